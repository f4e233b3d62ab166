"""URL filter: rules first, gradient-boosted trees on lexical features for the rest (DataFrame functions and Spark ML only).

Features: lengths of url, host, path and query, path depth, digit ratio, character entropy, number of parameters, dots and
hyphens of the host, and suffix statistics: the smoothed share of blocked urls under the host's last label and last two
labels, counted over all labelled rows. Rows that fit the model get these shares out of fold, from the labelled rows of the
other folds of urls, so no row's own label is among its features. Labelled urls are those that a rule decides. At most
`max_train_rows` distinct ones (lowest hashes of each class) fit the model; every url is judged.

Defined results: a null url, or one without `://`, has empty host and path and no rule, and the model judges it by its
features (lengths 0); without labelled urls of both classes the method's verdict is the only class seen, `allow` if none;
equal rules count once; repeated rows are judged row by row; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.common import drop, small, store

#: The rules of the query (fixed values): rule and verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
FEATURES = ["f_len", "f_host", "f_path", "f_query", "f_depth", "f_digits", "f_entropy", "f_params", "f_dots", "f_hyphens", "f_label", "f_domain"]
#: Folds of urls for the suffix shares of rows that fit the model.
FOLDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits (ties: the first by code point); null if none. The list of rules is a small parameter."""
    out = F.lit(None).cast("string")
    for rule in sorted(sorted(rules, reverse=True), key=len):
        name, _, rest = rule.partition("/")
        fits = (F.concat(F.lit("."), host).endswith("." + name)) & path.startswith("/" + rest if "/" in rule else "")
        out = F.when(fits, rule).otherwise(out)
    return out


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits per character, from the distinct characters of the text."""
    n = F.length(text)
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = F.transform(chars, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """urls with host, path, the suffixes and all features but the suffix statistics."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    out = urls.withColumn("host", host_of(u)).withColumn("path", path_of(u))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    return out.select(
        "*", F.element_at(labels, -1).alias("label"), F.substring_index("host", ".", -2).alias("domain"),
        F.length(u).cast("double").alias("f_len"), F.length("host").cast("double").alias("f_host"), F.length("path").cast("double").alias("f_path"),
        F.length(query).cast("double").alias("f_query"), _count(F.col("path"), "/").cast("double").alias("f_depth"),
        (F.length(F.regexp_replace(u, "[^0-9]", "")) / F.greatest(F.length(u), F.lit(1))).cast("double").alias("f_digits"), entropy(u).cast("double").alias("f_entropy"),
        F.when(query == "", 0).otherwise(1 + _count(query, "&")).cast("double").alias("f_params"), _count(F.col("host"), ".").cast("double").alias("f_dots"), _count(F.col("host"), "-").cast("double").alias("f_hyphens"),
    )


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("fold")), F.lit(FOLDS))


def statistics(known: DataFrame, key: str) -> DataFrame:
    """Of all labelled rows: one row per suffix with f_<key>, its smoothed share of blocked ones, and `out`, the same by fold without that fold."""
    folds = [(F.sum(F.when(fold_of(F.col("url")) != k, F.col("blocked"))), F.count(F.when(fold_of(F.col("url")) != k, 1))) for k in range(FOLDS)]
    share = lambda blocked, n: F.when(n > 0, (F.coalesce(blocked, F.lit(0)) + 1) / (n + 2))
    return known.groupBy(key).agg(share(F.sum("blocked"), F.count("*")).alias(f"f_{key}"), F.array(*(share(*x) for x in folds)).alias(f"out_{key}"))


def with_statistics(rows: DataFrame, label: DataFrame, domain: DataFrame, out_of_fold: bool = False) -> DataFrame:
    """Adds f_label and f_domain; both tables have one row per suffix of all labelled rows, and are broadcast only if small."""
    for key, table in (("label", label), ("domain", domain)):
        rows = rows.join(small(table), key, "left")
        if out_of_fold:
            rows = rows.withColumn(f"f_{key}", F.get(f"out_{key}", fold_of(F.col("url")).cast("int")))
        rows = rows.drop(f"out_{key}")
    return rows.withColumn("f_label", F.coalesce("f_label", F.lit(0.5))).withColumn("f_domain", F.coalesce("f_domain", "f_label"))


def train(rows: DataFrame, max_train_rows: int, trees: int, depth: int) -> tuple[GBTClassificationModel | None, DataFrame, DataFrame, str]:
    """rows: lexical() with `blocked` (null: not labelled). The model, the suffix statistics, the only class seen."""
    known = rows.where("blocked IS NOT NULL")
    label, domain = (store(statistics(known, key), "url-suffix")[0] for key in ("label", "domain"))
    keep = [c for c in ("url", "label", "domain", "blocked", *FEATURES) if c in rows.columns]
    distinct, distinct_path = store(known.select(*keep).dropDuplicates(["url"]), "url-distinct")
    many = {r.blocked: r["count"] for r in distinct.groupBy("blocked").count().collect()}
    if len(many) < 2:
        drop(distinct_path)
        return None, label, domain, "block" if many.get(1) else "allow"
    rare = min(many, key=many.get)  # in proportion, but a rare class has at least a tenth, if it has so many urls
    few = min(many[rare], max(max_train_rows // 10, max_train_rows * many[rare] // sum(many.values()), 1))
    lowest = lambda kind, n: distinct.where(F.col("blocked") == kind).orderBy(F.xxhash64("url"), "url").limit(n)
    sample, sample_path = store(lowest(rare, few).unionByName(lowest(1 - rare, max_train_rows - few)), "url-train")
    fitted = with_statistics(sample, label, domain, out_of_fold=True).coalesce(1)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(fitted).select("features", F.col("blocked").cast("double").alias("label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=17, maxBins=32).fit(data)
    drop(distinct_path, sample_path)
    return model, label, domain, ""


def predicted(rows: DataFrame, model: GBTClassificationModel, label: DataFrame, domain: DataFrame) -> DataFrame:
    """rows: lexical(). Adds the trees' `probability` (a vector) and `prediction` (1: block)."""
    return model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_statistics(rows, label, domain)))


def judged(urls: DataFrame, key: str = "page_id", rules: dict[str, str] = RULES, max_train_rows: int = 4000, trees: int = 8, depth: int = 3) -> DataFrame:
    """key, url, host, path, rule, verdict, block_prob (null where a rule decides)."""
    rows = lexical(urls.select(F.col(key), F.col("url").cast("string")))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    of_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        of_rule = F.when(F.col("rule") == rule, verdict).otherwise(of_rule)
    rows = rows.withColumn("by_rule", of_rule).withColumn("blocked", F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("int")))
    model, label, domain, only = train(rows, max_train_rows, trees, depth)
    if model is None:
        return rows.select(key, "url", "host", "path", "rule", F.coalesce("by_rule", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("block_prob"))
    scored = predicted(rows, model, label, domain)
    method = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    from pyspark.ml.functions import vector_to_array

    return scored.select(key, "url", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), F.when(F.col("by_rule").isNull(), vector_to_array("probability")[1]).alias("block_prob"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
