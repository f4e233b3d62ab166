"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

A document's expected copies are target / size of its source. Within a source the documents stand in a fixed order (size,
then id, null first); the running sum of expected copies plus one offset drawn per source crosses an integer for each copy to
emit. As all documents of a source expect the same number, the running sum is rank * rate, and the rank is the
number of rows in earlier ranges and before the row in its own. Ranges cut the order of (source, size, id) into parts of
like length, so a source with a third of all rows, or copies of one text, never meet in one task. Ordering by size keeps the
words taken within about one document of the target.

Targets: weights 1, 2, 3 repeating over the sources by code point (null last) share all sizes; a target stops at
`most` times its source's size and the excess is reshared by weight. That is water-filling: with sources ordered by
cap / weight a prefix is capped, found with two running sums over the table of sources.

Defined results: null and empty texts have size 0 and take 0 words; a null source is a source of its own; an empty table
gives no rows; repeated rows count as separate rows; a source whose sizes are all 0 has target 0; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexforge.llm.common import AT, FILE, WORD_PATTERN, documents, drop, located, small, store

#: Rows of one range of the order, on average, at most.
RANGE = 1 << 18
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """totals: source, source_size. Adds target. The table has one row per source, so one window over it is small."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("weight", turn.cast("long"))
    all_ = Window.partitionBy(F.lit(1))
    order = Window.partitionBy(F.lit(1)).orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("total", F.sum("source_size").over(all_)).withColumn("total_weight", F.sum("weight").over(all_))
    t = t.withColumn("size_before", F.coalesce(F.sum("source_size").over(upto), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    t = t.withColumn("level", (F.col("total") - most * F.col("size_before")) / (F.col("total_weight") - F.col("weight_before")))
    free = F.col("source_size") * most >= F.col("level") * F.col("weight")  # the first such level is the water level
    t = t.withColumn("water", F.min_by("level", F.when(free, F.col("weight_before"))).over(all_))
    share = F.least(F.col("water") * F.col("weight"), (F.col("source_size") * most).cast("double"))
    return t.select("source", "source_size", F.coalesce(share, F.lit(0.0)).alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """One number in [0, 1) per source, from the first 32 bits of an md5."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))).cast("binary"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken, and of located docs the places: one row per row of docs."""
    places = [c for c in (FILE, AT) if c in docs.columns]
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), *places)
    narrow, narrow_path = store(narrow, "mix-sizes")
    by_id, id_path = store(narrow.groupBy("source", "size", "doc_id").count(), "mix-ids")  # repeated rows are combined
    # Ranges of (source, size, id) of like numbers of rows: a hot source or size is split among them.
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-narrow.count() // RANGE))
    ordered = by_id.repartitionByRange(ranges, F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_first()).withColumn("range", F.spark_partition_id())
    by_id, ranged_path = store(ordered, "mix-ranges")
    drop(id_path)
    sums = by_id.groupBy("source", "range").agg(F.sum("count").alias("rows"), F.sum(F.col("size") * F.col("count")).alias("words"))
    sums, sums_path = store(sums, "mix-sums")  # one row per range and source
    rates = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    rates, _ = store(rates.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("start", offset(F.col("source"), seed)), "mix-rates")

    before = lambda column, w: F.coalesce(F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select("source", "range", before("rows", Window.partitionBy("source").orderBy("range")).alias("base"))
    same = lambda a, b, *keys: [a[k].eqNullSafe(b[k]) for k in keys]
    few = F.broadcast(rates) if rates.count() <= 100_000 else rates
    base = base.join(few, same(base, few, "source")).select(base.source, "range", "base", "source_size", "target", "rate", "start")
    within = Window.partitionBy("range", "source").orderBy("size", F.col("doc_id").asc_nulls_first())
    placed = by_id.withColumn("earlier", before("count", within))
    placed = placed.join(base, same(placed, base, "source", "range")).select(placed.source, "size", "doc_id", (F.col("base") + F.col("earlier")).alias("base"), "source_size", "target", "rate", "start")
    placed, _ = store(placed, "mix-places")
    drop(ranged_path, sums_path)
    again = [F.col(c) for c in places] or [F.lit(0)]
    ranked = narrow.withColumn("turn", F.row_number().over(Window.partitionBy("source", "size", "doc_id").orderBy(*again)))
    out = ranked.join(placed, same(ranked, placed, "source", "size", "doc_id"))
    place = F.col("base") + F.col("turn")
    cross = F.floor(place * F.col("rate") + F.col("start")) - F.floor((place - 1) * F.col("rate") + F.col("start"))
    out = out.withColumn("copies", F.least(cross, F.lit(most)).cast("long"))
    return out.select(ranked.doc_id, ranked.source, ranked["size"], "source_size", "target", "copies", (F.col("copies") * ranked["size"]).alias("taken"), *places)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them (a row may come several times), with their columns."""
    docs = located(docs)
    copies, _ = store(mix(docs).where("copies > 0").select(FILE, AT, F.col("copies").cast("int").alias("__lf_copies")), "mix-copies")
    again = docs.join(small(copies), [FILE, AT]).withColumn("__lf_again", F.explode(F.array_repeat(F.lit(1), F.col("__lf_copies"))))
    return again.drop(FILE, AT, "__lf_copies", "__lf_again")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0) AS BIGINT) AS size FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
o AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS total_weight,
  CAST(coalesce(sum(source_size) OVER w, 0) AS BIGINT) AS size_before, CAST(coalesce(sum(weight) OVER w, 0) AS BIGINT) AS weight_before FROM t
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - 3 * size_before) / (total_weight - weight_before) AS level FROM o),
f AS (SELECT *, (SELECT arg_min(level, weight_before) FROM l WHERE source_size * 3 >= level * weight) AS water FROM l),
r AS (SELECT source, source_size, coalesce(least(water * weight, CAST(source_size * 3 AS DOUBLE)), 0) AS target,
  CAST(('0x' || substr(md5('{SEED}:' || coalesce('s' || source, 'n')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS start FROM f),
p AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, start,
  row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS place FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  CAST(least(floor(place * rate + start) - floor((place - 1) * rate + start), 3) AS BIGINT) * size AS taken FROM p
"""
