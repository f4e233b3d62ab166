"""Lexicon files: the nested dictionary, word lists, the journal; and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FIELDS = ("tr", "pos", "pos_en", "category", "example_en", "example_tr")
SENSE = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">"
SENSES = "en string, word_ord int, sense_ord int, " + ", ".join(f"{f} string" for f in FIELDS)
JOURNAL = f"en string, entry {SENSE}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """{headword: [sense, ...]} as flat senses; of equal keys the last counts, at the first one's place. Convert once, query the flat table."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,array<{SENSE}>>").alias("m"))
    words = raw.select(F.posexplode("m").alias("word_ord", "en", "senses"))
    last = F.row_number().over(Window.partitionBy("en").orderBy(F.col("word_ord").desc()))
    words = words.withColumn("rank", last).withColumn("word_ord", F.min("word_ord").over(Window.partitionBy("en"))).where("rank = 1")
    return words.select("en", "word_ord", F.posexplode_outer("senses").alias("sense_ord", "s")).select("en", "word_ord", "sense_ord", *[f"s.{f}" for f in FIELDS])


def read_words(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """A JSON array of strings as distinct words; a missing or broken file is empty, or, if required, an error."""
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], "en string")
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>", {"mode": "FAILFAST" if required else "PERMISSIVE"})).alias("en")).distinct()


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOURNAL).json(path)


def append_journal(senses: DataFrame, path: str) -> None:
    """senses: en and the fields; one JSON line each, nulls written out."""
    senses.select("en", F.struct(*FIELDS).alias("entry")).write.mode("append").option("ignoreNullFields", "false").json(path)


def _renamed(spark: SparkSession, old: str, new: str) -> None:
    a, b = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    if not a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"{old} could not be renamed to {new}")


def _removed(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def recovered(spark: SparkSession, path: str) -> bool:
    """Whether the table at `path` exists; one that a broken-off snapshot() had set aside is put back first."""
    path = path.rstrip("/")
    if not exists(spark, path) and exists(spark, path + ".old"):
        _renamed(spark, path + ".old", path)
    return exists(spark, path)


def snapshot(df: DataFrame, path: str) -> None:
    """Write beside, set the old table aside, rename the new one, then remove the old one.

    At every moment the old or the new table is there, as `path` or as `path`.old; recovered() finds it.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    df.write.mode("overwrite").parquet(path + ".staging")
    if recovered(spark, path):
        _removed(spark, path + ".old")
        _renamed(spark, path, path + ".old")
    _renamed(spark, path + ".staging", path)
    _removed(spark, path + ".old")


def apply_journal(spark: SparkSession, path: str, journal: str) -> None:
    """Merge the journal's senses into the table of senses at `path`, sorted by headword; the journal is renamed to `journal`.applied."""
    from lexforge.operators.senses import merge

    new = read_journal(spark, journal)
    meta = new.metadataColumn("_metadata")
    # Appends in the order of time, files of one append in the order of their names, lines as they stand.
    new = new.select("en", "entry.*", meta["file_name"].alias("_f"), meta["file_modification_time"].alias("_t"), F.monotonically_increasing_id().alias("_i"))
    append = F.regexp_replace("_f", r"^part-\d+-", "")
    began = new.groupBy(append.alias("_a")).agg(F.min("_t").alias("_b"))
    new = new.withColumn("_a", append).join(began, "_a")
    place = F.row_number().over(Window.partitionBy("en").orderBy("_b", "_a", "_f", "_i"))
    old = spark.read.parquet(path) if recovered(spark, path) else spark.createDataFrame([], SENSES)
    after = old.agg(F.max("sense_ord")).first()[0] or 0  # senses of the journal come after all others
    rows = new.withColumn("word_ord", F.lit(0)).withColumn("sense_ord", (place + after).cast("long"))
    rows = rows.select(*[F.col(c).cast(old.schema[c].dataType) if c != "sense_ord" else F.col(c) for c in old.columns])
    snapshot(merge(old.withColumn("sense_ord", F.col("sense_ord").cast("long")), rows).orderBy("en", "sense_ord"), path)
    _renamed(spark, journal.rstrip("/"), journal.rstrip("/") + ".applied")


def write_words(words: DataFrame, more: DataFrame, path: str) -> None:
    """The sorted union of two word lists."""
    snapshot(words.select("en").union(more.select("en")).distinct().orderBy("en"), path)


def to_nested(senses: DataFrame) -> DataFrame:
    """en, senses: array in sense order; headwords sorted."""
    s = F.array_sort(F.collect_list(F.struct("sense_ord", *FIELDS)))
    return senses.groupBy("en").agg(F.transform(s, lambda x: F.struct(*[x[f].alias(f) for f in FIELDS])).alias("senses")).orderBy("en")
