"""Exact deduplication by a stateful stream.

Every row becomes a fingerprint (digest of the text without ASCII white space, length, content locator: file and row). The
fingerprints are streamed in micro-batches into keyed state that never expires and lives on disk (RocksDB): by digest it
retains the stable identifier of the row that stays, its locator and the number of rows. Rows of digests hit more than once
are read again by their locators and their full normalised bytes compared; should texts differ under one digest, they are
grouped again by their bytes.

The state keeps one entry for a distinct text, whatever the size of its group; counts are combined before the shuffle. With
a folder for the state (`state`) it outlives the run: later tables meet all rows that came before, of which one stays;
bytes are compared within a run, and with earlier runs by their SHA-256 digests.

Defined results: a null text counts as empty, so null, empty and blank texts are one group; ties go to the smallest doc_id
(a null id comes first), then to one row by its place; rows are told apart by their places, so of repeated rows with one
doc_id exactly one stays, whatever other texts that id has; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.common import AT, FILE, WHITE, configured, documents, located, new_path, pieces, small, store, texts, without_rows

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each store reserves megabytes for its logs
}


def sha256(norm: bytes) -> bytes:
    return hashlib.sha256(norm).digest()


def normal(text: str) -> bytes:
    return text.encode().translate(None, WHITE)


PRINTS = f"doc_id long, digest binary, sha string, n long, {FILE} long, {AT} long"
STAYS = f"struct<less:long,doc_id:long,{FILE}:long,{AT}:long>"


def fingerprints(docs: DataFrame, digest: Callable[[bytes], bytes] = sha256) -> DataFrame:
    """doc_id, digest, code points of the original text, locator (FILE, AT) of located docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            norm = [normal(t) for t in texts(b.column("text"))]
            n = pc.fill_null(pc.utf8_length(b.column("text")), 0).cast(pa.int64())
            sha = pa.array([hashlib.sha256(x).hexdigest() for x in norm], pa.string()) if digest is not sha256 else pa.nulls(b.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([digest(x) for x in norm], pa.binary()), sha, n, b.column(FILE), b.column(AT)], [c.split()[0] for c in PRINTS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), FILE, AT).mapInArrow(run, PRINTS)


def best_row() -> Column:
    return F.min(F.struct((-F.col("n")).alias("less"), "doc_id", FILE, AT))


def retain(stream: DataFrame) -> DataFrame:
    """The stateful step, for a stream (or table) of fingerprints: by digest, the row that stays and the rows seen."""
    return stream.groupBy("digest").agg(best_row().alias("stays"), F.count("*").alias("seen"))


def stream_state(spark: SparkSession, prints: str, updates: str, checkpoint: str, bytes_per_trigger: int = 1 << 30) -> DataFrame:
    """Run what is new in the folder `prints` through the state in `checkpoint`; the last word on each digest (from `updates`)."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.withColumn("number", F.lit(number)).write.mode("overwrite").parquet(f"{updates}/batch-{number}")

    with configured(spark, SETTINGS):
        source = spark.readStream.schema(PRINTS).option("maxBytesPerTrigger", bytes_per_trigger).option("recursiveFileLookup", "true").parquet(prints)
        query = retain(source).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
        query.awaitTermination()
    shape = f"digest binary, stays {STAYS}, seen long, number int"
    try:
        rows = spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(updates)
        last = rows.groupBy("digest").agg(F.max_by(F.struct("stays", "seen"), "number").alias("last"))
        return last.select("digest", "last.stays", "last.seen")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # no batch ran: the table is empty
            raise
        return spark.createDataFrame([], shape).drop("number")


def classes(docs: DataFrame, digest: Callable[[bytes], bytes] = sha256, bytes_per_trigger: int = 1 << 30, state: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, FILE and AT (its place in located docs), keep_id, group_size, kept, text_sha256.

    state: a shared folder that keeps the state for later runs; without it the run begins with an empty one.
    """
    spark = docs.sparkSession
    docs = docs if FILE in docs.columns else located(docs)
    home = state or new_path(spark, "dedup-state")
    mine = f"{home}/prints/{uuid.uuid4().hex}"
    fingerprints(docs, digest).write.parquet(mine)
    prints = spark.read.schema(PRINTS).parquet(mine)
    found, _ = store(stream_state(spark, f"{home}/prints", f"{home}/updates", f"{home}/checkpoint", bytes_per_trigger), "dedup-classes")

    # Full bytes on hits: within a digest the least and the greatest normalised text must be the same.
    hit = prints.join(found.where("seen > 1").select("digest"), "digest", "left_semi").select("digest", FILE, AT)
    hit, _ = store(hit, "dedup-hits")

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            norm = pa.array([normal(t) for t in texts(b.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("digest", FILE, AT)), norm], ["digest", FILE, AT, "norm"])

    full = docs.select(F.col("text").cast("string"), FILE, AT).join(small(hit), [FILE, AT]).mapInArrow(bytes_of, f"digest binary, {FILE} long, {AT} long, norm binary")
    bad, _ = store(full.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("z")).where("a <> z").select("digest"), "dedup-collisions")

    out = prints.join(found, "digest")
    if not bad.isEmpty():
        odd = prints.join(bad, "digest", "left_semi").join(full.select(FILE, AT, "norm"), [FILE, AT])
        own = odd.groupBy("digest", "norm").agg(best_row().alias("stays"), F.count("*").alias("seen"))
        odd = odd.join(own, ["digest", "norm"]).select(out.columns)
        out = out.join(bad, "digest", "left_anti").unionByName(odd)
    kept = (F.col(FILE) == F.col(f"stays.{FILE}")) & (F.col(AT) == F.col(f"stays.{AT}"))
    out = out.select("doc_id", FILE, AT, F.col("stays.doc_id").alias("keep_id"), F.col("seen").alias("group_size"), kept.alias("kept"), F.coalesce("sha", F.lower(F.hex("digest"))).alias("text_sha256"))
    return out


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with their columns."""
    docs = located(docs)
    gone, _ = store(classes(docs).where("NOT kept").select(FILE, AT), "dedup-gone")
    return without_rows(docs, gone)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
