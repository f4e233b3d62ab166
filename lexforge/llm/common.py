"""Shared helpers of the corpus operators: the cluster's shared folder, stored tables, checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of every contract here: space and U+0009 to U+000D (fixed values).
WHITE = b" \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of a key-only table that may be broadcast: 2^18 rows of some 16 bytes stay under 16 MB.
BROADCAST_ROWS = 1 << 18

_made: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where it is unset in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    name = getattr(shared_dir, "local", None)
    if name is None:
        name = shared_dir.local = tempfile.mkdtemp(prefix="lexforge-")
    return f"file://{name}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; removed at exit if drop() has not removed it before."""
    path = f"{shared_dir(spark)}/lexforge-{uuid.uuid4().hex[:12]}-{name}"
    _made[path] = spark
    return path


def drop(*paths: str) -> None:
    """Remove stored tables; a missing one is no error."""
    for path in paths:
        spark = _made.pop(path, None)
        if spark is not None:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _drop_all() -> None:
    for path in list(_made):
        try:
            drop(path)
        except Exception:  # noqa: BLE001  the session may be gone already
            _made.pop(path, None)


atexit.register(_drop_all)


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that hold within the block; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store(df: DataFrame, name: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it again: cuts the lineage, and survives the loss of executors.

    The shuffle files of the query that made it go as soon as it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with configured(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Columns that located() adds.
FILE, AT = "__lf_file", "__lf_at"


def located(docs: DataFrame) -> DataFrame:
    """docs with each row's place, (FILE, AT): a hash of its file's path and its number there, however tasks split the files.

    Only scans of Parquet files have such places; any other table is stored first. So rows are told apart whatever they hold.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        docs, _ = store(docs, "rows")
    meta = docs.metadataColumn("_metadata")
    return docs.withColumns({FILE: F.xxhash64(meta["file_path"]), AT: meta["row_index"]})


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of docs (located) whose place is not in dropped (a stored table with FILE and AT), without the places."""
    out = docs.join(small(dropped.select(FILE, AT)), [FILE, AT], "left_anti")
    return out.drop(FILE, AT)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored key table, marked for broadcast only if counting shows at most `rows` rows; else Spark's own choice (a shuffle) holds."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, so that few whole texts exist as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
