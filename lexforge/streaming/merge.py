"""The merge of senses as a stream: at-least-once batches, exactly-once effect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lexforge.operators.senses import KEY, merge
from lexforge.sources.lexicon import recovered, snapshot


def merge_stream(batches: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge every micro-batch of senses into the table at `path`; replaying a batch changes nothing."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(path) if recovered(spark, path) else batch.limit(0)
        snapshot(merge(old, batch), path)

    return batches.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame) -> DataFrame:
    """Stateful: the first row of each (en, tr, pos), for sinks that only append."""
    return stream.dropDuplicates(list(KEY))
