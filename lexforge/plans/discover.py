"""Work lists that grow while they are worked off, to their fixpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.sources import html_table


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and checkpointed in the shared folder; a temporary one only in local mode without a setting."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            import tempfile

            folder = tempfile.mkdtemp()
        context.setCheckpointDir(folder)
    return df.checkpoint()


def fixpoint(start: DataFrame, step: Callable[[DataFrame], DataFrame], rounds: int = 100) -> DataFrame:
    """start: en. Rounds of `step` over the words found last, until no new one comes; each round is checkpointed once."""
    known = fresh = kept(start.select("en").distinct())
    for _ in range(rounds):
        fresh = kept(step(fresh).select("en").distinct().join(known, "en", "left_anti"))
        if fresh.isEmpty():
            return known
        known = known.union(fresh)  # what was found before is not written again
    raise RuntimeError("no fixpoint")


def discover(pages: DataFrame, seeds: DataFrame, rounds: int = 100) -> DataFrame:
    """pages: page_id (the queried seed), html. en: all seeds reached from the given ones (en).

    A round looks up the pages of the seeds found last, takes their headwords, and the translations of these headwords on any
    page as the next seeds. Pages are parsed before the rounds, once for headwords and once for senses.
    """
    rows = html_table.raw_rows(pages)
    headwords = kept(html_table.reverse_headwords(rows))  # page_id, en
    senses = kept(html_table.forward_rows(rows).select(F.lower("en").alias("en"), "tr").distinct())

    def step(fresh: DataFrame) -> DataFrame:
        found = headwords.join(fresh.withColumnRenamed("en", "page_id"), "page_id", "left_semi").select("en").distinct()
        return senses.join(found, "en", "left_semi").select(F.col("tr").alias("en"))

    return fixpoint(seeds, step, rounds)


def expected_yield(found: int, seeds: int, sample: int) -> float:
    """New words to expect from all seeds, by those a sample gave."""
    return found * seeds / sample if sample else 0.0
