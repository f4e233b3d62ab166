"""The corpus pipeline: each stage calls one operator and works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexforge.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from lexforge.llm.common import documents, store

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", exact_dedup.stage),
    ("ngram_join", ngram_join.stage),
    ("mixing", mixing.stage),
    ("best_fit_packing", packing.stage),
]
#: Model training, tokenisation and packing cannot be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again as the next one's input."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs, _ = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
