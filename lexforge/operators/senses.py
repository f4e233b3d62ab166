"""Ranking, de-duplication and merging of senses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_SENSES = 7
KEY = ("en", "tr", "pos")


def priority(category: Column) -> Column:
    """Common use first, general next, then all else."""
    low = F.lower(F.coalesce(category, F.lit("")))
    return F.when(F.contains(low, F.lit("yaygın")), 0).when(F.contains(low, F.lit("genel")), 1).otherwise(2)


def single_words(senses: DataFrame) -> DataFrame:
    return senses.where(~F.contains("en", F.lit(" ")))


def first_of_each(senses: DataFrame, group: str = "en", rank: Column | None = None, order: str = "sense_ord") -> DataFrame:
    """The first sense of each (lower translation, part of speech) of a group, in (priority, order)."""
    w = Window.partitionBy(group, F.lower("tr"), "pos").orderBy(rank if rank is not None else priority(F.col("category")), order)
    return senses.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def best_senses(senses: DataFrame, group: str = "en", rank: Column | None = None, order: str = "sense_ord", most: int = MAX_SENSES) -> DataFrame:
    """At most `most` senses of a group: those with an example pair first, others fill up; position is 1, 2, ..."""
    rank = rank if rank is not None else priority(F.col("category"))
    has = F.coalesce((F.col("example_en") != "") & (F.col("example_tr") != ""), F.lit(False))
    w = Window.partitionBy(group).orderBy(has.desc(), rank, order)
    return first_of_each(senses, group, rank, order).withColumn("position", F.row_number().over(w)).where(F.col("position") <= most)


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append the senses of `new` whose (en, tr, pos) `old` lacks (nulls are equal, case counts); first of new wins. Idempotent."""
    same = [old[k].eqNullSafe(new[k]) for k in KEY]
    fresh = new.join(old, same, "left_anti")
    w = Window.partitionBy(*KEY).orderBy("sense_ord")
    fresh = fresh.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return old.unionByName(fresh.select(*old.columns))


def pending(words: DataFrame, done: DataFrame, most: int | None = None) -> DataFrame:
    """Words not done yet; `most` is the batch size of the work list."""
    out = words.join(done, "en", "left_anti")
    return out.orderBy("en").limit(most) if most else out


def discovered(found: DataFrame, known: DataFrame) -> DataFrame:
    return found.select("en").distinct().join(known, "en", "left_anti")


def seed_tokens(texts: DataFrame, column: str = "tr") -> DataFrame:
    """Distinct lower-case tokens of 3 to 18 letters (before lowering) of the seed alphabet."""
    t = texts.select(F.explode(F.split(column, r"(?U)[\s,;()]+")).alias("t"))
    return t.where(F.length("t").between(3, 18) & F.col("t").rlike(r"(?iu)^[a-zçğıöşüâîû]+$")).select(F.lower("t").alias("seed")).distinct()


def sampled(words: DataFrame, most: int = 200, column: str = "seed") -> DataFrame:
    """A uniform sample without replacement, the same on every run: lowest hashes first."""
    return words.orderBy(F.md5(F.col(column).cast("binary")), column).limit(most)
