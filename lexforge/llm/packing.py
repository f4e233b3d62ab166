"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Each partition of the input tokenises its documents, cuts those longer than a sequence and packs its pieces best-fit
(longest first). Bins that are nearly full, or too full for any item that is left anywhere, are done. The others go up a
tree as items of their load: `FAN_IN` partitions meet in one, are packed best-fit again, and so on up to the root. Only
bin numbers and loads travel; the pieces learn their final place from a table of bin moves. Before each round the bins
that nothing left could join are set aside, so what meets at the root is a few bins per partition, not a share of the rows.

Bin numbers are made of partition and rank, and every task sorts its items, so a task that runs again gives the same bins.

Defined results: a null or empty text is one piece of one token (the end id); repeated rows are packed row by row; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.common import documents, drop, store
from lexforge.llm.tokens import Encoder, vocabulary_path

CAPACITY = 4096
END_ID = 1
FAN_IN = 8
#: A bin with so few free tokens counts as full in the first round; the slack doubles with each round.
SLACK = 8
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, at long"
MOVES = "bin long, parent long, shift long, load long"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, longest items first (ties in the order given); the number of bins.

    Bins are found by their free room: bit r of `room` says that some bin has exactly r tokens free, so the tightest bin
    that takes an item of size s is the lowest set bit from s upwards.
    """
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = bins = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        above = room >> s
        if above:
            r = s + (above & -above).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                room ^= 1 << r
        else:
            r, b, bins = capacity, bins, bins + 1
        bin_of[i], offset[i] = b, capacity - r
        if r > s:
            free[r - s].append(b)
            room |= 1 << (r - s)
    return bin_of, offset, bins


def by_bytes(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of text; one text is never split."""
    n = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = np.flatnonzero(np.diff(np.cumsum(n) // most)) + 1
    for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(n)]):
        if z > a:
            yield batch.slice(a, z - a)


def packed_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece, packed within its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows = None, []
        ids_of: list[pa.Array] = []
        number = 0
        for batch in batches:
            for b in by_bytes(batch):
                encoder = encoder or Encoder(vocabulary)
                ids, begins = encoder.encode(b.column("text"))
                ids = ids.astype("<u4", copy=False)
                ids_of.append(b.column("doc_id"))
                for k in range(b.num_rows):
                    own = np.append(ids[begins[k] : begins[k + 1]], np.uint32(end_id)).astype("<u4", copy=False)
                    for p, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        rows.append((number, p, start, len(part), zlib.crc32(part.tobytes())))
                    number += 1
        if not rows:
            return
        doc, piece, start, length, crc = np.array(rows, np.int64).T
        del rows
        bins, at, _ = best_fit(length, capacity)
        bins += TaskContext.get().partitionId() << 32
        doc_ids = pa.concat_arrays(ids_of)
        for a in range(0, len(doc), 50_000):
            z = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(doc[z])), pa.array(piece[z], pa.int32()), *(pa.array(x[z]) for x in (start, length, crc, bins, at))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "at"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def merge_round(bins: DataFrame, groups: int, width: int, capacity: int) -> DataFrame:
    """bins: bin, load. Packs the bins of `width` neighbouring partitions again; bin, parent, shift, load of the parent."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"bin": [], "load": []}, dtype="int64"), *frames]).sort_values(["load", "bin"], ascending=[False, True])
        if len(got) == 0:
            return
        number, load = got["bin"].to_numpy(np.int64), got["load"].to_numpy(np.int64)
        of, at, n = best_fit(load, capacity)
        parent, total = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        np.minimum.at(parent, of, number)
        np.add.at(total, of, load)
        yield pd.DataFrame({"bin": number, "parent": parent[of], "shift": at, "load": total[of]})

    group = F.floor(F.shiftright("bin", 32) / width)
    dealt = bins.repartition(groups, group) if groups > 1 else bins.coalesce(1)
    return dealt.mapInPandas(run, MOVES)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, fan_in: int = FAN_IN, slack: int = SLACK) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found, _ = store(packed_pieces(docs, vocabulary or vocabulary_path(), capacity, end_id), "pack-pieces")
    loads, loads_path = store(found.groupBy("bin").agg(F.sum("length").alias("load")).where(F.col("load") < capacity - slack), "pack-loads")
    parts = (loads.agg(F.max(F.shiftright("bin", 32)).alias("most")).first().most or 0) + 1
    left, moves, old = loads, loads.select("bin", F.col("bin").alias("parent"), F.lit(0).cast("long").alias("shift")), [loads_path]
    width = 1
    while True:
        # A bin that has less room than the smallest item left is done, whatever its load.
        least = left.agg(F.min("load").alias("least")).first().least
        if least is None:
            break
        left = left.where(F.col("load") <= capacity - least)
        if left.limit(2).count() < 2:
            break
        width *= fan_in
        groups = -(-parts // width)
        step, path = store(merge_round(left, groups, width, capacity), "pack-round")
        next_moves = moves.alias("m").join(step.alias("s"), F.col("m.parent") == F.col("s.bin"), "left").select(
            "m.bin", F.coalesce("s.parent", "m.parent").alias("parent"), (F.col("m.shift") + F.coalesce("s.shift", F.lit(0))).alias("shift")
        )
        moves, moves_path = store(next_moves, "pack-moves")
        drop(*old)
        old = [path, moves_path]
        slack *= 2
        left = step.select(F.col("parent").alias("bin"), "load").distinct().where(F.col("load") < capacity - slack)
        if groups == 1:
            break
    out = found.join(moves, "bin", "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("parent", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)
