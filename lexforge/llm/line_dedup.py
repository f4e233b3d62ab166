"""Line deduplication over sharded cuckoo filters that exact reference-count tables back.

Each document gives one posting per distinct key (a line without outer ASCII white space, A-Z lowered, of at least
MIN_POINTS code points; 128-bit hash). Keys belong to shards. A shard has

* an exact table: by key the references, the smallest and the greatest document holding it;
* a stack of cuckoo filters over its keys: a batch's keys that no filter knows are new and are appended without a look into
  the exact table; the others are joined with it (a false positive is found there, and is then new).

Postings are combined by key before they travel, so a line that a third of all documents share costs each shard few rows.
Deleting documents takes their references back; a key without references leaves table and filter, so a line that was a
repeat becomes an original again: insert and delete undo each other.

Defined results: a null or empty text is one empty line, which has no key; repeated rows of one document count as one
document for the decision; equal ids with different texts are decided row by row; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.common import WHITE, documents, drop, pieces, small, store, texts

MIN_POINTS = 10
#: Keys of a shard: some 15 MB as a pandas frame.
SHARD_KEYS = 1 << 18
POSTINGS = "doc_id long, t long, n_lines long, sha string, k1 long, k2 long, at array<int>"
FILTERS = "shard int, filters array<binary>"


class CuckooFilter:
    """16-bit fingerprints in buckets of four, over 64-bit hashes; vectorised, with deletion."""

    SLOTS, KICKS = 4, 200

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def for_keys(cls, n: int) -> "CuckooFilter":
        buckets = 1 << max(4, int(np.ceil(np.log2(max(n, 1) / cls.SLOTS / 0.7))))
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    @property
    def room(self) -> int:
        """Keys that can be added up to a load of 0.9."""
        return int(0.9 * self.table.size) - int(np.count_nonzero(self.table))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = keys.astype(np.int64).view(np.uint64)
        mark = ((h >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        one = (h & np.uint64(len(self.table) - 1)).astype(np.int64)
        return mark, one, self._other(mark, one)

    def _other(self, mark: np.ndarray, place: np.ndarray) -> np.ndarray:
        return place ^ ((np.asarray(mark, np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return (self.table[one] == mark[:, None]).any(1) | (self.table[two] == mark[:, None]).any(1)

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Add keys; those without a place are returned."""
        mark, one, two = self._places(keys)
        left = np.arange(len(keys))
        for place in (one, two):
            for slot in range(self.SLOTS):
                open_ = left[self.table[place[left], slot] == 0]
                _, first = np.unique(place[open_], return_index=True)
                put = open_[first]
                self.table[place[put], slot] = mark[put]
                left = np.setdiff1d(left, put, assume_unique=True)
        lost = [i for i in left.tolist() if not self._kick(mark[i], int(two[i]), i)]
        return keys[lost]

    def _kick(self, mark: np.uint16, place: int, turn: int) -> bool:
        path = []
        for k in range(self.KICKS):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                return True
            slot = (turn + k) % self.SLOTS
            path.append((place, slot, self.table[place, slot]))
            self.table[place, slot], mark = mark, self.table[place, slot]
            place = int(self._other(mark, place))
        for place, slot, old in reversed(path):
            self.table[place, slot] = old
        return False

    def remove(self, keys: np.ndarray) -> np.ndarray:
        """Remove one mark per key; which keys had one."""
        mark, one, two = self._places(keys)
        done = np.zeros(len(keys), bool)
        for i in range(len(keys)):
            for place in (one[i], two[i]):
                at = np.flatnonzero(self.table[place] == mark[i])
                if len(at):
                    self.table[place, at[0]] = 0
                    done[i] = True
                    break
        return done


def add_to_stack(stack: list[CuckooFilter], keys: np.ndarray) -> list[CuckooFilter]:
    """Keys go to the last filter as long as it has room; a larger one is put on top for the rest."""
    while len(keys):
        n = min(len(keys), max(stack[-1].room, 0)) if stack else 0
        if n:
            keys = np.concatenate([stack[-1].add(keys[:n]), keys[n:]])
        if len(keys):
            stack = [*stack, CuckooFilter.for_keys(max(2 * len(keys), 2 * stack[-1].table.size if stack else 0))]
    return stack


def key_of(line: str) -> str:
    """The line's key; empty if too short to count."""
    key = line.strip(WHITE.decode())
    return key.translate(_LOWER) if len(key) >= MIN_POINTS else ""


_LOWER = {c: c + 32 for c in range(65, 91)}


def postings(docs: DataFrame) -> DataFrame:
    """One row per document and key (at: its line numbers), and one per document without key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            out: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                raw = text.encode()
                t, lines = xxhash.xxh3_64_intdigest(raw) - (1 << 63), text.split("\n")
                at: dict[str, list[int]] = {}
                for i, line in enumerate(lines):
                    if key := key_of(line):
                        at.setdefault(key, []).append(i)
                out.append((doc, t, len(lines), hashlib.sha256(raw).hexdigest(), None, None, None))
                for key, where in at.items():
                    h = xxhash.xxh3_128_intdigest(key.encode())
                    out.append((doc, t, None, None, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), where))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = [c.split()[0] for c in POSTINGS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, POSTINGS)


def by_key(rows: DataFrame) -> DataFrame:
    """shard-less exact entries of postings: k1, k2, refs, least, most."""
    return rows.groupBy("k1", "k2").agg(F.count("*").alias("refs"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))


def shards_for(spark: SparkSession, postings: int) -> int:
    """Shards that keep a shard's keys, which meet in one task, at some SHARD_KEYS however many postings there are."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // SHARD_KEYS))


@dataclass
class LineIndex:
    """The index: exact table, filters and postings, each a stored table. A method that changes it stores new versions."""

    spark: SparkSession
    shards: int = 0
    refs: DataFrame | None = None
    filters: DataFrame | None = None
    held: DataFrame | None = None

    def __post_init__(self):
        self.shards = self.shards or shards_for(self.spark, 0)
        self.refs = self.refs if self.refs is not None else self.spark.createDataFrame([], "k1 long, k2 long, refs long, least long, most long")
        self.filters = self.filters if self.filters is not None else self.spark.createDataFrame([], FILTERS)
        self.held = self.held if self.held is not None else self.spark.createDataFrame([], "doc_id long, k1 long, k2 long")

    def _sharded(self, df: DataFrame) -> DataFrame:
        return df.withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))

    def _probe(self, keys: DataFrame) -> DataFrame:
        """keys with `maybe`: whether a filter of the shard knows the key."""

        def run(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            known = np.zeros(len(rows), bool)
            for data in own["filters"].iloc[0] if len(own) else []:
                known |= CuckooFilter.load(data).contains(rows["k2"].to_numpy())
            return rows.assign(maybe=known)

        shape = "k1 long, k2 long, refs long, least long, most long, shard int, maybe boolean"
        return self._sharded(keys).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(run, shape)

    def _changed(self, keys: DataFrame, remove: bool) -> DataFrame:
        """The filters after adding or removing the given keys (k1, k2)."""

        def run(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            stack = [CuckooFilter.load(x) for x in (own["filters"].iloc[0] if len(own) else [])]
            k = rows.sort_values(["k1", "k2"])["k2"].to_numpy(np.int64)
            if remove:
                for f in reversed(stack):
                    k = k[~f.remove(k)]
            else:
                stack = add_to_stack(stack, k)
            return pd.DataFrame({"shard": [key[0]], "filters": [[f.dump() for f in stack]]})

        return self._sharded(keys.select("k1", "k2")).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(run, FILTERS)

    def insert(self, rows: DataFrame) -> "LineIndex":
        """Add a batch of postings (doc_id, k1, k2)."""
        rows = rows.where("k1 IS NOT NULL").select("doc_id", "k1", "k2")
        batch, path = store(self._probe(by_key(rows)), "line-batch")
        new, maybe = batch.where("NOT maybe").drop("maybe", "shard"), batch.where("maybe").drop("maybe", "shard")
        both = self.refs.alias("o").join(maybe.alias("n"), ["k1", "k2"], "full_outer")
        merged = both.select(
            "k1", "k2", (F.coalesce("o.refs", F.lit(0)) + F.coalesce("n.refs", F.lit(0))).alias("refs"),
            F.least("o.least", "n.least").alias("least"), F.greatest("o.most", "n.most").alias("most"), F.col("o.refs").isNull().alias("fresh"),
        )
        refs, _ = store(merged.unionByName(new.withColumn("fresh", F.lit(True))), "line-refs")
        filters, _ = store(self._changed(refs.where("fresh"), remove=False), "line-filters")
        drop(path)
        return LineIndex(self.spark, self.shards, refs.drop("fresh"), filters, self.held.unionByName(rows))

    def delete(self, doc_ids: DataFrame) -> "LineIndex":
        """Take back all references of the given documents (doc_id)."""
        ids, _ = store(doc_ids.select("doc_id").distinct(), "line-deleted")
        gone, _ = store(self.held.join(small(ids), "doc_id", "left_semi"), "line-gone")
        held, _ = store(self.held.join(small(ids), "doc_id", "left_anti").select("doc_id", "k1", "k2"), "line-held")
        touched = gone.select("k1", "k2").distinct()
        again = by_key(held.join(touched, ["k1", "k2"], "left_semi"))
        refs, _ = store(self.refs.join(touched, ["k1", "k2"], "left_anti").unionByName(again), "line-refs")
        dead, _ = store(touched.join(again, ["k1", "k2"], "left_anti"), "line-dead")
        filters, _ = store(self._changed(dead, remove=True), "line-filters")
        return LineIndex(self.spark, self.shards, refs, filters, held)

    def repeats(self) -> DataFrame:
        """Keys that at least two documents hold: k1, k2, least."""
        return self.refs.where("least <> most").select("k1", "k2", "least")


def decided(docs: DataFrame, batches: int = 2) -> tuple[DataFrame, DataFrame]:
    """Insert all of docs in batches; (rows: doc_id, t, n_lines, sha), (drops: doc_id, t, at - the lines that go)."""
    spark = docs.sparkSession
    found, _ = store(postings(docs), "line-postings")
    index = LineIndex(spark, shards_for(spark, found.where("k1 IS NOT NULL").count()))
    for i in range(batches):
        index = index.insert(found.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    gone = found.where("k1 IS NOT NULL").join(index.repeats(), ["k1", "k2"]).where("doc_id <> least")
    drops, _ = store(gone.groupBy("doc_id", "t").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")), "line-drops")
    return found.where("k1 IS NULL").select("doc_id", "t", "n_lines", "sha"), drops


def rest_of(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """Of the rows that lose lines: doc_id, t, n_dropped, text that stays, its digest."""
    wanted = drops.select(F.col("doc_id").alias("wanted"), "t", "at")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.join(wanted, rows.doc_id == wanted.wanted).select("doc_id", "t", "at", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            out = []
            for doc, t, at, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "t", "at", "text"))):
                if xxhash.xxh3_64_intdigest((text or "").encode()) - (1 << 63) == t:
                    at = set(at)
                    kept = "\n".join(line for i, line in enumerate((text or "").split("\n")) if i not in at)
                    out.append((doc, t, len(at), kept, hashlib.sha256(kept.encode()).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "t", "n_dropped", "kept_text", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, t long, n_dropped long, kept_text string, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped, kept_sha256."""
    rows, drops = decided(docs)
    rest = rest_of(docs, drops).drop("kept_text").dropDuplicates(["doc_id", "t"])
    out = rows.join(rest, ["doc_id", "t"], "left")
    return out.select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(documents(spark, sf_dir))


ORACLE = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
d AS (SELECT k.*, coalesce(r.least <> k.doc_id, false) AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id
"""
