"""Join of documents by the Jaccard similarity of their word n-grams, with signature trees; exact.

1. Every text is tokenised once: its set of 5-word shingles, hashed to 48 bits, is stored in packed form. Equal sets
   (128-bit signatures) become one node, so copies cost nothing further.
2. Nodes that share a minimum hash (one per quarter of the hash range) meet in units of bounded size. A unit builds a
   signature tree: leaves of a few sets, inner nodes with the OR of the token bitmaps, the range of set sizes and the most
   tokens that a bitmap hides. Tree and tree are traversed against each other; a pair of nodes is dropped when the greatest
   overlap that it allows is too small, or when all of its sets are in one component already. Leaves verify exactly.
   Links found here are a spanning forest, never all pairs of a group.
3. The same for every token of the sets' prefixes: in one fixed order of tokens, two sets of similarity t share one of
   their first n - ceil(t n) + 1 tokens. Postings travel packed, by ranges of keys (the leading bits of a token). Keys whose
   sets are all in one component are done. Keys that many nodes share (counted over all of them) are moved to the end of
   the order and the prefixes are taken again, so passages that many documents share hardly ever stay in a prefix. What is
   left, once for each different list of sets, goes through trees again, by bitmaps alone; pairs these allow are decided on
   the whole sets. This step is what makes the join exact: step 2 only shortens it. A list longer than a unit is cut into
   blocks and every pair of blocks is a unit.

Links are not needed pair by pair: components are, and each unit gives the links that connect what it sees.

Defined results: null, empty and blank texts have no set and link with nothing; texts with fewer words than n have one
shingle, the whole sequence; repeated rows and copies share a component; equal ids with different texts are separate rows
of which the component is found row by row; other columns are ignored, whatever their names; an empty table gives no rows.
one_of_each() and the stage keep one row of each component, the smallest doc_id (null first), then the first row; rows
without a set all stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexforge.llm.common import AT, FILE, configured, documents, drop, located, small, store, without_rows
from lexforge.llm.components import components
from lexforge.llm.packing import by_bytes

WORDS = 5
#: Sets, and tokens of all its sets, that one unit compares; larger groups are split.
UNIT = 1024
UNIT_TOKENS = 1 << 22
#: A key that so many nodes of different components hold in their prefixes is crowded, and moves to the end of the order.
CROWD = 64
#: Crowded keys that are broadcast (8 bytes each); if there are more, only keys with more nodes count as crowded.
MOST_CROWDED = 1 << 20
PASSES = 3
#: Prefixes are taken again if crowded keys hold more than this share of the postings found.
CROWDED_SHARE = 0.1
#: Postings that one part of the key range holds on average, and that a task gathers before it deals them out.
PART, CHUNK = 1 << 19, 1 << 21
#: Keys before its own that a prefix group's member brings along, so that a pair is given once where its prefixes run alike.
EARLY = 8
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: Rows of whole sets go to Python in batches of so many bytes.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}
SETS = f"doc_id long, row long, {FILE} long, {AT} long, size int, sig1 long, sig2 long, keys array<long>, lo binary, hi binary"
POSTINGS = "part int, base long, key binary, off binary, which binary, labels binary"
MEMBERS = "key long, node long, label long, many long"


@dataclass(frozen=True)
class Threshold:
    """100 * overlap >= percent * union."""

    percent: int = 75

    def linked(self, overlap, a, b):
        return (100 + self.percent) * overlap >= self.percent * (a + b)

    def prefix(self, n: int) -> int:
        return n + (-self.percent * n) // 100 + 1  # n - ceil(percent * n / 100) + 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(text: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text.cast(pa.large_string()), ""))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, np.int64)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
    coded = pc.dictionary_encode(flat.filter(pa.array(real)))
    known = np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    h = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.uint64)
    factors = np.resize(ODD, n) + np.arange(n, dtype=np.uint64) * np.uint64(2)
    m = max(len(h) - n + 1, 0)
    rolled = np.zeros(m, np.uint64)
    for i in range(n):
        rolled += h[i : i + m] * factors[i]
    rolled = mixed(rolled)
    out = []
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if z - a >= n:
            out.append(np.unique(rolled[a : z - n + 1]))
        elif z > a:
            out.append(mixed((h[a:z] * factors[: z - a]).sum(keepdims=True) + np.uint64(z - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> tuple[int, int]:
    return int(s.sum().view(np.int64)), int(mixed(s ^ ODD[1]).sum().view(np.int64))


def least_hashes(s: np.ndarray) -> np.ndarray:
    """The least hash of each quarter of the range that has one."""
    first = np.searchsorted(s, np.arange(4, dtype=np.uint64) << np.uint64(62))
    first = first[first < len(s)]
    return np.unique(s[first])


def width_of(n: int) -> int:
    """Bits of the bitmap of a set of n tokens: two for each, a power of two. Sets that may link differ by a factor of two at most."""
    return 1 << int(np.clip(np.ceil(np.log2(max(2 * n, 1))), 8, 20))


def bitmap(s: np.ndarray, width: int = 0) -> bytes:
    width = width or width_of(len(s))
    bits = np.zeros(width, bool)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32()), pa.array(flat.view(np.int64)))


def packed(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Sorted 64-bit hashes, cut to 48 bits: the low 32 bits of each, and the steps of its high 16."""
    flat = (np.concatenate(sets) if sets else np.zeros(0, np.uint64)) >> np.uint64(16)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    high = (flat >> np.uint64(32)).astype("<u2")
    step = np.diff(high, prepend=high[:1])
    first = bounds[:-1][np.diff(bounds) > 0]
    step[first] = high[first]

    def column(values: np.ndarray) -> pa.Array:
        where = (bounds * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer(where.tobytes()), pa.py_buffer(values.tobytes())])

    return column((flat & np.uint64(0xFFFFFFFF)).astype("<u4")), column(step)


def _bytes(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column as one array, and where each row's begin (one more at the end)."""
    _, where, data = column.buffers()
    at = np.frombuffer(where, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    values = np.frombuffer(data, kind, (at[-1] - at[0]) // size, at[0]) if data is not None and at[-1] > at[0] else np.zeros(0, kind)
    return values, (at - at[0]) // size


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a batch's sets (lo, hi), and where each set begins (one more at the end)."""
    low, bounds = _bytes(batch.column("lo"), "<u4")
    step, _ = _bytes(batch.column("hi"), "<u2")
    upto = np.cumsum(step, dtype=np.int64)
    many = np.diff(bounds)
    first = bounds[:-1][many > 0]
    high = upto - np.repeat(upto[first] - step[first], many[many > 0])
    return (high.astype(np.uint64) << np.uint64(32)) | low, bounds


def described(docs: DataFrame, n: int) -> DataFrame:
    """By row of docs (located): doc_id, row, place, size, signature, least hashes, packed set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in by_bytes(batch):
                sets = shingle_sets(b.column("text"), n)
                sig = [signature(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in ("doc_id", "row", FILE, AT)), pa.array([len(s) for s in sets], pa.int32()), pa.array([x for x, _ in sig], pa.int64()), pa.array([x for _, x in sig], pa.int64()), _lists([least_hashes(s) for s in sets]), *packed(sets)],
                    [x.split()[0] for x in SETS.split(", ")],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("row"), FILE, AT)
    return rows.mapInArrow(run, SETS)


def sets_with(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The packed sets of the given nodes (a stored table: node and more)."""
    return sets.select(F.col("row").alias("node"), "lo", "hi").join(small(nodes), "node")


class Deal:
    """Postings on their way: gathered by task, sorted by key, and dealt out by part of the key range."""

    def __init__(self, crowd: int):
        self.crowd, self.keys, self.nodes, self.labels, self.held = crowd, [], [], [], 0

    def add(self, keys: np.ndarray, node: int, label: int) -> None:
        self.keys.append(keys)
        self.nodes.append(node)
        self.labels.append(label)
        self.held += len(keys)

    def rows(self) -> pa.RecordBatch:
        """A row for each part; the keys of base -1 are crowded in this task's nodes already and need no postings."""
        many = [len(k) for k in self.keys]
        keys, node, label = np.concatenate([np.zeros(0, np.uint64), *self.keys]), np.repeat(np.array(self.nodes, np.int64), many), np.repeat(np.array(self.labels, np.int64), many)
        order = np.argsort(keys, kind="stable")
        keys, node, label = keys[order], node[order], label[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (node[1:] != node[:-1])
        keys, node, label = keys[new], node[new], label[new]
        out: list[tuple] = []
        if self.crowd and len(keys):
            first, size = runs(keys)
            hot = (size >= self.crowd) & (np.minimum.reduceat(label, first) < np.maximum.reduceat(label, first))
            told = keys[first[hot]]
            for at, n in zip(*runs(told >> np.uint64(32))):
                out.append((int(told[at] >> np.uint64(32)), -1, told[at : at + n].astype("<u4").tobytes(), b"", b"", b""))
            stay = np.repeat(~hot, size)
            keys, node, label = keys[stay], node[stay], label[stay]
        for at, n in zip(*runs(keys >> np.uint64(32))):
            z = slice(at, at + n)
            base = int(node[z].min())
            off = node[z] - base
            far = int(off.max())
            other = label[z] != node[z]
            names, which = np.unique(label[z][other], return_inverse=True)
            index = np.zeros(n, "<u4")  # 0: the node's component is its own
            index[other] = which + 1
            out.append((int(keys[at] >> np.uint64(32)), base, keys[z].astype("<u4").tobytes(), off.astype("<u2" if far < 1 << 16 else "<u4" if far < 1 << 32 else "<i8").tobytes(), index.astype("<u2" if len(names) < 65535 else "<u4").tobytes(), names.tobytes()))
        self.keys, self.nodes, self.labels, self.held = [], [], [], 0
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        columns = zip(*out) if out else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in POSTINGS.split(", ")])


def runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and its length."""
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(sorted_)))


def prefix_keys(batch: pa.RecordBatch, crowded: np.ndarray, bits: int, threshold: Threshold) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By set of a batch (node, lo, hi): its place, the prefix's keys that are not crowded, those that are.

    A key is a token's leading 32 + bits bits; crowded keys stand after all others.
    """
    flat, bounds = unpacked(batch)
    keys = flat >> np.uint64(16 - bits)
    often = np.zeros(len(keys), bool)
    if len(crowded):
        often = crowded[np.minimum(np.searchsorted(crowded, keys), len(crowded) - 1)] == keys
    for i, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        p, mark = threshold.prefix(z - a), often[a:z]
        if not mark.any():
            yield i, keys[a : a + p], keys[:0]
        else:
            own = keys[a:z]
            rare = own[~mark][:p]
            yield i, rare, own[mark][: p - len(rare)]


def postings(sets: DataFrame, crowded, bits: int, threshold: Threshold, crowd: int) -> DataFrame:
    """The prefixes' keys that are not crowded, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = Deal(crowd)
        for batch in batches:
            nodes, labels = batch.column("node").to_pylist(), batch.column("label").to_pylist()
            for i, rare, _ in prefix_keys(batch, crowded.value, bits, threshold):
                deal.add(rare, nodes[i], labels[i])
                if deal.held >= CHUNK:
                    yield deal.rows()
        yield deal.rows()

    return sets.mapInArrow(run, POSTINGS)


def opened(dealt: DataFrame, parts: int) -> DataFrame:
    """Of each part: the postings of keys that nodes of different components share. Keys that a task told of have no node, and `many` 0.

    A part holds postings of a few bytes; a key has at most crowd - 1 of them from each gathering task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def solve() -> Iterator[pa.RecordBatch]:
            told, keys, node, label = [np.zeros(0, "<u4")], [], [], []
            for base, key, off, which, names in held:
                k = np.frombuffer(key, "<u4")
                if base < 0:
                    told.append(k)
                    continue
                n = base + np.frombuffer(off, {2: "<u2", 4: "<u4", 8: "<i8"}[len(off) // len(k)]).astype(np.int64)
                at = np.frombuffer(which, {2: "<u2", 4: "<u4"}[len(which) // len(k)]).astype(np.int64)
                keys.append(k)
                node.append(n)
                label.append(np.where(at > 0, np.append(np.frombuffer(names, np.int64), 0)[at - 1], n))
            told_ = np.unique(np.concatenate(told))
            high = np.int64(part or 0) << 32
            if keys:
                k, n, l = np.concatenate(keys), np.concatenate(node), np.concatenate(label)
                order = np.argsort(k, kind="stable")
                k, n, l = k[order], n[order], l[order]
                first, size = runs(k)
                stay = np.repeat((np.minimum.reduceat(l, first) < np.maximum.reduceat(l, first)) & ~np.isin(k[first], told_), size)
                if stay.any():
                    yield pa.RecordBatch.from_arrays([pa.array(k[stay].astype(np.int64) + high), pa.array(n[stay]), pa.array(l[stay]), pa.array(np.repeat(size, size)[stay].astype(np.int64))], ["key", "node", "label", "many"])
            if len(told_):
                none = pa.nulls(len(told_), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(told_.astype(np.int64) + high), none, none, pa.array(np.zeros(len(told_), np.int64))], ["key", "node", "label", "many"])

        for batch in batches:
            for p, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "base", "key", "off", "which", "labels"))):
                if p != part:
                    yield from solve()
                    part, held = p, []
                held.append(row)
        yield from solve()

    return dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, MEMBERS)


def crowded_members(sets: DataFrame, crowded, bits: int, threshold: Threshold) -> DataFrame:
    """key, node, label of crowded keys that still stand in a prefix: only sets that are nearly all of such keys have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, often) for i, _, often in prefix_keys(batch, crowded.value, bits, threshold) if len(often)]
            at = np.repeat(np.array([i for i, _ in found], np.int64), [len(k) for _, k in found])
            key = np.concatenate([np.zeros(0, np.uint64), *(k for _, k in found)]).astype(np.int64) + (np.int64(1) << (32 + bits))
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("node").take(pa.array(at)), batch.column("label").take(pa.array(at))], ["key", "node", "label"])

    return sets.mapInArrow(run, "key long, node long, label long").distinct()


def prefix_members(sets: DataFrame, labelled: DataFrame, tokens: int, threshold: Threshold, parts: int) -> tuple[DataFrame, str]:
    """key, node, label: the prefix keys that nodes of different components share; its stored path. tokens: of all sets."""
    spark = sets.sparkSession
    bits = int(np.clip(np.ceil(np.log2(max(tokens * (100 - threshold.percent) / 100 / PART, 1))), 2, 16))
    ours, crowd = sets_with(sets, labelled), CROWD
    crowded = np.zeros(0, np.uint64)
    for turn in range(PASSES):
        last = turn == PASSES - 1
        shared = spark.sparkContext.broadcast(crowded)
        found, path = store(opened(postings(ours, shared, bits, threshold, 0 if last else crowd), parts), "ngram-open")
        hot = found.where((F.col("many") >= crowd) | (F.col("many") == 0))
        # By powers of two of their nodes: keys, postings. Keys that tasks told of count as the largest.
        sizes = {r.p: (r.keys, r.rows) for r in hot.groupBy(F.when(F.col("many") > 0, F.floor(F.log2("many"))).otherwise(63).alias("p")).agg(F.count_distinct("key").alias("keys"), F.count("*").alias("rows")).collect()}
        if last or 63 not in sizes and sum(n for _, n in sizes.values()) <= CROWDED_SHARE * found.count():
            break
        room, least = MOST_CROWDED - len(crowded), 0
        while least < 63 and sum(n for p, (n, _) in sizes.items() if p >= least) > room:
            least += 1
        crowd = max(crowd, 1 << least)
        new = hot.where((F.col("many") >= crowd) | (F.col("many") == 0)).select("key").distinct().toArrow()["key"].to_numpy()  # at most MOST_CROWDED keys
        crowded = np.unique(np.concatenate([crowded, new.astype(np.uint64)]))
        drop(path)
        shared.unpersist()
    members = found.where("node IS NOT NULL").select("key", "node", "label")
    if len(crowded):
        late, late_path = store(crowded_members(ours, shared, bits, threshold), "ngram-crowded")
        mixed_ = late.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("z")).where("a <> z").select("key")
        mixed_, mixed_path = store(mixed_, "ngram-mixed")
        members, both = store(members.unionByName(late.join(small(mixed_), "key")), "ngram-members")
        drop(path, late_path, mixed_path)
        path = both
    return members, path


class SignatureTree:
    """Sets, given by size and bitmap, in leaves of LEAF, FAN children to an inner node; levels[0] are the leaves.

    All bitmaps have one width, a power of two; a bit is set for each token modulo the width.
    """

    LEAF, FAN = 8, 4

    def __init__(self, size: np.ndarray, bits: np.ndarray, near: list):
        """near: a key that brings similar sets next to each other."""
        self.order = sorted(range(len(size)), key=lambda i: (near[i], int(size[i])))
        self.size, self.bits = size[self.order], bits[self.order]
        self.hidden = self.size - np.bitwise_count(self.bits).sum(1, dtype=np.int64)
        self.levels = []  # each: first set of every node, bitmaps, most hidden tokens, least and greatest size
        at, step = np.arange(0, len(size), self.LEAF), self.LEAF
        bitmap, hidden, low, high = self.bits, self.hidden, self.size, self.size
        while True:
            cut = np.arange(0, len(bitmap), step)
            bitmap, hidden = np.bitwise_or.reduceat(bitmap, cut), np.maximum.reduceat(hidden, cut)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((at, bitmap, hidden, low, high))
            if len(at) == 1:
                break
            step = self.FAN
            at = at[:: self.FAN]

    def links(self, label: np.ndarray, threshold: Threshold, check=None, wanted=None) -> list[tuple[int, int]]:
        """Pairs (positions in the given sets) of different labels that may link and, if given, for which wanted(x, y).

        With check(x, y), which decides exactly: those that do link, each joining two labels, until no others are left.
        """
        label = label[self.order].copy()
        found = []
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            at, bitmap, hidden, low, high = self.levels[level]
            end = lambda k: at[k + 1] if k + 1 < len(at) else len(self.size)  # noqa: E731, B023
            xs, ys = slice(at[i], end(i)), slice(at[j], end(j))
            first = label[xs.start]
            if (label[xs] == first).all() and (label[ys] == first).all():
                continue
            if i != j:
                most = min(int(np.bitwise_count(bitmap[i] & bitmap[j]).sum(dtype=np.int64)) + min(hidden[i], hidden[j]), high[i], high[j])
                if not threshold.linked(most, low[i], low[j]):
                    continue
            if level:
                step = self.FAN
                many = len(self.levels[level - 1][0])
                left = range(i * step, min((i + 1) * step, many))
                right = range(j * step, min((j + 1) * step, many))
                stack += [(level - 1, a, b) for a in left for b in right if i != j or a <= b]
                continue
            both = np.bitwise_count(self.bits[xs][:, None] & self.bits[ys][None]).sum(2, dtype=np.int64) + np.minimum(self.hidden[xs][:, None], self.hidden[ys][None])
            a, b = self.size[xs][:, None], self.size[ys][None]
            may = threshold.linked(np.minimum(both, np.minimum(a, b)), a, b)
            for x, y in zip(*np.nonzero(may)):
                x, y = int(x) + xs.start, int(y) + ys.start
                if label[x] == label[y] or (i == j and x >= y):
                    continue
                if wanted and not wanted(self.order[x], self.order[y]):
                    continue
                if check is None:
                    found.append((self.order[x], self.order[y]))
                elif check(self.order[x], self.order[y]):
                    found.append((self.order[x], self.order[y]))
                    label[label == label[y]] = label[x]
        return found


def exact_links(sets: list[np.ndarray], label: np.ndarray, threshold: Threshold) -> list[tuple[int, int]]:
    """Links between the given sets that connect all that link."""
    size = np.array([len(s) for s in sets], np.int64)
    width = min(width_of(int(size.max())), 1 << 16)
    bits = np.stack([np.frombuffer(bitmap(s, width), np.uint64) for s in sets])
    check = lambda x, y: threshold.linked(len(np.intersect1d(sets[x], sets[y], assume_unique=True)), size[x], size[y])
    return SignatureTree(size, bits, [int(s[0]) for s in sets]).links(label, threshold, check)


def possible_links(sizes: list[int], bitmaps: list[bytes], label: np.ndarray, threshold: Threshold, wanted=None) -> set[tuple[int, int]]:
    """Pairs of different labels, wanted if that is given, that their bitmaps allow to link. Each width is joined with itself and, folded, the next one."""
    size, width, out = np.array(sizes, np.int64), np.array([8 * len(b) for b in bitmaps]), set()
    for w in np.unique(width):
        some = np.flatnonzero((width == w) | (width == 2 * w))
        if len(set(label[some].tolist())) > 1:
            rows = [np.frombuffer(bitmaps[i], np.uint64) for i in some]
            half = int(w) // 64
            bits = np.stack([r if len(r) == half else r[:half] | r[half:] for r in rows])
            exact = width[some] == w  # two sets of the doubled width meet unfolded, in their own round
            here = lambda x, y, some=some, exact=exact: (exact[x] or exact[y]) and (wanted is None or wanted(some[x], some[y]))
            pairs = SignatureTree(size[some], bits, [int(b[0]) for b in bits]).links(label[some], threshold, wanted=here)
            out |= {(int(some[x]), int(some[y])) for x, y in pairs}
    return out


def folded(bits: int, width: int) -> int:
    """A bitmap of any width, cut into pieces of the given one that are laid over each other."""
    out = 0
    while bits:
        out |= bits & ((1 << width) - 1)
        bits >>= width
    return out


def possible(sizes: list[int], bitmaps: list[bytes], label: np.ndarray, threshold: Threshold, wanted) -> list[tuple[int, int]]:
    """possible_links() for a handful of sets, a single leaf: each pair directly."""
    out, bits = [], [int.from_bytes(b, "little") for b in bitmaps]
    for y in range(len(sizes)):
        for x in range(y):
            a, b = sizes[x], sizes[y]
            if label[x] == label[y] or not threshold.linked(min(a, b), a, b) or not wanted(x, y):
                continue
            one, two, width = bits[x], bits[y], 8 * min(len(bitmaps[x]), len(bitmaps[y]))
            if len(bitmaps[x]) != len(bitmaps[y]):
                one, two = folded(one, width), folded(two, width)
            most = (one & two).bit_count() + min(a - one.bit_count(), b - two.bit_count())
            if threshold.linked(min(most, a, b), a, b):
                out.append((x, y))
    return out


def unit_candidates(units: DataFrame, threshold: Threshold, parts: int) -> DataFrame:
    """units: unit, block, lone, early, node, label, size, bits. u < v: pairs of different labels that may link, from the trees of each unit.

    A pair is given where it meets first, not in every unit that holds it: not between two nodes of one block in a unit
    of two blocks (not `lone`), and not where both nodes hold a common key among their `early` ones, those just before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, found = None, [], set()

        def solve() -> None:
            if len({row[1] for row in held}) < 2:
                return
            nodes, labels, sizes, bits, blocks, lone, early = zip(*held)
            early = [frozenset(e) for e in early]
            first = lambda x, y: (lone[x] or blocks[x] != blocks[y]) and early[x].isdisjoint(early[y])
            of = possible if len(nodes) <= SignatureTree.LEAF else possible_links
            found.update((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])) for x, y in of(list(sizes), list(bits), np.array(labels, np.int64), threshold, first))

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["u", "v"])
            found.clear()
            return out

        for batch in batches:
            for u, *row in zip(*(batch.column(c).to_pylist() for c in ("unit", "node", "label", "size", "bits", "block", "lone", "early"))):
                if u != unit:
                    solve()
                    unit, held = u, []
                held.append(row)
            yield given()
        solve()
        yield given()

    return units.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(run, "u long, v long").distinct()


def bitmaps_of(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, size, bits of the given nodes (a stored table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = unpacked(batch)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(np.diff(bounds)), pa.array([bitmap(flat[a:z]) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())], ["node", "size", "bits"])

    return sets_with(sets, nodes).mapInArrow(run, "node long, size long, bits binary")


def unit_links(units: DataFrame, threshold: Threshold, parts: int) -> DataFrame:
    """units: unit, node, label, lo, hi. u, v: the links found in each unit between nodes of different labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(nodes: list[int], labels: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
            if len(set(labels)) < 2:
                return []
            if len(nodes) == 2:
                a, b = map(len, sets)
                linked = threshold.linked(min(a, b), a, b) and threshold.linked(len(np.intersect1d(*sets, assume_unique=True)), a, b)
                return [(nodes[0], nodes[1])] if linked else []
            return [(nodes[x], nodes[y]) for x, y in exact_links(sets, np.array(labels, np.int64), threshold)]

        unit, nodes, labels, sets = None, [], [], []
        for batch in batches:
            out = []
            flat, bounds = unpacked(batch)
            for k, (u, node, label) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("unit", "node", "label")))):
                if u != unit:
                    out += solve(nodes, labels, sets)
                    unit, nodes, labels, sets = u, [], [], []
                nodes.append(node)
                labels.append(label)
                sets.append(flat[bounds[k] : bounds[k + 1]])
            sets = [s.copy() for s in sets]  # else the whole batch stays in memory
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["u", "v"])
        out = solve(nodes, labels, sets)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["u", "v"])

    return units.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(run, "u long, v long")


def band(size: str, threshold: Threshold) -> Column:
    """Sets that link have sizes in one band or in neighbouring ones."""
    return F.floor(F.log(F.col(size).cast("double")) / (math.log(100 / threshold.percent) * (1 + 1e-9))).cast("int")


def once(members: DataFrame, threshold: Threshold) -> DataFrame:
    """members: key, node, label, size. One key for each different list of at least two nodes: key, many, first, tokens (the sum of sizes), bands (least and greatest label by band)."""
    parts = members.groupBy("key", band("size", threshold).alias("band")).agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("a"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("b"), F.min("node").alias("first"), F.sum("size").alias("tokens"))
    bands = F.map_from_entries(F.collect_list(F.struct("band", F.struct("lo", "hi"))))  # a few dozen bands, whatever the list
    lists = parts.groupBy("key").agg(F.sum("n").alias("many"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.min("first").alias("first"), F.sum("tokens").alias("tokens"), bands.alias("bands"))
    return lists.where("many > 1").groupBy("many", "a", "b").agg(F.min("key").alias("key"), F.min("first").alias("first"), F.max("tokens").alias("tokens"), F.min_by("bands", "key").alias("bands")).select("key", "many", "first", "tokens", "bands")


def matched(members: DataFrame, groups: DataFrame, threshold: Threshold) -> DataFrame:
    """members with their key's list, without nodes that no other of the list, of another component, has the size to link with."""
    out = members.join(groups, "key").withColumn("band", band("size", threshold))

    def other(step: int) -> Column:
        found = F.try_element_at("bands", F.col("band") + step)
        return F.coalesce((found["lo"] != F.col("label")) | (found["hi"] != F.col("label")), F.lit(False))

    return out.where(other(0) | other(1) | other(-1)).drop("bands", "band")


def without_sublists(members: DataFrame) -> DataFrame:
    """members: key, node, label, size. Drops keys all of whose nodes hold one and the same other key just before it.

    Such a key's list is part of that other key's list, so its pairs are compared there. The tokens of a passage that
    several documents share mostly have such lists: each document's prefix ends somewhere else in the passage.
    """
    before = members.withColumn("before", F.lag("key").over(Window.partitionBy("node").orderBy("key")))
    lists = before.groupBy("key").agg(F.min("before").alias("a"), F.max("before").alias("z"), F.count_if(F.col("before").isNull()).alias("first"))
    kept = lists.where("first > 0 OR a <> z").select("key")
    return members.join(kept, "key", "left_semi").select("key", "node", "label", "size")


def jaccard_classes(docs: DataFrame, n: int = WORDS, threshold: Threshold = Threshold(), unit: int = UNIT) -> DataFrame:
    """One row per row of docs: doc_id, row, FILE and AT (its place in located docs), root (null without a set), n_shingles, component_id."""
    spark = docs.sparkSession
    with configured(spark, BATCHES):
        return _classes(docs if FILE in docs.columns else located(docs), n, threshold, unit)


def _classes(docs: DataFrame, n: int, threshold: Threshold, unit: int) -> DataFrame:
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sets, sets_path = store(described(docs, n), "ngram-sets", "zstd")
    rows = sets.select("doc_id", "row", FILE, AT, "size", "sig1", "sig2")
    rows, _ = store(rows, "ngram-rows")
    nodes = sets.where("size > 0").groupBy("sig1", "sig2", "size").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.any_value("keys").alias("keys"))
    nodes, nodes_path = store(nodes.select("node", "least", "sig1", "sig2", "size", "keys"), "ngram-nodes")

    # Step 2: nodes with a common least hash.
    members = nodes.select("node", F.col("node").alias("label"), "size", F.explode("keys").alias("key"))
    groups, groups_path = store(once(members, threshold), "ngram-groups")
    cut = F.ceil(F.greatest(F.col("many") / unit, F.least("many", F.col("tokens") / UNIT_TOKENS)))
    placed = matched(members, groups, threshold).select("key", "node", F.pmod(F.xxhash64("node"), cut).alias("part"))
    leaders = groups.where(cut > 1).select("key", F.col("first").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)).alias("part"))
    units = placed.unionByName(leaders).distinct().select(F.xxhash64("key", "part").alias("unit"), "node", F.col("node").alias("label"))
    units, units_path = store(units, "ngram-units")
    edges, edges_path = store(unit_links(sets_with(sets, units), threshold, parts), "ngram-links")
    labels, labels_path = components(edges)
    drop(groups_path, units_path)

    # Step 3: every prefix token whose sets are not in one component yet.
    labelled, labelled_path = store(nodes.select("node", "size").join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("label"), "size"), "ngram-labels")
    tokens = nodes.agg(F.sum("size")).first()[0] or 0
    members, members_path = prefix_members(sets, labelled.drop("size"), tokens, threshold, parts)
    members, merged_path = store(without_sublists(members.join(small(labelled.select("node", "size")), "node")), "ngram-merged")
    groups, groups_path = store(once(members, threshold), "ngram-groups")
    blocks = F.ceil(F.col("many") / unit)
    early = F.collect_list("key").over(Window.partitionBy("node").orderBy("key").rowsBetween(-EARLY, -1))
    placed = matched(members, groups, threshold).withColumn("early", early).withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    units = placed.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "block", (F.col("block") == F.col("other")).alias("lone"), "early", "node", "label")
    units, units_path = store(units, "ngram-units")
    wanted, wanted_path = store(units.select("node").distinct(), "ngram-wanted")
    pairs, pairs_path = store(unit_candidates(units.join(bitmaps_of(sets, wanted), "node"), threshold, parts), "ngram-pairs")
    # What the bitmaps allow is decided on the sets: each pair is a unit.
    pairs = pairs.select(F.xxhash64("u", "v").alias("unit"), F.explode(F.array("u", "v")).alias("node"))
    pairs, ends_path = store(pairs.withColumn("label", F.col("node")), "ngram-ends")
    more, more_path = store(unit_links(sets_with(sets, pairs), threshold, parts), "ngram-links")
    drop(sets_path, members_path, merged_path, groups_path, units_path, wanted_path, pairs_path, ends_path, labelled_path)
    if not more.isEmpty():
        drop(labels_path)
        labels, labels_path = components(edges.unionByName(more))
    drop(edges_path, more_path)

    of = nodes.join(labels, "node", "left").select("sig1", "sig2", "least", F.coalesce("root", "node").alias("root"))
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of, _ = store(of.join(ids, "root").select("sig1", "sig2", "root", "component_id"), "ngram-classes")
    drop(nodes_path, labels_path)
    out = rows.join(of, ["sig1", "sig2"], "left")
    return out.select("doc_id", "row", FILE, AT, "root", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component (the smallest doc_id, null first, then the first row) and all rows without a set, with their columns."""
    docs = located(docs)
    found, path = store(jaccard_classes(docs).where("root IS NOT NULL"), "ngram-found")
    ours = found.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("stays"))
    gone, _ = store(found.join(ours, "root").where(F.col("row") != F.col("stays.row")).select(FILE, AT), "ngram-dropped")
    drop(path)
    return without_rows(docs, gone)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s),
t AS (SELECT doc_id, unnest(s) AS g FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n_shingles + y.n_shingles - o)),
r AS (WITH RECURSIVE reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b) SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT n.doc_id, n_shingles, component_id FROM n JOIN r ON r.a = n.doc_id
"""
