"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over the words of a text and their beginnings
(the first four and five letters, so that forms of a word never seen in training count as well); each later model also
sees the probabilities of the earlier categories. In training those are out-of-fold predictions, so a later model learns
from probabilities as wrong as they will be on new rows. The default chain is quality, then toxic (the two categories that
`labels` holds); any list of 0/1 label columns may be given.

Models are fitted on a bounded sample of labelled rows (`max_train_rows` and `max_train_words`, lowest hashes of doc_id
first) and at most `n_features` features a category; one task fits them on the sample's distinct words, and only the model
comes to the driver. Every row of the corpus is scored, over its whole text, a batch at a time: its words are looked up
once for each different word, and the weights of the features found are summed.

Defined results: a null or empty text has no words, so it gets the models' base rates; with no labelled rows at all (or
one class only) a category's probability is its smoothed base rate (0 without rows); repeated rows and ties are scored
row by row; columns of the input that clash with the output's names are left out of scores() and kept as they are by
filter_toxic(); an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexforge.llm.common import documents, drop, store
from lexforge.llm.packing import by_bytes

CHAIN = ("quality", "toxic")
#: Toxic rows are a tenth of the labelled ones, so probabilities of clean texts stay far below this.
THRESHOLD = 0.25
_SEEN = "__lf_words"
#: Kinds of features: whole words (0) and beginnings of so many letters, of longer words only.
BEGINNINGS = (0, 4, 5)


def words_of(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of a batch of texts; for every word of every text its row and its place among them."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(text.cast(pa.large_string()), "")), r"[^\p{L}]+")
    coded = pc.dictionary_encode(lists.flatten())
    at = coded.indices.to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets, np.int64)))
    real = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[at] if len(at) else np.zeros(0, bool)
    return coded.dictionary, rows[real], at[real]


def feature(words: pa.Array, kind: int) -> pa.Array:
    """The feature of this kind of each word; null if it has none."""
    if not kind:
        return words
    return pc.if_else(pc.greater(pc.utf8_length(words), kind), pc.utf8_slice_codeunits(words, 0, kind), pa.scalar(None, words.type))


@dataclass
class Chain:
    """Linear models: their features by kind, weights [feature, category], weights of earlier categories' probabilities, biases."""

    categories: list[str]
    features: list[pa.Array]
    weights: np.ndarray
    earlier: list[np.ndarray]
    bias: list[float]

    def scores(self, text: pa.Array) -> np.ndarray:
        """The probability of each category, in the chain's order, by row."""
        words, row, at = words_of(text)
        pairs, first, many = [np.zeros(0, np.int64)], 0, max(len(self.weights), 1)
        for kind, known in zip(BEGINNINGS, self.features):
            place = pc.fill_null(pc.index_in(feature(words, kind), value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
            hit = place[at]
            on = hit >= 0
            pairs.append(row[on] * many + (hit[on] + first))
            first += len(known)
        seen = np.unique(np.concatenate(pairs))  # a feature counts once a text
        row, on = seen // many, seen % many
        out = np.zeros((len(text), len(self.categories)))
        for k in range(len(self.categories)):
            z = self.bias[k] + np.bincount(row, weights=self.weights[on, k], minlength=len(text)) + out[:, :k] @ self.earlier[k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


@dataclass
class Entries:
    """Which of n features m rows have: one entry for each, as small integers."""

    row: np.ndarray
    feature: np.ndarray
    m: int
    n: int

    def of(self, chosen: np.ndarray) -> "Entries":
        """Of the chosen rows only (a mask), numbered anew."""
        on = chosen[self.row]
        return Entries((np.cumsum(chosen, dtype=np.int32) - 1)[self.row[on]], self.feature[on], int(chosen.sum()), self.n)


def _logistic(x: Entries, dense: np.ndarray, y: np.ndarray, rounds: int = 120, l2: float = 0.2) -> np.ndarray:
    """Weights [features, dense columns, bias] by full-batch gradient steps with per-coordinate scaling."""
    at, on, n, m = x.row, x.feature, x.n, x.m
    base = float(np.clip((y.sum() + 0.5) / (m + 1), 1e-4, 1 - 1e-4))
    w = np.zeros(n + dense.shape[1] + 1)
    w[-1] = np.log(base / (1 - base))
    scale = np.full(len(w), 1e-8)
    for _ in range(rounds):
        z = np.bincount(at, weights=w[on], minlength=m) + dense @ w[n:-1] + w[-1]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.concatenate([np.bincount(on, weights=g[at], minlength=n), dense.T @ g, [g.sum()]])
        grad[:-1] += l2 * w[:-1]
        scale += grad**2
        w -= 0.5 * grad / np.sqrt(scale)
    return w


@dataclass
class _Fitted:
    """A model over the features of the sample."""

    best: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, x: Entries, dense: np.ndarray) -> np.ndarray:
        w = np.zeros(x.n)
        w[self.best] = self.weights
        z = np.bincount(x.row, weights=w[x.feature], minlength=x.m) + dense @ self.earlier + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit_link(x: Entries, dense: np.ndarray, y: np.ndarray, n_features: int) -> _Fitted:
    """Choose the features that tell the classes apart best (z-score of the log odds), then fit on them."""
    if len(y) == 0 or y.min() == y.max():
        base = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-9
        return _Fitted(np.zeros(0, int), np.zeros(0), np.zeros(dense.shape[1]), float(np.log(base / (1 - base))))
    one, all_ = np.bincount(x.feature[(y > 0)[x.row]], minlength=x.n) + 0.5, np.bincount(x.feature, minlength=x.n) + 1.0
    zero = all_ - one
    n1, n0 = y.sum() + 1.0, len(y) - y.sum() + 1.0
    score = np.abs(np.log(one / n1) - np.log(zero / n0)) / np.sqrt(1 / one + 1 / zero)
    best = np.sort(np.argsort(-score, kind="stable")[:n_features])
    place = np.full(x.n, -1, np.int32)
    place[best] = np.arange(len(best))
    place = place[x.feature]
    on = place >= 0
    w = _logistic(Entries(x.row[on], place[on], x.m, len(best)), dense, y)
    k = len(best)
    return _Fitted(best, w[:k], w[k:-1], float(w[-1]))


def entries_of(words: pa.ListArray, min_rows: int) -> tuple[Entries, list[pa.Array]]:
    """The features, by kind, that at least min_rows rows have, and their entries."""
    coded = pc.dictionary_encode(words.flatten())
    m = len(words)
    at, row_of = coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(m, dtype=np.int32), np.diff(np.asarray(words.offsets, np.int64)))
    names, rows, features, first = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], 0
    for kind in BEGINNINGS:
        of = pc.dictionary_encode(feature(coded.dictionary, kind))
        place = pc.fill_null(of.indices, -1).to_numpy(zero_copy_only=False)[at].astype(np.int64)
        on = place >= 0
        pairs = place[on] * m + row_of[on]
        del place, on
        if kind:  # words of a row may begin alike
            pairs.sort()
            pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] if len(pairs) else pairs
        found = (pairs // max(m, 1)).astype(np.int32)
        often = np.bincount(found, minlength=len(of.dictionary)) >= min_rows
        stay = often[found]
        rows.append((pairs[stay] % max(m, 1)).astype(np.int32))
        features.append((np.cumsum(often, dtype=np.int32) - 1 + first)[found[stay]].astype(np.int32))
        del pairs, found, stay
        names.append(of.dictionary.filter(pa.array(often)))
        first += len(names[-1])
    return Entries(np.concatenate(rows), np.concatenate(features), m, first), names


def fit_rows(words: pa.ListArray, labels: dict[str, np.ndarray], chain: tuple[str, ...] = CHAIN, n_features: int = 1200, folds: int = 3, min_rows: int = 4) -> Chain:
    """Fit the chain on the distinct words of rows held in memory (the bounded sample)."""
    x, names = entries_of(words, min_rows)
    models, earlier, fold = [], np.zeros((x.m, 0)), np.arange(x.m) % folds
    for c in chain:
        y = np.asarray(labels[c], dtype=float)
        models.append(_fit_link(x, earlier, y, n_features))
        p = np.zeros(x.m)
        if c != chain[-1]:
            for k in range(folds):
                inn, out = fold != k, fold == k
                if out.any():
                    p[out] = _fit_link(x.of(inn), earlier[inn], y[inn], n_features).predict(x.of(out), earlier[out])
        earlier = np.column_stack([earlier, p])
    # Of all features of the sample only those that some model chose are kept.
    weights = np.zeros((x.n, len(chain)))
    for k, model in enumerate(models):
        weights[model.best, k] = model.weights
    used, start, kept = weights.any(1), 0, []
    for of in names:
        kept.append(of.filter(pa.array(used[start : start + len(of)], pa.bool_())))
        start += len(of)
    return Chain(list(chain), kept, weights[used], [model.earlier for model in models], [model.bias for model in models])


def fit(docs: DataFrame, labels: DataFrame, chain: tuple[str, ...] = CHAIN, max_train_rows: int = 10000, max_train_words: int = 8_000_000, n_features: int = 1200) -> Chain:
    """Fit on at most max_train_rows labelled rows of docs with at most max_train_words distinct words in all; the ids with the lowest hashes are taken, so reruns agree."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.expr(" AND ".join(f"`{c}` IN (0, 1)" for c in chain))).select("doc_id", *chain)
    ids, path = store(ids.orderBy(F.xxhash64("doc_id"), *ids.columns).limit(max_train_rows), "toxicity-ids")
    label_of = ids.select(F.col("doc_id").alias("__lf_id"), *(F.col(c).cast("double").alias(f"__lf_{c}") for c in chain))
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(label_of), F.col("doc_id") == F.col("__lf_id"))  # at most max_train_rows rows
    names = [f"__lf_{c}" for c in chain]

    def run(batches):
        for batch in batches:
            for b in by_bytes(batch):
                words, row, at = words_of(b.column("text"))
                seen = np.unique(row * max(len(words), 1) + at)
                row, at = np.divmod(seen, max(len(words), 1))
                upto = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))])
                own = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.take(pa.array(at)).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([b.column("h"), b.column("t"), pa.array(np.diff(upto)), own, *(b.column(c) for c in names)], ["h", "t", "n", "words", *names])

    shape = "h long, t long, n long, words array<string>, " + ", ".join(f"{c} double" for c in names)
    rows = rows.select(F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "text", *names).mapInArrow(run, shape)
    rows = rows.orderBy("h", "t").limit(max_train_rows)  # docs may repeat ids
    rows, rows_path = store(rows, "toxicity-rows")
    upto = F.sum("n").over(Window.orderBy("h", "t").rowsBetween(Window.unboundedPreceding, 0))  # a window over the bounded sample
    sample = rows.withColumn("upto", upto).where(F.col("upto") <= max_train_words).select("words", *names)

    def train(batches):  # in the window's one task: the bounded sample never comes to the driver
        got = pa.Table.from_batches(batches, pa.schema([("words", pa.list_(pa.string())), *((c, pa.float64()) for c in names)])).combine_chunks()
        model = fit_rows(_joined(got["words"]), {c: got[f"__lf_{c}"].to_numpy() for c in chain}, chain, n_features)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = sample.mapInArrow(train, "model binary").first()
    drop(path, rows_path)
    if found is not None:
        return pickle.loads(bytes(found.model))
    return fit_rows(pa.array([], pa.list_(pa.string())), {c: np.zeros(0) for c in chain}, chain, n_features)


def _joined(column: pa.ChunkedArray) -> pa.ListArray:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def with_probabilities(spark: SparkSession, model: Chain) -> "Column":
    """An Arrow UDF of the text: an array with one probability for each category."""
    shared = spark.sparkContext.broadcast(model)  # n_features features a category at most

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def probabilities(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        p = np.concatenate([np.zeros((0, len(shared.value.categories))), *(shared.value.scores(b.column("text")) for b in by_bytes(batch))])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))

    return probabilities


def scores(docs: DataFrame, model: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the chain's probabilities, the last category as a flag, kept (its contrary)."""
    p = with_probabilities(docs.sparkSession, model)
    names = model.categories
    out = docs.select("doc_id", p("text").alias(_SEEN))
    cols = [F.col(_SEEN)[i].alias(f"{c}_prob") for i, c in enumerate(names)]
    last = F.col(_SEEN)[len(names) - 1] >= threshold
    return out.select("doc_id", *cols, last.alias(names[-1]), (~last).alias("kept"))


def filter_toxic(docs: DataFrame, model: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with their columns, that the chain's last category does not reject."""
    p = with_probabilities(docs.sparkSession, model)
    k = len(model.categories) - 1
    return docs.withColumn(_SEEN, p("text")).where(F.col(_SEEN)[k] < threshold).select(*docs.columns)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scores(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
