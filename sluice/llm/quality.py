"""Quality scores by random-indexing word vectors and a network of two layers.

1. Each word has a sparse index vector: `ONES` places of `SIZE`, drawn by its hash, are +1 or -1. The vector of a word is the sum of the
   index vectors of the words up to `WINDOW` places away, over every text of the corpus. Words are dealt over `SLOTS` rows by hash, so
   that the table has one size whatever the vocabulary; each task sums its own rows, which are added up by Spark. The sums are
   whole numbers, so their order is nothing to the result. What all rows have in common is taken off, each is scaled to length one.
2. A document is the mean and the spread of the vectors of its words: each dimension's mean and standard deviation.
3. A network with one hidden layer of `HIDDEN` gives a logit. It is fitted on labelled documents, at most `SAMPLE_ROWS`, those
   with the smallest hash of their id; a fifth of these, by hash of the text, is kept back to calibrate: the logits are divided
   by the temperature that makes the labels likeliest there.

Words are runs of letters and digits or of other signs, in lower case; whole texts are read. A null or empty text has no word: all its
pooled values are zero, and its score is what the network gives for that. Labels that are null count for nothing, of several labels
of an id the largest counts, labels of unknown ids too little. Without labels of both kinds every score is the share of label 1,
0 without any. Repeated rows and rows with a null id are scored alike; extra columns stay; an empty table gives an empty result.
A very long text is pooled `CHUNK` words at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches, smallest_hashes, stored, words_of
from sluice.llm.fitting import minimised
from sluice.llm.perfect_hash import mixed

SIZE, ONES, WINDOW, SLOTS = 64, 4, 2, 1 << 14
HIDDEN, SAMPLE_ROWS, FOLDS = 24, 20_000, 5
CHUNK = 1 << 16


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each different word, the number of the word at each place, and where each text ends."""
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    words, ends = words_of(pc.replace_substring_regex(texts, r"([^\pL\pM\pN\s]+)", r" \1 "))
    hashes = np.fromiter((zlib.crc32(w.encode()) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return hashes, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, 0) % np.uint64(SLOTS)).astype(np.int64)


# ---------------------------------------------------------------- word vectors


def contexts(docs: DataFrame, text: str = "text") -> DataFrame:
    """slot, v0, v1, ...: the sums of the index vectors of all neighbours of the words in a slot."""
    names = [f"v{k}" for k in range(SIZE)]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(SLOTS * SIZE, np.int64)
        for batch in batches:
            _add_contexts(table, *tokens(batch.column(0)))
        rows = table.reshape(SLOTS, SIZE)
        used = np.flatnonzero(rows.any(1))
        for some in np.array_split(used, -(-len(used) // 2048) or 1):
            columns = [pa.array(some), *(pa.array(np.ascontiguousarray(c)) for c in rows[some].T)]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", *names])

    schema = ", ".join(f"{n} long" for n in ["slot", *names])
    return docs.select(text).mapInArrow(summed, schema).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names])


def _add_contexts(table: np.ndarray, hashes: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> None:
    first = (_slots(hashes) * SIZE)[codes]
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    draws = [mixed(hashes, 1 + j) for j in range(ONES)]
    at = [((x >> np.uint64(8)) % np.uint64(SIZE)).astype(np.int64)[codes] for x in draws]
    sign = [((x & np.uint64(1)).astype(np.int64) * 2 - 1)[codes] for x in draws]
    for k in range(1, WINDOW + 1):
        near = np.flatnonzero(doc[:-k] == doc[k:])
        for word, other in ((near, near + k), (near + k, near)):
            for place, one in zip(at, sign):
                np.add.at(table, first[word] + place[other], one[other])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A row for each slot. `SLOTS` rows come to the driver, whatever the corpus."""
    bounded_batches(docs.sparkSession)
    found = contexts(docs, text).toArrow()
    out = np.zeros((SLOTS, SIZE))
    out[found["slot"].to_numpy()] = np.column_stack([found[f"v{k}"].to_numpy() for k in range(SIZE)])
    used = out.any(1)
    out[used] = _unit(out[used])
    if used.any():
        out[used] = _unit(out[used] - out[used].mean(0))
    return out.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row for each text: means, then standard deviations, over its words."""
    hashes, codes, ends = tokens(texts)
    slots = _slots(hashes)[codes]
    out, begin = np.zeros((len(ends), 2 * SIZE)), 0
    for row, end in zip(out, ends.tolist()):
        total, squares = np.zeros(SIZE), np.zeros(SIZE)
        for at in range(begin, end, CHUNK):
            some = vectors[slots[at : min(end, at + CHUNK)]]
            total += some.sum(0, dtype=np.float64)
            squares += np.einsum("ij,ij->j", some, some, dtype=np.float64)
        if end > begin:
            mean = total / (end - begin)
            row[:SIZE] = mean
            row[SIZE:] = np.sqrt(np.maximum(squares / (end - begin) - mean * mean, 0))
        begin = end
    return out


# ---------------------------------------------------------------- network


@dataclass(frozen=True)
class Network:
    """Weights of two layers over scaled values, and a temperature. `constant` instead, where there was nothing to learn."""

    mean: np.ndarray
    spread: np.ndarray
    hidden: np.ndarray
    last: np.ndarray
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.spread
        return _with_one(np.tanh(_with_one(x) @ self.hidden)) @ self.last

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.constant) if self.constant is not None else _logistic(self.logits(x) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray, fold: np.ndarray, penalty: float = 1.0, steps: int = 200) -> Network:
    """Fitted on the rows of all folds but the first, calibrated on the first."""
    kept_back = fold == 0
    if not len(y) or y.min() == y.max():
        nothing = np.zeros(0)
        return Network(nothing, nothing, nothing, nothing, constant=float(y[0]) if len(y) else 0.0)
    if len(set(y[~kept_back])) < 2 or not kept_back.any():
        kept_back = np.zeros(len(y), bool)
    mean, spread = x[~kept_back].mean(0), x[~kept_back].std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    a, target = _with_one((x[~kept_back] - mean) / spread), y[~kept_back]
    shape = (a.shape[1], HIDDEN)
    rng = np.random.default_rng(HIDDEN)
    start = np.concatenate([rng.normal(0, 1 / np.sqrt(shape[0]), shape).ravel(), rng.normal(0, 0.1, HIDDEN + 1)])

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        hidden, last = w[: shape[0] * HIDDEN].reshape(shape), w[shape[0] * HIDDEN :]
        h = _with_one(np.tanh(a @ hidden))
        z = h @ last
        off = _logistic(z) - target
        back = np.outer(off, last[:-1]) * (1 - h[:, :-1] ** 2)
        value = (np.logaddexp(0, z) - target * z).sum() + penalty * (w @ w) / 2
        return value, np.concatenate([(a.T @ back).ravel(), h.T @ off]) + penalty * w

    w = minimised(loss, start, steps)
    network = Network(mean, spread, w[: shape[0] * HIDDEN].reshape(shape), w[shape[0] * HIDDEN :])
    if not kept_back.any():
        return network
    return Network(network.mean, network.spread, network.hidden, network.last, temperature(network.logits(x[kept_back]), y[kept_back]))


def temperature(logits: np.ndarray, y: np.ndarray, least: float = 0.05, most: float = 20.0) -> float:
    """What logits are divided by so that the labels are likeliest, with a weak pull towards 1, as few labels may be told
    apart without fault: by thirds of the interval of logarithms."""
    a, b = np.log(least), np.log(most)

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        return float((np.logaddexp(0, z) - y * z).sum() + t * t)

    for _ in range(60):
        c, d = a + (b - a) / 3, b - (b - a) / 3
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ---------------------------------------------------------------- documents


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network

    def column(self, text: Column) -> Column:
        """The score of a text: how likely its label is 1."""

        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return pa.array(self.network.scores(pooled(texts, self.vectors)), pa.float64())

        return scored(text)


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Word vectors of all texts of `docs`, and a network fitted on those that `labels` (doc_id and a column of 0 and 1) knows."""
    bounded_batches(docs.sparkSession)
    vectors = word_vectors(docs, text)
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).dropna()
    known = smallest_hashes(stored(known.groupBy("id").agg(F.max("y").alias("y"))), "id", sample_rows)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(known), "id")  # at most `sample_rows` short rows

    @F.arrow_udf("binary")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in pooled(texts, vectors)], pa.binary())

    rows = rows.select("id", "y", F.xxhash64("text").alias("hash"), features("text").alias("x"))
    found = rows.orderBy(F.xxhash64("id"), "id", "hash").limit(sample_rows).toArrow()
    x = np.array([np.frombuffer(v) for v in found["x"].to_pylist()]).reshape(found.num_rows, 2 * SIZE)
    fold = found["hash"].to_numpy() % FOLDS
    return Model(vectors, fit_network(x, found["y"].to_numpy().astype(np.float64), fold))
