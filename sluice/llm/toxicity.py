"""Toxicity by classifier chains.

The categories are columns of a table of labels. They are predicted one after the other: the linear model of a category
sees a document's features and the probabilities of all earlier categories. In training these are out-of-fold predictions,
as the later model will meet at prediction: each comes from a model that has not seen the document, nor an exact copy of it.

Features are the distinct words of a text (runs of letters, lower case) and their first 4, 5 and 6 letters, so that a stem
is known whatever its ending, and the shares of some kinds of bytes. Of the words and stems those that tell a category
best (chi-square over the sample) are kept, at most `FEATURES` for each category.

The models are fitted on a bounded sample: at most `SAMPLE_ROWS` labelled rows, those with the smallest hash of their id.
Every text is scored whole. A null or empty text has no word and is scored by its shares, all zero. Rows of `labels`
with a null count for nothing, of several labels of one id the largest counts, ids without a document are ignored. A
category of which the sample lacks one of the two values is predicted as that constant; with no labels at all every
probability is 0. Repeated rows and extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches, smallest_hashes, stored, whole_row
from sluice.llm.fitting import minimised

SAMPLE_ROWS, FEATURES, LEAST_CHI, LEAST_DOCUMENTS, FOLDS = 20_000, 600, 15.0, 4, 3
#: Of held-out rows, 0.3 finds a few more toxic ones than 0.5 and rejects no clean one.
THRESHOLD = 0.3
CHUNK = 250  # texts whose words are held at once
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
#: Kinds of bytes whose shares are features.
_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b" ", b"\n", bytes(range(128, 256))]
_KIND = np.zeros((256, len(_KINDS)), np.float64)
for _k, _bytes in enumerate(_KINDS):
    _KIND[list(_bytes), _k] = 1


def words_and_stems(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    found = set(words)
    for n in STEMS:
        found.update(f"{w[:n]}-" for w in words if len(w) > n)
    return found


def shares(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return np.bincount(data, minlength=256) @ _KIND / max(1, len(data))


@dataclass(frozen=True)
class Chain:
    """Fitted models. `weights[j]` has the words' and stems' weights, the shares', those of earlier categories, a bias."""

    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    mean: np.ndarray
    spread: np.ndarray
    weights: tuple[np.ndarray, ...]

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        """A row for each text, a column for each category."""
        x = np.zeros((len(texts), len(self.vocabulary) + len(self.mean)), np.float32)
        known = self.vocabulary.keys()
        for row, text in zip(x, texts):
            row[[self.vocabulary[f] for f in words_and_stems(text) & known]] = 1
            row[len(self.vocabulary) :] = (shares(text) - self.mean) / self.spread
        for w in self.weights:
            x = np.column_stack([x, _logistic(x @ w[:-1] + w[-1])])
        return x[:, x.shape[1] - len(self.weights) :]

    def column(self, text: Column) -> Column:
        """A struct of the probabilities, named as the categories."""

        @F.pandas_udf(", ".join(f"`{c}` double" for c in self.categories))
        def scored(texts: pd.Series) -> pd.DataFrame:
            chunks = [self.probabilities(texts.iloc[i : i + CHUNK].tolist()) for i in range(0, len(texts), CHUNK)]
            return pd.DataFrame(np.concatenate([np.zeros((0, len(self.categories))), *chunks]), columns=list(self.categories))

        return scored(text)


def fit(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], text: str = "text", doc_id: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS, features: int = FEATURES, folds: int = FOLDS,
) -> Chain:
    """The chain over `categories`, columns of `labels` (with doc_id) that hold 0 and 1, in this order."""
    bounded_batches(docs.sparkSession)
    sample = _sample(docs, labels, categories, text, doc_id, sample_rows)
    vocabulary = _vocabulary(sample, len(categories), features)
    marks, dense, y, fold = _matrix(sample, vocabulary, len(categories), sample_rows, folds)
    mean, spread = (dense.mean(0), dense.std(0)) if len(dense) else (np.zeros(len(_KINDS)), np.ones(len(_KINDS)))
    spread = np.where(spread > 0, spread, 1.0)
    # One matrix for all models: words and stems, shares, then a column for each earlier category.
    own = len(vocabulary) + len(mean)
    x = np.zeros((len(y), own + len(categories) - 1), np.float32)
    for row, ids in zip(x, marks):
        row[ids] = 1
    x[:, len(vocabulary) : own] = (dense - mean) / spread
    weights = []
    for j in range(len(categories)):
        seen = x[:, : own + j]
        weights.append(_fit_one(seen, y[:, j], np.ones(len(y), bool)))
        for f in range(folds) if j + 1 < len(categories) else ():
            w = _fit_one(seen, y[:, j], fold != f)
            x[fold == f, own + j] = _logistic(seen[fold == f] @ w[:-1] + w[-1])
    return Chain(tuple(categories), vocabulary, mean, spread, tuple(weights))


def scores(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """`row` (the columns of `docs`) and `p`, a struct of the probabilities."""
    bounded_batches(docs.sparkSession)
    return docs.select(whole_row(docs).alias("row"), chain.column(F.col(text)).alias("p"))


def _sample(docs: DataFrame, labels: DataFrame, categories: Sequence[str], text: str, doc_id: str, rows: int) -> DataFrame:
    ys = [F.col(c).cast("int").alias(f"y{j}") for j, c in enumerate(categories)]
    known = labels.select(F.col("doc_id").cast("long").alias("id"), *ys)
    known = stored(known.dropna().groupBy("id").agg(*[F.max(f"y{j}").alias(f"y{j}") for j in range(len(categories))]))
    known = smallest_hashes(known, "id", rows)  # at most `rows` short rows: they can be broadcast
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return stored(texts.join(F.broadcast(known), "id"))


def _vocabulary(sample: DataFrame, categories: int, most: int) -> dict[str, int]:
    """The words and stems with the largest chi-square for each category, counted where the texts are."""
    names = ["n", *(f"n{j}" for j in range(categories))]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[k : k + CHUNK] for b in batches for k in range(0, len(b), CHUNK)):
            counts = [Counter() for _ in names]
            ys = zip(*(batch[f"y{j}"] for j in range(categories)))
            for text, y in zip(batch["text"], ys):
                found = words_and_stems(text)
                counts[0].update(found)
                for c, value in zip(counts[1:], y):
                    if value:
                        c.update(found)
            yield pd.DataFrame({"feature": list(counts[0])} | {n: [c[f] for f in counts[0]] for n, c in zip(names, counts)})

    counts = sample.mapInPandas(counted, ", ".join(["feature string", *(f"{n} long" for n in names)]))
    counts = counts.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names]).filter(F.col("n") >= LEAST_DOCUMENTS)
    totals = sample.agg(F.count("*").alias("n"), *[F.sum(f"y{j}").alias(f"n{j}") for j in range(categories)]).first()
    counts, kept = stored(counts), {}
    for j in range(categories):
        if not totals["n"] or not 0 < totals[f"n{j}"] < totals["n"]:
            continue
        share = totals[f"n{j}"] / totals["n"]
        over = F.col(f"n{j}") - F.col("n") * share
        chi = over * over / (F.col("n") * (share * (1 - share)) * (1 - F.col("n") / (totals["n"] + 1)))
        best = counts.withColumn("chi", chi).filter(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "feature").limit(most)
        for row in best.collect():  # at most `most` words
            kept.setdefault(row["feature"], len(kept))
    return kept


def _matrix(sample: DataFrame, vocabulary: dict[str, int], categories: int, rows: int, folds: int) -> tuple:
    """Of at most `rows` rows: numbers of the words and stems in them, shares, labels, folds."""

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary.keys()
        for batch in batches:
            yield pd.DataFrame({
                "id": batch["id"], "fold": batch["fold"],
                "marks": [sorted(vocabulary[f] for f in words_and_stems(t) & known) for t in batch["text"]],
                "dense": [shares(t).tolist() for t in batch["text"]],
                "y": [list(map(int, y)) for y in zip(*(batch[f"y{j}"] for j in range(categories)))],
            })

    marks = sample.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(folds)).cast("int")).mapInPandas(
        marked, "id long, fold int, marks array<int>, dense array<double>, y array<int>"
    )
    found = marks.orderBy(F.xxhash64("id"), "id", F.xxhash64("marks")).limit(rows).collect()
    return (
        [r["marks"] for r in found],
        np.array([r["dense"] for r in found]).reshape(len(found), len(_KINDS)),
        np.array([r["y"] for r in found], np.float64).reshape(len(found), categories),
        np.array([r["fold"] for r in found], np.int64),
    )


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit_one(x: np.ndarray, y: np.ndarray, used: np.ndarray, penalty: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights and bias of a logistic regression on the rows in `used`, with an L2 penalty."""
    w, found = np.zeros(x.shape[1] + 1), y[used]
    if not len(found) or found.min() == found.max():
        w[-1] = 30.0 if len(found) and found[0] else -30.0
        return w

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = (x @ w[:-1].astype(np.float32) + w[-1]).astype(np.float64)
        off = np.where(used, _logistic(z) - y, 0.0)
        value = (np.logaddexp(0, z) - y * z)[used].sum() + penalty * (w[:-1] @ w[:-1]) / 2
        return value, np.append(off.astype(np.float32) @ x + penalty * w[:-1], off.sum())

    return minimised(loss, w, steps)
