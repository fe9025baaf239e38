"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of a trigram is the product of its letters' vectors, the first one
rotated twice and the second once (binding). A text is the sum of its trigrams' vectors, a language the sum of the vectors of
its texts, each at length one (bundling); what all languages have in common is taken off the profiles. A text has the language
with whose profile its own has the largest cosine; the score is the cosine, 0 if negative.

Letters are taken in lower case; all else is one boundary sign. A text that is null or has no letter has no language: `und`,
score 0. With nothing to learn from, every text is `und`. Ties go to the first language by name. Rows with a null language
teach nothing; repeated rows teach each time. An empty table gives an empty result. Extra columns stay. Memory does not depend on the
script: of a very long text its signs and distinct trigrams are held, 16 bytes each, and vectors of `BLOCK` trigrams at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches

SIZE, SEED, UNKNOWN = 512, 20, "und"
KEPT, CHUNK, BLOCK = 20_000, 64, 4096


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of letters and boundaries, 21 bits a sign, with how often each occurs. None without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    points = np.concatenate([[0], points, [0]])
    points = points[(points != 0) | (np.concatenate([[1], points[:-1]]) != 0)]
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:], return_counts=True)


class Space:
    """Vectors of letters, kept up to `KEPT` of them, of trigrams and of texts."""

    def __init__(self, size: int, seed: int) -> None:
        self.size, self.seed = size, seed
        self._letters: dict[int, np.ndarray] = {}

    def letter(self, point: int) -> np.ndarray:
        found = self._letters.get(point)
        if found is None:
            if len(self._letters) >= KEPT:
                self._letters.clear()
            found = np.random.default_rng([self.seed, point]).choice(np.array([-1, 1], np.int8), self.size)
            self._letters[point] = found
        return found

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """Of trigrams: the product of their letters, the first one rotated twice, the second once."""
        points, codes = np.unique(np.concatenate([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF]), return_inverse=True)
        table = np.array([self.letter(p) for p in points.tolist()])
        a, b, c = codes.reshape(3, -1)
        out = np.roll(table, 2, axis=1)[a]
        out *= np.roll(table, 1, axis=1)[b]
        out *= table[c]
        return out

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """A vector of length one for each text, zero without a letter. `BLOCK` trigrams have vectors at a time, however many there are."""
        out = np.zeros((len(texts), self.size), np.float32)
        for start in range(0, len(texts), CHUNK):
            found = [trigrams(t) for t in texts[start : start + CHUNK]]
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            text = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
            counts, order = np.concatenate([c for _, c in found]), np.argsort(at, kind="stable")
            text, at, counts = text[order], at[order], counts[order]
            for first in range(0, len(keys), BLOCK):
                some = keys[first : first + BLOCK]
                here = slice(*np.searchsorted(at, [first, first + BLOCK]))
                matrix = np.zeros((len(found), len(some)), np.float32)
                matrix[text[here], at[here] - first] = counts[here]
                out[start : start + len(found)] += matrix @ self.vectors(some).astype(np.float32)
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, length, out=out, where=length > 0)


@cache
def space(size: int, seed: int) -> Space:
    return Space(size, seed)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE, seed: int = SEED) -> dict[str, np.ndarray]:
    """A profile for each language. All rows are read; a sum for each language and a few dozen tasks comes to the driver."""
    bounded_batches(docs.sparkSession)

    def bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            vectors = space(size, seed).texts(batch["text"].tolist())
            for name, rows in batch.groupby("lang").indices.items():
                sums[name] = sums.get(name, 0) + vectors[rows].sum(0, dtype=np.float64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "sum": [s.tolist() for s in sums.values()]})

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sums = rows.mapInPandas(bundled, "lang string, sum array<double>")
    # Added position by position on the executors, so that the driver gets one vector for each language.
    sums = sums.select("lang", F.posexplode("sum").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    sums = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("sum"))
    found = {r["lang"]: np.array([x["x"] for x in r["sum"]]) for r in sums.collect()}
    profiles = {name: _unit(v) for name, v in sorted(found.items()) if v.any()}
    common = np.mean(list(profiles.values()), axis=0) if len(profiles) > 1 else 0
    return {name: _unit(v - common) for name, v in profiles.items()}


def _unit(v: np.ndarray) -> np.ndarray:
    return v / max(np.linalg.norm(v), 1e-12)


def predicted(text: Column, profiles: dict[str, np.ndarray], size: int = SIZE, seed: int = SEED) -> Column:
    """A struct of lang and score."""
    names = list(profiles)
    matrix = np.array([profiles[n] for n in names], np.float32).reshape(len(names), size)

    @F.pandas_udf("lang string, score double")
    def compared(texts: pd.Series) -> pd.DataFrame:
        vectors = space(size, seed).texts(texts.tolist())
        lang, score = np.full(len(vectors), UNKNOWN, object), np.zeros(len(vectors))
        known = vectors.any(1)
        if names and known.any():
            cosines = vectors[known] @ matrix.T
            lang[known] = np.array(names, object)[cosines.argmax(1)]
            score[known] = np.clip(cosines.max(1), 0, 1)
        return pd.DataFrame({"lang": lang, "score": score})

    return compared(text)
