"""Random-indexing vectors, the network and the quality query."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import quality, queries
from sluice.llm.perfect_hash import mixed

SF_DIR = "/root/testdata/sf0.01"


def index_vector(word):
    key, out = np.array([zlib.crc32(word.encode())], np.uint64), np.zeros(quality.SIZE, np.int64)
    for j in range(quality.ONES):
        (x,) = mixed(key, 1 + j).tolist()
        out[(x >> 8) % quality.SIZE] += 1 if x & 1 else -1
    return out


def words_of(text):
    """Letters and digits, or other signs, in lower case."""
    out = []
    for w in (text or "").lower().split():
        kinds = [c.isalnum() for c in w]
        cuts = [0, *(k for k in range(1, len(w)) if kinds[k] != kinds[k - 1]), len(w)]
        out += [w[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


TEXTS = ["The cat, sat ### on 3 mats.", None, "", "é&&& É e é", "a " * 9, "one"]


def brute_contexts(texts):
    sums = np.zeros((quality.SLOTS, quality.SIZE), np.int64)
    for text in texts:
        words = words_of(text)
        for i, w in enumerate(words):
            slot = mixed(np.array([zlib.crc32(w.encode())], np.uint64), 0)[0] % quality.SLOTS
            for j in range(max(0, i - quality.WINDOW), min(len(words), i + quality.WINDOW + 1)):
                if j != i:
                    sums[slot] += index_vector(words[j])
    return sums


def test_contexts_against_brute_force(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    got = np.zeros((quality.SLOTS, quality.SIZE), np.int64)
    for r in quality.contexts(docs).collect():
        got[r.slot] = r[1:]
    assert (got == brute_contexts(TEXTS)).all() and got.any()


def test_pooling_against_brute_force(monkeypatch):
    vectors = np.random.default_rng(1).normal(size=(quality.SLOTS, quality.SIZE)).astype(np.float32)
    for chunk in (3, 1 << 16):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        for text, row in zip(TEXTS, quality.pooled(pa.array(TEXTS), vectors)):
            slots = [mixed(np.array([zlib.crc32(w.encode())], np.uint64), 0)[0] % quality.SLOTS for w in words_of(text)]
            rows = vectors[slots].astype(float) if slots else np.zeros((1, quality.SIZE))
            assert np.allclose(row, np.concatenate([rows.mean(0), rows.std(0)]), atol=1e-5)


def test_network_learns_what_no_line_divides():
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (1500, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    network = quality.fit_network(x[:1200], y[:1200], np.arange(1200) % 5)
    assert np.mean((network.scores(x[1200:]) > 0.5) == y[1200:]) > 0.9


def test_temperature_finds_what_logits_were_multiplied_by():
    rng = np.random.default_rng(4)
    z = rng.normal(0, 2, 20_000)
    y = (rng.uniform(size=len(z)) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(quality.temperature(3 * z, y) - 3) < 0.2


def test_nothing_to_learn():
    x = np.ones((2, 4))
    for y, expected in (([], 0.0), ([1.0, 1.0], 1.0), ([0.0], 0.0)):
        network = quality.fit_network(x[: len(y)], np.array(y), np.zeros(len(y), int))
        assert network.scores(x).tolist() == [expected, expected]


def test_rows_of_any_kind(spark):
    good, bad = "some plain words of a text", "### &&& $$$ ***"
    rows = [(k, f"{good} {k}" if k % 2 else f"{bad} {k}", k) for k in range(40)]
    rows += [(None, None, 0), (None, good, 0), (50, "", 0), (50, "", 0), (51, "word " * 200_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(1, None), (1, 0), (None, 1), (99, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = docs.select("doc_id", "slot", model.column(F.col("text")).alias("score")).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got)
    by_id = {g.doc_id: g.score for g in got}
    assert all((by_id[k] > 0.5) == bool(k % 2) for k in range(40))
    again = quality.learn(docs.repartition(3), labels)
    assert sorted(g.score for g in got) == sorted(g.s for g in docs.select(again.column(F.col("text")).alias("s")).collect())
    empty = docs.filter("false")
    model = quality.learn(empty, labels)
    assert empty.select(model.column(F.col("text"))).collect() == [] and model.network.constant == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_query_on_rows_not_learnt_from(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = queries.op12_quality(spark, SF_DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    got = got.collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) and g.predicted == (g.score >= 0.7) for g in got)
    held = [(g.predicted, label[g.doc_id]) for g in got if g.held_out and g.doc_id in label]
    assert np.mean([p == y for p, y in held]) > 0.95 and len(held) > 50
