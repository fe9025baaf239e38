"""Toxicity, host rules, languages, mixing and page extraction."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import host_rules, html_crf, languages, mixing, toxicity
from sluice.llm.html_blocks import blocks

CLEAN = ["river", "stone", "paper", "letter", "garden", "winter", "music", "bread", "window", "market", "silver", "morning"]
ROUGH = ["blighter", "wretch", "oafish", "grumbold"]


def toxic_corpus(count=400, seed=1):
    r, rows, labels = random.Random(seed), [], []
    for i in range(count):
        bad, junk = r.random() < 0.3, r.random() < 0.2
        w = [r.choice(CLEAN) for _ in range(r.randint(5, 60))]
        if bad:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(ROUGH) + r.choice(["", "s", "ling", "."]))
        text = " ".join(x + ("$$$ " if junk else "") for x in w)
        rows.append((i, text))
        labels.append((i, int(not junk), int(bad)))
    return rows, labels


def test_toxicity_chain(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, p double")
    known = spark.createDataFrame([x for x in labels if x[0] % 2] + [(1, None, 1), (None, 1, 1), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    known = known.withColumn("junk", 1 - F.col("quality"))
    chain = toxicity.fit(docs, known, ["junk", "toxic"])
    more = docs.union(spark.createDataFrame([(None, None, 1.0), (7, "", None), (7, "river " * 30_000, 0.0)], docs.schema))
    got = toxicity.scores(more, chain).select("row.doc_id", "row.text", "p.*").collect()
    truth = {i: (junk, bad) for i, junk, bad in labels}
    found = [(g.junk > 0.5, g.toxic > 0.5, 1 - truth[g.doc_id][0], truth[g.doc_id][1]) for g in got if g.doc_id is not None and g.doc_id % 2 == 0]
    assert np.mean([a == c for a, _, c, _ in found]) > 0.98
    assert np.mean([b == d for _, b, _, d in found]) > 0.98
    assert all(g.toxic < 0.5 for g in got if g.doc_id is None or len(g.text) > 100_000)
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1  # the later model sees the earlier category


def test_earlier_categories_are_predicted_out_of_fold(spark, monkeypatch):
    rows, labels = toxic_corpus(120, 2)
    seen = []
    fit = toxicity._fit_one
    monkeypatch.setattr(toxicity, "_fit_one", lambda x, y, used: seen.append((int(used.sum()), x.shape[1])) or fit(x, y, used))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, junk int, toxic int")
    toxicity.fit(docs, known, ["junk", "toxic"], folds=3)
    whole, *folds, later = seen
    assert len(folds) == 3 and sum(n for n, _ in folds) == 2 * whole[0] == 240
    assert later == (whole[0], whole[1] + 1)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scores(docs, toxicity.fit(docs, none, ["toxic"])).select("p.toxic").collect()
    assert all(g.toxic < 1e-6 for g in got)
    only = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    got = toxicity.scores(docs, toxicity.fit(docs, only, ["toxic"])).select("p.toxic").collect()
    assert all(g.toxic > 0.99 for g in got)
    assert toxicity.scores(docs.filter("false"), toxicity.fit(docs.filter("false"), none, ["toxic"])).count() == 0


def brute_measures(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    counts = Counter(windows)
    inside = {k + j for k, x in enumerate(windows) if counts[x] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))


def test_measures():
    r = random.Random(2)
    some = [None, "", " \n ", "a b c d e " * 3, "one line\none line\n\x1c\n\x1c", "x" * 50_000, "a b c"]
    some += ["".join(r.choice(["a ", "b ", "c\n", "#", "$ ", "é ", "\t"]) for _ in range(r.randint(0, 60))) for _ in range(500)]
    assert [host_rules.measured(t) for t in some] == [brute_measures(t) for t in some]


def test_host_verdicts(spark):
    good = "some words that are all different from each other in this text number {}"
    rows = [(k, good.format(k), "good", 1) for k in range(300)] + [(1000 + k, "too short", "bad", 1) for k in range(300)]
    rows += [(2000 + k, good.format(k), "bad", 1) for k in range(20)] + [(3000, "too short", "tiny", 1), (3001, good, None, 1), (3002, None, None, 1)]
    rows += [(4000, "$ " * 40, "good", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = host_rules.judged(docs, F.col("source")).select("row.doc_id", "row.source", "host_rejected", "base_failed", "kept").collect()
    assert len(got) == len(rows)
    assert all(g.host_rejected == (g.source == "bad") for g in got if g.source in ("good", "bad", None))
    kept = sorted(g.doc_id for g in got if g.kept)
    assert kept == [*range(300), 3001]
    rates = spark.createDataFrame([("a", 10, 0, 0, 0, 10)] * 9 + [("b", 0, 0, 0, 0, 0)], "host string, n_words int, word_chars int, n_symbols int, n_dup_lines int, n_repeat_words int")
    rate = {r.host: r for r in host_rules.host_verdicts(rates, {"short": "n_words < 10"}, 0.5).collect()}
    assert 0 < rate["a"].rate_short < rate["b"].rate_short <= 1
    assert host_rules.judged(docs.filter("false"), F.col("source")).count() == 0


def language_rows():
    r = random.Random(3)
    stems = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["eau", "oux", "ille", "ç"]}
    rows = []
    for i in range(600):
        lang = r.choice(list(stems))
        text = " ".join("".join(r.choice(stems[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 40)))
        rows.append((i, text, lang))
    return rows


def test_languages(spark):
    rows = language_rows()
    docs = spark.createDataFrame([(*x, "z", 0.1) for x in rows], "doc_id long, text string, lang string, source string, score double")
    docs = docs.union(spark.createDataFrame([(1, "kalo", None, "z", 0.1), (2, None, "aa", "z", 0.1), (3, "", "aa", "", 0.1)], docs.schema))
    profiles = languages.learn(docs.filter("doc_id % 2 = 0"))
    assert list(profiles) == ["aa", "bb", "cc"]
    tests = [(i, t, x) for i, t, x in rows if i % 2] + [(-1, None, "und"), (-2, "12 !", "und"), (-3, "", "und"), (-4, "ein " * 40_000, "bb")]
    df = spark.createDataFrame(tests, "doc_id long, text string, lang string")
    got = df.select("lang", languages.predicted(df["text"], profiles).alias("p")).select("lang", "p.lang", "p.score").toDF("a", "b", "s").collect()
    assert np.mean([g.a == g.b for g in got]) > 0.98
    assert all((g.b == "und") == (g.s == 0) and 0 <= g.s <= 1 for g in got)
    assert all(g.b == "und" for g in got if g.a == "und")
    nothing = languages.learn(docs.filter("false"))
    assert nothing == {}
    assert {g[0] for g in df.select(languages.predicted(df["text"], nothing)["lang"]).collect()} == {"und"}


def test_a_text_is_the_sum_of_its_bound_trigrams():
    space = languages.Space(64, 1)
    a, b, z = (space.letter(ord(c)).astype(int) for c in "ab\0")
    both = np.roll(z, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * z
    assert np.allclose(space.texts(["Ab", "12"]), [both / np.linalg.norm(both), np.zeros(64)], atol=1e-6)


def test_raking_meets_the_targets():
    r = np.random.default_rng(1)
    values = [[str(x) for x in r.integers(0, k, 60)] for k in (5, 3, 4)]
    tokens = r.integers(50, 1000, 60).astype(float)
    shares = [{v: 1.0 for v in set(values[0])}, {"0": 0.3, "1": 0.4, "2": 0.3}, 1.0]
    p = mixing.rake(tokens, values, shares, 0.3)
    assert p.max() <= 1 and abs(p @ tokens / tokens.sum() - 0.3) < 1e-6
    for of, target in zip(values, shares):
        for v in set(of):
            here = np.array(of) == v
            want = target[v] / sum(target.values()) if isinstance(target, dict) else tokens[here].sum() / tokens.sum()
            assert abs((p * tokens)[here].sum() / (p @ tokens) - want) < 1e-4


def test_raking_is_bounded():
    p = mixing.rake(np.array([10.0, 1000.0, 0.0]), [["a", "b", "c"]], [{"a": 0.5, "b": 0.5}], 0.5)
    assert p[0] == 1 and p[2] == 1 and abs(p[1] - 0.495) < 1e-9
    assert mixing.rake(np.zeros(2), [["a", "b"]], [1.0], 0.5).tolist() == [1, 1]


def test_sample(spark):
    r = random.Random(5)
    rows = [(i, " ".join(["w"] * r.randint(1, 80)), r.choice(["s0"] * 8 + [f"s{k}" for k in range(1, 9)] + [None]), r.choice(["en", "de"])) for i in range(4000)]
    rows += [(None, None, None, None), (5, "", "s1", "en"), (9, "twice", "s1", "en"), (9, "twice", "s1", "en")]
    docs = spark.createDataFrame([(*x, 1, True) for x in rows], "doc_id long, text string, source string, lang string, p int, kept boolean")
    by = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.form_of(F.col("text"))}
    out = mixing.sample(docs, by, mixing.word_count(F.col("text")), {"source": 0.0, "lang": {"en": 0.5, "de": 0.5}, "topic": 1.0}, 0.4)
    got = out.collect()
    assert len(got) == len(rows) and out.select("row.*").columns == docs.columns
    assert all(g.n_tokens == len((g.row.text or "").split()) for g in got)
    kept, expected = defaultdict(float), defaultdict(float)
    for g in got:
        for key in (g.source, g.lang):
            kept[key] += g.n_tokens * g.kept
            expected[key] += g.n_tokens * g.p
    assert abs(expected["en"] - expected["de"]) < 0.01 * expected["en"]
    assert abs(expected["s1"] - expected["s2"]) < 0.01 * expected["s1"]
    assert all(abs(kept[k] - x) < 0.35 * x for k, x in expected.items() if x > 500)
    assert [(g.row.doc_id, g.kept) for g in out.orderBy("row.doc_id", "row.text").collect()] == [(g.row.doc_id, g.kept) for g in out.orderBy("row.doc_id", "row.text").collect()]
    assert len({g.kept for g in got if g.row.doc_id == 9 and g.row.text == "twice"}) == 1
    assert mixing.sample(docs.filter("false"), by, mixing.word_count(F.col("text")), {"source": 1.0, "lang": 1.0, "topic": 1.0}, 0.5).count() == 0


def test_values_without_a_target_keep_their_share(spark):
    """Null and unlisted languages with words; no listed language at all; a target for all others together."""
    rows = [(i, "w " * 20, ["en"] * 5 + ["de", None, "xx"]) for i in range(8)]
    rows = [(i, t, langs[i]) for i, t, langs in rows] * 50
    docs = spark.createDataFrame([(i * 1000 + k, t, lang) for k, (i, t, lang) in enumerate(rows)], "doc_id long, text string, lang string")

    def expected(docs, target):
        out = mixing.sample(docs, {"lang": F.col("lang")}, mixing.word_count(F.col("text")), {"lang": target}, 0.4).collect()
        total, by = sum(g.n_tokens for g in out), defaultdict(float)
        for g in out:
            by[g.lang] += g.n_tokens * g.p / total
        return pytest.approx(by, abs=1e-6)

    target = {"en": 0.75, "de": 0.25}
    assert {"en": 0.225, "de": 0.075, "(other)": 0.05, "xx": 0.05} == expected(docs, target)
    assert {"(other)": 0.2, "xx": 0.2} == expected(docs.filter("lang is null or lang = 'xx'"), target)
    assert {"en": 0.25, "de": 0.05, "(other)": 0.05, "xx": 0.05} == expected(docs, {"en": 5, "de": 1, "(other)": 2})


def test_every_value_has_its_own_marginal(spark):
    """One source with half of the tokens and 1,500 equal ones: these are kept alike, whatever their names."""
    docs = spark.range(1500).selectExpr("id as doc_id", "'w w' as text", "concat('s', id) as source")
    docs = docs.union(spark.createDataFrame([(-1, "w " * 3000, "hot")], docs.schema))
    out = mixing.sample(docs, {"source": F.col("source")}, mixing.word_count(F.col("text")), {"source": 0.7}, 0.85).collect()
    p = {g.source: g.p for g in out}
    assert len(p) == 1501 and all(p[f"s{k}"] == pytest.approx(1) for k in range(1500)) and p["hot"] == pytest.approx(0.7)


def test_raking_on_spark_takes_the_same_steps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 2)
    r = random.Random(8)
    rows = [(i, "w " * r.randint(0, 80), r.choice([f"s{k}" for k in range(6)] * 3 + ["rare", None]), r.choice("aaaaaabcx")) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, None, "empty", None)], "doc_id long, text string, source string, lang string")
    by = {"source": F.col("source"), "lang": F.col("lang")}
    for targets in ({"source": 0.3, "lang": {"a": 0.3, "b": 0.4, "gone": 1.0}}, {"source": {"s1": 3.0, "(other)": 1.0}, "lang": 1.0}):
        driver, on_spark = (
            sorted(map(repr, mixing.sample(docs, by, mixing.word_count(F.col("text")), targets, 0.7, limit=limit).withColumn("p", F.round("p", 9)).collect()))
            for limit in (1 << 20, 0)
        )
        assert driver == on_spark and len(driver) == 301


PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style><script>var a = "<p>no</p>";</script></head>
<body><div class="cookie-notice">We use cookies. <button>OK</button></div><header><a href="/">Site</a></header>
<nav><ul><li><a href="/a">Home</a><li><a href='/b>c'>News</a></ul></nav>
<article><h1>A title &amp; more</h1><p>First <b>para</b>graph,\n   with   space&nbsp;here. It has two sentences.
<p>Second one<br>goes on for quite a while, as paragraphs in articles do, and then it ends.
<div class="ad">Buy now</div><!-- <p>comment</p> --><p>Third &lt;b&gt; and last paragraph of this story, which is long enough.</article>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with this at all, it is wrong.</p></div></section>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/x">Other story</a></ul></aside>
<form><label>Your mail</label><textarea>x</textarea></form><footer>&copy; 2020 Site &middot; All rights reserved.</footer></body></html>"""
TEXT = (
    "A title & more First paragraph, with space here. It has two sentences. Second one goes on for quite a while, as paragraphs in "
    "articles do, and then it ends. Third <b> and last paragraph of this story, which is long enough."
)


def test_blocks():
    found = [b.text for b in blocks(PAGE)]
    assert "Not this" not in found and "x" not in found and "comment" not in " ".join(found).split()
    assert found[:4] == ["We use cookies.", "OK", "Site", "Home"]
    assert [b.text for b in blocks("a<p>b<div>c</div>d<td>e")] == ["a", "b", "c", "d", "e"]
    assert blocks(None) == blocks("") == blocks("<p> </p><!-- x") == []
    assert [b.text for b in blocks("1 < 2 <b>and</b> <unclosed 'x")][0].startswith("1 < 2 and")


def test_a_head_without_end():
    for page in ("<head><title>t</title><p>a<p>b", "<html><head><meta x><title>t</title>a<b></b><p>b", "<head><style>p</style><b>a</b><div>b</body>"):
        assert [b.text for b in blocks(page)] == ["a", "b"]
    assert [b.text for b in blocks("<head><title>t</title>a")] == ["a"]
    assert blocks("<head>\n<template><p>no</template> <link y></head><body>") == []


def test_field_on_other_pages_than_those_it_learnt():
    field = html_crf.fit(html_crf.composed([], 400, 1))
    right = [a == b for page, labels in html_crf.composed([], 150, 2) for a, b in zip(field.content(page), labels)]
    assert np.mean(right) > 0.97
    assert field.text(PAGE) == TEXT
    assert field.text(None) == field.text("") == ""


def test_only_pages_of_one_article_are_labelled():
    teasers = "<article class='comment'><p>A reader.</p></article>"
    assert html_crf.labelled(blocks(PAGE))[1] == [TEXT.find(b.text) >= 0 for b in blocks(PAGE)]
    assert html_crf.labelled(blocks(PAGE + teasers)) is None
    assert html_crf.labelled(blocks("<p>Main text.</p>" + teasers)) is None
    assert html_crf.labelled(blocks(f"<article>{teasers}</article>")) is None
    assert html_crf.labelled([]) is None


def test_viterbi_is_the_best_of_all_labellings():
    r = np.random.default_rng(3)
    page = html_crf.composed([], 1, 5)[0][0][:8]
    for _ in range(20):
        names = {f for k, b in enumerate(page) for f in (*html_crf.path_features(b.path), *html_crf.text_features(b, k, len(page)))}
        field = html_crf.Field({f: r.normal() for f in sorted(names)}, r.normal(size=(2, 2)), r.normal(size=2))
        scores = [
            sum(field.weights[f] for f in (*html_crf.path_features(b.path), *html_crf.text_features(b, k, len(page)))) for k, b in enumerate(page)
        ]

        def value(labels):
            return field.first[labels[0]] + sum(s for s, y in zip(scores, labels) if y) + sum(field.steps[a, b] for a, b in zip(labels, labels[1:]))

        every = [[n >> k & 1 for k in range(len(page))] for n in range(1 << len(page))]
        assert [int(x) for x in field.content(page)] == max(every, key=value)


def test_gradient_of_the_field(monkeypatch):
    kept = {}
    monkeypatch.setattr(html_crf, "minimised", lambda loss, w, steps: kept.update(loss=loss) or w)
    html_crf.fit(html_crf.composed([], 5, 8))
    loss, r = kept["loss"], np.random.default_rng(1)
    size = len(html_crf.fit(html_crf.composed([], 5, 8)).weights) + 6
    w, way = r.normal(size=size) * 0.1, r.normal(size=size)
    by_steps = (loss(w + 1e-5 * way)[0] - loss(w - 1e-5 * way)[0]) / 2e-5
    assert by_steps == pytest.approx(loss(w)[1] @ way, rel=1e-4)


def test_train_on_a_table(spark):
    rows = [(k, f"http://x/{k}", PAGE, "t") for k in range(5)] + [(None, None, None, None), (5, "u", "", "t"), (5, "u", PAGE, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    field = html_crf.train(df)
    got = df.select("page_id", field.column(df["html"]).alias("found")).collect()
    assert Counter(g.found for g in got) == {TEXT: 6, "": 2}
    assert html_crf.train(df.filter("false")).text(PAGE) == TEXT


def test_crc_split_of_the_language_query(spark):
    assert spark.sql("select crc32(cast('12' as binary))").first()[0] == zlib.crc32(b"12")


def test_many_letters_take_bounded_memory():
    """64 texts of 3,000 letters: no vector for each trigram is kept; the same vectors as by the definition."""
    r, space = np.random.default_rng(1), languages.Space(64, 1)
    texts = ["".join(map(chr, r.integers(0x4E00, 0x4E00 + 3000, 600))) for _ in range(64)]
    got = space.texts([*texts, None, "12"])
    for text, row in zip(texts[:3], got):
        points = [0, *map(ord, text), 0]
        whole = sum(
            np.roll(space.letter(a), 2).astype(int) * np.roll(space.letter(b), 1) * space.letter(c) for a, b, c in zip(points, points[1:], points[2:])
        )
        assert np.allclose(row, whole / np.linalg.norm(whole), atol=1e-6)
    assert not got[-2:].any() and len(space._letters) <= languages.KEPT


def test_goals_that_contradict_have_an_answer():
    """Source a is only English, b only German, and the goals want more of a, but less of English."""
    p = mixing.rake(np.array([100.0, 100.0]), [["a", "b"], ["en", "de"]], [{"a": 0.8, "b": 0.2}, {"en": 0.3, "de": 0.7}], 0.5)
    assert np.allclose(p, [0.3, 0.7])


def independent_rake(tokens, values, goals, rounds=3000):
    """Plain fitting to goals that no bound touches."""
    p = np.ones(len(tokens))
    for _ in range(rounds):
        for of, goal in zip(values, goals):
            for v, g in goal.items():
                here = np.array([x == v for x in of])
                p[here] *= g / (tokens * p)[here].sum()
    return p


def test_raking_to_its_end():
    rng = np.random.default_rng(2)
    tokens = rng.integers(50, 500, 24).astype(float)
    values = [[f"s{k % 4}" for k in range(24)], [f"l{k // 8}" for k in range(24)]]
    shares = [{"s0": 0.22, "s1": 0.28, "s2": 0.26, "s3": 0.24}, {"l0": 0.3, "l1": 0.36, "l2": 0.34}]
    p = mixing.rake(tokens, values, shares, 0.3)
    expected = independent_rake(tokens, values, [{v: s * 0.3 * tokens.sum() for v, s in d.items()} for d in shares])
    assert p.max() < 1 and np.abs(tokens * (p - expected)).max() < 1e-5 * tokens.sum()


def test_what_is_reached(spark):
    rows = [(k, f"s{k % 3}", f"l{k % 2}", "word " * (1 + k % 7)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    by = {"source": F.col("source"), "lang": F.col("lang")}
    found = mixing.sample(docs, by, mixing.word_count(F.col("text")), {"source": 0.5, "lang": {"l0": 0.4, "l1": 0.6}}, 0.5)
    got = {(r.dimension, r.value): r for r in mixing.reached(found, ["source", "lang"]).collect()}
    total = sum(r.n_tokens for (d, _), r in got.items() if d == "lang")
    assert set(got) == {("source", f"s{k}") for k in range(3)} | {("lang", "l0"), ("lang", "l1")}
    assert abs(got["lang", "l0"].expected - 0.4 * 0.5 * total) < 1e-4 * total
    assert all(abs(r.kept - r.expected) < 0.15 * r.n_tokens for r in got.values())


@pytest.mark.parametrize("unit", ["<a ", '<p "', '<p ">', "<p \"><b 'x\" ", "<div>", "<script ", "<", "<!-- ", "<a<a", '"><p "', "<!x ", "<li><ul>"])
def test_any_page_takes_time_in_proportion(unit):
    start = time.perf_counter()
    blocks(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - start < 15


def test_deep_pages_lose_no_text():
    found = blocks("<div>" * 2000 + "<p>deep</p>" + "</div>" * 2000 + "<p>after</p>")
    assert [b.text for b in found] == ["deep", "after"] and len(found[0].path) == 512 and found[1].path == ("p",)


def test_a_field_that_saw_names_also_knows_pages_without():
    pages = html_crf.composed([], 300, 3)
    field = html_crf.fit(pages + [(html_crf.plain(p), y) for p, y in pages])
    right = total = 0
    for page, labels in html_crf.composed([], 120, 4):
        for block, got, label in zip(page, field.content(html_crf.plain(page)), labels):
            words = block.text.count(" ") + 1
            right, total = right + words * (got == label), total + words
    assert right / total > 0.9


def test_raking_on_spark_to_its_end(spark, monkeypatch):
    """Many cells of few values: the same p as on the driver, bounded cells and cells without tokens among them."""
    monkeypatch.setattr(mixing, "REPLAYED", 3)
    monkeypatch.setattr(mixing, "CLOSE", 1e-3)
    rng = np.random.default_rng(5)
    rows = [(f"s{a}", f"l{b}", int(rng.integers(1, 900)) if (a + b) % 7 else 0) for a in range(9) for b in range(4)]
    cells = spark.createDataFrame(rows, "source string, lang string, n_tokens long")
    targets = {"source": 0.3, "lang": {"l0": 0.4, "l1": 0.3, "l2": 0.2, "l3": 0.1}}
    found = {(r.source, r.lang): r.p for r in mixing.raked(cells, ["source", "lang"], targets, 0.6).collect()}
    expected = mixing.rake(np.array([float(n) for *_, n in rows]), [[r[0] for r in rows], [r[1] for r in rows]], list(targets.values()), 0.6)
    assert len(found) == len(rows) and (expected == 1).any() and expected.min() < 0.9
    assert np.allclose([found[r[:2]] for r in rows], expected, atol=1e-6)
