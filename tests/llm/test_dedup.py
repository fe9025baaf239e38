"""Exact and near dedup against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from sluice.llm import content_sort, repeats, simhash
from sluice.llm.components import components

BLANK = re.compile(r"[\x20\x09-\x0D]")


def words(r, n, alphabet="abcdeé"):
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(1, 6))) for _ in range(n))


def corpus(seed=1):
    r = random.Random(seed)
    texts = [words(r, r.randint(0, 30)) for _ in range(40)]
    texts += [t.replace(" ", r.choice([" ", "\n", "\t ", ""])) for t in texts[:20]] + [texts[5]] * 30
    texts += [None, "", " \n\x0b", "x" * 50_000, "x" * 50_000, "\x1c", " "]
    r.shuffle(texts)
    return list(enumerate(texts)) + [(3, texts[3]), (None, texts[5]), (None, None), (None, "lone text"), (None, "lone text")]


def frame(spark, rows):
    """With columns named like internal ones."""
    full = [(i, t, "a", n, None) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, row string, part long, fp double")


def best(rows):
    """For each text, without blanks, the row that stays."""
    found = {}
    for i, t in rows:
        rank = (-len(t or ""), i is None, i or 0)
        normal = BLANK.sub("", t or "")
        found.setdefault(normal, []).append((rank, i))
    return {normal: (min(g)[1], len(g)) for normal, g in found.items()}


def test_groups(spark):
    rows = corpus()
    expected = best(rows)
    got = content_sort.groups(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in expected.items()}
    assert all((g.keep_id, g.group_size) == by_text[g.text_sha256] for g in got)
    assert sum(g.kept for g in got) == len(expected)
    assert all(g.doc_id == g.keep_id for g in got if g.kept)
    assert sorted(map(repr, (g.doc_id for g in got))) == sorted(repr(i) for i, _ in rows)


def test_groups_over_many_partitions(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = content_sort.groups(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(g.keep_id, g.group_size) for g in got if g.doc_id % 3} == {(1, 2000)}
    assert sum(g.kept for g in got) == 1001


def test_survivors(spark):
    rows = corpus(2)
    df = frame(spark, rows)
    got = content_sort.survivors(df)
    assert got.columns == df.columns
    kept = [(r.doc_id, BLANK.sub("", r.text or "")) for r in got.collect()]
    assert sorted(map(repr, kept)) == sorted(repr((i, n)) for n, (i, _) in best(rows).items())


def brute_print(text, n=3):
    w = [x.lower() for x in (text or "").encode().split()]
    shingles = [b" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    """For each fingerprint the set that it reaches."""
    left, parts = set(prints), []
    while left:
        open_, part = [left.pop()], set()
        while open_:
            x = open_.pop()
            part.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 2}
            left -= near
            open_ += near
        parts.append(part)
    return {x: part for part in parts for x in part}


def near_corpus():
    r = random.Random(5)
    base = words(r, 300)
    rows = [(None, base), (None, "two words"), (None, "two words")]
    for i in range(60):
        w = base.split(" ")
        for _ in range(i % 7):
            w[r.randrange(300)] = "q"
        rows.append((i, " ".join(w)))
    return rows + [(i + 100, t) for i, (_, t) in enumerate(corpus(7))]


def test_fingerprints():
    for _, t in [*corpus(3), (0, "ÀB c"), (0, "AB c")]:
        assert simhash.fingerprint_of(t) % (1 << 64) == brute_print(t)


def test_near_groups(spark):
    rows = near_corpus()
    prints = [brute_print(t) for _, t in rows]
    parts = brute_components(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        key = min(parts[p])
        least[key] = min((x for x in (least.get(key), i) if x is not None), default=None)
    expected = [(i, f"{p:016x}", least[min(parts[p])]) for (i, _), p in zip(rows, prints)]
    got = [tuple(g) for g in simhash.near_groups(frame(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    df = frame(spark, rows)
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, (k.doc_id for k in kept.collect()))) == sorted(map(repr, least.values()))


def test_links_of_all_pairs(spark):
    r = random.Random(9)
    prints = {r.getrandbits(64) for _ in range(200)}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ 1 << r.randrange(64) ^ r.choice([0, 1 << r.randrange(64)]) ^ r.choice([0, 0, 1 << r.randrange(64)]))
    prints |= {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {tuple(x) for x in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 199)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 160)} | {199: 199, 200: 199}


def brute_spans(rows, keep_first, length=repeats.LENGTH):
    texts = sorted(((i is not None, i or 0, t or "") for i, t in rows), key=lambda x: x[:2])
    data = [t.encode() for *_, t in texts]
    seen = {}
    for d in range(len(data)):
        for p in range(len(data[d]) - length + 1):
            seen.setdefault(data[d][p : p + length], []).append((d, p))
    out = []
    for d, (_, i, _) in enumerate(texts):
        covered = bytearray(len(data[d]))
        for p in range(len(covered) - length + 1):
            where = seen[data[d][p : p + length]]
            if len(where) > 1 and (not keep_first or where[0] != (d, p)):
                covered[p : p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(data[d], covered) if not c)
        runs = sum(c and not before for before, c in zip(b"\0" + covered, covered))
        out.append((i, len(covered), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def passages():
    r = random.Random(3)
    shared = [words(r, n) for n in (90, 120, 160, 300)]
    rows = []
    for i in range(1, 40):
        parts = [
            r.choice([words(r, r.randint(5, 150)), r.choice(shared), r.choice(shared)[r.randint(0, 90) :], r.choice(shared)[: -r.randint(1, 90)]])
            for _ in range(r.randint(0, 4))
        ]
        rows.append((i, "".join(parts)))
    base = words(r, 400).split(" ")
    for i in range(50, 64):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = "zz"
        rows.append((i, " ".join(w)))
    special = ["a" * 900, "ab" * 300, "a" * 399, "", None, rows[3][1], "x" + "a" * 1000 + "y", "Forü " * 200, "é" * 300]
    return rows + [(70 + k, t) for k, t in enumerate(special)]


@pytest.mark.parametrize(("hot", "keep_first"), [(2000, False), (0, False), (2000, True), (0, True)])
def test_repeats(spark, monkeypatch, hot, keep_first):
    """`hot` 0 takes all blocks the way of hot anchors."""
    monkeypatch.setattr(repeats, "HOT_BLOCKS", hot)
    rows = passages()
    found = repeats.spans(frame(spark, rows), keep_first=keep_first).collect()
    got = [(g.doc_id, g.n_bytes, sum(s.end - s.start for s in g.spans), len(g.spans), g.kept_sha256) for g in found]
    assert sorted(got) == brute_spans(rows, keep_first)
    assert all(g.kept is None or hashlib.sha256(g.kept).hexdigest() == g.kept_sha256 for g in found)


def test_repeated_rows_and_null_ids_in_repeats(spark):
    text = words(random.Random(1), 150)
    rows = [(1, text), (1, text), (None, text), (None, text), (None, None), (2, "short")]
    got = repeats.spans(frame(spark, rows)).collect()
    assert sorted((str(g.doc_id), g.n_bytes, len(g.spans)) for g in got) == sorted(
        [("1", len(text.encode()), 1)] * 2 + [("None", len(text.encode()), 1)] * 2 + [("None", 0, 0), ("2", 5, 0)]
    )


def test_anchors_of_long_texts_do_not_depend_on_slabs(monkeypatch):
    text = words(random.Random(8), 3000).encode()
    whole = repeats.anchors(text)
    monkeypatch.setattr(repeats, "_SLAB", 1000)
    parts = repeats.anchors(text)
    starts = lambda found: sorted((a, s + k - p) for a, _, s, c, p in zip(*found) for k, p in ((n, 0) for n in range(c)))
    assert starts(whole) == starts(parts)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert content_sort.groups(empty).count() == content_sort.survivors(empty).count() == 0
    assert simhash.near_groups(empty).count() == simhash.representatives(empty).count() == 0
    assert repeats.spans(empty).count() == 0
