"""Bitmaps of repeated keys: a superset of their rows, and the same results as without."""

import re
from collections import Counter

import pytest

from sluice import TableSpec
from sluice.operators.bitmaps import BUCKET_BITS, bits_within, key_bits, rows_maybe_with, rows_surely_without
from sluice.operators.checks import bad_records, reject, with_row_id
from sluice.operators.duplicates import flag_repeated, flag_unrepeated, repeated_bits, repeated_keys
from sluice.plans import pipeline
from sluice.plans.pipeline import load_checked, load_raw
from sluice.plans.sizes import CELL_BYTES, ROW_BYTES, measured

SPEC = TableSpec("t", "t.csv", "t", {"k": "int", "n": "int", "v": "string"}, ["k", "n"])
ONE_BUCKET = BUCKET_BITS // 8 + ROW_BYTES + 2 * CELL_BYTES
ROWS = 30_000


def some_repeated(spark):
    """3 of 10 rows share their key with one other, every tenth of these as a copy; some keys are null; one key has 2,000 rows."""
    return spark.range(0, ROWS, 1, 6).selectExpr(
        "cast(case when id % 15 = 14 then -1 when id % 10 < 3 then id div 20 * 20 + id % 10 else id end as string) as k",
        "if(id % 101 = 0, null, cast(id % 7 * 0 as string)) as n",
        "if(id % 30 < 3, 'same', concat('v', id)) as v",
    )


def in_two(rows, limit, hot_rows=1_000_000, spec=SPEC):
    repeated = repeated_keys(rows, spec, 0)
    bits = repeated_bits(repeated, limit)
    once = flag_unrepeated(rows, repeated, spec, bits)
    return repeated, bits, once, flag_repeated(rows, spec, repeated, hot_rows, limit, bits)


def reasons(bad):
    return Counter((r.k, r.n, r.v if r.v == "same" else "v", tuple(r.reason)) for r in bad.collect())


def test_a_bitmap_stays_within_its_limit(spark):
    assert [bits_within(n) for n in (0, ONE_BUCKET - 1, ONE_BUCKET, 3 * ONE_BUCKET)] == [0, 0, BUCKET_BITS, 2 * BUCKET_BITS]
    listed = spark.range(40_000).selectExpr("cast(id as string) as k")
    for limit in (3 * ONE_BUCKET, 9 * ONE_BUCKET, 1 << 26):
        bits = key_bits(listed, ["k"], ["k"], 40_000, limit)
        if 2 * 40_000 > bits_within(limit):
            assert bits is None
            continue
        rows = bits.rows.collect()
        assert sum(len(r[1]) + ROW_BYTES + 2 * CELL_BYTES for r in rows) <= limit and measured(bits.rows)[0] == len(rows)
        assert len({r[0] for r in rows}) == len(rows) <= bits.size // BUCKET_BITS


@pytest.mark.parametrize("type_", ["string", "long", "double", "date", "decimal(20,3)", "binary"])
def test_a_bitmap_misses_no_key(spark, type_):
    value = f"cast(cast(id as string) as {type_})" if type_ != "date" else "date_add(date'2000-01-01', cast(id as int))"
    rows = spark.range(20_000).selectExpr(f"if(id % 50 = 7, null, {value}) as k", "id")
    listed = rows.filter("id % 3 = 0 and k is not null").select("k")
    count = listed.count()
    bits = key_bits(listed, ["k"], ["k"], count, ONE_BUCKET)
    maybe = {r.id for r in rows_maybe_with(rows, bits).collect()}
    without = {r.id for r in rows_surely_without(rows, bits).collect()}
    assert {i for i in range(0, 20_000, 3) if i % 50 != 7} <= maybe
    assert not maybe & without and maybe | without == set(range(20_000))
    assert {i for i in range(20_000) if i % 50 == 7} <= without
    # Of the 13,000 others about a fifth share a bit; with bits enough, a sixteenth at most.
    assert 0.1 < (len(maybe) - count) / 13_000 < 0.3
    many = rows_maybe_with(rows, key_bits(listed, ["k"], ["k"], count, 1 << 26)).count()
    assert count <= many < count + 13_000 / 14


def test_no_bitmap_for_no_bits_or_texts_of_a_collation(spark):
    listed = spark.range(10).selectExpr("cast(id as string) as k")
    assert key_bits(listed, ["k"], ["k"], 10, ONE_BUCKET - 1) is None
    assert key_bits(listed.selectExpr("k collate utf8_lcase as k"), ["k"], ["k"], 10, 1 << 26) is None
    empty = key_bits(listed.limit(0), ["k"], ["k"], 0, 1 << 26)
    assert rows_maybe_with(listed, empty).count() == 0 and rows_surely_without(listed, empty).count() == 10


@pytest.mark.parametrize("limit", [ONE_BUCKET, 1 << 26])
@pytest.mark.parametrize("hot_rows", [1_000, 1_000_000])
def test_reasons_are_the_same_as_without(spark, limit, hot_rows):
    rows = with_row_id(some_repeated(spark), SPEC)
    repeated, bits, once, again = in_two(rows, limit, hot_rows)
    assert bits and not repeated.few
    assert reasons(reject(once.unionByName(again), SPEC)) == reasons(bad_records(rows, SPEC))
    assert once.count() + again.count() == ROWS


def test_rows_whose_bit_is_not_set_are_not_shuffled(spark):
    """Three of ten rows share a key; most others go around the shuffle, which a list of that length would not let them."""
    rows = with_row_id(some_repeated(spark), SPEC)
    repeated, _, once, again = in_two(rows, 1 << 26)
    shared = repeated.rows.groupBy().sum("_sluice_rows").first()[0]
    assert 0.3 * ROWS < shared < 0.4 * ROWS
    once.collect()
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"(?<!Broadcast)Exchange ", plan.split("== Initial Plan ==")[0])
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert shared <= again.count() < shared + 0.08 * ROWS


def test_malformed_rows_and_null_keys_take_no_part(spark):
    spec = TableSpec("t", "t.csv", "t", {"k": "int", "v": "string"}, ["k"], reject_malformed=True)
    raw = spark.createDataFrame(
        [("1", "a", None), ("1", "b", None), ("1", "a", "1|a|x"), (None, "a", None), (None, "a", None), ("2", "c", None)],
        "k string, v string, _malformed_row string",
    )
    _, bits, once, again = in_two(with_row_id(raw, spec), 1 << 26, spec=spec)
    assert bits
    got = sorted((str(r.k), r.v, *r.reason) for r in reject(once.unionByName(again), spec).collect())
    assert got == [
        ("1", "a", "_is_row_malformed"), ("1", "a", "_key_duplicate"), ("1", "b", "_key_duplicate"),
        ("None", "a", "_is_k_null"), ("None", "a", "_is_k_null"),
    ]


@pytest.mark.parametrize("limit", [0, 2 * ONE_BUCKET, 1 << 26])
def test_the_job_writes_the_same_tables(spark, database, tmp_path, limit):
    """By no list, by the bitmap, by the list."""
    some_repeated(spark).write.parquet(str(tmp_path / "rows.parquet"))
    spec = TableSpec("t", str(tmp_path / "rows.parquet"), f"{database}.t", dict(SPEC.columns), list(SPEC.keys))
    load_raw(spark, spec)
    load_checked(spark, spec, broadcast_bytes=limit)
    expected = bad_records(with_row_id(spark.table(spec.raw_table), spec), spec)
    assert reasons(spark.table(spec.bad_table)) == reasons(expected)
    assert spark.table(spec.clean_table).count() == ROWS - expected.count()


def test_a_look_up_reads_one_number_of_a_bitmap(spark):
    """Not a copy of the whole part, as a binary value would be. Every bit of Spark's bitmap is found in its place."""
    listed = spark.range(BUCKET_BITS).selectExpr("id as k")
    bits = key_bits(listed.filter("k % 3 = 0"), ["k"], ["k"], BUCKET_BITS // 3, ONE_BUCKET)
    assert bits.rows.dtypes[1][1] == "array<bigint>" and bits.rows.first()[1].__len__() == BUCKET_BITS // 64
    places = {(r[0]) for r in listed.filter("k % 3 = 0").selectExpr(f"pmod(xxhash64(k), {BUCKET_BITS})").collect()}
    found = {64 * n + 8 * (7 - j // 8) + j % 8 for n, word in enumerate(bits.rows.first()[1]) for j in range(64) if word >> j & 1}
    assert found == places
    maybe = {r.k for r in rows_maybe_with(listed, bits).collect()}
    assert maybe == {r.k for r in listed.selectExpr("k", f"pmod(xxhash64(k), {BUCKET_BITS}) as p").collect() if r.p in places}


@pytest.mark.parametrize("limit", [2 * ONE_BUCKET, 1 << 26])
def test_rows_that_were_checked_for_duplicates_are_not_shuffled_again(spark, database, tmp_path, monkeypatch, limit):
    """Only the bad ones of the others, few of many tasks, are gathered."""
    some_repeated(spark).write.parquet(str(tmp_path / "rows.parquet"))
    spec = TableSpec("t", str(tmp_path / "rows.parquet"), f"{database}.t", dict(SPEC.columns), list(SPEC.keys))
    tops = {}

    def noted(df, name, mode, write=pipeline.write_table):
        tops[name] = df._jdf.queryExecution().optimizedPlan()
        write(df, name, mode)

    monkeypatch.setattr(pipeline, "write_table", noted)
    load_raw(spark, spec)
    load_checked(spark, spec, broadcast_bytes=limit)
    assert tops[spec.bad_table].nodeName() == "Union" and tops[spec.bad_table].toString().count("RebalancePartitions") == 1
