"""A third of the rows in one key, a third copies of one row: no task may get much more than its share."""

from collections import Counter
from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sluice import TableSpec
from sluice.operators import duplicates, skew
from sluice.operators.checks import bad_records, reject, with_row_id
from sluice.operators.duplicates import with_duplicate_flags
from sluice.operators.merge import merge
from sluice.operators.skew import join_facts, key_counts, listed_keys, rows_with, rows_without

ROWS = 60_000
NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
SPEC = TableSpec("t", "t.csv", "t", {"k": "int", "v": "string"}, ["k"])


@contextmanager
def settings(spark, **changes):
    names = {name.replace("__", "."): value for name, value in changes.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def sixteen_tasks(spark, **more):
    return settings(
        spark,
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        **more,
    )


def hot_rows(spark):
    """Thirds: one key with a row of its own each time, one key with the same row each time, keys with one row."""
    return spark.range(0, ROWS, 1, 8).selectExpr(
        "cast(case id % 3 when 0 then '7' when 1 then '8' else id + 100 end as string) as k",
        "case id % 3 when 1 then 'same' else concat('v', id) end as v",
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def largest_task(df):
    """Rows in the largest partition; every column is used, so that no step is dropped."""
    used = F.bit_xor(F.xxhash64(*df.columns))
    return max(r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), used).collect())


def test_hot_keys_and_hot_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "COPY_SLOTS", 64)
    with sixteen_tasks(spark):
        rows = with_row_id(hot_rows(spark), SPEC)
        assert largest_task(with_duplicate_flags(rows, SPEC, hot_rows=1000)) < ROWS / 16 * 1.5
        counts = bad_records(rows, SPEC, hot_rows=1000).groupBy("reason").count()
        assert {r.reason[0]: r["count"] for r in counts.collect()} == {"_key_duplicate": ROWS // 3, "_row_duplicate": ROWS // 3 - 1}


def test_without_hot_keys_one_exchange_carries_the_rows(spark):
    """The counts find none above the bound, and there is no other way in the plan."""
    rows = with_row_id(spark.range(0, ROWS, 1, 8).selectExpr("cast(id as string) as k", "'x' as v"), SPEC)
    flagged = with_duplicate_flags(rows, SPEC)
    assert flagged.collect() and plan(flagged).count("Exchange hashpartitioning") == 1
    assert "Join" not in plan(flagged)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_nothing_is_broadcast_that_is_not_measured_as_small(spark, monkeypatch, limit):
    """With a limit of 0 nothing is broadcast, and no task gets more than its share."""
    monkeypatch.setattr(duplicates, "COPY_SLOTS", 64)
    with sixteen_tasks(spark, **NO_BROADCAST):
        rows = with_row_id(hot_rows(spark), SPEC)
        flagged = with_duplicate_flags(rows, SPEC, hot_rows=1000, limit=limit)
        assert largest_task(flagged) < ROWS / 16 * 1.6
        assert ("Broadcast" in plan(flagged)) == (limit > 0)
        facts = spark.range(ROWS).selectExpr("cast(id as string) as k", "id as n")
        joined = join_facts(rows.drop("_sk"), facts, ["k"], "left", hot_rows=1000, limit=limit)
        assert largest_task(joined) < ROWS / 16 * 1.6
        assert ("Broadcast" in plan(joined)) == (limit > 0)
        target = rows.select("k", "v").filter("k != '8'")
        source = facts.selectExpr("k", "'new' as v")
        merged = merge(target, source, ["k"], hot_rows=1000, limit=limit)
        assert largest_task(merged) < ROWS / 16 * 1.6
        assert ("Broadcast" in plan(merged)) == (limit > 0)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_a_list_of_keys_splits_rows(spark, limit):
    rows = hot_rows(spark)
    listed = listed_keys(rows, ["k"], 1000, limit)
    assert listed.few == (limit > 0) and listed.count == 2
    assert {r.k for r in rows_with(rows, listed).distinct().collect() if r.k in "78"} == {"7", "8"}
    assert rows_with(rows, listed).count() == ROWS * 2 // 3 and rows_without(rows, listed).count() == ROWS // 3


def test_null_keys_are_spread(spark):
    with sixteen_tasks(spark):
        nulls = hot_rows(spark).withColumn("k", F.expr("nullif(k, '7')"))
        rows = with_row_id(nulls.filter("k is null or v != 'same'"), SPEC)
        assert largest_task(with_duplicate_flags(rows, SPEC)) < ROWS / 8


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_join_with_hot_and_null_keys(spark, how):
    rows = hot_rows(spark).withColumn("k", F.expr("nullif(k, '8')"))
    facts = spark.range(ROWS).selectExpr("cast(id as string) as k", "id as n").filter("id % 2 = 1")
    with sixteen_tasks(spark, **NO_BROADCAST):
        joined = join_facts(rows, facts, ["k"], how, hot_rows=1000)
        assert [tuple(r) for r in key_counts(rows, ["k"], above=1000).collect()] == [("7", ROWS // 3)]
        plain = rows.join(facts, "k", how)
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.select(joined.columns).collect()))
        if how == "left":
            assert largest_task(joined) < ROWS / 3 / 4


def test_upsert_with_a_hot_key_in_the_target(spark):
    """The source is an aggregate, which the adaptive planner would not split the target for."""
    target = hot_rows(spark)
    source = spark.range(ROWS).groupBy(F.col("id").cast("string").alias("k")).agg(F.lit("new").alias("v"))
    with sixteen_tasks(spark, **NO_BROADCAST):
        merged = merge(target, source, ["k"], hot_rows=1000)
        assert largest_task(merged) < ROWS / 3 / 2
        updated = target.join(source, "k", "left_semi").count()
        inserted = source.join(target, "k", "left_anti").count()
        rows = merged.collect()
        assert len(rows) == ROWS + inserted
        assert sum(r.v == "new" for r in rows) == updated + inserted


def test_upsert_with_half_of_the_source_in_a_key_that_the_target_lacks(spark):
    source = spark.range(0, ROWS, 1, 8).selectExpr("cast(if(id % 2 = 0, -1, id) as string) as k", "'new' as v")
    target = spark.range(0, ROWS, 1, 8).selectExpr("cast(id * 3 as string) as k", "'old' as v")
    with sixteen_tasks(spark, **NO_BROADCAST):
        merged = merge(target, source, ["k"], hot_rows=1000)
        assert largest_task(merged) < ROWS / 8
        counts = {r.v: r["count"] for r in merged.groupBy("v").count().collect()}
        assert counts["new"] == ROWS and counts["old"] == ROWS - source.join(target, "k", "left_semi").count()


def test_upsert_reads_and_shuffles_each_side_once(spark, tmp_path):
    """Besides the key counts, with no hot keys: each side is scanned twice, for the join and for null keys."""
    for name, first in (("target", 0), ("source", 500)):
        spark.range(first, first + 1000).selectExpr("cast(id as string) as k", "id as v").write.parquet(str(tmp_path / name))
    with settings(spark, **NO_BROADCAST):
        target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
        merged = merge(target, source, ["k"])
        assert merged.count() == 1500
        merged.collect()
        text = plan(merged)
    for name in ("target", "source"):
        assert text.count(f"{tmp_path}/{name}") <= 2
    assert text.count("Exchange hashpartitioning") == 2 and text.count("SortMergeJoin") == 1


def pairs(spark):
    """A third of the rows in one key; the others have some to a key, or one, or a null key."""
    return spark.range(0, ROWS, 1, 8).selectExpr(
        "cast(case when id % 97 = 0 then null when id % 3 = 0 then -7 when id % 5 = 0 then id else id div 6 end as string) as k",
        "concat('v', id % 4) as v",
    )


@pytest.mark.parametrize("hot", [False, True])
def test_a_long_list_of_keys_is_not_repeated_but_for_hot_ones(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "SLOTTED_KEYS", 1000)
    monkeypatch.setattr(skew, "HOT_ROWS", 1000)
    rows = pairs(spark) if hot else pairs(spark).filter("k is null or k != '-7'")
    listed = replace(listed_keys(rows, ["k"], 1), few=False)
    assert listed.count > 5000 and (listed.most > 1000) == hot
    with sixteen_tasks(spark, **NO_BROADCAST):
        some, others = rows_with(rows, listed), rows_without(rows, listed)
        assert ("Generate" in plan(some)) == ("Generate" in plan(others)) == hot
        assert largest_task(some) < some.count() / 16 * 1.6 and largest_task(others) < others.count() / 16 * 2
        keys = {r[0] for r in listed.rows.select("_sluice_key_k").collect()}
        everything = Counter(tuple(r) for r in rows.collect())
        assert Counter(tuple(r) for r in some.collect()) == Counter({r: n for r, n in everything.items() if r[0] in keys})
        assert Counter(tuple(r) for r in others.collect()) == Counter({r: n for r, n in everything.items() if r[0] not in keys})


@pytest.mark.parametrize("hot", [False, True])
def test_conflicts_of_many_keys_are_not_repeated_but_for_hot_ones(spark, monkeypatch, hot):
    """All repeated keys take the way of the hot ones."""
    monkeypatch.setattr(skew, "SLOTTED_KEYS", 1000)
    monkeypatch.setattr(skew, "HOT_ROWS", 1000)
    monkeypatch.setattr(duplicates, "COPY_SLOTS", 64)
    rows = with_row_id(pairs(spark) if hot else pairs(spark).filter("k is null or k != '-7'"), SPEC)
    listed = replace(listed_keys(rows, ["k"], 1), few=False, limit=1 << 20)
    with sixteen_tasks(spark, **NO_BROADCAST):
        monkeypatch.setattr(type(listed), "above", lambda self, n, limit=0, f=type(listed).above: self if n == 1 else f(self, n, 1 << 20))
        flagged = with_duplicate_flags(rows, SPEC, 1, listed)
        assert ("Generate" in plan(flagged)) == hot
        assert largest_task(flagged) < ROWS / 16 * 1.6
        counts = {tuple(r.reason): r["count"] for r in bad_records(rows, SPEC).groupBy("reason").count().collect()}
        assert {tuple(r.reason): r["count"] for r in reject(flagged, SPEC).groupBy("reason").count().collect()} == counts
