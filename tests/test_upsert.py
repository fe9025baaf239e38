from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from shops import shop_spec

from sluice.operators.merge import ambiguous_keys, merge, shared_keys
from sluice.plans.pipeline import _touched, upsert_table
from sluice.plans.registry import create_registry, lookup, register
from sluice.sources import tables
from sluice.sources.tables import bucket_columns, finish_replacement, partition_columns, replace_rows

TARGET = [(1, "a", "old"), (1, "a", "older"), (2, "b", "old"), (3, None, "old"), (4, "d", None)]
SOURCE = [(1, "a", "new"), (4, "d", "new"), (4, "x", "new"), (3, None, "new"), (9, "i", "new"), (9, "i", "twice")]
MERGED = [
    (1, "a", "new"),
    (1, "a", "new"),
    (2, "b", "old"),
    (3, None, "old"),
    (3, None, "new"),
    (4, "d", "new"),
    (4, "x", "new"),
    (9, "i", "new"),
    (9, "i", "twice"),
]
SCHEMA = "k1 int, k2 string, v string"


@pytest.mark.parametrize("small_source", [True, False])
def test_merge(spark, small_source):
    target, source = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    merged = merge(target, source.select("v", "k2", "k1"), ["k1", "k2"], small_source)
    assert merged.columns == target.columns
    assert Counter(map(tuple, merged.collect())) == Counter(MERGED)


def test_update_to_null(spark):
    target, source = spark.createDataFrame([(1, "a", "old")], SCHEMA), spark.createDataFrame([(1, "a", None)], SCHEMA)
    assert merge(target, source, ["k1"]).collect() == [(1, "a", None)]


def test_ambiguous_keys(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([*SOURCE, (1, "a", "newer")], SCHEMA)
    for limit in (0, 1 << 20):
        assert ambiguous_keys(target, source, ["k1", "k2"], limit).collect() == [(1, "a")]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_upsert_table(spark, database, broadcast_bytes):
    name = f"{database}.t"
    spark.createDataFrame(TARGET, SCHEMA).write.saveAsTable(name)
    upsert_table(spark.createDataFrame(SOURCE, SCHEMA), name, ["k1", "k2"], broadcast_bytes)
    assert Counter(map(tuple, spark.table(name).collect())) == Counter(MERGED)
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]


def partitioned(spark, name, rows, schema, by):
    spark.createDataFrame(rows, schema).write.partitionBy(by).saveAsTable(name)


def test_the_source_is_cast_before_partitions_are_told(spark, database):
    """A time falls on a day, a fraction in a whole number, '' in the null partition."""
    day, number, text = (f"{database}.{n}" for n in ("days", "numbers", "texts"))
    partitioned(spark, day, [(1, date(2025, 1, 1)), (2, date(2025, 1, 1)), (3, date(2025, 1, 2))], "k int, d date", "d")
    new = spark.createDataFrame([(9, datetime(2025, 1, 1, 12))], "k int, d timestamp_ntz")
    upsert_table(new, day, ["k", "d"])
    assert sorted((r.k, str(r.d)) for r in spark.table(day).collect()) == [
        (1, "2025-01-01"), (2, "2025-01-01"), (3, "2025-01-02"), (9, "2025-01-01"),
    ]
    partitioned(spark, number, [("a", 1), ("b", 1), ("c", 2)], "k string, p int", "p")
    upsert_table(spark.createDataFrame([("d", 1.5)], "k string, p double"), number, ["k", "p"])
    assert sorted((r.k, r.p) for r in spark.table(number).collect()) == [("a", 1), ("b", 1), ("c", 2), ("d", 1)]
    partitioned(spark, text, [(1, None), (2, "x")], "k int, p string", "p")
    upsert_table(spark.createDataFrame([(7, "")], "k int, p string"), text, ["k", "p"])
    assert sorted(map(str, ((r.k, r.p) for r in spark.table(text).collect()))) == ["(1, None)", "(2, 'x')", "(7, None)"]


def test_source_rows_that_meet_after_the_cast_are_an_error(spark, database):
    name = f"{database}.t"
    partitioned(spark, name, [(1, "old", date(2025, 1, 1))], "k int, v string, d date", "d")
    two = [(1, "a", datetime(2025, 1, 1, 1)), (1, "b", datetime(2025, 1, 1, 2))]
    with pytest.raises(ValueError):
        upsert_table(spark.createDataFrame(two, "k int, v string, d timestamp_ntz"), name, ["k", "d"])
    assert [r.v for r in spark.table(name).collect()] == ["old"]


def test_more_than_a_thousand_touched_partitions(spark, database):
    name = f"{database}.t"
    spark.range(1020).selectExpr("id as k", "'old' as v", "id as p").repartition(2, "p").write.partitionBy("p").saveAsTable(name)
    files = files_of_partitions(spark, name)
    upsert_table(spark.range(1005).selectExpr("id as k", "'new' as v", "id as p"), name, ["k", "p"])
    now = files_of_partitions(spark, name)
    assert {p for p in files if files[p] == now[p]} == set(range(1005, 1020))
    assert {r.v: r["count"] for r in spark.table(name).groupBy("v").count().collect()} == {"new": 1005, "old": 15}


def test_untouched_partitions_are_not_read(spark, database):
    name = f"{database}.t"
    spark.range(100).selectExpr("id as k", "id % 10 as p").write.partitionBy("p").saveAsTable(name)
    source = spark.createDataFrame([(1, 1), (2, 2)], "k bigint, p bigint")
    touched = _touched(spark.table(name), source, ["p"], 1 << 20)
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString().lower()
    assert touched.count() == 20


def test_the_table_keeps_format_comment_and_properties(spark, database):
    name = f"{database}.t"
    spark.sql(f"CREATE TABLE {name} (k int COMMENT 'key', v string) USING orc COMMENT 'kept' TBLPROPERTIES ('owner.team' = 'x')")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'old'), (2, 'old')")
    before = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    upsert_table(spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string"), name, ["k"])
    assert spark.sql(f"SHOW CREATE TABLE {name}").first()[0] == before
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "old"), (2, "new"), (3, "new")]
    assert all(f.endswith(".orc") for f in spark.table(name).inputFiles())


@pytest.mark.parametrize("by", [None, "p"])
def test_a_replacement_that_is_cut_off_is_finished(spark, database, monkeypatch, by):
    name = f"{database}.t"
    old = spark.createDataFrame([("a", 1), ("b", 2)], "p string, k int").write
    (old.partitionBy(by) if by else old).saveAsTable(name)
    new = spark.createDataFrame([("a", 5)], "p string, k int")
    with monkeypatch.context() as cut, pytest.raises(RuntimeError):
        cut.setattr(tables, "_overwrite", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
        replace_rows(new, name, only_its_partitions=bool(by))
    if not by:
        spark.sql(f"TRUNCATE TABLE {name}")  # as far as a plain overwrite may have come
    finish_replacement(spark, name)
    left = [("a", 5), ("b", 2)] if by else [("a", 5)]
    assert sorted((r.p, r.k) for r in spark.table(name).collect()) == left
    finish_replacement(spark, name)
    assert sorted((r.p, r.k) for r in spark.table(name).collect()) == left


def test_a_copy_that_is_not_complete_is_dropped(spark, database, monkeypatch):
    name = f"{database}.t"
    spark.createDataFrame([(1, "old")], "k int, v string").write.saveAsTable(name)
    files, path = tables._files(spark, f"{tables._pending(spark, name)}/all-1/part-0")
    files.create(path).close()
    upsert_table(spark.createDataFrame([(2, "new")], "k int, v string"), name, ["k"])
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "old"), (2, "new")]


@pytest.mark.parametrize("small", [True, False])
def test_names_of_columns(spark, small):
    """Any name but the reserved ones, which are rejected."""
    names = ["_rows", "_conflict", "_new", "_key_k", "a.b", "_slot"]
    schema = ", ".join(f"`{n}` int" for n in names)
    target, source = (spark.createDataFrame([tuple(range(k, k + 6))], schema) for k in (1, 2))
    for keys in (["_rows"], ["a.b", "_slot"]):
        assert merge(target, source, keys, small).count() == 2
    with pytest.raises(ValueError):
        merge(target.withColumn("_sluice_new", F.lit(1)), source.withColumn("_sluice_new", F.lit(1)), ["_rows"], small)


def test_only_touched_partitions_are_replaced(spark, database):
    name = f"{database}.t"
    rows = [("a", 1, "old"), ("a", 2, "old"), ("b", 1, "old"), ("b", 2, "old"), (None, 1, "old"), ("c", 1, "old")]
    spark.createDataFrame(rows, "p string, k int, v string").write.partitionBy("p").saveAsTable(name)
    files = files_of_partitions(spark, name)
    source = [("a", 1, "new"), ("a", 3, "new"), (None, 1, "new"), ("d", 1, "new")]
    upsert_table(spark.createDataFrame(source, "p string, k int, v string"), name, ["k", "p"])
    after = Counter((r.p, r.k, r.v) for r in spark.table(name).collect())
    old = [row for row in rows if row != ("a", 1, "old")]
    assert after == Counter([*source, *old])
    now = files_of_partitions(spark, name)
    assert {p for p in files if files[p] == now[p]} == {"b", "c"}
    assert scratch_tables(spark) == []


def test_partitioning_stays_where_keys_do_not_include_it(spark, database):
    name = f"{database}.t"
    spark.createDataFrame([("a", 1), ("b", 2)], "p string, k int").write.partitionBy("p").saveAsTable(name)
    upsert_table(spark.createDataFrame([("c", 1), ("c", 3)], "p string, k int"), name, ["k"])
    assert sorted((r.p, r.k) for r in spark.table(name).collect()) == [("b", 2), ("c", 1), ("c", 3)]
    assert partition_columns(spark, name) == ["p"]


def files_of_partitions(spark, name):
    files = spark.table(name).selectExpr("p", "_metadata.file_path as f").distinct()
    return {r.p: sorted(r.f) for r in files.groupBy("p").agg(F.collect_list("f").alias("f")).collect()}


def scratch_tables(spark):
    return spark.sql("SHOW TABLES IN sluice_scratch").filter("not isTemporary").collect()


def test_ambiguous_upsert_leaves_the_table(spark, database):
    name = f"{database}.t"
    spark.createDataFrame(TARGET, SCHEMA).write.saveAsTable(name)
    with pytest.raises(ValueError):
        upsert_table(spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], SCHEMA), name, ["k1", "k2"])
    assert Counter(map(tuple, spark.table(name).collect())) == Counter(TARGET)


def test_target_types_stay(spark):
    target = spark.createDataFrame([(1, "a", None)], "k int, `a.b c` string, m map<string,int>")
    source = spark.createDataFrame([("2", 5, {"x": 1}), ("1", 6, None)], "k string, `a.b c` bigint, m map<string,int>")
    for small in (True, False):
        merged = merge(target, source, ["k", "a.b c"], small)
        assert merged.dtypes == target.dtypes
        rows = sorted(map(tuple, merged.collect()), key=str)
        assert rows == [(1, "6", None), (1, "a", None), (2, "5", {"x": 1})]


def test_columns_must_agree(spark):
    with pytest.raises(ValueError):
        merge(spark.createDataFrame(TARGET, SCHEMA), spark.range(2), ["k1"])


def test_registry(spark, database):
    table = f"{database}.config"
    create_registry(spark, table)
    columns = [(f"c{i * 7 % 30}", "int") for i in range(30)]
    first = shop_spec("/files/shops.csv", "db.stalls", columns=columns, keys=["c7", "c0"])
    register(spark, table, first)
    register(spark, table, shop_spec("/files/sales.parquet", "db.sales", name="sales", header=None, delimiter=None))
    assert lookup(spark, table, "stalls") == first
    changed = shop_spec("/files/shops.csv", "db.stalls", columns=columns, keys=["c1"], write_mode="append")
    register(spark, table, changed)
    assert lookup(spark, table, "stalls") == changed
    assert lookup(spark, table, "sales").header is None
    assert spark.table(table).count() == 2
    with pytest.raises(KeyError):
        lookup(spark, table, "nope")


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_a_target_in_buckets_is_not_shuffled(spark, database, hot_rows):
    """Only the source is, both where keys are counted and where the sides meet; hot keys apart."""
    name = f"{database}.t"
    rows = spark.range(400).selectExpr("if(id < 396, id, null) as k1", "cast(id % 3 as string) as k2", "'old' as v")
    rows.write.bucketBy(5, "k1", "k2").saveAsTable(name)
    target = spark.table(name)
    source = spark.range(0, 800, 2).selectExpr("id as k1", "cast(id % 3 as string) as k2", "'new' as v")
    shared = shared_keys(target, source, ["k1", "k2"], in_buckets=True)
    plan = merge(target, source, ["k1", "k2"], shared=shared)
    plan.collect()
    shown = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert shown.count("Exchange ") == 1 and "SelectedBucketsCount: 5 out of 5" in shown
    expected = sorted(map(str, merge(target, source, ["k1", "k2"], hot_rows=hot_rows).collect()))
    upsert_table(source, name, ["k1", "k2"], 0)
    assert sorted(map(str, spark.table(name).collect())) == expected
    assert bucket_columns(spark, name) == ["k1", "k2"]
    again = spark.table(name).groupBy("k1", "k2").count()
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == len(expected) - 1  # two null keys are alike


def test_ambiguous_keys_of_a_target_in_buckets(spark, database):
    name = f"{database}.t"
    spark.createDataFrame(TARGET, SCHEMA).write.bucketBy(3, "k2", "k1").saveAsTable(name)
    with pytest.raises(ValueError):
        upsert_table(spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], SCHEMA), name, ["k1", "k2"], 0)
    upsert_table(spark.createDataFrame(SOURCE, SCHEMA), name, ["k1", "k2"], 0)
    assert Counter(map(tuple, spark.table(name).collect())) == Counter(MERGED)
