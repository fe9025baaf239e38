import os
from datetime import date
from types import SimpleNamespace

import pytest
from shops import BAD, CLEAN_IDS, LINES, reasons_of, shop_spec, write_shops

from sluice import TableSpec, load_checked, load_raw, run
from sluice.plans.pipeline import load_daily_sales
from sluice.sources.files import file_format, read_file, with_provenance
from sluice.sources.tables import (
    create_or_replace_table,
    drop_paths,
    drop_scratch,
    read_table,
    scratch_database,
    scratch_path,
    scratch_scope,
    shared_folder,
    write_table,
)


def scratch_tables(spark):
    return spark.sql("SHOW TABLES IN sluice_scratch").filter("not isTemporary").collect()


def test_raw_table(spark, database, tmp_path):
    path = write_shops(tmp_path)
    spec = shop_spec(path, f"{database}.stalls")
    load_raw(spark, spec)
    load_raw(spark, spec)
    raw = spark.table(f"{database}.stalls_bronze")
    assert dict(raw.dtypes) == {
        "stall": "string",
        "label": "string",
        "zone": "string",
        "since": "string",
        "_load_dt": "date",
        "_load_dttm": "timestamp",
        "_file_name": "string",
        "_file_path": "string",
        "_file_size": "bigint",
        "_file_mod": "timestamp",
    }
    rows = raw.collect()
    assert len(rows) == len(LINES) - 1
    assert {(r._file_name, r._file_size) for r in rows} == {(path.name, path.stat().st_size)}
    assert rows[0]._file_path.endswith(f"/{path.name}")


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_checked_tables(spark, database, tmp_path, broadcast_bytes, hot_rows):
    spec = shop_spec(write_shops(tmp_path), f"{database}.stalls")
    load_raw(spark, spec)
    load_checked(spark, spec, hot_rows, broadcast_bytes)
    clean = spark.table(f"{database}.stalls_silver")
    assert clean.dtypes == [
        ("stall", "int"),
        ("label", "string"),
        ("zone", "string"),
        ("since", "date"),
        ("load_dt", "date"),
        ("load_dttm", "timestamp"),
    ]
    assert [r.stall for r in clean.sort("stall").collect()] == CLEAN_IDS
    assert {r.since for r in clean.collect()} == {date(2024, 3, 1), date(2024, 3, 2), date(2024, 3, 6), None}
    assert reasons_of(spark.table(spec.bad_table)) == sorted(BAD, key=str)
    assert scratch_tables(spark) == []


@pytest.mark.parametrize("mode, times", [("overwrite", 1), ("append", 2)])
def test_write_modes(spark, database, tmp_path, mode, times):
    spec = shop_spec(write_shops(tmp_path), f"{database}.stalls", write_mode=mode)
    run(spark, [spec])
    run(spark, [spec])
    assert spark.table(spec.clean_table).count() == times * len(CLEAN_IDS)
    assert spark.table(spec.bad_table).count() == 2 * len(BAD)


def test_files_to_mart(spark, database, tmp_path):
    sales_path = str(tmp_path / "sales.parquet")
    sales = [
        (1, 46, 2, "10.50", date(2024, 4, 1)),
        (2, 47, 1, "4.00", date(2024, 4, 1)),
        (2, 47, 1, "4.00", date(2024, 4, 1)),
        (3, 46, 1, "1.00", date(2024, 4, 1)),
        (3, 46, 9, "1.00", date(2024, 4, 1)),
        (4, 41, 1, "7.25", date(2024, 4, 2)),
        (-4, 40, 1, "7.25", date(2024, 4, 2)),
        (None, 40, 1, "7.25", date(2024, 4, 2)),
    ]
    schema = "ticket int, stall int, pieces int, paid string, day date"
    spark.createDataFrame(sales, schema).write.parquet(sales_path)
    columns = {"ticket": "int", "stall": "int", "pieces": "int", "paid": "decimal(18,2)", "day": "date"}
    fact = TableSpec("tickets", sales_path, f"{database}.tickets", columns, ["ticket", "stall"])
    shop = shop_spec(write_shops(tmp_path), f"{database}.stalls")
    run(spark, [shop, fact])
    clean = spark.table(fact.clean_table), spark.table(shop.clean_table)
    load_daily_sales(*clean, f"{database}.mart", key="stall", date="day", amount="paid")
    mart = spark.table(f"{database}.mart").drop("compute_date").withColumnRenamed("max_sales", "m")
    # Stall 41 stands in two zones: its ticket counts twice.
    assert [(*r[:4], str(r.m)) for r in mart.sort("day").collect()] == [
        (date(2024, 4, 1), 14, 7, 2, "10.50"),
        (date(2024, 4, 2), 14, 7, 2, "7.25"),
    ]
    assert sorted((r.ticket or 0, r.reason[0]) for r in spark.table(fact.bad_table).collect()) == [
        (-4, "_is_ticket_invalid"),
        (0, "_is_ticket_null"),
        (2, "_row_duplicate"),
        (3, "_key_duplicate"),
        (3, "_key_duplicate"),
    ]


def test_format_by_extension():
    assert file_format("/a/b.c/stalls_20240310.csv") == "csv"
    assert file_format("s3://bucket/sales.parquet/") == "parquet"
    for path in ("/a/b.json", "/a/csv/", "/a/b.CSV"):
        with pytest.raises(ValueError):
            file_format(path)


def test_parquet_keeps_its_types(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    spark.range(3).write.parquet(path)
    df = with_provenance(read_file(spark, path))
    assert df.dtypes[0] == ("id", "bigint")
    assert all(r._file_name.endswith(".parquet") for r in df.collect())


def test_table_writes(spark, database):
    name = f"{database}.t"
    create_or_replace_table(spark, name, "a int, m map<string,string>")
    assert read_table(spark, name).dtypes == [("a", "int"), ("m", "map<string,string>")]
    write_table(spark.range(2), name, "overwrite")
    write_table(spark.range(3), name, "append")
    assert read_table(spark, name).columns == ["id"] and read_table(spark, name).count() == 5
    write_table(spark.range(2).selectExpr("id", "id as b"), name, "overwrite")
    assert read_table(spark, name).columns == ["id", "b"]


def test_spec_is_checked():
    for changes in (
        {"keys": []},
        {"keys": ["nope"]},
        {"write_mode": "ignore"},
        {"path": "x.json"},
        {"columns": {"stall": "int", "zone": "string", "_sk": "int"}},
        {"columns": {"stall": "int", "zone": "string", "_sluice_rows": "int"}},
        {"columns": [("stall", "int"), ("zone", "int"), ("stall", "int")]},
    ):
        with pytest.raises(ValueError):
            shop_spec(**{"path": "x.csv", **changes})


def test_shared_folder_is_the_one_the_session_names_or_in_the_warehouse(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda name, *_: "/wh/" if "warehouse" in name else None))
    assert shared_folder(unset) == "/wh/_sluice"


def test_scratch_is_removed_when_asked(spark):
    database, folder = scratch_database(spark)
    spark.range(2).write.saveAsTable(f"{database}.t")
    spark.range(2).write.parquet(f"{folder}/x")
    drop_scratch(spark)
    assert not spark.catalog.databaseExists(database) and not os.path.exists(folder)


def test_scratch_paths_of_a_scope(spark):
    outside = scratch_path(spark)
    with scratch_scope() as made:
        first = scratch_path(spark)
        with scratch_scope() as inner:
            second = scratch_path(spark, ".csv")
        third = scratch_path(spark)
    assert (made, inner) == ([first, third], [second]) and outside not in made
    for path in (first, outside):
        spark.range(2).write.parquet(path)
    drop_paths(spark, made)  # one of them was never written
    assert not os.path.exists(first) and os.path.exists(outside)
    drop_scratch(spark)
