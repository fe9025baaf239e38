"""Every registered query against its SQL, on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(entry.table_queries()) == set(entry.table_sql())


@pytest.mark.parametrize("name", entry.table_queries())
def test_query(spark, sql, name):
    df = entry.table_queries()[name](spark, SF_DIR)
    expected = sql.sql(entry.table_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(
        map(repr, expected.select(*[f'"{c}"' for c in columns]).fetchall())
    )


def test_rows_of_both_tables_are_counted_apart(spark):
    """Each row as often as it is there, null values included; clean rows are counted in their types, and texts made of the counts."""
    clean = spark.sql("select * from values (1, 2, 'a', 'b', date'2024-01-01', 'x'), (1, 2, 'a', 'b', date'2024-01-01', 'x'), "
                      "(1, 2, 'a', 'b', date'2024-01-01', 'y'), (1, 2, null, 'b', null, 'x') as t(k1, k2, f, g, d, run)")  # fmt: skip
    bad = spark.sql("select *, array('r', 's') as reason from values ('1', null, 'a', 'b', '2024-01-01', 7L, 'x'), "
                    "('1', null, 'a', 'b', '2024-01-01', 8L, 'x'), ('1', '2', 'a', 'b', '2024-01-01', 9L, 'x') as t(k1, k2, f, g, d, _sk, run)")  # fmt: skip
    counted = entry._times(clean, bad, "run")
    assert counted.columns == ["k1", "k2", "f", "g", "d", "reason", "run", "times"]
    assert sorted(map(repr, map(tuple, counted.collect()))) == sorted(map(repr, [
        ("1", "2", "a", "b", "2024-01-01", "", "x", 2), ("1", "2", "a", "b", "2024-01-01", "", "y", 1),
        ("1", "2", None, "b", None, "", "x", 1),
        ("1", None, "a", "b", "2024-01-01", "r,s", "x", 2), ("1", "2", "a", "b", "2024-01-01", "r,s", "x", 1),
    ]))
    assert {r.times for r in entry._times(clean.drop("run"), bad.drop("run")).collect()} == {1, 2, 3}


@pytest.mark.parametrize("name", ["append_twice", "rerun_after_cut"])
def test_both_tables_are_not_counted_in_one(spark, name, monkeypatch):
    """No aggregate of all rows as text, which has to hold the groups of both tables at once."""
    write, rows = entry._raw_lines, 200
    monkeypatch.setattr(entry, "_raw_lines", lambda *a: write(*a).limit(rows))
    plan = entry.table_queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union" and plan.toString().count("Aggregate [") == 2


def test_entry(spark):
    assert entry.entry(spark).count() > 0
