"""A mart of which only the months that changed are written."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sluice.plans.pipeline import MONTH, load_daily_sales, refresh_daily_sales
from sluice.sources import tables

SALES = "shop_id int, sales_date date, sales_amt decimal(18,2)"
OLD = [(1, date(2024, 1, 5), 10), (2, date(2024, 2, 1), 20), (2, date(2024, 2, 28), 5), (1, date(2024, 3, 1), 7), (1, None, 3)]


def sales_of(spark, rows):
    return spark.createDataFrame([(s, d, None if a is None else a) for s, d, a in rows], "shop_id int, sales_date date, sales_amt int").select(
        "shop_id", "sales_date", F.col("sales_amt").cast("decimal(18,2)")
    )


def files(spark, name):
    rows = spark.table(name).select(MONTH, "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {(r[0], r[1], r[2]) for r in rows}


def mart(spark, name):
    rows = spark.table(name).drop("compute_date").collect()
    return sorted(((str(r.sales_date), r[MONTH], r.sum_sales, r.bucket_count) for r in rows), key=str)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_only_months_that_changed(spark, database, limit):
    name = f"{database}.mart"
    shops = spark.createDataFrame([(1,), (2,), (2,)], "shop_id int")
    load_daily_sales(sales_of(spark, OLD), shops, name, by_month=True)
    before = files(spark, name)
    new = [r for r in OLD if r[1] is None or r[1].month != 3] + [(1, date(2024, 2, 2), 9), (2, date(2024, 4, 1), 1), (1, None, 4)]
    days = sales_of(spark, [(0, date(2024, 2, 2), 0), (0, date(2024, 4, 1), 0), (0, date(2024, 3, 9), 0), (0, None, 0)]).select("sales_date")
    refresh_daily_sales(sales_of(spark, new), shops, name, days, broadcast_bytes=limit)
    again = f"{database}.whole"
    load_daily_sales(sales_of(spark, new), shops, again, by_month=True)
    assert mart(spark, name) == mart(spark, again) and len(mart(spark, name)) == 6
    now = files(spark, name)
    assert {f for f in before if f[0] == "2024-01"} == {f for f in now if f[0] == "2024-01"}
    assert not {f for f in before if f[0] == "2024-02"} & now and "2024-03" not in {f[0] for f in now}


def test_an_interrupted_refresh_is_finished(spark, database, monkeypatch):
    name = f"{database}.mart"
    shops = spark.createDataFrame([(1,)], "shop_id int")
    load_daily_sales(sales_of(spark, OLD), shops, name, by_month=True)
    new = [*OLD, (1, date(2024, 2, 2), 9)]
    days = sales_of(spark, new[-1:]).select("sales_date")
    with monkeypatch.context() as cut, pytest.raises(RuntimeError):
        cut.setattr(tables, "_overwrite", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
        refresh_daily_sales(sales_of(spark, new), shops, name, days)
    refresh_daily_sales(sales_of(spark, new), shops, name, days.filter("false"))
    load_daily_sales(sales_of(spark, new), shops, f"{database}.whole", by_month=True)
    assert mart(spark, name) == mart(spark, f"{database}.whole")


def test_a_mart_that_is_not_partitioned_is_refused(spark, database):
    load_daily_sales(sales_of(spark, OLD), spark.createDataFrame([(1,)], "shop_id int"), f"{database}.mart")
    with pytest.raises(ValueError):
        refresh_daily_sales(sales_of(spark, OLD), spark.range(0).toDF("shop_id"), f"{database}.mart", sales_of(spark, OLD).select("sales_date"))
