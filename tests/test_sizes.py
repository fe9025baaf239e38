from sluice.operators.skew import ROWS, listed_keys, rows_with, rows_without
from sluice.plans.sizes import fits_broadcast, measured


def test_size_is_measured(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) as text", "cast(null as string) as n")
    assert measured(df, 1 << 20) == (1000, True)
    assert not fits_broadcast(df, 100_000)
    assert not fits_broadcast(df, 1 << 20, file_bytes=2 << 20)
    assert fits_broadcast(df.filter("id < 0"), 0)


def test_listed_keys_are_counted_once_and_measured(spark):
    rows = spark.range(1000).selectExpr("id % 7 as k", "if(id < 3, null, id % 2) as k2", "id as v")
    listed = listed_keys(rows, ["k", "k2"], 70)
    assert (listed.count, listed.few) == (14, True)
    assert not listed_keys(rows, ["k", "k2"], 70, 10).few
    above = listed.above(71)
    assert above.count == listed.rows.filter(f"{ROWS} > 71").count() < 14
    for limit in (0, 1 << 20):
        some = listed_keys(rows, ["k", "k2"], 71, limit)
        assert rows_with(rows, some).count() + rows_without(rows, some).count() == 1000
        assert rows_without(rows, some).filter("k2 is null").count() == 3
