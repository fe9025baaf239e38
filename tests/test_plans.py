"""What the plans read and shuffle."""

import re

import pytest
from pyspark.sql import functions as F
from shops import shop_spec

from sluice.operators.checks import (
    accept,
    bad_records,
    clean_records,
    duplicate_records,
    invalid_records,
    null_key_records,
    reject,
    with_row_id,
)
from sluice.operators.duplicates import KEY_DUPLICATE, ROW_DUPLICATE, flag_repeated, flag_unrepeated, repeated_keys
from sluice.operators.marts import daily_sales
from sluice.operators.merge import merge
from sluice.operators.skew import key_counts


@pytest.fixture(scope="module")
def shops(spark, tmp_path_factory):
    """A table with two keys that repeat and 98 that do not; `extra` is in no spec."""
    path = str(tmp_path_factory.mktemp("plans") / "shops.parquet")
    spark.range(100).selectExpr(
        "cast(if(id < 4, id % 2, id) as string) as stall",
        "concat('n', id) as label",
        "'b' as zone",
        "'2024-03-10' as since",
        "id as extra",
    ).write.parquet(path)
    return with_row_id(spark.read.parquet(path), SPEC)


SPEC = shop_spec("x.csv", keys=["stall"])


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.collect()
    return initial(df).split("== Initial Plan ==")[0]


def shuffles(plan):
    return len(re.findall(r"\bExchange ", plan))


def read_columns(plan):
    return [sorted(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


@pytest.mark.parametrize("records", [invalid_records, null_key_records])
def test_row_checks_do_not_shuffle(shops, records):
    assert shuffles(initial(records(shops, SPEC))) == 0


def test_one_shuffle_and_one_sort_for_both_windows(shops):
    """Rows with a null key go around both."""
    plan = final(bad_records(shops, SPEC))
    assert (shuffles(plan), plan.count("Window "), plan.count("Sort ")) == (1, 2, 1)


def test_without_hot_keys_the_rows_are_read_once_and_null_keys_once_more(shops):
    columns = ["label", "since", "stall", "zone"]
    assert read_columns(final(clean_records(shops, SPEC))) == [columns]
    assert read_columns(final(bad_records(shops, SPEC))) == [columns, columns]
    assert "Python" not in final(bad_records(shops, SPEC))


def test_copies_alone_need_one_window(shops):
    plan = final(duplicate_records(shops, SPEC, only="_row_duplicate"))
    assert (shuffles(plan), plan.count("Window ")) == (1, 1)


def test_keys_are_counted_on_key_columns_alone(shops):
    plan = final(key_counts(shops, SPEC.keys, above=1))
    assert read_columns(plan) == [["stall"]]
    assert "PushedFilters: [IsNotNull(stall)]" in plan
    assert "partial_count" in plan


def test_rows_with_a_key_of_their_own_are_not_shuffled(spark, shops):
    repeated = repeated_keys(shops, SPEC)
    once = flag_unrepeated(shops, repeated)
    assert shuffles(initial(once)) == 0 and once.count() == 96
    assert flag_repeated(shops, SPEC, repeated).count() == 4


def test_upsert_with_a_small_source_does_not_shuffle_the_target(spark, shops, tmp_path):
    target = shops.drop("_sk")
    source = target.limit(3).withColumn("zone", target.since)
    plan = final(merge(target, source, ["stall", "label"], small_source=True))
    assert "SortMergeJoin" not in plan
    carried = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert all("zone" not in columns for columns in carried)


def test_mart_needs_one_combined_shuffle(spark, shops):
    sales = spark.read.parquet(shops.inputFiles()[0].rsplit("/", 1)[0]).selectExpr(
        "stall as shop_id", "date(since) as sales_date", "cast(extra as decimal(18,2)) as sales_amt"
    )
    once = shops.selectExpr("stall as shop_id").distinct()
    plan = final(daily_sales(sales, once, few_repeated=True))
    assert "Join" not in plan and shuffles(plan) == 1 and "partial_sum" in plan


def test_a_merge_looks_at_the_keys_of_both_sides_once(spark, shops, monkeypatch):
    """One shuffle of key columns, in which both sides are counted together; then the join, each side shuffled once."""
    from sluice.operators import merge as module

    looks = []

    def noted(df):
        looks.append(final(df))
        return written(df)

    written = module.written_once
    monkeypatch.setattr(module, "written_once", noted)
    target = shops.drop("_sk")
    source = target.filter("stall <> '0' and stall <> '1'").withColumn("zone", target.since)
    plan = final(merge(target, source, ["stall"]))
    assert len(looks) == 1 and shuffles(looks[0]) == 1 and read_columns(looks[0]) == [["stall"], ["stall"]]
    assert shuffles(plan) == 2


def test_checks_that_match_no_text_come_first(shops):
    """A row that is bad by its duplicates or a null key is not matched with patterns to tell that it is."""
    flagged = with_row_id(shops, SPEC, F.col("_sk")).withColumns({n: F.col("_sk") % 2 == 0 for n in (ROW_DUPLICATE, KEY_DUPLICATE)})
    for df in (reject(flagged, SPEC), accept(flagged, SPEC)):
        kept = next(line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in line)
        assert "RLIKE" in kept and kept.index("% 2") < kept.index("RLIKE")
