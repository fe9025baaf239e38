"""Aggregates of clean sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, IntegralType, StringType

from sluice.functions.names import OWN, check_names, named
from sluice.operators.skew import HOT_ROWS, join_facts
from sluice.plans.sizes import BROADCAST_BYTES

SHOPS = f"{OWN}shops"


def daily_sales(
    sales: DataFrame,
    shops: DataFrame,
    key: str = "shop_id",
    date: str = "sales_date",
    amount: str = "sales_amt",
    few_repeated: bool = False,
) -> DataFrame:
    """Sales left-joined to shops, per day: floored sum and average, number of amounts, greatest amount.

    A sale counts once for each shop row with its key, and once if there is none. `few_repeated` says that
    `repeated_shops` has been found small enough to broadcast; then the sales are only shuffled by day, combined.
    """
    return sales_per_day(sales, repeated_shops(sales, shops, key), key, date, amount, few_repeated)


def repeated_shops(sales: DataFrame, shops: DataFrame, key: str = "shop_id") -> DataFrame:
    """The keys with several shops, and how many (`SHOPS`). Nothing else of the shops bears on the result."""
    check_names(sales.columns, shops.columns)
    ours, theirs = sales.schema[key].dataType, shops.schema[key].dataType
    shop = named(key)
    if isinstance(theirs, StringType) and not isinstance(ours, StringType):
        shop = shop.try_cast(ours)  # text that is no such value matches no sale
    return (
        shops.select(shop.alias(key))
        .filter(named(key).isNotNull())
        .groupBy(named(key))
        .agg(F.count("*").alias(SHOPS))
        .filter(F.col(SHOPS) > 1)
    )


def sales_per_day(
    sales: DataFrame,
    repeated: DataFrame,
    key: str = "shop_id",
    date: str = "sales_date",
    amount: str = "sales_amt",
    few_repeated: bool = False,
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """`daily_sales`, given `repeated_shops`.

    A sale is weighted by its number of shops instead of being multiplied into rows, whatever the two sides
    hold for one key.
    """
    theirs = repeated.schema[key].dataType
    if isinstance(sales.schema[key].dataType, StringType) and not isinstance(theirs, StringType):
        sales = sales.withColumn(key, named(key).try_cast(theirs))
    times = F.coalesce(F.col(SHOPS), F.lit(1).cast("long"))
    value = _summable(sales, amount)
    total = F.sum(F.when(F.col(SHOPS).isNull(), value).otherwise(value * F.col(SHOPS)))
    sales = sales.select(named(key), named(date), named(amount))
    if few_repeated:
        weighted = sales.join(F.broadcast(repeated), key, "left")
    else:
        weighted = join_facts(sales, repeated, [key], "left", hot_rows, limit)
    return (
        weighted.groupBy(named(date))
        .agg(
            # The names of the mart's columns.
            F.floor(total).cast("long").alias("sum_sales"),
            F.floor(total / F.sum(F.when(value.isNotNull(), times))).cast("long").alias("avg_sales"),
            F.coalesce(F.sum(F.when(named(amount).isNotNull(), times)), F.lit(0).cast("long")).alias("bucket_count"),
            F.max(named(amount)).alias("max_sales"),
        )
    )


def with_compute_date(df: DataFrame) -> DataFrame:
    # Fixed value: the name of the mart's control column.
    return df.withColumn("compute_date", F.current_timestamp())


def _summable(df: DataFrame, column: str) -> Column:
    """Decimals and whole numbers sum exactly as they are; floats and text sum as doubles."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, DecimalType | IntegralType):
        return named(column)
    return named(column).try_cast("double") if isinstance(data_type, StringType | FloatType) else named(column)
