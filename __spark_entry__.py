
from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluice.functions.flags import flags_to_rows  # noqa: E402
from sluice.functions.formats import typed  # noqa: E402
from sluice.operators.checks import (  # noqa: E402
    bad_records,
    clean_records,
    duplicate_records,
    format_flags,
    invalid_records,
    null_key_flags,
    null_key_records,
    reject,
    with_row_id,
)
from sluice.operators.duplicates import (  # noqa: E402
    KEY_DUPLICATE,
    ROW_DUPLICATE,
    flag_repeated,
    flag_unrepeated,
    repeated_bits,
    repeated_keys,
    with_duplicate_flags,
)
from sluice.operators.marts import daily_sales, repeated_shops, sales_per_day, with_compute_date  # noqa: E402
from sluice.operators.merge import merge  # noqa: E402
from sluice.plans.pipeline import (  # noqa: E402
    days_of_run,
    load_daily_sales,
    refresh_daily_sales,
    run,
    run_each,
    upsert_table,
)
from sluice.plans.registry import create_registry, lookup, register  # noqa: E402
from sluice.plans.sizes import fits_broadcast  # noqa: E402
from sluice.plans.spec import TableSpec  # noqa: E402
from sluice.sources.files import read_file, with_provenance  # noqa: E402
from sluice.sources.tables import (  # noqa: E402
    RUN,
    create_or_replace_table,
    drop_table,
    read_table,
    scratch_database,
    scratch_path,
    write_table,
)

# ---------------------------------------------------------------- inputs

LINES = TableSpec(
    name="lines",
    file_path="lines.csv",
    table_name="lines",
    columns={"k1": "int", "k2": "int", "f": "string", "g": "string", "d": "date"},
    keys=["k1", "k2"],
    header=True,
    delimiter="|",
)

SHIPMENTS = TableSpec(
    name="shipments",
    file_path="shipments.parquet",
    table_name="shipments",
    columns={"supplier": "int", "day": "date", "f": "string", "g": "string"},
    keys=["supplier", "day"],
)
# No list of keys is short enough to broadcast, a bitmap of up to 32 MB is.
SHORT_LIST, SHORT_BITS = 0, 64 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_file(spark, f"{sf_dir}/{name}.parquet")


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem as text, with null keys, wrong numbers and wrong dates written into some rows."""
    return _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey").cast("string")).alias("k1"),
        F.when(F.col("l_partkey") % 89 == 0, "x").otherwise(F.col("l_linenumber").cast("string")).alias("k2"),
        F.col("l_returnflag").alias("f"),
        F.col("l_linestatus").alias("g"),
        F.when(F.col("l_suppkey") % 7 == 0, F.date_format("l_shipdate", "yyyyMMdd"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-01"))
        .alias("d"),
    )


RAW_LINES_SQL = """
b as (
  select case when l_orderkey % 97 <> 0 then cast(l_orderkey as varchar) end as k1,
         case when l_partkey % 89 = 0 then 'x' else cast(l_linenumber as varchar) end as k2,
         l_returnflag as f, l_linestatus as g,
         case when l_suppkey % 7 = 0 then strftime(l_shipdate, '%Y%m%d')
              else strftime(l_shipdate, '%Y-%m-01') end as d
  from lineitem),
w as (
  select *, (k1 is null or k2 is null) as kn,
         row_number() over (partition by k1, k2, f, g, d) as rn from b),
x as (
  select *, sum(case when rn = 1 then 1 else 0 end) over (partition by k1, k2) as kc from w),
flags as (
  select k1, k2, f, g, d,
         coalesce(not regexp_matches(d, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), false) as _is_d_invalid,
         coalesce(not regexp_matches(k1, '^[0-9]+$'), false) as _is_k1_invalid,
         k1 is null as _is_k1_null,
         coalesce(not regexp_matches(k2, '^[0-9]+$'), false) as _is_k2_invalid,
         k2 is null as _is_k2_null,
         not kn and rn = 1 and kc > 1 as _key_duplicate,
         not kn and rn > 1 as _row_duplicate
  from x)
"""

SHIPMENTS_SQL = """
with w as (
  select cast(l_suppkey as varchar) as supplier, strftime(l_shipdate, '%Y-%m-%d') as day, l_returnflag as f, l_linestatus as g,
         row_number() over (partition by l_suppkey, strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, l_linestatus) as rn
  from lineitem),
x as (select *, sum(case when rn = 1 then 1 else 0 end) over (partition by supplier, day) as kc from w)
select supplier, day, f, g, case when rn > 1 then '_row_duplicate' else '_key_duplicate' end as reason
from x where rn > 1 or kc > 1
"""

INVALID = ["_is_d_invalid", "_is_k1_invalid", "_is_k2_invalid"]
NULL_KEY = ["_is_k1_null", "_is_k2_null"]
DUPLICATE = ["_key_duplicate", "_row_duplicate"]


ALL = sorted(INVALID + NULL_KEY + DUPLICATE)
MALFORMED = sorted([*ALL, "_is_row_malformed"])

#: Rows of `_lines_of_any_length`: the malformed ones are no twins of others.
MALFORMED_SQL = """
b as (
  select case when l_orderkey % 97 <> 0 then cast(l_orderkey as varchar) end as k1,
         case when l_partkey % 89 = 0 then 'x' else cast(l_linenumber as varchar) end as k2,
         case when l_quantity = 48 then l_returnflag || '|' else l_returnflag end as f, l_linestatus as g,
         case when l_quantity <> 50 then strftime(l_shipdate, '%Y-%m-01') end as d,
         l_quantity in (49, 50) as _is_row_malformed,
         case l_quantity when 49 then concat_ws('|', coalesce(k1, ''), k2, f, g, d, 'more')
                         when 50 then concat_ws('|', coalesce(k1, ''), k2, f, g) end as _malformed_row
  from lineitem),
w as (
  select *, (k1 is null or k2 is null or _is_row_malformed) as kn,
         row_number() over (partition by _is_row_malformed, k1, k2, f, g, d) as rn from b),
x as (
  select *, sum(case when rn = 1 then 1 else 0 end) over (partition by _is_row_malformed, k1, k2) as kc from w),
flags as (
  select k1, k2, f, g, d, _malformed_row, _is_row_malformed,
         false as _is_d_invalid,
         coalesce(not regexp_matches(k1, '^[0-9]+$'), false) as _is_k1_invalid,
         k1 is null as _is_k1_null,
         coalesce(not regexp_matches(k2, '^[0-9]+$'), false) as _is_k2_invalid,
         k2 is null as _is_k2_null,
         not kn and rn = 1 and kc > 1 as _key_duplicate,
         not kn and rn > 1 as _row_duplicate
  from x)
"""


def _reason_names(flags: list[str]) -> str:
    return ", ".join(f"case when {f} then '{f}' end" for f in sorted(flags))


def _records_sql(flags: list[str]) -> str:
    return (
        f"with {RAW_LINES_SQL} select k1, k2, f, g, d, concat_ws(',', {_reason_names(flags)}) as reason "
        f"from flags where {' or '.join(flags)}"
    )


def _records(records: DataFrame) -> DataFrame:
    """Reasons as one text, without the row number, which differs from read to read."""
    return records.drop("_sk").withColumn("reason", F.array_join("reason", ","))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_id(_raw_lines(spark, sf_dir), LINES)


def _money(column: str) -> F.Column:
    return F.col(column).cast("decimal(18,2)")


# ---------------------------------------------------------------- scans


def scan_parquet_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns, and the provenance columns in forms that can be checked."""
    read = with_provenance(_table(spark, sf_dir, "orders"))
    return read.select(*[c for c in read.columns if not c.startswith("_")], "_file_name", *_checked_provenance())


def _checked_provenance() -> list[F.Column]:
    return [
        (F.col("_load_dt") == F.current_date()).alias("loaded_today"),
        (F.to_date("_load_dttm") == F.col("_load_dt")).alias("same_day"),
        F.endswith("_file_path", F.concat(F.lit("/"), F.col("_file_name"))).alias("path_ends_in_name"),
        (F.col("_file_size") > 0).alias("has_bytes"),
        (F.col("_file_mod") <= F.col("_load_dttm")).alias("written_before"),
    ]


def scan_csv_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, ".csv")
    _raw_lines(spark, sf_dir).write.option("header", True).option("delimiter", "|").csv(path)
    read = with_provenance(read_file(spark, path, header="true", delimiter="|"))
    in_folder = F.contains("_file_path", F.lit(path.rsplit("/", 1)[-1])) & F.endswith("_file_name", F.lit(".csv"))
    return read.select(*LINES.column_names, in_folder.alias("from_csv"), *_checked_provenance())


def scan_table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)[0]}.customer"
    write_table(_table(spark, sf_dir, "customer"), name, "overwrite")
    return read_table(spark, name)


# ---------------------------------------------------------------- checks


def project_cast_by_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [typed(c, t) for c, t in LINES.columns]
    valid = _raw_lines(spark, sf_dir).withColumns(format_flags(LINES))
    for flag in format_flags(LINES):
        valid = valid.filter(~F.col(flag))
    return _dates_as_text(valid.filter("k1 is not null").select(*columns))


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("d", F.col("d").cast("string"))


def format_flags_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_lines(spark, sf_dir).withColumns(format_flags(LINES))


def flags_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {**format_flags(LINES), **null_key_flags(LINES)}
    flagged = _raw_lines(spark, sf_dir).withColumns(flags)
    return flags_to_rows(flagged, list(flags), LINES.column_names)


def invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(invalid_records(_rows(spark, sf_dir), LINES))


def null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(null_key_records(_rows(spark, sf_dir), LINES))


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(duplicate_records(_rows(spark, sf_dir), LINES))


def row_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(duplicate_records(_rows(spark, sf_dir), LINES, only=ROW_DUPLICATE))


def key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(duplicate_records(_rows(spark, sf_dir), LINES, only=KEY_DUPLICATE))


def bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(bad_records(_rows(spark, sf_dir), LINES))


def bad_all_keys_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated key takes the way of the hot ones. They are counted once."""
    rows = _rows(spark, sf_dir)
    return _records(reject(with_duplicate_flags(rows, LINES, 1, repeated_keys(rows, LINES)), LINES))


def bad_few_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a key of their own are told from the others first, and not shuffled if the list of these is small."""
    rows = _rows(spark, sf_dir)
    repeated = repeated_keys(rows, LINES)
    flagged = flag_unrepeated(rows, repeated).unionByName(flag_repeated(rows, LINES, repeated))
    return _records(reject(flagged, LINES))


def bad_many_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the rows share their key. The list of these keys is taken as too long to broadcast, its bitmap is not: rows
    whose bit is not set are not shuffled."""
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("supplier"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.col("l_returnflag").alias("f"),
        F.col("l_linestatus").alias("g"),
    )
    rows = with_row_id(lines, SHIPMENTS)
    repeated = repeated_keys(rows, SHIPMENTS, SHORT_LIST)
    bits = repeated_bits(repeated, SHORT_BITS)
    flagged = flag_unrepeated(rows, repeated, bits=bits)
    flagged = flagged.unionByName(flag_repeated(rows, SHIPMENTS, repeated, limit=SHORT_BITS, bits=bits))
    return _records(reject(flagged, SHIPMENTS))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(clean_records(_rows(spark, sf_dir), LINES))


# ---------------------------------------------------------------- marts and upserts


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("shop_id"),
        F.to_date("l_shipdate").alias("sales_date"),
        _money("l_extendedprice").alias("sales_amt"),
    )


def _daily_sales(sales: DataFrame, shops: DataFrame) -> DataFrame:
    """Broadcast the repeated shops if a look at their size allows it."""
    return daily_sales(sales, shops, few_repeated=fits_broadcast(repeated_shops(sales, shops)))


def _mart(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"sales_date": F.col("sales_date").cast("string"), "max_sales": F.col("max_sales").cast("double")}
    )


def daily_sales_by_ship_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = _table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "shop_id")
    return _mart(_daily_sales(_sales(spark, sf_dir), shops))


def daily_sales_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to their lines: an order counts once for each line."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("shop_id"),
        F.to_date("o_orderdate").alias("sales_date"),
        _money("o_totalprice").alias("sales_amt"),
    )
    lines = _table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "shop_id")
    return _mart(_daily_sales(orders, lines))


def daily_sales_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shops: keys as text, some of them no number, some repeated."""
    shops = _table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", "x")
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("shop_id")
    )
    return _mart(_daily_sales(_sales(spark, sf_dir), shops))


def daily_sales_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined by a shuffle; shops above a thousand sales are spread."""
    sales = _sales(spark, sf_dir)
    nations = _table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "shop_id")
    return _mart(sales_per_day(sales, repeated_shops(sales, nations), hot_rows=1000))


def daily_sales_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = with_compute_date(daily_sales_by_ship_date(spark, sf_dir))
    is_time = stamped.schema["compute_date"].dataType.simpleString() == "timestamp"
    today = F.lit(is_time) & (F.to_date("compute_date") == F.current_date())
    return stamped.withColumn("stamped", today).drop("compute_date")


def _order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("orderkey"))
        .agg(
            F.max("l_linestatus").alias("status"),
            F.sum(_money("l_extendedprice")).cast("double").alias("amount"),
        )
    )


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders updated with the status and the sum of their lines; orders without lines stay."""
    return merge(_order_amounts(spark, sf_dir), _line_totals(spark, sf_dir), ["orderkey"])


def upsert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, several to a key, updated with their order; orders without lines are inserted."""
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_returnflag").alias("status"),
        F.col("l_extendedprice").alias("amount"),
    )
    return merge(lines, _order_amounts(spark, sf_dir), ["orderkey"])


def upsert_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys; suppliers updated from customers of the same number and nation, the other customers inserted."""
    names = ["key", "name", "nation", "balance"]
    suppliers = _table(spark, sf_dir, "supplier").toDF(*names)
    customers = _table(spark, sf_dir, "customer").drop("c_mktsegment").toDF(*names)
    return merge(suppliers, customers, ["key", "nation"])


# ---------------------------------------------------------------- through tables


def upsert_orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`upsert_orders` on a table."""
    table = f"{scratch_database(spark)[0]}.orders"
    write_table(_order_amounts(spark, sf_dir), table, "overwrite")
    upsert_table(_line_totals(spark, sf_dir), table, ["orderkey"])
    return read_table(spark, table)


def upsert_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, updated from lines by order and status; a status without lines is neither read nor written."""
    table = f"{scratch_database(spark)[0]}.orders"
    _order_amounts(spark, sf_dir).write.partitionBy("status").saveAsTable(table)
    lines = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("orderkey"), F.col("l_linestatus").alias("status"))
        .agg(F.sum(_money("l_extendedprice")).cast("double").alias("amount"))
    )
    upsert_table(lines, table, ["orderkey", "status"])
    return read_table(spark, table)


def upsert_bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`upsert_orders` on a table in buckets by order, which is not shuffled though the source is taken as a large one."""
    table = f"{scratch_database(spark)[0]}.orders"
    _order_amounts(spark, sf_dir).write.bucketBy(8, "orderkey").saveAsTable(table)
    upsert_table(_line_totals(spark, sf_dir), table, ["orderkey"], broadcast_bytes=0)
    return read_table(spark, table)


def upsert_partitioned_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the first day of their year, as dates; the source, finished orders of the first years, has these days as times of the
    day, and keys as text."""
    table = f"{scratch_database(spark)[0]}.orders"
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("amount"),
        F.trunc(F.to_date("o_orderdate"), "year").alias("day"),
        F.col("o_orderstatus").alias("status"),
    )
    orders.drop("status").write.partitionBy("day").saveAsTable(table)
    source = orders.filter("status = 'F' and year(day) < 1997").select(
        F.col("orderkey").cast("string"),
        F.lit(0.5).alias("amount"),
        (F.col("day").cast("timestamp") + F.expr("interval 12 hours")).alias("day"),
    )
    upsert_table(source, table, ["orderkey", "day"])
    return read_table(spark, table).withColumn("day", F.col("day").cast("string"))


def replace_with_new_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is written, written anew with other columns, emptied with others again, and added to."""
    database = scratch_database(spark)[0]
    name, kept = f"{database}.t", f"{database}.kept"
    write_table(_table(spark, sf_dir, "customer"), name, "overwrite")
    write_table(_table(spark, sf_dir, "orders"), name, "overwrite")
    replaced = read_table(spark, name)
    columns = F.lit(", ".join(replaced.columns)).alias("columns")
    write_table(replaced.select(columns, F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount")), kept, "overwrite")
    create_or_replace_table(spark, name, "columns string, key bigint, amount double")
    write_table(read_table(spark, kept), name, "append")
    customers = _table(spark, sf_dir, "customer").select(F.lit("customer"), "c_custkey", "c_acctbal")
    write_table(customers.toDF("columns", "key", "amount"), name, "append")
    return read_table(spark, name)


def append_other_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, then suppliers with a column less and one more, then nations with fewer: one table, by name."""
    name = f"{scratch_database(spark)[0]}.parties"
    customers = _table(spark, sf_dir, "customer").toDF("key", "name", "nation", "balance", "segment")
    suppliers = _table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("NAME"), F.col("s_suppkey").alias("key")
    )
    nations = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation"))
    for rows, mode in ((customers, "overwrite"), (suppliers, "append"), (nations, "append")):
        write_table(rows, name, mode)
    return read_table(spark, name)


def _bad_lines(spark: SparkSession, sf_dir: str, mode: str) -> tuple[TableSpec, str]:
    """The spec of a file of raw lines and tables of its own, and the file."""
    database, folder = scratch_database(spark)
    path = f"{folder}/lines.csv"
    _raw_lines(spark, sf_dir).write.option("header", True).option("delimiter", "|").csv(path)
    return replace(LINES, file_path=path, table_name=f"{database}.lines", write_mode=mode), path


def files_to_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad-record table of a run over a file of lines, its spec looked up by name in a registry."""
    spec, _ = _bad_lines(spark, sf_dir, "overwrite")
    registry = f"{spec.table_name}_specs"
    create_registry(spark, registry)
    for one in (replace(spec, name="others", keys=["f"]), spec):
        register(spark, registry, one)
    run(spark, [lookup(spark, registry, spec.name)])
    return _records(read_table(spark, spec.bad_table))


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs in append mode: rows of the clean and of the bad-record table, with how often each is there."""
    spec, _ = _bad_lines(spark, sf_dir, "append")
    run(spark, [spec])
    run(spark, [spec])
    return _times(read_table(spark, spec.clean_table), read_table(spark, spec.bad_table))


def _times(clean: DataFrame, bad: DataFrame, *of_run: str) -> DataFrame:
    """How often each row is in the clean and in the bad-record table, as text, by the columns `of_run` too. No row is the same in both,
    as only bad ones have a reason, so each table is counted alone, the clean rows in their types, which take less room than text."""
    bad = _records(bad).select(*LINES.column_names, "reason", *of_run)
    counted = clean.groupBy(*LINES.column_names, *of_run).agg(F.count("*").alias("times"))
    texts = [F.col(c).cast("string").alias(c) for c in LINES.column_names]
    return counted.select(*texts, F.lit("").alias("reason"), *of_run, "times").union(
        bad.groupBy(*bad.columns).agg(F.count("*").alias("times"))
    )


def _lines_of_any_length(spark: SparkSession, sf_dir: str) -> tuple[TableSpec, str]:
    """As `_bad_lines`, but of lines with other fields: those of 50 pieces lack the last one, those of 49 have one more, and those of
    48 have a delimiter in quotes."""
    database, folder = scratch_database(spark)
    path, q = f"{folder}/lines.csv", F.col("l_quantity")
    lines = _table(spark, sf_dir, "lineitem").select(
        F.coalesce(F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey").cast("string")), F.lit("")),
        F.when(F.col("l_partkey") % 89 == 0, "x").otherwise(F.col("l_linenumber").cast("string")),
        F.when(q == 48, F.concat(F.lit('"'), "l_returnflag", F.lit('|"'))).otherwise(F.col("l_returnflag")),
        F.col("l_linestatus"),
        F.when(q != 50, F.date_format("l_shipdate", "yyyy-MM-01")),
        F.when(q == 49, "more"),
    )
    text = lines.select(F.concat_ws("|", *lines.columns).alias("k1|k2|f|g|d"))
    text.write.options(header=True, delimiter="\x01", quote="\x00").csv(path)
    return replace(LINES, file_path=path, table_name=f"{database}.lines", reject_malformed=True), path


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad records of a file with rows that are too short, too long and quoted, each malformed one with its text."""
    spec, _ = _lines_of_any_length(spark, sf_dir)
    run(spark, [spec])
    return _records(read_table(spark, spec.bad_table))


def rerun_after_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs in append mode, the first one cut off between its two outputs and repeated, the second one done twice: rows of the
    clean and of the bad-record table by run, with how often each is there."""
    spec, _ = _bad_lines(spark, sf_dir, "append")
    write_table(_raw_lines(spark, sf_dir).limit(0), spec.clean_table, "overwrite")  # in the way of the clean rows
    try:
        run(spark, [spec], "first")
    except ValueError:
        drop_table(spark, spec.clean_table)
    for run_id in ("first", "second", "second"):
        run(spark, [spec], run_id)
    clean, bad = (read_table(spark, t).withColumnRenamed(RUN, "run") for t in (spec.clean_table, spec.bad_table))
    return _times(clean, bad, "run")


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run counted while it wrote: clean rows, bad rows, and bad rows by reason."""
    spec, _ = _bad_lines(spark, sf_dir, "overwrite")
    run(spark, [spec], "only")
    return read_table(spark, spec.counts_table).withColumnRenamed(RUN, "run")


def run_with_broken_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables at the same time, one of which has no file: what came of each, and the rows of the others."""
    spec, path = _bad_lines(spark, sf_dir, "append")
    names = ("good", "broken", "again")
    files = (path, f"{path}.not_there.csv", path)
    specs = [replace(spec, name=n, table_name=f"{spec.table_name}_{n}", file_path=f) for n, f in zip(names, files, strict=True)]
    outcomes = [(o.name, o.error is not None, o.counts.get("clean"), o.counts.get("bad")) for o in run_each(spark, specs, "only")]
    found = spark.createDataFrame(outcomes, "name string, failed boolean, clean long, bad long")
    tables = [s for s in specs if spark.catalog.tableExists(s.bad_table)]
    written = [read_table(spark, s.bad_table).groupBy(F.lit(s.name).alias("name")).agg(F.count("*").alias("in_table")) for s in tables]
    return found.join(reduce(DataFrame.unionByName, written), "name", "left")


def files_to_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, raw tables, bad-record and clean tables, mart table; the result is read from the mart."""
    database, folder = scratch_database(spark)
    sales, shops = f"{folder}/sales.csv", f"{folder}/shops.parquet"
    line = F.col
    _table(spark, sf_dir, "lineitem").select(
        F.when(line("l_orderkey") % 97 != 0, line("l_orderkey")).alias("transaction_id"),
        line("l_suppkey").alias("shop_id"),
        line("l_quantity").cast("int").alias("sales_qty"),
        _money("l_extendedprice").alias("sales_amt"),
        F.when(line("l_partkey") % 89 == 0, F.date_format("l_shipdate", "yyyyMMdd"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("sales_date"),
    ).write.option("header", True).option("delimiter", "|").csv(sales)
    _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("shop_id"), "s_name").write.parquet(shops)
    specs = [
        TableSpec(
            name="sales",
            file_path=sales,
            table_name=f"{database}.sales",
            columns={
                "transaction_id": "int",
                "shop_id": "int",
                "sales_qty": "int",
                "sales_amt": "decimal(18,2)",
                "sales_date": "date",
            },
            keys=["transaction_id", "shop_id"],
            header="true",
            delimiter="|",
        ),
        TableSpec(
            name="shops",
            file_path=shops,
            table_name=f"{database}.shops",
            columns={"shop_id": "int", "s_name": "string"},
            keys=["shop_id"],
        ),
    ]
    run(spark, specs)
    mart = f"{database}.daily_sales"
    load_daily_sales(spark.table(specs[0].clean_table), spark.table(specs[1].clean_table), mart)
    return _mart(spark.table(mart).drop("compute_date"))


def mart_of_changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs append sales; the mart is made after the first one, and after the second one only the months it has days of are."""
    database, folder = scratch_database(spark)
    sales = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("shop_id"),
        _money("l_extendedprice").alias("sales_amt"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("sales_date"),
    )
    columns = {"transaction_id": "int", "line": "int", "shop_id": "int", "sales_amt": "decimal(18,2)", "sales_date": "date"}
    keys = ["transaction_id", "line", "shop_id", "sales_amt", "sales_date"]
    shops, mart = _table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "shop_id"), f"{database}.daily_sales"
    parts = {"early": "sales_date < '1996-07'", "late": "sales_date >= '1996-07'"}
    for run_id, part in parts.items():
        path = f"{folder}/{run_id}.parquet"
        sales.filter(part).write.parquet(path)
        spec = TableSpec(run_id, path, f"{database}.sales", columns, keys, write_mode="append")
        run(spark, [spec], run_id)
        clean = read_table(spark, spec.clean_table)
        if run_id == "early":
            load_daily_sales(clean, shops, mart, by_month=True)
        else:
            refresh_daily_sales(clean, shops, mart, days_of_run(spark, spec, run_id))
    return _mart(read_table(spark, mart).drop("compute_date"))


# ---------------------------------------------------------------- contract


SMALLEST = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Daily sales of the smallest data set."""
    return daily_sales_by_ship_date(spark, SMALLEST)


def _corpus() -> ModuleType | None:
    """The training-data pipeline with its queries and SQL, if it is installed with the library."""
    try:
        return importlib.import_module("corpus_pipeline")
    except ImportError:  # also where a package that it needs is not installed
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = _corpus()
    return table_queries() | (corpus.queries() if corpus else {})


def oracle_sql() -> dict[str, str]:
    corpus = _corpus()
    return table_sql() | (corpus.oracle_sql() if corpus else {})


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_parquet_provenance": scan_parquet_provenance,
        "scan_csv_bronze": scan_csv_bronze,
        "scan_table_by_name": scan_table_by_name,
        "project_cast_by_spec": project_cast_by_spec,
        "format_flags": format_flags_of_rows,
        "flags_long": flags_long,
        "invalid_records": invalid,
        "null_key_records": null_key,
        "row_duplicates": row_duplicates,
        "key_duplicates": key_duplicates,
        "duplicate_records": duplicates,
        "bad_records": bad,
        "bad_records_all_keys_hot": bad_all_keys_hot,
        "bad_records_few_repeated": bad_few_repeated,
        "bad_records_many_repeated": bad_many_repeated,
        "clean_records": clean,
        "daily_sales": daily_sales_by_ship_date,
        "daily_sales_fanout": daily_sales_fanout,
        "daily_sales_text_key": daily_sales_text_key,
        "daily_sales_shuffled": daily_sales_shuffled,
        "daily_sales_stamped": daily_sales_stamped,
        "upsert_orders": upsert_orders,
        "upsert_lines": upsert_lines,
        "upsert_suppliers": upsert_suppliers,
        "upsert_orders_table": upsert_orders_table,
        "upsert_partitioned_table": upsert_partitioned_table,
        "upsert_partitioned_cast": upsert_partitioned_cast,
        "upsert_bucketed_table": upsert_bucketed_table,
        "files_to_daily_sales": files_to_daily_sales,
        "files_to_bad_records": files_to_bad_records,
        "append_twice": append_twice,
        "replace_with_new_schema": replace_with_new_schema,
        "append_other_columns": append_other_columns,
        "malformed_rows": malformed_rows,
        "rerun_after_cut": rerun_after_cut,
        "run_counts": run_counts,
        "run_with_broken_file": run_with_broken_file,
        "mart_of_changed_months": mart_of_changed_months,
    }


def _daily_sql(sales: str, shops: str, extra: str = "") -> str:
    return f"""
select cast(sales_date as varchar) as sales_date,
       cast(floor(sum(sales_amt)) as bigint) as sum_sales,
       cast(floor(sum(sales_amt) / count(sales_amt)) as bigint) as avg_sales,
       count(sales_amt) as bucket_count,
       cast(max(sales_amt) as double) as max_sales{extra}
from ({sales}) s left join ({shops}) h on s.shop_id = h.shop_id
group by s.sales_date"""


SALES_SQL = (
    "select l_suppkey as shop_id, cast(l_shipdate as date) as sales_date, "
    "cast(l_extendedprice as decimal(18,2)) as sales_amt from lineitem"
)
SUPPLIER_KEYS_SQL = "select s_suppkey as shop_id from supplier"
ORDER_AMOUNTS_SQL = "select o_orderkey as orderkey, o_orderstatus as status, o_totalprice as amount from orders"
BAD_SQL = _records_sql(INVALID + NULL_KEY + DUPLICATE)
LONG_SQL = " union all ".join(
    f"select k1, k2, f, g, d, '{f}' as reason, true as status from flags where {f}" for f in INVALID + NULL_KEY
)


def _upsert_sql(target: str, source: str, keys: list[str], others: list[str]) -> str:
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    new = ", ".join([f"t.{k}" for k in keys] + [f"case when s._new then s.{c} else t.{c} end as {c}" for c in others])
    columns = ", ".join(keys + others)
    return f"""
with t as ({target}), s as (select *, true as _new from ({source}))
select {new} from t left join s on {on}
union all
select {columns} from s where not exists (select 1 from t where {on})"""


UPSERT_ORDERS_SQL = _upsert_sql(
    ORDER_AMOUNTS_SQL,
    "select l_orderkey as orderkey, max(l_linestatus) as status, "
    "cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount from lineitem group by l_orderkey",
    ["orderkey"],
    ["status", "amount"],
)


PROVENANCE_SQL = ", ".join(
    f"true as {c}" for c in ("loaded_today", "same_day", "path_ends_in_name", "has_bytes", "written_before")
)


def table_sql() -> dict[str, str]:
    lines = f"with {RAW_LINES_SQL}"
    return {
        "scan_parquet_provenance": f"select *, 'orders.parquet' as _file_name, {PROVENANCE_SQL} from orders",
        "scan_csv_bronze": f"{lines} select k1, k2, f, g, d, true as from_csv, {PROVENANCE_SQL} from b",
        "scan_table_by_name": "select * from customer",
        "project_cast_by_spec": f"{lines} select try_cast(k1 as int) as k1, try_cast(k2 as int) as k2, f, g, "
        "cast(try_cast(d as date) as varchar) as d from flags "
        "where k1 is not null and not _is_k1_invalid and not _is_k2_invalid and not _is_d_invalid",
        "format_flags": f"{lines} select k1, k2, f, g, d, _is_k1_invalid, _is_k2_invalid, _is_d_invalid from flags",
        "flags_long": f"{lines} {LONG_SQL}",
        "invalid_records": _records_sql(INVALID),
        "null_key_records": _records_sql(NULL_KEY),
        "row_duplicates": _records_sql(["_row_duplicate"]),
        "key_duplicates": _records_sql(["_key_duplicate"]),
        "duplicate_records": _records_sql(DUPLICATE),
        "bad_records": BAD_SQL,
        "bad_records_all_keys_hot": BAD_SQL,
        "bad_records_few_repeated": BAD_SQL,
        "bad_records_many_repeated": SHIPMENTS_SQL,
        "clean_records": f"{lines} select cast(k1 as int) as k1, cast(k2 as int) as k2, f, g, "
        "cast(cast(d as date) as varchar) as d from flags "
        f"where not ({' or '.join(INVALID + NULL_KEY + DUPLICATE)})",
        "daily_sales": _daily_sql(SALES_SQL, SUPPLIER_KEYS_SQL),
        "daily_sales_fanout": _daily_sql(
            "select o_orderkey as shop_id, cast(o_orderdate as date) as sales_date, "
            "cast(o_totalprice as decimal(18,2)) as sales_amt from orders",
            "select l_orderkey as shop_id from lineitem",
        ),
        "daily_sales_text_key": _daily_sql(
            SALES_SQL,
            "select try_cast(case when c_mktsegment = 'MACHINERY' then 'x' else cast(c_nationkey as varchar) end "
            "as bigint) as shop_id from customer",
        ),
        "daily_sales_shuffled": _daily_sql(SALES_SQL, "select c_nationkey as shop_id from customer"),
        "daily_sales_stamped": _daily_sql(SALES_SQL, SUPPLIER_KEYS_SQL, ", true as stamped"),
        "upsert_orders": UPSERT_ORDERS_SQL,
        "upsert_lines": _upsert_sql(
            "select l_orderkey as orderkey, l_returnflag as status, l_extendedprice as amount from lineitem",
            ORDER_AMOUNTS_SQL,
            ["orderkey"],
            ["status", "amount"],
        ),
        "upsert_suppliers": _upsert_sql(
            "select s_suppkey as key, s_name as name, s_nationkey as nation, s_acctbal as balance from supplier",
            "select c_custkey as key, c_name as name, c_nationkey as nation, c_acctbal as balance from customer",
            ["key", "nation"],
            ["name", "balance"],
        ),
        "upsert_orders_table": UPSERT_ORDERS_SQL,
        "upsert_bucketed_table": UPSERT_ORDERS_SQL,
        "upsert_partitioned_table": _upsert_sql(
            ORDER_AMOUNTS_SQL,
            "select l_orderkey as orderkey, l_linestatus as status, "
            "cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount "
            "from lineitem group by l_orderkey, l_linestatus",
            ["orderkey", "status"],
            ["amount"],
        ),
        "upsert_partitioned_cast": "select o_orderkey as orderkey, case when o_orderstatus = 'F' and year(o_orderdate) < 1997 "
        "then 0.5 else o_totalprice end as amount, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') as day from orders",
        "files_to_bad_records": BAD_SQL,
        "append_twice": f"{lines}, reasons as (select k1, k2, f, g, d, concat_ws(',', "
        + ", ".join(f"case when {f} then '{f}' end" for f in sorted(INVALID + NULL_KEY + DUPLICATE))
        + ") as reason from flags) select k1, k2, f, g, d, reason, 2 * count(*) as times from reasons group by all",
        "replace_with_new_schema": "select 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' as columns, "
        "o_orderkey as key, o_totalprice as amount from orders union all select 'customer', c_custkey, c_acctbal from customer",
        "append_other_columns": "select c_custkey as key, c_name as name, c_nationkey as nation, c_acctbal as balance, "
        "c_mktsegment as segment, null as kind from customer union all select s_suppkey, s_name, null, s_acctbal, null, 'supplier' from supplier "
        "union all select null, n_name, n_nationkey, null, null, null from nation",
        "malformed_rows": f"with {MALFORMED_SQL} select k1, k2, f, g, d, _malformed_row, concat_ws(',', {_reason_names(MALFORMED)}) as reason "
        f"from flags where {' or '.join(MALFORMED)}",
        "rerun_after_cut": f"{lines}, reasons as (select k1, k2, f, g, d, concat_ws(',', {_reason_names(ALL)}) as reason from flags) "
        "select k1, k2, f, g, d, reason, run, count(*) as times from reasons, (values ('first'), ('second')) as r(run) group by all",
        "mart_of_changed_months": _daily_sql(
            # Rows that are equal in all columns are copies: one of them is clean.
            "select distinct l_orderkey, l_linenumber, l_suppkey as shop_id, cast(l_extendedprice as decimal(18,2)) as sales_amt, "
            "cast(l_shipdate as date) as sales_date from lineitem",
            SUPPLIER_KEYS_SQL,
            ", strftime(s.sales_date, '%Y-%m') as sales_month",
        ),
        "run_counts": f"{lines}, n as (select count(*) as rows, count_if({' or '.join(ALL)}) as bad, "
        + ", ".join(f"count_if({f}) as n{f}" for f in ALL)
        + " from flags) select 'clean' as counted, rows - bad as rows, 'only' as run from n union all select 'bad', bad, 'only' from n"
        + "".join(f" union all select '{f}', n{f}, 'only' from n" for f in ALL),
        "run_with_broken_file": f"{lines}, n as (select count(*) as rows, count_if({' or '.join(ALL)}) as bad from flags) "
        "select name, failed, case when not failed then rows - bad end as clean, case when not failed then bad end as bad, "
        "case when not failed then bad end as in_table from n, (values ('good', false), ('broken', true), ('again', false)) as t(name, failed)",
        "files_to_daily_sales": "with "
        "raw as (select case when l_orderkey % 97 <> 0 then l_orderkey end as transaction_id, l_suppkey as shop_id, "
        "cast(l_quantity as int) as sales_qty, cast(l_extendedprice as decimal(18,2)) as sales_amt, "
        "l_partkey % 89 = 0 as wrong, l_shipdate, case when l_partkey % 89 = 0 then strftime(l_shipdate, '%Y%m%d') "
        "else strftime(l_shipdate, '%Y-%m-%d') end as date_text from lineitem), "
        "versions as (select distinct transaction_id, shop_id, sales_qty, sales_amt, wrong, date_text, "
        "cast(l_shipdate as date) as sales_date from raw where transaction_id is not null), "
        "sole as (select *, count(*) over (partition by transaction_id, shop_id) as n from versions) "
        + _daily_sql("select * from sole where n = 1 and not wrong", SUPPLIER_KEYS_SQL),
    }
