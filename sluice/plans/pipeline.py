"""The jobs: file to raw table, raw table to clean and bad-record tables, clean tables to a mart, upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions.flags import none_null
from sluice.functions.names import OWN, named
from sluice.operators.checks import accept, all_flags, reject, with_load_time, with_row_id
from sluice.operators.duplicates import (
    flag_repeated,
    flag_unrepeated,
    repeated_bits,
    repeated_keys,
    with_duplicate_flags,
)
from sluice.operators.marts import repeated_shops, sales_per_day, with_compute_date
from sluice.operators.merge import ambiguous_keys, as_target, merge, shared_keys, small_and_repeated
from sluice.operators.skew import HOT_ROWS, ROWS
from sluice.plans.sizes import BROADCAST_BYTES, fits_broadcast
from sluice.plans.spec import TableSpec
from sluice.sources.files import read_file, with_provenance
from sluice.sources.tables import (
    RUN,
    bucket_columns,
    drop_partitions,
    drop_table,
    finish_replacement,
    partition_columns,
    read_table,
    replace_rows,
    scratch_bytes,
    stored_row_id,
    write_partitioned,
    write_run,
    write_scratch_table,
    write_table,
)

#: The column a mart is partitioned by: year and month of the day.
MONTH = "sales_month"


def load_raw(spark: SparkSession, spec: TableSpec) -> None:
    """File to raw table, replacing it. No shuffle."""
    raw = with_provenance(read_file(spark, spec.file_path, spec.header, spec.delimiter, spec.reject_malformed))
    write_table(raw, spec.raw_table, "overwrite")


def load_checked(
    spark: SparkSession,
    spec: TableSpec,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    run_id: str | None = None,
) -> dict[str, int]:
    """Raw table to bad-record table (appended) and clean table (by the spec's mode).

    With a `run_id`, what is appended goes to the run's partition of the table and replaces what this run wrote there before: a run
    that was cut off anywhere can be repeated and adds its rows once. The numbers of clean rows, of bad rows and of bad rows for
    each reason are taken while the rows are written, kept by run in the spec's table of counts, and returned. `_sk` is a row's place in the
    raw table's files, and so the same however often and by how many tasks they are read.

    The repeated keys are counted and stored first. If they are few, only their rows are checked for
    duplicates, once, and kept for both outputs; all other rows go from the raw table to the outputs with no
    shuffle: the raw table is read once for the keys, once for these rows and once for each output. If they are too many to
    broadcast, a bitmap of their hashes tells rows that surely have a key of their own, which go the same way; the others are
    checked. If they are too many for that as well, all rows are checked, once, and both outputs are read from there.
    """
    raw = read_table(spark, spec.raw_table)
    rows = with_row_id(raw, spec, stored_row_id(raw))
    repeated = repeated_keys(rows, spec, broadcast_bytes)
    bits = repeated_bits(repeated, broadcast_bytes)
    if repeated.few or bits:
        checked = flag_repeated(rows, spec, repeated, hot_rows, broadcast_bytes, bits)
    else:
        checked = with_duplicate_flags(rows, spec, hot_rows, repeated, broadcast_bytes)
    scratch = write_scratch_table(checked)
    try:
        flagged = spark.table(scratch)
        # Few rows from many tasks: gather them into files of a useful size. Those checked for duplicates are mostly bad, and in such
        # files already.
        if repeated.few or bits:
            alone = flag_unrepeated(rows, repeated, spec, bits)
            bad = reject(alone, spec).hint("rebalance").unionByName(reject(flagged, spec))
            flagged = alone.unionByName(flagged)
        else:
            bad = reject(flagged, spec).hint("rebalance")
        clean = with_load_time(accept(flagged, spec))
        if run_id is None:
            write_table(bad, spec.bad_table, "append")
            write_table(clean, spec.clean_table, spec.write_mode)
            return {}
        return _write_counted(bad, clean, spec, run_id)
    finally:
        drop_table(spark, scratch)


def _write_counted(bad: DataFrame, clean: DataFrame, spec: TableSpec, run_id: str) -> dict[str, int]:
    """The counts come from the tasks that write, so no row is read for them."""
    of_reasons = {r: F.count_if(F.array_contains("reason", r)).alias(r) for r in all_flags(spec)}
    of_bad, of_clean = Observation(), Observation()
    write_run(bad.observe(of_bad, F.count("*").alias("bad"), *of_reasons.values()), spec.bad_table, run_id)
    clean = clean.observe(of_clean, F.count("*").alias("clean"))
    if spec.write_mode == "append":
        write_run(clean, spec.clean_table, run_id)
    else:
        write_table(clean, spec.clean_table, spec.write_mode)
    counts = {**of_clean.get, **of_bad.get}
    write_run(bad.sparkSession.createDataFrame(list(counts.items()), "counted string, rows long"), spec.counts_table, run_id)
    return counts


def run(spark: SparkSession, specs: Iterable[TableSpec], run_id: str | None = None) -> None:
    """Raw, then checked, for each table. A run with an id can be repeated, see `load_checked`."""
    for spec in specs:
        load_raw(spark, spec)
        load_checked(spark, spec, run_id=run_id)


@dataclass(frozen=True)
class Outcome:
    """What came of one table in a run: its counts, or what went wrong."""

    name: str
    counts: dict[str, int]
    error: str | None


def run_each(spark: SparkSession, specs: Sequence[TableSpec], run_id: str, at_once: int = 4) -> list[Outcome]:
    """`run` for several tables at the same time, each in a scheduler pool of its name. A table that fails leaves the others alone;
    repeating the run, for all or for those that failed, adds no row twice."""
    if len({s.table_name.lower() for s in specs}) < len(specs):
        raise ValueError("two specs have the same table")

    def one(spec: TableSpec) -> Outcome:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            load_raw(spark, spec)
            return Outcome(spec.name, load_checked(spark, spec, run_id=run_id), None)
        except Exception as e:  # whatever it is, it belongs to this table
            return Outcome(spec.name, {}, f"{type(e).__name__}: {str(e).strip().splitlines()[0] if str(e).strip() else ''}")
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, at_once)) as threads:
        return list(threads.map(inheritable_thread_target(spark)(one), specs))


def load_daily_sales(
    sales: DataFrame,
    shops: DataFrame,
    table: str,
    key: str = "shop_id",
    date: str = "sales_date",
    amount: str = "sales_amt",
    broadcast_bytes: int = BROADCAST_BYTES,
    by_month: bool = False,
) -> None:
    """Daily sales, stamped with the time, to the mart table, replacing it.

    Before they are combined, sales are shuffled only if many shops repeat. `by_month` partitions the table by the month of the day,
    `MONTH`, so that `refresh_daily_sales` can replace some of it; by day, each file would have one row.
    """

    def written(per_day: DataFrame) -> None:
        if by_month:
            write_partitioned(_in_months(per_day, date), table, MONTH)
        else:
            write_table(per_day, table, "overwrite")

    _with_daily_sales(sales, shops, key, date, amount, broadcast_bytes, written)


def refresh_daily_sales(
    sales: DataFrame,
    shops: DataFrame,
    table: str,
    days: DataFrame,
    key: str = "shop_id",
    date: str = "sales_date",
    amount: str = "sales_amt",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """The mart table of `load_daily_sales(by_month=True)` brought up to date where `days`, a column of that name, has changed.

    The months of these days are computed anew from `sales`, of which only their rows go on after the scan, and put in place;
    other months are neither read nor written. A month that has no sales any more goes. For the days of a run, see
    `days_of_run`; where a run is repeated, take also those it had before. What an interruption leaves is finished by the next refresh.
    """
    spark = sales.sparkSession
    if partition_columns(spark, table) != [MONTH]:
        raise ValueError(f"{table} is not partitioned by {MONTH}")
    finish_replacement(spark, table)
    months = write_scratch_table(days.select(_month(date).alias(MONTH)).distinct())
    try:
        changed = spark.table(months)
        some = _touched(sales.withColumn(MONTH, _month(date)), changed, [MONTH], broadcast_bytes)

        def written(per_day: DataFrame) -> None:
            replace_rows(_in_months(per_day, date), table, only_its_partitions=True)

        _with_daily_sales(some, shops, key, date, amount, broadcast_bytes, written)
        left = some.select(MONTH).distinct()
        drop_partitions(spark, table, MONTH, changed.join(left, changed[MONTH].eqNullSafe(left[MONTH]), "left_anti"))
    finally:
        drop_table(spark, months)


def days_of_run(spark: SparkSession, spec: TableSpec, run_id: str, date: str = "sales_date") -> DataFrame:
    """The days of the rows that a run added to the clean table. Only its partition is read."""
    return spark.table(spec.clean_table).filter(F.col(RUN) == run_id).select(named(date)).distinct()


def _month(date: str) -> Column:
    return F.date_format(named(date), "yyyy-MM")


def _in_months(per_day: DataFrame, date: str) -> DataFrame:
    return per_day.withColumn(MONTH, _month(date))


def _with_daily_sales(
    sales: DataFrame, shops: DataFrame, key: str, date: str, amount: str, limit: int, written: Callable[[DataFrame], None]
) -> None:
    spark = sales.sparkSession
    scratch = write_scratch_table(repeated_shops(sales, shops, key))
    try:
        repeated = spark.table(scratch)
        few = fits_broadcast(repeated, limit)
        written(with_compute_date(sales_per_day(sales, repeated, key, date, amount, few, limit=limit)))
    finally:
        drop_table(spark, scratch)


def upsert_table(source: DataFrame, table: str, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> None:
    """Merge `source` into `table`, which keeps its format, partitioning, comment and properties.

    The source is first put in the table's types, so that keys and partitions are compared as they will be written. If the
    keys include the columns the table is partitioned by, only the partitions the source has rows for are read and
    replaced. A table in buckets by the keys is never shuffled: the source is, to its buckets, and the new files keep them.
    See `replace_rows` for what an interruption leaves; the next upsert of the table finishes it first.
    """
    spark = source.sparkSession
    finish_replacement(spark, table)
    target, partitions = read_table(spark, table), partition_columns(spark, table)
    by_partition = bool(partitions) and set(partitions) <= set(keys)
    scratch = write_scratch_table(as_target(source, target, partitions))
    try:
        stored = spark.table(scratch)
        if by_partition:
            target = _touched(target, stored, partitions, broadcast_bytes)
        small = repeated = False
        if scratch_bytes(spark, scratch) <= broadcast_bytes:
            small, repeated = small_and_repeated(stored, keys, broadcast_bytes)
        if small:
            shared = None
            ambiguous = repeated and not ambiguous_keys(target, stored, keys, broadcast_bytes).isEmpty()
        else:
            in_buckets = set(bucket_columns(spark, table)) == set(keys)
            shared = shared_keys(target, stored, keys, limit=broadcast_bytes, in_buckets=in_buckets)
            ambiguous = shared.ambiguous > 0
        if ambiguous:
            raise ValueError(f"several source rows have the key of one row of {table}")
        replace_rows(merge(target, stored, keys, small, limit=broadcast_bytes, shared=shared), table, by_partition)
    finally:
        drop_table(spark, scratch)


def _touched(target: DataFrame, source: DataFrame, partitions: Sequence[str], limit: int) -> DataFrame:
    """The rows of the partitions that the source has rows for. A list of them that is measured as small is broadcast,
    and then tells the scan which partitions to read; those with a null value are few and looked up apart."""
    own = [f"{OWN}of_{p}" for p in partitions]
    values = source.groupBy(*[named(p).alias(o) for p, o in zip(partitions, own, strict=True)])
    values = values.agg(F.count("*").alias(ROWS)).filter(F.col(ROWS) > 0)
    if fits_broadcast(values, limit):
        values = F.broadcast(values)
    pairs = [(named(p), named(o)) for p, o in zip(partitions, own, strict=True)]
    whole = target.filter(none_null(partitions)).join(values, [p == o for p, o in pairs], "left_semi")
    null = reduce(Column.__and__, [p.eqNullSafe(o) for p, o in pairs])
    return whole.unionByName(target.filter(~none_null(partitions)).join(values, null, "left_semi"))
