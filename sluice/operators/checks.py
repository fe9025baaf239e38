"""Row checks against a spec: wrong format, null key, duplicates; rejected rows and clean rows.

The operators take the rows of `with_row_id`: the spec's columns, the text of malformed rows if the spec rejects them, and `_sk`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.flags import any_of, flagged_rows
from sluice.functions.formats import breaks_format, simple_type, typed
from sluice.functions.names import named, quoted
from sluice.operators.duplicates import KEY_DUPLICATE, ROW_DUPLICATE, takes_part, with_duplicate_flags
from sluice.operators.skew import HOT_ROWS
from sluice.plans.spec import TableSpec
from sluice.sources.files import MALFORMED


def with_row_id(df: DataFrame, spec: TableSpec, row_id: Column | None = None) -> DataFrame:
    """The spec's columns in order and `_sk`, a number that tells the rows of one read apart, or `row_id`."""
    row_id = F.monotonically_increasing_id() if row_id is None else row_id
    return df.select(*quoted(spec.row_columns[:-1]), row_id.alias("_sk"))


# The names of the reasons, which the flags bear.


def format_flags(spec: TableSpec) -> dict[str, Column]:
    return {f"_is_{c}_invalid": breaks_format(c, t) for c, t in spec.columns if simple_type(t) != "string"}


def null_key_flags(spec: TableSpec) -> dict[str, Column]:
    return {f"_is_{c}_null": named(c).isNull() for c in spec.keys}


def malformed_flags(spec: TableSpec) -> dict[str, Column]:
    """For rows of a file that `read_file` has marked."""
    return {"_is_row_malformed": F.col(MALFORMED).isNotNull()} if spec.reject_malformed else {}


def duplicate_flags() -> dict[str, Column]:
    return {name: F.col(name) for name in (ROW_DUPLICATE, KEY_DUPLICATE)}


def all_flags(spec: TableSpec) -> dict[str, Column]:
    """Every check, for rows that carry the duplicate flags. Those that match no text come first: a row that fails one of them is bad
    without a look at its texts."""
    return {**duplicate_flags(), **null_key_flags(spec), **malformed_flags(spec), **format_flags(spec)}


def invalid_records(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return flagged_rows(rows, format_flags(spec), spec.row_columns)


def malformed_records(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return flagged_rows(rows, malformed_flags(spec), spec.row_columns)


def null_key_records(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return flagged_rows(rows, null_key_flags(spec), spec.row_columns)


def duplicate_records(
    rows: DataFrame, spec: TableSpec, hot_rows: int = HOT_ROWS, only: str | None = None
) -> DataFrame:
    """Later copies of a row, and all first copies of a key that has different rows. Null keys take no part.

    `only` is ROW_DUPLICATE or KEY_DUPLICATE for one of the two; copies alone need no look at the other rows of a key.
    """
    whole = rows.filter(takes_part(spec))
    flagged = with_duplicate_flags(whole, spec, hot_rows, copies_only=only == ROW_DUPLICATE, whole_keys=True)
    flags = {name: flag for name, flag in duplicate_flags().items() if only in (None, name)}
    return flagged_rows(flagged, flags, spec.row_columns)


def reject(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows failing any check, as read, with all their reasons."""
    return flagged_rows(flagged, all_flags(spec), spec.row_columns)


def accept(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows passing every check, in their declared types."""
    return flagged.filter(~any_of(all_flags(spec).values())).select(*[typed(c, t) for c, t in spec.columns])


def bad_records(rows: DataFrame, spec: TableSpec, hot_rows: int = HOT_ROWS) -> DataFrame:
    return reject(with_duplicate_flags(rows, spec, hot_rows), spec)


def clean_records(rows: DataFrame, spec: TableSpec, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows `bad_records` leaves. Rows that no other row can be a twin of go before the shuffle: they are never clean."""
    whole = rows.filter(takes_part(spec))
    return accept(with_duplicate_flags(whole, spec, hot_rows, whole_keys=True), spec)


def with_load_time(df: DataFrame) -> DataFrame:
    # The names of the clean table's control columns.
    return df.withColumns({"load_dt": F.current_date(), "load_dttm": F.current_timestamp()})
