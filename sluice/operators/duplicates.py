"""Duplicate rows and conflicting keys.

Of the rows that are equal in every column, the first is kept and the later ones are row duplicates.
Where a key then still has several rows, all of them are key duplicates. Rows with a null key, and malformed ones where the
spec rejects them, are neither.

One key may hold a large part of the table, and so may the copies of one row. Most rows go by key to one
exchange and one sort; the rows of hot keys go by their whole content and a slot instead, so that no task
gets more than a share of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.flags import none_null
from sluice.functions.names import OWN, named, quoted
from sluice.operators.bitmaps import KeyBits, key_bits, rows_maybe_with, rows_surely_without
from sluice.operators.skew import (
    HOT_ROWS,
    SLOT,
    Listed,
    listed_keys,
    own_key,
    rows_with,
    rows_without,
    same_key,
    slotted,
)
from sluice.plans.sizes import BROADCAST_BYTES
from sluice.plans.spec import TableSpec
from sluice.sources.files import MALFORMED

# The reasons for duplicates.
ROW_DUPLICATE = "_row_duplicate"
KEY_DUPLICATE = "_key_duplicate"

COPY_SLOTS = 1 << 16
ALONE, COPY, VERSIONS, LATER, CONFLICT = (f"{OWN}{n}" for n in ("alone", "copy", "versions", "later", "conflict"))


def takes_part(spec: TableSpec) -> Column:
    """Whether a row can have duplicates."""
    part = none_null(spec.keys)
    return part & F.col(MALFORMED).isNull() if spec.reject_malformed else part


def repeated_keys(rows: DataFrame, spec: TableSpec, limit: int = BROADCAST_BYTES) -> Listed:
    """The keys with more than one row, and how many rows they have. Counts them once."""
    return listed_keys(rows.filter(takes_part(spec)), spec.keys, 1, limit)


def with_duplicate_flags(
    rows: DataFrame,
    spec: TableSpec,
    hot_rows: int = HOT_ROWS,
    repeated: Listed | None = None,
    limit: int = BROADCAST_BYTES,
    copies_only: bool = False,
    whole_keys: bool = False,
) -> DataFrame:
    """Add both flags. All rows pass one exchange; those of hot keys pass two, those that take no part none.

    `repeated` saves counting the keys. `copies_only` leaves the flag of key duplicates false. `whole_keys` says that
    rows that take no part have been left out.
    """
    whole = rows.filter(takes_part(spec))
    hot = listed_keys(whole, spec.keys, hot_rows, limit) if repeated is None else repeated.above(hot_rows, limit)
    flagged = _flag_by_key(rows_without(whole, hot), spec, copies_only)
    if hot.count:
        flagged = flagged.unionByName(_flag_spread(rows_with(whole, hot), spec, hot, copies_only))
    if not whole_keys and (spec.reject_malformed or any(rows.schema[k].nullable for k in spec.keys)):
        flagged = flagged.unionByName(_unflagged(rows.filter(~takes_part(spec))))
    return flagged


def repeated_bits(repeated: Listed, limit: int = BROADCAST_BYTES) -> KeyBits | None:
    """For repeated keys that are too many to broadcast: a bitmap of them that is not, if there can be one."""
    if repeated.few:
        return None
    return key_bits(repeated.rows, repeated.keys, [own_key(k) for k in repeated.keys], repeated.count, limit)


def flag_unrepeated(
    rows: DataFrame, repeated: Listed, spec: TableSpec | None = None, bits: KeyBits | None = None
) -> DataFrame:
    """The rows whose key is not in `repeated`, and those that take no part: they have no duplicates and, if the list is small,
    need no shuffle. The spec is needed if it rejects malformed rows. With `bits` of the list, however long it is: the rows whose
    bit is not set, without a shuffle."""
    part = takes_part(spec) if spec and spec.reject_malformed else None
    return _unflagged(rows_surely_without(rows, bits, part) if bits else rows_without(rows, repeated, part))


def flag_repeated(
    rows: DataFrame,
    spec: TableSpec,
    repeated: Listed,
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
    bits: KeyBits | None = None,
) -> DataFrame:
    """The rows whose key is in `repeated`, with both flags. With `bits` of the list: all that `flag_unrepeated` leaves; those
    that only share a bit are found to have no duplicates."""
    hot = repeated.above(hot_rows, limit)
    part = takes_part(spec) if spec.reject_malformed else None
    some = rows_maybe_with(rows, bits, part) if bits else rows_with(rows, repeated, part)
    flagged = _flag_by_key(rows_without(some, hot), spec, False)
    return flagged.unionByName(_flag_spread(rows_with(some, hot), spec, hot, False)) if hot.count else flagged


def _unflagged(rows: DataFrame) -> DataFrame:
    return rows.withColumns({ROW_DUPLICATE: F.lit(False), KEY_DUPLICATE: F.lit(False)})


def _flag_by_key(rows: DataFrame, spec: TableSpec, copies_only: bool) -> DataFrame:
    """For keys of bounded size, none null. Both windows use the one exchange and the one sort."""
    group = quoted(spec.keys)
    copies = Window.partitionBy(*group, *quoted(spec.non_keys)).orderBy("_sk")
    flagged = rows.repartition(*group).withColumn(COPY, F.row_number().over(copies))
    conflict = F.lit(False)
    if not copies_only:
        flagged = flagged.withColumn(VERSIONS, F.count_if(F.col(COPY) == 1).over(Window.partitionBy(*group)))
        conflict = (F.col(COPY) == 1) & (F.col(VERSIONS) > 1)
    return flagged.select(
        *quoted(spec.row_columns), (F.col(COPY) > 1).alias(ROW_DUPLICATE), conflict.alias(KEY_DUPLICATE)
    )


def _flag_spread(rows: DataFrame, spec: TableSpec, hot: Listed, copies_only: bool) -> DataFrame:
    """For the rows of hot keys. Copies of one row are numbered within slots, then the slots' firsts are."""
    content, columns = quoted(spec.column_names), quoted(spec.row_columns)
    in_slot = Window.partitionBy(*content, ALONE).orderBy("_sk")
    of_firsts = Window.partitionBy(*content, LATER).orderBy("_sk")
    flagged = (
        rows.withColumn(ALONE, F.pmod(F.xxhash64("_sk"), F.lit(COPY_SLOTS)))
        .withColumn(LATER, F.when(F.row_number().over(in_slot) > 1, F.col("_sk")))
        .withColumn(ROW_DUPLICATE, F.col(LATER).isNotNull() | (F.row_number().over(of_firsts) > 1))
    )
    if copies_only:
        return flagged.select(*columns, ROW_DUPLICATE, F.lit(False).alias(KEY_DUPLICATE))
    conflicts = _conflicting_keys(rows, spec)
    if hot.few:  # these keys are some of the hot ones, whose list has been measured
        flagged = flagged.join(F.broadcast(conflicts), same_key(spec.keys), "left")
    else:
        flagged, slots = slotted(flagged, conflicts, hot)
        flagged = flagged.join(slots, same_key(spec.keys) & (F.col(SLOT) == F.col(f"{SLOT}s")), "left")
    return flagged.select(
        *columns, ROW_DUPLICATE, (F.col(CONFLICT).isNotNull() & ~F.col(ROW_DUPLICATE)).alias(KEY_DUPLICATE)
    )


def _conflicting_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys with rows that differ: then the least and the greatest row differ. A task sends two rows per key."""
    row = F.struct(*quoted(spec.non_keys), F.lit(0).alias(f"{OWN}end"))
    own = [f"{OWN}key_{k}" for k in spec.keys]
    return (
        rows.groupBy(*[named(k).alias(o) for k, o in zip(spec.keys, own, strict=True)])
        .agg(F.min(row).alias(f"{OWN}least"), F.max(row).alias(f"{OWN}greatest"))
        .filter(~F.col(f"{OWN}least").eqNullSafe(F.col(f"{OWN}greatest")))
        .select(*map(named, own), F.lit(True).alias(CONFLICT))
    )
