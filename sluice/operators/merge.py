"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions.flags import none_null
from sluice.functions.names import OWN, check_names, named, quoted
from sluice.operators.skew import HOT_ROWS, ROWS, Listed, join_spread, listed_keys, own_key, rows_with, rows_without
from sluice.plans.sizes import BROADCAST_BYTES, row_bytes
from sluice.sources.tables import written_once

OLD, NEW = f"{OWN}old", f"{OWN}new"


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    small_source: bool = False,
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
    shared: SharedKeys | None = None,
) -> DataFrame:
    """Every target row, replaced by the source row of its key if there is one, and the source rows no key matched.

    The result has the target's columns and types. A null key matches nothing. A target row that matches several source rows
    is an error: `shared_keys` finds it before the join; where the source is broadcast, see `ambiguous_keys`.

    `small_source` says that the source has been found small enough to
    broadcast: then the target is not shuffled. Otherwise one full outer join by key gives updates and inserts. Around it go
    rows with a null key; rows of keys that are hot in the target, which meet their one source row by key and slot;
    and source rows of keys that are hot in the source, which no target row can have. `shared` saves the look at the keys of
    both sides.
    """
    check_names(target.columns, source.columns)
    keys, source = list(keys), as_target(source, target)
    if small_source:
        return _merge_small(target, source, keys)
    shared = shared_keys(target, source, keys, hot_rows, limit) if shared is None else shared
    if shared.ambiguous:
        raise ValueError(f"{shared.ambiguous} keys of the target have several source rows")
    hot, many = shared.hot, shared.many
    old, new = target.filter(none_null(keys)), source.filter(none_null(keys))
    inserts = rows_without(new, hot)
    both = _packed(rows_without(old, hot), keys, OLD).join(_packed(rows_without(inserts, many), keys, NEW), keys, "full")
    merged = both.select(F.coalesce(NEW, OLD).alias(NEW)).select(f"{NEW}.*")
    if hot.count:
        spread = join_spread(_packed(rows_with(old, hot), keys, OLD), _packed(rows_with(new, hot), keys, NEW), keys, "left")
        merged = merged.unionByName(spread.select(F.coalesce(NEW, OLD).alias(NEW)).select(f"{NEW}.*"))
    if many.count:
        merged = merged.unionByName(rows_with(inserts, many))
    for side in (target, source):
        if any(side.schema[k].nullable for k in keys):
            merged = merged.unionByName(side.filter(~none_null(keys)))
    return merged


def _packed(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.select(*quoted(keys), F.struct(*quoted(rows.columns)).alias(name))


def _merge_small(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    new = _packed(source.filter(none_null(keys)), keys, NEW)
    paired = target.join(F.broadcast(new), keys, "left")
    kept = paired.select(
        *[F.when(F.col(NEW).isNotNull(), F.col(NEW).getField(c)).otherwise(named(c)).alias(c) for c in target.columns]
    )
    # The keys that the two share are no more than the source has: they can be broadcast as well.
    listed = source.filter(none_null(keys)).select(*quoted(keys)).distinct()
    known = target.select(*quoted(keys)).join(F.broadcast(listed), keys, "left_semi").distinct()
    return kept.unionByName(source.join(F.broadcast(known), keys, "left_anti"))


@dataclass(frozen=True)
class SharedKeys:
    """What a merge must know of the keys of both sides."""

    hot: Listed  # with many target rows
    many: Listed  # with many source rows and no target row
    ambiguous: int  # number of those with target rows and several source rows


def shared_keys(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
    in_buckets: bool = False,
) -> SharedKeys:
    """One look at the keys of both sides: they are counted together, combined before one shuffle. Only keys that are hot on a
    side or ambiguous are kept, stored once, and measured all at once. `in_buckets` says that the target is a table in buckets by
    these keys: then its keys are counted where they are, and only the source's are shuffled, to the buckets."""
    own, old, new = [own_key(k) for k in keys], f"{OWN}of_target", f"{OWN}of_source"
    key, sides = [named(k).alias(o) for k, o in zip(keys, own, strict=True)], []
    for rows, n_old, n_new in ((target, 1, 0), (as_target(source, target), 0, 1)):
        sides.append(rows.filter(none_null(keys)).select(*key, F.lit(n_old).alias(old), F.lit(n_new).alias(new)))
    if in_buckets:
        of_target, of_source = (s.groupBy(*quoted(own)).agg(F.sum(n).alias(n)) for s, n in zip(sides, (old, new), strict=True))
        counts = of_target.join(of_source, own, "full").na.fill(0, [old, new])
    else:
        counts = sides[0].unionByName(sides[1]).groupBy(*quoted(own)).agg(F.sum(old).alias(old), F.sum(new).alias(new))
    ambiguous = (F.col(old) > 0) & (F.col(new) > 1)
    kept = written_once(counts.filter((F.col(old) > hot_rows) | (F.col(new) > hot_rows) | ambiguous))
    size = row_bytes(own)
    found = kept.agg(
        *[x for where in (F.col(old) > hot_rows, F.col(new) > hot_rows) for x in (F.count_if(where), F.sum(F.when(where, size)))],
        F.count_if(ambiguous),
    ).first()
    hot, many = (
        Listed(tuple(keys), kept.filter(F.col(n) > hot_rows).select(*quoted(own), F.col(n).alias(ROWS)), rows, (total or 0) <= limit)
        for n, rows, total in ((old, *found[:2]), (new, *found[2:4]))
    )
    return SharedKeys(hot, many, found[4])


def small_and_repeated(source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES) -> tuple[bool, bool]:
    """Whether the source, hashed in memory, stays within `limit`, and whether a key, none null, has several of its rows. One look."""
    of_key = source.groupBy(*quoted(keys)).agg(F.count("*").alias(ROWS), F.sum(row_bytes(source.columns)).alias(f"{OWN}bytes"))
    total, most = of_key.agg(F.sum(f"{OWN}bytes"), F.max(F.when(none_null(keys), F.col(ROWS)))).first()
    return (total or 0) <= limit, (most or 0) > 1


def ambiguous_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Keys of the target with several source rows, for which an update is not defined. The target's rows are not
    shuffled if such keys are few in the source, and not read if there are none."""
    repeated = listed_keys(as_target(source, target), keys, 1, limit)
    return rows_with(target.select(*quoted(keys)), repeated).distinct()


def as_target(source: DataFrame, target: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
    """The source in the target's columns and types. Text that a partition's name can't hold, '', is null there."""
    if set(target.columns) != set(source.columns):
        raise ValueError(f"the source has columns {source.columns}, the target {target.columns}")
    columns = []
    for f in target.schema:
        value = named(f.name).cast(f.dataType)
        if f.name in partitions and isinstance(f.dataType, StringType):
            value = F.when(value != "", value)
        columns.append(value.alias(f.name))
    return source.select(*columns)
