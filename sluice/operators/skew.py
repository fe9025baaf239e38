"""Joins and splits that hold when one key has a large part of the rows.

Keys are counted on the key columns alone, combined before the shuffle, and the list of those above a bound is stored once and
measured. Rows of listed keys are told from the others by broadcasting the list if it is small; otherwise list and
rows meet by key and slot: rows are dealt over `SLOTS` slots and the list is repeated in each. Of a list of over `SLOTTED_KEYS` keys
only those with more than `HOT_ROWS` rows are repeated, and only their rows are dealt; the others have one slot, so that a long list
is shuffled once. Rows of a hot key are never shuffled by that key alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.flags import none_null
from sluice.functions.names import OWN, named, quoted
from sluice.plans.sizes import BROADCAST_BYTES, measured
from sluice.sources.tables import written_once

HOT_ROWS = 1_000_000
SLOTS = 64
SLOTTED_KEYS = 1 << 14
ROWS, SLOT, HOT = f"{OWN}rows", f"{OWN}slot", f"{OWN}hot"


@dataclass(frozen=True)
class Listed:
    """Keys, each once and none null, with their number of rows (`ROWS`), stored and measured."""

    keys: tuple[str, ...]
    rows: DataFrame
    count: int
    few: bool  # small enough to broadcast
    most: int | None = None  # the greatest number of rows, where it has been looked up
    limit: int = BROADCAST_BYTES  # what `few` was measured by

    def above(self, rows: int, limit: int = BROADCAST_BYTES) -> Listed:
        """The keys with more rows than this."""
        return _measured(self.rows.filter(F.col(ROWS) > rows), self.keys, limit)


def key_counts(rows: DataFrame, keys: Sequence[str], above: int) -> DataFrame:
    """The keys with more than `above` rows, and how many (`ROWS`). Keys with a null are left out."""
    return (
        rows.filter(none_null(keys)).groupBy(*quoted(keys)).agg(F.count("*").alias(ROWS)).filter(F.col(ROWS) > above)
    )


def listed_keys(rows: DataFrame, keys: Sequence[str], above: int, limit: int = BROADCAST_BYTES) -> Listed:
    """The keys of `rows` with more than `above` rows. Counts them once."""
    counts = key_counts(rows, keys, above)
    return _measured(written_once(counts.select(*[named(k).alias(own_key(k)) for k in keys], ROWS)), tuple(keys), limit)


def _measured(rows: DataFrame, keys: Sequence[str], limit: int) -> Listed:
    return Listed(tuple(keys), rows, *measured(rows, limit, ROWS), limit)


def own_key(key: str) -> str:
    return f"{OWN}key_{key}"


def same_key(keys: Sequence[str]) -> Column:
    """Null-safe, so that no filter on one side is carried over to the other: then one broadcast serves all joins."""
    return reduce(Column.__and__, [named(k).eqNullSafe(named(own_key(k))) for k in keys])


def rows_with(rows: DataFrame, listed: Listed, where: Column | None = None) -> DataFrame:
    """The rows whose key is listed and for which `where` holds."""
    return _split(rows, listed, "left_semi", where)


def rows_without(rows: DataFrame, listed: Listed, where: Column | None = None) -> DataFrame:
    """The other rows, those with a null key included."""
    return _split(rows, listed, "left_anti", where)


def _split(rows: DataFrame, listed: Listed, how: str, where: Column | None) -> DataFrame:
    if not listed.count:
        return rows if how == "left_anti" else rows.filter(F.lit(False))
    match = same_key(listed.keys)
    if where is not None:
        match = match & where
    if listed.few:
        return rows.join(F.broadcast(listed.rows.select(*quoted(map(own_key, listed.keys)))), match, how)
    left, right = slotted(rows, listed.rows, listed)
    return left.join(right.drop(ROWS), match & (F.col(SLOT) == F.col(f"{SLOT}s")), how).drop(SLOT)


def slotted(rows: DataFrame, facts: DataFrame, listed: Listed) -> tuple[DataFrame, DataFrame]:
    """Rows with a slot (`SLOT`), and facts, which name some of the listed keys as the list does, in each slot (`SLOT` and an s) that
    their rows may have. A row without a listed key meets no fact, in whichever slot."""
    hot = None
    if listed.count > SLOTTED_KEYS and listed.most is not None:
        hot = listed.above(HOT_ROWS, listed.limit) if listed.most > HOT_ROWS else listed
    if hot is None or hot is not listed and not hot.few:
        return dealt(rows), in_all_slots(facts).withColumnRenamed(SLOT, f"{SLOT}s")
    spread, one, own = ~none_null(listed.keys), F.lit(0), list(map(own_key, listed.keys))
    if hot is listed:
        # Not a literal 0: the planner would leave the slot out of the shuffle, and rows with a null key would gather.
        facts = facts.withColumn(f"{SLOT}s", F.pmod(F.xxhash64(*quoted(own)), F.lit(1)).cast("int"))
    else:
        of_hot = hot.rows.select(*quoted(own), F.lit(True).alias(HOT))
        facts = facts.join(F.broadcast(of_hot), own, "left")
        facts = facts.withColumn(f"{SLOT}s", F.explode(F.when(F.col(HOT), F.array([F.lit(k) for k in range(SLOTS)])).otherwise(F.array(one))))
        facts = facts.drop(HOT)
        rows = rows.join(F.broadcast(of_hot), same_key(listed.keys), "left").drop(*own)
        spread = spread | F.col(HOT).isNotNull()
    return dealt(rows).withColumn(SLOT, F.when(spread, F.col(SLOT)).otherwise(one)).drop(HOT), facts


def dealt(rows: DataFrame) -> DataFrame:
    """With a slot for each row, whatever it holds."""
    return rows.withColumn(SLOT, F.pmod(F.monotonically_increasing_id(), F.lit(SLOTS)).cast("int"))


def in_all_slots(rows: DataFrame) -> DataFrame:
    """Each row once for each slot."""
    return rows.withColumn(SLOT, F.explode(F.array([F.lit(k) for k in range(SLOTS)])))


def join_spread(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by key and slot: for rows of hot keys and facts with one row for each. The planner may broadcast the facts."""
    return dealt(rows).join(in_all_slots(facts), [*keys, SLOT], how).drop(SLOT)


def join_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    how: str,
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """`left` or `left_anti` join with a table of any size, with one row per key (of those in `rows`) and no null key.

    Rows of hot keys meet their facts by key and slot, rows with a null key meet none, all others by a shuffle.
    """
    keys = list(keys)
    hot = listed_keys(rows, keys, hot_rows, limit)
    whole = rows.filter(none_null(keys))
    alone = rows.filter(~none_null(keys))
    if how == "left":
        alone = alone.withColumns({f.name: F.lit(None).cast(f.dataType) for f in facts.schema if f.name not in keys})
    joined = rows_without(whole, hot).join(facts, keys, how).unionByName(alone)
    if hot.count:
        joined = joined.unionByName(join_spread(rows_with(whole, hot), rows_with(facts, hot), keys, how))
    return joined
