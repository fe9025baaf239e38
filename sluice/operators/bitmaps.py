"""Bitmaps of key hashes, which split rows where a list of keys is too long to broadcast.

Each listed key sets one bit. A key whose bit is not set is surely not in the list; one whose bit is set is, or shares the bit
with a listed key. So a bitmap tells a superset of the rows that have listed keys. It has `BITS_PER_KEY` bits for each of them, or fewer
so as to stay within the limit of bytes, whatever the number of keys: it takes a list over a hundred times as long as the keys
themselves would in the same limit. The bits are stored as long numbers, of which a look-up reads one; from a binary value it would
copy the whole part of the bitmap for each row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.flags import none_null
from sluice.functions.names import OWN, named
from sluice.plans.sizes import CELL_BYTES, ROW_BYTES
from sluice.sources.tables import written_once

BUCKET_BITS = 1 << 15  # fixed value: the bits of one bitmap of Spark's functions
WORD_BITS = 64
BITS_PER_KEY = 16
BUCKET, BITS, PLACE = f"{OWN}bucket", f"{OWN}bits", f"{OWN}place"


@dataclass(frozen=True)
class KeyBits:
    """A bitmap of keys, stored in rows of `BUCKET_BITS` bits, within the limit it was made for."""

    keys: tuple[str, ...]
    rows: DataFrame
    size: int


def bits_within(limit: int) -> int:
    """The bits of the largest bitmap that, hashed in memory, stays within `limit` bytes: a power of two, or 0."""
    buckets = limit // (BUCKET_BITS // 8 + ROW_BYTES + 2 * CELL_BYTES)
    return BUCKET_BITS << (buckets.bit_length() - 1) if buckets else 0


def key_bits(listed: DataFrame, keys: Sequence[str], columns: Sequence[str], count: int, limit: int) -> KeyBits | None:
    """The bitmap of the `count` keys in `listed`, where `columns` hold the values of `keys`. None if the keys are more than half
    the bits, so that too many others would share theirs, or where equal texts need not have equal bytes."""
    size = min(bits_within(limit), max(BUCKET_BITS, 1 << (BITS_PER_KEY * count - 1).bit_length()))
    if 2 * count > size or any("collate" in listed.schema[c].dataType.simpleString() for c in columns):
        return None
    place = listed.select((_place(columns, size) + 1).alias(PLACE))  # Spark's functions number bits and buckets from 1
    place = place.select(F.bitmap_bucket_number(PLACE).alias(BUCKET), F.bitmap_bit_position(PLACE).alias(PLACE))
    # Dealt by bucket first: a task that made parts of all buckets would send the whole bitmap.
    bits = place.repartition(BUCKET).groupBy(BUCKET).agg(F.bitmap_construct_agg(PLACE).alias(BITS))
    return KeyBits(tuple(keys), written_once(bits.select(BUCKET, _words().alias(BITS))), size)


def _words() -> Column:
    """The bytes of a bitmap as long numbers, the first byte of each uppermost."""
    starts = F.sequence(F.lit(1), F.lit(BUCKET_BITS // 8), F.lit(WORD_BITS // 8))
    return F.transform(starts, lambda at: F.conv(F.hex(F.substring(F.col(BITS), at, F.lit(WORD_BITS // 8))), 16, -10).cast("long"))


def rows_maybe_with(rows: DataFrame, bits: KeyBits, where: Column | None = None) -> DataFrame:
    """The rows whose key is listed and some others, all with no null in the key, for which `where` holds."""
    return rows.join(F.broadcast(bits.rows), _is_set(bits, where), "left_semi")


def rows_surely_without(rows: DataFrame, bits: KeyBits, where: Column | None = None) -> DataFrame:
    """The rows that `rows_maybe_with` leaves."""
    return rows.join(F.broadcast(bits.rows), _is_set(bits, where), "left_anti")


def _place(columns: Sequence[str], size: int) -> Column:
    """From 0; `size` is a power of two."""
    return F.xxhash64(*map(named, columns)).bitwiseAND(F.lit(size - 1))


def _is_set(bits: KeyBits, where: Column | None) -> Column:
    """For a row and the part of the bitmap that it meets. Nothing in it can be null but the row's key, so no filter is carried over from
    one side to the other: one broadcast serves all joins."""
    place = _place(bits.keys, bits.size)
    at = place.bitwiseAND(F.lit(BUCKET_BITS - 1))
    word = F.get(BITS, F.shiftright(at, WORD_BITS.bit_length() - 1).cast("int"))
    # Bytes are counted from a word's upper end, bits in them from the lower one.
    bit = at.bitwiseAND(F.lit(WORD_BITS - 1)).bitwiseXOR(F.lit(WORD_BITS - 8)).cast("int")
    match = (F.shiftright(place, BUCKET_BITS.bit_length() - 1) + 1 == F.col(BUCKET)) & none_null(bits.keys)
    match = match & (F.getbit(word, bit) == 1)
    return match if where is None else match & where
