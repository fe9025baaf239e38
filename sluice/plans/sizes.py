"""Measured sizes, for the choice of a plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.names import named

BROADCAST_BYTES = 64 << 20
ROW_BYTES, CELL_BYTES = 48, 16


def measured(df: DataFrame, limit: int = BROADCAST_BYTES, most: str | None = None) -> tuple[int, bool] | tuple[int, bool, int]:
    """The number of rows, whether they, hashed in memory, stay within `limit`, and the greatest value of the column `most`, if one is
    given, or 0. One aggregate; one row comes back."""
    if limit < 0:
        raise ValueError(f"the limit must not be negative, got {limit}")
    wanted = [F.coalesce(F.max(named(most)), F.lit(0))] if most else []
    rows, total, *greatest = df.agg(F.count("*"), F.coalesce(F.sum(row_bytes(df.columns)), F.lit(0)), *wanted).first()
    return rows, total <= limit, *greatest


def row_bytes(columns: Sequence[str]) -> Column:
    """About what a row of these columns takes, hashed in memory."""
    text = sum((F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))
    return text + F.lit(ROW_BYTES + CELL_BYTES * len(columns))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, file_bytes: int = 0) -> bool:
    """Whether the rows stay within `limit`. If they are files of more bytes, nothing is read to tell."""
    return file_bytes <= limit and measured(df, limit)[1]
