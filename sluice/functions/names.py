"""Columns by their literal name, whatever characters it holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the names of columns that the operators add for themselves begin with.
OWN = "_sluice_"


def quoted(columns: Iterable[str]) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def named(column: str) -> Column:
    return F.col(quoted([column])[0])


def check_names(*tables: Iterable[str]) -> None:
    """Raise where a column has a name that the operators may give to their own."""
    taken = sorted({c for columns in tables for c in columns if c.lower().startswith(OWN)})
    if taken:
        raise ValueError(f"column names that begin with {OWN} are reserved, got {taken}")
