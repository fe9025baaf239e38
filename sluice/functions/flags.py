"""Boolean flag columns, each named after the reason it stands for."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.names import named, quoted


def any_of(flags: Iterable[Column]) -> Column:
    flags = list(flags)
    return reduce(Column.__or__, flags) if flags else F.lit(False)


def none_null(columns: Iterable[str]) -> Column:
    return reduce(Column.__and__, [named(c).isNotNull() for c in columns])


def reasons(flags: Mapping[str, Column]) -> Column:
    """The names of the true flags as an array, in name order. The order is settled here, so no row needs a sort."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(flags[name], F.array(F.lit(name))).otherwise(none) for name in sorted(flags)])


def flagged_rows(df: DataFrame, flags: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """The rows with a true flag, with an array of the reasons. No shuffle: a row is never taken apart."""
    return df.filter(any_of(flags.values())).select(*quoted(keep), reasons(flags).alias("reason"))


def flags_to_rows(df: DataFrame, flags: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per row and true flag: the kept columns, `reason` and `status`."""
    kept = quoted(keep)
    if not flags:
        return df.filter(F.lit(False)).select(*kept, F.lit("").alias("reason"), F.lit(True).alias("status"))
    return df.filter(any_of(map(named, flags))).unpivot(kept, quoted(flags), "reason", "status").filter("status")
