"""Format rules and casts of raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.names import named

# The accepted text of a column, by declared type.
FORMAT_RULES = {
    "int": r"^[0-9]+$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
}


#: Other names of types that have rules.
_SAME = {"integer": "int"}


def simple_type(data_type: str) -> str:
    """The type's name as rules know it, whatever its letter case and spaces."""
    name = "".join(data_type.lower().split())
    return _SAME.get(name, name)


def breaks_format(column: str, data_type: str) -> Column:
    """True where the text does not have the form of its type; never NULL, and false for NULL text.

    The rule reads the form only, so `2025-99-99` passes. A type with no rule of its own is
    checked by whether the text can be cast to it.
    """
    text, rule = named(column).cast("string"), FORMAT_RULES.get(simple_type(data_type))
    if rule:
        return F.coalesce(~text.rlike(rule), F.lit(False))
    return text.isNotNull() & text.try_cast(data_type).isNull()


def typed(column: str, data_type: str) -> Column:
    """The column in its declared type, NULL where the text does not fit, whatever the session's ANSI setting."""
    return named(column).try_cast(data_type).alias(column)
