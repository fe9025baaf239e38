"""Delimited-text and Parquet files, with provenance columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted file extensions, each the name of its reader.
FORMATS = ("csv", "parquet")

#: The raw table's column for the text of rows that do not have the file's number of fields.
MALFORMED = "_malformed_row"


def file_format(path: str) -> str:
    """The reader for a path: the text after its last dot."""
    extension = path.rstrip("/").rsplit(".", 1)[-1]
    if extension not in FORMATS:
        raise ValueError(f"{path}: the extension must be one of {FORMATS}")
    return extension


def read_file(
    spark: SparkSession,
    path: str,
    header: bool | str | None = None,
    delimiter: str | None = None,
    mark_malformed: bool = False,
) -> DataFrame:
    """Every CSV column is read as a string, with no pass over the file to guess types; Parquet keeps its own types.

    CSV rows with fewer fields than the first line end in NULLs, those with more lose the rest. `mark_malformed` adds a column,
    `MALFORMED`, that has the whole text of such a row and is NULL in all others; Spark wants it read with some other column.
    A delimiter in quotes is part of its field; a row over several lines is read as one only up to the first line end, and
    so is malformed.
    """
    reader = spark.read.format(file_format(path))
    if header is not None:
        reader = reader.option("header", header)
    if delimiter is not None:
        reader = reader.option("delimiter", delimiter)
    if not mark_malformed:
        return reader.load(path)
    if file_format(path) != "csv":
        raise ValueError(f"{path}: only delimited rows can be malformed")
    columns = T.StructType([T.StructField(c, T.StringType()) for c in [*reader.load(path).columns, MALFORMED]])
    # Without pruning, as fields that are not parsed are not counted either.
    marked = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    return reader.schema(columns).options(**marked).load(path)


def with_provenance(df: DataFrame) -> DataFrame:
    """Add load time and source file; `df` must come straight from a file scan, which supplies `_metadata`."""
    return df.withColumns(
        {
            # The names of the raw table's control columns.
            "_load_dt": F.current_date(),
            "_load_dttm": F.current_timestamp(),
            "_file_name": F.col("_metadata.file_name"),
            "_file_path": F.col("_metadata.file_path"),
            "_file_size": F.col("_metadata.file_size"),
            "_file_mod": F.col("_metadata.file_modification_time"),
        }
    )
