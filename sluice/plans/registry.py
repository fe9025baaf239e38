"""The table of specs: one row per pipeline."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.plans.pipeline import upsert_table
from sluice.plans.spec import TableSpec
from sluice.sources.tables import add_columns, create_or_replace_table

# The columns of the registry but the last, which a registry may lack.
REGISTRY_SCHEMA = (
    "pipeline_name string, file_path string, header string, delimiter string, table_name string, "
    "schema_detail map<string,string>, keys array<string>, write_mode string, reject_malformed string"
)
# As it is built, before names and types make the map.
_BUILT_SCHEMA = REGISTRY_SCHEMA.replace("schema_detail map<string,string>", "names array<string>, types array<string>")


def create_registry(spark: SparkSession, table: str) -> None:
    create_or_replace_table(spark, table, REGISTRY_SCHEMA)


def register(spark: SparkSession, table: str, spec: TableSpec) -> None:
    """Add the spec, or replace the one of its name. The map is built in column order, which it keeps. A registry without the last
    column gets it."""
    header = None if spec.header is None else str(spec.header).lower()
    types = [t for _, t in spec.columns]
    row = (spec.name, spec.file_path, header, spec.delimiter, spec.table_name, spec.column_names, types)
    built = (
        spark.createDataFrame(
            [(*row, list(spec.keys), spec.write_mode, str(spec.reject_malformed).lower())],
            _BUILT_SCHEMA,
        )
        .withColumn("schema_detail", F.map_from_arrays("names", "types"))
        .drop("names", "types")
    )
    add_columns(built, table)
    upsert_table(built, table, ["pipeline_name"])


def lookup(spark: SparkSession, table: str, name: str) -> TableSpec:
    row = (
        spark.table(table)
        .filter(F.col("pipeline_name") == name)
        .withColumn("schema_detail", F.map_entries("schema_detail"))
        .first()
    )
    if row is None:
        raise KeyError(f"{table} has no pipeline named {name!r}")
    return TableSpec(
        name=row.pipeline_name,
        file_path=row.file_path,
        table_name=row.table_name,
        columns=row.schema_detail,
        keys=row["keys"],
        header=row.header,
        delimiter=row.delimiter,
        write_mode=row.write_mode,
        reject_malformed=row.asDict().get("reject_malformed") == "true",
    )
