"""Catalog tables: reads, writes, replacement of rows, and scratch data in the folder the cluster shares."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.names import named, quoted

SCRATCH_DATABASE, PENDING = "sluice_scratch", "sluice_pending"

#: Names of the files that Spark's Parquet writer makes: the task, and the number of its file, of which a task has few.
_PART, _FILES_OF_TASK = r"part-(\d+)-[0-9a-f-]+-?c(\d{1,3})\..*parquet", 1000

#: The column that tells the runs of a job apart.
RUN = "_run_id"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def stored_row_id(table: DataFrame) -> Column | None:
    """A number for each row of a table, by its file and its place there: the same in every read, however the files are split.

    For Parquet tables that one job has written, as raw tables are: there the names of files count the job's tasks and their files. None
    for others.
    """
    numbers = [re.fullmatch(_PART, unquote(f.rsplit("/", 1)[-1])) for f in table.inputFiles()]
    if not numbers or not all(numbers) or len({m.groups() for m in numbers}) < len(numbers):
        return None
    task, file = (F.regexp_extract("_metadata.file_name", _PART, k).cast("long") for k in (1, 2))
    return F.shiftleft(task * _FILES_OF_TASK + file, 36) + F.col("_metadata.row_index")


def write_table(df: DataFrame, name: str, mode: str) -> None:
    """`overwrite` replaces the rows and, where it differs, the schema. `append` adds rows: columns that the table lacks are added to it
    and NULL in the rows it has, columns that `df` lacks are NULL in the new rows."""
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name) and _lower(df.columns) != _lower(spark.table(name).columns):
        _in_columns(df, add_columns(df, name)).write.insertInto(name)
    else:
        df.write.mode(mode).saveAsTable(name)


def _lower(names: Iterable[str]) -> set[str]:
    return {n.lower() for n in names}


def add_columns(df: DataFrame, name: str) -> StructType:
    """Add the columns of `df` that the table lacks to the table; its schema then. Files are not touched."""
    spark = df.sparkSession
    known = _lower(spark.table(name).columns)
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"{quoted([f.name])[0]} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return spark.table(name).schema


def _in_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """By name; what `df` lacks is NULL."""
    own = {c.lower(): c for c in df.columns}
    there = [named(own[f.name.lower()]) if f.name.lower() in own else F.lit(None).cast(f.dataType) for f in schema]
    return df.select(*[c.alias(f.name) for c, f in zip(there, schema, strict=True)])


def write_run(df: DataFrame, name: str, run_id: str) -> None:
    """Put `df` in place of all rows that this run wrote to the table before; the rows of other runs stay.

    The table is partitioned by the run, `RUN`. It is made if it is not there, and takes columns of `df` that it lacks. A run that was
    cut off may leave a part of its rows, or none where it had some, until it is repeated. Repeating it, however often, gives
    the rows of one run, also where the repetition has none.
    """
    spark = df.sparkSession
    if not run_id:
        raise ValueError("a run needs a name")
    if not spark.catalog.tableExists(name):
        empty = spark.createDataFrame([], df.schema).withColumn(RUN, F.lit(run_id))
        empty.write.partitionBy(RUN).saveAsTable(name)
    if partition_columns(spark, name) != [RUN]:
        raise ValueError(f"{name} is not partitioned by {RUN}, so that the rows of a run can't be replaced")
    columns = StructType([f for f in add_columns(df, name) if f.name != RUN])
    of_run = run_id.replace("\\", "\\\\").replace("'", "\\'")
    insert = f"INSERT OVERWRITE TABLE {name} PARTITION ({RUN} = '{of_run}') SELECT * FROM {{rows}}"
    spark.sql(insert, rows=_in_columns(df, columns))


def write_partitioned(df: DataFrame, name: str, by: str) -> None:
    """As `write_table` with `overwrite`, partitioned by a column of few values, each partition written by few tasks."""
    df.hint("rebalance", *quoted([by])).write.mode("overwrite").partitionBy(by).saveAsTable(name)


def drop_partitions(spark: SparkSession, name: str, by: str, values: DataFrame) -> None:
    """Drop those partitions of the table whose value is in the one column of `values`; a value comes to the driver for each."""
    parts = spark.sql(f"SHOW PARTITIONS {name}").select(F.substring_index("partition", "=", -1).alias("part"))
    told = values.toDF("value").select(F.coalesce(F.col("value").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("part"))
    for row in parts.join(told.distinct(), "part").collect():
        of = "NULL" if row.part == "__HIVE_DEFAULT_PARTITION__" else f"'{row.part}'"
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({by} = {of})")
    spark.catalog.refreshTable(name)


def create_or_replace_table(spark: SparkSession, name: str, schema: str) -> None:
    """An empty table of the given schema, in place of whatever bore the name."""
    write_table(spark.createDataFrame([], schema), name, "overwrite")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return _described(spark, name).get("partition_columns", [])


def bucket_columns(spark: SparkSession, name: str) -> list[str]:
    return _described(spark, name).get("bucket_columns", [])


def _described(spark: SparkSession, name: str) -> dict:
    """What the catalog knows of a table. Unlike a list of its columns, this starts no job."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])


def replace_rows(df: DataFrame, name: str, only_its_partitions: bool = False) -> None:
    """Put `df`, which may read the table, in place of its rows, or of those in the partitions it has rows for.

    The table itself stays, with its format, partitioning, comment and properties. The new rows are written in full
    beside the tables first, and the table is overwritten from there. If this second write is cut off, readers see a part
    of the rows, and the copy is left: `finish_replacement` then writes it again. One replacement of a table at a time.
    """
    spark = df.sparkSession
    copy = f"{_pending(spark, name)}/{'partitions' if only_its_partitions else 'all'}-{uuid.uuid4().hex}"
    df.select(*quoted(spark.table(name).columns)).write.parquet(copy)
    _overwrite(spark, name, copy)


def finish_replacement(spark: SparkSession, name: str) -> None:
    """Finish replacements of the table's rows that were cut off, or drop what they left before it was complete."""
    files, path = _files(spark, _pending(spark, name))
    for copy in sorted(str(f.getPath()) for f in files.listStatus(path)) if files.exists(path) else ():
        if files.exists(_path(spark, f"{copy}/_SUCCESS")):
            _overwrite(spark, name, copy)
        else:
            _delete(spark, copy)


def _overwrite(spark: SparkSession, name: str, copy: str) -> None:
    # The overwrite mode is a session setting; a session of its own leaves the caller's as it is.
    session = spark.newSession()
    dynamic = copy.rsplit("/", 1)[-1].startswith("partitions-")
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic" if dynamic else "static")
    rows, partitions = session.read.schema(spark.table(name).schema).parquet(copy), partition_columns(spark, name)
    if partitions:
        rows = rows.hint("rebalance", *quoted(partitions))
    rows.write.insertInto(_full_name(spark, name), overwrite=True)
    spark.catalog.refreshTable(name)
    _delete(spark, copy)


def _full_name(spark: SparkSession, name: str) -> str:
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def _pending(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{PENDING}/{quote(_full_name(spark, name).lower(), safe='')}"


def shared_folder(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names, or else one in the warehouse: both are shared by all executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_sluice"


_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, suffix: str = "") -> str:
    path = f"{shared_folder(spark)}/{SCRATCH_DATABASE}_files/{uuid.uuid4().hex}{suffix}"
    if (made := _scope.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """The scratch paths that are given out within, so that who writes a result can `drop_paths` what it was made from."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield made
    finally:
        _scope.reset(token)


def drop_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        _delete(spark, path)


def write_scratch_table(df: DataFrame) -> str:
    """Write `df` once and return the table's name; the caller drops the table."""
    folder = f"{shared_folder(df.sparkSession)}/{SCRATCH_DATABASE}"
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{folder}'")
    name = f"{SCRATCH_DATABASE}.t_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    return name


def scratch_bytes(spark: SparkSession, name: str) -> int:
    """The size of a scratch table's files."""
    files, path = _files(spark, f"{shared_folder(spark)}/{name.replace('.', '/')}")
    return files.getContentSummary(path).getLength()


def written_once(df: DataFrame) -> DataFrame:
    """`df` computed once, kept by a checkpoint in the shared folder. Spark removes it when nothing refers to it any
    more, where `spark.cleaner.referenceTracking.cleanCheckpoints` is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def scratch_database(spark: SparkSession) -> tuple[str, str]:
    """A new database in the shared folder, and a folder for files beside it."""
    folder = scratch_path(spark)
    database = f"{SCRATCH_DATABASE}_{folder.rsplit('/', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    return database, folder


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch files and databases of `scratch_path` and `scratch_database`. For when no result that reads them
    is in use: results of queries are lazy, so only their reader can tell."""
    for row in spark.sql(f"SHOW DATABASES LIKE '{SCRATCH_DATABASE}_*'").collect():
        spark.sql(f"DROP DATABASE IF EXISTS {row[0]} CASCADE")
    _delete(spark, f"{shared_folder(spark)}/{SCRATCH_DATABASE}_files")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = _path(spark, path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def _delete(spark: SparkSession, path: str) -> None:
    files, found = _files(spark, path)
    files.delete(found, True)
