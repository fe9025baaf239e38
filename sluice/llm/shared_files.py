"""Files that executors write and read themselves, in a folder all of them share (a path or URI that pyarrow knows)."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark takes it by: pyarrow takes one without a scheme as a folder of the machine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    whole = files.makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def write_file(folder: str, name: str, parts: list[bytes]) -> None:
    """Put a file in place whole or not at all; a repeated task replaces it by the same bytes."""
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    draft = f"{at}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, f"{at}/{name}")


class Reader:
    """Random reads of one file."""

    def __init__(self, folder: str, name: str) -> None:
        store, at = fs.FileSystem.from_uri(folder)
        self._file = store.open_input_file(f"{at}/{name}")
        self.size = self._file.size()

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_: object) -> None:
        self._file.close()

    def read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)
