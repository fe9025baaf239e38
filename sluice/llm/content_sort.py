"""Exact dedup by a content sort.

Rows are range-partitioned by sampled splitters over their normalised bytes and sorted externally, so that equal texts
are adjacent; neighbours are then compared in full. The sort key is a prefix of the normalised bytes and a hash of all of
them, then length and id: it is short whatever the texts are, and as the id is part of it, a group of copies of any size is
split over partitions. Runs of equal texts at the edges of partitions, two or so for each partition, are settled by their
whole text afterwards.

Texts are equal if identical once blanks (`[\\x20\\x09-\\x0D]`) are deleted; null counts as empty. Of a group the row with
the most code points in the original text stays, then the smallest id (null last), then any one of identical rows.
An empty table gives an empty result. Extra columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import BLANKS, bounded_batches, stored, whole_row, without_blanks

PREFIX_CHARS = 48
_RUNS = (
    "part int, run long, doc_id long, head_id long, run_rows long, head boolean, n_chars int, text_sha256 string, "
    "edge_text string"
)
_DELETED = BLANKS.encode()


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows, edges = _settled(docs, text, doc_id, carry=False)
    out = rows.join(F.broadcast(edges), ["part", "run"], "left")
    return out.select(
        "doc_id",
        F.when(F.col("won").isNull(), F.col("head_id")).otherwise(F.col("won_id")).alias("keep_id"),
        F.coalesce("total", "run_rows").alias("group_size"),
        (F.col("head") & F.coalesce("won", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def survivors(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    rows, edges = _settled(docs, text, doc_id, carry=True)
    out = rows.join(F.broadcast(edges), ["part", "run"], "left").filter(F.coalesce("won", F.lit(True)))
    return out.select("row.*")


def _settled(docs: DataFrame, text: str, doc_id: str, carry: bool) -> tuple[DataFrame, DataFrame]:
    """The sorted rows with their runs, and for the runs at edges what they come to together.

    The second is broadcast: it has about two short rows for each partition, however many rows there are.
    """
    runs = stored(_runs(docs, text, doc_id, carry))
    rank = F.struct(-F.col("n_chars"), F.col("head_id").isNull(), "head_id", "part", "run")
    edges = runs.filter("edge_text is not null")
    edges = edges.select("edge_text", "part", "run", "run_rows", rank.alias("rank"))
    best = edges.groupBy("edge_text").agg(F.min("rank").alias("best"), F.sum("run_rows").alias("total"))
    settled = edges.join(best, "edge_text").select(
        "part", "run", "total", F.col("best.head_id").alias("won_id"), (F.col("rank") == F.col("best")).alias("won")
    )
    return runs, settled


def _runs(docs: DataFrame, text: str, doc_id: str, carry: bool) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (whole_row(docs) if carry else F.lit(None).cast("boolean")).alias("row"),
    )
    normal = without_blanks(F.col("text"))
    rows = rows.withColumn("normal", normal).select(
        "doc_id", "text" if not carry else F.lit(None).cast("string").alias("text"), "row",
        F.substring("normal", 1, PREFIX_CHARS).alias("prefix"), F.xxhash64("normal").alias("hash"),
        (-F.char_length("text")).alias("less"),
    )
    key = ["prefix", "hash", "less", F.col("doc_id").asc_nulls_last()]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    if carry:
        rows = rows.withColumn("text", F.coalesce(F.col("row").getField(text), F.lit("")))
    kind = rows.schema["row"].dataType
    schema = T.StructType.fromDDL(_RUNS).add("row", kind)
    return rows.select("doc_id", F.col("text").cast("binary").alias("text"), "prefix", "hash", "less", "row").mapInArrow(
        _marker(carry), schema
    )


class _Run:
    """Rows with one normalised text, all in one partition. Of rows other than the first only the id is held."""

    __slots__ = ("number", "text", "ids", "n_chars", "row")

    def __init__(self, number: int, text: bytes, n_chars: int, row: pa.Array) -> None:
        self.number, self.text, self.n_chars, self.row, self.ids = number, text, n_chars, row, []


def _marker(carry: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first, key = TaskContext.get().partitionId(), 0, None, None
        open_runs: list[_Run] = []  # of the current key: one, unless hashes collide
        closed: list[tuple[_Run, bool]] = []
        for batch in batches:
            doc_ids, prefixes, hashes, less = (batch.column(c).to_pylist() for c in ("doc_id", "prefix", "hash", "less"))
            texts, rows = batch.column("text"), batch.column("row")
            for i, k in enumerate(zip(prefixes, hashes)):
                text = texts[i].as_py().translate(None, _DELETED)
                if k != key:
                    closed += ((r, key == first) for r in open_runs)
                    first, key, open_runs = first or k, k, []
                run = next((r for r in open_runs if r.text == text), None)
                if run is None:
                    run = _Run(number, text, -less[i], rows.take(pa.array([i])) if carry else None)
                    number += 1
                    open_runs.append(run)
                run.ids.append(doc_ids[i])
            if closed:
                yield _written(part, closed, carry, rows.type)
                closed = []
        if open_runs:
            yield _written(part, [(r, True) for r in open_runs], carry, rows.type)

    return mark


def _written(part: int, runs: list[tuple[_Run, bool]], carry: bool, kind: pa.DataType) -> pa.RecordBatch:
    """Columns in the order of `_RUNS`; with `carry`, the first row of each run only."""
    out: list[list] = [[] for _ in range(8)]
    for run, edge in runs:
        sha = hashlib.sha256(run.text).hexdigest()
        for i, doc_id in enumerate(run.ids[:1] if carry else run.ids):
            edge_text = run.text.decode() if edge and i == 0 else None
            values = (run.number, doc_id, run.ids[0], len(run.ids), i == 0, run.n_chars, sha, edge_text)
            for column, value in zip(out, values):
                column.append(value)
    rows = pa.concat_arrays([r.row for r, _ in runs]) if carry else pa.nulls(len(out[0]), kind)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string(), pa.string())
    names = ["part", "run", "doc_id", "head_id", "run_rows", "head", "n_chars", "text_sha256", "edge_text", "row"]
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(out[0]), pa.int32()), *(pa.array(c, k) for c, k in zip(out, kinds)), rows], names=names
    )
