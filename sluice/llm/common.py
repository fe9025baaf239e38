"""What several of the operators share: inputs, scratch files, whole rows as one column, batches of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.files import read_file
from sluice.sources.tables import scratch_path

#: Bytes that split words and that exact comparison leaves out: `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_file(spark, f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit what one Arrow batch holds, so that long texts don't add up in a Python worker. Only lowers the limits."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    size = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if not size.isdigit() or int(size) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame) -> DataFrame:
    """`df` written once to the shared scratch folder and read back: computed once, lineage cut, no executor holds it."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names of internal columns can't clash with theirs."""
    return F.struct(*[df[f"`{c.replace('`', '``')}`"] for c in df.columns])


def without_blanks(text: Column) -> Column:
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def smallest_hashes(ids: DataFrame, key: str, rows: int) -> DataFrame:
    """At most `rows` rows, those with the smallest hash of `key`, whose values are distinct. About twice as many are
    brought together to choose from, however many there are."""
    draw = F.shiftrightunsigned(F.xxhash64(F.col(key)), 11) / F.lit(float(1 << 53))
    share = 2 * rows / max(1, ids.count())
    return ids.filter(draw < share).orderBy(draw, key).limit(rows)


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, one after the other, and where each text ends."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    is_word = pc.not_equal(flat, "")
    upto = np.concatenate([[0], np.cumsum(is_word.to_numpy(zero_copy_only=False))])
    return flat.filter(is_word).dictionary_encode(), upto[offsets[1:]].astype(np.int64)
