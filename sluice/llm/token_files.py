"""Token ids of a corpus as raw binary shards, with a minimal perfect hash index from document to payload.

Shards. Documents are range-partitioned and sorted by (doc_id, hash of the text), null ids first. Each task writes its
documents as files `<part>-<n>.ids` of at most about `SHARD_BYTES`: ids one after the other as unsigned integers of 2 bytes (4 if
the vocabulary needs them) in the machines' byte order, nothing between them. Files in the order of their names hold the corpus.

Index. Distinct ids are dealt into buckets of about `BUCKET_KEYS` by hash, one file `<bucket>.mph` each: a minimal perfect hash
of the bucket's ids, then one fixed-size entry under each number: a fingerprint of the id, the shard, the place of its
first token there and the number of tokens. Access by key reads one bucket and one entry, whatever the corpus' size, and
one stretch of one shard. A fingerprint of 32 bits tells unknown ids, but for one in 2**32.

Encoding: whole texts, null as empty, plus an end id. Special tokens' names in a text are ordinary text. A text is cut at places
where the pre-tokeniser always cuts, and each worker keeps the stretches it met last with their ids, up to `KEPT_BYTES`. A very
long text is held as a whole, with its ids, in one task.

Repeated ids: all rows are in the shards, the index knows the first of them, which answers for all. A null id has no key: a
look-up gives null. `checked_rows` reads the payload of each row, whatever its id. No rows: no shards, an empty index. Extra
columns are not read. Tasks that run again write the same files.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sluice.llm.byte_words import WordModel
from sluice.llm.common import bounded_batches, stored
from sluice.llm.perfect_hash import PerfectHash, mixed
from sluice.llm.shared_files import Reader, qualified, write_file
from sluice.llm.stretches import Kept, cut, joined
from sluice.sources.tables import scratch_path

SHARD_BYTES, BUCKET_KEYS, KEPT_BYTES = 32 << 20, 100_000, 80 << 20
_ENTRY = np.dtype([("print", "<u4"), ("n_tokens", "<u4"), ("shard", "<i8"), ("at", "<i8")])
_FINGERPRINT_SEED = 1000


class Encoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._words = WordModel(self.tokenizer)
        (self.line_end,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._kept = Kept(self._made, KEPT_BYTES)

    def encoded(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, each with the end id last, and where each one ends. Null is empty."""
        places, ends = cut(pc.fill_null(texts, ""), ".,")
        codes = places.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return joined(self._kept.of(places.dictionary.to_pylist()), self.kind, codes, ends, end_id)

    def _made(self, stretches: list[str]) -> list[bytes]:
        code = {2: "H", 4: "I"}[self.kind.itemsize]
        made = [ids and array(code, ids).tobytes() for ids in self._words.ids(stretches)]
        others = iter(self._of_any_kind([s for s, ids in zip(stretches, made) if ids is None]))
        return [next(others) if ids is None else ids for ids in made]

    def _of_any_kind(self, stretches: list[str]) -> list[bytes]:
        """Many at a time as lines of one text: the pre-tokeniser cuts at line ends, if no blank but one space is beside them."""
        odd = [k for k, s in enumerate(stretches) if (t := s.removeprefix(" ")) != t.strip() or not t or "\n" in t]
        if odd:
            alone = set(odd)
            lines = iter(self._lines([s for k, s in enumerate(stretches) if k not in alone]))
            others = iter(self._encoded([stretches[k] for k in odd]))
            return [next(others if k in alone else lines) for k in range(len(stretches))]
        return self._lines(stretches)

    def _lines(self, stretches: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(stretches), 2000):
            some = stretches[k : k + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids)) * self.kind.itemsize
            if len(ends) != len(some):
                out += self._encoded(some)
                continue
            data, starts = ids.tobytes(), np.append(0, ends[:-1] + self.kind.itemsize)
            out += [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        return out

    def _encoded(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(texts), 5000):
            some = self.tokenizer.encode_batch_fast(texts[k : k + 5000], add_special_tokens=False)
            out += [np.array(e.ids, self.kind).tobytes() for e in some]
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class TokenFiles:
    """Shards and index in one folder. `shards`: a row for each shard with its first token's place in the corpus."""

    def __init__(self, folder: str, kind: np.dtype, shards: DataFrame, buckets: int, entries: DataFrame, known: DataFrame, n_others: int) -> None:
        """`entries`: doc_id, shard, at, n_tokens of each row; `known`: those in the index; `n_others`: how many are not."""
        self.folder, self.kind, self.shards, self.buckets = folder, kind, shards, buckets
        self.entries, self.known, self.n_others = entries, known, n_others

    def look_up(self, keys: DataFrame, doc_id: str = "doc_id") -> DataFrame:
        """For each row of `keys`: doc_id, start, n_tokens, ids (bytes of the payload), null where the id is unknown."""
        return self._read(keys, doc_id, "ids binary", lambda data: data)

    def checked(self, keys: DataFrame, doc_id: str = "doc_id") -> DataFrame:
        """As `look_up`, but with the crc32 of the ids as 4-byte integers instead of the ids."""
        return self._read(keys, doc_id, "ids_crc32 long", self._crc32())

    def checked_rows(self) -> DataFrame:
        """As `checked`, a row for each row that was written with its own payload: by key where the index knows it, by shard and
        place where its id is null or known for another row."""
        if not self.n_others:
            return self.checked(self.entries)
        known = stored(self.known)
        others = self.entries.join(known.select("shard", "at"), ["shard", "at"], "left_anti")
        others = others.select("doc_id", "shard", "at", "n_tokens")
        return self.checked(known).unionByName(self._payloads_of(others, "ids_crc32 long", self._crc32()))

    def _crc32(self):
        kind = self.kind
        return lambda data: zlib.crc32(np.frombuffer(data, kind).astype("<u4").tobytes())

    def _read(self, keys: DataFrame, doc_id: str, result: str, made) -> DataFrame:
        folder, spark = self.folder, keys.sparkSession
        bounded_batches(spark)
        # Keys meet their bucket, then their shard. Only short rows are dealt out.
        bucket = _bucket(F.col("doc_id"), self.buckets)
        by_bucket = keys.select(F.col(doc_id).cast("long").alias("doc_id")).withColumn("bucket", bucket)
        if not self.buckets:
            by_bucket = by_bucket.filter("false")
        found = by_bucket.repartition(F.col("bucket"), F.pmod(F.xxhash64("doc_id"), F.lit(4))).sortWithinPartitions("bucket").mapInPandas(
            lambda batches: _located(batches, folder), "doc_id long, shard long, at long, n_tokens long"
        )
        return self._payloads_of(found, result, made)

    def _payloads_of(self, found: DataFrame, result: str, made) -> DataFrame:
        folder, kind, name = self.folder, self.kind, result.split()[0]
        bounded_batches(found.sparkSession)
        found = found.repartitionByRange("shard", "at").sortWithinPartitions("shard", "at")
        schema = T.StructType.fromDDL(f"doc_id long, shard long, at long, n_tokens long, {result}")
        read = found.mapInPandas(lambda batches: _payloads(batches, folder, kind, name, made), schema)
        starts = self.shards.select(F.col("shard").alias("of"), F.col("start").alias("base"))
        read = read.join(F.broadcast(starts), F.col("shard") == F.col("of"), "left")
        return read.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", name)


def write(
    docs: DataFrame, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", folder: str | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> TokenFiles:
    """Encode all rows with the tokenizer file at `path` (the same on every executor) and write shards and index."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = qualified(spark, folder or scratch_path(spark))
    kind = encoder(path).kind
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash")
    entries = stored(
        rows.select("doc_id", "text").mapInArrow(
            lambda batches: _written(batches, folder, path, end_id, shard_bytes), "doc_id long, shard long, at long, n_tokens long"
        )
    )
    shards = _starts(entries)
    known = entries.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("shard", "at", "n_tokens")).alias("first"))
    known, count, n_keys = known.select("doc_id", "first.*"), entries.count(), 0
    buckets = -(-count // BUCKET_KEYS)
    if buckets:
        dealt = known.withColumn("bucket", _bucket(F.col("doc_id"), buckets))
        built = dealt.groupBy("bucket").applyInPandas(lambda group: _indexed(group, folder), "bucket long, n_keys long")
        n_keys = built.agg(F.sum("n_keys")).first()[0] or 0
    return TokenFiles(folder, kind, shards, buckets, entries, known, count - n_keys)


def _starts(entries: DataFrame) -> DataFrame:
    """The place of each shard's first token. A row of 16 bytes for each shard passes the driver."""
    sizes = entries.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    starts, before = [], 0
    for r in sizes:
        starts.append((r["shard"], before))
        before += r["n"]
    return entries.sparkSession.createDataFrame(starts, "shard long, start long")


def _bucket(doc_id, buckets: int):
    return F.pmod(F.xxhash64(doc_id, F.lit("bucket")), F.lit(max(1, buckets)))


def _shard_name(shard: int) -> str:
    return f"{shard >> 32:06d}-{shard & 0xFFFFFFFF:06d}.ids"


def _written(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    of = encoder(path)
    shard, held, size = TaskContext.get().partitionId() << 32, [], 0  # size in ids
    for batch in batches:
        ids, ends = of.encoded(batch.column("text"), end_id)
        starts, shards, begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)], [], 0
        at = starts + size
        while begin < len(ends):
            # As many texts as the shard has room for, one at least if it is empty.
            end = int(np.searchsorted(starts, starts[begin] + shard_bytes // of.kind.itemsize - size))
            if end > begin:
                stretch = ids[starts[begin] : ends[end - 1]]
                at[begin:end] = starts[begin:end] - starts[begin] + size
                shards += [shard] * (end - begin)
                held.append(stretch.tobytes())
                size, begin = size + len(stretch), end
            if begin < len(ends):
                write_file(folder, _shard_name(shard), held)
                shard, held, size = shard + 1, [], 0
        columns = [batch.column("doc_id"), pa.array(shards, pa.int64()), pa.array(at), pa.array(ends - starts)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "at", "n_tokens"])
    if held:
        write_file(folder, _shard_name(shard), held)


def _indexed(group: pd.DataFrame, folder: str) -> pd.DataFrame:
    keys = group["doc_id"].to_numpy(np.int64)
    hashed = PerfectHash.of(keys)
    entries = np.zeros(len(keys), _ENTRY)
    number = hashed.numbers(keys)
    entries["print"][number] = _fingerprints(keys)
    for name in ("shard", "at", "n_tokens"):
        entries[name][number] = group[name].to_numpy()
    bucket, bits = int(group["bucket"].iloc[0]), hashed.to_bytes()
    write_file(folder, f"{bucket:06d}.mph", [struct.pack("<Q", len(bits)), bits, entries.tobytes()])
    return pd.DataFrame({"bucket": [bucket], "n_keys": [len(keys)]})


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.view(np.uint64), _FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


class Bucket:
    """One bucket of the index."""

    def __init__(self, folder: str, bucket: int) -> None:
        with Reader(folder, f"{bucket:06d}.mph") as file:
            (size,) = struct.unpack("<Q", file.read(0, 8))
            self.hash = PerfectHash.from_bytes(file.read(8, size))
            self.entries = np.frombuffer(file.read(8 + size, self.hash.size * _ENTRY.itemsize), _ENTRY)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries, and which of the keys are known."""
        number = self.hash.numbers(keys)
        entries = self.entries[np.maximum(number, 0)]
        return entries, (number >= 0) & (entries["print"] == _fingerprints(keys))


def _located(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    number, bucket = -1, None
    for batch in batches:
        for n, group in batch.groupby("bucket", sort=True):
            if n != number:
                number, bucket = n, Bucket(folder, int(n))
            ids = group["doc_id"]
            known = ids.notna().to_numpy()
            keys = ids.fillna(0).to_numpy(np.int64)
            entries, found = bucket.find(keys)
            known &= found
            out = pd.DataFrame({"doc_id": ids.astype("Int64")})
            for name in ("shard", "at", "n_tokens"):
                out[name] = pd.Series(entries[name].astype(np.int64), index=out.index).astype("Int64").where(known)
            yield out


def _payloads(batches: Iterator[pd.DataFrame], folder: str, kind: np.dtype, name: str, made) -> Iterator[pd.DataFrame]:
    number, file = None, None
    for batch in batches:
        out = []
        for shard, at, n in zip(batch["shard"], batch["at"], batch["n_tokens"]):
            if pd.isna(shard):
                out.append(None)
                continue
            if shard != number:
                if file:
                    file.__exit__()
                number, file = shard, Reader(folder, _shard_name(int(shard)))
            out.append(made(file.read(int(at) * kind.itemsize, int(n) * kind.itemsize)))
        result = pd.DataFrame({c: batch[c].astype("Int64") for c in ("doc_id", "shard", "at", "n_tokens")})
        result[name] = pd.Series(out, index=result.index, dtype="Int64" if name == "ids_crc32" else object)
        yield result
    if file:
        file.__exit__()
