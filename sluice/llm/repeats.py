"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of `LENGTH` bytes that covers it also starts elsewhere, in any document (`every`), or elsewhere
earlier (`later`: the first copy stays). Documents are ordered by id, then by hash of the text; matches never cross them.

1. Anchors. Each start of a string is owned by an anchor, the place in the string at which a stretch of `STRETCH` bytes has the smallest
   hash. Equal strings have equal anchors at equal places, so only anchors whose hash occurs twice matter. The starts that an
   anchor owns are a block. Counts of hashes are combined before the shuffle.
2. Copies. Blocks with the same content are copies as a whole; one of them, the first, stands for all.
3. Longest previous factors. Blocks of one anchor whose contents differ meet in one task, as bytes. There the starts with a window
   that has company are put in suffix order; previous and next smaller positions in it give the nearest earlier match, and
   how far it goes: as the match of the next start is at most one byte shorter, all starts within are settled at once.
4. Anchors with more than `HOT_BLOCKS` different blocks, such as the edges of a passage that a third of all documents share, never meet in
   one task: their starts are dealt by the content that is common to `CLASS` of them, and those still open one by one by the
   hash of the string, and counted.
5. Starts become spans of bytes for each document; documents without any are not read again.

Bytes decide in step 3; in steps 2 and 4 two hashes of 64 bits do. Texts are taken as UTF-8, null as empty. Texts shorter
than `LENGTH` have no span. Rows that repeat are documents of their own, with the same spans; a null id stays null.
An empty table gives an empty result. A very long text is held as a whole in one task; it is hashed 1 MB at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches, stored

LENGTH, STRETCH, CLASS = 400, 128, 32
HOT_BLOCKS, BATCH_BLOCKS, SUFFIX_ROWS = 2000, 4000, 20_000
_SLAB = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_TABLES = [np.random.default_rng(k).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1) for k in (31, 32)]


class Hashes:
    """Hashes of any stretch of some bytes: polynomials modulo 2**64, from sums over prefixes."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        self.power, self.inverse = self._up_to(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[which][data] * self.power[: len(data)], out=self.sums[1:])

    @classmethod
    def _up_to(cls, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        held = cls._powers.get(which)
        if held is None or len(held[0]) < n:
            size, base = max(n, 1 << 12), _BASES[which]
            held = tuple(
                np.cumprod(np.array([1] + [b] * size, np.uint64), dtype=np.uint64)
                for b in (base, pow(base, -1, 1 << 64))
            )
            if size <= 2 * _SLAB:
                cls._powers[which] = held
        return held

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours."""
    size = 1
    while size * 2 <= width:
        a, size = np.minimum(a[:-size], a[size:]), size * 2
    return np.minimum(a[: len(a) - (width - size)], a[width - size :]) if size < width else a


def anchors(data: bytes, length: int = LENGTH, stretch: int = STRETCH) -> tuple[np.ndarray, ...]:
    """Of each block of starts: hash of the anchor, hash of the content, first start, number of starts, place of the anchor."""
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, len(data) - length + 1), _SLAB):
        part = np.frombuffer(data, np.uint8, min(len(data) - at, _SLAB + length - 1), at)
        hashes, n = Hashes(part), len(part)
        begin = np.arange(n - stretch + 1)
        h = hashes.of(begin, begin + stretch)
        # The place in the lowest bits: the smallest hash's first place. A slab's places fit.
        key = (h >> np.uint64(21) << np.uint64(21)) | begin.astype(np.uint64)
        owner = (_least(key, length - stretch + 1) & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        count = np.diff(np.append(first, len(owner)))
        place = owner[first] - first
        content = hashes.of(first, first + count + length - 1) ^ _mix(place.astype(np.uint64) << np.uint64(32) | count.astype(np.uint64))
        found.append((h[owner[first]].view(np.int64), content.view(np.int64), first + at, count, place))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


# ---------------------------------------------------------------- spans for each document


def kept_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_first: bool = False) -> DataFrame:
    """`spans`, but with the bytes that stay of every row as kept, whether or not any go."""
    rows, found, _ = _found(docs, text, doc_id, keep_first)
    whole = F.col("text")
    everything = rows.select("doc_id", "doc", "hash", F.length(whole).cast("long").alias("n_bytes"), "text")
    return _result(everything.join(found, ["doc", "hash"], "left"), F.coalesce("kept", whole), F.coalesce("sha256", F.sha2(whole, 256)))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_first: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, spans (array of start and end), kept (the other bytes; null if all stay),
    kept_sha256."""
    _, found, marked = _found(docs, text, doc_id, keep_first)
    everything = marked.select("doc_id", "doc", "hash", "n_bytes", F.col("sha256").alias("whole_sha256"))
    return _result(everything.join(found, ["doc", "hash"], "left"), F.col("kept"), F.coalesce("sha256", "whole_sha256"))


def _found(docs: DataFrame, text: str, doc_id: str, keep_first: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their keys, spans and what stays of those that lose any, and the rows with their blocks."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("hash")]
    rows = rows.select("doc_id", *key, F.col("text").cast("binary").alias("text"))
    marked = stored(rows.mapInPandas(_marked, _MARKED))
    starts = stored(_starts(rows, marked, keep_first))
    per_doc = starts.groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "count")).alias("starts"))
    found = _with_text(rows, per_doc).mapInPandas(_cut, _CUT)
    return rows, found.groupBy("doc", "hash").agg(*[F.first(c).alias(c) for c in ("spans", "kept", "sha256")]), marked


def _result(rows: DataFrame, kept: Column, sha256: Column) -> DataFrame:
    spans = F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))
    return rows.select("doc_id", "n_bytes", spans.alias("spans"), kept.alias("kept"), sha256.alias("kept_sha256"))


def _starts(rows: DataFrame, marked: DataFrame, keep_first: bool) -> DataFrame:
    """(doc, hash, start, count): stretches of starts of strings that go."""
    blocks = marked.select("doc", "hash", F.explode(F.arrays_zip("anchor", "content", "count", "place", "starts")).alias("b"))
    blocks = blocks.select("doc", "hash", "b.*")
    # Counts are stored before they are joined: then the planner can split a hot anchor's blocks in the join.
    several = stored(blocks.groupBy("anchor").agg(F.sum(F.size("starts")).alias("n")).filter("n > 1").select("anchor"))
    blocks = stored(blocks.join(several, "anchor"))
    kinds = blocks.groupBy("anchor", "content").agg(
        F.sum(F.size("starts")).alias("copies"),
        F.min(F.struct("doc", "hash", F.col("starts")[0].alias("start"), "count", "place")).alias("first"),
    )
    kinds = stored(kinds)
    contested = stored(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"))
    # Copies as a whole.
    copied = kinds.filter("copies > 1").select("anchor", "content", "first")
    copied = blocks.join(copied, ["anchor", "content"]).select("doc", "hash", F.explode("starts").alias("start"), "count", "first")
    if keep_first:
        is_first = (F.col("doc") == F.col("first.doc")) & (F.col("hash") == F.col("first.hash")) & (F.col("start") == F.col("first.start"))
        copied = copied.filter(~is_first)
    copied = copied.select("doc", "hash", F.col("start").cast("long"), F.col("count").cast("long"))
    # Blocks that share an anchor and differ, as bytes.
    open_kinds = kinds.join(contested, "anchor").select("anchor", "copies", "first.*", (F.col("kinds") > HOT_BLOCKS).alias("hot"))
    wanted = open_kinds.groupBy("doc", "hash").agg(
        F.collect_set(F.struct("start", "count", "place", "anchor", "hot", (F.col("copies") > 1).alias("copied"))).alias("blocks")
    )
    pieces = stored(_with_text(rows, wanted).mapInPandas(_sliced, _SLICED))
    matched = pieces.filter("not hot").repartition("anchor").sortWithinPartitions("anchor")
    matched = matched.mapInPandas(lambda batches: _matched(batches, keep_first), _STARTS)
    found, hot = copied.union(matched), pieces.filter("hot")
    return found if hot.isEmpty() else found.union(_counted(hot.dropDuplicates(["doc", "hash", "start"]), keep_first))


def _with_text(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of the documents in `wanted`, packed while it is dealt out."""
    packed = rows.select("doc", "hash", _packed(F.col("text")).alias("packed"))
    return packed.join(wanted, ["doc", "hash"])


def _packed(text: Column) -> Column:
    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        return texts.map(zstandard.ZstdCompressor(3).compress)

    return pack(text)


_MARKED = (
    "doc_id long, doc long, hash long, n_bytes long, sha256 string, anchor array<long>, content array<long>, count array<int>, "
    "place array<int>, starts array<array<int>>"
)
_SLICED = "anchor long, doc long, hash long, start long, count int, place int, copied boolean, hot boolean, data binary"
_STARTS = "doc long, hash long, start long, count long"
_CUT = "doc long, hash long, spans array<struct<start:long,end:long>>, kept binary, sha256 string"


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, doc, row_hash, text in zip(batch["doc_id"].astype("Int64"), batch["doc"], batch["hash"], batch["text"]):
            anchor, content, start, count, place = anchors(text)
            # Blocks that a document has more than once, as in periods, are written once with all their starts.
            order = np.lexsort((start, content, anchor))
            new = np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) | np.diff(content[order])]) != 0) if len(order) else order
            one = order[new]
            starts = np.split(start[order].astype(np.int32), new[1:]) if len(one) else []
            out.append((
                doc_id, doc, row_hash, len(text), hashlib.sha256(text).hexdigest(), anchor[one], content[one],
                count[one].astype(np.int32), place[one].astype(np.int32), starts,
            ))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _MARKED.split(", ")])


def _sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _SLICED.split(", ")]
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, row_hash, packed, wanted in zip(batch["doc"], batch["hash"], batch["packed"], batch["blocks"]):
            text = unpack.decompress(packed)
            for b in wanted:
                data = text[b["start"] : b["start"] + b["count"] + LENGTH - 1]
                out.append((b["anchor"], doc, row_hash, b["start"], b["count"], b["place"], b["copied"], b["hot"], data))
            if len(out) >= BATCH_BLOCKS:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, row_hash, packed, starts in zip(batch["doc"], batch["hash"], batch["packed"], batch["starts"]):
            text = unpack.decompress(packed)
            removed = union([(s["start"], s["start"] + s["count"] + LENGTH - 1) for s in starts])
            kept, at = [], 0
            for start, end in removed:
                kept.append(text[at:start])
                at = end
            rest = b"".join([*kept, text[at:]])
            out.append((doc, row_hash, [{"start": a, "end": b} for a, b in removed], rest, hashlib.sha256(rest).hexdigest()))
        yield pd.DataFrame(out, columns=["doc", "hash", "spans", "kept", "sha256"])


def union(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches; those that touch are one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


# ---------------------------------------------------------------- longest previous factors


def _matched(batches: Iterator[pd.DataFrame], keep_first: bool) -> Iterator[pd.DataFrame]:
    """Blocks come sorted by anchor. Those of one anchor are taken together, several anchors at a time."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        last = batch["anchor"].iloc[-1] if len(batch) else None
        held.append(batch)
        size += len(batch)
        if size >= BATCH_BLOCKS:
            all_rows = pd.concat(held, ignore_index=True)
            whole = all_rows["anchor"] != last
            if whole.any():
                yield from _matched_blocks(all_rows[whole], keep_first)
            held = [all_rows[~whole]]
            size = len(held[0])
    if size:
        yield from _matched_blocks(pd.concat(held, ignore_index=True), keep_first)


def _matched_blocks(rows: pd.DataFrame, keep_first: bool) -> Iterator[pd.DataFrame]:
    """In parts of whole anchors, about `BATCH_BLOCKS` blocks each."""
    anchor = rows["anchor"].to_numpy()
    edges = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    at = 0
    while at < len(rows):
        later = edges[edges >= at + BATCH_BLOCKS]
        end = int(later[0]) if len(later) else len(rows)
        yield _settled(rows.iloc[at:end], keep_first)
        at = end


def _settled(rows: pd.DataFrame, keep_first: bool) -> pd.DataFrame:
    rows = rows.drop_duplicates(["doc", "hash", "start"]).sort_values(["doc", "hash", "start"])  # repeated rows
    data, counts = rows["data"].tolist(), rows["count"].to_numpy()
    goes = Factors(data, counts).earlier()
    if not keep_first:
        goes |= Factors(data, counts, backwards=True).earlier()
        goes[np.repeat(rows["copied"].to_numpy(bool), counts)] = False  # all copies go as a whole already
    first = np.concatenate([[0], np.cumsum(counts)])
    edge = np.zeros(len(goes) + 1, bool)
    edge[first] = True
    begin = np.flatnonzero(goes & (edge[:-1] | ~np.concatenate([[False], goes[:-1]])))
    end = np.flatnonzero(goes & (edge[1:] | ~np.concatenate([goes[1:], [False]]))) + 1
    block = np.searchsorted(first, begin, "right") - 1
    out = rows[["doc", "hash"]].iloc[block].reset_index(drop=True)
    out["start"] = rows["start"].to_numpy()[block] + begin - first[block]
    out["count"] = end - begin
    return out


class Factors:
    """Previous factors of `LENGTH` bytes or more at the starts of some blocks, whose order is the order of the text.

    `counts` has the number of starts in each block; a block has `LENGTH` - 1 bytes more than starts. `backwards`: the order of
    the text is turned round, so that a factor is a later one.
    """

    def __init__(self, data: list[bytes], counts: np.ndarray, backwards: bool = False) -> None:
        self.bytes = np.frombuffer(b"".join(data), np.uint8)
        sizes = np.array([len(d) for d in data], np.int64)
        begin = np.cumsum(sizes) - sizes
        self.block = np.repeat(np.arange(len(data)), counts)
        first = np.cumsum(counts) - counts
        self.at = np.arange(len(self.block)) - first[self.block] + begin[self.block]  # in `bytes`
        self.last = (begin + counts - 1)[self.block]  # the block's last start
        self.order = np.arange(len(self.block)) * (-1 if backwards else 1)
        hashes = [Hashes(np.frombuffer(d, np.uint8)).of(s := np.arange(c), s + LENGTH) for d, c in zip(data, counts)]
        _, self.same = np.unique(np.concatenate(hashes), return_inverse=True) if hashes else (None, np.zeros(0, np.int64))

    def earlier(self) -> np.ndarray:
        """For each start whether its string is found at an earlier one."""
        n = len(self.block)
        first = np.full(self.same.max(initial=-1) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, self.same, self.order)
        todo, found = self.order > first[self.same], np.zeros(n, bool)
        while todo.any():
            before = np.concatenate([[False], todo[:-1] & (self.block[1:] == self.block[:-1])])
            heads = np.flatnonzero(todo & ~before)
            wanted = np.zeros(len(first), bool)
            wanted[self.same[heads]] = True
            company = np.flatnonzero(wanted[self.same])
            company = company[np.argsort(self.same[company], kind="stable")]
            length = np.zeros(n, np.int64)
            for part in self._parts(company):
                self._longest_previous(part, length)
            # A match that goes beyond `LENGTH` settles the starts after it as well.
            reach = np.where(length[heads] >= LENGTH, length[heads] - LENGTH + 1, 0)
            step = np.zeros(n + 1, np.int64)
            np.add.at(step, heads, 1)
            np.add.at(step, heads + np.maximum(reach, 1), -1)
            seen = np.cumsum(step[:-1]) > 0
            hit = np.zeros(n + 1, np.int64)
            np.add.at(hit, heads[reach > 0], 1)
            np.add.at(hit, (heads + reach)[reach > 0], -1)
            found |= np.cumsum(hit[:-1]) > 0
            todo &= ~seen
        return found

    def _parts(self, company: np.ndarray) -> Iterator[np.ndarray]:
        """Whole groups of starts with one hash, about `SUFFIX_ROWS` at a time."""
        at = 0
        while at < len(company):
            end = min(at + SUFFIX_ROWS, len(company))
            while end < len(company) and self.same[company[end]] == self.same[company[end - 1]]:
                end += 1
            yield company[at:end]
            at = end

    def _longest_previous(self, starts: np.ndarray, length: np.ndarray) -> None:
        """Put the suffixes at `starts` in order and write the length of each one's longest earlier factor to `length`."""
        windows = np.lib.stride_tricks.sliding_window_view(self.bytes, LENGTH)[self.at[starts]]
        in_order = np.argsort(np.ascontiguousarray(windows).view(f"S{LENGTH}").ravel(), kind="stable")
        windows, starts = windows[in_order], starts[in_order]
        joined = np.concatenate([[False], (windows[1:] == windows[:-1]).all(1), [False]])  # with the suffix before
        order = self.order[starts]
        previous = _nearest_smaller(order)
        following = len(order) - 1 - _nearest_smaller(order[::-1])[::-1]
        breaks = np.cumsum(~joined)  # equal where all between share the prefix
        for other, there in ((previous, previous >= 0), (following, following < len(order))):
            other = np.where(there, other, 0)
            match = there & (breaks[other] == breaks[: len(order)])
            mine, its = starts[match], starts[other[match]]
            np.maximum.at(length, mine, LENGTH + self._beyond(mine, its))

    def _beyond(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at starts `a` and `b` agree after `LENGTH` bytes, within both blocks."""
        room = np.minimum(self.last[a] - self.at[a], self.last[b] - self.at[b])
        agreed, going = np.zeros(len(a), np.int64), np.flatnonzero(room > 0)
        while len(going):
            at = agreed[going] + LENGTH
            same = self.bytes[self.at[a[going]] + at] == self.bytes[self.at[b[going]] + at]
            going = going[same]
            agreed[going] += 1
            going = going[agreed[going] < room[going]]
        return agreed


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or -1."""
    out = np.arange(len(values)) - 1
    while True:
        wrong = np.flatnonzero((out >= 0) & (values[out] > values))
        if not len(wrong):
            return out
        out[wrong] = out[out[wrong]]  # all between were larger


# ---------------------------------------------------------------- anchors with very many different blocks


_CLASSES = "anchor long, class int, core long, around long, doc long, hash long, start long, count int, data binary"


def _counted(blocks: DataFrame, keep_first: bool) -> DataFrame:
    """Starts that go of the blocks of hot anchors, by counts of content that is common to fewer and fewer starts."""
    classes = stored(blocks.mapInPandas(_classes, _CLASSES))
    shared = stored(classes.groupBy("anchor", "class", "core").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    classes = classes.join(shared, ["anchor", "class", "core"])
    kinds = classes.groupBy("anchor", "class", "core", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "hash", "start", "count", "data")).alias("first")
    )
    kinds = stored(kinds)
    copied = classes.drop("data").join(
        kinds.filter("n > 1").select("anchor", "class", "core", "around", "first.doc", "first.hash", "first.start").toDF(
            "anchor", "class", "core", "around", "of_doc", "of_hash", "of_start"
        ),
        ["anchor", "class", "core", "around"],
    )
    is_first = "doc = of_doc and hash = of_hash and start = of_start"
    if keep_first:
        copied = copied.filter(f"not ({is_first})")
    copied = copied.select("doc", "hash", "start", F.col("count").cast("long"))
    several = stored(kinds.groupBy("anchor", "class", "core").agg(F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds"))
    singles = kinds.join(several, ["anchor", "class", "core"]).select("first.*")
    singles = stored(singles.mapInPandas(_one_by_one, "one long, two long, doc long, hash long, start long"))
    found = singles.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(F.struct("doc", "hash", "start")).alias("first"))
    found = found.filter("n > 1").select("one", "two", "first.*").toDF("one", "two", "of_doc", "of_hash", "of_start")
    singles = singles.join(stored(found), ["one", "two"])
    if keep_first:
        singles = singles.filter(f"not ({is_first})")
    return copied.union(singles.select("doc", "hash", "start", F.lit(1).cast("long")))


def _classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A block's starts by distance from the anchor, `CLASS` at a time: hash of what their strings share, and of all they cover."""
    names = [c.split()[0] for c in _CLASSES.split(", ")]
    for batch in batches:
        out = []
        for b in batch.itertuples(index=False):
            hashes = Hashes(np.frombuffer(b.data, np.uint8), 1)
            distance = b.place - np.arange(b.count)
            kind = distance // CLASS
            first = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
            count = np.diff(np.append(first, b.count))
            # What every string of the class shares, whether or not this block has all of the class.
            nearest = b.place - kind[first] * CLASS
            core = hashes.of(nearest, nearest - CLASS + 1 + LENGTH).view(np.int64)
            shape = distance[first].astype(np.uint64) << np.uint64(20) | count.astype(np.uint64)
            around = (hashes.of(first, first + count + LENGTH - 1) ^ _mix(shape)).view(np.int64)
            for k, f, n, c, a in zip(*(x.tolist() for x in (kind[first], first, count, core, around))):
                out.append((b.anchor, k, c, a, b.doc, b.hash, b.start + f, n, b.data[f : f + n + LENGTH - 1]))
        yield pd.DataFrame(out, columns=names)


def _one_by_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for b in batch.itertuples(index=False):
            data, s = np.frombuffer(b.data, np.uint8), np.arange(b.count)
            one, two = (Hashes(data, w).of(s, s + LENGTH).view(np.int64) for w in (0, 1))
            out.append(pd.DataFrame({"one": one, "two": two, "doc": b.doc, "hash": b.hash, "start": b.start + s}))
        yield pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("one", "two", "doc", "hash", "start")})
