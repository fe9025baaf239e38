"""Alignment of two tokenizers' tokens over the same bytes, and how often tokens of the one stand for tokens of the other.

A is a byte-level tokenizer that reads a space and the text, B a piece model that puts this space in front itself. Tokens are
intervals of bytes. All intervals of both are sorted by start, the running maximum of their ends is taken, and a group begins where a
start reaches it: so groups end where a token of A and one of B end together. Within a group, each token of A is expanded to the
tokens of B that it overlaps; of these pairs, those that end together are links. The count of a pair of ids is the number of its
links in all texts.

1. Texts are cut where both tokenizers always cut: before a space or line end that follows another sign, after a single line end, and between a letter
   and a stop or comma. Each different stretch of a batch of texts is encoded and aligned once; a worker keeps stretches that
   recur, up to `KEPT_BYTES`. Nothing else depends on the cuts: unusual blanks only make longer stretches.
2. Each batch writes its texts as numbers of stretches, and one row of its pairs with their counts. So a pair has one row in a batch however
   often it occurs, and no pair, however common, has more rows than there are batches.
3. Counts are summed by pair, the highest of each id of B is found among the pairs that have it (no more than A has ids), and
   both are joined back to the pairs of each batch. Texts meet the facts of their own batch only, in one group of its size.

Texts that are null or empty, or whose tokens' bytes are not those of the text with its space (texts with U+2581), have no token:
all numbers are zero and the groups are ''. Rows that repeat count each time; a null id stays null; other columns are not read; an
empty table gives an empty result. A very long text is a batch of its own: memory grows with it alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm.byte_words import WordModel, is_byte_level, signs_of_bytes
from sluice.llm.common import bounded_batches, stored
from sluice.llm.stretches import SPACE, Kept, cut

KEPT_BYTES, RECORD_BYTES = 60 << 20, 250

_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
_STAGED = (
    "batch long, doc_id long, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", groups_sha256 string, stretches array<int>, "
    "pairs array<long>, counts array<long>, sizes array<int>, at array<int>"
)
_RESULT = "doc_id long, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", n_best long, count_sum long, groups_sha256 string"


class Tokenizers:
    """Both tokenizers, and what is known of stretches met before."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        if not is_byte_level(self.a):
            raise ValueError(f"{a_path}: a byte-level tokenizer that cuts words and changes nothing is needed")
        self._words = WordModel(self.a)
        sign = {c: b for b, c in enumerate(signs_of_bytes())}
        self.a_bytes = {i: bytes(sign[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else
            p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        most = max(size, max(self.a_bytes) + 1)
        self.a_sizes, self.b_sizes, self.decimal = np.zeros(most, np.int64), np.zeros(most, np.int64), list(map(str, range(most)))
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes[:size] = [len(x) for x in self.b_bytes]
        self.b_space = self.b.piece_to_id(SPACE)
        self.b_before = self.b.encode("\n")  # what stands before a stretch that has no space of its own
        beside = {pair for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) for pair in zip(p, p[1:])}
        self.cuts = not any(y == SPACE != x or "\n" in (x, y) for x, y in beside)
        self.signs = "".join(c for c in ".," if not any(y == c and x.isalpha() for x, y in beside))
        self._kept = Kept(self._many, KEPT_BYTES, lambda record: RECORD_BYTES + len(record[5]) + len(record[6]))

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        ids = self._words.ids(texts)
        others = [t for t, x in zip(texts, ids) if x is None]
        made = iter(self.a.encode_batch_fast(others, add_special_tokens=False))
        return [next(made).ids if x is None else x for x in ids]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Of stretches, each with the space in front that it has in the text."""
        spaced = [t[:1] == " " for t in texts]
        ids = self.b.encode([t[1:] if s else "\n" + t for t, s in zip(texts, spaced)], num_threads=1)
        skip = len(self.b_before)
        return [x or [self.b_space] if s else x[skip:] for x, s in zip(ids, spaced)]

    def records(self, stretches: list[str]) -> list[tuple]:
        """n_a, n_b, n_groups, n_links, n_overlaps, groups, codes of the linked pairs, and whether both tokenizers give the bytes."""
        return self._kept.of(stretches)

    def _many(self, stretches: list[str]) -> list[tuple]:
        return [r for k in range(0, len(stretches), 20_000) for r in self._made(stretches[k : k + 20_000])]

    def _made(self, stretches: list[str]) -> list[tuple]:
        data = [s.encode() for s in stretches]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        a_ids, b_ids = self.encode_a(stretches), self.encode_b(stretches)
        fits = np.ones(len(data), bool)
        a, b = _Side(a_ids, self.a_bytes, self.a_sizes), _Side(b_ids, self.b_bytes, self.b_sizes)
        if not (a.gives(data, sizes) and b.gives(data, sizes)):
            for k, whole in enumerate(data):
                fits[k] = all(b"".join([of[i] for i in x[k]]) == whole for x, of in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)))
                if not fits[k]:
                    a_ids[k] = b_ids[k] = []
            a, b = _Side(a_ids, self.a_bytes, self.a_sizes), _Side(b_ids, self.b_bytes, self.b_sizes)
        group, links, n_overlaps = coalesced(a.end, b.end)
        written = self._written(a, b, group, fits)
        bounds = np.searchsorted(a.inside[links[0]], np.arange(len(data) + 1))
        codes, at = pair_code(a.ids[links[0]], b.ids[links[1]]).tobytes(), (8 * bounds).tolist()
        n_groups = np.bincount(a.inside[np.diff(group[: len(a.ids)], prepend=-1) != 0], minlength=len(data))
        overlaps = np.bincount(a.inside, n_overlaps, len(data)).astype(np.int64)
        numbers = [x.tolist() for x in (a.counts, b.counts, n_groups, np.diff(bounds), overlaps)]
        return list(zip(*numbers, written, [codes[x:y] for x, y in zip(at, at[1:])], fits.tolist()))

    def _written(self, a: _Side, b: _Side, group: np.ndarray, fits: np.ndarray) -> list[bytes]:
        """The groups of each stretch as `a1,a2|b1;a3|b2`."""
        order = np.argsort(group, kind="stable")  # within a group A's first
        inside, is_b, group = np.concatenate([a.inside, b.inside])[order], order >= len(a.ids), group[order]
        same = [np.append(x[1:] == x[:-1], False) for x in (inside, group, is_b)]
        mark = np.where(~same[0], 3, np.where(~same[1], 2, np.where(same[2], 0, 1)))
        parts: list[str] = [""] * (2 * len(order))
        parts[::2] = map(self.decimal.__getitem__, np.concatenate([a.ids, b.ids])[order].tolist())
        parts[1::2] = map(",|;\n".__getitem__, mark.tolist())
        lines = iter("".join(parts).encode().split(b"\n"))
        return [next(lines) if n else b"" for n in a.counts.tolist()]


class _Side:
    """One tokenizer's ids of some stretches, one after the other."""

    def __init__(self, ids: list[list[int]], data, sizes: np.ndarray) -> None:
        self.data, self.counts = data, np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.counts.sum()))
        self.inside = np.repeat(np.arange(len(ids)), self.counts)
        self.end = np.cumsum(sizes[self.ids])  # in the bytes of all stretches

    def gives(self, stretches: list[bytes], sizes: np.ndarray) -> bool:
        """Whether the bytes of the ids are those of the stretches."""
        last = np.append(0, self.end)[np.cumsum(self.counts)]
        return np.array_equal(last, np.cumsum(sizes)) and b"".join(map(self.data.__getitem__, self.ids.tolist())) == b"".join(stretches)


def coalesced(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """For intervals that follow each other on either side, given by their ends: the group of each interval (A's, then B's), the pairs
    that end together, and the number of B's intervals that each of A's overlaps."""
    a_start, b_start = np.concatenate([[0], a_end])[: len(a_end)], np.concatenate([[0], b_end])[: len(b_end)]
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.append(False, start[order][1:] >= reached[:-1])[: len(order)]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    # Each of A's intervals with those of B, from the first that ends after its start to the last that starts before its end.
    first, beyond = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    n = beyond - first
    one = np.repeat(np.arange(len(a_end)), n)
    other = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    together = a_end[one] == b_end[other]
    return group, (one[together], other[together]), n


def pair_code(a, b):
    return a << 32 | b


@cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def spaced(texts: pa.Array) -> pa.Array:
    """A space and the text; nothing for null and empty ones."""
    texts = pc.fill_null(texts, "")
    return pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))


# ---------------------------------------------------------------- documents


class Aligned:
    """Aligned documents. `staged` has a row for each document and one for each batch."""

    def __init__(self, staged: DataFrame) -> None:
        self.staged = staged
        self._pairs: DataFrame | None = None

    @property
    def pairs(self) -> DataFrame:
        """a, b, n: how many links have the pair; best: whether no other id of A has more with the same id of B."""
        if self._pairs is None:
            each = self.staged.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
            counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
            b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
            counts = counts.withColumn("b", b)
            best = F.col("n") == F.max("n").over(Window.partitionBy("b"))
            self._pairs = stored(counts.select("pair", F.shiftright("pair", 32).alias("a"), "b", "n", best.alias("best")))
        return self._pairs

    def documents(self) -> DataFrame:
        """One row per document: doc_id, numbers of tokens, groups, links and overlaps, n_best, count_sum, groups_sha256."""
        asked = self.staged.filter("pairs is not null").select(F.col("batch").alias("of"), F.posexplode("pairs").alias("at", "pair"))
        facts = asked.join(self.pairs.select("pair", "n", "best"), "pair").select("of", "at", "n", "best")
        return self.staged.groupBy("batch").cogroup(facts.groupBy("of")).applyInArrow(_summed, _RESULT)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id") -> Aligned:
    """Files of both tokenizers must be at the same paths on every executor."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return Aligned(stored(rows.mapInArrow(lambda batches: _staged(batches, a_path, b_path), _STAGED)))


def groups(text: Column, a_path: str, b_path: str) -> Column:
    """The groups of a text: ids of A, a bar, ids of B, groups set apart by semicolons; '' without tokens."""

    @F.arrow_udf("string")
    def written(texts: pa.Array) -> pa.Array:
        of = tokenizers(a_path, b_path)
        places, ends = cut(spaced(texts), of.signs, of.cuts)
        records, codes = of.records(places.dictionary.to_pylist()), places.indices.to_pylist()
        out, begin = [], 0
        for end in ends.tolist():
            mine = [records[c] for c in codes[begin:end]]
            out.append(b";".join([r[5] for r in mine]).decode() if all(r[7] for r in mine) else "")
            begin = end
        return pa.array(out, pa.string())

    return written(text)


def _staged(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    of, task = tokenizers(a_path, b_path), TaskContext.get().partitionId() << 32
    schema = _arrow(_STAGED)
    for number, batch in enumerate(batches):
        places, ends = cut(spaced(batch.column("text")), of.signs, of.cuts)
        records = of.records(places.dictionary.to_pylist())
        codes = places.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        begin, n = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)], len(records)
        fits = np.fromiter((r[7] for r in records), bool, n)
        misses = np.concatenate([[0], np.cumsum(~fits[codes])])
        whole = misses[ends] == misses[begin]
        inside = np.repeat(whole, ends - begin)
        codes = codes[inside]
        size = np.where(whole, ends - begin, 0)
        upto = np.concatenate([[0], np.cumsum(size)])
        numbers = []
        for k in range(5):
            sums = np.concatenate([[0], np.cumsum(np.fromiter((r[k] for r in records), np.int64, n)[codes])])
            numbers.append(sums[upto[1:]] - sums[upto[:-1]])
        written, listed = [r[5] for r in records], codes.tolist()
        bounds = zip(upto[:-1].tolist(), upto[1:].tolist())
        digests = [hashlib.sha256(b";".join([written[c] for c in listed[a:b]])).hexdigest() if b > a else "" for a, b in bounds]
        pairs = np.frombuffer(b"".join([r[6] for r in records]), np.int64)
        sizes = np.fromiter((len(r[6]) // 8 for r in records), np.int64, n)
        distinct, at = np.unique(pairs, return_inverse=True)
        counts = np.bincount(at, np.repeat(np.bincount(codes, minlength=n), sizes), len(distinct)).astype(np.int64)
        rows = len(ends)
        stretches = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(codes, pa.int32()))
        last = {"pairs": distinct, "counts": counts, "sizes": sizes, "at": at}
        columns: dict[str, pa.Array] = {
            "batch": pa.array(np.full(rows + 1, task + number)), "doc_id": _and(batch.column("doc_id"), None),
            "groups_sha256": _and(pa.array(digests, pa.string()), None), "stretches": _and(stretches, None),
        }
        columns |= {name: _and(pa.array(x, pa.int64()), None) for name, x in zip(_NUMBERS, numbers)}
        columns |= {name: pa.array([None] * rows + [x], schema.field(name).type) for name, x in last.items()}
        yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


def _and(rows: pa.Array, last: object) -> pa.Array:
    return pa.concat_arrays([rows, pa.array([last], rows.type)])


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


def _summed(rows: pa.Table, facts: pa.Table) -> pa.Table:
    """The documents of one batch with the counts of their links."""
    rows = rows.combine_chunks()
    is_batch = pc.is_valid(rows["pairs"])
    own, docs = rows.filter(is_batch), rows.filter(pc.invert(is_batch))
    n = np.zeros(max(1, len(own["pairs"][0])), np.int64)
    best = n.copy()
    place = facts["at"].to_numpy()
    n[place], best[place] = facts["n"].to_numpy(), facts["best"].to_numpy()
    at, sizes = (np.array(own[c][0].as_py(), np.int64) for c in ("at", "sizes"))
    stretches = docs["stretches"].combine_chunks()
    codes, upto = stretches.flatten().to_numpy(), stretches.offsets.to_numpy().astype(np.int64)
    upto -= upto[0]
    found = {}
    for name, of_pair in (("n_best", best), ("count_sum", n)):
        by_stretch = _sums(of_pair[at], np.concatenate([[0], np.cumsum(sizes)]))
        found[name] = pa.array(_sums(by_stretch[codes], upto))
    schema = _arrow(_RESULT)
    return pa.table([found.get(f.name, docs[f.name] if f.name in docs.column_names else None) for f in schema], schema=schema)


def _sums(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[upto[1:]] - sums[upto[:-1]]
