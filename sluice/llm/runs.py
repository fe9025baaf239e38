"""Periodic runs of words, by maximal pairs in the tree of LCP intervals.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), at least `least` words and
`exponent` periods long, that no neighbouring word extends. Two places i < j form a maximal pair of length d if the same d words
begin at both and neither the words before nor those after are the same. A stretch of period q and length d + q that can't be
extended is a maximal pair of length d and distance q, and the other way round; so the maximal pairs with d + q >= `least` and
d >= (`exponent` - 1) * q are the runs, and nothing has to be extended. Multiples of a period give the same stretch: the smallest stays.

1. Suffixes of all texts of a batch are put in order by doubling: ranks by 1, 2, 4 words and so on, each time only of places whose
   rank is not yet their own. Places whose next words occur once in their text are done early. The ranks also give the
   length of the common prefix (LCP) of neighbours in the order.
2. The tree of LCP intervals is walked bottom-up. An interval has lists of its places by the class of the word on the left,
   in order of the text. Where two children meet, each place of the smaller one is looked up among those of the other. Places
   with a common prefix of d words that are at most d / 2 apart stand evenly, one period from the next; all but the first of them
   have the same word on the left, and all but the last the same word on the right, so that they are in one child. So of
   those within reach only the outermost one on either side can be of another class, and one look settles each side. Each place is
   looked up at most log n times.
3. A word is dropped if a run contains it after the run's first period.

Words are `[^\\x20\\x09-\\x0D]+`; whole texts, null as empty. A text without words has no run and an empty collapsed text. Rows that
repeat have the same result; an empty table gives an empty result; other columns are not read. A very long text is taken as a whole
in one task: 4 bytes a word and doubling, of which there are log2 of its longest repeat.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.llm.common import words_of

LEAST, EXPONENT = 24, 3
RESULT = "struct<runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def found(text: Column, least: int = LEAST, exponent: int = EXPONENT) -> Column:
    """A struct of the runs of a text, by start, then period, and of the text without the words that runs repeat."""
    if exponent < 3:
        raise ValueError(f"the exponent must be 3 or more, got {exponent}")

    @F.arrow_udf(RESULT)
    def runs(texts: pa.Array) -> pa.Array:
        return _batch(texts, least, exponent)

    return runs(text)


def _batch(texts: pa.Array, least: int, exponent: int) -> pa.Array:
    words, ends = words_of(texts)
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    start, length, period = runs(codes, ends, least, exponent)
    text = np.searchsorted(ends, start, "right")
    # A word goes if a run covers it after its first period.
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    stays = np.cumsum(cover[:-1]) == 0
    upto = np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], ends]).astype(np.int64)]
    kept = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.dictionary.take(pa.array(codes[stays])))
    found = [start - begin[text], length, period]
    rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], fields=list(_RUN))
    bounds = np.searchsorted(text, np.arange(len(ends) + 1))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows)
    return pa.StructArray.from_arrays([lists, pc.binary_join(kept, " ")], names=["runs", "collapsed"])


def runs(codes: np.ndarray, ends: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, ...]:
    """Start, length and period of the runs of texts that lie one after the other, each up to one of `ends`; in order."""
    shortest = -(-least * (exponent - 1) // exponent)  # no pair of a run is shorter
    places, lcp = in_order(codes, ends, shortest)
    smallest: dict[tuple[int, int], int] = {}
    if len(places):
        left = np.concatenate([[-1], codes[:-1]])
        left[np.concatenate([[0], ends[:-1]])[ends > np.concatenate([[0], ends[:-1]])]] = -1
        for i, d, q in _maximal_pairs(places.tolist(), lcp.tolist(), left.tolist(), least, exponent - 1):
            if q < smallest.get((i, d + q), q + 1):
                smallest[i, d + q] = q
    rows = np.array(sorted((i, q, n) for (i, n), q in smallest.items()), np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 2], rows[:, 1]


def in_order(codes: np.ndarray, ends: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The places where `shortest` words begin that begin elsewhere in the text too, roughly (no fewer), in suffix order, and
    the number of words that each one has in common with the next (0: less than `shortest`)."""
    n = len(codes)
    sizes = np.diff(ends, prepend=0)
    end = np.repeat(ends, sizes)
    key = np.repeat(np.arange(len(ends)), sizes) * (int(codes.max(initial=0)) + 1) + codes
    _, kind, counts = np.unique(key, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[kind].astype(np.int32)  # the first place of its group in the order
    active, group = np.flatnonzero(counts[kind] > 1), np.zeros(0, np.int64)
    levels, h = [rank.copy()], 1
    while len(active):
        if 2 * h > shortest >= h:
            active = group = active[end[active] - active >= shortest]
            if not len(group):
                break
        ahead = active + h
        second = np.where(ahead < end[active], rank[np.minimum(ahead, n - 1)], -1)
        order = np.lexsort((second, rank[active]))
        active, second = active[order], second[order]
        first = rank[active]
        new_group = np.concatenate([[True], first[1:] != first[:-1]])
        new_part = new_group.copy()
        new_part[1:] |= second[1:] != second[:-1]
        at = np.arange(len(active))
        head = np.maximum.accumulate(np.where(new_group, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        rank[active] = first + part - head
        alone = new_part & np.append(new_part[1:], True)
        active, h = active[~alone], 2 * h
        levels.append(rank.copy())
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = group[np.argsort(rank[group], kind="stable")]
    a, b = places[:-1], places[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels))):
        x, y = a + lcp, b + lcp
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        lcp[same] += 1 << k
    return places, np.append(np.where(lcp >= shortest, lcp, 0), 0)


def _maximal_pairs(
    places: list[int], lcp: list[int], left: list[int], least: int, periods: int
) -> Iterator[tuple[int, int, int]]:
    """Place, length d and distance q of maximal pairs with d >= periods * q and d + q >= least."""
    stack: list[tuple[int, list[int]]] = []  # open intervals: number of words in common, places so far in order of the text

    def met(one: list[int], other: list[int], d: int) -> Iterator[tuple[int, int, int]]:
        """Pairs between two children, whose places are then put together in the larger list."""
        few, many = (one, other) if len(one) < len(other) else (other, one)
        reach, nearest = d // periods, least - d
        for x in few:
            word = left[x]
            k = bisect_left(many, x - reach)
            if k < len(many) and (y := many[k]) < x and left[y] != word and x - y >= nearest:
                yield y, d, x - y
            k = bisect_right(many, x)
            if k < len(many) and (y := many[k]) - x <= reach and left[y] != word and y - x >= nearest:
                yield x, d, y - x

    def joined(one: list[int], other: list[int]) -> list[int]:
        few, many = (one, other) if len(one) < len(other) else (other, one)
        for x in few:
            insort(many, x)
        return many

    for place, common in zip(places, lcp):
        now = [place]
        while stack and stack[-1][0] > common:
            d, so_far = stack.pop()
            yield from met(so_far, now, d)
            now = joined(so_far, now)
        if common:
            if stack and stack[-1][0] == common:
                d, so_far = stack.pop()
                yield from met(so_far, now, d)
                now = joined(so_far, now)
            stack.append((common, now))
