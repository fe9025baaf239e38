"""Texts as sequences of short stretches that recur, so that each different stretch of a batch is encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
SPACE = "▁"  # a piece model's sign for a space
#: Blanks of several bytes in UTF-8, and the sign for a space.
_WIDE = ["\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", SPACE]
_WIDE_FIRST = sorted({s.encode()[0] for s in _WIDE})


def cut(texts: pa.Array, signs: str = "", cuts: bool = True) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The stretches of all texts, one after the other, and where each text's stretches end; an empty text has none.

    Texts are cut before a space or line end that follows a sign which is no blank, after a line end between two such signs, and between a Latin
    letter and one of `signs`: where tokenizers that cut words always cut, whatever stands around. Unusual blanks, and several together,
    make longer stretches, nothing else. Without `cuts` each text is one stretch.
    """
    texts = pa.concat_arrays([texts.cast(pa.string())])  # without an offset into a larger array
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    size = int(bounds[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8, size) if size else np.zeros(0, np.uint8)
    cut_at = np.zeros(size + 1, bool)
    if cuts and size:
        line_end = data == 10
        plain = ~_blanks(data)
        after_plain = np.append(False, plain[:-1])
        cut_at[:-1] |= ((data == 32) | line_end) & after_plain
        # What follows the line end must not even begin like a blank of several bytes.
        begins = plain & ~np.isin(data, _WIDE_FIRST) if data.max() >= 128 else plain
        cut_at[1:-1] |= (line_end & after_plain)[:-1] & begins[1:]
        if signs:
            cut_at[1:-1] |= _letters(data)[:-1] & np.isin(data[1:], np.frombuffer(signs.encode("ascii"), np.uint8))
    cut_at[bounds] = True
    at = np.flatnonzero(cut_at) if size else np.zeros(1, np.int64)
    whole = texts.buffers()[2] if size else pa.py_buffer(b"")
    stretches = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), whole)
    return stretches.dictionary_encode(), np.searchsorted(at, bounds[1:])


def _blanks(data: np.ndarray) -> np.ndarray:
    """Blanks, those of several bytes marked at the last one."""
    found = _BLANK[data]
    if data.max(initial=0) >= 128:
        for sign in _WIDE:
            *before, last = sign.encode()
            at = np.flatnonzero(data == last)
            for k, byte in enumerate(reversed(before), 1):
                at = at[at >= k]
                at = at[data[at - k] == byte]
            found[at] = True
    return found


def _letters(data: np.ndarray) -> np.ndarray:
    """Letters of ASCII and of the two Latin blocks after it, marked at the last byte."""
    found = _LETTER[data]
    if data.max(initial=0) >= 128:
        at = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
        at = at[at + 1 < len(data)]
        odd = (data[at] == 0xC3) & ((data[at + 1] == 0x97) | (data[at + 1] == 0xB7))  # the signs of multiplication and division
        found[at[~odd] + 1] = True
    return found


def joined(ids: list[bytes], kind: np.dtype, codes: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, each with the end id last, and the place at which each text ends.

    `ids` are those of each stretch.
    """
    codes = np.insert(codes, ends, len(ids))
    last = ends + np.arange(len(ends))  # the place of each text's end id
    ids = [*ids, np.array([end_id], kind).tobytes()]
    pool = np.frombuffer(b"".join(ids), kind)
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // kind.itemsize
    counts = size[codes]
    upto = np.cumsum(counts)
    at = np.repeat((np.cumsum(size) - size)[codes] - (upto - counts), counts)
    at += np.arange(len(at))
    return pool[at], upto[last]


class Kept:
    """What was made of stretches, kept as long as they recur: those met last, up to about `most` bytes, twice as much at most.
    Long stretches are made each time."""

    LONG, ENTRY_BYTES = 1000, 220

    def __init__(self, make: Callable[[list[str]], list], most: int, size: Callable[[object], int] = len) -> None:
        self._make, self._most, self._size = make, most, size
        self._now: dict[str, object] = {}
        self._before: dict[str, object] = {}
        self._held = 0

    def of(self, stretches: list[str]) -> list:
        now, before, size = self._now, self._before, self._size
        found = list(map(now.get, stretches))
        missing = [k for k, made in enumerate(found) if made is None]
        for k in missing:
            found[k] = before.get(stretches[k])
        new = [k for k in missing if found[k] is None]
        for k, made in zip(new, self._make([stretches[k] for k in new]) if new else ()):
            found[k] = made
        for k in missing:
            text = stretches[k]
            if len(text) <= self.LONG:
                now[text] = found[k]
                self._held += self.ENTRY_BYTES + len(text) + size(found[k])
        if self._held > self._most:
            self._now, self._before, self._held = {}, now, 0
        return found
