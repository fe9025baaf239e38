"""SentencePiece encoding and decoding of whole texts, for models of the merge (BPE) type with byte fallback.

Encoding is exact and by backtracking. An Aho-Corasick automaton over the pieces gives the longest piece at each position.
A piece is taken if it is compatible with the one before it, that is if merging the text of both anew gives just these
two; else the next shorter piece that is its prefix is tried, and if there is none, the position is marked as failed in a
bitfield and the last piece is taken back. A sequence all of whose neighbours are compatible is the one that merging gives.

A text is cut where no piece can reach across: before white space, and at two characters that stand beside each other in no
piece. What is between two cuts is encoded once for each batch, and kept by the worker as long as it recurs, up to `KEPT_BYTES`.

The model's normaliser must change nothing but spaces, add a space in front of a text and keep all other spaces; this is
checked when a model is read. Null and empty texts have the end id alone. Rows that repeat are encoded alike, an empty table gives an
empty result, no column but the text is read. A very long text is held as a whole, with its ids, in one task. The model file must be
at the same path on every executor.
"""

from __future__ import annotations

import codecs
import re
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.llm.stretches import SPACE, Kept, cut, joined

KEPT, KEPT_BYTES = 150_000, 40 << 20
_LETTER = r"[^\W\d_]"
_RUN = re.compile(f"{SPACE}*{_LETTER}+|{SPACE}+|.", re.DOTALL)
_KIND = np.dtype(np.int32)
_PROBE = "  a  éﬁ Ａ\t\n b "


class Model:
    """`encode` and `decode` of one text; the same results as the library's with neither begin id nor sampling."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(_PROBE) != SPACE + _PROBE.replace(" ", SPACE):
            raise ValueError(f"{path}: the normaliser changes more than spaces")
        self.end_id = model.eos_id()
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
        self.byte_id = {int(self.pieces[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError(f"{path}: byte fallback is needed")
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        order = sorted(self.ids, key=lambda p: -self.score[p])
        self.rank = {p: r if len(p) > 1 else -1 for r, p in enumerate(order)}  # characters come from no merge
        self.tied = {p for a, b in zip(order, order[1:]) if self.score[a] == self.score[b] for p in (a, b) if len(p) > 1}
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError(f"{path}: some pieces have characters that are no piece")
        self.shown = [
            bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else
            " ⁇ ".encode() if model.is_unknown(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.control = frozenset(i for i in range(size) if model.is_control(i))
        self.beside = {pair for p in self.ids for pair in zip(p, p[1:])}
        # White space is cut off in front, where it begins, and line ends on both sides, if no piece has the like inside.
        inner = any(b == SPACE != a for a, b in self.beside) or any("\n" in pair for pair in self.beside)
        after_letter = {b for a, b in self.beside if a.isalpha()}
        self.signs = "".join(c for c in ".,;:!?" if c not in after_letter)
        self.cuts = not inner
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self._shorter: dict[str, str | None] = {}
        self._compatible: dict[tuple[str, str], bool] = {}
        self._last_merge: dict[str, tuple[str, str] | None] = {}
        self._kept = Kept(lambda stretches: [self._stretch(s) for s in stretches], KEPT_BYTES)

    def encode(self, text: str | None) -> list[int]:
        """All ids, the end id last."""
        return self.encoded(pa.array([text], pa.string()))[0].tolist()

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, each with the end id last, and where each one ends."""
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        places, ends = cut(texts, self.signs, self.cuts)
        codes = places.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return joined(self._kept.of(places.dictionary.to_pylist()), _KIND, codes, ends, self.end_id)

    def _stretch(self, text: str) -> bytes:
        """Ids of a text that no piece reaches into or out of; spaces are still spaces."""
        beside, parts = self.beside, _RUN.findall(text.replace(" ", SPACE))
        if len(parts) > 1:
            runs, parts = parts, []
            for run in runs:
                if parts and (parts[-1][-1], run[0]) in beside:
                    parts[-1] += run
                else:
                    parts.append(run)
        found, ids = array("i"), self.ids
        for part in parts:
            for piece in self._backtrack(part):
                if piece in ids:
                    found.append(ids[piece])
                else:
                    found.extend(self.byte_id[x] for x in piece.encode())
        return found.tobytes()

    def _backtrack(self, text: str) -> list[str]:
        """Pieces of a text; a character that is in no piece stands for itself."""
        open_at = bytearray(b"\1") * (len(text) + 1)  # 0: no encoding goes on from here
        made, compatible, size = self._last_merge, self._compatible, len(text)
        taken: list[str] = []
        at, piece = 0, self._longest(text, 0)
        while True:
            end = at + len(piece)
            if open_at[end] and (made.get(piece) or self._halves(piece)):
                if not taken or compatible.get((taken[-1], piece)) or self._fits(taken[-1], piece):
                    taken.append(piece)
                    if end == size:
                        return taken
                    at, piece = end, self._longest(text, end)
                    continue
            piece = self._prefix(piece)
            if piece is None:
                open_at[at] = 0
                piece = taken.pop()
                at -= len(piece)

    def _longest(self, text: str, at: int) -> str:
        """The longest piece that starts at a position."""
        if text[at] not in self.ids:
            return text[at]
        return next(self.automaton.iter_long(text, at))[1]

    def _prefix(self, piece: str) -> str | None:
        """The longest piece that is a proper prefix."""
        if piece not in self._shorter:
            self._shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), None)
        return self._shorter[piece]

    def _fits(self, left: str, right: str) -> bool:
        """Whether merging the characters of both gives just the two."""
        fits = self._compatible.get((left, right))
        if fits is None:
            if left in self.tied or right in self.tied:
                fits = self._merged(left + right, 1) == [left, right]
            else:
                fits = self._no_merge_across(left, right)
            if len(self._compatible) >= KEPT:
                self._compatible.clear()
            self._compatible[left, right] = fits
        return fits

    def _no_merge_across(self, left: str, right: str) -> bool:
        """Take the merges of both back, last one first: none of them may have come after a merge across the border.

        Of two merges of one score that on the left comes first.
        """
        rank, before = self.rank, np.inf
        while before == np.inf and (left + right) not in rank or rank.get(left + right, np.inf) >= before:
            if rank[left] > rank[right]:
                before, left = rank[left], self._halves(left)[1]
            elif rank[right] >= 0:
                before, right = rank[right] + 1, self._halves(right)[0]
            else:
                return True
        return False

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes the piece; of a character, the character; None if merging doesn't give the piece."""
        if piece not in self._last_merge:
            parts = self._merged(piece, 2)
            made = len(parts) == 2 and piece in self.score
            self._last_merge[piece] = tuple(parts) if made else (piece, piece) if len(piece) == 1 else None
        return self._last_merge[piece]

    def _merged(self, text: str, parts_left: int) -> list[str]:
        """Merge neighbours, best score first and leftmost of equal ones, until so many are left or no two make a piece."""
        parts, score = list(text), self.score
        while len(parts) > parts_left:
            best = max((score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] == -np.inf:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD, the space in front of the text goes."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        parts = [ids]
        if not self.control.isdisjoint(ids):  # bytes do not join across a control id
            cuts = [-1, *(k for k, i in enumerate(ids) if i in self.control), len(ids)]
            parts = [ids[a + 1 : b] for a, b in zip(cuts, cuts[1:])]
        text = "".join([b"".join(map(self.shown.__getitem__, p)).decode(errors="each byte") for p in parts])
        first = next((i for i in ids if self.shown[i]), None)
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text


codecs.register_error("each byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


@cache
def model(path: str) -> Model:
    return Model(path)


def round_trip(text: Column, path: str) -> Column:
    """A struct of the ids of a text, the end id last, and the text that these decode to. One pass, in one worker."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        of = model(path)
        ids, ends = of.encoded(texts)
        bounds = np.concatenate([[0], ends]).tolist()
        decoded = [of.decode(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
        return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], names=["ids", "decoded"])

    return both(text)


def encode(text: Column, path: str) -> Column:
    """The ids of a text as array<int>, the end id last."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        ids, ends = model(path).encoded(texts)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    @F.pandas_udf("string")
    def decoded(rows: pd.Series) -> pd.Series:
        of = model(path)
        return pd.Series([None if r is None else of.decode(r) for r in rows], dtype=object)

    return decoded(ids)
