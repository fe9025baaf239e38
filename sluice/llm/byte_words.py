"""Words of Latin letters for byte-level tokenizers: the pre-tokeniser leaves such a word whole, so that it can go to the
library's model at once, without the library's way for texts of any kind, which takes most of the time."""

from __future__ import annotations

import json
import re

from tokenizers import Tokenizer

#: A space or none, then letters of ASCII and of the Latin blocks after it.
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")


def signs_of_bytes() -> list[str]:
    """The sign that each byte has in a byte-level vocabulary: bytes that can be shown stand for themselves, the others follow
    from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def is_byte_level(tokenizer: Tokenizer) -> bool:
    """Whether texts are cut by the byte-level rule and nothing is changed or put in front."""
    description = json.loads(tokenizer.to_str())
    before, model = description["pre_tokenizer"] or {}, description["model"]
    return (
        not description["normalizer"] and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        and before.get("use_regex", True) and model.get("type") == "BPE" and not model.get("dropout")
    )


class WordModel:
    def __init__(self, tokenizer: Tokenizer) -> None:
        self._tokenize = tokenizer.model.tokenize
        self._signs = dict(enumerate(signs_of_bytes()))
        self._direct = is_byte_level(tokenizer)

    def ids(self, stretches: list[str]) -> list[list[int] | None]:
        """The ids of each stretch that is such a word, None for the others."""
        if not self._direct:
            return [None] * len(stretches)
        is_word, tokenize, signs = _WORD.fullmatch, self._tokenize, self._signs
        return [
            [t.id for t in tokenize(s.encode().decode("latin-1").translate(signs))] if is_word(s) else None for s in stretches
        ]
