"""Cutting texts into pieces that a byte-level BPE treats independently, and caching their ids."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space after white space may belong to either side of a pre-token border.
_UNCLEAR = re.compile(r"\s ")
#: A space after anything else always starts a pre-token.
_BORDER = re.compile(r"(?<=\S)(?= )")
#: Stands for a cut in Arrow's strings.
_CUT = "\0"
#: ``_UNCLEAR`` and the mark of a cut, for Arrow's expressions, where ``\\s`` is of ASCII only.
_UNCLEAR_ARROW = r"[\s\pZ\x0b\x1c-\x1f\x{85}] |\x00"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Further places that no pre-token crosses: a letter before punctuation (an apostrophe may
#: start a contraction) or a line break, and a line break by itself before a letter.
_ENDS = rf"([{_LATIN}])([!-&(-/:-@\[-`{{-~\n])"
_LINES = rf"([!-~{_LATIN}\x00]\n)([{_LATIN}])"


def pieces(text: str) -> list[str]:
    """``text`` cut before each space that follows a non-space; the pieces join to the text.

    The split pattern of the byte-level vocabularies never matches across such a place, so
    encoding the pieces one by one gives the ids of the whole text.
    """
    if _UNCLEAR.search(text) or text[:1] == " ":
        return [p for p in _BORDER.split(text) if p]
    if not text:
        return []
    first, *rest = text.split(" ")
    return [first, *[" " + p for p in rest]] if first else [" " + p for p in rest]


class PieceCache(dict):
    """piece -> little-endian uint32 ids; emptied when ``limit`` pieces are held, so its memory is bounded."""

    def __init__(self, encode, limit: int = 400_000, longest: int = 200, special: Iterable[str] = ()):
        """``special``: tokens that stand for themselves wherever they are; they hold no space."""
        super().__init__()
        self.encode, self.limit, self.longest = encode, limit, longest
        self.unclear = "|".join([_UNCLEAR_ARROW, *map(re.escape, special)])

    def _learn(self, wanted: set[str]) -> list[str]:
        """Encode the ``wanted`` pieces that are not held, together; those longer than ``longest``."""
        new = [p for p in wanted if p not in self]
        for lo in range(0, len(new), 50_000):
            part = new[lo:lo + 50_000]
            self.update(zip(part, self.encode(part)))
        return [p for p in new if len(p) > self.longest]

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; pieces that are not held are encoded together.

        Arrow cuts the texts and numbers their distinct pieces, so that only those are looked
        up here; texts with spaces after white space or special tokens are cut by ``pieces``.
        """
        if len(self) > self.limit:
            self.clear()
        column = pa.array(texts, pa.large_string())
        unclear = pc.match_substring_regex(column, self.unclear)
        other = {i: pieces(texts[i]) for i in np.flatnonzero(unclear.to_numpy(zero_copy_only=False)).tolist()}
        marked = pc.replace_substring(column.filter(pc.invert(unclear)), " ", f"{_CUT} ")
        for border in (_ENDS, _LINES):
            marked = pc.replace_substring_regex(marked, border, rf"\1{_CUT}\2")
        split = pc.split_pattern(marked, _CUT)
        cut = split.flatten().dictionary_encode()
        distinct = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        long = self._learn(set(distinct).union(*other.values()))
        joined = pa.array(list(map(self.__getitem__, distinct)), pa.large_binary()).take(cut.indices)
        data, ends = joined.buffers()[2], np.frombuffer(joined.buffers()[1], np.int64)[split.offsets.to_numpy()].tolist()
        plain = (data[a:b].to_pybytes() for a, b in pairwise(ends))
        out = [b"".join(map(self.__getitem__, other[i])) if i in other else next(plain) for i in range(len(texts))]
        for p in long:  # they hardly repeat
            del self[p]
        return out
