"""Where a text may be cut so that no vocabulary piece spans the cut."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

from railctx.llm.arrow import Memo

MARK = "▁"

_SPACED = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_STEM_AND_SIGNS = re.compile(rf"({MARK}*[^\W\d_]+)([^\w{MARK}]+)")


class Cuts:
    """Values of a text's parts, each computed once per worker.

    Two characters that stand side by side in no piece never share a piece. So words end at the
    mark of a space and at a line break, and the signs behind a word are a part of their own.
    """

    def __init__(self, vocabulary: Iterable[str], compute: Callable[[list[str]], list[Any]], add: Callable[[list], Any]):
        self.joined = {piece[k : k + 2] for piece in vocabulary for k in range(len(piece) - 1)}
        self.whole = any("\n" in pair or pair[1] == MARK != pair[0] for pair in self.joined)
        self.add = add
        self.parts = Memo(compute, 700_000)
        self.memo = Memo(self._words, 300_000)

    def words(self, text: str) -> list[str]:
        if "  " in text or MARK in text or " \n" in text or text[0] in " \n" or text[-1] == " ":
            return _SPACED.findall(MARK + text.replace(" ", MARK))
        marked = (MARK + text.replace(" ", f" {MARK}")).replace("\n", " \n ")
        return [w for w in marked.split(" ") if w]

    def _words(self, words: list[str]) -> list[Any]:
        cut = [self._cut(w) for w in words]
        values = iter(self.parts.of([p for parts in cut for p in parts]))
        return [self.add([next(values) for _ in parts]) for parts in cut]

    def _cut(self, word: str) -> tuple[str, ...]:
        found = _STEM_AND_SIGNS.fullmatch(word)
        if found and found[1][-1] + found[2][0] not in self.joined:
            return found.groups()
        return (word,)

    def of(self, text: str) -> list[Any]:
        """Values of the words of a text that is not empty."""
        if self.whole:
            return self.parts.of([MARK + text.replace(" ", MARK)])
        return self.memo.of(self.words(text))
