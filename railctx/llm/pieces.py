"""SentencePiece encoding and decoding for merge-type vocabularies.

The symbols of a text are its characters; an agenda ordered by score, then place, holds every
adjacent pair whose concatenation is a piece. The best pair is merged, its neighbours enter the
agenda, until none is left. Symbols outside the vocabulary become byte pieces.

Two facts of the vocabulary keep this cheap and exact. Two characters that stand side by side
in no piece are never merged, so a text may be cut between them; and equal parts have equal
pieces, so each part is merged once per worker. Every part that enters the memo is checked
against the sentencepiece library, one call for the new parts of a text; a difference stops
the job, because its ids could not be trusted.

Defined cases: null or empty text gives the begin and end ids only; repeated rows give repeated
rows; an empty table gives no rows. Texts are never cut short.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import struct

import numpy as np
from pyspark.sql import DataFrame

from railctx.llm.arrow import keyed_text, map_rows
from railctx.llm.vocabulary import MARK, Cuts

#: Parts up to this many characters keep their agenda in a list, which is faster than a heap there.
SHORT = 40
NEVER = math.inf

_codecs: dict[str, Codec] = {}


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model, ids = self.library, range(self.library.get_piece_size())
        special = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        self.ids = {model.id_to_piece(i): i for i in ids if i not in special}
        self.order = {p: -model.get_score(i) for p, i in self.ids.items() if not model.is_unused(i)}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.begin, self.end = (struct.pack("<I", i) for i in (model.bos_id(), model.eos_id()))
        if model.normalize("a  b") != f"{MARK}a{MARK}{MARK}b":
            raise ValueError("this vocabulary changes text before it merges")
        self.lead = self.merge(f"{MARK}\n")
        self.cuts = Cuts(self.order, self.checked, b"".join)

    def merge(self, text: str) -> bytes:
        """Ids of one part by the agenda."""
        symbols = self._short(list(text)) if len(text) <= SHORT else self._long(list(text))
        ids: list[int] = []
        for symbol in symbols:
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in symbol.encode())
            else:
                ids.append(self.unknown)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _short(self, symbols: list[str]) -> list[str]:
        """The agenda as a plain list, the score of each pair at its place; the first best is next."""
        order = self.order.get
        agenda = [order(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            left = agenda.index(best)
            piece = symbols[left] + symbols.pop(left + 1)
            symbols[left] = piece
            del agenda[left]
            if left < len(agenda):
                agenda[left] = order(piece + symbols[left + 1], NEVER)
            if left:
                agenda[left - 1] = order(symbols[left - 1] + piece, NEVER)
        return symbols

    def _long(self, symbols: list[str]) -> list[str]:
        """The agenda as a heap, so that very long parts stay near linear."""
        order, size = self.order, len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        agenda = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < size:
                piece = symbols[left] + symbols[right]
                if piece in order:
                    heapq.heappush(agenda, (order[piece], left, piece))

        for left in range(size - 1):
            propose(left, left + 1)
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left]
            # A symbol that was merged away is empty, so a pair that is out of date never fits.
            if right >= size or not symbols[left] or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [s for s in symbols if s]

    def checked(self, parts: list[str]) -> list[bytes]:
        """Ids of new parts, held against the library's. A part without a space goes behind a line break."""
        found = [self.merge(p) for p in parts]
        plain = [p[1:].replace(MARK, " ") if p[0] == MARK else "\n" + p for p in parts]
        for part, ours, theirs in zip(parts, found, self.library.encode(plain, num_threads=1), strict=True):
            # The library puts no mark before empty text, so a lone mark has nothing to compare.
            ours = ours if part[0] == MARK else self.lead + ours
            if part != MARK and ours != struct.pack(f"<{len(theirs)}I", *theirs):
                raise ValueError(f"the library encodes {part!r} differently")
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a whole text with begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return self.begin + self.end
        return self.begin + b"".join(self.cuts.of(text)) + self.end

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, model: str, **columns: str) -> DataFrame:
    """Per document its ids, begin and end included."""

    def rows():
        own = codec(model)
        return lambda row: [(row[0], np.frombuffer(own.encode(row[1]), "<i4").tolist())]

    return map_rows(keyed_text(docs, **columns), rows, "doc_id long, ids array<int>", 64)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Per row of ``doc_id, ids`` the text; null or empty ids give empty text."""

    def rows():
        own = codec(model)
        return lambda row: [(row[0], own.decode(row[1] or []))]

    return map_rows(encoded.select("doc_id", "ids"), rows, "doc_id long, text string", 64)


def round_trip(docs: DataFrame, model: str, **columns: str) -> DataFrame:
    """Encode and decode in one pass over the text; digests in place of the long columns."""

    def rows():
        own = codec(model)

        def digest(row):
            data = own.encode(row[1])
            back = own.decode(np.frombuffer(data, "<u4").tolist())
            return [(row[0], len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256(back.encode()).hexdigest())]

        return digest

    return map_rows(
        keyed_text(docs, **columns), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
