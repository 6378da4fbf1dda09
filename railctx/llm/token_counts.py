"""Token counts of a unigram vocabulary without building the tokens.

Aho-Corasick gives every vocabulary match of a word; dynamic programming over the places of the
word carries the best score and the number of pieces on that path. Ties follow the tokenizer:
of equal scores the match that starts first stays, and scores are added in double precision
from left to right. A character that no piece covers alone costs ten less than the worst piece
and counts as its UTF-8 bytes when the vocabulary has byte pieces, else as one piece per run.

White space is written as U+2581 and one is put in front of the text. Where no piece spans a
place, the best path passes through it, so a text is cut there; counts and scores of the parts
add up, and each part is computed once per worker.

Defined cases: null or empty text has 0 tokens and score 0; repeated rows give repeated rows;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import ahocorasick
from pyspark.sql import DataFrame

from railctx.llm.arrow import keyed_text, map_rows
from railctx.llm.vocabulary import Cuts

UNKNOWN_PENALTY = 10.0

_counters: dict[tuple, Counter] = {}


def piece_scores(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces that text can match, with their scores, and whether unknown characters become bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    bytes_too = any(model.is_byte(i) for i in ids)
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in plain], bytes_too


class Counter:
    def __init__(self, vocabulary: Iterable[tuple[str, float]], byte_fallback: bool):
        self.matches = ahocorasick.Automaton()
        single, worst = set(), 0.0
        vocabulary = list(vocabulary)
        for piece, score in vocabulary:
            self.matches.add_word(piece, (len(piece), score))
            worst = min(worst, score)
            if len(piece) == 1:
                single.add(piece)
        if not len(self.matches):
            raise ValueError("the vocabulary is empty")
        self.matches.make_automaton()
        self.single, self.unknown, self.byte_fallback = single, worst - UNKNOWN_PENALTY, byte_fallback
        # Runs of unknown characters count as one without byte pieces, so they must stay whole then.
        spanning = () if byte_fallback else ("\n\n",)
        self.cuts = Cuts(
            [*(p for p, _ in vocabulary), *spanning],
            lambda parts: [self.word(p) for p in parts],
            lambda found: (sum(n for n, _ in found), sum(s for _, s in found)),
        )

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path. Of equal paths, the one whose last piece is longest."""
        size = len(word)
        best, count = [0.0] + [-math.inf] * size, [0] * (size + 1)
        if self.single.issuperset(word):
            # Matches come by their end, the longest of an end first.
            for end, (length, score) in self.matches.iter(word):
                total = best[end + 1 - length] + score
                if total > best[end + 1]:
                    best[end + 1], count[end + 1] = total, count[end + 1 - length] + 1
            return count[size], best[size]
        found: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, match in self.matches.iter(word):
            found[end].append(match)
        after_unknown = [False] * (size + 1)
        for end, matches in enumerate(found):
            at = end + 1
            for length, score in matches:
                total = best[at - length] + score
                if total > best[at]:
                    best[at], count[at], after_unknown[at] = total, count[at - length] + 1, False
            if word[end] not in self.single and best[end] + self.unknown > best[at]:
                more = len(word[end].encode()) if self.byte_fallback else int(not after_unknown[end])
                best[at], count[at], after_unknown[at] = best[end] + self.unknown, count[end] + more, True
        return count[size], best[size]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        found = self.cuts.of(text)
        return sum(n for n, _ in found), sum((s for _, s in found), 0.0)


def token_counts(docs: DataFrame, model: str, **columns: str) -> DataFrame:
    """Per document the number of pieces and the score of the best segmentation."""

    def rows():
        if model not in _counters:
            _counters[model] = Counter(*piece_scores(model))
        counter = _counters[model]
        return lambda row: [(row[0], *counter.text(row[1]))]

    return map_rows(keyed_text(docs, **columns), rows, "doc_id long, n_tokens long, score double")
