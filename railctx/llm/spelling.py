"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols, each of them used about as often. Of every word the full
one-edit neighbourhood of its reduced form is generated: itself and all deletions, replacements and
insertions over the few symbols, far fewer than over all letters. Joined with the reduced vocabulary it finds every word one edit away, as an edit
of the word is at most one edit of its reduced form; candidates are then verified on the original
strings. Each word generates its own neighbourhood without repeats, so a pair is met once from either side.

Reduced forms travel as 64-bit hashes computed from prefix sums, so a variant costs the same for short and
long words, and strings are looked up for candidates only. Equal hashes of different forms cost a
verification and change nothing.

Defined cases: null and empty texts have no words; a null id counts as empty text; repeated rows count
as often as they occur; ties go to the smaller word in code-point order; texts and words of any
length are whole; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.llm.arrow import written

#: Letters that make up a word, after A-Z are lower-cased; none beyond one byte.
LETTERS = "a-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT = 6, 5
#: One in so many runs of a document loses a letter.
THINNED = 199
#: A form occurs so many times as often as its variant.
OUTWEIGHS = 5
#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Words that a task counts before it hands them on, and variants that leave in one batch.
HELD_WORDS, HELD_VARIANTS = 200_000, 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def thinned(run: str, start: int) -> str:
    """The run, or without one letter where its checksum after that of ``<id>:`` says so."""
    h = zlib.crc32(run.encode(), start)
    if h % THINNED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n over all documents; counted inside tasks first."""
    plain = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    # A shorter run can only lose letters.
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}")

    def batch(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for part in batches:
            for k in range(part.num_rows):
                start = zlib.crc32(part.column(0)[k].as_py().encode() + b":")
                # bytes.lower() knows A-Z only.
                lowered = part.column(1)[k].as_py().encode().lower().decode()
                for word, n in Counter(runs.findall(lowered)).items():
                    word = thinned(word, start)
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield batch(held)
                    held = Counter()
        if held:
            yield batch(held)

    return plain.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_counts(words: DataFrame) -> list[tuple[str, int]]:
    """How many letters of the vocabulary are this letter; a row per letter of the alphabet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            held.update("".join(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["letter", "n"])

    rows = words.select("word").mapInArrow(run, "letter string, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    return [(row["letter"], row["n"]) for row in rows]


def dealt_letters(counts: list[tuple[str, int]], symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol of every letter, from 1 on. Frequent letters come first and go to the symbol that is used
    least, so that the symbols are used alike and few words share a reduced form."""
    table, used = np.zeros(256, np.uint64), [0] * symbols
    for letter, n in sorted(counts, key=lambda c: (-c[1], c[0])):
        symbol = used.index(min(used))
        used[symbol] += n
        table[ord(letter)] = symbol + 1
    return table


def reduced(word: str, table: np.ndarray) -> np.ndarray:
    return table[np.frombuffer(word.encode("latin-1"), np.uint8)]


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 2, np.uint64(_BASE))
    out[0] = 1
    return np.multiply.accumulate(out)


def form_key(forms: np.ndarray) -> int:
    """Sum of symbol times base to the power of its place, modulo 2^64."""
    return int((forms * _powers(len(forms))[: len(forms)]).sum(dtype=np.uint64))


def variant_keys(forms: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Keys of the reduced form and of every form one edit away, without repeats, as signed 64-bit integers."""
    n = len(forms)
    power = _powers(n)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(forms * power[:n], dtype=np.uint64)])
    whole = before[-1]
    every = np.arange(1, symbols + 1, dtype=np.uint64)[:, None]
    deleted = before[:-1] + (whole - before[1:]) * np.uint64(_UNBASE)
    replaced = whole + (every - forms) * power[:n]
    inserted = before + every * power[: n + 1] + (whole - before) * np.uint64(_BASE)
    return np.unique(np.concatenate([deleted, replaced.ravel(), inserted.ravel()])).view(np.int64)


def vocabulary(counts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Words that occur often enough, with an id and the key of their reduced form; and the symbols of the letters."""
    words = written(counts.where(F.col("n") >= LEAST_COUNT))
    table = dealt_letters(letter_counts(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([form_key(reduced(w, table)) for w in batch.column(0).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=["word", "n", "key"])

    keyed = words.mapInArrow(run, "word string, n long, key long")
    return written(keyed.withColumn("id", F.monotonically_increasing_id())), table


def variants(words: DataFrame, table: np.ndarray) -> DataFrame:
    """id and the keys of its neighbourhood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, size = [], [], 0
        for batch in batches:
            for of, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                near = variant_keys(reduced(word, table))
                ids.append(np.full(len(near), of))
                keys.append(near)
                size += len(near)
                if size >= HELD_VARIANTS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))], names=["id", "key"])
                    ids, keys, size = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))], names=["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id long, key long")


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def near_words(words: DataFrame, table: np.ndarray) -> DataFrame:
    """word, n, near, near_n for every word one edit away, from either side."""
    met = variants(words, table).join(words.select(F.col("id").alias("near_id"), "key"), "key").where("id <> near_id").select("id", "near_id")
    named = met.join(words.select("id", "word", "n"), "id").join(words.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n")), "near_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verified = [one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield batch.filter(pa.array(verified, pa.bool_()))

    return named.select("word", "n", "near", "near_n").mapInArrow(run, "word string, n long, near string, near_n long")


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n. A form is the most frequent near word, if frequent enough."""
    # Largest count first, then the smallest word.
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near")))
    per_word = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.rank") >= OUTWEIGHS * F.col("n")
    return words.select("word", "n").join(per_word, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.rank")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` with the last word that its forms lead to.

    A form is at least ``OUTWEIGHS`` times as frequent, so chains are short and never closed. Roots are
    handed down one level at a time: a word has no more variants than one-edit neighbours, so no
    join key collects a tree.
    """
    formed = written(formed)
    rest = formed.where("form is not null")
    level = formed.where("form is null").withColumn("root", F.col("word"))
    done = level
    parent = level.select(F.col("word").alias("form"), "root")
    while not rest.isEmpty():
        level = written(rest.join(parent, "form"))
        done = done.unionByName(level)
        rest = written(rest.join(level.select("word"), "word", "left_anti"))
        parent = level.select(F.col("word").alias("form"), "root")
    return done


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the corpus that is long and frequent enough."""
    words, table = vocabulary(word_counts(docs, doc_id, text))
    return with_roots(forms(words, near_words(words, table))).select("word", "form", "root", "n", "n_near", "form_n")
