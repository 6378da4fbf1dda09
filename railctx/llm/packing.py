"""Packing by power-of-two decomposition.

The token count of a document is written in binary; the document is cut into one piece per
set bit, longest first, and whole ``capacity`` pieces before them. Every piece is a sequence of its
own, of a length that is a power of two, so no sequence crosses documents and none is padded.

Pieces of equal length share a bucket; sequence ids run through one bucket after the other. No token id is
moved to number them: a task notes its number and counts its pieces of each length while it writes
them, a small sum over tasks and lengths tells where each of these counts starts, and reading adds
the two. Row order inside a task is that of its input partition, so a task that is run again writes the same.

Defined cases: null or empty text has the end token only; repeated rows are packed as often as
they occur; a null id is kept; an empty table gives no rows. Texts are never cut. Other columns are not
looked at.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from railctx.llm.arrow import Memo, keyed_text, only, written

CAPACITY = 4096
END = 2
#: Rows leave a task when they hold so many ids.
BATCH_IDS = 1 << 20
#: Bytes of text, and at most so many words of them, of which each distinct word is looked up once; words, or places, in one step.
TOGETHER_BYTES, TOGETHER, AT_ONCE = 4 << 20, 1 << 20, 1 << 14
#: Words without their closing punctuation, and other words, that a worker remembers.
MEMO_CORES, MEMO_PARTS = 340_000, 300_000
#: Punctuation after which a word may end; not the apostrophe, which some tokenizers leave with letters.
_CLOSING = "".join(sorted(set(string.punctuation) - {"'"}))
#: Stands for a character that is left to the tokenizer; no letter is spelled so.
_ODD = "\0"
#: Up to here no letter combines with another, and none looks at its neighbours to change case.
_LAST_LATIN = "\u024f"
#: Counts of the pieces by task and length are broadcast up to this size, of about so many bytes a row.
BROADCAST_BYTES, COUNT_BYTES = 32 << 20, 64

_coders: dict[str, Words] = {}


def word_coder(path: str) -> Words:
    """Token ids by word, as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and never joins across it, so the ids of a text are those
    of its words in order. Splitting at ASCII white space is safe for any finer rule inside.
    """
    if path not in _coders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _coders[path] = Words(Tokenizer.from_file(path))
    return _coders[path]


def _begin() -> None:
    only("packing", _coders.clear)


class Words:
    """Ids of words, all words of a call at a time.

    Most words are Latin letters with closing punctuation. What the tokenizer does to such a word before
    its merges is done here letter by letter, as the tokenizer itself spells each letter, and the merges are
    called alone; letters recur with other punctuation, so their ids are remembered without it. Any other word goes through
    the whole tokenizer, and so do all words where it does not cut letters from punctuation.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters: dict[int, str] = {ord("\n"): "\n"}
        self.cores = Memo(self.lettered, MEMO_CORES)
        self.whole = Memo(self.encoded, MEMO_PARTS)
        named = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.closing = "".join(c for c in _CLOSING if not any(c in name for name in named))
        self.simple = not any(name.isalpha() for name in named) and self._cuts_letters_off()

    def _cuts_letters_off(self) -> bool:
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None or not self.closing:
            return False
        one_by_one, run = "a".join(self.closing), "a" + self.closing
        cuts, run_cuts = ([part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] for probe in (one_by_one, run))
        return cuts == list(one_by_one) and run_cuts[0] == "a"

    def __len__(self) -> int:
        return len(self.cores)

    def __call__(self, words: list[bytes]) -> list[bytes]:
        # Words hold no white space, so all of them are handled as lines of one text.
        texts = b"\n".join(words).decode().split("\n")
        cores = [text.rstrip(self.closing) for text in texts]
        found = self.cores.of(cores)
        # A word that is no letters goes whole; of others, what is left is the punctuation, if any.
        rest = [text[len(core) :] if ids else text for text, core, ids in zip(texts, cores, found, strict=True)]
        return [ids + end if end else ids for ids, end in zip(found, self.whole.of(rest), strict=True)]

    of = __call__

    def lettered(self, cores: list[str]) -> Iterator[bytes]:
        """Ids of the cores that are letters, none for others."""
        joined = "\n".join(cores)
        self._learn(set(joined))
        spelled = joined.translate(self.letters).split("\n")
        return (self.merged(letters) if letters and _ODD not in letters else b"" for letters in spelled)

    def _learn(self, seen: set[str]) -> None:
        """How the tokenizer spells each letter; ``_ODD`` for what is no letter, or is cut in two."""
        for letter in seen:
            if ord(letter) in self.letters:
                continue
            self.letters[ord(letter)] = _ODD
            if self.simple and letter.isalpha() and letter <= _LAST_LATIN:
                pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(letter))
                if len(pieces) == 1:
                    self.letters[ord(letter)] = pieces[0][0]

    def merged(self, spelled: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()

    def encoded(self, texts: list[str]) -> list[bytes]:
        """One call, which tells the text of each id."""
        found = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        cuts = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(texts) + 1))
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def piece_lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full pieces, then the set bits of the rest from high to low."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``TOGETHER_BYTES``, or larger ones as they came."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= TOGETHER_BYTES:
            joined, held, size = pa.concat_batches(held), [], 0
            del batch
            yield joined
    if held:
        yield pa.concat_batches(held)


def _coded(part: pa.RecordBatch, coder: Words) -> Iterator[tuple[int | None, bytes]]:
    """Ids of each text of a batch. Each distinct word is looked up once; its ids go to all of its places at once."""
    split = pc.ascii_split_whitespace(part.column(1))
    words, bounds = split.flatten(), np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))
    data, at, total = [], np.zeros(len(bounds), np.int64), 0
    for first in range(0, len(words), TOGETHER):
        some = words.slice(first, TOGETHER).dictionary_encode()
        sizes, ids = [], []
        for k in range(0, len(some.dictionary), AT_ONCE):
            found = coder.of(_listed(some.dictionary.slice(k, AT_ONCE)))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)) // 4)
            ids.append(b"".join(found))
        sizes, ids = np.concatenate(sizes), np.frombuffer(b"".join(ids), "<u4")
        starts, places = np.cumsum(sizes) - sizes, some.indices.to_numpy()
        for k in range(0, len(places), AT_ONCE):
            place = places[k : k + AT_ONCE]
            size = sizes[place]
            ends = np.cumsum(size)
            # The k-th id of a place lies k behind the first one of its word in ``ids``.
            data.append(ids[np.repeat(starts[place] - (ends - size), size) + np.arange(ends[-1])])
            here = (bounds > first + k) & (bounds <= first + k + len(place))
            at[here] = total + ends[bounds[here] - first - k - 1]
            total += int(ends[-1])
    held = np.concatenate(data) if data else np.empty(0, "<u4")
    for doc_id, a, b in zip(part.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield doc_id, held[a:b].tobytes()


def _listed(words: pa.Array) -> list[bytes]:
    """Words, which hold no line break, as bytes."""
    one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    return pc.binary_join(one, "\n")[0].as_buffer().to_pybytes().split(b"\n")


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True, **columns: str) -> DataFrame:
    """One row per piece: place in its document, checksum, task, place among the task's pieces of its length and, unless turned off, its ids."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    last = np.array([end], "<u4").tobytes()

    schema = T._parse_datatype_string("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, place long" + ", ids array<int>" * with_ids)
    arrow = to_arrow_schema(schema)

    def batch(rows: list[tuple], held: list[bytes]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=False)]
        if with_ids:
            ends = np.cumsum([0] + [row[2] for row in rows]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(held), "<i4")), type=arrow.field("ids").type))
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        coder = word_coder(tokenizer)
        rows, held, room = [], [], BATCH_IDS
        task, taken = TaskContext.get().partitionId(), Counter()
        for doc_id, coded in (found for part in _joined(batches) for found in _coded(part, coder)):
            data = coded + last
            total, start = len(data) // 4, 0
            for length in piece_lengths(total, capacity):
                ids = data[4 * start : 4 * (start + length)]
                rows.append((doc_id, start, length, zlib.crc32(ids), total, task, taken[length]))
                taken[length] += 1
                held.append(ids if with_ids else b"")
                start += length
                room -= length
                if room <= 0 or len(rows) >= 2048:
                    yield batch(rows, held)
                    rows, held, room = [], [], BATCH_IDS
        if rows:
            yield batch(rows, held)

    return keyed_text(docs, **columns).mapInArrow(run, schema)


def digested(packed: DataFrame) -> DataFrame:
    """Packed rows with the checksum of the ids they hold in place of the ids."""
    names = [c for c in packed.columns if c not in ("ids", "ids_crc32")]
    schema = T.StructType([packed.schema[c] for c in names] + [T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, ids = batch.columns
            data, ends = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B"), ids.offsets.to_pylist()
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=[*names, "ids_crc32"])

    return packed.select(*names, "ids").mapInArrow(run, schema).select([c for c in packed.columns if c != "ids"])


def numbered(pieces: DataFrame) -> DataFrame:
    """Written ``pieces`` with sequence ids without gaps, bucket after bucket."""
    counts = written(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("rows")))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shorter = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)  # one row per length
    buckets = counts.groupBy("length").agg(F.sum("rows").alias("rows")).select("length", F.coalesce(F.sum("rows").over(shorter), F.lit(0)).alias("bucket"))
    starts = counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).join(F.broadcast(buckets), "length")
    starts = starts.select("length", "task", (F.col("bucket") + F.col("before")).alias("first"))
    if counts.count() * COUNT_BYTES <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    placed = pieces.join(starts, ["length", "task"])
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", *[c for c in pieces.columns if c == "ids"],
        (F.col("first") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True, **columns: str) -> DataFrame:
    """Pieces with the sequence that holds them. A sequence is one piece, at offset 0.

    Pieces are written once, with their ids; what is returned reads them from there.
    """
    return numbered(written(pieces(docs, tokenizer, capacity, end, with_ids, **columns)))
