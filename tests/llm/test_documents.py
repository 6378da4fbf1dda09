"""Token operators, packing and rules against brute force and the libraries."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from railctx.llm import arrow, jaccard_join, packing, pieces, quality_rules, token_counts
from railctx.llm.arrow import Memo

ODD = [
    "", " ", "\n", "  two  spaces  ", "tab\tand\nlines\n\n", "\nfirst line empty", "▁mark ▁▁ x▁", "日本語 テスト 🎉", "é́ combining",
    "<s> </s> <0x0A> <|endoftext|> <|im_end|>", "a\x85b c", "İSTANBUL ÅÅ", "x" * 5000, "word, " * 2000, "don't we'll 1,234.5 a.b.c java.util",
    "ab" * 40 + " " + "🎉" * 50, "\x00 nul", "a.\nB.\nC", "a .\n b", "..,,!! %%% ###$$$",
]
SCHEMA = "text string, doc_id long, words string, n long, row string"


def odd_rows():
    """Odd texts, nulls, repeated rows and columns whose names the operators use inside."""
    rows = [(text, i, "w", None, "r") for i, text in enumerate(ODD)]
    return [*rows, (None, 100, None, 1, None), ("no id", None, None, 1, None), rows[5], rows[5]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_pieces_equal_the_library(spark, docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = pieces.encode(docs, path)
    want = sorted((i is None, i or 0, library.encode(t or "", add_bos=True, add_eos=True)) for t, i, *_ in odd_rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in encoded.collect()) == want
    back = {r.doc_id: r.text for r in pieces.decode(encoded, path).collect()}
    for text, i, *_ in odd_rows():
        assert back[i] == library.decode(library.encode(text or "", add_bos=True, add_eos=True))
    assert pieces.encode(empty, path).count() == 0 and pieces.round_trip(empty, path).count() == 0


def test_pieces_of_random_texts():
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, rng = pieces.codec(path), random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice(["th", "er", "ing", " ", "  ", "\n", ".", ",", "▁", "é", "🎉", "0", "A", "%"]) for _ in range(rng.randint(0, 60)))
        got = np.frombuffer(own.encode(text), "<u4").tolist()
        assert got == own.library.encode(text, add_bos=True, add_eos=True), repr(text)


def test_list_and_heap_agree():
    own, rng = pieces.codec(public_tokenizers.path("piece_bpe_32k.model")), random.Random(4)
    for _ in range(200):
        symbols = [rng.choice("abcdeth▁ing") for _ in range(rng.randint(1, 90))]
        assert own._short(list(symbols)) == own._long(list(symbols))


def unigram(vocabulary, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return tokenizer


def test_token_counts_equal_the_library(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary, byte_fallback = token_counts.piece_scores(path)
    library = unigram([("<unk>", 0.0), *vocabulary, *((f"<0x{b:02X}>", 0.0) for b in range(256))], byte_fallback)
    got = {r.doc_id: (r.n_tokens, r.score) for r in token_counts.token_counts(docs, path).collect()}
    for text, i, *_ in odd_rows():
        # The library puts no mark before a text that begins with one and reads control pieces.
        if text and text[0] not in " ▁" and "<s>" not in text:
            assert got[i][0] == len(library.encode(text).ids), repr(text[:40])
    assert got[100] == (0, 0.0) == got[0]
    assert token_counts.token_counts(empty, path).count() == 0


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_ties_and_unknown_runs(byte_fallback):
    vocabulary = [(p, -1.0 * len(p)) for p in ("▁", "a", "b", "ab", "ba", "aba", "bab", "▁a", "▁ab")]
    library = unigram([("<unk>", 0.0), *vocabulary, *((f"<0x{b:02X}>", -99.0) for b in range(256))] if byte_fallback else [("<unk>", 0.0), *vocabulary], byte_fallback)
    counter = token_counts.Counter([*vocabulary, ("zz", -99.0)] if byte_fallback else vocabulary, byte_fallback)
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice("ab cé\n") for _ in range(rng.randint(1, 30)))
        if text[0] != " ":  # the library would put no mark before it
            got, want = counter.text(text)[0], len(library.encode(text).ids)
            assert got == want, repr(text)


def test_best_score_is_the_best():
    vocabulary = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -4.0, "bb": -6.0}
    counter = token_counts.Counter(vocabulary.items(), True)

    def best(text):
        if not text:
            return 0.0
        return max((s + best(text[len(p) :]) for p, s in vocabulary.items() if text.startswith(p)), default=-1e9)

    for text in ("a", "ab", "abba", "aabb ab", "b b b"):
        assert counter.text(text)[1] == pytest.approx(best("▁" + text.replace(" ", "▁")))


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    capacity = 64
    rows = packing.pack(docs, path, capacity).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_doc: dict = {}
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= capacity and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        by_doc.setdefault(r.doc_id, []).append(r)
    for text, i, *_ in odd_rows():
        found = sorted(by_doc[i], key=lambda r: r.start)
        ids = library.encode(text or "", add_special_tokens=False).ids + [packing.END]
        if i != 5:
            assert [x for r in found for x in r.ids] == ids, repr(text)
            assert [r.start for r in found] == list(np.cumsum([0] + [r.length for r in found])[:-1])
        assert {r.doc_tokens for r in found} == {len(ids)}
    # The repeated row is packed each time.
    assert sum(r.length for r in by_doc[5]) == 3 * by_doc[5][0].doc_tokens
    # Buckets follow each other.
    lengths = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths)
    assert packing.pack(empty, path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, path, 100)


def test_words_with_closing_punctuation_share_their_letters(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    words = packing.Words(library)
    ends = ["", ".", "***", ".$$$", '"', "&&&", ")", "%%%]", "_", "-", "<", "'", "'s", "\u0338", "é"]
    texts = [core + end for core in ("word", "Ndth", "Straße", "12", "don't", "") for end in ends if core + end]
    asked = []
    monkeypatch.setattr(words.whole, "compute", lambda some: asked.extend(some) or words.encoded(some))
    found = [np.frombuffer(ids, "<u4").tolist() for ids in words([text.encode() for text in texts])]
    assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]
    # Only the ends of words of letters go through the whole tokenizer.
    assert not {"word***", "Ndth.$$$", "Straße&&&", 'word"', "word)"} & set(asked) and {"***", ".$$$"} <= set(asked)


def test_a_batch_looks_up_each_word_once(monkeypatch):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words, asked = packing.Words(library), []

    class Counted:
        def of(self, some):
            asked.extend(some)
            return words(some)

    texts = ["the end of\tthe  end", "", " \n\x0b", "of the\r\nend", "don't word*** 12 \u00a0x\u0085y \x1c \u4e2d\u6587 the", "\x00 ends. Ends. \u0338", "Stra\u00dfe \u0130 e\u0301"] * 90
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    right = [(i, library.encode(text, add_special_tokens=False).ids) for i, text in enumerate(texts)]
    read = lambda part: [(i, np.frombuffer(ids, "<u4").tolist()) for i, ids in packing._coded(part, Counted())]
    assert read(batch) == right
    assert len(asked) == len(set(asked))
    assert read(batch.slice(100, 200)) == right[100:300] and read(batch.slice(0, 0)) == []
    assert read(batch.slice(1, 2)) == [(1, []), (2, [])]
    # Steps may end inside a text.
    monkeypatch.setattr(packing, "AT_ONCE", 3)
    monkeypatch.setattr(packing, "TOGETHER", 7)
    assert read(batch) == right


def test_small_batches_are_looked_up_together(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b", "c" * 50])], names=["doc_id", "text"])
    monkeypatch.setattr(packing, "TOGETHER_BYTES", 2 * batch.nbytes)
    assert [b.num_rows for b in packing._joined(iter([batch] * 5))] == [4, 4, 2]
    assert list(packing._joined(iter([]))) == []


def test_a_worker_keeps_the_memos_of_one_operator():
    """What packing remembers in a worker is gone when that worker hashes shingles, and the other way round."""
    path = public_tokenizers.path("word_bpe_49k.json")
    packing._begin()
    coder = packing.word_coder(path)
    coder.of([b"some", b"words"])
    packing._begin()  # the next task of the same operator
    assert packing.word_coder(path) is coder and len(coder) == 2
    jaccard_join._begin()
    assert not packing._coders
    jaccard_join.shingles("some words")
    jaccard_join._begin()
    assert len(jaccard_join._hashes) == 2
    packing._begin()
    assert not jaccard_join._hashes


def test_batches_are_bounded_by_bytes(spark):
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["bytes"]) for b in batches)
    long = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    arrow.ship(spark)
    assert long.mapInArrow(sizes, "bytes long").agg(F.max("bytes")).first()[0] <= arrow.BATCH_BYTES + 200_000


def test_memo_looks_up_known_words_once():
    class Counted(Memo):
        looked_up = 0

        def get(self, word):
            Counted.looked_up += 1
            return super().get(word)

    memo = Counted(lambda words: [w * 2 for w in words], limit=3)
    assert memo.of(["a", "b", "a", "c"]) == ["aa", "bb", "aa", "cc"] and Counted.looked_up == 4
    assert memo.of(["c", "d", "a"]) == ["cc", "dd", "aa"] and Counted.looked_up == 7  # emptied on the way
    assert memo.of(["c"]) == ["cc"] and memo.of([]) == [] and len(memo) <= 3


def test_piece_lengths():
    assert packing.piece_lengths(5000, 4096) == [4096, 512, 256, 128, 8]
    assert packing.piece_lengths(0) == [] and packing.piece_lengths(1) == [1]


# Quality rules


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows: dict = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures(spark, empty):
    rng = random.Random(1)
    texts = [*ODD, None, "a b c a b c a b c", "x\nx\n \n\nx", "a b c d a b c"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rows = [(t, i, "w", 1, "r") for i, t in enumerate(texts)]
    got = quality_rules.judge(spark.createDataFrame(rows, SCHEMA))
    for r in got.collect():
        want = brute_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(texts[r.doc_id])
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(empty).count() == 0


def brute_posterior(votes, weights):
    """Expectation-maximisation text by text, as the operator does by counted pattern."""
    texts = [p for p, n in weights for _ in range(n)]
    prior = quality_rules.PRIOR_TEXTS + quality_rules.PRIOR_SHARE * len(texts)
    good, table = quality_rules.PRIOR_GOOD, {c: [list(quality_rules.PRIOR_VOTES[c]) for _ in range(votes)] for c in (True, False)}

    def posterior(p):
        a, b = good, 1 - good
        for rule, v in enumerate(p):
            a, b = a * table[True][rule][1 - v], b * table[False][rule][1 - v]
        return a / (a + b)

    for _ in range(quality_rules.ROUNDS):
        share = [posterior(p) for p in texts]
        new = {}
        for c, first in ((True, quality_rules.PRIOR_GOOD), (False, 1 - quality_rules.PRIOR_GOOD)):
            new[c] = []
            for rule in range(votes):
                row = [prior * first * x for x in quality_rules.PRIOR_VOTES[c]]
                for p, s in zip(texts, share, strict=True):
                    row[1 - p[rule]] += s if c else 1 - s
                row = [x / sum(row) for x in row]
                place, low, high = (2, 0, quality_rules.MOST_FALSE_ALARMS) if c else (0, quality_rules.LEAST_PASSED, 1)
                bounded = min(max(row[place], low), high)
                new[c].append([bounded if k == place else x * (1 - bounded) / (1 - row[place]) for k, x in enumerate(row)])
        mass = prior * quality_rules.PRIOR_GOOD + sum(share)
        good, table = mass / (prior + len(texts)), new
    return {p: posterior(p) for p, _ in weights}


def test_estimate_by_pattern_equals_text_by_text():
    rng = random.Random(5)
    patterns = {tuple(rng.choice((1, 1, 1, 0, -1)) for _ in range(4)): rng.randint(1, 30) for _ in range(20)}
    weights = sorted(patterns.items())
    model = quality_rules.estimate(weights, 4)
    for p, want in brute_posterior(4, weights).items():
        assert 1 / (1 + np.exp(-model.log_odds(p))) == pytest.approx(want, abs=1e-9)


def test_rules_keep_clean_and_drop_junk(spark):
    rng = random.Random(2)
    lexicon = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    clean = [" ".join(rng.choice(lexicon) for _ in range(rng.randint(60, 300))) + "." for _ in range(300)]
    junk = [" ".join(rng.choice(lexicon) + "%%%" for _ in range(100)) for _ in range(20)]
    junk += [" ".join(rng.choice(lexicon).upper() + "!!" for _ in range(100)) for _ in range(20)]
    junk += ["\n".join(rng.choice(clean)[:60] for _ in range(2)) * 12 for _ in range(20)]
    rows = [(t, i, "w", 1, "r") for i, t in enumerate(clean + junk)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = quality_rules.keep(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(len(clean)))
    # A corpus without junk loses nothing.
    alone = frame.where(F.col("doc_id") < len(clean))
    assert quality_rules.keep(alone).count() == len(clean)
