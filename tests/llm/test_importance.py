"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import pytest

from railctx.llm import importance

DOCS = "score long, text string, doc_id long, rank int, n_words long, weight long, bucket int, range int"


def documents(spark, rows):
    return spark.createDataFrame([(7, text, i, 1, 2, 3, 4, 5) for i, text in rows], DOCS).repartition(3)


def brute_features(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10000 for run in runs]


def brute(rows, target):
    docs = [(i, *brute_features(text)) for i, text in rows]
    s, t = [0] * 10000, [0] * 10000
    for _, _, found in docs:
        for b in found:
            s[b] += 1
    for text in target:
        for b in brute_features(text)[1]:
            t[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    scored = []
    for i, words, found in docs:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((d for d in scored if d[1] >= 20), key=lambda d: (-d[4], d[0] is None, d[0]))
    wanted = 5 * len(may) // 100
    ranks = [(d[0], d[2], d[3], d[4], k) for k, d in enumerate(may[:wanted], 1)]
    rest = [(d[0], d[2], d[3], d[4], None) for d in may[wanted:]] + [(d[0], d[2], d[3], d[4], None) for d in scored if d[1] < 20]
    return ranks + rest


def same(spark, rows, target):
    aim = spark.createDataFrame([(1, text, "x") for text in target], "item_id long, text string, doc_id string")
    result = importance.resample(documents(spark, rows), aim)
    assert result.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r)[:5] for r in result.collect()), key=repr)
    assert got == sorted(brute(rows, target), key=repr)
    return got


def made(rng, n):
    vocabulary = ["Alpha", "beta9", "gamma", "δέλτα", "it's", "ÀÉ", "Zeta", "one-two", "naïve", "3.14"] + [f"w{i}" for i in range(60)]
    return rng.choice(["  ", " ", "\n", "\t, "]).join(rng.choice(vocabulary) for _ in range(n))


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, made(rng, rng.choice([0, 1, 2, 3, 19, 20, 21, 60, 200]))) for i in range(300)]
    rows += rows[5:25] + [(900, None), (901, ""), (902, " ;,\x00 "), (None, made(rng, 40)), (None, None)]
    rows += [(903, "x" * 300_000), (904, "y " * 150_000)]
    got = same(spark, rows, [made(rng, 50) for _ in range(10)] + [None, ""])
    assert sum(rank is not None for *_, rank in got) >= 5


def test_no_documents_or_no_target(spark):
    rng = random.Random(6)
    assert same(spark, [], ["alpha beta"]) == []
    same(spark, [(i, made(rng, 30)) for i in range(40)], [])


@pytest.mark.parametrize("held", [1, 2, 3, 50])
def test_parts_of_a_long_text(held, monkeypatch):
    monkeypatch.setattr(importance, "HELD_WORDS", held)
    rng = random.Random(held)
    for n in (0, 1, 2, 3, 4, 7, 120):
        text = made(rng, n)
        words, found = importance.feature_buckets(text.encode())
        assert (words, sorted(found.tolist())) == (brute_features(text)[0], sorted(brute_features(text)[1]))
