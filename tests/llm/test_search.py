"""Neighbours, near-duplicate groups and the classifier against brute force and held-out labels."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from railctx.llm import components as graph
from railctx.llm import jaccard_join, neighbours, quality_classifier

VECTORS = "cell long, embedding array<float>, vec_id long, rank int, block string"


def vectors(spark, rows):
    return spark.createDataFrame([(7, v, i, 1, "b") for i, v in rows], VECTORS).repartition(3)


def brute(rows, dimension, k, every):
    plain = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == dimension and None not in v]
    plain = [(i, v) for i, v in plain if np.isfinite(v).all() and v.any()]
    out = {}
    for i, q in plain:
        if i % every == 0:
            near = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in plain if j != i)[:k]
            out[i] = [(j, pytest.approx(d, abs=1e-12)) for d, j in near]
    return out


def found(result):
    out: dict = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_neighbours_with_odd_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((5, 8))
    rows = [(i, (centres[i % 5] + 0.3 * rng.standard_normal(8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[10][1]) for i in range(30)]  # equal vectors: ties by id
    rows += [(2000, None), (2010, [0.0] * 8), (2020, [1.0, None] + [0.0] * 6), (2030, [float("nan")] * 8), (2040, [1.0]), (None, rows[0][1])]
    got = found(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0, confidence=0.9999))
    want = brute(rows, 8, 10, 10)
    assert set(got) == set(want)
    assert got == want


def test_small_blocks_and_many_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(900)]
    got, want = found(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0)), brute(rows, 16, 10, 50)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.95 * 10 * len(want)


def test_few_or_no_candidates(spark):
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    got = found(neighbours.nearest(vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])]), F.col("vec_id") % 10 == 0))
    assert got == {0: [(1, pytest.approx(2**0.5)), (1, pytest.approx(2**0.5))]}


def test_stopping_ratio():
    assert neighbours.chi_square_cdf(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert neighbours.stopping_ratio(6, 0.99) == pytest.approx(16.812, abs=1e-2)


# Components


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, rng.randint(1, 60)) for _ in range(40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(45)]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r.id: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


# Near duplicates

DOCS = "text string, point long, doc_id long, n long, rare string"


def documents(spark, rows):
    return spark.createDataFrame([(t, 1, i, 2, "r") for i, t in rows], DOCS).repartition(3)


def words_of(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]


def set_of(text):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_groups(rows):
    sets = [set_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    groups: dict = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(root(k), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)), key=str)


def near_copies(seed, groups, copies, passages=3):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    common = [[rng.choice(lexicon) for _ in range(50)] for _ in range(passages)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(lexicon) for _ in range(rng.randint(3, 150))]
        if rng.random() < 0.5:
            base += rng.choice(common)
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 4))):
                text[rng.randrange(len(text))] = rng.choice(lexicon)
            texts.append(" ".join(text) if rng.random() < 0.8 else "\n".join(text).upper())
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,groups,copies", [(1, 60, 3), (2, 6, 45)])
def test_groups(spark, seed, groups, copies):
    texts = [*near_copies(seed, groups, copies), None, "", " \n", "one", "ONE", "one two three four", "é É", "É É"]
    rows = [(100 + 3 * i, t) for i, t in enumerate(texts)]
    rows += [(5, rows[0][1]), (None, rows[1][1]), (None, "nobody else has this text here"), rows[2]]
    got = jaccard_join.groups(documents(spark, rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_groups(rows)


@pytest.mark.parametrize("seed,groups,copies", [(1, 60, 3), (2, 6, 45)])
def test_an_id_may_stand_for_several_texts(spark, seed, groups, copies):
    texts = near_copies(seed, groups, copies)
    rows = [(100 + i // 2, t) for i, t in enumerate(texts)] + [(101, texts[2])] * 4
    got = jaccard_join.groups(documents(spark, rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_groups(rows)


def test_one_text_for_each_point(spark):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (1, "a b c d e f"), (2, "g h i j k l")]
    docs = documents(spark, rows).select("doc_id", "text")
    sign = jaccard_join.signed(docs).select("doc_id", "mark", "point").distinct()
    found = jaccard_join._chosen(docs, sign.where("doc_id = 1")).collect()
    assert len({r.point for r in found}) == 2 and sorted(r.text for r in found) == ["a b c d e f", "g h i j k l"]


def test_chains_and_windows(spark):
    """Each text is linked with the next only, and all share shingles, so regions must replicate their border."""
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(80)]
    rows += [(1000 + i, " ".join(words[2 * i : 2 * i + 40])) for i in range(60)]
    got = jaccard_join.groups(documents(spark, rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_groups(rows)


def test_prefixes_bound_every_link():
    for n in range(1, 200):
        p = jaccard_join.prefix_length(n)
        assert n - p < 0.75 * n <= n - p + 1


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (2, "other words"), (None, "a b c d e f"), (9, None), (8, "")]
    kept = jaccard_join.keep_one(documents(spark, rows))
    assert kept.columns == ["text", "point", "doc_id", "n", "rare"]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("1", "A b c d e f"), ("2", "other words"), ("None", "a b c d e f"), ("9", None), ("8", "")], key=lambda x: (x[0], x[1])
    )
    assert jaccard_join.groups(documents(spark, [])).count() == 0


# Classifier


def labelled(seed=4, n=400):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(n):
        words, good = [rng.choice(lexicon) for _ in range(rng.randint(30, 300))], rng.random() < 0.75
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words) if i % 2 else " ".join(w + "%%%" for w in words)
        rows.append((text, 1, i, 1, "src"))
        labels.append((i, int(good), "fr"))
    return rows, labels


def test_classifier_on_held_out_labels(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, "x"), (7, None, "x")], "doc_id long, quality int, score string")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    classifier = quality_classifier.fit(docs, marks, learn)
    scores = {r.doc_id: r.score for r in quality_classifier.scores(docs, classifier).collect()}
    truth = dict((i, q) for i, q, _ in labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[i] >= 0.3) == (truth[i] == 1) for i in held]) > 0.95
    kept = quality_classifier.keep(docs, classifier, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.3}


def test_held_out_labels_are_not_learned(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, DOCS)
    learn = F.col("doc_id") % 5 != 0
    flipped = [(i, 1 - q if i % 5 == 0 else q, s) for i, q, s in labels]
    schema = "doc_id long, quality int, score string"
    one, two = (quality_classifier.fit(docs, spark.createDataFrame(x, schema), learn) for x in (labels, flipped))
    assert one == two


def test_classifier_edges(spark):
    rows, labels = labelled(n=60)
    schema = "doc_id long, quality int, score string"
    docs = spark.createDataFrame([*rows, (None, 1, 900, 1, "s"), ("", 1, 901, 1, "s"), ("x " * 60_000, 1, 902, 1, "s"), ("a", 1, None, 1, "s")], DOCS)
    for marks in ([], [x for x in labels if x[1] == 1], labels):
        classifier = quality_classifier.fit(docs, spark.createDataFrame(marks, schema), F.lit(True))
        scores = {r.doc_id: r.score for r in quality_classifier.scores(docs, classifier).collect()}
        assert len(scores) == 64 and all(0 <= s <= 1 for s in scores.values()) and scores[900] == scores[901]
    assert quality_classifier.scores(spark.createDataFrame([], DOCS), classifier).count() == 0


def test_sample_is_picked_by_a_hash_of_the_id(spark, monkeypatch):
    """Good texts say their id; those that are learned from come from the whole range, in no order of partitions."""
    rows = [(f"good{i} " * 8 if i % 4 else f"BAD{i}!! " * 8, 1, i, 1, "s") for i in range(2000)]
    marks = spark.createDataFrame([(i, int(i % 4 > 0), "x") for i in range(2000)], "doc_id long, quality int, score string")
    seen = []
    monkeypatch.setattr(quality_classifier, "dictionary", lambda texts: seen.append(texts) or b"".join(t.encode() for t in texts))
    fitted = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, DOCS).repartition(parts, "doc_id")
        fitted.append(quality_classifier.fit(docs, marks, F.lit(True), class_rows=100))
    assert fitted[0] == fitted[1] and [len(t) for t in seen] == [50] * 4
    for texts in seen[:2]:
        ids = sorted(int("".join(c for c in t.split()[0] if c.isdigit())) for t in texts)
        assert 700 < ids[len(ids) // 2] < 1300 and ids[-1] > 1800
