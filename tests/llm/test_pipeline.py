"""The corpus pipeline: its stages against brute force, and its registration."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from railctx.llm import packing
from railctx.llm.queries import QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(seed=6):
    """Clean texts with copies and near copies, and junk of three kinds, with labels for most."""
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    rows, labels, clean = [], [], {}
    for i in range(300):
        words = [rng.choice(lexicon) for _ in range(rng.randint(80, 250))]
        kind = i % 10
        if kind < 7:
            if kind == 1 and clean:
                text = rng.choice(list(clean.values()))
            elif kind == 2 and clean:
                words = rng.choice(list(clean.values())).split(" ")
                words[len(words) // 2] = "changed"
                text = " ".join(words)
            else:
                text = " ".join(words)
            clean[i] = text
        else:
            text = " ".join({7: w.upper() + "!!", 8: w + "%%%", 9: words[0]}[kind] for w in words)
        rows.append((i, text, "en", "src", len(text)))
        labels.append((i, int(kind < 7), 0))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), rows[0]]
    return rows, labels, clean


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    rows, labels, clean = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), clean


def shingle_set(text):
    words = text.split(" ")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_stages(spark, folder):
    path, clean = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, path)
    assert good.columns == COLUMNS
    kept = {r.doc_id for r in good.collect()}
    assert set(clean) <= kept and len(kept - set(clean)) < 45
    passed = stages["quality rules"](spark, good, path)
    assert passed.columns == COLUMNS
    assert {r.doc_id for r in passed.collect()} == set(clean)
    single = stages["n-gram Jaccard join"](spark, passed, path)
    assert single.columns == COLUMNS
    # Brute force: of each group of linked texts the smallest id.
    sets = {i: shingle_set(t) for i, t in clean.items()}
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = sorted((group[i], group[j]), reverse=True)
                group = {k: new if g == old else g for k, g in group.items()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(group.values()))
    packed = corpus_pipeline.run(spark, path)
    lengths = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in lengths} == set(group.values()) and all(r.n == r["all"] for r in lengths)
    sequences = packed.select("sequence_id").collect()
    assert sorted(r.sequence_id for r in sequences) == list(range(len(sequences)))


def test_end_token_closes_each_document(spark, folder):
    path, _ = folder
    last = corpus_pipeline.run(spark, path).where("start + length = doc_tokens and length = 1").first()
    if last is not None:
        assert last.ids_crc32 == zlib.crc32(packing.END.to_bytes(4, "little"))


def test_sequences_hold_their_ids(spark, folder):
    path, clean = folder
    by_doc: dict = {}
    for r in corpus_pipeline.run(spark, path).collect():
        assert len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, rows in by_doc.items():
        ids = [x for r in sorted(rows, key=lambda r: r.start) for x in r.ids]
        assert ids == library.encode(clean[doc_id], add_special_tokens=False).ids + [packing.END]


def test_packing_digests_are_of_the_ids(spark, folder, monkeypatch):
    real, path = packing.pack, folder[0]
    names = [c for c in real(spark.read.parquet(f"{path}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json")).columns if c != "ids"]
    rows = QUERIES["op7_packing"](spark, path)
    assert rows.columns == names
    before = rows.orderBy("sequence_id").collect()
    doubled = F.transform("ids", lambda x: x * 2)
    monkeypatch.setattr(packing, "pack", lambda *args, **more: real(*args, **more).withColumn("ids", doubled))
    after = QUERIES["op7_packing"](spark, path).orderBy("sequence_id").collect()
    assert len(before) == len(after) and all(a.ids_crc32 != b.ids_crc32 for a, b in zip(before, after, strict=True))


def test_registered():
    names = set(driver.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


@pytest.mark.parametrize("name", ["op1_jaccard_join", "op2_chat_format", "op11_vector_file"])
def test_query_matches_sql(spark, name):
    from check_oracle import compare, connect

    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), name, folder) is None
