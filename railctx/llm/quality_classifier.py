"""Compression classifier for text quality.

Two zstandard dictionaries are built from labelled text, one from good and one from bad. A text
is compressed with each, block by block, so that a long text does not become its own dictionary.
The difference of the two sizes over their sum, together with the size over the raw size, goes
through a logistic curve fitted on labelled texts that are in neither dictionary. Every byte of
every text is scored; only the fit uses a sample: of each class the ``class_rows`` labelled texts with the smallest hash
of their id, among those of at most ``most_chars`` characters.

Defined cases: null or empty text is scored by the curve at no difference and no compression;
rows without a label are scored only; a text with several labels counts with the smallest; with
labels of one class, or none, the score is the smoothed share of good labels; repeated rows get
equal scores; an empty table gives no rows. Ids, languages and sources are never looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.llm.arrow import keyed_text, map_rows, only

CLASS_ROWS = 1500
MOST_CHARS = 20_000
DICTIONARY_BYTES = 110 * 1024
BLOCK = 4096
LEVEL = 3


@dataclass(frozen=True)
class Classifier:
    """Both dictionaries and the curve; small enough to travel with a task."""

    good: bytes
    bad: bytes
    curve: tuple[float, float, float]

    def scorer(self):
        good, bad = compressor(self.good), compressor(self.bad)
        bias, by_difference, by_ratio = self.curve

        def score(text: str) -> float:
            if not (self.good and self.bad):
                return 1 / (1 + math.exp(-bias))
            difference, ratio = features(text, good, bad)
            odds = bias + by_difference * difference + by_ratio * ratio
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

        return score


def compressor(content: bytes) -> zstandard.ZstdCompressor | None:
    if not content:
        return None
    dictionary = zstandard.ZstdCompressionDict(content)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def features(text: str, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, float]:
    """Normalised size difference (higher: nearer to good text) and smaller size over raw size."""
    data = text.encode()
    if not data:
        return 0.0, 1.0
    with_good = with_bad = 0
    for start in range(0, len(data), BLOCK):
        block = data[start : start + BLOCK]
        with_good += len(good.compress(block))
        with_bad += len(bad.compress(block))
    return (with_bad - with_good) / (with_bad + with_good), min(with_good, with_bad) / len(data)


def dictionary(texts: list[str]) -> bytes:
    """Trained on blocks; of too little text for training, the text itself."""
    blocks = [data[s : s + BLOCK] for data in (t.encode() for t in texts) for s in range(0, len(data), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def logistic(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps; columns are scaled for the ridge."""
    scale = rows.std(0) + 1e-9
    x = np.column_stack([np.ones(len(rows)), rows / scale])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (labels - p)) - ridge * beta
        curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([beta[:1], beta[1:] / scale])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, class_rows: int = CLASS_ROWS, most_chars: int = MOST_CHARS) -> Classifier:
    """Learn from rows of ``labels`` (doc_id, quality) for which ``learn``, a condition on doc_id, holds."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(learn & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    counts = {row["quality"]: row["count"] for row in marked.groupBy("quality").count().collect()}
    total = {c: counts.get(c, 0) for c in (0, 1)}
    # Of each class the smallest by a hash of the id, among texts that can be used; ids first, so that no other text moves.
    short = keyed_text(docs).where((F.length("text") <= most_chars) & (F.length("text") > 0))
    spread = F.xxhash64("doc_id", F.lit("sample"))
    usable = marked.join(short.select("doc_id"), "doc_id", "left_semi").withColumn("spread", spread)
    picked = [usable.where(F.col("quality") == c).orderBy("spread", "doc_id").limit(class_rows) for c in (0, 1)]
    texts = short.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").distinct()
    # An id may stand for several texts.
    order = Window.partitionBy("quality").orderBy("spread", "doc_id", "text")
    rows = texts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= class_rows).collect()
    by_class: dict[int, list[str]] = {0: [], 1: []}
    for row in sorted(rows, key=lambda r: r["place"]):
        by_class[row["quality"]].append(row["text"])
    share = (total[1] + 1) / (total[0] + total[1] + 2)
    if min(len(by_class[0]), len(by_class[1])) < 2:
        return Classifier(b"", b"", (math.log(share / (1 - share)), 0.0, 0.0))
    # Every second text is for the dictionaries, the others are for the curve.
    good, bad = dictionary(by_class[1][::2]), dictionary(by_class[0][::2])
    sized, truth = [], []
    packers = compressor(good), compressor(bad)
    for label in (0, 1):
        for text in by_class[label][1::2]:
            sized.append(features(text, *packers))
            truth.append(label)
    truth = np.array(truth, float)
    # The sample holds as many bad as good texts; weights give each class its share of the labels.
    weights = np.where(truth == 1, share / max(1, truth.sum()), (1 - share) / max(1, (1 - truth).sum())) * len(truth)
    bias, by_difference, by_ratio = logistic(np.array(sized), truth, weights)
    return Classifier(good, bad, (float(bias), float(by_difference), float(by_ratio)))


def scores(docs: DataFrame, classifier: Classifier, **columns: str) -> DataFrame:
    """Quality score of every whole text: doc_id, score."""
    packed = docs.sparkSession.sparkContext.broadcast(classifier)

    def rows():
        only("quality_classifier")
        score = packed.value.scorer()
        return lambda row: [(row[0], score(row[1]))]

    return map_rows(keyed_text(docs, **columns), rows, "doc_id long, score double")


def keep(docs: DataFrame, classifier: Classifier, least: float, text: str = "text") -> DataFrame:
    """The rows whose text scores ``least`` or more, with all their columns, in one pass."""
    packed = docs.sparkSession.sparkContext.broadcast(classifier)
    at = docs.columns.index(text)

    def run(batches):
        only("quality_classifier")
        score = packed.value.scorer()
        for batch in batches:
            kept = [score(t or "") >= least for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
