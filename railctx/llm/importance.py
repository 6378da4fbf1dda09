"""Target-distribution importance resampling by overlapped regex scanning.

Separators collapse to single spaces; one overlapped scan with a boundary lookaround then gives, at
every word, the span of the run of up to three words that begins there, and the checksum of that run is
taken up to its first, second and third word. The checksums are counted in a fixed number of buckets, for
the corpus and for the target texts. A document's weight is the sum of its features' gains; noise from
a hash of its id makes the draw of the highest scores a draw without replacement by weight.

A text is scanned once: the buckets of its features are written beside its id, sorted and as differences, which
compress well, and both the counts and the weights are read from there. Counts are summed inside tasks
first, so what is shuffled is one row per bucket and task; the gains are one number per bucket.

The draw is ranked without gathering it: rows are dealt by ranges of the score, ranked inside a
range, and each range starts after the rows of those before it.

Defined cases: null and empty texts have no features, weight 0 and take no part in the draw; a null id counts as
empty text in the noise, and is last among ties; repeated rows are scored and drawn each; texts are never cut; with no target
text gains follow from the formula with a count of 0; an empty table gives no rows. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.llm.arrow import map_rows, shared_folder, written

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE_PERCENT = 5
SEED = 42
#: Words whose runs are held at a time, whatever the length of the text.
HELD_WORDS = 1 << 16

#: A-Z to a-z, separators to spaces. Digits, letters and all bytes beyond ASCII make up words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: A space, then one to three words up to a boundary. A match begins at every space.
_RUNS = regex.compile(rb" [^ ]++(?: [^ ]++){0,2}+(?![^ ])")


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of one to three words."""
    spaced = b" " + b" ".join(text.translate(_FOLD).split())
    runs = _RUNS.finditer(spaced, overlapped=True)
    words, parts = 0, []
    # Checksums of the last word, and of the last two, of the part before.
    last_one, last_two = [], []
    while spans := [run.span() for run in islice(runs, HELD_WORDS)]:
        starts = [a for a, _ in spans]
        # A word ends where the next match begins.
        end = spaced.find(b" ", starts[-1] + 1)
        held = [spaced[a:b] for a, b in zip(starts, [*starts[1:], len(spaced) if end < 0 else end], strict=True)]
        # A checksum goes on over a further word: none of the run is read twice.
        one = [crc32(word[1:]) for word in held]
        two = list(map(crc32, held[1 - len(last_one) :], [*last_one, *one]))
        three = list(map(crc32, held[2 - len(last_one) - len(last_two) :], [*last_two, *two]))
        parts.append(np.array(one + two + three, np.int64) % buckets)
        words += len(one)
        last_one, last_two = one[-1:], two[-1:]
    return words, np.concatenate(parts) if parts else np.zeros(0, np.int64)


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and the buckets of the features, sorted, as differences of two bytes each; written."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))

    def rows():
        def scan(row: tuple) -> Iterator[tuple]:
            words, found = feature_buckets(row[1])
            found.sort()
            yield row[0], words, len(found), np.diff(found, prepend=0).astype("<u2").tobytes()

        return scan

    scanned = map_rows(plain, rows, "doc_id long, n_words long, n_features long, buckets binary", chunk=256)
    path = shared_folder(docs.sparkSession)
    scanned.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(scanned.schema).parquet(path)


def _unpacked(held: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(held, "<u2").astype(np.int64))


def bucket_counts(found: DataFrame) -> DataFrame:
    """bucket, n over all rows of ``features``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for held in batch.column(0):
                total += np.bincount(_unpacked(held.as_py()), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> list[int]:
    """Gain of every bucket; ``BUCKETS`` numbers, whatever the size of the input."""
    spark = corpus.sparkSession
    counts = spark.range(BUCKETS).withColumnRenamed("id", "bucket")
    counts = counts.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0)
    counts = written(counts)
    sums = counts.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("S"), F.coalesce(F.sum("t"), F.lit(0)).alias("T")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * F.lit(float(sums["S"] + BUCKETS)) / ((s + 1) * F.lit(float(sums["T"] + BUCKETS)))
    found = counts.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")).orderBy("bucket")
    return [row["gain"] for row in found.collect()]


def weighed(found: DataFrame, gain: list[int]) -> DataFrame:
    """doc_id, n_words, n_features and the sum of the gains of its features."""
    table = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(table[_unpacked(held.as_py())].sum()) for held in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return found.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def drawn(scored: DataFrame, share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with the rank of those drawn. ``scored`` must be stable (written)."""
    may = scored.where(F.col("n_words") >= least_words)
    wanted = may.count() * share_percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    # The row number parts rows of one score and id, so no range has to hold more than its share.
    ranged = may.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)
    ranged = written(ranged.withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = ranged.withColumn("place", place).join(F.broadcast(starts), "range")  # one row per partition
    rank = F.col("first") + F.col("place")
    ranked = ranked.withColumn("rank", F.when(rank <= wanted, rank).cast("long")).drop("row", "range", "first", "place")
    return ranked.unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank and n_words of every document."""
    found = features(docs, doc_id, text)
    aim = features(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")))
    gain = gains(bucket_counts(found), bucket_counts(aim))
    scored = written(weighed(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"))))
    return drawn(scored).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
