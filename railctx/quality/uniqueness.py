"""Uniqueness of keys without moving the keys.

Every task turns its keys into sorted 64-bit hashes without repeats, cut by ranges of the hash, and packs each range
as the differences of its hashes: a sparse bitmap of the hash space, of six or seven bytes a
key. Only these are shuffled. A range that meets in one task shows which hashes came from several tasks or repeated
inside one; all other keys are proven to occur once. Only keys of such suspect hashes are
counted exactly, so two keys that share a hash change nothing. A key that a third of the rows hold
is one hash per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.session import materialize

#: Hashes that a task sorts at a time.
HELD_HASHES = 1 << 20
#: Hash ranges for each shuffle partition of the session; a range meets in one task.
RANGES_PER_PARTITION = 8


def pack(hashes: np.ndarray) -> bytes:
    """Sorted distinct hashes as the first one and differences of as many bytes as the largest needs."""
    if not len(hashes):
        return b""
    steps = np.diff(hashes)
    width = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    return hashes[:1].astype("<u8").tobytes() + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(held: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    first = np.frombuffer(held[:8], "<u8")
    steps = np.zeros((n - 1, 8), np.uint8)
    if n > 1:
        steps[:, : (len(held) - 8) // (n - 1)] = np.frombuffer(held[8:], np.uint8).reshape(n - 1, -1)
    return np.cumsum(np.concatenate([first, steps.reshape(-1).view("<u8")]), dtype=np.uint64)


def _hashed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.withColumn("_hash", F.xxhash64(*key))


def sketch(df: DataFrame, key: Sequence[str], ranges: int) -> DataFrame:
    """``range``, ``keys`` (packed, ``n`` of them), ``again`` (packed, ``n_again``) and the ``rows`` they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += batch.num_rows
            if size >= HELD_HASHES:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        found, copies = np.unique(np.concatenate(held), return_counts=True)
        # Ranges are equal parts of the hash space, so sorted hashes fall into them in order.
        part = (found >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
        rows = []
        for r in np.unique(part).tolist():
            some, many = found[cuts[r] : cuts[r + 1]], copies[cuts[r] : cuts[r + 1]]
            again = some[many > 1]
            rows.append((r, pack(some), len(some), pack(again), len(again), int(many.sum())))
        columns = zip(*rows, strict=True)
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["range", "keys", "n", "again", "n_again", "rows"],
        )

    schema = "range int, keys binary, n long, again binary, n_again long, rows long"
    return _hashed(df, key).select("_hash").mapInArrow(run, schema)


def suspects(sketched: DataFrame) -> DataFrame:
    """One row per range: ``rows``, distinct hashes, and the hashes that were met more than once."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        found, copies = np.unique(np.concatenate([unpack(r["keys"], r["n"]) for r in rows]), return_counts=True)
        again = [unpack(r["again"], r["n_again"]) for r in rows]
        many = np.unique(np.concatenate([found[copies > 1], *again])).view(np.int64)
        return pa.table(
            {
                "rows": pa.array([sum(r["rows"] for r in rows)], pa.int64()),
                "hashes": pa.array([len(found)], pa.int64()),
                "many": pa.array([many.tolist()], pa.list_(pa.int64())),
            }
        )

    return sketched.groupBy("range").applyInArrow(run, "rows long, hashes long, many array<long>")


def uniqueness(df: DataFrame, key: Sequence[str]) -> dict[str, int]:
    """Rows, distinct keys, keys held by more than one row, and the rows that are too many.

    Reads ``df`` once, and a second time only if there are suspects, for their keys alone.
    """
    ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_range = materialize(suspects(sketch(df, key, ranges)))
    total = per_range.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("hashes"), F.lit(0)).alias("hashes"),
        F.coalesce(F.sum(F.size("many")), F.lit(0)).alias("many"),
    ).first()
    distinct, duplicate = total["hashes"], 0
    if total["many"]:
        named = per_range.select(F.explode("many").alias("_hash"))
        exact = (
            _hashed(df, key)
            .join(named, "_hash", "left_semi")
            .groupBy(*key)
            .agg(F.count(F.lit(1)).alias("_copies"))
            .agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_copies") > 1).alias("duplicate"))
            .first()
        )
        distinct, duplicate = distinct - total["many"] + exact["keys"], exact["duplicate"]
    return {
        "row_count": total["rows"],
        "distinct_keys": distinct,
        "duplicate_keys": duplicate,
        "surplus_rows": total["rows"] - distinct,
    }
