"""Shared plumbing: Arrow batches in and out, word memos, intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of a batch on its way to a worker. The JVM holds a batch several times over outside its heap (the vectors,
#: which double as they grow, and the stream), and so does the worker.
BATCH_BYTES = 2 << 20

_own_folder: str | None = None
_holders: dict[str, Callable[[], None]] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may start without it on their path, in a session with small batches."""
    if not 0 < spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    context = spark.sparkContext
    if getattr(context, "_railctx_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="railctx-")) / "railctx.zip"
    with zipfile.ZipFile(archive, "w") as held:
        for source in sorted(package.rglob("*.py")):
            held.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._railctx_shipped = True


def keyed_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that no other column can clash. Null text: empty."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def map_rows(df: DataFrame, rows: Callable[[], Callable[[tuple], Iterable[tuple]]], schema: str, chunk: int = 2048) -> DataFrame:
    """Rows to rows inside Arrow batches. ``rows()`` runs once per task and gives the row function.

    Results leave in batches of about ``chunk`` rows, so a task holds one incoming batch and
    one outgoing batch, whatever the size of its partition.
    """
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = rows()
        held: list[tuple] = []
        for batch in batches:
            columns = batch.columns
            for start in range(0, batch.num_rows, chunk):
                part = [c.slice(start, chunk).to_pylist() for c in columns]
                for row in zip(*part, strict=True):
                    held.extend(function(row))
                if len(held) >= chunk:
                    yield _batch(held, arrow)
                    held = []
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, kind)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def only(owner: str, release: Callable[[], None] | None = None) -> None:
    """Called where a task begins: ``owner`` may keep memos in this worker, which ``release`` gives back; all others are released.

    A worker outlives its tasks, so what one operator remembers would lie beside the work of the next.
    """
    others = [name for name in _holders if name != owner]
    for name in others:
        _holders.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    if release:
        _holders[owner] = release


class Memo(dict):
    """What a word becomes (never None), computed once per worker process; emptied when ``limit`` words are held."""

    def __init__(self, compute: Callable[[list], Iterable], limit: int = 500_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def of(self, words: list) -> list:
        """The value of every word, in order; words not seen before are computed in one call."""
        values = list(map(self.get, words))
        unknown = [place for place, value in enumerate(values) if value is None]
        if unknown:
            missing = list(dict.fromkeys([words[place] for place in unknown]))
            if len(self) + len(missing) > self.limit:
                self.clear()
            self.update(zip(missing, self.compute(missing), strict=True))
            for place in unknown:
                values[place] = self[words[place]]
        return values


def shared_folder(spark: SparkSession) -> str:
    """A new path in the cluster's checkpoint folder; a local session without one gets a folder of its own.

    On a cluster a folder of this machine would be missing on all others, so the setting must be there.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder is not None and not isinstance(folder, str):
        folder = folder.get() if folder.isDefined() else None
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        _own_folder = _own_folder or tempfile.mkdtemp(prefix="llm-")
        folder = _own_folder
    return f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder and go on from there: lineage ends, lost executors don't matter."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
