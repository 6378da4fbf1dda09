"""Session settings and the few physical decisions the operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

BROADCAST_BYTES = 64 * 1024 * 1024

HASHED_PART = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

_local_folder: str | None = None


def build_session(app: str = "railctx", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the UTC clock the time operators rely on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Call-site capture costs several JVM calls per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Wall clocks are kept in TIMESTAMP columns, so any other zone would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def together(spark: SparkSession, steps: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent actions side by side, so that small jobs fill idle slots of large ones."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()
        }
        return {name: future.result() for name, future in started.items()}


def hash_short_parts(spark: SparkSession) -> None:
    """Let the adaptive execution join by hash, without sorting, where every part of a side turns out to be short.

    Short is what it makes of merged parts anyway (64 MiB by default); joins with a longer part stay sorted ones, which
    spill and are split where they are skewed. A session that has a limit of its own keeps it.
    """
    if spark.conf.get(HASHED_PART) in ("0", "0b"):
        spark.conf.set(HASHED_PART, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))


def _shared_folder(spark: SparkSession) -> str | None:
    """The cluster's checkpoint folder; a local session without one gets its own.

    A cluster session without the setting gets none: a machine-local folder would be
    missing on the other machines and lost with an executor.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        if _local_folder is None:
            _local_folder = tempfile.mkdtemp(prefix="railctx-")
            # Nobody else knows this folder; what lies in a cluster's folder is the cluster's to clear.
            atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
        folder = _local_folder
    return folder


def shared_path(spark: SparkSession) -> str | None:
    """A new path in the shared folder, if there is one."""
    folder = _shared_folder(spark)
    return None if folder is None else f"{folder.rstrip('/')}/railctx-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute a shared input once, as a table in the shared folder.

    Later plans read it with column pruning and known sizes, and survive lost executors.
    Without a shared folder the plan stays lazy.
    """
    path = shared_path(df.sparkSession)
    if path is None:
        return df
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
