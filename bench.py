"""Time the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs on its own: nothing computed by one is kept for the next. The first round
is a warm-up and is not counted; the result of a query is the best of the counted rounds.
``BENCH_ROUNDS`` and ``BENCH_QUERIES`` (comma-separated names) narrow a trial run.
"""

from __future__ import annotations

import json
import os
import re
import time

from railctx.plans.queries import QUERIES, run
from railctx.session import build_session


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "railctx-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    best: dict[str, float] = {}
    for name in names:
        seconds(spark, name, sf_dir)
        best[name] = round(min(seconds(spark, name, sf_dir) for _ in range(rounds)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
