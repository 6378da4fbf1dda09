"""Counters at several places of one plan, filled by one pass over its source.

An audit of a source, of what is made of it, and of what was kept on the way would read the source once
for each. Here the counters are put at the nodes themselves: rows run through them once, on their way
to a sink that keeps nothing, and the columns that no counter needs are not computed.

Spark adds up a counter per finished task. A task that runs again, because an executor was lost with its
shuffle files, is added twice wherever the node lies below a shuffle. So each node also counts how often its
tasks began and which tasks did; where the two differ the pass is repeated.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ATTEMPTS = 3
#: Seconds to wait for a node of a finished pass; one that the optimiser removed never reports.
PATIENCE = 5.0

_TASK, _FIRST = "_task", "_first_of_task"
_BEGUN, _TASKS = "_begun", "_tasks"


class CountedTwice(RuntimeError):
    """A task ran more than once in every attempt, so its rows were counted more than once."""


class Nodes:
    """The counters of one pass, by the name of their place."""

    def __init__(self) -> None:
        self._placed: dict[str, tuple[Observation, list[str]]] = {}

    def at(self, name: str, df: DataFrame, counters: dict[str, Column]) -> DataFrame:
        """``df`` with aggregates over all of its rows, which it passes on unchanged."""
        observation = Observation(name)
        self._placed[name] = (observation, list(counters))
        # Ids count rows from 0 in their lower 33 bits.
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        numbered = df.withColumns({_TASK: F.spark_partition_id(), _FIRST: first})
        watched = numbered.observe(
            observation,
            *[counter.alias(counter_name) for counter_name, counter in counters.items()],
            F.count_if(_FIRST).alias(_BEGUN),
            F.size(F.collect_set(F.when(F.col(_FIRST), F.col(_TASK)))).alias(_TASKS),  # a number per task
        )
        return watched.drop(_TASK, _FIRST)

    def read(self) -> dict[str, dict[str, Any]]:
        """Counters by place, after the pass; those of a node that had no rows to see are None."""
        deadline = time.monotonic() + PATIENCE
        found = {}
        for name, (observation, counters) in self._placed.items():
            done = observation._jo.future()
            while not done.isCompleted() and time.monotonic() < deadline:
                time.sleep(0.01)
            seen = observation.get if done.isCompleted() and observation._jo.getRow().size() else {}
            if seen and seen[_BEGUN] != seen[_TASKS]:
                raise CountedTwice(f"{name}: {seen[_TASKS]} tasks began {seen[_BEGUN]} times")
            found[name] = {counter: seen.get(counter) for counter in counters}
        return found


def one_pass(build: Callable[[Nodes], DataFrame], attempts: int = ATTEMPTS) -> dict[str, dict[str, Any]]:
    """Run the plan that ``build`` makes, once, and return what its nodes counted.

    ``build`` puts counters where it wants them and returns the end of the plan.
    """
    for attempt in range(1, attempts + 1):
        nodes = Nodes()
        build(nodes).write.format("noop").mode("overwrite").save()
        try:
            return nodes.read()
        except CountedTwice:
            if attempt == attempts:
                raise
    raise ValueError("at least one attempt is needed")
