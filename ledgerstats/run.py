"""Compute statistics and store them: one period at a time, or all of them again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerstats import files
from ledgerstats.functions.calendar import DAY_SECONDS
from ledgerstats.operators.periods import Period
from ledgerstats.plans.inputs import Inputs
from ledgerstats.plans.registry import (
    STATISTICS,
    WIDE_STATISTICS,
    Shared,
    period_for,
    prerequisites,
    shared_by,
    statistic_of,
)
from ledgerstats.session import configure
from ledgerstats.sources.base import LedgerSource
from ledgerstats.store import Store


class StatisticsFailed(RuntimeError):
    def __init__(self, errors: dict[str, BaseException]):
        super().__init__("could not be computed: " + ", ".join(sorted(errors)))
        self.errors = errors


class DependencyFailed(RuntimeError):
    pass


class _Once:
    """A shared join's result, written by whichever of its statistics comes first."""

    def __init__(self, spark: SparkSession, root: str, shared: Shared, inputs: Inputs):
        self.spark, self.shared, self.inputs = spark, shared, inputs
        self.path = f"{root}/_shared/{uuid.uuid4().hex}"
        self.lock = Lock()
        self.schema: StructType | None = None
        self.failed = False

    def values(self, period: Period) -> DataFrame | None:
        """(period, a column for each statistic); none where it cannot be computed for all."""
        with self.lock:
            if self.schema is None and not self.failed:
                try:
                    rows = self.shared.plan(self.inputs, period)
                    rows.hint("rebalance").write.parquet(self.path)
                    self.schema = rows.schema
                except Exception:
                    self.failed = True
            return None if self.failed else self.spark.read.schema(self.schema).parquet(self.path)

    def clear(self) -> None:
        files.delete(self.spark, self.path)


def run(
    source: LedgerSource,
    store: Store,
    statistics: Iterable[str] | None = None,
    timestamp: int | None = None,
    rebuild: bool = False,
    at_once: int = 4,
) -> list[str]:
    """Compute and store statistics and what they depend on; all nineteen by default.

    `timestamp` (epoch seconds) names the day and week to compute, by default
    yesterday's. A period that is not complete yet stores nothing, and stored rows never
    change. `rebuild` replaces each table by all complete periods, in one job per table.

    Up to `at_once` statistics that do not depend on each other are submitted side by
    side, so that the last tasks of one do not leave the cluster idle. A statistic that
    fails does not stop the others. Statistics that need the same join get it computed once:
    what it gives, a row a period, is written and each takes its column; where that fails they
    are computed one by one. Returns the names computed, in the order they were;
    raises `StatisticsFailed` at the end if any failed.
    """
    if rebuild and timestamp is not None:
        raise ValueError("a rebuild covers all periods: it takes no timestamp")
    names = list(STATISTICS if statistics is None else statistics)
    unknown = sorted(set(names) - STATISTICS.keys() - WIDE_STATISTICS.keys())
    if unknown:
        raise ValueError("unknown statistics: " + ", ".join(unknown))
    if not rebuild and timestamp is None:
        timestamp = int(time.time()) - DAY_SECONDS

    configure(source.spark, source.size_in_bytes())
    extent = source.extent()
    inputs = Inputs(source, store.read, one_period=not rebuild)
    done: list[str] = []
    errors: dict[str, BaseException] = {}
    joins: dict[str, _Once] = {}
    for shared in shared_by(prerequisites(names), source):
        once = _Once(source.spark, store.root, shared, inputs)
        joins.update({name: once for name in shared.statistics})

    def plan_of(name: str, period: Period | None) -> DataFrame:
        if name in joins and (values := joins[name].values(period)) is not None:
            return joins[name].shared.member(values, name, period)
        return statistic_of(name).plan(inputs, period)

    def compute_and_store(name: str) -> None:
        statistic = statistic_of(name)
        failed = [other for other in statistic.depends_on if other in errors]
        if failed:
            raise DependencyFailed(", ".join(failed))
        period = period_for(extent, statistic.unit, timestamp)
        if rebuild and statistic.rollup_of in done:
            store.replace(name, statistic.rollup(store.read(statistic.rollup_of), period))
        elif rebuild or period is None:
            store.replace(name, plan_of(name, period))
        elif not period.is_empty:
            store.insert(name, plan_of(name, period), period)

    waiting = TopologicalSorter(prerequisites(names))
    waiting.prepare()
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(at_once) as pool:
        while waiting.is_active():
            for name in waiting.get_ready():
                running[pool.submit(compute_and_store, name)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name, error = running.pop(future), future.exception()
                if error is None:
                    done.append(name)
                else:
                    errors[name] = error
                waiting.done(name)
    for join in joins.values():
        join.clear()
    if errors:
        raise StatisticsFailed(errors)
    return done
