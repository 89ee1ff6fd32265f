"""Job API (API-1..4, API-8): read -> transforms -> enrichments -> write.

A transform is any ``DataFrame -> DataFrame`` function; a chain is a tuple of
them applied with ``DataFrame.transform``, so the same chain runs on batch
frames and on streaming frames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial, reduce
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .session import create_file, list_names

Transform = Callable[[DataFrame], DataFrame]
Transforms = tuple[Transform, ...]


def apply_transforms(df: DataFrame, transforms: Sequence[Transform]) -> DataFrame:
    """API-1: left fold of ``DataFrame.transform``."""
    return reduce(lambda acc, f: acc.transform(f), transforms, df)


def bind(transform: Callable[..., DataFrame], *args: Any, **kwargs: Any) -> Transform:
    """API-4: an enrichment bound to its arguments."""
    return lambda df: transform(df, *args, **kwargs)


@dataclass(frozen=True)
class Job:
    """API-2/3: the value form of the read/transform/enrich/write hooks."""

    read: Callable[[SparkSession], DataFrame]
    transforms: Transforms = ()
    enrichments: Transforms = ()
    write: Callable[[DataFrame], Any] | None = None
    name: str = "job"

    def build(self, spark: SparkSession) -> DataFrame:
        """The lazy result frame (nothing runs)."""
        df = apply_transforms(self.read(spark), self.transforms)
        return apply_transforms(df, self.enrichments)

    def run(self, spark: SparkSession) -> Any:
        """Build and hand the frame to the writer (the only action)."""
        df = self.build(spark)
        return self.write(df) if self.write else df


def run_stages(spark: SparkSession, stages: Sequence[Job]) -> list[Any]:
    """API-8: run idempotent stages in order (raw -> bars -> serving)."""
    return [stage.run(spark) for stage in stages]


@dataclass(frozen=True)
class Stage:
    """API-8: a job, or any function of the session, in a graph: it runs once every stage in
    ``after`` is done. ``pool``: the scheduler pool of its Spark jobs (its own by default)."""

    name: str
    run: Callable[[SparkSession], Any]
    after: tuple[str, ...] = ()
    pool: str | None = None


class StageFailure(RuntimeError):
    """Stages that raised; what depends on them was not begun, and everything else has run."""

    def __init__(self, failed: dict[str, BaseException], skipped: Sequence[str]):
        self.failed, self.skipped = failed, list(skipped)
        super().__init__(f"failed: {', '.join(f'{k} ({v!r})' for k, v in failed.items())}; not begun: {self.skipped}")


def stage_order(stages: Sequence[Stage]) -> list[str]:
    """The names in an order that respects ``after``; ValueError for repeated names, unknown
    ones and cycles."""
    by_name = {s.name: s for s in stages}
    if len(by_name) < len(stages):
        raise ValueError("two stages have one name")
    unknown = {a for s in stages for a in s.after} - by_name.keys()
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    try:
        return list(TopologicalSorter({s.name: s.after for s in stages}).static_order())
    except CycleError as cycle:
        raise ValueError(f"stages wait for one another: {cycle.args[1]}") from None


def run_graph(
    spark: SparkSession, stages: Sequence[Stage], state: str, max_parallel: int = 8
) -> dict[str, str]:
    """API-8: run a graph of idempotent stages, those that do not wait for one another side by
    side; what became of each: ``done``, or ``kept`` if an earlier run had done it.

    ``state`` is a folder for this run (of one run date, say): a stage leaves a marker there
    when it has ended, and a rerun with the same folder begins at the first stages without
    one. A stage that fails stops only what depends on it; the others run to their end, then
    :class:`StageFailure` tells. Each stage's Spark jobs go to a scheduler pool of its own, so with
    ``spark.scheduler.mode=FAIR`` side-by-side stages share the executors; the thread hands
    the caller's local properties down.
    """
    stage_order(stages)
    by_name = {s.name: s for s in stages}
    marked = set(list_names(spark, state))
    outcome = {n: "kept" for n in by_name if f"{n}.done" in marked}
    failed: dict[str, BaseException] = {}
    running: dict[Future, str] = {}

    def run(stage: Stage) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", stage.pool or stage.name)
        stage.run(spark)
        create_file(spark, f"{state}/{stage.name}.done", datetime.now(timezone.utc).isoformat())

    with ThreadPoolExecutor(max_parallel) as threads:
        while True:
            begun = {*outcome, *failed, *running.values()}
            ready = [s for n, s in by_name.items() if n not in begun and all(a in outcome for a in s.after)]
            for stage in ready:
                work = inheritable_thread_target(spark)(partial(run, stage))
                running[threads.submit(work)] = stage.name
            if not running:
                break
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                error = future.exception()
                if error is None:
                    outcome[name] = "done"
                else:
                    failed[name] = error
    if failed:
        raise StageFailure(failed, [n for n in by_name if n not in outcome and n not in failed])
    return outcome
