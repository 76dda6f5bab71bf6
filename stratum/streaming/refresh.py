"""A pipeline refresh whose order follows from what the steps read.

A step is SQL text, or a function of the session that gives a DataFrame; it refers to other
steps by name, as tables. Nobody lists the reads: a step is analysed, and a table that the
analysis misses and that is a step's name is a read of it. The step waits until that one
is written and is analysed again. Steps that wait for nothing run at the same time. After a failed
step those that read it, directly or not, are skipped and the others go on.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from stratum.session import shared_dir

Step = str | Callable[[SparkSession], DataFrame]


class CycleError(ValueError):
    """Steps that wait for each other."""


@dataclass
class Outcome:
    """What became of a step: written, failed (with the error) or skipped; the steps it read, and where its table is."""
    status: str = "waiting"
    reads: list[str] = field(default_factory=list)
    path: str | None = None
    error: str | None = None


def _missing(error: AnalysisException) -> str | None:
    """The table an analysis did not find."""
    if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
        return None
    return (error.getMessageParameters() or {}).get("relationName", "").replace("`", "") or None


def refresh(spark: SparkSession, steps: Mapping[str, Step], root: str | None = None, at_once: int = 4) -> dict[str, Outcome]:
    """Runs all steps and returns their outcomes in the order they ended.

    Each step's result is written under ``root`` and is a temporary view of the step's name from then on; a
    view of that name from before is dropped first. Names are compared without case, as tables' are.
    """
    log = logging.getLogger("SQLQueryContextLogger")  # a table that is not there yet is no error to report
    quiet, log.disabled = log.disabled, True
    try:
        return _refresh(spark, steps, root or shared_dir(spark, "refresh"), at_once)
    finally:
        log.disabled = quiet


def _refresh(spark: SparkSession, steps: Mapping[str, Step], root: str, at_once: int) -> dict[str, Outcome]:
    of = {name.lower(): name for name in steps}
    if len(of) < len(steps):
        raise ValueError("two steps differ only by case")
    for name in steps:
        spark.catalog.dropTempView(name)
    outcomes, ended = {name: Outcome() for name in steps}, {}

    def attempt(name: str) -> str | None:
        """Runs a step; returns the name of a step that it misses."""
        step = steps[name]
        there = {n for n, o in outcomes.items() if o.status == "written"}  # before the analysis: others may end during it
        try:
            df = spark.sql(step) if isinstance(step, str) else step(spark)
            df.schema  # noqa: B018 - analysed here at the latest
        except AnalysisException as e:
            read = of.get((_missing(e) or "").lower())
            if read is None or read in there:
                raise
            return read
        path = f"{root}/{name}"
        df.write.mode("overwrite").parquet(path)
        outcomes[name].path = path
        spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
        return None

    def end(name: str, status: str, error: str | None = None) -> None:
        outcomes[name].status, outcomes[name].error = status, error
        ended[name] = outcomes[name]

    waits: dict[str, str] = {}  # step -> the step it misses
    ready, running = list(steps), {}
    with ThreadPoolExecutor(at_once) as pool:
        while ready or running or waits:
            running.update({pool.submit(attempt, name): name for name in ready})
            ready = []
            if not running:
                loop = " -> ".join([*_loop(waits)])
                for name in waits:
                    end(name, "failed", f"cycle: {loop}")
                raise CycleError(loop)
            done: set[Future]
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for f in done:
                name = running.pop(f)
                if f.exception() is not None:
                    end(name, "failed", str(f.exception()).split("\n")[0])
                elif f.result() is None:
                    end(name, "written")
                else:
                    outcomes[name].reads.append(f.result())
                    waits[name] = f.result()
            moved = True
            while moved:  # a skipped step may let others know
                moved = False
                for name, read in list(waits.items()):
                    status = outcomes[read].status
                    if status == "waiting":
                        continue
                    moved = True
                    del waits[name]
                    if status == "written":
                        ready.append(name)
                    else:
                        end(name, "skipped", f"reads {read}")
    return ended


def _loop(waits: Mapping[str, str]) -> list[str]:
    """A cycle among the waiting steps."""
    seen: list[str] = []
    at = next(iter(waits))
    while at not in seen:
        seen.append(at)
        at = waits[at]
    return [*seen[seen.index(at):], at]
