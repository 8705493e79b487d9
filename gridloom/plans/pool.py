"""A bounded pool of Spark jobs for the lines of a list: several at a time, each tried again, none held up by another."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from gridloom.operators.lineage import shared_path

OUTCOMES = "table string, status string, rows long, reason string, attempts int"
#: Outcomes that the driver holds before it writes them.
HELD = 1_000


@dataclass(frozen=True)
class Pool:
    """How lines are run: so many at a time, each tried again so often, after a pause that doubles from ``pause`` on."""

    workers: int = 4
    retries: int = 3
    pause: float = 4.0
    #: Errors that another attempt would not mend.
    final: tuple[type[Exception], ...] = (ValueError, TypeError, KeyError, AnalysisException)

    def attempt(self, spark: SparkSession, run: Callable, line, name: str) -> tuple:
        """The outcome of one line. Its jobs go to a scheduler pool of their own, so that lines share the cluster
        evenly where the fair scheduler is on."""
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        for attempt in range(1, self.retries + 2):
            try:
                return line["table"], "ok", run(line), "", attempt
            except Exception as problem:
                reason = f"{type(problem).__name__}: {problem}"
                if isinstance(problem, self.final) or attempt > self.retries:
                    return line["table"], "fail", 0, reason, attempt
            time.sleep(self.pause * 2 ** (attempt - 1))
        raise AssertionError("unreachable")


def run_lines(spark: SparkSession, lines: Iterable, run: Callable, pool: Pool = Pool()) -> DataFrame:
    """One outcome row for each line (a row with ``table``), in no stated order: status, rows, reason and attempts.

    Lines are taken as workers become free, so the driver holds no more of them than workers, and outcomes are written
    whenever ``HELD`` are there. A line that fails, or waits for its next attempt, holds up one worker only.
    """
    folder = shared_path(spark)
    done: list[tuple] = []

    def write() -> None:
        spark.createDataFrame(done, OUTCOMES).coalesce(1).write.mode("append").parquet(folder)
        done.clear()

    def take(finished: Iterable[Future]) -> None:
        done.extend(f.result() for f in finished)
        if len(done) >= HELD:
            write()

    with ThreadPoolExecutor(pool.workers) as threads:
        running: set[Future] = set()
        for number, line in enumerate(lines):
            if len(running) >= pool.workers:
                finished, running = wait(running, return_when=FIRST_COMPLETED)
                take(finished)
            work = inheritable_thread_target(spark)(pool.attempt)
            running.add(threads.submit(work, spark, run, line, f"line_{number % pool.workers}"))
        take(wait(running).done)
    write()
    return spark.read.schema(OUTCOMES).parquet(folder)
