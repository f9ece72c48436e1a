"""Progress of a write while it runs, from Spark's status tracker."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Called with tasks done, tasks known so far, and the rows written: None until the write is complete.
Progress = Callable[[int, int, int | None], None]
SECONDS = 0.5
GROUP = ("spark.jobGroup.id", "spark.job.description")


def tasks_of(spark: SparkSession, group: str) -> tuple[int, int]:
    """Tasks done, failed attempts not counted, and tasks in all, of the stages of a job group that have been submitted."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(stage) for stage in {stage for job in jobs if job for stage in job.stageIds}]
    known = [stage for stage in stages if stage and stage.numTasks]
    return sum(stage.numCompletedTasks for stage in known), sum(stage.numTasks for stage in known)


@contextmanager
def watched(spark: SparkSession, progress: Progress | None) -> Iterator[Callable[[int], None]]:
    """Report the jobs that the block starts, twice a second where tasks ended; yields what reports the rows at the end.

    Tasks done never fall, also if a stage runs again; the tasks in all grow while later stages are planned. The jobs run
    in a job group of their own meanwhile. A callback that raises while the write runs ends the reports, not the write.
    """
    if progress is None:
        yield lambda rows: None
        return
    context, group, ended, most = spark.sparkContext, uuid.uuid4().hex, threading.Event(), [0, 0]

    def poll() -> None:
        while not ended.wait(SECONDS):
            done, tasks = tasks_of(spark, group)
            if done > most[0]:
                most[:] = done, max(tasks, done, most[1])
                progress(*most, None)

    def finished(rows: int) -> None:
        ended.set()
        thread.join()
        progress(*[max(most[0], *tasks_of(spark, group))] * 2, rows)

    before = [context.getLocalProperty(name) for name in GROUP]
    context.setJobGroup(group, before[1] or "write")
    thread = threading.Thread(target=poll, daemon=True)
    thread.start()
    try:
        yield finished
    finally:
        ended.set()
        for name, value in zip(GROUP, before):
            context.setLocalProperty(name, value)
