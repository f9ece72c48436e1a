"""Exports that run batch by batch: bounded memory, running progress, restart where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

POLL_SECONDS = 0.2
# Batches whose progress a query remembers; Spark's default of 100 would lose rows from the count.
KEPT_UPDATES = "1000000"


def export_stream(
    stream: DataFrame, path: str, checkpoint: str, progress: Callable[[int], None] | None = None
) -> int:
    """Write all rows a stream has now to ZSTD Parquet; returns the rows of this run.

    progress is called with the running total as batches complete. The checkpoint records which
    files are done, so a second run adds only files that came later.
    """
    counted = stream.observe("exported", F.count(F.lit(1)).alias("rows"))
    conf, retained = stream.sparkSession.conf, "spark.sql.streaming.numRecentProgressUpdates"
    before = conf.get(retained)
    conf.set(retained, KEPT_UPDATES)  # the query takes the setting over when it starts
    try:
        run = (
            counted.writeStream.format("parquet")
            .option("compression", "zstd")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
    finally:
        conf.set(retained, before)
    total, last = 0, -1
    try:
        while True:
            ended = run.awaitTermination(POLL_SECONDS)
            for batch in run.recentProgress:
                if batch.batchId <= last or "exported" not in batch.observedMetrics:
                    continue
                last = batch.batchId
                total += batch.observedMetrics["exported"].rows
                if progress:
                    progress(total)
            if ended:
                return total
    finally:
        if run.isActive:
            run.stop()
