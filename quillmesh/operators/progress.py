"""Rows in and out of each stage of a run, taken while the stages do their work, and progress of streams."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quillmesh.plans.runtime import written


def staged(rows: DataFrame, stages: dict[str, Callable[[DataFrame], DataFrame]], told: Callable[[str, int, int], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """The last stage's rows, and (place, stage, rows_in, rows_out) as observed when each stage was written; ``told`` hears of each as it ends."""
    seen: list[tuple[str, int, int]] = []
    for name, stage in stages.items():
        came, went, source = Observation(), Observation(), rows
        rows = written(stage(rows if seen else rows.observe(came, F.count(F.lit(1)).alias("n"))).observe(went, F.count(F.lit(1)).alias("n")))
        seen.append((name, seen[-1][2] if seen else _told(came, source), _told(went, rows)))
        if told:
            told(*seen[-1])
    seen = [(place, *x) for place, x in enumerate(seen)]
    return rows, rows.sparkSession.createDataFrame(seen, "place int, stage string, rows_in long, rows_out long")


def _told(observed: Observation, rows: DataFrame) -> int:
    """The observed number of rows; they are counted where the plan came to nothing, and its observation with it."""
    try:
        return observed.get["n"]
    except Py4JError:
        return rows.count()


class Progress(StreamingQueryListener):
    """Keeps the rows of each micro-batch of the streams that end while it listens, under their name."""

    def __init__(self) -> None:
        self.batches: list[tuple[str | None, int, int]] = []
        self.failed: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.name, p.batchId, p.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed.append(event.exception)
