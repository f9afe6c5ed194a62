"""How far running jobs are."""

from __future__ import annotations

from pyspark.sql import SparkSession


def time_left(seconds: float | None) -> str:
    """As ``functions.values.eta`` writes it."""
    if seconds is None or seconds < 0:
        return "calculating..."
    h, rest = divmod(int(seconds), 3600)
    m, s = divmod(rest, 60)
    return f"{h}h {m:02d}m {s:02d}s" if h else f"{m}m {s:02d}s" if m else f"{s}s"


def estimate(done: int, total: int, elapsed: float) -> float | None:
    """Seconds left at the pace so far; None before anything is done."""
    return elapsed / done * (total - done) if done else None


def tasks(spark: SparkSession) -> tuple[int, int]:
    """Tasks done and tasks in all of the stages that run."""
    tracker = spark.sparkContext.statusTracker()
    found = [tracker.getStageInfo(i) for i in tracker.getActiveStageIds()]
    return sum(s.numCompletedTasks for s in found if s), sum(s.numTasks for s in found if s)
