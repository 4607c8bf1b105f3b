"""Batch windows: where a job's next batch starts, and moving that on."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.upsert import update_rows, upsert
from .tables import has_snapshot, read_snapshot, replace_snapshot

Window = tuple[datetime | None, datetime]


def batch_window(offsets: DataFrame, job: str, start: datetime | None = None,
                 end: datetime | None = None) -> Window:
    """Start and end of a job's next batch: the arguments, else the stored offset
    and now. A job that never ran, or was told to start over, has no start: it
    reads everything up to the end."""
    if start is None:
        row = job_windows(offsets).where(F.col("JOB") == job).first()
        start = row["START_AT"] if row else None
    return start, end or datetime.now()


def job_windows(offsets: DataFrame) -> DataFrame:
    """The next start of every job; NULL for one that starts over."""
    return offsets.select("JOB", F.when(~F.col("RESET_FLAG").eqNullSafe(1), F.col("OFFSET_AT"))
                          .alias("START_AT"))


def commit_offset(offsets: DataFrame, job: str, end: datetime) -> DataFrame:
    """Offsets with ``job`` moved on to ``end`` and its reset done. To be
    written after the job succeeded; a failed job repeats its window."""
    moved = offsets.sparkSession.range(1).select(
        F.lit(job).alias("JOB"), F.lit(end).cast("timestamp").alias("OFFSET_AT"),
        F.lit(0).alias("RESET_FLAG"))
    return upsert(offsets, moved, "JOB", unique=True)


def request_reset(offsets: DataFrame, job: str, flag: int = 1) -> DataFrame:
    """Offsets with a job told to start over (or not)."""
    return update_rows(offsets, {"RESET_FLAG": F.lit(flag)}, F.col("JOB") == job)


def run_batch(spark: SparkSession, root: str, job: str,
              step: Callable[[datetime | None, datetime], None], start: datetime | None = None,
              end: datetime | None = None, commit: bool = True) -> Window:
    """Run ``step`` on the job's next window and move its offset on.

    ``root`` holds the offset table. An error in ``step`` leaves the offset
    alone, so the next run repeats the window; merges by key make that harmless.
    """
    offsets = (read_snapshot(spark, root) if has_snapshot(spark, root)
               else spark.createDataFrame([], schemas.JOB_OFFSET))
    window = batch_window(offsets, job, start, end)
    step(*window)
    if commit:
        replace_snapshot(commit_offset(offsets, job, window[1]), root)
    return window
