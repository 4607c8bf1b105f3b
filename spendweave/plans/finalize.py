"""The reported code of each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions.measures import run_moment
from ..operators.reconcile import MIN_CONFIDENCE, final_code
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window


def batch(items: DataFrame, start: Moment | None, end: Moment, now: Column | None = None,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Items of a window with their final codes, but for those labelled by hand."""
    open_items = in_window(items, start, end).where("FINAL_REPORT_UNSPSC_MANUAL_LABELED IS NULL")
    return final_code(open_items, run_moment(now), min_confidence)


def merge(items: DataFrame, coded: DataFrame, now: Column | None = None) -> DataFrame:
    return upsert(items, coded, "ID", now=run_moment(now))


def run(items: DataFrame, start: Moment | None, end: Moment, now: Column | None = None,
        min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Item table with final codes for the batch; items labelled by hand stay."""
    now = run_moment(now)
    return merge(items, materialize(batch(items, start, end, now, min_confidence), "finalize"), now)
