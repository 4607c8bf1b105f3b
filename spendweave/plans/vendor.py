"""Exchange with the outside labelling vendor: export, import, apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions.measures import run_moment
from ..operators.dedup import keep_first
from ..operators.joins import anti_filter
from ..operators.numbering import dense_number
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window, latest_predictions, project, unpredicted
from ..sources.tables import export_csv, next_run


# -- export -----------------------------------------------------------------------

def export_candidates(items: DataFrame, start: Moment, end: Moment,
                      obsolete: str = C.STATUS_OBSOLETED, now: Column | None = None) -> DataFrame:
    """One item per well-described text the vendor has not labelled."""
    open_levels = " AND ".join(f"EXTERNAL_PREDICATED_UNSPSC_{level} IS NULL" for level in C.LEVELS)
    wanted = f"{open_levels} AND DASHBOARD_STATUS <> '{obsolete}' AND AN_DATA_QUALITY_LEVEL = 'Good'"
    rows = project(in_window(items, start, end), C.EXPORT, wanted)
    moment = run_moment(now)
    return keep_first(rows, "PROCESSED_DESCRIPTION", ["PO_ITEM_ID"]).withColumn(C.UPDATED, moment)


def to_export(candidates: DataFrame, report: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Candidates not exported before; ``batch_size`` takes the first by text, of which
    there is one row each."""
    fresh = anti_filter(candidates, report, "PROCESSED_DESCRIPTION")
    if not batch_size:
        return fresh
    numbered = dense_number(fresh, ["PROCESSED_DESCRIPTION"], "__at")
    return numbered.where(F.col("__at") < batch_size).drop("__at")


def mark_exported(report: DataFrame, exported: DataFrame, now: Column | None = None) -> DataFrame:
    """The report with the exported texts listed, still without an answer."""
    return upsert(report, exported.select("DESCRIPTION", "PROCESSED_DESCRIPTION"),
                  "PROCESSED_DESCRIPTION", unique=True, now=now)


def run_export(items: DataFrame, report: DataFrame, path: str, start: Moment, end: Moment,
               export_date: str, batch_size: int | None = None,
               now: Column | None = None) -> DataFrame:
    """Write the export and return the new report. The exported rows are fixed
    before they are used twice."""
    now = run_moment(now)
    rows = materialize(to_export(export_candidates(items, start, end, now=now), report,
                                 batch_size), "vendor-export")
    export_csv(rows, path, export_date, next_run(items.sparkSession, path, export_date))
    return mark_exported(report, rows, now)


# -- import and apply ----------------------------------------------------------------

def answered_items(items: DataFrame, report: DataFrame) -> DataFrame:
    """Items joined to the report by text, with the report's codes as theirs.

    A description in the report replaces the item's. Confidences are not taken
    over.
    """
    kept = [name for name in report.columns
            if name in C.REPORT_TO_ITEM or name in ("PROCESSED_DESCRIPTION", "DESCRIPTION")]
    own = [name for name in items.columns if name not in C.REPORT_TO_ITEM.values()]
    return (items.select(*own).join(report.select(*kept), "PROCESSED_DESCRIPTION")
            .withColumnsRenamed(C.REPORT_TO_ITEM))


def feed_to_report(feed: DataFrame) -> DataFrame:
    """Newest answer per text, in report columns."""
    return latest_predictions(feed, C.VENDOR_FEED).withColumnsRenamed(C.FEED_TO_REPORT)


#: The answer that was given later wins, in whichever order they arrive.
NOT_OLDER = ("target.REPORT_LASTUPDATED_AT IS NULL OR "
             "source.REPORT_LASTUPDATED_AT >= target.REPORT_LASTUPDATED_AT")


def merge_report(report: DataFrame, answers: DataFrame, now: Column | None = None) -> DataFrame:
    """The report with answers (one per text) merged in; older ones change nothing.
    Answers to no text (NULL) count as one text."""
    return upsert(report, answers, "PROCESSED_DESCRIPTION", when=NOT_OLDER, unique=True,
                  null_safe=True, now=now)


#: The same for items.
ITEM_NOT_OLDER = ("target.EXTERNAL_PREDICATION_LASTUPDATED_AT IS NULL OR "
                  "source.EXTERNAL_PREDICATION_LASTUPDATED_AT >= "
                  "target.EXTERNAL_PREDICATION_LASTUPDATED_AT")


def import_batch(items: DataFrame, answers: DataFrame) -> DataFrame:
    """Items without an answer whose text has been answered."""
    return answered_items(unpredicted(items, C.VENDOR_ITEM), answers)


def import_merge(items: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    return upsert(items, updates, "ID", when=ITEM_NOT_OLDER, insert=False, now=now)


def run_import(items: DataFrame, report: DataFrame, feed: DataFrame,
               now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Item table and report with a vendor feed merged in."""
    now = run_moment(now)
    answers = materialize(feed_to_report(feed), "vendor-answers")
    updates = materialize(import_batch(items, answers), "vendor-items")
    return import_merge(items, updates, now), merge_report(report, answers, now)


#: An item keeps an answer of the same time.
NEWER = ("target.EXTERNAL_PREDICATION_LASTUPDATED_AT IS NULL OR "
         "source.EXTERNAL_PREDICATION_LASTUPDATED_AT <> target.EXTERNAL_PREDICATION_LASTUPDATED_AT")


def apply_batch(items: DataFrame, report: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """The window's unanswered items whose text has a stored answer."""
    return answered_items(unpredicted(in_window(items, start, end), C.VENDOR_ITEM), report)


def apply_merge(items: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    return upsert(items, updates, "ID", when=NEWER, insert=False, now=now)


def run_apply(items: DataFrame, report: DataFrame, start: Moment, end: Moment,
              now: Column | None = None) -> DataFrame:
    """Item table with stored answers applied to the batch's unanswered items."""
    return apply_merge(items, materialize(apply_batch(items, report, start, end), "vendor-apply"), now)
