"""Star schema: product dimension, and the facts that refer to it."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions.measures import run_moment
from ..operators.dedup import keep_first
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window, project

#: Facts may arrive after their item; the item window reaches back this far.
LOOK_BACK = timedelta(days=7)


def dimension_rows(items: DataFrame, start: Moment, end: Moment,
                   obsolete: str = C.STATUS_OBSOLETE,
                   look_back: timedelta = LOOK_BACK) -> DataFrame:
    """One item per purchase line, the most recently updated, then lowest ID."""
    batch = in_window(items, start, end, look_back=look_back)
    rows = project(batch, [*C.DIMENSION, C.UPDATED], F.col("DASHBOARD_STATUS") != obsolete)
    return keep_first(rows, "PO_ITEM_ID", [F.col(C.UPDATED).desc(), "ID"]).drop(C.UPDATED)


def link_facts(fact: DataFrame, rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Facts with a reference to their product; blanket orders stay without."""
    return upsert(fact, rows.select("ID", "PO_ITEM_ID"), {"ID": "PO_ITEM_ID"},
                  when="target.IS_BLANKET = 0 AND (target.PRODUCT_ID IS NULL "
                       "OR source.ID <> target.PRODUCT_ID)",
                  update={"PRODUCT_ID": "source.ID"}, insert=False, unique=True, now=now)


def merge(dimension: DataFrame, rows: DataFrame, now: Column | None = None) -> DataFrame:
    return upsert(dimension, rows, "ID", unique=True, now=now)


def run(items: DataFrame, dimension: DataFrame, fact: DataFrame, start: Moment, end: Moment,
        now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Dimension and fact table with the batch merged in."""
    now = run_moment(now)
    rows = materialize(dimension_rows(items, start, end), "dimension")
    return merge(dimension, rows, now), link_facts(fact, rows, now)
