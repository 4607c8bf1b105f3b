"""Quality of descriptions and buyer codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions.measures import run_moment
from ..operators import reconcile
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window

#: An item is rewritten only if its evaluation differs from the stored one.
CHANGED = """
    source.PROCESSED_DESCRIPTION <> target.PROCESSED_DESCRIPTION
    OR target.AN_CLASSIFICATION_QUALITY_COMMODITY IS NULL
    OR source.AN_CLASSIFICATION_QUALITY_COMMODITY <> target.AN_CLASSIFICATION_QUALITY_COMMODITY
    OR source.AN_UNSPSC_COMMODITY <> target.AN_UNSPSC_COMMODITY"""


def evaluate_items(items: DataFrame, commodity: DataFrame) -> DataFrame:
    """Items with cleaned, rated description and validated, split code.

    The valid codes are written first: the code directory is bounded, and its
    measured size lets it be broadcast instead of shuffling the items by code.
    """
    valid = materialize(reconcile.valid_codes(commodity), "valid-codes")
    rated = reconcile.rate_descriptions(items)
    return reconcile.derive_levels(reconcile.validate_codes(rated, valid))


def batch(items: DataFrame, commodity: DataFrame, start: Moment | None, end: Moment) -> DataFrame:
    """The evaluated items of a window."""
    return evaluate_items(in_window(items, start, end), commodity)


def merge(items: DataFrame, evaluated: DataFrame, now: Column | None = None) -> DataFrame:
    return upsert(items, evaluated, "ID", when=CHANGED, insert=False, now=run_moment(now))


def run(items: DataFrame, commodity: DataFrame, start: Moment | None, end: Moment,
        now: Column | None = None) -> DataFrame:
    """The item table with the batch's evaluations merged in."""
    return merge(items, materialize(batch(items, commodity, start, end), "evaluate"), now)
