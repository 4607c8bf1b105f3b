"""Dates and amounts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_moment(now: Column | None = None) -> Column:
    """The time of a run: one value for all its jobs, unless the caller sets it.

    ``current_timestamp`` would differ between the jobs of a run.
    """
    return F.lit(datetime.now()) if now is None else now


def month_start(moment: Column) -> Column:
    """First instant of the month, as a timestamp."""
    return F.date_trunc("month", moment)


def whole_amount(quantity: Column, unit_price: Column) -> Column:
    """Line amount without its fraction (truncated toward zero)."""
    return (quantity * unit_price).cast("bigint")
