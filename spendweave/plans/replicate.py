"""Full copies: commodity dimension, training items, model records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import AUDIT
from ..operators.upsert import insert_absent, upsert


def load_commodity(commodity: DataFrame, dimension: DataFrame,
                   now: Column | None = None) -> DataFrame:
    """Commodity dimension with the raw table merged in, codes as text."""
    rows = commodity.drop(*AUDIT).withColumn("CODE", F.col("CODE").cast("string"))
    return upsert(dimension, rows, "ID", now=now, merge_schema=True, one_pass=True)


def copy_training_items(raw: DataFrame, training: DataFrame,
                        now: Column | None = None) -> DataFrame:
    """Training items with the raw table merged in. An update also takes the
    raw row's creation time; an insert is stamped with the run."""
    return upsert(training, raw, "ID", now=now, one_pass=True, keep_created=False)


def record_models(models: DataFrame, rows: DataFrame) -> DataFrame:
    """Model records, with unseen (name, version) pairs added."""
    return insert_absent(models, rows, ["NAME", "VERSION"])
