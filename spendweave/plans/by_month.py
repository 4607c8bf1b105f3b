"""Jobs on tables partitioned by document month.

A daily batch touches few months. The job's batch is computed from the whole
table (its window is pushed down), then only the months it falls into are read,
merged and rewritten. A row must keep its document month.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import replace_partitions, write_table

MONTH = "MONTH"


def with_month(df: DataFrame, date: str = "DOCUMENT_DATE") -> DataFrame:
    """Add the month of ``date`` as a number like 202405; NULL has a partition of its own."""
    return df.withColumn(MONTH, (F.year(date) * 100 + F.month(date)).cast("int"))


def write_by_month(df: DataFrame, path: str, date: str = "DOCUMENT_DATE") -> None:
    write_table(with_month(df, date), path, partition_by=[MONTH])


def run_by_month(spark: SparkSession, path: str, make_batch: Callable[[DataFrame], DataFrame],
                 merge: Callable[[DataFrame, DataFrame], DataFrame],
                 date: str | None = None) -> int:
    """Merge a job's batch into the table at ``path``; how many months were rewritten.

    ``make_batch`` gets the table, ``merge`` its touched months and the batch (see
    the ``batch`` and ``merge`` functions of the jobs). ``date`` names the date of a
    batch that does not carry the table's month.
    """
    batch = make_batch(spark.read.parquet(path))
    batch = materialize(with_month(batch, date) if date else batch, "month-batch")
    return replace_partitions(spark, path, batch, [MONTH], merge)
