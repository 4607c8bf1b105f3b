"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_RANK, _ROW = "__rank", "__row"
#: Hashes of repeated rows up to which they are broadcast (8 bytes each); they are counted first.
FEW_REPEATS = 100_000


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` of a frame that is read from files, and may be read twice.

    Hashes of the rows are counted first: a row whose hash does not repeat is not moved, the
    others are compared whole. If many repeat, all are.
    """
    row = F.xxhash64(*df.columns)
    repeated = materialize(df.select(row.alias(_ROW)).groupBy(_ROW).count().where("count > 1").select(_ROW), "repeated")
    if repeated.count() > FEW_REPEATS:
        return df.distinct()
    marked, few = df.withColumn(_ROW, row), F.broadcast(repeated)
    return (marked.join(few, _ROW, "left_anti").drop(_ROW)
            .unionByName(marked.join(few, _ROW, "left_semi").drop(_ROW).distinct()))


def keep_first(df: DataFrame, keys: str | Sequence[str],
               order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first row of each key under ``order_by``; no keys drops repeated rows.

    A hash of the whole row ends the order, so rows that tie are equal rows and
    the result does not depend on partitioning. The filter on ``row_number``
    lets Spark keep one row per key *before* the shuffle (WindowGroupLimit), so
    a key holding a large share of the rows costs one row per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        return df.distinct()
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order_by, F.xxhash64(*df.columns)))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], moment: str,
                   tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """The most recent row of each key."""
    return keep_first(df, keys, [F.col(moment).desc(), *tie_break])
