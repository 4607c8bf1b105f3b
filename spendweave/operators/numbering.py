"""Numbers and top rows without passing rows through one task.

``dense_number`` deals rows out by ranges of their order, counts each range and adds the
counts up; ``top_rows`` finds the value at which the k-th row lies from histograms, so no
partition hands over k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PART, _AT = "__part", "__at"
#: Leading bits of a count by which a first histogram is made (64 * 2**10 buckets at most).
_BITS = 10


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dense_number(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 0) -> DataFrame:
    """``df`` with the rows numbered in ``order`` from ``start``; ties in any order.

    The rows are written by ranges of the order, so that all passes see the same ranges.
    Only one count for each range comes to the driver.
    """
    keys = _columns(order)
    ranged = materialize(df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()), "ranges")
    before, offsets = start, []
    for part, rows in sorted(ranged.groupBy(_PART).count().collect()):
        offsets.append((part, before))
        before += rows
    if not offsets:
        return ranged.withColumn(name, F.lit(0).cast("long")).drop(_PART)
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*keys)) - 1
    known = F.create_map(*[F.lit(x) for pair in offsets for x in pair])
    return ranged.withColumn(name, (F.element_at(known, F.col(_PART)) + place).cast("long")).drop(_PART)


def _edge(counts: DataFrame, k: int) -> tuple[int, int] | None:
    """The value that the k-th row from above has in ``value``, and how many rows lie above it."""
    totals = counts.withColumn("above", F.sum("rows").over(Window.orderBy(F.desc("value"))) - F.col("rows"))
    row = totals.where((F.col("above") < k) & (F.col("above") + F.col("rows") >= k)).first()
    return (row["value"], row["above"]) if row else None


def top_rows(df: DataFrame, k: int, by: str, ties: Sequence[str | Column]) -> DataFrame:
    """The ``k`` rows with the largest ``by`` (positive integers), of equal ones the first by
    ``ties``; all rows if there are fewer.

    A histogram of the leading bits finds where the k-th row lies, one of the exact values
    within them its value; the rows of that value are numbered by range. ``df`` is read
    several times and should have been written.
    """
    if k <= 0:
        return df.limit(0)
    low = F.greatest(F.length(F.bin(by)) - 1 - _BITS, F.lit(0)).cast("int")
    coarse = F.call_function("shiftleft", F.call_function("shiftright", F.col(by), low), low)

    def histogram(rows: DataFrame, value: Column) -> DataFrame:
        return rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))

    found = _edge(histogram(df, coarse), k)
    if found is None:
        return df
    first, above = found
    inside = df.where(coarse == first)
    cut, more = _edge(histogram(inside, F.col(by)), k - above)
    tied = dense_number(df.where(F.col(by) == cut), ties, _AT).where(F.col(_AT) < k - above - more)
    return df.where(F.col(by) > cut).unionByName(tied.drop(_AT))
