"""Exact-size samples and splits without a global sort.

Rows are ordered by a seeded hash of the chosen columns, then by a hash of the whole
row. Histograms find the place of a cut step by step: the prefix of the first hash,
within that prefix the hash itself (which many rows share if the columns repeat), and
within that hash the prefix of the second one. Rows elsewhere pass a filter; only what
agrees in all three is ordered, after equal rows have been folded into one with a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_BUCKET, _HASH, _ROW, _TAKE = "__bucket", "__hash", "__row", "__take"
_DIGITS = 5          # 16**5, about a million buckets


def _digest(seed: int, columns: Sequence[str]) -> Column:
    """A uniform, seeded hash: an MD5 any SQL engine can repeat."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *fields))


def _hashed(df: DataFrame, seed: int, by: Sequence[str] | None) -> DataFrame:
    """The rows with their hashes, written once: all passes see the same rows."""
    first, row = _digest(seed, by or df.columns), _digest(seed, df.columns)
    return materialize(df.withColumns({
        _BUCKET: F.substring(first, 1, _DIGITS), _HASH: first,
        _ROW: F.substring(row, 1, _DIGITS)}), "hashed")


def _edge(rows: DataFrame, level: str, wanted: Column) -> tuple[Column, Column]:
    """The value of ``level`` that the cut after ``wanted`` rows falls into, and how
    many rows of that value lie before it; one row, written for the passes that follow."""
    histogram = rows.groupBy(level).agg(F.count(F.lit(1)).alias("n"))
    totals = histogram.withColumns({
        "upto": F.sum("n").over(Window.orderBy(level)),
        "all": F.sum("n").over(Window.partitionBy())})
    first = totals.where(F.col("upto") > wanted).agg(
        F.min(F.struct(level, (wanted - F.col("upto") + F.col("n")).alias("missing"))).alias("e"))
    edge = materialize(first.select(
        # no such value: all rows lie before the cut ('g' follows every hex digit)
        F.coalesce(f"e.{level}", F.lit("g")).alias("value"), F.col("e.missing")), "cut")
    return edge.select("value").scalar(), edge.select("missing").scalar()


def _cut(hashed: DataFrame, wanted: Column) -> tuple[Column, Column, Column]:
    """Conditions for the rows before the cut and for those that it may divide, and how
    many of the latter lie before it."""
    before, here, missing = F.lit(False), F.lit(True), wanted
    for level in (_BUCKET, _HASH, _ROW):
        value, missing = _edge(hashed.where(here), level, missing)
        before = before | (here & (F.col(level) < value))
        here = here & (F.col(level) == value)
    return before, here, missing


def _divided(hashed: DataFrame, here: Column, missing: Column,
             columns: Sequence[str]) -> DataFrame:
    """The rows at the edge, equal ones folded into one with its count ``n``, and how
    many of the ``n`` lie before the cut."""
    folded = (hashed.where(here).groupBy(*hashed.columns).agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(Window.orderBy(*columns))
    room = F.greatest(F.lit(0), missing - (upto - F.col("n")))
    return folded.withColumn(_TAKE, F.least(F.col("n"), room))


def _unfolded(frame: DataFrame, copies: Column, columns: Sequence[str]) -> DataFrame:
    counted = frame.withColumn("__copies", copies.cast("int")).where("__copies > 0")
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))
                              ).select(*columns)


def sample_rows(df: DataFrame, n: int, seed: int = 42,
                by: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer), the same for any
    partitioning. ``by`` names the columns that seed the order (default: all)."""
    hashed = _hashed(df, seed, by)
    before, here, missing = _cut(hashed, F.lit(n).cast("bigint"))
    return hashed.where(before).select(*df.columns).unionByName(
        _unfolded(_divided(hashed, here, missing, df.columns), F.col(_TAKE), df.columns))


def sample_with_replacement(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` draws with replacement.

    Independent draws at a rate six standard deviations above ``n`` are written
    with a random order, and cut to size by that order.
    """
    total = df.count()
    if not total:
        return df
    rate = (n + 6 * n ** 0.5 + 20) / total
    draws = df.sample(withReplacement=True, fraction=rate, seed=seed)
    draws = materialize(draws.withColumn("__draw", F.rand(seed)), "draws")
    return sample_rows(draws, n, seed, ["__draw"]).drop("__draw")


def split_tail(df: DataFrame, share: float, seed: int = 42,
               by: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows; validation is the last ``int(rows * share)``
    in seeded order. A share that rounds to no rows leaves validation empty."""
    hashed = _hashed(df, seed, by)
    wanted = F.col("all") - F.floor(F.col("all") * F.lit(share)).cast("bigint")
    before, here, missing = _cut(hashed, wanted)
    divided = materialize(_divided(hashed, here, missing, df.columns), "edge")
    training = hashed.where(before).select(*df.columns).unionByName(
        _unfolded(divided, F.col(_TAKE), df.columns))
    validation = hashed.where(~(before | here)).select(*df.columns).unionByName(
        _unfolded(divided, F.col("n") - F.col(_TAKE), df.columns))
    return training, validation
