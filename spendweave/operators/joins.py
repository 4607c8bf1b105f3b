"""Joins of the plans.

Only keys that were counted are broadcast by hint. Of other sides Catalyst broadcasts a side whose size is known to
be under ``spark.sql.autoBroadcastJoinThreshold`` and joins by sort-merge
otherwise; adaptive execution then splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_SPREAD = "__spread"
#: Keys up to which they are broadcast (codes of some ten characters); they are counted first.
FEW_KEYS = 2_000_000
#: Bits of a key filter (16 MB at most), and those of one of its rows.
FILTER_BITS, ROW_BITS = 1 << 27, 1 << 15


def key_filter(keys: DataFrame, column: str) -> DataFrame:
    """``__row, __bits``: a bit set for the hash of every key, in rows of 4 KB. Its size is
    bounded whatever the number of keys, so it may be broadcast."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    places = keys.where(F.col(column).isNotNull()).select(
        F.floor(at / ROW_BITS).cast("int").alias("__row"), (at % ROW_BITS).alias("at"))
    # places are moved, not rows of bits of every task
    return places.repartition("__row").groupBy("__row").agg(F.bitmap_construct_agg("at").alias("__bits"))


def _is_set(column: str) -> tuple[Column, Column]:
    """The row of a key filter that a key belongs to, and whether its bit there is set."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    place = (at % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(at / ROW_BITS).cast("int"), F.call_function("shiftright", byte, place % 8).bitwiseAND(F.lit(1)) == 1


def maybe_in(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be among those of a :func:`key_filter` of the same type: all
    that are, and of the others those whose hash meets one. To be followed by a join, which
    then moves few rows in vain."""
    row, is_set = _is_set(column)
    found = df.join(F.broadcast(bits), row == F.col("__row"))
    # the key is taken from both sides, lest a join on it goes below this one
    return found.where(is_set).select(*[F.when(is_set, F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns])


def split_maybe(df: DataFrame, column: str, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key may be among those of a :func:`key_filter` of the same type, and
    all others, those without a key among them. ``df`` is read for each."""
    row, is_set = _is_set(column)
    found = df.join(F.broadcast(bits), (row == F.col("__row")) & F.col(column).isNotNull(), "left")
    near = F.coalesce(is_set, F.lit(False))
    # the key of the near rows is taken from both sides, lest a join on it goes below this one
    return (found.where(near).select(*[F.when(near, F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns]),
            found.where(~near).select(*df.columns))


def counted_keys(keys: DataFrame, column: str) -> DataFrame:
    """The distinct keys of ``column``, to be broadcast if they are few enough; they are counted
    first."""
    known = materialize(keys.select(column).where(F.col(column).isNotNull()).distinct(), "keys")
    return F.broadcast(known) if known.count() <= FEW_KEYS else known


def semi_filter(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    keys = right.select(F.col(right_on).alias("__key"))
    return left.join(keys, left[left_on] == keys["__key"], "left_semi")


def anti_filter(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(right.select(*keys), keys, "left_anti")


def left_lookup(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                spread: int = 256) -> DataFrame:
    """Left join that keeps rows with a NULL key from meeting in one task.

    NULL keys match nothing, yet all hash to one shuffle partition. They get a
    second join key taken from the row itself; rows with a key get 0, as does
    the right side.
    """
    others = [name for name in left.columns if name != left_on]
    scatter = F.when(left[left_on].isNull(),
                     F.pmod(F.xxhash64(*others), F.lit(spread)) + 1).otherwise(0)
    probe = left.withColumn(f"{_SPREAD}_l", scatter.cast("int"))
    build = (right.withColumnRenamed(right_on, "__key")
             .withColumn(f"{_SPREAD}_r", F.lit(0)))
    matches = ((probe[left_on] == build["__key"])
               & (probe[f"{_SPREAD}_l"] == build[f"{_SPREAD}_r"]))
    return probe.join(build, matches, "left").drop("__key", f"{_SPREAD}_l", f"{_SPREAD}_r")


def split_known(df: DataFrame, report: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a stored answer in ``report`` (joined to it), and the others."""
    return df.join(report, key, "inner"), anti_filter(df, report, key)
