"""Monthly network totals from facts and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import CREATED, NETWORK_GROUP, NETWORK_KEY, UPDATED
from ..operators.network import add_states, item_state, network_lines, network_totals, totals_of
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window
from ..sources.tables import replace_partitions
from .by_month import MONTH, with_month, write_by_month


def batch_facts(fact: DataFrame, start: Moment, end: Moment,
                whole_months: bool = False) -> DataFrame:
    """Facts by document date, without blanket orders. ``whole_months`` widens
    the window to full months, so that no month is overwritten by a part of it."""
    if whole_months:
        if start is not None:
            start = F.date_trunc("month", F.lit(start).cast("timestamp"))
        end = (F.date_trunc("month", F.lit(end).cast("timestamp"))
               + F.expr("interval 1 month") - F.expr("interval 1 microsecond"))
    return in_window(fact, start, end, column="DOCUMENT_DATE").where("IS_BLANKET = 0")


def batch(fact: DataFrame, dimension: DataFrame, start: Moment | None, end: Moment,
          whole_months: bool = False) -> DataFrame:
    """Totals of a window."""
    return network_totals(batch_facts(fact, start, end, whole_months), dimension)


def merge(totals: DataFrame, fresh: DataFrame, null_safe: bool = False,
          now: Column | None = None) -> DataFrame:
    # several groups may share the update key (it leaves out the upper levels)
    return upsert(totals, fresh, NETWORK_KEY, null_safe=null_safe, now=now)


def run(fact: DataFrame, dimension: DataFrame, totals: DataFrame, start: Moment, end: Moment,
        whole_months: bool = False, null_safe: bool = False,
        now: Column | None = None) -> DataFrame:
    """Totals with the batch's months merged in.

    By default a NULL in the key matches nothing, so such a group is inserted
    again by every run; ``null_safe`` updates it instead.
    """
    fresh = materialize(batch(fact, dimension, start, end, whole_months), "network")
    return merge(totals, fresh, null_safe, now)


# -- incremental totals ------------------------------------------------------------------------
#
# A table of lines and sums by group, order and item, partitioned by document month, is changed
# by what a batch changes; totals are computed anew for the groups that it touches only.

_GROUP = "__group"


def fact_deltas(before: DataFrame, after: DataFrame, dimension: DataFrame,
                old_dimension: DataFrame | None = None) -> DataFrame:
    """Signed lines of facts as they were counted (``before``: changed and removed ones) and as
    they are now (``after``: changed and late ones). A product whose code has changed makes its
    facts changed ones: pass the products as they were as ``old_dimension``."""
    def lines(facts: DataFrame, products: DataFrame, sign: int) -> DataFrame:
        return network_lines(facts.where("IS_BLANKET = 0"), products).withColumn("SIGN", F.lit(sign))

    return lines(before, old_dimension or dimension, -1).unionByName(lines(after, dimension, 1))


def start_state(fact: DataFrame, dimension: DataFrame, path: str) -> DataFrame:
    """Write the state of all facts; their totals."""
    state = item_state(network_lines(fact.where("IS_BLANKET = 0"), dimension))
    write_by_month(state, path)
    return totals_of(fact.sparkSession.read.parquet(path))


def _with_group(df: DataFrame) -> DataFrame:
    # groups that share a hash are refreshed together, which does no harm
    return df.withColumn(_GROUP, F.xxhash64(*NETWORK_GROUP))


def update_totals(path: str, totals: DataFrame, deltas: DataFrame, now: Column | None = None) -> tuple[DataFrame, int]:
    """The totals after ``deltas`` have been added to the state at ``path``, and the number of
    months rewritten there.

    The batch is aggregated by item first. Only its months are read and rewritten, only its
    groups are added up again; they replace their rows in ``totals`` (a group without lines
    has none) and keep their time of creation.
    """
    spark = totals.sparkSession
    change = materialize(with_month(item_state(deltas, "SIGN")), "network-deltas")
    groups = materialize(_with_group(change).select(_GROUP, MONTH).distinct(), "network-groups")
    months = replace_partitions(spark, path, change, [MONTH], lambda state, batch: with_month(
        add_states(state.drop(MONTH), batch.drop(MONTH))))
    touched = [row[0] for row in groups.select(MONTH).distinct().collect()]
    here = F.col(MONTH).isin([m for m in touched if m is not None])
    state = spark.read.parquet(path).where(here | F.col(MONTH).isNull() if None in touched else here)
    keys = groups.select(_GROUP).distinct()
    fresh = totals_of(_with_group(state).join(keys, _GROUP, "left_semi"))
    moment = F.current_timestamp() if now is None else now
    marked = _with_group(totals)
    old = marked.join(keys, _GROUP, "left_semi").alias("old")
    fresh = _with_group(fresh).alias("fresh")
    same = F.col(f"fresh.{_GROUP}") == F.col(f"old.{_GROUP}")
    for name in NETWORK_GROUP:
        same = same & F.col(f"fresh.{name}").eqNullSafe(F.col(f"old.{name}"))
    values = [c for c in totals.columns if c not in (CREATED, UPDATED)]
    replaced = fresh.join(old, same, "left").select(
        *[F.col(f"fresh.{c}") for c in values],
        F.coalesce(F.col(f"old.{CREATED}"), moment).cast("timestamp").alias(CREATED), moment.cast("timestamp").alias(UPDATED))
    kept = marked.join(keys, _GROUP, "left_anti").drop(_GROUP)
    return kept.unionByName(replaced), months
