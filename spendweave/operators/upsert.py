"""Update-or-insert as a DataFrame expression.

``upsert`` returns the table's new content; writing it is the caller's step
(:mod:`spendweave.sources.tables`). A key equal to NULL matches nothing, unless
asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import AUDIT, UPDATED
from ..session import materialize
from .clean import align
from .joins import key_filter, split_maybe

_HIT = "__hit"
_OLD = "__old"
_UPDATE = "__update"
#: Source rows up to which lookup joins are taken; such a source may be broadcast.
FEW_ROWS = 100_000

Keys = str | Sequence[str] | Mapping[str, str]


def _key_map(keys: Keys) -> dict[str, str]:
    """Target key -> source key."""
    if isinstance(keys, str):
        return {keys: keys}
    return dict(keys) if isinstance(keys, Mapping) else {key: key for key in keys}


def _all(conditions) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def require_unique(source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> None:
    """Fail if a key that can match occurs twice in ``source``.

    One aggregation over hashes of the keys, run at once, and only if one repeats another
    over the keys themselves; rows with a NULL key cannot match and are left out. A source
    that is costly to compute should have been written before.
    """
    matching = _all([F.lit(True)] if null_safe else [F.col(key).isNotNull() for key in keys])
    rows = source.select(*keys).where(matching)
    if rows.groupBy(F.xxhash64(*keys)).count().where("count > 1").isEmpty():
        return
    twice = rows.groupBy(*keys).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"several source rows for key {twice.asDict()}")


def _filters(target: DataFrame, source: DataFrame, pairs: Mapping[str, str], null_safe: bool) -> bool:
    """Whether a filter of the source's keys can spare target rows a shuffle: one key, of one
    type on both sides, and more rows than a lookup takes."""
    if null_safe or len(pairs) != 1:
        return False
    (left, right), = pairs.items()
    return target.schema[left].dataType == source.schema[right].dataType and source.count() > FEW_ROWS


def upsert(target: DataFrame, source: DataFrame, keys: Keys, *,
           when: str | Column | None = None,
           update: bool | Mapping[str, str | Column] = True,
           insert: bool = True,
           now: Column | None = None,
           null_safe: bool = False,
           unique: bool = False,
           merge_schema: bool = False,
           one_pass: bool | None = None,
           scanned: bool = False,
           keep_created: bool = True) -> DataFrame:
    """Rows of ``target`` with ``source`` merged in.

    keys          join columns; a mapping gives target name -> source name
    when          further condition for an update, over ``target.x``, ``source.x``
    update        True: every column the source has; a mapping: target column ->
                  expression over ``source.x``; False: leave matched rows alone
    insert        add source rows without a match
    now           timestamp for the audit columns (default: current time)
    null_safe     let NULL keys match each other
    unique        the source is known to hold each key once; skip the check
    merge_schema  add columns only the source has (NULL in untouched rows)
    one_pass      full outer join instead of lookup joins. Lookups never move the
                  target when the source is small enough to be broadcast; for
                  a larger one a pass over both is cheaper, for the target is
                  computed and moved once instead of twice. By default the
                  source's rows are counted (it should have been written).
    scanned       the target is read from files, and may be read twice: without ``insert``,
                  rows whose key a large source cannot have are then not moved
    keep_created  False: an update also takes the source's creation time
    """
    pairs = _key_map(keys)
    moment = F.current_timestamp() if now is None else now
    if not unique:
        require_unique(source, list(pairs.values()), null_safe)
    if merge_schema:
        fresh = [f for f in source.schema.fields if f.name not in target.columns]
        target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fresh})
    types = {f.name: f.dataType for f in target.schema.fields}

    def equal(left: str, right: str) -> Column:
        left_column, right_column = F.col(f"target.{left}"), F.col(f"source.{right}")
        return left_column.eqNullSafe(right_column) if null_safe else left_column == right_column

    match = _all([equal(left, right) for left, right in pairs.items()])

    def value(expression: str | Column) -> Column:
        return F.expr(expression) if isinstance(expression, str) else expression

    def from_source(name: str) -> Column:
        return F.col(f"source.{name}") if name in source.columns else F.lit(None)

    if isinstance(update, Mapping):
        changes = {name: value(expression) for name, expression in update.items()}
    elif update:
        frozen = set(AUDIT) if keep_created else {UPDATED}
        changes = {name: from_source(name) for name in target.columns
                   if name in source.columns and name not in frozen}
    else:
        changes = {}
    if changes and UPDATED in types:
        changes[UPDATED] = moment
    stamps = {name: moment for name in AUDIT}
    inserted = {name: stamps.get(name, from_source(name)) for name in target.columns}

    def typed(name: str, column: Column) -> Column:
        return column.cast(types[name]).alias(name)

    hit = F.col(f"source.{_HIT}").isNotNull()
    if when is not None:
        hit = hit & value(when)

    def merged(name: str) -> Column:
        # the condition is decided once per row, not once per column
        old = F.col(f"target.{name}")
        return F.when(F.col(_UPDATE), changes[name]).otherwise(old) if name in changes else old

    marked = source.withColumn(_HIT, F.lit(1)).alias("source")
    if insert and changes and one_pass is None:
        one_pass = source.select(*pairs.values()).count() > FEW_ROWS
    if one_pass and insert:
        both = target.withColumn(_OLD, F.lit(1)).alias("target").join(marked, match, "full_outer")
        absent = F.col(f"target.{_OLD}").isNull()
        return both.withColumn(_UPDATE, hit).select(*[
            typed(name, F.when(absent, inserted[name]).otherwise(merged(name)))
            for name in target.columns])

    updated = target
    if changes and scanned and not insert and _filters(target, source, pairs, null_safe):
        (left, right), = pairs.items()
        near, far = split_maybe(target, left, materialize(key_filter(source, right), "key-filter"))
        joined = near.alias("target").join(marked, match, "left").withColumn(_UPDATE, hit)
        updated = joined.select(*[typed(name, merged(name)) for name in target.columns]).unionByName(
            far.select(*[typed(name, F.col(name)) for name in target.columns]))
    elif changes:
        updated = (target.alias("target").join(marked, match, "left").withColumn(_UPDATE, hit)
                   .select(*[typed(name, merged(name)) for name in target.columns]))
    if not insert:
        return updated
    present = (target.select(*pairs).alias("target")
               .join(source.select(*pairs.values()).alias("source"), match, "left_semi")
               .alias("target"))
    added = (source.alias("source").join(present, match, "left_anti")
             .select(*[typed(name, inserted[name]) for name in target.columns]))
    return updated.unionByName(added)


def insert_absent(target: DataFrame, source: DataFrame, keys: Keys) -> DataFrame:
    """Add source rows whose key the target lacks, as they are; never update."""
    names = list(_key_map(keys))
    known = target.select(*names)
    return target.unionByName(source.join(known, names, "left_anti").select(*target.columns))


# -- row maintenance ---------------------------------------------------------------

def update_rows(df: DataFrame, assignments: Mapping[str, str | Column],
                where: str | Column | None = None) -> DataFrame:
    """Set columns in the rows a condition holds for."""
    condition = F.lit(True) if where is None else F.expr(where) if isinstance(where, str) else where
    types = {f.name: f.dataType for f in df.schema.fields}

    def assigned(name: str) -> Column:
        new = assignments[name]
        new = F.expr(new) if isinstance(new, str) else new
        return F.when(condition, new.cast(types[name])).otherwise(F.col(name))

    return df.select(*[assigned(name).alias(name) if name in assignments else F.col(name)
                       for name in df.columns])


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; columns they lack become NULL."""
    return df.unionByName(align(rows, df.schema))


def delete_rows(df: DataFrame, where: str | Column) -> DataFrame:
    """Rows a condition does not hold for (unknown counts as not holding)."""
    condition = F.expr(where) if isinstance(where, str) else where
    return df.where(~F.coalesce(condition, F.lit(False)))
