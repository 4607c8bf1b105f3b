"""Filters, renames and missing-value handling driven by instructions.

Instruction keys are those of the existing YAML files, so a parsed file can be
passed on unchanged.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..columns import NA
from ..functions import codes
from .dedup import distinct_rows, keep_first
from .joins import counted_keys, semi_filter


# -- predicates ----------------------------------------------------------------

def _matches(name: str, wanted: Any) -> Column:
    column = F.col(name)
    if wanted is None:
        return column.isNull()
    if isinstance(wanted, (list, tuple)):
        return column.isin(list(wanted))
    if wanted == "NOT NULL":
        return column.isNotNull()
    return column == F.lit(str(wanted))


def _excluded(name: str, unwanted: Any) -> Column | None:
    # only a list excludes; a scalar is ignored
    return ~F.col(name).isin(unwanted) if isinstance(unwanted, list) else None


#: Instruction key -> predicate for one column.
PREDICATES = {
    "filter": _matches,
    "regex_pattern_filter": lambda name, pattern: F.col(name).rlike(pattern),
    "ne_filter": _excluded,
    "contains_char_filter": lambda name, part: F.col(name).contains(part),
    "not_contains_char_filter": lambda name, part: ~F.col(name).contains(part),
}


def predicate(instructions: Mapping[str, Any]) -> Column | None:
    """All row conditions of ``instructions`` as one column, or None."""
    parts = [build(name, value)
             for key, build in PREDICATES.items()
             for name, value in (instructions.get(key) or {}).items()]
    parts = [part for part in parts if part is not None]
    return reduce(lambda left, right: left & right, parts) if parts else None


def transform(df: DataFrame, instructions: Mapping[str, Any]) -> DataFrame:
    """Filter, then sort, rename and select; absent keys are skipped.

    All conditions go into one ``where``, so that they reach the scan together.
    """
    condition = predicate(instructions)
    if condition is not None:
        df = df.where(condition)
    if order := instructions.get("sort_values"):
        df = df.sort(order["sort_columns"], ascending=order["is_ascending"])
    if renames := instructions.get("rename"):
        df = df.withColumnsRenamed(renames)
    if columns := instructions.get("select"):
        df = df.select(*columns)
    return df


# -- columns --------------------------------------------------------------------

def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{prefix}_{name}" for name in df.columns})


def union_all(*frames: DataFrame, distinct: bool = True, scanned: bool = False) -> DataFrame:
    """Union by column name, without repeated rows unless told otherwise. ``scanned``: the
    frames are read from files, and may be read twice."""
    union = reduce(lambda left, right: left.unionByName(right), frames)
    if not distinct:
        return union
    return distinct_rows(union) if scanned else union.distinct()


def align(df: DataFrame, target_schema, stamp: Mapping[str, Column] | None = None) -> DataFrame:
    """Exactly the target's columns, in its order and types.

    Columns the frame lacks become typed NULLs; ``stamp`` sets columns such as
    the audit timestamps.
    """
    stamp = stamp or {}

    def source(name: str) -> Column:
        if name in stamp:
            return stamp[name]
        return F.col(name) if name in df.columns else F.lit(None)

    return df.select(*[source(field.name).cast(field.dataType).alias(field.name)
                       for field in target_schema.fields])


# -- missing values ----------------------------------------------------------------

def unify_na(df: DataFrame, columns: str | Sequence[str], spellings: Iterable[str],
             replacement: str = NA) -> DataFrame:
    """One spelling for "not available"; NULL counts as ``N/A``.

    Columns become strings: with ANSI casts a number cannot be compared with
    the spellings.
    """
    spellings = list(spellings)

    def unified(name: str) -> Column:
        value = F.coalesce(F.col(name).cast("string"), F.lit(NA))
        return F.when(value.isin(spellings), replacement).otherwise(value)

    names = [columns] if isinstance(columns, str) else columns
    return df.withColumns({name: unified(name) for name in names})


def unify_and_filter_na(df: DataFrame, instructions: Mapping[str, Any]) -> DataFrame:
    unified = unify_na(df, instructions["columns"], instructions["na_vals_list"],
                       instructions["replacement_val"])
    return transform(unified, instructions.get("na_filter_instructions") or {})


def drop_missing(df: DataFrame, config: Mapping[str, Any] | None = None) -> DataFrame:
    return df.dropna(**(config or {}))


def fill_missing(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    return df.fillna(**config)


# -- composite cleaning ---------------------------------------------------------------

@dataclass(frozen=True)
class Cleaning:
    """Instructions of the item cleaning, named as in the YAML files."""

    select_cols_instructions: Mapping[str, Any] = field(default_factory=dict)
    handle_str_na_vals: Mapping[str, Any] = field(default_factory=dict)
    drop_duplicates_instructions: Mapping[str, Any] = field(default_factory=dict)
    handle_missing_vals: Mapping[str, Any] = field(default_factory=dict)


def drop_duplicates(df: DataFrame, instructions: Mapping[str, Any],
                    order_by: Sequence[str | Column] = (), scanned: bool = False) -> DataFrame:
    """First one row per index value, then one per combination of categories. ``scanned``: the
    rows are read from files, and may be read twice."""
    if scanned and not instructions.get("index_col") and not instructions.get("cat_cols"):
        return distinct_rows(df)
    once = keep_first(df, instructions.get("index_col") or (), order_by)
    return keep_first(once, instructions.get("cat_cols") or (), order_by)


def clean_items(df: DataFrame, config: Cleaning, order_by: Sequence[str | Column] = (),
                counts: Mapping[str, Observation] | None = None, scanned: bool = False) -> DataFrame:
    """Select, unify and filter NA, de-duplicate, drop and fill missing values.

    ``counts`` maps a step (``selected``, ``na_filtered``, ``deduplicated``,
    ``missing_dropped``) to an Observation; the counts are collected by the job
    that consumes the result, not by extra jobs. ``scanned`` frames may be read twice
    (not if they are counted).
    """
    counts = counts or {}

    def counted(frame: DataFrame, step: str) -> DataFrame:
        return count_rows(frame, counts[step]) if step in counts else frame

    df = counted(transform(df, config.select_cols_instructions), "selected")
    if config.handle_str_na_vals:
        df = unify_and_filter_na(df, config.handle_str_na_vals)
    df = counted(df, "na_filtered")
    df = counted(drop_duplicates(df, config.drop_duplicates_instructions, order_by, scanned and not counts),
                 "deduplicated")
    dropping = config.handle_missing_vals.get("drop_na_instructions") or {}
    if dropping.get("drop_rows"):
        df = drop_missing(df, dropping.get("dropna_config"))
    df = counted(df, "missing_dropped")
    filling = config.handle_missing_vals.get("fill_na_instructions") or {}
    if filling.get("fill_missing_val"):
        df = fill_missing(df, filling["fillna_config"])
    return df


def count_rows(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows on the way, as metric ``rows`` of ``observation``."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


# -- legal codes ---------------------------------------------------------------------

#: Instructions that keep complete codes with a real segment,
#: family and class.
LEGAL_CODES = {
    "unspsc_col": "CODE",
    "length_filter": {"regex_pattern_filter": {"CODE": codes.LEGAL_CODE}},
    "non_zero_filter": {"not_contains_char_filter": {"SEGMENT": "00", "FAMILY": "00",
                                                     "CLASS": "00"}},
}


def legal_codes(df: DataFrame, reference: DataFrame | None = None,
                instructions: Mapping[str, Any] = LEGAL_CODES) -> DataFrame:
    """Rows with a legal code, split into its four digit pairs; optionally only
    codes found in ``reference``."""
    name = instructions["unspsc_col"]
    legal = transform(df, instructions.get("length_filter") or {}).dropna(subset=[name])
    split = legal.withColumns(codes.digit_pairs(F.col(name)))
    split = transform(split, instructions.get("non_zero_filter") or {})
    if reference is None:
        return split
    return semi_filter(split, counted_keys(reference, name), name, name)
