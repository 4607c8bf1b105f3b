"""Eight-digit, four-level commodity codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..columns import LEVELS

# Zero pairs that end a code, and the shape of a legal code.
TRAILING_ZERO_PAIRS = r"0{2}\b|0{4}\b|0{6}\b"
LEGAL_CODE = r"^(?!0{8})\d{8}$"

CODE_DIGITS = 8
CONFIDENCE_TYPE = "decimal(6,5)"


def width(level: int) -> int:
    """Digits of a code down to ``level`` (1 = segment .. 4 = commodity)."""
    return 2 * level


def strip_zero_pairs(code: Column) -> Column:
    """Code without its unused lower levels; NULL gives ``'0'``."""
    return F.regexp_replace(F.coalesce(code, F.lit("0")), TRAILING_ZERO_PAIRS, "")


def prefix(code: Column, level: int) -> Column:
    return F.substring(code, 1, width(level))


def digit_pairs(code: Column) -> dict[str, Column]:
    """The four two-digit parts by level name."""
    return {name: F.substring(code, width(n) + 1, 2) for n, name in enumerate(LEVELS)}


def levels_if(code: Column, accepted: Column, target: str = "AN_UNSPSC_{}") -> dict[str, Column]:
    """Code prefixes per level where ``accepted``, else ``'0'`` at every level."""
    return {target.format(name): F.when(accepted, prefix(code, n)).otherwise("0")
            for n, name in enumerate(LEVELS, start=1)}


def upper_levels(code: Column, target: str = "FINAL_REPORT_UNSPSC_{}") -> dict[str, Column]:
    """Prefixes for segment, family and class; NULL for a NULL code."""
    return {target.format(name): prefix(code, n)
            for n, name in enumerate(LEVELS[:-1], start=1)}


def deepest_level(label: Column) -> Column:
    """How many levels a predicted label specifies (trailing zeros specify none)."""
    return F.ceil(F.length(F.rtrim(label, F.lit("0"))) / 2).cast("int")


def level_code(label: Column, level: int) -> Column:
    """Label down to ``level``; NULL when nothing but zeros follows from the
    level's own digits on."""
    open_digits = CODE_DIGITS + 2 - width(level)
    unspecified = F.right(label, F.lit(open_digits)) == "0" * open_digits
    return F.when(~unspecified, prefix(label, level))


def level_confidence(label: Column, probability: Column, level: int) -> Column:
    """The prediction's probability on levels the label specifies, else NULL."""
    return F.when(deepest_level(label) >= level, probability).cast(CONFIDENCE_TYPE)


def prediction_levels(label: Column, probability: Column,
                      names: Mapping[str, str] | None = None) -> dict[str, Column]:
    """The eight code and confidence columns of one prediction.

    ``names`` renames report columns (``UNSPSC_*``, ``CONFIDENCE_*``), for
    example with :data:`spendweave.columns.REPORT_TO_OWN`.
    """
    levels = list(enumerate(LEVELS, start=1))
    wide = {f"UNSPSC_{name}": level_code(label, n) for n, name in levels}
    wide |= {f"CONFIDENCE_{name}": level_confidence(label, probability, n) for n, name in levels}
    return {(names or {}).get(name, name): column for name, column in wide.items()}
