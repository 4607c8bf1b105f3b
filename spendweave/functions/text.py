"""Item descriptions and feature text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a word in an item description, and in the
# text the model sees (the tokenizer also ends words at tab and newline).
DESCRIPTION_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TOKEN_PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'

# Rating thresholds.
POOR_BELOW = 3
GOOD_ABOVE = 15


def _words(text: Column, punctuation: str = "") -> Column:
    """Pieces between single blanks or punctuation marks, empty ones included."""
    return F.split(text, f"[ {re.escape(punctuation)}]" if punctuation else " ")


def distinct_words(text: Column) -> Column:
    """Words of ``text`` split at single blanks, each kept where it first occurs."""
    return F.array_distinct(_words(text))


def clean_description(text: Column) -> Column:
    """Lower-cased text without punctuation and repeated words; NULL gives ``''``."""
    words = F.array_distinct(_words(F.lower(text), DESCRIPTION_PUNCTUATION))
    return F.trim(F.concat_ws(" ", words))


def rate_description(cleaned: Column) -> Column:
    """``Poor`` / ``Acceptable`` / ``Good`` by the amount of text left.

    All three counts (letters and digits, letters, length) must pass a bound;
    letters are the smallest of them, so they decide for both bounds.
    """
    letters = F.length(F.regexp_replace(cleaned, "[^a-z]", ""))
    return (F.when(letters < POOR_BELOW, "Poor")
            .when(letters > GOOD_ABOVE, "Good")
            .otherwise("Acceptable"))


def concat_features(*names: str) -> Column:
    """One text column from several; NULLs are skipped."""
    return F.concat_ws(" ", *[F.col(name) for name in names])


def tokens(text: Column) -> Column:
    """Lower-cased words of a feature text, in order, with repeats."""
    return F.array_remove(_words(F.lower(text), TOKEN_PUNCTUATION), "")


def pad_ids(ids: Column, length: int) -> Column:
    """Exactly ``length`` ids: the last ones are kept, zeros follow at the end."""
    kept = F.when(F.size(ids) > length, F.slice(ids, -length, length)).otherwise(ids)
    return F.concat(kept, F.array_repeat(F.lit(0), F.lit(length) - F.size(kept)))
