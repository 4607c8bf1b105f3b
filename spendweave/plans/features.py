"""Feature text for the model, and the training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions.text import concat_features
from ..operators.clean import Cleaning, clean_items, legal_codes

# Cleaning instructions that stored models and training tables were made with.
_NA_TEXT = {
    "columns": list(C.TEXT_COLUMNS),
    "na_vals_list": list(C.NA_SPELLINGS),
    "replacement_val": C.NA,
    "na_filter_instructions": {"not_contains_char_filter": {"DESCRIPTION": C.NA,
                                                            "PO_ITEM_ID": C.NA}},
}
_MISSING = {
    "drop_na_instructions": {"drop_rows": True,
                             "dropna_config": {"subset": ["PO_ITEM_ID", "DESCRIPTION"],
                                               "how": "any"}},
    "fill_na_instructions": {"fill_missing_val": True,
                             "fillna_config": {"value": C.NA,
                                               "subset": ["SUPPLIER_ORG", "BUYER_ORG",
                                                          "SUPPLIER_PART", "MANUFACTURER_PART",
                                                          "MANUFACTURER_NAME", "ITEM_TYPE",
                                                          "IS_ADHOC"]}},
}

#: Cleaning of the training table: one row per line, then per distinct content.
TRAINING_CLEANING = Cleaning(
    select_cols_instructions={"select": [*C.TEXT_COLUMNS, "CODE", *C.LEVELS]},
    handle_str_na_vals=_NA_TEXT,
    drop_duplicates_instructions={
        "index_col": ["PO_ITEM_ID"],
        "cat_cols": [name for name in C.TEXT_COLUMNS if name != "PO_ITEM_ID"] + ["CODE"]},
    handle_missing_vals=_MISSING)

#: Cleaning before scoring: only repeated rows are dropped, every item is scored.
SCORING_CLEANING = Cleaning(
    select_cols_instructions={"select": ["ID", *C.TEXT_COLUMNS]},
    handle_str_na_vals=_NA_TEXT,
    drop_duplicates_instructions={"index_col": [], "cat_cols": []},
    handle_missing_vals=_MISSING)


def training_table(rows: DataFrame, reference: DataFrame | None = None,
                   cleaning: Cleaning = TRAINING_CLEANING,
                   order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Cleaned rows with a legal code."""
    return clean_items(legal_codes(rows, reference), cleaning, order_by)


def with_feature(df: DataFrame, parts: Sequence[str] = C.FEATURE_PARTS,
                 name: str = C.FEATURE) -> DataFrame:
    """Add the concatenated feature text."""
    return df.withColumn(name, concat_features(*parts))


def feature_and_label(df: DataFrame, label: str = "CODE",
                      parts: Sequence[str] = C.FEATURE_PARTS, keep: Sequence[str] = ()) -> DataFrame:
    """Only the feature text and the label (and ``keep``)."""
    return df.select(*keep, concat_features(*parts).alias(C.FEATURE), F.col(label))
