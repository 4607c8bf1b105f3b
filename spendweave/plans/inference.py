"""Predictions for new items: stored ones where the text is known, else scored."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import codes
from ..functions.measures import run_moment
from ..operators.clean import Cleaning, clean_items
from ..operators.joins import anti_filter
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window
from .features import SCORING_CLEANING, with_feature

#: Feature frame (CONCAT_FEATURE) -> the same rows with ``predicted_label`` and
#: ``predicted_label_proba``.
Scorer = Callable[[DataFrame], DataFrame]


def python_scorer(model_fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Scorer:
    """Scorer from a function over Arrow batches, for models outside Spark ML."""
    schema = f"{C.FEATURE} string, predicted_label string, predicted_label_proba double"
    return lambda features: features.select(C.FEATURE).mapInPandas(model_fn, schema)


def feature_rows(items: DataFrame, start: Moment, end: Moment,
                 cleaning: Cleaning = SCORING_CLEANING, scanned: bool = False) -> DataFrame:
    """ID and feature text of the batch's cleaned items; ``scanned`` items may be read twice."""
    return with_feature(clean_items(in_window(items, start, end), cleaning, scanned=scanned)).select("ID", C.FEATURE)


def new_answers(features: DataFrame, stored: DataFrame, scorer: Scorer, model_id: str,
                now: Column | None = None) -> DataFrame:
    """Report rows for texts without a stored answer. Each text is scored once,
    however many items share it."""
    moment = run_moment(now)
    unknown = anti_filter(features.select(C.FEATURE).distinct(), stored, C.FEATURE)
    scored = scorer(unknown)
    levels = codes.prediction_levels(F.col("predicted_label"), F.col("predicted_label_proba"))
    return scored.select(C.FEATURE, *[column.alias(name) for name, column in levels.items()],
                         moment.cast("timestamp").alias("REPORT_LASTUPDATED_AT"),
                         F.lit(model_id).alias("MODEL_UUID"))


def updates_of(features: DataFrame, answers: DataFrame) -> DataFrame:
    """Predictions of the batch's items, in item columns."""
    return (features.join(answers, C.FEATURE).withColumnsRenamed(C.REPORT_TO_OWN)
            .select(*C.OWN_PREDICTION))


def batch(items: DataFrame, report: DataFrame, scorer: Scorer, model_id: str, start: Moment, end: Moment,
          cleaning: Cleaning = SCORING_CLEANING, now: Column | None = None) -> DataFrame:
    """Predictions of the window's items, stored ones and new ones."""
    features = materialize(feature_rows(items, start, end, cleaning, scanned=True), "features")
    stored = report.where(F.col("MODEL_UUID") == model_id).drop(*C.AUDIT)
    fresh = materialize(new_answers(features, stored, scorer, model_id, run_moment(now)), "scores")
    return updates_of(features, stored.unionByName(fresh))


def merge(items: DataFrame, updates: DataFrame, now: Column | None = None, scanned: bool = False) -> DataFrame:
    return upsert(items, updates, "ID", insert=False, now=now, scanned=scanned,
                  when="target.MODEL_UUID IS NULL OR source.MODEL_UUID <> target.MODEL_UUID")


def run(items: DataFrame, report: DataFrame, scorer: Scorer, model_id: str, start: Moment,
        end: Moment, cleaning: Cleaning = SCORING_CLEANING,
        now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Item table and prediction report with the batch merged in.

    Scores are written before the two merges read them, so the model runs once. The items should
    be read from files: they are read twice by the cleaning and twice by the merge.
    """
    moment = run_moment(now)
    features = materialize(feature_rows(items, start, end, cleaning, scanned=True), "features")
    stored = report.where(F.col("MODEL_UUID") == model_id).drop(*C.AUDIT)
    fresh = materialize(new_answers(features, stored, scorer, model_id, moment), "scores")
    answers = stored.unionByName(fresh)
    merged_items = merge(items, materialize(updates_of(features, answers), "predictions"), moment, scanned=True)
    merged_report = upsert(report, fresh, [C.FEATURE, "MODEL_UUID"], unique=True, now=moment)
    return merged_items, merged_report
