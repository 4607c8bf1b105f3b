"""Training features, a distributed text classifier, and its quality."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import codes, text
from ..operators import bayes, labels, sampling, vocabulary
from ..operators.bayes import SparseBayes
from ..operators.metrics import class_metrics
from ..session import materialize
from .features import feature_and_label


@dataclass(frozen=True)
class TrainingOptions:
    """Defaults of the training configuration."""

    label: str = "CODE"
    imbalance: str | None = "filter"
    threshold: int = 262
    replacement: str = "99999999"
    sample: int | None = 800_000
    seed: int = 42
    num_words: int = 20_001
    text_length: int = 300
    validation_share: float = 0.1
    #: ``naive_bayes`` among all labels, ``top_down`` level by level (both with weights in
    #: tables), or ``logistic_regression`` (a Spark ML model with a matrix on the driver)
    classifier: str = "naive_bayes"
    #: digits of a code down to each level, for ``top_down``
    levels: tuple[int, ...] = tuple(map(codes.width, range(1, 5)))


def balanced_sample(table: DataFrame, options: TrainingOptions = TrainingOptions(),
                    parts: Sequence[str] = C.FEATURE_PARTS,
                    row_key: str = "PO_ITEM_ID") -> DataFrame:
    """Feature text and label of the rows to train on, written once: counting
    words, labels and rows all read it."""
    rows = feature_and_label(table, options.label, parts, keep=[row_key])
    balanced, _ = labels.balance(rows, options.label, options.imbalance, options.threshold,
                                 options.replacement)
    if options.sample is not None:
        balanced = sampling.sample_rows(balanced, options.sample, options.seed, [row_key])
    return materialize(balanced, "training-sample")


def training_features(rows: DataFrame, options: TrainingOptions = TrainingOptions(),
                      row_key: str = "PO_ITEM_ID") -> DataFrame:
    """Padded word ids and one-hot label of each row."""
    words = vocabulary.vocabulary(rows, C.FEATURE, row_key, options.num_words)
    ids = vocabulary.token_ids(rows, C.FEATURE, words, "ids")
    padded = ids.withColumn("ids", text.pad_ids(F.col("ids"), options.text_length))
    dictionary = labels.label_index(rows, options.label)
    indexed = labels.index_labels(padded, options.label, dictionary)
    return labels.one_hot(indexed, "label_index", "label_vector")


Model = SparseBayes | PipelineModel


def _regression(rows: DataFrame, options: TrainingOptions) -> PipelineModel:
    prepared = rows.withColumn("words", text.tokens(F.col(C.FEATURE)))
    stages = [StringIndexer(inputCol=options.label, outputCol="label_number",
                            stringOrderType="alphabetAsc", handleInvalid="skip"),
              CountVectorizer(inputCol="words", outputCol="word_counts",
                              vocabSize=options.num_words - 1),
              IDF(inputCol="word_counts", outputCol="weights"),
              LogisticRegression(maxIter=20, featuresCol="weights", labelCol="label_number",
                                 predictionCol="predicted", probabilityCol="probability",
                                 rawPredictionCol="raw")]
    return Pipeline(stages=stages).fit(prepared)


def fit_classifier(rows: DataFrame, options: TrainingOptions = TrainingOptions()) -> Model:
    """Word weights and a classifier over them.

    Naive Bayes needs one aggregation over the rows, whatever their number, and keeps its
    weights in tables; logistic regression iterates and is meant for few labels.
    """
    if options.classifier == "logistic_regression":
        return _regression(rows, options)
    if options.classifier not in ("naive_bayes", "top_down"):
        raise ValueError(f"unknown classifier {options.classifier!r}")
    levels = options.levels if options.classifier == "top_down" else ()
    return bayes.fit(rows, C.FEATURE, options.label, options.num_words, levels)


def score(model: Model, rows: DataFrame) -> DataFrame:
    """Rows with ``predicted_label`` and its probability."""
    if isinstance(model, SparseBayes):
        return bayes.predict(model, rows, C.FEATURE)
    # the label indexer is left out: rows to score have no label
    scored = rows.withColumn("words", text.tokens(F.col(C.FEATURE)))
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    number, probability = labels.predicted_class(vector_to_array(F.col("probability")))
    names = IndexToString(inputCol="predicted_number", outputCol="predicted_label",
                          labels=model.stages[0].labels)
    numbered = scored.withColumns({"predicted_number": number.cast("double"),
                                   "predicted_label_proba": probability})
    return names.transform(numbered).select(*rows.columns, "predicted_label",
                                            "predicted_label_proba")


def metrics_by_level(scored: DataFrame, label: str, levels: Sequence[int]) -> DataFrame:
    """``digits`` and the metrics of labels cut to so many digits, a row for each level. The
    rows are reduced to their confusion counts once."""
    each = scored.select(F.explode(F.array(*map(F.lit, levels))).alias("digits"), label, "predicted_label")
    cut = each.select("digits", *[F.expr(f"substr({name}, 1, digits)").alias(name)
                                  for name in (label, "predicted_label")])
    return class_metrics(cut, label, "predicted_label", by=["digits"])


def train(table: DataFrame, options: TrainingOptions = TrainingOptions(),
          parts: Sequence[str] = C.FEATURE_PARTS,
          row_key: str = "PO_ITEM_ID") -> tuple[Model, DataFrame]:
    """A fitted classifier and its metrics on the held-back rows, for ``top_down`` by level."""
    rows = balanced_sample(table, options, parts, row_key)
    fitting, held_back = sampling.split_tail(rows, options.validation_share, options.seed,
                                              [row_key])
    model = fit_classifier(materialize(fitting, "training-rows"), options)
    scored = score(model, held_back)
    if options.classifier == "top_down":
        return model, metrics_by_level(scored, options.label, options.levels)
    return model, class_metrics(scored, options.label, "predicted_label")
