"""Classification quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Support-weighted precision, recall and F1, rounded to three digits; a row for each
    value of the columns ``by``.

    Rows are first reduced to the confusion counts; a class that is never
    predicted has precision 0.
    """
    confusion = df.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))
    sides = confusion.select(*by, F.inline(F.array(
        F.struct(F.col(label).cast("string").alias("class"),
                 F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("hits"),
                 F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col(prediction).cast("string").alias("class"),
                 F.lit(0).cast("bigint").alias("hits"),
                 F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted")))))
    per_class = sides.groupBy(*by, "class").agg(*[F.sum(name).alias(name)
                                             for name in ("hits", "actual", "predicted")])
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("hits") / F.col("actual")).otherwise(0.0)
    f1 = F.when(F.col("hits") > 0,
                2 * F.col("hits") / (F.col("actual") + F.col("predicted"))).otherwise(0.0)

    def weighted(score, name: str):
        return F.round(F.sum(score * F.col("actual")) / F.sum("actual"), 3).alias(name)

    return per_class.groupBy(*by).agg(weighted(precision, "precision"), weighted(recall, "recall"),
                         weighted(f1, "f1"), F.sum("actual").alias("rows"))
