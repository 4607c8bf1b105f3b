"""Labels: counts, rare values, index and one-hot form."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import NA
from ..session import materialize
from .numbering import dense_number


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc_nulls_first("count"), F.asc(column)))


def rare_values(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Values on fewer than ``threshold`` rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.where(F.col("__rows") < threshold).select(column)


def replace_rare(df: DataFrame, column: str, threshold: int,
                 replacement: str) -> tuple[DataFrame, DataFrame]:
    """One label for all rare ones, and the list of rare ones. NULL becomes ``N/A``.

    The list is written once, so that its measured size decides how it is
    joined; a list too long to broadcast is joined by sort-merge.
    """
    rare = materialize(rare_values(df, column, threshold), "rare-labels")
    lookup = rare.select(F.col(column).alias("__rare")).where(F.col("__rare").isNotNull())
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit(NA)))
    joined = filled.join(lookup, filled[column] == lookup["__rare"], "left")
    label = F.when(F.col("__rare").isNotNull(), F.lit(replacement)).otherwise(F.col(column))
    return joined.withColumn(column, label).drop("__rare"), rare


def keep_frequent(df: DataFrame, column: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose label is on at least ``threshold`` rows, and the rare labels.

    Rows without a label drop out.
    """
    counts = materialize(df.groupBy(column).agg(F.count(F.lit(1)).alias("__rows")), "label-counts")
    frequent = counts.where(F.col("__rows") >= threshold).select(column)
    rare = counts.where(F.col("__rows") < threshold).select(column)
    return df.join(frequent, column, "left_semi"), rare


def balance(df: DataFrame, column: str, how: str | None, threshold: int,
            replacement: str = "99999999") -> tuple[DataFrame, DataFrame | None]:
    """Treat rare labels: ``replace``, ``filter``, anything else leaves them."""
    if how == "replace":
        return replace_rare(df, column, threshold, replacement)
    if how == "filter":
        return keep_frequent(df, column, threshold)
    return df, None


def label_index(df: DataFrame, column: str, index: str = "label_index") -> DataFrame:
    """Distinct labels in ascending order, numbered from 0.

    Ranges of labels are numbered on their own and start where the one before ends.
    The result is written, so that its measured size decides how rows are joined to it.
    """
    classes = df.where(F.col(column).isNotNull()).select(column).distinct()
    numbered = dense_number(classes, [column], index)
    return materialize(numbered.withColumn(index, F.col(index).cast("int")), "label-index")


def index_labels(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Rows with the number of their label."""
    return df.join(dictionary, column, "inner")


def one_hot(df: DataFrame, index: str, output: str) -> DataFrame:
    """Sparse indicator vector over all classes (the largest index sets the size)."""
    encoder = OneHotEncoder(inputCol=index, outputCol=output, dropLast=False)
    return encoder.fit(df).transform(df)


def predicted_class(probabilities: str | Column) -> tuple[Column, Column]:
    """Index of the most likely class (the first on ties) and its probability,
    rounded half-even to three digits."""
    column = F.col(probabilities) if isinstance(probabilities, str) else probabilities
    best = F.array_max(column)
    return (F.array_position(column, best) - 1).cast("int"), F.bround(best, 3)
