"""Word ids for text features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import text
from ..session import materialize
from .numbering import dense_number, top_rows


def _place(df: DataFrame, row_key: Sequence[str]) -> Column:
    """Row and position of a word as one ordered value.

    An integer key is packed into a decimal, which a hash aggregate can hold;
    other keys form a struct, at the price of a sort aggregate.
    """
    if len(row_key) == 1 and isinstance(df.schema[row_key[0]].dataType, IntegralType):
        return F.col(row_key[0]).cast("decimal(20,0)") * F.lit(2**31) + F.col("pos")
    return F.struct(*row_key, "pos")


def word_counts(df: DataFrame, column: str, row_key: Sequence[str]) -> DataFrame:
    """Occurrences of each word and the place of its first one."""
    words = df.select(*row_key, F.posexplode(text.tokens(F.col(column))).alias("pos", "word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"),
                                     F.min(_place(df, row_key)).alias("first"))


def vocabulary(df: DataFrame, column: str, row_key: str | Sequence[str],
               num_words: int) -> DataFrame:
    """The ``num_words - 1`` most frequent words, numbered from 1.

    Ties go to the word that occurs first (``row_key`` orders the rows). Histograms of
    the counts find the last word that is kept, and the kept ones are numbered by ranges:
    no task gets the most frequent words of every other one.
    """
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    counts = materialize(word_counts(df, column, keys), "word-counts")
    top = top_rows(counts, num_words - 1, "count", ["first"])
    return dense_number(top, [F.desc("count"), F.asc("first")], "index", 1).select(
        "word", "count", F.col("index").cast("int").alias("index"))


def token_ids(df: DataFrame, column: str, words: DataFrame, output: str = "ids") -> DataFrame:
    """Ids of the words of each text in order; unknown words are dropped.

    The rows are numbered and written once; their words meet the vocabulary in a
    join (Spark broadcasts a small one) and are regrouped by that number, so rows
    may repeat and need no key. A NULL text has no ids.
    """
    words = materialize(words.select("word", F.col("index").cast("int").alias("__index")), "vocabulary")
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = (rows.select("__row", F.posexplode(text.tokens(F.col(column))).alias("pos", "word"))
             .join(words, "word").groupBy("__row")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "__index"))).alias("__found")))
    ids = F.coalesce(F.transform("__found", lambda entry: entry["__index"]),
                     F.array().cast("array<int>"))
    return rows.join(found, "__row", "left").withColumn(output, ids).drop("__found", "__row")
