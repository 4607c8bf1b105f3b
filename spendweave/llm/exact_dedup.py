"""Exact duplicates of normalised texts, with the heavy hitters split off.

A digest that a large share of all rows has would send these rows to one task. So the
frequent digests are found first (Misra-Gries counters: Spark's ``freqItems``), counted
exactly, and their winners broadcast: rows with such a digest are decided where they are.
All other digests are rare by construction and go through an ordinary aggregation and join.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

from .common import BLANKS, sha256_text, text_of

#: Misra-Gries counters. Every digest with more than 1/COUNTERS of the rows is found; the
#: broadcast holds at most COUNTERS rows of about 100 bytes, whatever the input.
COUNTERS = 256
#: Keys of dropped rows (some 120 bytes each) up to which they are broadcast.
BROADCAST_KEYS = 400_000


def normalised(text: str = "text") -> Column:
    """The text with each run of white space replaced by one blank; NULL is empty."""
    return F.regexp_replace(text_of(text), BLANKS, " ")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows whose normalised texts are equal form a group; ``keep_id`` is its smallest
    ``doc_id`` and exactly one row of a group is ``kept``.

    NULL texts count as empty, and all empty texts are equal. A NULL ``doc_id`` comes after
    every other one; a group of NULL ids only keeps one of them. Among repeated rows with
    the smallest id an arbitrary one stays. An empty table gives an empty result. Other
    columns are not looked at.
    """
    keyed = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), sha256_text(normalised(text)).alias("text_sha256"),
    ).withColumn("row", F.monotonically_increasing_id()), "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    facts = (F.count(F.lit(1)).alias("group_size"), first.alias("winner"))

    candidates = (keyed.stat.freqItems(["text_sha256"], 1.0 / counters)
                  .select(F.explode("text_sha256_freqItems").alias("text_sha256")))
    counted = (keyed.join(F.broadcast(candidates), "text_sha256").groupBy("text_sha256").agg(*facts))
    frequent = materialize(counted, "frequent-digests")   # verified: exact counts and winners
    held = keyed.join(F.broadcast(frequent), "text_sha256")
    rest = keyed.join(F.broadcast(frequent.select("text_sha256")), "text_sha256", "left_anti")
    rest = rest.join(rest.groupBy("text_sha256").agg(*facts), "text_sha256")
    return held.unionByName(rest).select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                          counters: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns as they were. NULL and
    empty texts are one group; an empty table stays empty; other columns may have any name.

    The keys of the rows that go are counted: up to ``BROADCAST_KEYS`` they are broadcast and
    no text moves, more of them are met by a shuffle.
    """
    key = ("__xd_id", "__xd_digest")
    decided = materialize(
        exact_duplicates(docs, text, doc_id, counters)
        .groupBy(F.col("doc_id").alias(key[0]), F.col("text_sha256").alias(key[1]))
        .agg(F.max("kept").alias("__xd_kept"), F.count(F.lit(1)).alias("__xd_rows")), "decided")
    marked = docs.withColumns({key[0]: F.col(doc_id), key[1]: sha256_text(normalised(text))})

    def on(other):
        return (marked[key[0]].eqNullSafe(other[key[0]])) & (marked[key[1]] == other[key[1]])

    dropped = materialize(decided.filter(~F.col("__xd_kept")).select(*key), "dropped")
    if dropped.count() <= BROADCAST_KEYS:
        dropped = F.broadcast(dropped)
    marked = marked.join(dropped, on(dropped), "left_anti")
    # rows that share id and text with the row that stays: only where ids repeat
    repeated = decided.filter(F.col("__xd_kept") & (F.col("__xd_rows") > 1)).select(*key)
    if not repeated.isEmpty():
        once = marked.join(repeated, on(repeated), "left_semi").dropDuplicates(list(key))
        marked = marked.join(repeated, on(repeated), "left_anti").unionByName(once)
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns])
