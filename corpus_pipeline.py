"""A training corpus from the table of documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of the documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.llm import exact_dedup, near_dedup, packing, pii, quality
from spendweave.llm.common import bounded_batches, table
from spendweave.session import scratch, shared_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the rules reject go. NULL and empty texts are rejected,
    repeated rows are judged alike.
    """
    bounded_batches(spark)
    return quality.keep_good_documents(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact deduplication: one document of each group of equal texts stays; NULL texts count
    as empty, of repeated rows one stays.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: one document of each component stays; texts without words are alike to
    none and stay.
    """
    bounded_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; NULL texts stay NULL."""
    bounded_batches(spark)
    return pii.mask_personal_data(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids packed into windows; one row per piece. A NULL text has its end id alone; an
    empty table gives no rows, here as in all stages.
    """
    bounded_batches(spark)
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("personal_data", masked_documents),
    ("packing", packed_windows),
]

#: Tokenizing and learned cutoffs are beyond SQL; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again, and what a stage
    has written on the way is removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
