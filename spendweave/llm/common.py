"""What the operators of this package share: reading, row numbers, the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: Rows that travel to a Python worker at once. Texts may be long; a worker holds a batch
#: of them, its results and nothing else.
BATCH_ROWS = 256


def query(name: str, sql: str | None = None):
    """Register ``function(spark, sf_dir)`` and, where there is one, its SQL equivalent."""
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows per Arrow batch of this session (the default of 10,000 rows of long
    texts would not fit a worker)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def sha256_text(column: Column) -> Column:
    """Lowercase hex digest of a string's UTF-8 bytes."""
    return F.sha2(column.cast("binary"), 256)
