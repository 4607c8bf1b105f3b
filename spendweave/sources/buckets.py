"""Tables kept in buckets of their key, so that a merge moves its batch only.

A key decides two numbers. The *part* is a partition column: a merge reads and rewrites the
parts that its batch hits and leaves all other files alone. Within a part the files are
bucketed and sorted by the key in the catalog's way, so the table's side of a join on the key
is never shuffled, however large the batch is; a small batch is broadcast as usual.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import COMPRESSION, shuffles_released

PART, _BUCKET = "KEY_PART", "__bucket"
#: Rows of a bucket over all parts: a task of a merge reads and sorts so many at most, if keys are
#: spread evenly.
BUCKET_ROWS = 500_000
#: Rows that a task sorts and writes when a table is created, if keys are spread evenly.
TASK_ROWS = 250_000
#: Rows that are moved and written at once when a table is created from files.
CREATE_ROWS = 80_000_000
#: Rows that a merge rewrites at once: until they replace them, they take disk beside the old ones.
MERGE_ROWS = 20_000_000


def part_of(key: str | Column, parts: int) -> Column:
    """The part of a key: the leading digits of its MD5, modulo the number of parts."""
    column = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class BucketTable:
    """A catalog table by parts and buckets of ``key``; the numbers are fixed at its creation.

    A part should hold what a few tasks write at once; parts x buckets bounds the files. A task
    of a merge reads one bucket of all parts, so ``buckets`` is a least number: a table of more
    rows is created with as many as keep a bucket below ``BUCKET_ROWS``.
    """

    spark: SparkSession
    name: str
    key: str
    parts: int = 256
    buckets: int = 32

    def create(self, df: DataFrame, path: str | None = None, rows: int | None = None,
               derive: Callable[[DataFrame], DataFrame] | None = None, written: bool = False) -> BucketTable:
        """Write ``df`` as the table, which is returned with its number of buckets. Rows of a
        file are brought together first. ``rows`` is how many there are at most; without it they
        are counted. ``derive`` makes the table's columns of those of ``df`` once rows are
        together, so that only what they are made of is moved; it must keep the key, the column
        ``KEY_PART`` and the rows where they are (projections, joins with a broadcast side). A
        ``written`` frame is read from files: a large one once for every ``CREATE_ROWS`` rows, which
        are moved and written before the next ones."""
        rows = df.count() if rows is None else rows
        buckets = max(self.buckets, -(-rows // BUCKET_ROWS))
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
        part, bucket = part_of(self.key, self.parts), F.pmod(F.hash(self.key), F.lit(buckets))
        rounds = min(self.parts, max(1, -(-rows // CREATE_ROWS))) if written else 1
        # as a column: the key is not moved where ``derive`` makes it anew
        numbered = df.withColumns({PART: part, _BUCKET: bucket})
        for k in range(rounds):
            own = numbered if rounds == 1 else numbered.where(F.col(PART) % rounds == k)
            placed = own.repartition(-(-tasks // rounds), PART, _BUCKET).drop(_BUCKET)
            shaped = placed if derive is None else derive(placed)
            writer = (shaped.write.format("parquet").option("compression", COMPRESSION)
                      .mode("append" if k else "overwrite").option("partitionOverwriteMode", "dynamic"))
            if path:
                writer = writer.option("path", path)
            with shuffles_released(self.spark):
                writer.partitionBy(PART).bucketBy(buckets, self.key).sortBy(self.key).saveAsTable(self.name)
        return replace(self, buckets=buckets)

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def current(self, batch: DataFrame) -> tuple[DataFrame, list[int]]:
        """The table's rows in the parts that ``batch`` hits, and these parts."""
        hit = sorted(row[0] for row in batch.select(part_of(self.key, self.parts)).distinct().collect())
        return self.spark.table(self.name).where(F.col(PART).isin(hit)).drop(PART), hit

    def merge(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the parts that ``batch`` hits by ``merge(current, batch)``; their number.

        ``batch`` has the table's key under its name, is read several times, and should have
        been written. The merge must keep a row's key, and is made of some parts after the
        other, each with the batch's rows of them, so that about ``MERGE_ROWS`` rows lie on disk
        twice. Its result is written by the tasks of its join; no row is shuffled for the write.
        """
        current, hit = self.current(batch)
        if hit:
            rounds = min(len(hit), max(1, -(-current.count() // MERGE_ROWS)))
            part = part_of(self.key, self.parts)
            merged = []     # all before the first is written, so that a merge that fails leaves the table alone
            for k in range(rounds):
                own = hit[k::rounds]
                rows = self.spark.table(self.name).where(F.col(PART).isin(own)).drop(PART)
                merged.append(merge(rows, batch if rounds == 1 else batch.where(part.isin(own))).withColumn(PART, part))
            for df in merged:
                with shuffles_released(self.spark):
                    df.select(*current.columns, PART).write.mode("overwrite").insertInto(self.name)
            self.spark.catalog.refreshTable(self.name)
        return len(hit)
