"""Writing tables, and replacing a table that is read by its own update.

A Parquet directory cannot be overwritten while a plan reads it. Three ways
around it, by how much of the table a batch touches:

* ``replace_snapshot``: a new version directory per update, for tables whose
  batches touch everything;
* ``replace_partitions``: only the partitions a batch touches are read and
  written (Spark's dynamic partition overwrite);
* ``save_bucketed``: a catalog table bucketed by its key. Joining a batch to it
  shuffles the batch only.

With Delta on the class path pass ``table_format="delta"`` to ``write_table``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import COMPRESSION, shuffles_released

_VERSION = "version="


def _compressed(writer):
    return writer.option("compression", COMPRESSION)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", table_format: str = "parquet",
                database: str | None = None, table: str | None = None,
                partition_by: Sequence[str] = ()) -> None:
    """Write a table and, if named, register it in the catalog at its path."""
    with shuffles_released(df.sparkSession):
        _compressed(df.write).format(table_format).mode(mode).partitionBy(*partition_by).save(path)
    if database and table:
        spark = df.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
        spark.sql(f"CREATE TABLE `{database}`.`{table}` USING {table_format} LOCATION '{path}'")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of a snapshot table, oldest first."""
    fs, folder = _file_system(spark, root)
    if not fs.exists(folder):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [(entry.getPath(), entry.getPath().getName()) for entry in fs.listStatus(folder)]
    return sorted(int(name.removeprefix(_VERSION)) for location, name in names
                  if name.startswith(_VERSION) and fs.exists(path(location, "_SUCCESS")))


def has_snapshot(spark: SparkSession, root: str) -> bool:
    return bool(_versions(spark, root))


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version."""
    versions = _versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root}/{_VERSION}{versions[-1]:08d}")


def replace_snapshot(df: DataFrame, root: str, keep: int = 2) -> None:
    """Write ``df`` as the next version; it becomes current once it is complete.

    A failed write leaves the current version in place. Versions older than the
    last ``keep`` are removed.
    """
    spark = df.sparkSession
    versions = _versions(spark, root)
    number = versions[-1] + 1 if versions else 1
    _compressed(df.write).mode("overwrite").parquet(f"{root}/{_VERSION}{number:08d}")
    for old in [*versions, number][:-keep]:
        fs, folder = _file_system(spark, f"{root}/{_VERSION}{old:08d}")
        fs.delete(folder, True)


def _in_partitions(values: list, partition_by: Sequence[str]) -> Column:
    """Condition on partition columns, as literals: the scan lists only these directories."""
    if len(partition_by) == 1:
        known = [row[0] for row in values if row[0] is not None]
        same = F.col(partition_by[0]).isin(known) if known else F.lit(False)
        return same | F.col(partition_by[0]).isNull() if len(known) < len(values) else same
    return reduce(or_, [reduce(and_, [F.col(name).eqNullSafe(F.lit(value)) for name, value in
                                      zip(partition_by, row, strict=True)]) for row in values],
                  F.lit(False))


def replace_partitions(spark: SparkSession, path: str, batch: DataFrame,
                       partition_by: Sequence[str],
                       merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Apply ``merge(current, batch)`` to the partitions ``batch`` touches; their number.

    A key must always fall into the same partition. The touched partition values
    (at most as many as there are partitions) become a partition filter of the
    scan, and dynamic overwrite replaces just those directories. ``batch`` is read
    twice, so it should have been written.
    """
    fs, folder = _file_system(spark, path)
    values = batch.select(*partition_by).distinct().collect()
    if fs.exists(folder):
        current = spark.read.parquet(path).where(_in_partitions(values, partition_by))
    else:
        current = batch.limit(0)
    if values:
        merged = merge(current, batch)
        with shuffles_released(spark):
            (_compressed(merged.write).mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(path))
    return len(values)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                  path: str | None = None) -> None:
    """Write a catalog table bucketed and sorted by ``keys``."""
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_arrays(df: DataFrame, path: str) -> None:
    """Feature matrices: array columns in Parquet."""
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, export_date: str, run_no: int = 0,
               max_rows_per_file: int = 1_000_000) -> None:
    """CSV with header under ``export_date=../run_no=..``.

    Every run has its own directory, so earlier exports stay where they are.
    Quotes are doubled, line breaks and outer blanks kept; the file size is
    bounded, because such files are read whole by one task each.
    """
    (df.withColumn("export_date", F.lit(export_date)).withColumn("run_no", F.lit(run_no))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
              ignoreTrailingWhiteSpace=False, maxRecordsPerFile=max_rows_per_file)
     .partitionBy("export_date", "run_no").csv(path))


def next_run(spark: SparkSession, path: str, export_date: str) -> int:
    """Number of the next export of a day."""
    fs, folder = _file_system(spark, f"{path}/export_date={export_date}")
    if not fs.exists(folder):
        return 0
    runs = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return 1 + max((int(name.removeprefix("run_no=")) for name in runs
                    if name.startswith("run_no=")), default=-1)
