"""Session defaults, and the one place where lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Settings the plans are written for. Adaptive execution splits hot join
#: keys, merges small shuffle blocks and re-plans joins on measured sizes.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a Parquet file grows in memory; a broadcast is decided on the grown size
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # the JVM does not compile methods over 8000 bytes; wide rows are faster
    # operator by operator than in one method that stays interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Codec of the tables that the library writes for itself.
COMPRESSION = "zstd"


def build_session(app_name: str = "spendweave", master: str | None = None,
                  settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; ``settings`` add to or override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables: ``spark.checkpoint.dir``, and
    below the warehouse where that is not set. Both are shared by contract."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate").rstrip("/")


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Writes inside the block drop their shuffle files at their end. Otherwise these stay on
    disk until the driver happens to collect its garbage, whatever runs next."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a frame feeds several consumers, or where a derived lookup has
    to be *measured* before it may be broadcast: the scan of the written files
    carries their real size, so Catalyst's broadcast threshold is a check on
    facts instead of on an estimate. The files survive lost executors.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    for paths in _scratch.get():
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The open blocks of this thread or task; other threads have their own.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession):
    """Remove the intermediate tables made inside the block, at its end. Results
    that read them must have been written by then."""
    paths: list[str] = []
    token = _scratch.set((*_scratch.get(), paths))
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
