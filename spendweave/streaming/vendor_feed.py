"""Vendor files consumed once, as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import columns as C
from .. import schemas
from ..plans.vendor import merge_report
from ..session import materialize, scratch
from ..sources.buckets import BucketTable


def read_feed(spark: SparkSession, path: str, archive: str | None = None,
              files_per_batch: int = 1000) -> DataFrame:
    """New CSV files under ``path``; with ``archive`` a processed file is moved
    there when a later batch commits."""
    reader = (spark.readStream.schema(schemas.VENDOR_FEED)
              .options(header=True, multiLine=True, escape='"',
                       maxFilesPerTrigger=files_per_batch))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path)


def import_feed(feed: DataFrame, checkpoint: str,
                merge: Callable[[DataFrame], None]) -> StreamingQuery:
    """Run ``merge`` on every batch of files that has not been imported yet.

    The checkpoint makes each file count once; a batch repeated after a failure
    is merged by key and changes nothing. Answers are merged by their time (see
    ``plans.vendor``), so neither the order of the files nor how they are
    grouped into batches matters.
    """
    return (feed.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, _: merge(batch)).start())


def newest_answers(feed: DataFrame) -> DataFrame:
    """The newest answer to each text, as a streaming aggregate: its state outlives batches and
    restarts. Of answers of the same time the greatest wins, in any order of arrival."""
    time = "PREDICATION_LASTUPDATED_AT"
    others = [name for name in C.VENDOR_FEED if name not in ("PROCESSED_DESCRIPTION", time)]
    newest = F.max(F.struct(time, *others)).alias("newest")
    return (feed.groupBy("PROCESSED_DESCRIPTION").agg(newest).select("PROCESSED_DESCRIPTION", "newest.*")
            .withColumnsRenamed(C.FEED_TO_REPORT))


def changed_answers(answers: DataFrame, report: DataFrame) -> DataFrame:
    """Answers that the report lacks or has an older one for."""
    known = report.where("REPORT_LASTUPDATED_AT is not null").select(
        F.col("PROCESSED_DESCRIPTION").alias("__text"), F.col("REPORT_LASTUPDATED_AT").alias("__at"))
    same = F.col("PROCESSED_DESCRIPTION").eqNullSafe(F.col("__text"))
    return answers.join(known, same & ~(F.col("REPORT_LASTUPDATED_AT") > F.col("__at")), "left_anti")


def import_answers(feed: DataFrame, checkpoint: str, report: BucketTable, now: Column | None = None,
                   on_batch: Callable[[int, int], None] = lambda answers, parts: None) -> StreamingQuery:
    """Merge the feed into a report kept in buckets of its text.

    A batch brings the newest answers to its texts; those that change the report rewrite the
    parts that they hit, all others rewrite nothing. A batch repeated after a failure changes
    nothing. ``on_batch`` is told the changed answers and rewritten parts.
    """
    def merge(batch: DataFrame, _: int) -> None:
        with scratch(batch.sparkSession):
            answers = materialize(batch, "answers")
            current, _ = report.current(answers)
            changed = materialize(changed_answers(answers, current), "changed-answers")
            on_batch(changed.count(), report.merge(changed, lambda table, rows: merge_report(table, rows, now)))

    return (newest_answers(feed).writeStream.option("checkpointLocation", checkpoint).outputMode("update")
            .trigger(availableNow=True).foreachBatch(merge).start())
