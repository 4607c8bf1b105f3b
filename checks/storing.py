"""Tables written and read back: snapshots, partitions, CSV exchange, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendweave import schemas
from spendweave.functions.measures import month_start
from spendweave.operators.upsert import upsert
from spendweave.plans import vendor
from spendweave.session import materialize, shared_folder
from spendweave.sources import readers, tables
from spendweave.sources.buckets import BucketTable
from spendweave.streaming import vendor_feed

from . import bind
from .bind import plain, query, sql_time, with_tables
from .merging import FEED, lower_feed


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"


@query("table_snapshots", """
    select o_orderkey, case when o_orderkey % 2 = 0 then 'NEW' else o_orderpriority end
             as o_orderpriority from orders""")
def table_snapshots(spark, d):
    """A table replaced by an update of itself."""
    root = _folder(spark)
    tables.replace_snapshot(bind.table(spark, d, "orders").select("o_orderkey",
                                                                 "o_orderpriority"), root)
    current = tables.read_snapshot(spark, root)
    changed = current.where("o_orderkey % 2 = 0").withColumn("o_orderpriority", F.lit("NEW"))
    tables.replace_snapshot(upsert(current, changed, "o_orderkey"), root)
    return tables.read_snapshot(spark, root)


@query("table_partitions", """
    select o_orderkey, o_orderstatus, o_totalprice * case when o_orderstatus = 'F'
               and o_orderkey % 3 = 0 then 2 else 1 end as o_totalprice from orders""")
def table_partitions(spark, d):
    """Only the partition the batch touches is rewritten."""
    path = _folder(spark)
    orders = bind.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.write_table(orders, path, partition_by=["o_orderstatus"])
    batch = orders.where("o_orderstatus = 'F' and o_orderkey % 3 = 0").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2)
    tables.replace_partitions(spark, path, batch, ["o_orderstatus"],
                              lambda current, rows: upsert(current, rows, "o_orderkey"))
    return spark.read.parquet(path)


@query("csv_export", "select doc_id, text, lang from documents")
def csv_export(spark, d):
    """Whole texts through an export and back."""
    path = _folder(spark)
    rows = bind.table(spark, d, "documents").select("doc_id", "text", "lang")
    tables.export_csv(rows, path, "2024-06-01", tables.next_run(spark, path, "2024-06-01"))
    return readers.load_table(path, "csv", spark, "doc_id bigint, text string, lang string, "
                              "export_date string, run_no int", multi_line=True).select(
        "doc_id", "text", "lang")


@query("csv_export_runs", """
    select '2024-06-01' as day, r as run_no, count(*) as n
    from orders, (values (0), (1)) runs(r) where o_orderkey % 2 = r group by r""")
def csv_export_runs(spark, d):
    """Two exports of one day stay side by side."""
    path = _folder(spark)
    orders = bind.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    for run in (0, 1):
        tables.export_csv(orders.where(f"o_orderkey % 2 = {run}"), path, "2024-06-01",
                          tables.next_run(spark, path, "2024-06-01"))
    exported = readers.load_table(path, "csv", spark, "o_orderkey bigint, o_orderpriority string, "
                                  "export_date string, run_no int")
    return exported.groupBy(F.col("export_date").alias("day"), "run_no").agg(
        F.count("*").alias("n"))


@query("array_tables", """
    select vec_id, round(list_sum(embedding), 3) as total, len(embedding) as n
    from embeddings""")
def array_tables(spark, d):
    path = _folder(spark)
    tables.write_arrays(bind.table(spark, d, "embeddings"), path)
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x)
    return spark.read.parquet(path).select("vec_id", F.round(total, 3).alias("total"),
                                           F.size("embedding").cast("bigint").alias("n"))


@query("vendor_stream", with_tables("parts", f"""
    select nullif(PROCESSED_DESCRIPTION, '') as PROCESSED_DESCRIPTION, DESCRIPTION,
           CODE as UNSPSC_COMMODITY,
           {sql_time('SENT_AT', 'REPORT_LASTUPDATED_AT')} from ({FEED})"""))
def vendor_stream(spark, d):
    """Vendor files read once as a stream and merged into the report. An empty CSV
    value is NULL."""
    folder = _folder(spark)
    feed = plain(lower_feed(spark, d))
    shaped = feed.select(*[F.col(field.name) if field.name in feed.columns
                           else F.lit(None).cast("string").alias(field.name)
                           for field in spark.createDataFrame([], schemas.VENDOR_FEED).schema])
    later = F.max("PREDICATION_LASTUPDATED_AT").over(Window.partitionBy("PROCESSED_DESCRIPTION"))
    newest = F.col("PREDICATION_LASTUPDATED_AT") == later
    shaped = materialize(shaped.withColumn("newest", newest), "feed")
    # the newest answers come first, the outdated ones in later files
    for wanted in ("newest", "not newest"):
        (shaped.where(wanted).drop("newest")
         .write.options(header=True, escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss")
         .mode("append").csv(f"{folder}/feed"))
    report = f"{folder}/report"
    tables.replace_snapshot(spark.createDataFrame([], schemas.VENDOR_REPORT), report)

    def merge(batch):
        current = tables.read_snapshot(batch.sparkSession, report)
        answers = vendor.feed_to_report(batch)
        tables.replace_snapshot(vendor.merge_report(current, answers), report)

    feed = vendor_feed.read_feed(spark, f"{folder}/feed", archive=f"{folder}/done")
    vendor_feed.import_feed(feed, f"{folder}/checkpoint", merge).awaitTermination()
    return plain(tables.read_snapshot(spark, report).select(
        "PROCESSED_DESCRIPTION", "DESCRIPTION", "UNSPSC_COMMODITY", "REPORT_LASTUPDATED_AT"))


@query("vendor_stream_state", with_tables("parts", f"""
    select nullif(PROCESSED_DESCRIPTION, '') as PROCESSED_DESCRIPTION, DESCRIPTION,
           CODE as UNSPSC_COMMODITY, {sql_time('SENT_AT', 'REPORT_LASTUPDATED_AT')},
           (select count(*) from ({FEED})) as first_changed,
           cast(0 as bigint) as second_changed, cast(0 as bigint) as second_parts from ({FEED})"""))
def vendor_stream_state(spark, d):
    """The newest answers first, then, after a restart, the outdated ones: these change nothing."""
    folder, seen = _folder(spark), []
    feed = plain(lower_feed(spark, d))
    shaped = feed.select(*[F.col(field.name) if field.name in feed.columns
                           else F.lit(None).cast("string").alias(field.name)
                           for field in spark.createDataFrame([], schemas.VENDOR_FEED).schema])
    later = F.max("PREDICATION_LASTUPDATED_AT").over(Window.partitionBy("PROCESSED_DESCRIPTION"))
    shaped = materialize(shaped.withColumn("newest", F.col("PREDICATION_LASTUPDATED_AT") == later), "feed")
    name = f"report_{uuid.uuid4().hex}"
    report = BucketTable(spark, name, "PROCESSED_DESCRIPTION", 16, 2).create(
        spark.createDataFrame([], schemas.VENDOR_REPORT), f"{folder}/report")
    for wanted in ("newest", "not newest"):
        (shaped.where(wanted).drop("newest")
         .write.options(header=True, escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss")
         .mode("append").csv(f"{folder}/feed"))
        files = vendor_feed.read_feed(spark, f"{folder}/feed")
        batches = []
        vendor_feed.import_answers(files, f"{folder}/checkpoint", report,
                                   on_batch=lambda *counts: batches.append(counts)).awaitTermination()
        seen.append([sum(side) for side in zip(*batches)] or [0, 0])
    return plain(report.read().select(
        "PROCESSED_DESCRIPTION", "DESCRIPTION", "UNSPSC_COMMODITY", "REPORT_LASTUPDATED_AT",
        F.lit(seen[0][0]).cast("bigint").alias("first_changed"), F.lit(seen[1][0]).cast("bigint").alias("second_changed"),
        F.lit(seen[1][1]).cast("bigint").alias("second_parts")))


@query("month_partitions", f"""
    select strftime(o_orderdate, '%Y-%m') as month, count(*) as n,
           cast(sum(o_orderkey) as bigint) as keys
    from orders group by all""")
def month_partitions(spark, d):
    path = _folder(spark)
    orders = bind.table(spark, d, "orders").withColumn(
        "month", F.date_format(month_start(F.col("o_orderdate")), "yyyy-MM"))
    tables.write_table(orders.select("o_orderkey", "month").repartition("month"), path,
                       partition_by=["month"])
    return (spark.read.schema("o_orderkey bigint, month string").parquet(path)
            .groupBy("month").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")))
