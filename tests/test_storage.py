"""Tables on disk, exports, streams."""

import pytest
from pyspark.sql import functions as F

from spendweave import schemas
from spendweave.operators.upsert import upsert
from spendweave.session import materialize, scratch
from spendweave.sources import readers, tables
from spendweave.streaming import vendor_feed

from .conftest import rows


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(1, 5):
        df = spark.range(n) if n == 1 else tables.read_snapshot(spark, root).union(
            spark.range(n - 1, n))
        tables.replace_snapshot(df, root)
    assert tables.read_snapshot(spark, root).count() == 4
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version=00000003",
                                                                  "version=00000004"]
    # an unfinished version is not read
    (tmp_path / "t" / "version=00000005").mkdir()
    assert tables.read_snapshot(spark, root).count() == 4


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], "k int, v string, p string")
    merge = lambda current, batch: upsert(current, batch, "k")
    tables.replace_partitions(spark, path, first, ["p"], merge)
    untouched = {f.name for f in (tmp_path / "t" / "p=p1").iterdir()}
    batch = spark.createDataFrame([(2, "B", "p2"), (3, "C", "p3")], "k int, v string, p string")
    tables.replace_partitions(spark, path, batch, ["p"], merge)
    assert rows(spark.read.parquet(path), "k", "v", "p") == [(1, "a", "p1"), (2, "B", "p2"),
                                                             (3, "C", "p3")]
    assert {f.name for f in (tmp_path / "t" / "p=p1").iterdir()} == untouched


def test_bucketed_table_is_not_shuffled(spark, tmp_path):
    tables.save_bucketed(spark.range(1000).selectExpr("id as k", "id as v"), "bucketed_items",
                         ["k"], 4, str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(500, 1500).selectExpr("id as k", "id * 2 as v").repartition(3)
        merged = upsert(spark.table("bucketed_items"), batch, "k", unique=True, one_pass=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert merged.count() == 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.drop_table(spark, "bucketed_items")


def test_named_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path, database="spend_db", table="three")
    assert spark.table("spend_db.three").count() == 3
    spark.sql("DROP DATABASE spend_db CASCADE")


def test_csv_keeps_whole_texts(spark, tmp_path):
    path = str(tmp_path / "csv")
    texts = ['say "hi", twice', "two\nlines", " padded ", "back\\slash", "0110"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    for _ in range(2):
        tables.export_csv(df, path, "2024-01-01", tables.next_run(spark, path, "2024-01-01"))
    back = readers.load_table(path, "csv", spark,
                              "n int, t string, export_date string, run_no int", multi_line=True)
    assert rows(back, "n", "t", "run_no") == sorted(
        [(n, t, run) for n, t in enumerate(texts) for run in (0, 1)], key=repr)


def test_training_inputs(spark, tmp_path):
    for name in ("one", "two", "ref"):
        spark.createDataFrame([("0110", name), ("0220", "same")], "CODE string, s string").write \
            .option("header", True).csv(str(tmp_path / name))
    inputs = {f"{readers.COMMUNITY}1": {"path": str(tmp_path / "one")},
              f"{readers.COMMUNITY}3": {"path": str(tmp_path / "two")},
              readers.REFERENCE: {"path": str(tmp_path / "ref"), "prefix": "r"}}
    kind = "CODE string, s string"
    union, reference = readers.load_training_inputs(inputs, spark, schema=kind,
                                                    reference_schema=kind)
    assert rows(union) == [("0110", "one"), ("0110", "two"), ("0220", "same")]
    assert reference.columns == ["r_CODE", "r_s"]
    with pytest.raises(ValueError, match="other"):
        readers.load_training_inputs({**inputs, "other": {"path": "/nowhere"}}, spark)
    union, reference = readers.load_training_inputs(
        {"x_1": {"path": str(tmp_path / "one")}}, spark, schema=kind, community="x_")
    assert union.count() == 2 and reference is None


def test_feed_is_imported_once(spark, tmp_path):
    seen = []

    def send(name, *texts):
        columns = [field.name for field in spark.createDataFrame([], schemas.VENDOR_FEED).schema]
        made = spark.createDataFrame([(text,) for text in texts], "PROCESSED_DESCRIPTION string")
        made.select(*[F.col(c) if c in made.columns else F.lit(None).cast("string").alias(c)
                      for c in columns]).coalesce(1).write.option("header", True).csv(
            str(tmp_path / "feed" / name))

    def run():
        feed = vendor_feed.read_feed(spark, str(tmp_path / "feed" / "*"))
        vendor_feed.import_feed(
            feed, str(tmp_path / "checkpoint"),
            lambda batch: seen.extend(r["PROCESSED_DESCRIPTION"] for r in batch.collect())
        ).awaitTermination()

    send("a", "x", "y")
    run()
    send("b", "z")
    run()
    run()
    assert sorted(seen) == ["x", "y", "z"]


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "id % 2 as p").groupBy("p").count()
    cut = materialize(df)
    assert rows(cut) == rows(df)
    assert "Aggregate" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_scratch_is_local_to_a_thread(spark):
    """A block that ends must not remove what another thread has made meanwhile."""
    from threading import Event, Thread
    inside, done, kept = Event(), Event(), []

    def other():
        with scratch(spark):
            inside.wait(60)
            kept.append(materialize(spark.range(7)))
            done.set()
            ended.wait(60)
            kept.append(kept[0].count())

    ended = Event()
    thread = Thread(target=other)
    thread.start()
    with scratch(spark):
        materialize(spark.range(3))
        inside.set()
        done.wait(60)
    ended.set()
    thread.join()
    assert kept[1] == 7


def test_answers_do_not_depend_on_the_order_of_files(spark, tmp_path):
    """One file per batch, the newest first; consumed files are archived."""
    import os

    from spendweave.plans import vendor
    columns = [field.name for field in spark.createDataFrame([], schemas.VENDOR_FEED).schema]
    for name, code, day in (("a", "22222222", "2024-02-02"), ("b", "11111111", "2024-01-01"),
                            ("c", "11111111", "2023-01-01")):
        made = spark.createDataFrame([("bolt", code, f"{day} 00:00:00")],
                                     "PROCESSED_DESCRIPTION string, PREDICATED_UNSPSC_COMMODITY string, "
                                     "PREDICATION_LASTUPDATED_AT string")
        made.select(*[F.col(c) if c in made.columns else F.lit(None).cast("string").alias(c)
                      for c in columns]).coalesce(1).write.mode("append").option(
            "header", True).csv(str(tmp_path / "feed"))
    report = str(tmp_path / "report")
    tables.replace_snapshot(spark.createDataFrame([], schemas.VENDOR_REPORT), report)

    def merge(batch):
        current = tables.read_snapshot(spark, report)
        tables.replace_snapshot(vendor.merge_report(current, vendor.feed_to_report(batch)), report)

    for _ in range(2):
        feed = vendor_feed.read_feed(spark, str(tmp_path / "feed"), str(tmp_path / "done"), 1)
        vendor_feed.import_feed(feed, str(tmp_path / "checkpoint"), merge).awaitTermination()
    assert rows(tables.read_snapshot(spark, report), "UNSPSC_COMMODITY") == [("22222222",)]
    archived = [f for _, _, names in os.walk(tmp_path / "done") for f in names if f.endswith(".csv")]
    assert archived


def test_scratch_removes_intermediate_tables(spark):
    import os
    with scratch(spark):
        kept = materialize(spark.range(5))
        files = kept.inputFiles()
        assert kept.count() == 5
    assert files and not any(os.path.exists(f.removeprefix("file:").replace("///", "/")
                                            ) for f in files)
