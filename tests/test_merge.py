"""Upsert semantics and batch offsets."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spendweave.operators import upsert as merge
from spendweave.session import materialize
from spendweave.sources import offsets

from .conftest import rows

AUDITED = "k string, v string, w int, _DELTA_CREATED_ON timestamp, _DELTA_UPDATED_ON timestamp"
OLD, NEW = datetime(2020, 1, 1), datetime(2024, 1, 1)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", "1", 1, OLD, OLD), ("b", None, 2, OLD, OLD),
                                  (None, "n", 3, OLD, OLD)], AUDITED)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("a", "x"), ("c", "y"), (None, "z")], "k string, v string")


def now():
    return F.lit(NEW)


@pytest.mark.parametrize("one_pass", [False, True])
def test_upsert(target, source, one_pass):
    result = merge.upsert(target, source, "k", now=now(), one_pass=one_pass)
    assert rows(result) == sorted([
        ("a", "x", 1, OLD, NEW), ("b", None, 2, OLD, OLD), ("c", "y", None, NEW, NEW),
        (None, "n", 3, OLD, OLD), (None, "z", None, NEW, NEW)], key=repr)


@pytest.mark.parametrize("one_pass", [False, True])
def test_null_safe(target, source, one_pass):
    result = merge.upsert(target, source, "k", now=now(), null_safe=True, one_pass=one_pass)
    assert rows(result, "k", "v") == sorted([("a", "x"), ("b", None), ("c", "y"), (None, "z")],
                                            key=repr)


def test_conditions_and_column_choice(target, source):
    changed = merge.upsert(target, source, "k", now=now(), insert=False,
                           when="target.v is null or source.v <> target.v")
    assert rows(changed, "k", "v", "_DELTA_UPDATED_ON") == sorted([
        ("a", "x", NEW), ("b", None, OLD), (None, "n", OLD)], key=repr)
    same = merge.upsert(target, source, "k", now=now(), insert=False, when="source.v = target.v")
    assert rows(same) == rows(target)
    chosen = merge.upsert(target, source.withColumnRenamed("k", "id"), {"k": "id"}, now=now(),
                          insert=False, update={"w": F.lit(9)})
    assert rows(chosen, "k", "v", "w") == sorted([("a", "1", 9), ("b", None, 2), (None, "n", 3)],
                                                 key=repr)
    assert merge.upsert(target, source, "k", update=False).where("v = 'x'").count() == 0


def test_merge_schema(target, source):
    wide = source.withColumn("extra", F.lit(1.5))
    assert "extra" not in merge.upsert(target, wide, "k").columns
    result = merge.upsert(target, wide, "k", merge_schema=True)
    assert rows(result, "k", "extra") == sorted([("a", 1.5), ("b", None), ("c", 1.5), (None, None),
                                                 (None, 1.5)], key=repr)


def test_repeated_source_key_fails(spark, target):
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    with pytest.raises(Exception, match="several source rows"):
        merge.upsert(target, twice, "k").collect()
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], "k string, v string")
    assert merge.upsert(target, nulls, "k").count() == 5


def test_twice_is_once(target, source):
    keyed = source.where("k is not null")
    once = merge.upsert(target, keyed, "k", now=now())
    assert rows(merge.upsert(once, keyed, "k", now=now())) == rows(once)


def test_insert_absent(spark):
    schema = "NAME string, VERSION int, UUID string"
    known = spark.createDataFrame([("m", 1, "u1")], schema)
    seen = spark.createDataFrame([("m", 1, "u2"), ("m", 2, "u3")], schema)
    assert rows(merge.insert_absent(known, seen, ["NAME", "VERSION"])) == [("m", 1, "u1"),
                                                                           ("m", 2, "u3")]


def test_row_maintenance(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    assert rows(merge.update_rows(df, {"s": "'z'"}, "n = 2")) == [(1, "a"), (2, "z")]
    assert rows(merge.delete_rows(df, "s = 'a'")) == [(2, None)]
    assert rows(merge.insert_rows(df, spark.createDataFrame([("q",)], "s string"))) == sorted(
        [(1, "a"), (2, None), (None, "q")], key=repr)


def test_small_batches_do_not_move_the_target(spark):
    target = spark.range(1000).selectExpr("cast(id as string) as k", "id as v")
    source = spark.range(10).selectExpr("cast(id as string) as k", "id * 2 as v")
    plan = merge.upsert(target, source, "k", unique=True)._jdf.queryExecution().executedPlan()
    assert "Exchange hashpartitioning" not in plan.toString()


def test_offsets(spark):
    table = spark.createDataFrame([], "JOB string, OFFSET_AT timestamp, RESET_FLAG int")
    end = datetime(2024, 5, 5)
    assert offsets.batch_window(table, "j", end=end) == (None, end)
    table = offsets.commit_offset(table, "j", end)
    assert offsets.batch_window(table, "j", end=NEW) == (end, NEW)
    reset = offsets.request_reset(table, "j")
    assert offsets.batch_window(reset, "j", end=NEW) == (None, NEW)
    again = offsets.commit_offset(reset, "j", NEW)
    assert offsets.batch_window(again, "j", end=NEW) == (NEW, NEW)
    assert offsets.batch_window(again, "j", start=OLD, end=NEW) == (OLD, NEW)


def test_a_hot_key_is_split(spark):
    """A third of the items share one text; the join must not leave them to one task."""
    from spendweave.plans.vendor import answered_items
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items = spark.range(0, 60_000, 1, 8).selectExpr(
            "id as ID", "if(id % 3 = 0, 'hot', concat('t', id % 5000)) as PROCESSED_DESCRIPTION")
        report = spark.range(5000).selectExpr(
            "if(id = 0, 'hot', concat('t', id)) as PROCESSED_DESCRIPTION",
            "'12' as UNSPSC_SEGMENT")
        joined = answered_items(items, report)
        assert len(joined.collect()) == items.where("PROCESSED_DESCRIPTION <> 't0'").count()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_batches_follow_each_other(spark, tmp_path):
    root, windows = str(tmp_path / "offsets"), []
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    offsets.run_batch(spark, root, "j", lambda *w: windows.append(w), end=first)

    def fail(*window):
        raise ValueError("step failed")

    with pytest.raises(ValueError):
        offsets.run_batch(spark, root, "j", fail, end=second)
    offsets.run_batch(spark, root, "j", lambda *w: windows.append(w), end=second, commit=False)
    offsets.run_batch(spark, root, "other", lambda *w: windows.append(w), end=second)
    offsets.run_batch(spark, root, "j", lambda *w: windows.append(w), end=second)
    assert windows == [(None, first), (first, second), (None, second), (first, second)]


def test_rows_that_cannot_be_hit_are_not_moved(spark, monkeypatch):
    """A target in files: rows without a source key pass by the join, also those without a key."""
    monkeypatch.setattr(merge, "FEW_ROWS", 0)
    rows_ = [(k if k % 7 else None, f"n{k}") for k in range(40)] + [(8, "again")]
    files = materialize(spark.createDataFrame(rows_, "ID int, NAME string"))
    batch = materialize(spark.createDataFrame([(None, "x"), (8, "eight"), (9, "nine"), (99, "absent")], "ID int, NAME string"))
    split, seen = merge.split_maybe, []
    monkeypatch.setattr(merge, "split_maybe", lambda df, key, bits: seen.append(split(df, key, bits)) or seen[-1])
    plain = merge.upsert(files, batch, "ID", insert=False)
    found = merge.upsert(files, batch, "ID", insert=False, scanned=True)
    assert rows(found) == rows(plain) and found.schema == plain.schema
    (near, far), = seen
    assert [r[0] for r in rows(near, "ID")] == [8, 8, 9] and far.count() == 38
