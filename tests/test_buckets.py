"""Tables in buckets: what a merge moves, rewrites and leaves alone."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spendweave.operators.upsert import upsert
from spendweave.sources import buckets
from spendweave.session import materialize
from spendweave.sources.buckets import BucketTable, part_of

from .conftest import rows

NOW = datetime(2024, 1, 10)


@pytest.fixture
def table(spark, tmp_path):
    data = spark.range(500).selectExpr("concat('k', id) as ID", "id as V", "cast(null as timestamp) as _DELTA_UPDATED_ON")
    made = BucketTable(spark, f"bucketed_{os.path.basename(tmp_path)}".replace("-", "_"), "ID", 8, 4).create(data, str(tmp_path / "t"))
    yield made
    spark.sql(f"drop table {made.name}")


def files(tmp_path):
    return {os.path.join(folder, f) for folder, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")}


def merged(current, batch):
    return upsert(current, batch, "ID", now=F.lit(NOW))


def test_merge_rewrites_the_parts_of_its_batch(spark, table, tmp_path):
    before = files(tmp_path)
    batch = materialize(spark.createDataFrame([("k3", -3), ("k77", -77), ("new", 1)], "ID string, V long"))
    hit = {r[0] for r in batch.select(part_of("ID", 8)).collect()}
    assert table.merge(batch, merged) == len(hit) < 8
    after = files(tmp_path)
    assert {f for f in before & after} == {f for f in before if int(f.split("KEY_PART=")[1].split("/")[0]) not in hit}
    expected = {**{f"k{k}": k for k in range(500)}, "k3": -3, "k77": -77, "new": 1}
    assert {r.ID: r.V for r in table.read().collect()} == expected and table.read().count() == 501
    # and once more over the rewritten parts, from the table itself
    again = materialize(table.read().where("V < 0").withColumn("V", F.col("V") * 2).select("ID", "V"))
    table.merge(again, merged)
    assert rows(table.read().where("V < 0"), "ID", "V") == [("k3", -6), ("k77", -154)]
    assert table.merge(batch.limit(0), merged) == 0


def test_a_merge_of_many_rows_goes_by_groups_of_parts(spark, table, monkeypatch):
    """The rows that lie on disk twice are bounded; inserted rows are inserted once."""
    monkeypatch.setattr(buckets, "MERGE_ROWS", 150)
    batch = materialize(spark.range(400, 600).selectExpr("concat('k', id) as ID", "-id as V"))
    seen = []

    def watched(current, own):
        seen.append((current.count(), own.count()))
        return merged(current, own)

    assert table.merge(batch, watched) == 8
    assert len(seen) == 4 and sum(n for n, _ in seen) == 500 and sum(n for _, n in seen) == 200
    assert {r.ID: r.V for r in table.read().collect()} == {f"k{k}": k if k < 400 else -k for k in range(600)}
    assert table.read().count() == 600
    twice = materialize(batch.unionByName(batch.limit(1)).withColumn("V", F.lit(0)))
    with pytest.raises(ValueError):
        table.merge(twice, merged)
    assert table.read().where("V = 0").count() == 1      # k0: nothing was written


def test_a_table_of_many_rows_is_created_by_groups_of_parts(spark, tmp_path, monkeypatch):
    rows_ = materialize(spark.range(500).selectExpr("concat('k', id) as ID", "id as V"))
    monkeypatch.setattr(buckets, "CREATE_ROWS", 200)
    name = f"created_{os.path.basename(tmp_path)}".replace("-", "_")
    made = BucketTable(spark, name, "ID", 8, 4).create(rows_, str(tmp_path / "t"), written=True)
    assert rows(made.read(), "ID", "V") == rows(rows_) and {f.split("KEY_PART=")[1][0] for f in files(tmp_path)} == set("01234567")
    assert made.merge(rows_.where("V < 3").withColumn("V", F.lit(-1)), lambda t, b: upsert(t, b, "ID", insert=False)) <= 3
    assert made.read().where("V = -1").count() == 3 and made.read().count() == 500
    assert len([f for f in files(tmp_path)]) <= 8 * 4
    spark.sql(f"drop table {name}")


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(found.apply(k).getName().startswith("shuffle_") for k in range(found.size()))

    before = shuffles()
    counts = materialize(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    assert counts.count() == 7
    kept = shuffles()
    materialize(counts.repartition(5, "k").groupBy("count").agg(F.max("k").alias("most")))
    assert shuffles() <= kept and kept - before <= 4      # those of counts.count() only
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_the_table_is_not_shuffled(spark, table):
    """A batch too large for a broadcast: only the batch is dealt out."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = materialize(table.read().withColumn("V", F.col("V") + 1))
        current, _ = table.current(batch)
        plan = merged(current, batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and plan.count("Bucketed: true") >= 2
    for line in block_of_exchanges(plan):
        assert table.name not in line


def block_of_exchanges(plan):
    """The lines below each Exchange of a plan."""
    lines, found = plan.splitlines(), []
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            for below in lines[k + 1:]:
                text = below.lstrip(" :+-*()0123456789")
                if not text or below.index(text[:4]) <= depth:
                    break
                found.append(below)
    assert found
    return found


def test_parts_of_missing_keys(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "k string")
    assert all(0 <= r[0] < 7 for r in df.select(part_of("k", 7)).collect())


def test_a_large_table_gets_more_buckets(spark, tmp_path, monkeypatch):
    """A task of a merge reads one bucket of all parts."""
    from spendweave.sources import buckets
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 50)
    name = f"grown_{os.path.basename(tmp_path)}".replace("-", "_")
    data = spark.range(500).selectExpr("concat('k', id) as ID", "id as V", "cast(null as timestamp) as _DELTA_UPDATED_ON")
    table = BucketTable(spark, name, "ID", 2, 4).create(data, str(tmp_path / "t"))
    assert table.buckets == 10 and spark.table(name).rdd.getNumPartitions() >= 4
    batch = materialize(spark.createDataFrame([("k3", -3), ("new", 1)], "ID string, V long"))
    table.merge(batch, merged)
    assert table.read().where("V < 0 or ID = 'new'").count() == 2 and table.read().count() == 501
    spark.sql(f"drop table {name}")


def test_derived_columns_are_made_where_rows_are(spark, tmp_path):
    """The key is derived anew after the shuffle, and rows lie in the buckets of their key."""
    data = spark.range(300).selectExpr("id as V", "concat('k', id) as ID")
    name = f"derived_{os.path.basename(tmp_path)}".replace("-", "_")
    made = BucketTable(spark, name, "ID", 4, 2).create(
        data, str(tmp_path / "t"), 300, lambda df: df.selectExpr("concat('k', V) as ID", "V", "repeat('text', 9) as T", "KEY_PART"))
    try:
        assert rows(made.read(), "ID", "V") == sorted((f"k{k}", k) for k in range(300))
        wrong = spark.table(name).where(F.col("KEY_PART") != part_of("ID", 4))
        assert wrong.count() == 0 and made.read().where("T <> repeat('text', 9)").count() == 0
        assert len(files(tmp_path)) <= 8
    finally:
        spark.sql(f"drop table {name}")
