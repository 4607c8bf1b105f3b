"""The vendor feed is written by many tasks."""

from pathlib import Path

from checks import storing
from spendweave.streaming import vendor_feed


def test_vendor_feed_is_written_in_parallel(spark, monkeypatch):
    files, read = [], vendor_feed.read_feed

    def counted(session, path, **options):
        files.extend(Path(path.removeprefix("file:")).glob("part-*.csv"))
        return read(session, path, **options)

    monkeypatch.setattr(storing.vendor_feed, "read_feed", counted)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = storing.vendor_stream(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set(key, before)
    assert rows and len({r.PROCESSED_DESCRIPTION for r in rows}) == len(rows)
    assert len(files) > 2
