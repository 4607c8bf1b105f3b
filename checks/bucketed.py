"""Jobs on tables kept in buckets of their key: a day's batch rewrites the parts that it hits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from spendweave import columns as C
from spendweave.plans import extract, inference, star, vendor
from spendweave.session import materialize, scratch, shared_folder
from spendweave.sources.buckets import PART as PART_COLUMN
from spendweave.sources.buckets import BucketTable

from . import bind, merging
from .bind import LEVELS, plain, query
from .coding import ORG_SQL, raw_tables
from .merging import EXTRACT_SCHEMA, IN_WINDOW, RUN, now

PARTS, BUCKETS = 64, 4
DAY_START, DAY_END = "1997-03-03 00:00:00", "1997-03-03 23:59:59"
IN_DAY = f"between timestamp '{DAY_START}' and timestamp '{DAY_END}'"
OLD = "2001-01-01 00:00:00"
PART = f"cast('0x' || substr(md5(ID), 1, 8) as bigint) % {PARTS}"


def bucketed(spark, df, d, derive=None, written=False):
    """A table of items; there are no more than lines."""
    name = f"bucketed_{uuid.uuid4().hex}"
    lines = bind.table(spark, d, "lineitem").count()
    return BucketTable(spark, name, "ID", PARTS, BUCKETS).create(df, f"{shared_folder(spark)}/{name}", lines, derive, written)


def bucketed_items(spark, d):
    """The item table in buckets. Given columns are written and moved; what is made of them, texts
    above all, is made where rows have come together."""
    few = bind.few_parts(spark, d)
    derive = (lambda df: bind.shape_items(spark, d, df, PART_COLUMN)) if few else (lambda df: bind.name_items(df, PART_COLUMN))
    with scratch(spark):
        return bucketed(spark, bind.written_items(spark, d, with_parts=not few), d, derive, written=True)


def shown(table, parts, *columns):
    return plain(table.read().select(F.lit(parts).cast("bigint").alias("parts"), *columns))


def with_parts(sql: str, touched: str | None = None) -> str:
    """The rows of a merge with the number of parts that it rewrote: those of changed rows."""
    hit = touched or f"select ID from merged where _DELTA_UPDATED_ON = '{RUN}'"
    return (f"with merged as ({sql}) select *, (select count(distinct {PART}) from ({hit})) as parts from merged")


_DAY_ONLY = {"_DELTA_CREATED_ON": f"'{OLD}'",
             "_DELTA_UPDATED_ON": f"case when o.DOCUMENT_DATE {IN_DAY} then '{RUN}' else '{OLD}' end"}


@query("extract_by_bucket", with_parts(bind.with_tables(
    "lines orders_b parts", merging._extract_sql(merging.EXTRACTED | _DAY_ONLY), org=ORG_SQL)))
def extract_by_bucket(spark, d):
    """All lines of two years, then those of a day again."""
    raw = raw_tables(spark, d)
    empty = spark.createDataFrame([], EXTRACT_SCHEMA)
    table = bucketed(spark, extract.extract_items(raw, empty.schema, merging.START, merging.END,
                                                  F.lit(OLD).cast("timestamp")), d)
    batch = materialize(extract.extract_items(raw, empty.schema, DAY_START, DAY_END, now()), "extract")
    parts = table.merge(batch, lambda items, rows: extract.merge(items, rows, now()))
    return merging.whole_row(table.read()).withColumn("parts", F.lit(parts).cast("bigint"))


FEW = "P_KEY < 3"


@query("import_by_bucket", with_parts(bind.ORACLE["import_items"].replace(
    "from parts\n    qualify", f"from parts where {FEW}\n    qualify")))
def import_by_bucket(spark, d):
    """The answers to two texts."""
    table = bucketed_items(spark, d)
    feed = merging.lower_feed(spark, d).where("PREDICATION_LASTUPDATED_AT < timestamp_ntz'2024-01-04'")
    answers = materialize(vendor.feed_to_report(feed), "vendor-answers")
    updates = materialize(vendor.import_batch(table.read(), answers), "vendor-items")
    parts = table.merge(updates, lambda items, rows: vendor.import_merge(items, rows, now()))
    return shown(table, parts, "ID", "DESCRIPTION", "EXTERNAL_PREDICATED_UNSPSC_FAMILY",
                 "EXTERNAL_PREDICATION_LASTUPDATED_AT", "_DELTA_UPDATED_ON")


@query("apply_by_bucket", with_parts(bind.ORACLE["apply_report"].replace(IN_WINDOW, IN_DAY)))
def apply_by_bucket(spark, d):
    """Stored answers for a day's items."""
    table = bucketed_items(spark, d)
    updates = materialize(vendor.apply_batch(table.read(), merging.vendor_report(spark, d), DAY_START, DAY_END),
                          "vendor-apply")
    parts = table.merge(updates, lambda items, rows: vendor.apply_merge(items, rows, now()))
    return shown(table, parts, "ID", "DESCRIPTION", "EXTERNAL_PREDICATED_UNSPSC_CLASS",
                 "EXTERNAL_PREDICATION_LASTUPDATED_AT", "_DELTA_UPDATED_ON")


_INFERRED = bind.ORACLE["infer_items"].replace(IN_WINDOW, IN_DAY)


@query("infer_by_bucket", f"""{_INFERRED[:_INFERRED.rindex('from item_table t left join')].replace(
    'select t.ID', f'select (select count(distinct {PART}) from feature_rows) as parts, t.ID')
    }{_INFERRED[_INFERRED.rindex('from item_table t left join'):]}""")
def infer_by_bucket(spark, d):
    """Predictions for a day's items."""
    table = bucketed_items(spark, d)
    report = merging.prediction_report(table.read(), DAY_START, DAY_END)
    updates = materialize(inference.batch(table.read(), report, merging.length_scorer, "M1", DAY_START, DAY_END, now=now()),
                          "predictions")
    parts = table.merge(updates, lambda items, rows: inference.merge(items, rows, now()))
    return shown(table, parts, *C.OWN_PREDICTION, "_DELTA_UPDATED_ON")


@query("load_by_bucket", with_parts(bind.ORACLE["load_dimension"].replace(
    f"between timestamp '{bind.START}' - interval 7 day and timestamp '{bind.END}'",
    f"between timestamp '{DAY_START}' - interval 7 day and timestamp '{DAY_END}'")))
def load_by_bucket(spark, d):
    """The products of a day and the week before."""
    items = merging._reported(spark, d)
    table = bucketed(spark, merging._first_dimension(items), d)
    rows = materialize(star.dimension_rows(items, DAY_START, DAY_END), "dimension")
    parts = table.merge(rows, lambda dimension, batch: star.merge(dimension, batch, now()))
    return shown(table, parts, "ID", "PO_ITEM_ID", "UNSPSC_COMMODITY", *C.AUDIT)
