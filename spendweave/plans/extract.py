"""Purchase lines with their order, document, commodity and parties."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions.measures import run_moment
from ..operators.clean import align
from ..operators.dedup import keep_first
from ..operators.joins import key_filter, maybe_in, semi_filter
from ..operators.upsert import upsert
from ..session import materialize
from ..sources.readers import Moment, in_window, project


def _same_type(df: DataFrame, column: str, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` that may have a key of ``batch``; all of them where a join would have to
    convert one of the keys."""
    if df.schema[column].dataType != batch.schema[key].dataType:
        return df
    bits = materialize(key_filter(batch, key), "key-filter")
    return maybe_in(df, column, bits)


def join_sources(po_item: DataFrame, po: DataFrame, document: DataFrame,
                 item_commodity: DataFrame, org: DataFrame) -> DataFrame:
    """Lines of the given orders and documents, one row per commodity of a line.

    The batch's orders, documents and parties meet first and are written, and
    so are their lines. The two tables read in full, lines and commodities, then join
    a side of measured size: a daily batch is broadcast and neither of them is
    shuffled. Of a larger batch a filter of its keys is broadcast, so that few
    of the other rows are moved.
    """
    headers = po.join(document, po["GENERIC_DOCUMENT_ID"] == document["CXML_DOCUMENT_ID"])
    for party in ("BUYER", "SUPPLIER"):
        side = org.select(F.col("ORG_ID").alias("__org"), F.col("NAME").alias(f"{party}_NAME"),
                          F.col("ANID").alias(f"{party}_ANID"))
        headers = headers.join(side, headers[f"{party}_ORG"] == side["__org"], "left").drop("__org")
    headers = materialize(headers, "headers")
    near = _same_type(po_item, "PO_ID", headers, "ID")
    lines = materialize(
        near.join(headers, near["PO_ID"] == headers["ID"]).drop("ID"), "lines")
    wanted = semi_filter(_same_type(item_commodity, "PO_ITEM", lines, "PO_ITEM_ID"), lines, "PO_ITEM", "PO_ITEM_ID")
    return lines.join(wanted, lines["PO_ITEM_ID"] == wanted["PO_ITEM"], "left").drop("PO_ITEM")


def with_item_key(df: DataFrame) -> DataFrame:
    """``ID`` = line and commodity number; 0 stands for no commodity."""
    numbered = df.fillna({"PO_ITEM_COMMODITY_ID": 0})
    return numbered.withColumn("ID", F.concat_ws("-", "PO_ITEM_ID", "PO_ITEM_COMMODITY_ID"))


def extract_items(raw: Mapping[str, DataFrame], target_schema, start: Moment, end: Moment,
                  now: Column | None = None) -> DataFrame:
    """The batch's items in the target's shape.

    Orders and documents are taken by update time, lines, commodities and
    organisations in full. Enrichment columns are NULL: a re-extracted item is
    enriched again.
    """
    orders = in_window(raw["po"], start, end).where("IS_BLANKET = 0")
    documents = in_window(raw["cxml_document"], start, end)
    joined = join_sources(project(raw["po_item"], C.PO_ITEM), project(orders, C.PO),
                          project(documents, C.DOCUMENT),
                          project(raw["po_item_commodity"], C.PO_ITEM_COMMODITY),
                          project(raw["org"], C.ORG))
    keyed = with_item_key(joined).withColumnRenamed("CODE", "AN_UNSPSC_COMMODITY")
    moment = run_moment(now)
    shaped = align(keyed, target_schema, {name: moment for name in C.AUDIT})
    return keep_first(shaped, "ID")


def merge(items: DataFrame, extracted: DataFrame, now: Column | None = None) -> DataFrame:
    return upsert(items, extracted, "ID", unique=True, now=run_moment(now))


def run(raw: Mapping[str, DataFrame], items: DataFrame, start: Moment | None, end: Moment,
        now: Column | None = None) -> DataFrame:
    """The item table with the batch merged in."""
    now = run_moment(now)
    return merge(items, materialize(extract_items(raw, items.schema, start, end, now), "extract"), now)
