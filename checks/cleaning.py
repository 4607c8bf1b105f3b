"""Scans, filters, missing values, duplicates."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Observation
from pyspark.sql import functions as F

from spendweave.columns import NA_SPELLINGS
from spendweave.functions import text
from spendweave.operators import clean, dedup, joins
from spendweave.plans import features
from spendweave.sources import readers

from . import bind
from .bind import END, START, plain, query, sql_time, with_tables

SPELLED = ", ".join(f"'{value}'" for value in NA_SPELLINGS)


@query("scan_projected", """
    select l_orderkey as PO_ID, l_partkey as PART, l_quantity as QUANTITY
    from lineitem where l_shipdate >= timestamp '1998-01-01' and l_returnflag <> 'N'""")
def scan_projected(spark, d):
    lineitem = bind.table(spark, d, "lineitem")
    return readers.project(
        lineitem, ["l_orderkey as PO_ID", "l_partkey as PART", "l_quantity as QUANTITY"],
        "l_shipdate >= timestamp_ntz'1998-01-01' and l_returnflag <> 'N'")


@query("scan_window", f"""
    select o_orderkey, {sql_time('o_orderdate')} from orders
    where o_orderdate between timestamp '{START}' and timestamp '{END}'""")
def scan_window(spark, d):
    orders = bind.table(spark, d, "orders")
    return plain(readers.in_window(orders, START, END, "o_orderdate")
                 .select("o_orderkey", "o_orderdate"))


@query("scan_late_arrivals", f"""
    select o_orderkey, {sql_time('o_orderdate')} from orders
    where o_orderdate between timestamp '{START}' - interval 7 day and timestamp '{END}'""")
def scan_late_arrivals(spark, d):
    orders = bind.table(spark, d, "orders")
    return plain(readers.in_window(orders, START, END, "o_orderdate", timedelta(days=7))
                 .select("o_orderkey", "o_orderdate"))


@query("scan_whole_table", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def scan_whole_table(spark, d):
    return readers.load_table(f"{d}/supplier.parquet", "parquet", spark)


@query("scan_unpredicted", with_tables("items", """
    select ID, PO_ITEM_ID from items where VENDOR_CODE is null"""))
def scan_unpredicted(spark, d):
    items = bind.items(spark, d).withColumn("EXTERNAL_PREDICATION_LASTUPDATED_AT",
                                            F.expr("case when VENDOR_CODE is not null "
                                                   "then DOCUMENT_DATE end"))
    return readers.unpredicted(items, ["ID", "PO_ITEM_ID", "EXTERNAL_PREDICATION_LASTUPDATED_AT"]
                               ).select("ID", "PO_ITEM_ID")


@query("valid_reference_codes", with_tables("commodity", """
    select distinct CODE from commodity where VALID = 1"""))
def valid_reference_codes(spark, d):
    from spendweave.operators.reconcile import valid_codes
    return valid_codes(bind.commodity(spark, d))


@query("instruction_transform", with_tables("items", """
    select ID, ITEM_TYPE as KIND, DESCRIPTION as TEXT, BUYER_ORG from items
    where DASHBOARD_STATUS in ('PO_NEW', 'PO_SHIPPED') and IS_BLANKET = 0
      and CODE is not null and regexp_matches(DESCRIPTION, 'ring|gear')
      and ITEM_TYPE not in ('PROMO', 'LARGE') and contains(DESCRIPTION, 'Brand')
      and not contains(MANUFACTURER_PART, '7')"""))
def instruction_transform(spark, d):
    return clean.transform(bind.items(spark, d), {
        "filter": {"DASHBOARD_STATUS": ["PO_NEW", "PO_SHIPPED"], "IS_BLANKET": 0,
                   "CODE": "NOT NULL"},
        "regex_pattern_filter": {"DESCRIPTION": "ring|gear"},
        "ne_filter": {"ITEM_TYPE": ["PROMO", "LARGE"], "ID": "a scalar is ignored"},
        "contains_char_filter": {"DESCRIPTION": "Brand"},
        "not_contains_char_filter": {"MANUFACTURER_PART": "7"},
        "sort_values": {"sort_columns": ["ITEM_TYPE", "ID"], "is_ascending": [False, True]},
        "rename": {"ITEM_TYPE": "KIND", "DESCRIPTION": "TEXT"},
        "select": ["ID", "KIND", "TEXT", "BUYER_ORG"]})


@query("null_filter", with_tables("items", """
    select ID, ITEM_TYPE from items where DESCRIPTION is null"""))
def null_filter(spark, d):
    return clean.transform(bind.items(spark, d), {"filter": {"DESCRIPTION": None},
                                                  "select": ["ID", "ITEM_TYPE"]})


@query("prefix_columns", """
    select c_custkey as src_c_custkey, c_name as src_c_name, c_nationkey as src_c_nationkey,
           c_acctbal as src_c_acctbal, c_mktsegment as src_c_mktsegment from customer""")
def prefix_columns(spark, d):
    return clean.prefix_columns(bind.table(spark, d, "customer"), "src")


@query("union_distinct", """
    select l_partkey as K, l_suppkey as S from lineitem where l_returnflag = 'R'
    union select l_partkey, l_suppkey from lineitem where l_linestatus = 'F'""")
def union_distinct(spark, d):
    lineitem = bind.table(spark, d, "lineitem")
    left = lineitem.where("l_returnflag = 'R'").selectExpr("l_partkey as K", "l_suppkey as S")
    right = lineitem.where("l_linestatus = 'F'").selectExpr("l_suppkey as S", "l_partkey as K")
    return clean.union_all(left, right)


@query("union_all", """
    select c_custkey as K, c_name as N from customer
    union all select s_suppkey, s_name from supplier""")
def union_all(spark, d):
    return clean.union_all(
        bind.table(spark, d, "customer").selectExpr("c_custkey as K", "c_name as N"),
        bind.table(spark, d, "supplier").selectExpr("s_name as N", "s_suppkey as K"),
        distinct=False)


_UNIFIED = """case when coalesce({0}, 'N/A') in (""" + SPELLED + """) then 'none'
    else coalesce({0}, 'N/A') end as {0}"""


@query("unify_na", with_tables("items", f"""
    select ID, {_UNIFIED.format('DESCRIPTION')}, {_UNIFIED.format('MANUFACTURER_NAME')},
           {_UNIFIED.format('SUPPLIER_PART')} from items"""))
def unify_na(spark, d):
    items = bind.items(spark, d).select("ID", "DESCRIPTION", "MANUFACTURER_NAME", "SUPPLIER_PART")
    return clean.unify_na(items, ["DESCRIPTION", "MANUFACTURER_NAME", "SUPPLIER_PART"],
                          NA_SPELLINGS, "none")


@query("unify_and_filter_na", with_tables("items", f"""
    select * from (select ID, {_UNIFIED.format('DESCRIPTION').replace("'none'", "'N/A'")},
        {_UNIFIED.format('MANUFACTURER_NAME').replace("'none'", "'N/A'")} from items)
    where not contains(DESCRIPTION, 'N/A')"""))
def unify_and_filter_na(spark, d):
    return clean.unify_and_filter_na(
        bind.items(spark, d).select("ID", "DESCRIPTION", "MANUFACTURER_NAME"),
        {"columns": ["DESCRIPTION", "MANUFACTURER_NAME"], "na_vals_list": list(NA_SPELLINGS),
         "replacement_val": "N/A",
         "na_filter_instructions": {"not_contains_char_filter": {"DESCRIPTION": "N/A"}}})


@query("drop_missing", with_tables("items", """
    select ID, DESCRIPTION, CODE, MANUFACTURER_PART from items
    where (DESCRIPTION is not null)::int + (CODE is not null)::int
        + (MANUFACTURER_PART is not null)::int >= 2"""))
def drop_missing(spark, d):
    items = bind.items(spark, d).select("ID", "DESCRIPTION", "CODE", "MANUFACTURER_PART")
    return clean.drop_missing(items, {"thresh": 2,
                                      "subset": ["DESCRIPTION", "CODE", "MANUFACTURER_PART"]})


@query("fill_missing", with_tables("items", """
    select ID, coalesce(DESCRIPTION, '-') as DESCRIPTION, CODE,
           coalesce(MANUFACTURER_PART, '-') as MANUFACTURER_PART from items"""))
def fill_missing(spark, d):
    items = bind.items(spark, d).select("ID", "DESCRIPTION", "CODE", "MANUFACTURER_PART")
    return clean.fill_missing(items, {"value": "-", "subset": ["DESCRIPTION",
                                                               "MANUFACTURER_PART"]})


@query("first_per_key", with_tables("items", """
    select PO_ITEM_ID, ID, DESCRIPTION from items
    qualify row_number() over (partition by PO_ITEM_ID
                               order by _DELTA_UPDATED_ON desc, ID) = 1"""))
def first_per_key(spark, d):
    kept = dedup.keep_first(bind.items(spark, d), "PO_ITEM_ID",
                            [F.col("_DELTA_UPDATED_ON").desc(), "ID"])
    return kept.select("PO_ITEM_ID", "ID", "DESCRIPTION")


@query("latest_per_key", f"""
    select user_id, event_id, event_type, {sql_time('ts')} from events
    qualify row_number() over (partition by user_id order by ts desc, event_id) = 1""")
def latest_per_key(spark, d):
    latest = dedup.latest_per_key(bind.table(spark, d, "events"), "user_id", "ts", ["event_id"])
    return plain(latest.select("user_id", "event_id", "event_type", "ts"))


@query("two_stage_duplicates", with_tables("items", """
    select * from (
        select PO_ITEM_ID, SUPPLIER_ORG, DESCRIPTION, ITEM_TYPE, ID from items
        qualify row_number() over (partition by PO_ITEM_ID order by ID) = 1)
    qualify row_number() over (partition by SUPPLIER_ORG, DESCRIPTION, ITEM_TYPE order by ID) = 1
    """))
def two_stage_duplicates(spark, d):
    items = bind.items(spark, d).select("PO_ITEM_ID", "SUPPLIER_ORG", "DESCRIPTION",
                                        "ITEM_TYPE", "ID")
    return clean.drop_duplicates(items, {"index_col": ["PO_ITEM_ID"],
                                         "cat_cols": ["SUPPLIER_ORG", "DESCRIPTION",
                                                      "ITEM_TYPE"]}, ["ID"])


@query("whole_row_duplicates", "select distinct l_partkey, l_returnflag from lineitem")
def whole_row_duplicates(spark, d):
    rows = bind.table(spark, d, "lineitem").select("l_partkey", "l_returnflag")
    return clean.drop_duplicates(rows, {"index_col": None, "cat_cols": []})


_SCORING_TEXT = ("SUPPLIER_ORG", "BUYER_ORG", "PO_ITEM_ID", "DESCRIPTION", "SUPPLIER_PART",
                 "MANUFACTURER_PART", "MANUFACTURER_NAME", "ITEM_TYPE", "IS_ADHOC")


def _unified(name: str) -> str:
    value = f"coalesce(cast({name} as varchar), 'N/A')"
    return f"case when {value} in ({SPELLED}) then 'N/A' else {value} end as {name}"


CLEANED = f"""select ID, {', '.join(_unified(name) for name in _SCORING_TEXT)} from items"""


@query("clean_items", with_tables("items", """
    select distinct * from cleaned
    where not contains(DESCRIPTION, 'N/A') and not contains(PO_ITEM_ID, 'N/A')""",
    cleaned=CLEANED))
def clean_items(spark, d):
    return clean.clean_items(bind.items(spark, d), features.SCORING_CLEANING)


@query("clean_training_items", with_tables("items", """
    select * exclude (ID) from (
        select * from (
            select * from cleaned
            where not contains(DESCRIPTION, 'N/A') and not contains(PO_ITEM_ID, 'N/A'))
        qualify row_number() over (partition by PO_ITEM_ID order by ID) = 1)
    qualify row_number() over (partition by SUPPLIER_ORG, BUYER_ORG, DESCRIPTION, SUPPLIER_PART,
        MANUFACTURER_PART, MANUFACTURER_NAME, ITEM_TYPE, IS_ADHOC order by ID) = 1""",
    cleaned=CLEANED))
def clean_training_items(spark, d):
    config = features.TRAINING_CLEANING
    config = clean.Cleaning(
        {"select": ["ID", *_SCORING_TEXT]}, config.handle_str_na_vals,
        {"index_col": ["PO_ITEM_ID"],
         "cat_cols": [name for name in _SCORING_TEXT if name != "PO_ITEM_ID"]},
        config.handle_missing_vals)
    return clean.clean_items(bind.items(spark, d), config, ["ID"]).drop("ID")


@query("stage_counts", with_tables("items", """
    select (select count(*) from items) as selected, (select count(*) from kept) as na_filtered,
           (select count(*) from (select distinct * from kept)) as deduplicated,
           (select count(*) from (select distinct * from kept)) as result_rows""",
    cleaned=CLEANED,
    kept="select * from cleaned where not contains(DESCRIPTION, 'N/A') "
         "and not contains(PO_ITEM_ID, 'N/A')"))
def stage_counts(spark, d):
    counts = {step: Observation(step) for step in ("selected", "na_filtered", "deduplicated")}
    cleaned = clean.clean_items(bind.items(spark, d), features.SCORING_CLEANING, counts=counts)
    total = cleaned.count()
    steps = [F.lit(seen.get["rows"]).cast("bigint").alias(step) for step, seen in counts.items()]
    return spark.range(1).select(*steps, F.lit(total).cast("bigint").alias("result_rows"))


@query("legal_codes", with_tables("items commodity", """
    select ID, CODE, substr(CODE, 1, 2) as SEGMENT, substr(CODE, 3, 2) as FAMILY,
           substr(CODE, 5, 2) as CLASS, substr(CODE, 7, 2) as COMMODITY
    from items where regexp_full_match(CODE, '[0-9]{8}') and CODE <> '00000000'
      and substr(CODE, 1, 2) <> '00' and substr(CODE, 3, 2) <> '00'
      and substr(CODE, 5, 2) <> '00' and CODE in (select CODE from commodity)"""))
def legal_codes(spark, d):
    items = bind.items(spark, d).select("ID", "CODE")
    return clean.legal_codes(items, bind.commodity(spark, d).select("CODE"))


@query("concat_feature", with_tables("items", """
    select ID, concat_ws(' ', SUPPLIER_ORG, BUYER_ORG, DESCRIPTION, MANUFACTURER_NAME, ITEM_TYPE,
                         IS_ADHOC) as CONCAT_FEATURE from items"""))
def concat_feature(spark, d):
    return features.with_feature(bind.items(spark, d)).select("ID", "CONCAT_FEATURE")


CLEAN_SQL = """trim(array_to_string(list_filter(words, lambda x, i: list_position(words, x) = i),
    ' '))"""
WORDS_SQL = r"""string_split(lower(regexp_replace(coalesce({0}, ''),
    '[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{{|}}~]', ' ', 'g')), ' ')"""


@query("clean_description", f"""
    select id, {CLEAN_SQL} as cleaned, length({CLEAN_SQL}) as n from (
        select concat('D', cast(doc_id as varchar)) as id, {WORDS_SQL.format('text')} as words
        from documents
        union all
        select concat('P', cast(p_partkey as varchar)), {WORDS_SQL.format(bind.DESCRIPTION)}
        from part)""")
def clean_description(spark, d):
    documents = bind.table(spark, d, "documents").selectExpr(
        "concat('D', cast(doc_id as string)) as id", "text")
    parts = bind.parts(spark, d).selectExpr("concat('P', cast(P_KEY as string)) as id",
                                            "DESCRIPTION as text")
    cleaned = documents.unionByName(parts).select(
        "id", text.clean_description(F.col("text")).alias("cleaned"))
    return cleaned.withColumn("n", F.length("cleaned").cast("bigint"))


@query("distinct_words", """
    select doc_id, array_to_string(list_filter(words, lambda x, i: list_position(words, x) = i),
                                   '|') as words
    from (select doc_id, string_split(text, ' ') as words from documents)""")
def distinct_words(spark, d):
    return bind.table(spark, d, "documents").select(
        "doc_id", F.concat_ws("|", text.distinct_words(F.col("text"))).alias("words"))


@query("rate_description", with_tables("parts", r"""
    select P_KEY, cleaned, case when least(a, b, c) < 3 then 'Poor'
                                when a > 15 and b > 15 and c > 15 then 'Good'
                                else 'Acceptable' end as quality
    from (select P_KEY, cleaned, length(regexp_replace(cleaned, '[^0-9a-z]', '', 'g')) as a,
                 length(regexp_replace(cleaned, '[^a-z]', '', 'g')) as b, length(cleaned) as c
          from (select P_KEY, """ + CLEAN_SQL + """ as cleaned from (
                select P_KEY, """ + WORDS_SQL.format("DESCRIPTION") + """ as words
                from parts)))"""))
def rate_description(spark, d):
    from spendweave.operators.reconcile import rate_descriptions
    return rate_descriptions(bind.parts(spark, d)).select(
        "P_KEY", F.col("PROCESSED_DESCRIPTION").alias("cleaned"),
        F.col("AN_DATA_QUALITY_LEVEL").alias("quality"))


@query("semi_filter", with_tables("items commodity", """
    select ID, CODE from items where CODE in (select CODE from commodity where VALID = 1)"""))
def semi_filter(spark, d):
    return joins.semi_filter(bind.items(spark, d).select("ID", "CODE"),
                             bind.commodity(spark, d).where("VALID = 1"), "CODE", "CODE")
