"""Upserts, row maintenance, batch offsets and the plans that end in a merge."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from spendweave import columns as C
from spendweave.functions import codes
from spendweave.operators import upsert as merge
from spendweave.plans import (by_month, evaluate, extract, finalize, inference, network, replicate, star,
                              vendor)
from spendweave.session import materialize, shared_folder
from spendweave import schemas
from spendweave.sources import offsets, tables
from spendweave.sources.readers import in_window

from . import bind
from .bind import END, LEVELS, START, plain, query, sql_time, with_tables
from .coding import (DERIVED, NETWORK_SQL, ORG_SQL, STRIPPED, confidence_sql, level_sql,
                     raw_tables, vendor_feed)

RUN = "2024-06-01 00:00:00"


def now():
    return F.lit(RUN).cast("timestamp")


IN_WINDOW = f"between timestamp '{START}' and timestamp '{END}'"
AUDIT_SQL = f"{sql_time('_DELTA_CREATED_ON')}, {sql_time('_DELTA_UPDATED_ON')}"

# -- generic -------------------------------------------------------------------------------

TARGET = ("c_custkey as ID", "c_name as NAME",
          "case when c_custkey % 10 = 0 then cast(null as string) else c_mktsegment end as SEGMENT",
          "c_nationkey as NATION", "timestamp_ntz'2001-01-01' as _DELTA_CREATED_ON",
          "timestamp_ntz'2001-01-01' as _DELTA_UPDATED_ON")
SOURCE = ("c_custkey as ID", "concat(c_name, '*') as NAME",
          "case when c_custkey % 4 = 0 then 'NEW' else c_mktsegment end as SEGMENT",
          "c_nationkey as NATION")


def target(spark, d):
    return bind.table(spark, d, "customer").where("c_custkey % 3 <> 0").selectExpr(*TARGET)


def source(spark, d):
    return bind.table(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr(*SOURCE)


def merged_sql(when: str = "true", columns=("NAME", "SEGMENT", "NATION"), insert: bool = True) -> str:
    """The merge spelled out as a full or left join."""
    hit = f"(s.ID is not null and t.ID is not null and coalesce({when}, false))"
    shown = ", ".join(
        f"case when t.ID is null then s.{c} when {hit} then s.{c} else t.{c} end as {c}"
        if c in columns else f"case when t.ID is null then s.{c} else t.{c} end as {c}"
        for c in ("NAME", "SEGMENT", "NATION"))
    return f"""
        with t as (select {', '.join(TARGET).replace('timestamp_ntz', 'timestamp ')}
                   from customer where c_custkey % 3 <> 0),
             s as (select {', '.join(SOURCE)} from customer where c_custkey % 2 = 0)
        select coalesce(t.ID, s.ID) as ID, {shown},
               case when t.ID is null then '{RUN}' else '2001-01-01 00:00:00' end
                 as _DELTA_CREATED_ON,
               case when t.ID is null or {hit} then '{RUN}' else '2001-01-01 00:00:00' end
                 as _DELTA_UPDATED_ON
        from t {'full' if insert else 'left'} join s on t.ID = s.ID"""


@query("upsert_full", merged_sql())
def upsert_full(spark, d):
    return plain(merge.upsert(target(spark, d), source(spark, d), "ID", now=now()))


@query("upsert_one_pass", merged_sql())
def upsert_one_pass(spark, d):
    return plain(merge.upsert(target(spark, d), source(spark, d), "ID", now=now(),
                              one_pass=True))


@query("upsert_changed", merged_sql("t.SEGMENT is null or s.SEGMENT <> t.SEGMENT"))
def upsert_changed(spark, d):
    return plain(merge.upsert(target(spark, d), source(spark, d), "ID", now=now(),
                              when="target.SEGMENT is null or source.SEGMENT <> target.SEGMENT"))


@query("update_only", merged_sql(columns=("SEGMENT",), insert=False))
def update_only(spark, d):
    return plain(merge.upsert(target(spark, d), source(spark, d), "ID", now=now(), insert=False,
                              update={"SEGMENT": "source.SEGMENT"}))


#: Among NULLs that match each other a source may hold one only.
ONE_NULL = "(ID % 14 > 0 or ID = 14)"


def _null_keys(spark, d, kept: str = "true"):
    keyed = target(spark, d).withColumn("ID", F.expr("case when ID % 7 > 0 then ID end"))
    rows = source(spark, d).where(kept).withColumn("ID", F.expr("case when ID % 14 > 0 then ID end"))
    return keyed, rows


@query("upsert_null_keys", f"""
    with t as (select {', '.join(TARGET).replace('timestamp_ntz', 'timestamp ')}
               from customer where c_custkey % 3 <> 0),
         t2 as (select * replace (case when ID % 7 > 0 then ID end as ID) from t),
         s as (select * replace (case when ID % 14 > 0 then ID end as ID)
               from (select {', '.join(SOURCE)} from customer where c_custkey % 2 = 0))
    select coalesce(t2.ID, s.ID) as ID, coalesce(s.NAME, t2.NAME) as NAME,
           case when t2.NAME is null then '{RUN}' else '2001-01-01 00:00:00' end
             as _DELTA_CREATED_ON
    from t2 full join s on t2.ID = s.ID""")
def upsert_null_keys(spark, d):
    keyed, rows = _null_keys(spark, d)
    return plain(merge.upsert(keyed, rows, "ID", now=now()).select("ID", "NAME",
                                                                  "_DELTA_CREATED_ON"))


@query("upsert_null_safe", f"""
    with t as (select {', '.join(TARGET).replace('timestamp_ntz', 'timestamp ')}
               from customer where c_custkey % 3 <> 0),
         t2 as (select * replace (case when ID % 7 > 0 then ID end as ID) from t),
         s as (select * replace (case when ID % 14 > 0 then ID end as ID)
               from (select {', '.join(SOURCE)} from customer where c_custkey % 2 = 0)
               where {ONE_NULL})
    select coalesce(t2.ID, s.ID) as ID, coalesce(s.NAME, t2.NAME) as NAME,
           case when t2.NAME is null then '{RUN}' else '2001-01-01 00:00:00' end
             as _DELTA_CREATED_ON
    from t2 full join s on t2.ID is not distinct from s.ID""")
def upsert_null_safe(spark, d):
    keyed, rows = _null_keys(spark, d, ONE_NULL)
    merged = merge.upsert(keyed, rows, "ID", now=now(), null_safe=True)
    return plain(merged.select("ID", "NAME", "_DELTA_CREATED_ON"))


@query("upsert_new_columns", """
    select coalesce(c.c_custkey, 40 * s.s_suppkey) as ID, coalesce(s.s_name, c.c_name) as NAME,
           s.s_acctbal as BALANCE
    from customer c full join supplier s on c.c_custkey = 40 * s.s_suppkey""")
def upsert_new_columns(spark, d):
    customers = bind.table(spark, d, "customer").selectExpr("c_custkey as ID", "c_name as NAME")
    suppliers = bind.table(spark, d, "supplier").selectExpr(
        "40 * s_suppkey as ID", "s_name as NAME", "s_acctbal as BALANCE")
    return merge.upsert(customers, suppliers, "ID", merge_schema=True)


@query("insert_absent", """
    select c_custkey as ID, c_name as NAME from customer where c_custkey % 3 <> 0
    union all select c_custkey, concat(c_name, '*') from customer
    where c_custkey % 2 = 0 and c_custkey % 3 = 0""")
def insert_absent(spark, d):
    return merge.insert_absent(target(spark, d).select("ID", "NAME"),
                               source(spark, d).select("ID", "NAME"), "ID")


@query("record_models", """
    select concat('M', cast(user_id as varchar)) as NAME, count(*) as VERSION, 'old' as STAGE
    from events where user_id % 2 = 0 group by user_id
    union all select concat('M', cast(user_id as varchar)), count(*), 'new'
    from events where user_id % 2 = 1 and user_id % 5 = 0 group by user_id""")
def record_models(spark, d):
    uses = bind.table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("VERSION"))
    named = uses.select("user_id", F.concat(F.lit("M"), F.col("user_id").cast("string"))
                        .alias("NAME"), "VERSION")
    known = named.where("user_id % 2 = 0").select("NAME", "VERSION", F.lit("old").alias("STAGE"))
    seen = named.where("user_id % 5 = 0").select("NAME", "VERSION", F.lit("new").alias("STAGE"))
    return replicate.record_models(known, seen)


@query("rows_updated", """
    select o_orderkey, case when o_totalprice > 300000 then 'BIG' else o_orderpriority end
             as o_orderpriority from orders""")
def rows_updated(spark, d):
    orders = bind.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return merge.update_rows(orders, {"o_orderpriority": "'BIG'"},
                             "o_totalprice > 300000").drop("o_totalprice")


@query("rows_deleted", "select o_orderkey from orders where o_orderstatus <> 'F'")
def rows_deleted(spark, d):
    return merge.delete_rows(bind.table(spark, d, "orders"), "o_orderstatus = 'F'").select(
        "o_orderkey")


@query("rows_inserted", """
    select c_custkey, c_name, c_acctbal from customer
    union all select s_suppkey, s_name, null from supplier""")
def rows_inserted(spark, d):
    customers = bind.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    suppliers = bind.table(spark, d, "supplier").selectExpr("s_suppkey as c_custkey",
                                                            "s_name as c_name")
    return merge.insert_rows(customers, suppliers)


@query("job_windows", f"""
    select event_type as JOB, case when event_type = 'error' then null
             else strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') end as START_AT
    from events group by event_type""")
def job_windows(spark, d):
    stored = bind.table(spark, d, "events").groupBy(F.col("event_type").alias("JOB")).agg(
        F.max("ts").cast("timestamp").alias("OFFSET_AT")).withColumn("RESET_FLAG", F.lit(0))
    return plain(offsets.job_windows(offsets.request_reset(stored, "error")))


@query("first_run", "select o_orderkey from orders where o_orderdate <= timestamp '1997-06-30'")
def first_run(spark, d):
    """A job that never ran reads everything up to the end."""
    from datetime import datetime
    stored = spark.createDataFrame([], schemas.JOB_OFFSET)
    start, end = offsets.batch_window(stored, "network", end=datetime(1997, 6, 30))
    return in_window(bind.table(spark, d, "orders"), start, end, "o_orderdate").select("o_orderkey")


@query("commit_offset", f"""
    select event_type as JOB, case when event_type = 'view' then '{RUN}'
             else strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') end as OFFSET_AT,
           0 as RESET_FLAG from events group by event_type
    union all select 'fresh', '{RUN}', 0""")
def commit_offset(spark, d):
    from datetime import datetime
    stored = bind.table(spark, d, "events").groupBy(F.col("event_type").alias("JOB")).agg(
        F.max("ts").alias("OFFSET_AT")).withColumn("RESET_FLAG", F.lit(0))
    end = datetime.fromisoformat(RUN)
    return plain(offsets.commit_offset(offsets.commit_offset(stored, "view", end), "fresh", end))


# -- plans -----------------------------------------------------------------------------------

#: The whole item row; a line's id is text here.
EXTRACT_SCHEMA = schemas.ITEM.replace("PO_ITEM_ID decimal(28,0)", "PO_ITEM_ID string")

#: What the extract knows of an item; all other columns are still NULL.
EXTRACTED = {
    "ID": "concat(l.ID, '-', cast(case when p.CODE is null then 0 else l.P_KEY end as varchar))",
    "PO_ITEM_ID": "l.ID", "PO_ID": "l.PO_ID",
    "PO_ITEM_COMMODITY_ID": "case when p.CODE is null then 0 else l.P_KEY end",
    "GENERIC_DOCUMENT_ID": "o.O_KEY + 5", "CXML_DOCUMENT_ID": "o.O_KEY + 5", "DESCRIPTION": "p.DESCRIPTION",
    "MANUFACTURER_PART": "l.MANUFACTURER_PART", "MANUFACTURER_NAME": "p.BRAND", "ITEM_TYPE": "p.ITEM_TYPE",
    "ITEM_CATEGORY": "'category'", "UNIT_OF_MEASURE": "l.UNIT_OF_MEASURE", "SUPPLIER_PART": "l.SUPPLIER_PART",
    "SUPPLIER_PART_NUMBER": "cast(l.SUPPLIER_ORG as varchar)", "SUPPLIER_PART_EXTENSION": "''",
    "DOMAIN": "case when p.CODE is not null then 'UNSPSC' end", "IS_BLANKET": "o.IS_BLANKET", "IS_ADHOC": "0",
    "SHIP_TO_COUNTRY": "concat('C', cast(o.O_KEY % 9 as varchar))", "SERVICE_TYPE": "'goods'",
    "BUYER_ORG": "o.BUYER_ORG", "SUPPLIER_ORG": "1000000 + o.O_KEY % 100", "BUYER_NAME": "b.NAME", "BUYER_ANID": "b.ANID",
    "SUPPLIER_NAME": "s.NAME", "SUPPLIER_ANID": "s.ANID", "DASHBOARD_STATUS": "o.DASHBOARD_STATUS",
    "DOCUMENT_DATE": "strftime(o.DOCUMENT_DATE, '%Y-%m-%d %H:%M:%S')",
    "CREATED_DATE": "strftime(o.DOCUMENT_DATE, '%Y-%m-%d %H:%M:%S')", "AN_UNSPSC_COMMODITY": "p.CODE",
    "_DELTA_CREATED_ON": f"case when o.DOCUMENT_DATE <= timestamp '1997-06-30' then '2001-01-01 00:00:00' else '{RUN}' end",
    "_DELTA_UPDATED_ON": f"'{RUN}'",
}


def _extract_sql(columns: dict[str, str]) -> str:
    kinds = dict(field.strip().rsplit(" ", 1) for field in EXTRACT_SCHEMA.replace("6,5", "6.5").split(","))
    empty = {name: "double" if kind.startswith("decimal") else "varchar" for name, kind in kinds.items()}
    shown = [f"{columns.get(name, f'cast(null as {kind})')} as {name}" for name, kind in empty.items()]
    return f"""
    select {', '.join(shown)}
    from lines l join parts p on l.P_KEY = p.P_KEY
    join orders_b o on l.PO_ID = o.O_KEY and o.IS_BLANKET = 0 and o.DOCUMENT_DATE {IN_WINDOW}
    left join org b on b.ORG_ID = o.BUYER_ORG
    left join org s on s.ORG_ID = 1000000 + o.O_KEY % 100"""


def whole_row(items):
    """All columns; integers that are NULL everywhere as text."""
    return plain(items.withColumns({name: F.col(name).cast("string") for name in
                                    ("BANNED_FROM_TRAINING", "BANNED_FROM_ENRICHMENT")}))


@query("extract_items", with_tables("lines orders_b parts", _extract_sql(EXTRACTED), org=ORG_SQL))
def extract_items(spark, d):
    """Two rounds: the first half year, then the whole window over its result."""
    raw = raw_tables(spark, d)
    empty = spark.createDataFrame([], EXTRACT_SCHEMA)
    first = materialize(extract.extract_items(raw, empty.schema, START, "1997-06-30",
                                              F.lit("2001-01-01").cast("timestamp")))
    return whole_row(extract.run(raw, first, START, END, now()))


@query("evaluate_merge", with_tables("item_table items commodity", f"""
    select t.ID, coalesce(e.PROCESSED_DESCRIPTION, t.PROCESSED_DESCRIPTION)
             as PROCESSED_DESCRIPTION,
           {', '.join(f'case when e.ID is not null then e.AN_UNSPSC_{level} '
                      f'else t.AN_UNSPSC_{level} end as AN_UNSPSC_{level}' for level in LEVELS)},
           case when e.ID is not null then e.QUALITY else t.AN_CLASSIFICATION_QUALITY_CLASS end
             as AN_CLASSIFICATION_QUALITY_CLASS,
           {sql_time('t._DELTA_CREATED_ON')},
           case when e.ID is not null then '{RUN}'
                else strftime(t._DELTA_UPDATED_ON, '%Y-%m-%d %H:%M:%S') end as _DELTA_UPDATED_ON
    from item_table t left join (
        select e.* from evaluated e join item_table t using (ID)
        where t._DELTA_UPDATED_ON {IN_WINDOW}
          and (e.PROCESSED_DESCRIPTION <> t.PROCESSED_DESCRIPTION
               or t.AN_CLASSIFICATION_QUALITY_COMMODITY is null
               or e.QUALITY <> t.AN_CLASSIFICATION_QUALITY_COMMODITY
               or e.AN_UNSPSC_COMMODITY <> t.AN_UNSPSC_COMMODITY)) e using (ID)""",
    rated=f"""select i.ID, i.P, i.AN_UNSPSC_COMMODITY, case when v.CODE is null then 'Poor'
                  else 'Acceptable' end as QUALITY
              from (select ID, {STRIPPED.format('AN_UNSPSC_COMMODITY')} as AN_UNSPSC_COMMODITY,
                           DESCRIPTION as P from item_table) i
              left join (select distinct CODE from commodity where VALID = 1) v
                on i.AN_UNSPSC_COMMODITY = v.CODE""",
    evaluated=f"""select ID, QUALITY, trim(array_to_string(list_filter(w, lambda x, i:
                      list_position(w, x) = i), ' ')) as PROCESSED_DESCRIPTION, {DERIVED}
                  from (select *, string_split(lower(regexp_replace(coalesce(P, ''),
                      '[#,()/-]', ' ', 'g')), ' ') as w from rated)"""))
def evaluate_merge(spark, d):
    merged = evaluate.run(bind.item_table(spark, d), bind.commodity(spark, d), START, END, now())
    return plain(merged.select("ID", "PROCESSED_DESCRIPTION",
                               *[f"AN_UNSPSC_{level}" for level in LEVELS],
                               "AN_CLASSIFICATION_QUALITY_CLASS", *C.AUDIT))


CANDIDATES = f"""
    select PROCESSED_DESCRIPTION, DESCRIPTION, PO_ITEM_ID, MANUFACTURER_PART, MANUFACTURER_NAME,
           AN_UNSPSC_COMMODITY from item_table
    where _DELTA_UPDATED_ON {IN_WINDOW}
      and {' and '.join(f'EXTERNAL_PREDICATED_UNSPSC_{level} is null' for level in LEVELS)}
      and DASHBOARD_STATUS <> 'PO_OBSOLETED' and AN_DATA_QUALITY_LEVEL = 'Good'"""


@query("export_candidates", with_tables("item_table", """
    select PROCESSED_DESCRIPTION, min(PO_ITEM_ID) as PO_ITEM_ID from candidates
    group by PROCESSED_DESCRIPTION""", candidates=CANDIDATES))
def export_candidates(spark, d):
    return vendor.export_candidates(bind.item_table(spark, d), START, END).select(
        "PROCESSED_DESCRIPTION", "PO_ITEM_ID")


def vendor_report(spark, d):
    """Report with an answer for a third of the texts."""
    parts = bind.parts(spark, d).where("DESCRIPTION is not null").groupBy("DESCRIPTION").agg(
        F.min("P_KEY").alias("K"), F.max("CODE").alias("CODE"))
    return parts.selectExpr(
        "concat(DESCRIPTION, '!') as DESCRIPTION", "lower(DESCRIPTION) as PROCESSED_DESCRIPTION",
        *[f"substr(CODE, 1, {2 * n}) as UNSPSC_{level}"
          for n, level in enumerate(LEVELS, start=1)],
        *[f"cast(0.5 as decimal(6,5)) as CONFIDENCE_{level}" for level in LEVELS],
        "case when K % 3 = 0 then timestamp_ntz'2002-02-02' end as REPORT_LASTUPDATED_AT",
        "timestamp_ntz'2001-01-01' as _DELTA_CREATED_ON",
        "timestamp_ntz'2001-01-01' as _DELTA_UPDATED_ON")


REPORT = f"""
    select DESCRIPTION || '!' as DESCRIPTION, lower(DESCRIPTION) as PROCESSED_DESCRIPTION,
           {', '.join(f'substr(max(CODE), 1, {2 * n}) as UNSPSC_{level}'
                      for n, level in enumerate(LEVELS, start=1))},
           case when min(P_KEY) % 3 = 0 then timestamp '2002-02-02' end as REPORT_LASTUPDATED_AT
    from parts where DESCRIPTION is not null group by DESCRIPTION"""


@query("mark_exported", with_tables("item_table", f"""
    select PROCESSED_DESCRIPTION, REPORT_LASTUPDATED_AT is not null as ANSWERED,
           '2001-01-01 00:00:00' as _DELTA_CREATED_ON from report
    union all
    select PROCESSED_DESCRIPTION, false, '{RUN}'
    from (select distinct PROCESSED_DESCRIPTION from candidates c
          where not exists (select 1 from report r
                            where r.PROCESSED_DESCRIPTION = c.PROCESSED_DESCRIPTION))""",
    candidates=CANDIDATES,
    report="select * from (" + REPORT + ") where contains(PROCESSED_DESCRIPTION, 'ring')"))
def mark_exported(spark, d):
    report = vendor_report(spark, d).where("contains(PROCESSED_DESCRIPTION, 'ring')")
    rows = vendor.to_export(vendor.export_candidates(bind.item_table(spark, d), START, END),
                            report)
    marked = vendor.mark_exported(report, rows, now())
    return plain(marked.select("PROCESSED_DESCRIPTION",
                               F.col("REPORT_LASTUPDATED_AT").isNotNull().alias("ANSWERED"),
                               "_DELTA_CREATED_ON"))


FEED = """
    select DESCRIPTION || '!' as DESCRIPTION, lower(coalesce(DESCRIPTION, ''))
             as PROCESSED_DESCRIPTION, CODE,
           timestamp '2024-01-01' + to_days(cast(P_KEY as int)) as SENT_AT from parts
    qualify row_number() over (partition by lower(coalesce(DESCRIPTION, ''))
                               order by P_KEY desc) = 1"""


def lower_feed(spark, d):
    return vendor_feed(spark, d).withColumn("PROCESSED_DESCRIPTION",
                                            F.lower("PROCESSED_DESCRIPTION"))


@query("import_items", with_tables("item_table", f"""
    select t.ID, case when f.SENT_AT is not null then f.DESCRIPTION else t.DESCRIPTION end
             as DESCRIPTION,
           case when f.SENT_AT is not null then substr(f.CODE, 1, 4)
                else t.EXTERNAL_PREDICATED_UNSPSC_FAMILY end as EXTERNAL_PREDICATED_UNSPSC_FAMILY,
           strftime(coalesce(f.SENT_AT, t.EXTERNAL_PREDICATION_LASTUPDATED_AT), '%Y-%m-%d %H:%M:%S')
             as EXTERNAL_PREDICATION_LASTUPDATED_AT,
           case when f.SENT_AT is not null then '{RUN}'
                else strftime(t._DELTA_UPDATED_ON, '%Y-%m-%d %H:%M:%S') end as _DELTA_UPDATED_ON
    from item_table t left join feed f
      on t.PROCESSED_DESCRIPTION = f.PROCESSED_DESCRIPTION
         and t.EXTERNAL_PREDICATION_LASTUPDATED_AT is null""", feed=FEED))
def import_items(spark, d):
    merged, _ = vendor.run_import(bind.item_table(spark, d), vendor_report(spark, d),
                                  lower_feed(spark, d), now())
    return plain(merged.select("ID", "DESCRIPTION", "EXTERNAL_PREDICATED_UNSPSC_FAMILY",
                               "EXTERNAL_PREDICATION_LASTUPDATED_AT", "_DELTA_UPDATED_ON"))


@query("import_report", with_tables("parts", f"""
    select coalesce(f.PROCESSED_DESCRIPTION, r.PROCESSED_DESCRIPTION) as PROCESSED_DESCRIPTION,
           case when f.SENT_AT is not null then f.DESCRIPTION else r.DESCRIPTION end as DESCRIPTION,
           case when f.SENT_AT is not null then f.CODE else r.UNSPSC_COMMODITY end
             as UNSPSC_COMMODITY,
           strftime(coalesce(f.SENT_AT, r.REPORT_LASTUPDATED_AT), '%Y-%m-%d %H:%M:%S')
             as REPORT_LASTUPDATED_AT,
           case when r.PROCESSED_DESCRIPTION is null then '{RUN}' else '2001-01-01 00:00:00' end
             as _DELTA_CREATED_ON
    from report r full join feed f on r.PROCESSED_DESCRIPTION = f.PROCESSED_DESCRIPTION""",
    feed=FEED, report=REPORT))
def import_report(spark, d):
    _, merged = vendor.run_import(bind.item_table(spark, d), vendor_report(spark, d),
                                  lower_feed(spark, d), now())
    return plain(merged.select("PROCESSED_DESCRIPTION", "DESCRIPTION", "UNSPSC_COMMODITY",
                               "REPORT_LASTUPDATED_AT", "_DELTA_CREATED_ON"))


@query("apply_report", with_tables("item_table", f"""
    select t.ID, case when r.HIT then r.DESCRIPTION else t.DESCRIPTION end as DESCRIPTION,
           case when r.HIT then r.UNSPSC_CLASS else t.EXTERNAL_PREDICATED_UNSPSC_CLASS end
             as EXTERNAL_PREDICATED_UNSPSC_CLASS,
           strftime(case when r.HIT then r.REPORT_LASTUPDATED_AT
                    else t.EXTERNAL_PREDICATION_LASTUPDATED_AT end, '%Y-%m-%d %H:%M:%S')
             as EXTERNAL_PREDICATION_LASTUPDATED_AT,
           case when r.HIT then '{RUN}'
                else strftime(t._DELTA_UPDATED_ON, '%Y-%m-%d %H:%M:%S') end as _DELTA_UPDATED_ON
    from item_table t left join (select *, true as HIT from report) r
      on t.PROCESSED_DESCRIPTION = r.PROCESSED_DESCRIPTION
         and t.EXTERNAL_PREDICATION_LASTUPDATED_AT is null
         and t._DELTA_UPDATED_ON {IN_WINDOW}""", report=REPORT))
def apply_report(spark, d):
    merged = vendor.run_apply(bind.item_table(spark, d), vendor_report(spark, d), START, END,
                              now())
    return plain(merged.select("ID", "DESCRIPTION", "EXTERNAL_PREDICATED_UNSPSC_CLASS",
                               "EXTERNAL_PREDICATION_LASTUPDATED_AT", "_DELTA_UPDATED_ON"))


@query("finalize_merge", with_tables("item_table items", f"""
    select t.ID, n.CODE as FINAL_REPORT_UNSPSC_COMMODITY,
           substr(n.CODE, 1, 4) as FINAL_REPORT_UNSPSC_FAMILY,
           cast(n.CONFIDENCE as double) as FINAL_REPORT_CONFIDENCE_CLASS,
           case when n.CONFIDENCE is not null then '{RUN}' end as FINAL_REPORT_LASTUPDATED_AT,
           case when n.ID is not null then '{RUN}'
                else strftime(t._DELTA_UPDATED_ON, '%Y-%m-%d %H:%M:%S') end as _DELTA_UPDATED_ON
    from item_table t left join (
        select ID, case when V > 0.8 then EXTERNAL_PREDICATED_UNSPSC_COMMODITY
                        when O > 0.8 then SBN_PREDICATED_UNSPSC_COMMODITY
                        when A = EXTERNAL_PREDICATED_UNSPSC_COMMODITY
                          or A = SBN_PREDICATED_UNSPSC_COMMODITY then A end as CODE,
               case when V > 0.8 then V when O > 0.8 then O
                    when A = EXTERNAL_PREDICATED_UNSPSC_COMMODITY then V
                    when A = SBN_PREDICATED_UNSPSC_COMMODITY then O end as CONFIDENCE
        from (select *, AN_UNSPSC_COMMODITY as A, EXTERNAL_PREDICATION_CONFIDENCE_COMMODITY as V,
                     SBN_PREDICTION_CONFIDENCE_COMMODITY as O from item_table)
        where _DELTA_UPDATED_ON {IN_WINDOW} and FINAL_REPORT_UNSPSC_MANUAL_LABELED is null) n
      using (ID)"""))
def finalize_merge(spark, d):
    merged = finalize.run(bind.item_table(spark, d), START, END, now())
    return plain(merged.select("ID", "FINAL_REPORT_UNSPSC_COMMODITY", "FINAL_REPORT_UNSPSC_FAMILY",
                               "FINAL_REPORT_CONFIDENCE_CLASS", "FINAL_REPORT_LASTUPDATED_AT",
                               "_DELTA_UPDATED_ON"))


def _by_month(sql: str, touched: str) -> str:
    """The rows of a merge with the number of months that it rewrote."""
    return sql.replace("select t.ID,", f"select (select count(distinct strftime(_DELTA_CREATED_ON, "
                       f"'%Y-%m')) from item_table where _DELTA_UPDATED_ON {IN_WINDOW} {touched}) "
                       "as months, t.ID,", 1)


#: Rows that a task sorts and writes on average.
MONTH_TASK_ROWS = 250_000


def _items_by_month(spark, d):
    path = f"{shared_folder(spark)}/items-{uuid.uuid4().hex}"
    if not bind.few_parts(spark, d):
        by_month.write_by_month(bind.item_table(spark, d), path, "_DELTA_CREATED_ON")
        return path
    # numbers are brought together by month, so a task sorts few texts and writes few files
    tasks = max(spark.sparkContext.defaultParallelism, -(-bind.table(spark, d, "lineitem").count() // MONTH_TASK_ROWS))
    share = F.pmod(F.hash("l_orderkey"), F.lit(tasks // 16 + 1))
    given = by_month.with_month(bind.given_items(spark, d), "o_orderdate").withColumn("share", share)
    placed = given.repartition(tasks, by_month.MONTH, "share")
    tables.write_table(bind.shape_items(spark, d, placed, by_month.MONTH), path, partition_by=[by_month.MONTH])
    return path


@query("finalize_by_month", _by_month(bind.ORACLE["finalize_merge"],
                                      "and FINAL_REPORT_UNSPSC_MANUAL_LABELED is null"))
def finalize_by_month(spark, d):
    """Only the months of the batch are rewritten."""
    path = _items_by_month(spark, d)
    months = by_month.run_by_month(spark, path, lambda items: finalize.batch(items, START, END, now()),
                                   lambda items, rows: finalize.merge(items, rows, now()))
    return plain(spark.read.parquet(path).select(
        F.lit(months).cast("bigint").alias("months"), "ID", "FINAL_REPORT_UNSPSC_COMMODITY",
        "FINAL_REPORT_UNSPSC_FAMILY", "FINAL_REPORT_CONFIDENCE_CLASS", "FINAL_REPORT_LASTUPDATED_AT",
        "_DELTA_UPDATED_ON"))


@query("evaluate_by_month", _by_month(bind.ORACLE["evaluate_merge"], ""))
def evaluate_by_month(spark, d):
    path = _items_by_month(spark, d)
    months = by_month.run_by_month(
        spark, path, lambda items: evaluate.batch(items, bind.commodity(spark, d), START, END),
        lambda items, rows: evaluate.merge(items, rows, now()))
    return plain(spark.read.parquet(path).select(
        F.lit(months).cast("bigint").alias("months"), "ID", "PROCESSED_DESCRIPTION",
        *[f"AN_UNSPSC_{level}" for level in LEVELS], "AN_CLASSIFICATION_QUALITY_CLASS", *C.AUDIT))


DIMENSION_ROWS = """
    select ID, PO_ITEM_ID, DESCRIPTION, EXTERNAL_PREDICATED_UNSPSC_COMMODITY as UNSPSC_COMMODITY
    from item_table
    where _DELTA_UPDATED_ON between timestamp '{0}' - interval 7 day and timestamp '{1}'
      and DASHBOARD_STATUS <> 'PO_OBSOLETE'
    qualify row_number() over (partition by PO_ITEM_ID order by _DELTA_UPDATED_ON desc, ID) = 1"""
FIRST_START, FIRST_END = "1996-01-01 00:00:00", "1997-03-01 00:00:00"


def _reported(spark, d):
    """Items whose vendor code is the reported one; they are read several times."""
    items = bind.item_table(spark, d, bind.purchases(spark, d))
    return items.withColumns({f"FINAL_REPORT_UNSPSC_{level}":
                              F.col(f"EXTERNAL_PREDICATED_UNSPSC_{level}") for level in LEVELS})


def _facts(items):
    return items.groupBy("PO_ITEM_ID").agg(F.min("ID").alias("FIRST_ID")).selectExpr(
        "PO_ITEM_ID as ID", "cast(PO_ITEM_ID % 5 = 0 as int) as IS_BLANKET",
        "case when PO_ITEM_ID % 3 = 0 then FIRST_ID end as PRODUCT_ID",
        "timestamp'2001-01-01' as _DELTA_UPDATED_ON")


def _first_dimension(items):
    rows = star.dimension_rows(items, FIRST_START, FIRST_END)
    return materialize(rows.withColumns({name: F.lit("2001-01-01").cast("timestamp")
                                         for name in C.AUDIT}))


@query("load_dimension", with_tables("item_table", f"""
    select coalesce(a.ID, b.ID) as ID, coalesce(a.PO_ITEM_ID, b.PO_ITEM_ID) as PO_ITEM_ID,
           case when b.ID is not null then b.UNSPSC_COMMODITY else a.UNSPSC_COMMODITY end
             as UNSPSC_COMMODITY,
           case when a.ID is null then '{RUN}' else '2001-01-01 00:00:00' end
             as _DELTA_CREATED_ON,
           case when b.ID is not null then '{RUN}' else '2001-01-01 00:00:00' end
             as _DELTA_UPDATED_ON
    from a full join b using (ID)""",
    a=DIMENSION_ROWS.format(FIRST_START, FIRST_END), b=DIMENSION_ROWS.format(START, END)))
def load_dimension(spark, d):
    items = _reported(spark, d)
    merged, _ = star.run(items, _first_dimension(items), _facts(items), START, END, now())
    return plain(merged.select("ID", "PO_ITEM_ID", "UNSPSC_COMMODITY", *C.AUDIT))


@query("link_facts", with_tables("item_table", f"""
    select f.ID, f.IS_BLANKET, case when f.IS_BLANKET = 0 and b.ID is not null then b.ID
                                    else f.PRODUCT_ID end as PRODUCT_ID,
           case when f.IS_BLANKET = 0 and b.ID is not null
                     and (f.PRODUCT_ID is null or f.PRODUCT_ID <> b.ID)
                then '{RUN}' else '2001-01-01 00:00:00' end as _DELTA_UPDATED_ON
    from facts f left join b on f.ID = b.PO_ITEM_ID""",
    b=DIMENSION_ROWS.format(START, END),
    facts="""select PO_ITEM_ID as ID, cast(PO_ITEM_ID % 5 = 0 as int) as IS_BLANKET,
                    case when PO_ITEM_ID % 3 = 0 then min(ID) end as PRODUCT_ID
             from item_table group by PO_ITEM_ID"""))
def link_facts(spark, d):
    items = _reported(spark, d)
    _, linked = star.run(items, _first_dimension(items), _facts(items), START, END, now())
    return plain(linked)


@query("network_merge", with_tables("fact products", f"""
    select coalesce(a.SUPPLIER_ANID, b.SUPPLIER_ANID) as SUPPLIER_ANID,
           coalesce(a.BUYER_ORG, b.BUYER_ORG) as BUYER_ORG,
           coalesce(a.DOCUMENT_DATE, b.DOCUMENT_DATE) as DOCUMENT_DATE,
           coalesce(a.REQUESTED_DELIVERY_DATE, b.REQUESTED_DELIVERY_DATE)
             as REQUESTED_DELIVERY_DATE,
           coalesce(a.UNSPSC_COMMODITY, b.UNSPSC_COMMODITY) as UNSPSC_COMMODITY,
           coalesce(a.UNIT_OF_MEASURE, b.UNIT_OF_MEASURE) as UNIT_OF_MEASURE,
           coalesce(b.ORDER_AMOUNT, a.ORDER_AMOUNT) as ORDER_AMOUNT,
           coalesce(b.PO_ITEM_COUNT, a.PO_ITEM_COUNT) as PO_ITEM_COUNT,
           case when a.SUPPLIER_ANID is null then '{RUN}' else '2001-01-01 00:00:00' end
             as _DELTA_CREATED_ON
    from a full join b using ({', '.join(C.NETWORK_KEY)})""",
    a=NETWORK_SQL.format("IS_BLANKET = 0 and f.DOCUMENT_DATE between timestamp '1996-06-01' "
                         "and timestamp '1997-06-30'"),
    b=NETWORK_SQL.format("IS_BLANKET = 0 and f.DOCUMENT_DATE between timestamp '1997-01-01' "
                         "and timestamp '1998-12-31 23:59:59'")))
def network_merge(spark, d):
    fact, products = bind.fact(spark, d, bind.purchases(spark, d, bind.FACT_GIVEN)), bind.products(spark, d)
    first = network.network_totals(network.batch_facts(fact, "1996-06-01", "1997-06-30"), products)
    stored = materialize(first.withColumns({name: F.lit("2001-01-01").cast("timestamp")
                                            for name in C.AUDIT}))
    # the window ends mid-month for the run; whole months are taken
    merged = network.run(fact, products, stored, "1997-01-15", "1998-12-15", whole_months=True,
                         now=now())
    return plain(merged.select("SUPPLIER_ANID", "BUYER_ORG", "DOCUMENT_DATE",
                               "REQUESTED_DELIVERY_DATE", "UNSPSC_COMMODITY", "UNIT_OF_MEASURE",
                               "ORDER_AMOUNT", "PO_ITEM_COUNT", "_DELTA_CREATED_ON"))


#: Facts as they were first counted: in the batch late ones are missing, some had other values,
#: some are gone since.
EARLIER = {"QUANTITY": "QUANTITY + 7", "SHIP_TO_COUNTRY": "'C9'"}
IN_BATCH = "(DOCUMENT_DATE >= timestamp_ntz'1997-01-10' and DOCUMENT_DATE < timestamp_ntz'1997-03-20')"
LATE, CHANGED, GONE = (f"({IN_BATCH} and PO % 3 = {k})" for k in range(3))


@query("network_incremental", with_tables(
    "fact products", f"""
    select n.*, (select count(distinct date_trunc('month', DOCUMENT_DATE)) from fact
                 where IS_BLANKET = 0 and {IN_BATCH}) as months
    from ({NETWORK_SQL.format(f"IS_BLANKET = 0 and not {GONE}")}) n""".replace("timestamp_ntz", "timestamp")))
def network_incremental(spark, d):
    """Two rounds: all facts as they were, then the late, changed and removed ones of a batch.
    The totals equal those of the facts as they are."""
    facts, products = bind.fact(spark, d, bind.purchases(spark, d, bind.FACT_GIVEN)), bind.products(spark, d)
    earlier = facts.withColumns({name: F.expr(text) for name, text in EARLIER.items()})
    first = facts.where(f"not {IN_BATCH} or {GONE}").unionByName(earlier.where(CHANGED))
    path = f"{shared_folder(spark)}/network-state-{uuid.uuid4().hex}"
    stored = network.start_state(first, products, path).withColumns(
        {name: F.lit("2001-01-01").cast("timestamp") for name in C.AUDIT})
    deltas = network.fact_deltas(earlier.where(CHANGED).unionByName(facts.where(GONE)),
                                 facts.where(f"{CHANGED} or {LATE}"), products)
    updated, months = network.update_totals(path, materialize(stored, "totals"), deltas, now())
    return plain(updated.drop(*C.AUDIT).withColumns({
        "AVERAGE_UNIT_PRICE_USD": F.round("AVERAGE_UNIT_PRICE_USD", 9), "months": F.lit(months).cast("bigint")}))


@query("network_by_month", bind.ORACLE["network_merge"].replace(
    "select coalesce(a.SUPPLIER_ANID", "select (select count(distinct DOCUMENT_DATE) from b) as months, "
    "coalesce(a.SUPPLIER_ANID", 1))
def network_by_month(spark, d):
    fact, products = bind.fact(spark, d, bind.purchases(spark, d, bind.FACT_GIVEN)), bind.products(spark, d)
    path = f"{shared_folder(spark)}/totals-{uuid.uuid4().hex}"
    first = network.batch(fact, products, "1996-06-01", "1997-06-30")
    by_month.write_by_month(first.withColumns({name: F.lit("2001-01-01").cast("timestamp")
                                               for name in C.AUDIT}), path)
    months = by_month.run_by_month(
        spark, path, lambda _: network.batch(fact, products, "1997-01-15", "1998-12-15", whole_months=True),
        lambda totals, rows: network.merge(totals, rows, now=now()), date="DOCUMENT_DATE")
    return plain(spark.read.parquet(path).select(
        F.lit(months).cast("bigint").alias("months"), "SUPPLIER_ANID", "BUYER_ORG", "DOCUMENT_DATE",
        "REQUESTED_DELIVERY_DATE", "UNSPSC_COMMODITY", "UNIT_OF_MEASURE", "ORDER_AMOUNT",
        "PO_ITEM_COUNT", "_DELTA_CREATED_ON"))


@query("load_commodity", with_tables("commodity", f"""
    select ID, CODE, NAME, LEVEL_NAME,
           case when ID % 2 = 0 then '2001-01-01 00:00:00' else '{RUN}' end as _DELTA_CREATED_ON,
           '{RUN}' as _DELTA_UPDATED_ON from commodity"""))
def load_commodity(spark, d):
    commodity = bind.commodity(spark, d)
    raw = commodity.withColumn("CODE", F.col("CODE").cast("bigint"))
    stored = commodity.where("ID % 2 = 0").withColumn("NAME", F.lit("old")).drop("LEVEL_NAME")
    stored = stored.withColumns({name: F.lit("2001-01-01").cast("timestamp") for name in C.AUDIT})
    loaded = replicate.load_commodity(raw, stored, now())
    return plain(loaded.select("ID", "CODE", "NAME", "LEVEL_NAME", *C.AUDIT))


@query("replicate_training", with_tables("items", f"""
    select ID, DESCRIPTION,
           case when PO_ID % 2 = 0 then strftime(_DELTA_CREATED_ON, '%Y-%m-%d %H:%M:%S')
                else '{RUN}' end as _DELTA_CREATED_ON, '{RUN}' as _DELTA_UPDATED_ON from items"""))
def replicate_training(spark, d):
    raw = bind.items(spark, d).select("ID", "PO_ID", "DESCRIPTION", *C.AUDIT)
    stored = raw.where("PO_ID % 2 = 0").withColumns(
        {"DESCRIPTION": F.lit("old"), "_DELTA_CREATED_ON": F.lit("2001-01-01").cast("timestamp_ntz")})
    copied = replicate.copy_training_items(raw, stored, now())
    return plain(copied.select("ID", "DESCRIPTION", *C.AUDIT))


# -- inference with a scorer both engines can compute -----------------------------------------

LABEL = "cast(10000000 + (length({0}) * 104729) % 899999 * 100 as string)"
PROBABILITY = "cast((length({0}) * 37 % 1000) / 1000.0 as double)"


def length_scorer(features):
    """Label and probability from the length of the text."""
    return features.selectExpr("CONCAT_FEATURE",
                               LABEL.format("CONCAT_FEATURE") + " as predicted_label",
                               PROBABILITY.format("CONCAT_FEATURE") + " as predicted_label_proba")


_TEXT = ("SUPPLIER_ORG", "BUYER_ORG", "PO_ITEM_ID", "DESCRIPTION", "MANUFACTURER_NAME",
         "ITEM_TYPE", "IS_ADHOC")


def _filled(name: str) -> str:
    from spendweave.columns import NA_SPELLINGS
    value = f"coalesce(cast({name} as varchar), 'N/A')"
    listed = ", ".join(f"'{v}'" for v in NA_SPELLINGS)
    return f"case when {value} in ({listed}) then 'N/A' else {value} end as {name}"


FEATURE_ROWS = f"""
    select ID, concat_ws(' ', SUPPLIER_ORG, BUYER_ORG, DESCRIPTION, MANUFACTURER_NAME, ITEM_TYPE,
                         IS_ADHOC) as CONCAT_FEATURE
    from (select ID, {', '.join(_filled(name) for name in _TEXT)} from item_table
          where _DELTA_UPDATED_ON {IN_WINDOW})
    where not contains(DESCRIPTION, 'N/A') and not contains(PO_ITEM_ID, 'N/A')"""
STORED = f"""
    select CONCAT_FEATURE, {level_sql("'12340000'")}, {confidence_sql("'12340000'", '0.25')},
           timestamp '2003-03-03' as REPORT_LASTUPDATED_AT, 'M1' as MODEL_UUID
    from (select distinct CONCAT_FEATURE from feature_rows
          where length(CONCAT_FEATURE) % 3 = 0)"""
ANSWERS = f"""
    select * from stored union all
    select CONCAT_FEATURE, {level_sql('label')}, {confidence_sql('label', 'p')},
           timestamp '{RUN}', 'M1'
    from (select CONCAT_FEATURE, {LABEL.format('CONCAT_FEATURE')} as label,
                 cast({PROBABILITY.format('CONCAT_FEATURE')} as decimal(6,5)) as p
          from (select distinct CONCAT_FEATURE from feature_rows)
          where length(CONCAT_FEATURE) % 3 <> 0)"""


def prediction_report(items, start, end):
    """A third of the window's texts has a stored answer, also one of another model."""
    features = inference.feature_rows(items, start, end).select("CONCAT_FEATURE").distinct()
    levels = codes.prediction_levels(F.lit("12340000"), F.lit(0.25))
    known = features.where("length(CONCAT_FEATURE) % 3 = 0").select(
        "CONCAT_FEATURE", *[column.alias(name) for name, column in levels.items()],
        F.lit("2003-03-03").cast("timestamp").alias("REPORT_LASTUPDATED_AT"),
        F.lit("M1").alias("MODEL_UUID"),
        *[F.lit("2003-03-03").cast("timestamp").alias(name) for name in C.AUDIT])
    return materialize(known.unionByName(known.withColumn("MODEL_UUID", F.lit("M0"))))


def inference_round(spark, d, scorer=length_scorer):
    """The texts without a stored answer are scored."""
    items = bind.item_table(spark, d, bind.purchases(spark, d))
    report = prediction_report(items, START, END)
    return inference.run(items, report, scorer, "M1", START, END, now=now())


@query("infer_items", with_tables("item_table", f"""
    select t.ID, {', '.join(
        f'case when a.HIT then a.UNSPSC_{level} else t.SBN_PREDICATED_UNSPSC_{level} end '
        f'as SBN_PREDICATED_UNSPSC_{level}, cast(case when a.HIT then a.CONFIDENCE_{level} '
        f'else t.SBN_PREDICTION_CONFIDENCE_{level} end as double) '
        f'as SBN_PREDICTION_CONFIDENCE_{level}' for level in LEVELS)},
        case when a.HIT then 'M1' else t.MODEL_UUID end as MODEL_UUID,
        strftime(case when a.HIT then a.REPORT_LASTUPDATED_AT
                 else t.SBN_PREDICTION_LASTUPDATED_AT end, '%Y-%m-%d %H:%M:%S')
          as SBN_PREDICTION_LASTUPDATED_AT,
        case when a.HIT then '{RUN}'
             else strftime(t._DELTA_UPDATED_ON, '%Y-%m-%d %H:%M:%S') end as _DELTA_UPDATED_ON
    from item_table t left join (
        select f.ID, true as HIT, answers.* from feature_rows f join answers using (CONCAT_FEATURE)
        ) a on t.ID = a.ID and (t.MODEL_UUID is null or t.MODEL_UUID <> 'M1')""",
    feature_rows=FEATURE_ROWS, stored=STORED, answers=ANSWERS))
def infer_items(spark, d):
    merged, _ = inference_round(spark, d)
    return plain(merged.select(*C.OWN_PREDICTION, "_DELTA_UPDATED_ON"))


@query("infer_report", with_tables("item_table", f"""
    select CONCAT_FEATURE, MODEL_UUID, {', '.join(f'UNSPSC_{v}, CONFIDENCE_{v}' for v in LEVELS)},
           {sql_time('REPORT_LASTUPDATED_AT')} from answers
    union all select CONCAT_FEATURE, 'M0',
           {', '.join(f'UNSPSC_{v}, CONFIDENCE_{v}' for v in LEVELS)},
           {sql_time('REPORT_LASTUPDATED_AT')} from stored""",
    feature_rows=FEATURE_ROWS, stored=STORED, answers=ANSWERS))
def infer_report(spark, d):
    _, report = inference_round(spark, d)
    return plain(report.drop(*C.AUDIT))
