"""Codes, joins, reconciliation, aggregates, labels, metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spendweave import columns as C
from spendweave.functions import codes
from spendweave.functions.measures import month_start, whole_amount
from spendweave.operators import joins, labels, metrics, network, reconcile
from spendweave.plans import evaluate, extract, vendor
from spendweave.sources.readers import latest_predictions

from . import bind
from .bind import END, LEVELS, START, plain, query, sql_time, with_tables
from .cleaning import CLEAN_SQL, WORDS_SQL

# -- codes ----------------------------------------------------------------------------

STRIPPED = r"regexp_replace(coalesce({0}, '0'), '0{{2}}\b|0{{4}}\b|0{{6}}\b', '', 'g')"


@query("strip_zero_pairs", with_tables("items", f"""
    select ID, {STRIPPED.format('CODE')} as STRIPPED from items"""))
def strip_zero_pairs(spark, d):
    return bind.items(spark, d).select("ID", codes.strip_zero_pairs(F.col("CODE"))
                                       .alias("STRIPPED"))


VALIDATED = f"""
    select i.ID, i.AN_UNSPSC_COMMODITY,
           case when v.CODE is null then 'Poor' else 'Acceptable' end as QUALITY
    from (select ID, {STRIPPED.format('CODE')} as AN_UNSPSC_COMMODITY from items) i
    left join (select distinct CODE from commodity where VALID = 1) v
      on i.AN_UNSPSC_COMMODITY = v.CODE"""


@query("validate_code", with_tables("items commodity", f"""
    select ID, AN_UNSPSC_COMMODITY,
           {', '.join(f'QUALITY as AN_CLASSIFICATION_QUALITY_{level}' for level in LEVELS)}
    from ({VALIDATED})"""))
def validate_code(spark, d):
    valid = reconcile.valid_codes(bind.commodity(spark, d))
    return reconcile.validate_codes(bind.items(spark, d).select("ID", "AN_UNSPSC_COMMODITY"),
                                    valid)


DERIVED = ", ".join(
    f"case when QUALITY = 'Acceptable' then substr(AN_UNSPSC_COMMODITY, 1, {2 * n}) else '0' end "
    f"as AN_UNSPSC_{level}" for n, level in enumerate(LEVELS, start=1))


@query("derive_levels", with_tables("items commodity", f"select ID, {DERIVED} from ({VALIDATED})"))
def derive_levels(spark, d):
    valid = reconcile.valid_codes(bind.commodity(spark, d))
    rated = reconcile.validate_codes(bind.items(spark, d).select("ID", "AN_UNSPSC_COMMODITY"),
                                     valid)
    return reconcile.derive_levels(rated).select("ID", *[f"AN_UNSPSC_{level}" for level in LEVELS])


def level_sql(label: str, prefix: str = "UNSPSC_") -> str:
    return ", ".join(
        f"case when right({label}, {10 - 2 * n}) = repeat('0', {10 - 2 * n}) then null "
        f"else substr({label}, 1, {2 * n}) end as {prefix}{level}"
        for n, level in enumerate(LEVELS, start=1))


def deepest_sql(label: str) -> str:
    return f"cast(ceil(length(rtrim({label}, '0')) / 2.0) as int)"


def confidence_sql(label: str, probability: str, prefix: str = "CONFIDENCE_") -> str:
    return ", ".join(
        f"cast(case when {deepest_sql(label)} >= {n} then {probability} end as double) "
        f"as {prefix}{level}" for n, level in enumerate(LEVELS, start=1))


@query("level_codes", with_tables("items", f"""
    select ID, {level_sql('OWN_CODE')}, {deepest_sql('OWN_CODE')} as DEEPEST from items"""))
def level_codes(spark, d):
    label = F.col("OWN_CODE")
    return bind.items(spark, d).select(
        "ID", *[codes.level_code(label, n).alias(f"UNSPSC_{level}")
                for n, level in enumerate(LEVELS, start=1)],
        codes.deepest_level(label).alias("DEEPEST"))


@query("level_confidence", with_tables("items", f"""
    select ID, {level_sql('OWN_CODE', 'SBN_PREDICATED_UNSPSC_')},
           {confidence_sql('OWN_CODE', 'OWN_CONFIDENCE', 'SBN_PREDICTION_CONFIDENCE_')}
    from items"""))
def level_confidence(spark, d):
    wide = codes.prediction_levels(F.col("OWN_CODE"), F.col("OWN_CONFIDENCE"), C.REPORT_TO_OWN)
    return plain(bind.items(spark, d).select(
        "ID", *[column.alias(name) for name, column in wide.items()]))


def candidates(spark, d):
    """Items with buyer, vendor and own candidate codes."""
    return bind.items(spark, d).selectExpr(
        "ID", "_DELTA_UPDATED_ON", "CODE as AN_UNSPSC_COMMODITY",
        "VENDOR_CODE as EXTERNAL_PREDICATED_UNSPSC_COMMODITY",
        "VENDOR_CONFIDENCE as EXTERNAL_PREDICATION_CONFIDENCE_COMMODITY",
        "OWN_CODE as SBN_PREDICATED_UNSPSC_COMMODITY",
        "OWN_CONFIDENCE as SBN_PREDICTION_CONFIDENCE_COMMODITY",
        "case when P_KEY % 23 = 1 then 'Good' else 'Acceptable' end "
        "as AN_CLASSIFICATION_QUALITY_COMMODITY")


RECONCILED = """
    select ID, _DELTA_UPDATED_ON, FINAL_CODE, substr(FINAL_CODE, 1, 2) as S,
           substr(FINAL_CODE, 1, 4) as F, substr(FINAL_CODE, 1, 6) as C,
           cast(CONFIDENCE as double) as CONFIDENCE
    from (select *, case when VENDOR_CONFIDENCE > 0.8 then VENDOR_CODE
                  when OWN_CONFIDENCE > 0.8 then OWN_CODE
                  when P_KEY % 23 = 1 then CODE
                  when CODE = VENDOR_CODE or CODE = OWN_CODE then CODE end as FINAL_CODE,
             case when VENDOR_CONFIDENCE > 0.8 then VENDOR_CONFIDENCE
                  when OWN_CONFIDENCE > 0.8 then OWN_CONFIDENCE
                  when CODE = VENDOR_CODE then VENDOR_CONFIDENCE
                  when CODE = OWN_CODE then OWN_CONFIDENCE end as CONFIDENCE
          from items)"""


@query("reconcile", with_tables("items", f"""
    select ID, S as FINAL_REPORT_UNSPSC_SEGMENT, F as FINAL_REPORT_UNSPSC_FAMILY,
           C as FINAL_REPORT_UNSPSC_CLASS, FINAL_CODE as FINAL_REPORT_UNSPSC_COMMODITY,
           {', '.join(f'CONFIDENCE as FINAL_REPORT_CONFIDENCE_{level}' for level in LEVELS)},
           case when CONFIDENCE is not null then '2024-01-01 00:00:00' end
             as FINAL_REPORT_LASTUPDATED_AT
    from ({RECONCILED})"""))
def reconcile_codes(spark, d):
    final = reconcile.final_code(candidates(spark, d), F.lit("2024-01-01").cast("timestamp"))
    return plain(final.select("ID", *[name for name in final.columns
                                      if name.startswith("FINAL_REPORT")]))


# -- joins ----------------------------------------------------------------------------

ORG_SQL = """
    select c_custkey as ORG_ID, c_name as NAME, concat('B', cast(c_custkey as varchar)) as ANID
    from customer
    union all select 1000000 + s_suppkey, s_name, concat('S', cast(s_suppkey as varchar))
    from supplier"""


@query("join_sources", with_tables("lines orders_b parts", """
    select l.ID as PO_ITEM_ID, l.PO_ID, o.BUYER_ORG, o.SELLER as SUPPLIER_ORG,
           b.NAME as BUYER_NAME, s.NAME as SUPPLIER_NAME, b.ANID as BUYER_ANID,
           s.ANID as SUPPLIER_ANID, c.P_KEY as PO_ITEM_COMMODITY_ID,
           coalesce(c.P_KEY, 0) as KEY_PART, c.CODE
    from lines l
    join (select *, 1000000 + O_KEY % 100 as SELLER from orders_b where IS_BLANKET = 0
          and DOCUMENT_DATE between timestamp '1997-01-01' and timestamp '1998-12-31') o
      on l.PO_ID = o.O_KEY
    left join (select ID, P_KEY, CODE from lines join parts using (P_KEY)
               where CODE is not null) c on c.ID = l.ID
    left join org b on b.ORG_ID = o.BUYER_ORG
    left join org s on s.ORG_ID = o.SELLER""", org=ORG_SQL))
def join_sources(spark, d):
    raw = raw_tables(spark, d)
    from spendweave.sources.readers import in_window, project
    joined = extract.join_sources(
        project(raw["po_item"], C.PO_ITEM),
        project(in_window(raw["po"], START, END), C.PO, "IS_BLANKET = 0"),
        project(raw["cxml_document"], C.DOCUMENT),
        project(raw["po_item_commodity"], C.PO_ITEM_COMMODITY), project(raw["org"], C.ORG))
    return joined.select(
        "PO_ITEM_ID", "PO_ID", "BUYER_ORG", "SUPPLIER_ORG", "BUYER_NAME", "SUPPLIER_NAME",
        "BUYER_ANID", "SUPPLIER_ANID", "PO_ITEM_COMMODITY_ID",
        F.coalesce("PO_ITEM_COMMODITY_ID", F.lit(0)).alias("KEY_PART"), "CODE")


def raw_tables(spark, d):
    """Orders split into order and document, lines, commodities, organisations.

    A line's id is text here: the given line numbers repeat.
    """
    orders = bind.orders(spark, d)
    lines = bind.lines_of_parts(spark, d)
    customer, supplier = bind.table(spark, d, "customer"), bind.table(spark, d, "supplier")
    audit = ["DOCUMENT_DATE as _DELTA_CREATED_ON", "DOCUMENT_DATE as _DELTA_UPDATED_ON"]
    return {
        "po": orders.selectExpr("O_KEY as ID", "O_KEY + 5 as GENERIC_DOCUMENT", "IS_BLANKET",
                                "concat('C', cast(O_KEY % 9 as string)) as SHIP_TO_COUNTRY",
                                "0 as IS_ADHOC", "'goods' as SERVICE_TYPE", *audit),
        "cxml_document": orders.selectExpr(
            "O_KEY + 5 as ID", "BUYER_ORG as FROM_ORG", "1000000 + O_KEY % 100 as TO_ORG",
            "DASHBOARD_STATUS", "DOCUMENT_DATE", "DOCUMENT_DATE as CREATED", *audit),
        "po_item": lines.selectExpr(
            "ID", "PO_ID as PO", "DESCRIPTION", "MANUFACTURER_PART", "BRAND as MANUFACTURER_NAME",
            "ITEM_TYPE", "'category' as ITEM_CATEGORY", "UNIT_OF_MEASURE", "SUPPLIER_PART",
            "cast(SUPPLIER_ORG as string) as SUPPLIER_PART_KID", "'' as SUPPLIER_PART_EXTENSION"),
        "po_item_commodity": lines.where("CODE is not null").selectExpr(
            "P_KEY as ID", "ID as PO_ITEM", "'UNSPSC' as DOMAIN", "CODE"),
        "org": customer.selectExpr("c_custkey as ID", "concat('B', cast(c_custkey as string)) "
                                   "as ANID", "c_name as NAME").unionByName(
            supplier.selectExpr("1000000 + s_suppkey as ID",
                                "concat('S', cast(s_suppkey as string)) as ANID",
                                "s_name as NAME")),
    }


@query("join_text_key", with_tables("items", f"""
    select i.ID, i.DESCRIPTION, r.CODE as EXTERNAL_PREDICATED_UNSPSC_COMMODITY
    from items i join report r using (DESCRIPTION)""",
    report="select DESCRIPTION, max(CODE) as CODE from parts group by DESCRIPTION"))
def join_text_key(spark, d):
    report = (bind.parts(spark, d).groupBy("DESCRIPTION").agg(F.max("CODE").alias("CODE"))
              .selectExpr("DESCRIPTION as PROCESSED_DESCRIPTION", "CODE as UNSPSC_COMMODITY"))
    items = bind.items(spark, d).selectExpr("ID", "DESCRIPTION as PROCESSED_DESCRIPTION")
    return vendor.answered_items(items, report).withColumnRenamed("PROCESSED_DESCRIPTION",
                                                                  "DESCRIPTION")


@query("anti_export", with_tables("items", """
    select DESCRIPTION, min(ID) as ID from items
    where DESCRIPTION is not null and DESCRIPTION not in
        (select DESCRIPTION from parts where P_KEY % 5 = 2 and DESCRIPTION is not null)
    group by DESCRIPTION"""))
def anti_export(spark, d):
    exported = bind.parts(spark, d).where("P_KEY % 5 = 2").selectExpr(
        "DESCRIPTION as PROCESSED_DESCRIPTION")
    texts = (bind.items(spark, d).where("DESCRIPTION is not null")
             .groupBy(F.col("DESCRIPTION").alias("PROCESSED_DESCRIPTION"))
             .agg(F.min("ID").alias("ID")))
    return vendor.to_export(texts, exported).withColumnRenamed("PROCESSED_DESCRIPTION",
                                                               "DESCRIPTION")


@query("export_batch", with_tables("parts", """
    select DESCRIPTION from parts where DESCRIPTION is not null and length(DESCRIPTION) % 3 <> 0
    group by DESCRIPTION order by DESCRIPTION limit 50"""))
def export_batch(spark, d):
    texts = (bind.parts(spark, d).where("DESCRIPTION is not null")
             .selectExpr("DESCRIPTION as PROCESSED_DESCRIPTION").distinct())
    exported = texts.where("length(PROCESSED_DESCRIPTION) % 3 = 0")
    batch = vendor.to_export(texts, exported, batch_size=50)
    return batch.withColumnRenamed("PROCESSED_DESCRIPTION", "DESCRIPTION")


KNOWN = "select DESCRIPTION, min(CODE) as STORED from parts where P_KEY % 3 = 0 " \
        "and DESCRIPTION is not null group by DESCRIPTION"


@query("split_known", with_tables("items", """
    select ID, STORED, 'known' as STATE from items join known using (DESCRIPTION)
    union all select ID, null, 'new' from items
    where DESCRIPTION is null or DESCRIPTION not in (select DESCRIPTION from known)""",
    known=KNOWN))
def split_known(spark, d):
    report = (bind.parts(spark, d).where("P_KEY % 3 = 0 and DESCRIPTION is not null")
              .groupBy("DESCRIPTION").agg(F.min("CODE").alias("STORED")))
    known, new = joins.split_known(bind.items(spark, d).select("ID", "DESCRIPTION"), report,
                                   "DESCRIPTION")
    return (known.select("ID", "STORED", F.lit("known").alias("STATE"))
            .unionByName(new.select("ID", F.lit(None).cast("string").alias("STORED"),
                                    F.lit("new").alias("STATE"))))


@query("fact_dimension", with_tables("fact products", """
    select f.ID, f.PO, f.PRODUCT_ID, p.UNSPSC_SEGMENT, p.UNSPSC_COMMODITY
    from fact f left join products p on f.PRODUCT_ID = p.ID"""))
def fact_dimension(spark, d):
    return network.with_commodity(bind.fact(spark, d), bind.products(spark, d)).select(
        "ID", "PO", "PRODUCT_ID", "UNSPSC_SEGMENT", "UNSPSC_COMMODITY")


@query("feed_latest", with_tables("parts", f"""
    select PROCESSED_DESCRIPTION, DESCRIPTION, PREDICATED_UNSPSC_COMMODITY,
           {sql_time('PREDICATION_LASTUPDATED_AT')}
    from feed qualify row_number() over (partition by PROCESSED_DESCRIPTION
                                         order by PREDICATION_LASTUPDATED_AT desc) = 1""",
    feed="select b.*, timestamp '2024-01-01' + to_days(cast(P_KEY as int)) "
         "as PREDICATION_LASTUPDATED_AT from (select P_KEY, "
         "coalesce(DESCRIPTION, '') as PROCESSED_DESCRIPTION, "
         "DESCRIPTION || '!' as DESCRIPTION, CODE as PREDICATED_UNSPSC_COMMODITY "
         "from parts) b"))
def feed_latest(spark, d):
    return plain(latest_predictions(vendor_feed(spark, d), C.VENDOR_FEED).select(
        "PROCESSED_DESCRIPTION", "DESCRIPTION", "PREDICATED_UNSPSC_COMMODITY",
        "PREDICATION_LASTUPDATED_AT"))


def vendor_feed(spark, d):
    """Parts as vendor answers, one day apart."""
    parts = bind.parts(spark, d)
    levels = [f"substr(CODE, 1, {2 * n}) as PREDICATED_UNSPSC_{level}"
              for n, level in enumerate(LEVELS[:-1], start=1)]
    return parts.selectExpr(
        "case when DESCRIPTION is not null then concat(DESCRIPTION, '!') end as DESCRIPTION",
        "coalesce(DESCRIPTION, '') as PROCESSED_DESCRIPTION", *levels,
        "CODE as PREDICATED_UNSPSC_COMMODITY",
        "timestamp_ntz'2024-01-01' + make_dt_interval(cast(P_KEY as int)) "
        "as PREDICATION_LASTUPDATED_AT")


# -- aggregates -----------------------------------------------------------------------

NETWORK_SQL = f"""
    select SUPPLIER_ANID, BUYER_ORG, SUPPLIER_ORG, {sql_time('REQUESTED_DELIVERY_DATE')},
           {sql_time('DOCUMENT_DATE')}, SHIP_TO_COUNTRY, UNIT_OF_MEASURE, UNSPSC_SEGMENT,
           UNSPSC_FAMILY, UNSPSC_CLASS, UNSPSC_COMMODITY,
           cast(sum(OA) as bigint) as ORDER_AMOUNT, cast(sum(QUANTITY) as bigint) as ORDER_UNITS,
           round(avg(UNIT_PRICE_USD), 9) as AVERAGE_UNIT_PRICE_USD,
           count(distinct PO) as PO_COUNT, count(distinct ID) as PO_ITEM_COUNT
    from (select f.SUPPLIER_ANID, f.BUYER_ORG, f.SUPPLIER_ORG,
                 date_trunc('month', f.REQUESTED_DELIVERY_DATE) as REQUESTED_DELIVERY_DATE,
                 date_trunc('month', f.DOCUMENT_DATE) as DOCUMENT_DATE, f.SHIP_TO_COUNTRY,
                 f.UNIT_OF_MEASURE, coalesce(UNSPSC_SEGMENT, '99') as UNSPSC_SEGMENT,
                 coalesce(UNSPSC_FAMILY, '9999') as UNSPSC_FAMILY,
                 coalesce(UNSPSC_CLASS, '999999') as UNSPSC_CLASS,
                 coalesce(UNSPSC_COMMODITY, '99999999') as UNSPSC_COMMODITY,
                 cast(trunc(QUANTITY * UNIT_PRICE_USD) as bigint) as OA, QUANTITY, UNIT_PRICE_USD,
                 PO, f.ID
          from fact f left join products p on f.PRODUCT_ID = p.ID where {{0}})
    group by all"""


@query("network_monthly", with_tables("fact products", NETWORK_SQL.format("IS_BLANKET = 0")))
def network_monthly(spark, d):
    fact = bind.fact(spark, d).where("IS_BLANKET = 0")
    totals = network.network_totals(fact, bind.products(spark, d))
    return plain(totals.withColumn("AVERAGE_UNIT_PRICE_USD",
                                   F.round("AVERAGE_UNIT_PRICE_USD", 9)))


@query("row_measures", f"""
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
           {sql_time("date_trunc('month', l_shipdate)", 'MONTH')},
           cast(trunc(l_quantity * l_discount * 100) as bigint) as AMOUNT from lineitem""")
def row_measures(spark, d):
    lineitem = bind.table(spark, d, "lineitem")
    return plain(lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        month_start(F.col("l_shipdate")).alias("MONTH"),
        whole_amount(F.col("l_quantity") * F.col("l_discount"), F.lit(100)).alias("AMOUNT")))


@query("value_counts", with_tables("items", """
    select CODE, count(*) as count from items group by CODE"""))
def value_counts(spark, d):
    return labels.value_counts(bind.items(spark, d), "CODE")


@query("rare_values", with_tables("items", """
    select DESCRIPTION from items group by DESCRIPTION having count(*) < 25"""))
def rare_values(spark, d):
    return labels.rare_values(bind.items(spark, d), "DESCRIPTION", 25)


@query("replace_rare", with_tables("items", """
    select ID, case when CODE in (select CODE from items where CODE is not null group by CODE
                                  having count(*) < 30) then '99999999'
                    else coalesce(CODE, 'N/A') end as CODE from items"""))
def replace_rare(spark, d):
    items = bind.items(spark, d).select("ID", "CODE")
    return labels.balance(items, "CODE", "replace", 30, "99999999")[0]


@query("keep_frequent", with_tables("items", """
    select ID, CODE from items where CODE in
        (select CODE from items group by CODE having count(*) >= 30)"""))
def keep_frequent(spark, d):
    items = bind.items(spark, d).select("ID", "CODE")
    return labels.balance(items, "CODE", "filter", 30)[0]


@query("infrequent_labels", with_tables("items", """
    select CODE from items group by CODE having count(*) < 30"""))
def infrequent_labels(spark, d):
    items = bind.items(spark, d).select("ID", "CODE")
    return labels.balance(items, "CODE", "filter", 30)[1]


@query("label_index", """
    select doc_id, lang, idx from documents join
        (select lang, row_number() over (order by lang) - 1 as idx
         from (select distinct lang from documents where lang is not null)) using (lang)""")
def label_index(spark, d):
    documents = bind.table(spark, d, "documents").select("doc_id", "lang")
    dictionary = labels.label_index(documents, "lang", "idx")
    return labels.index_labels(documents, "lang", dictionary).withColumn(
        "idx", F.col("idx").cast("bigint"))


@query("one_hot", """
    select doc_id, array_to_string(list_transform(range(k), lambda j:
               case when j = idx then '1' else '0' end), '') as hot
    from documents join (select lang, row_number() over (order by lang) - 1 as idx,
                                count(*) over () as k
                         from (select distinct lang from documents)) using (lang)""")
def one_hot(spark, d):
    documents = bind.table(spark, d, "documents").select("doc_id", "lang")
    indexed = labels.index_labels(documents, "lang", labels.label_index(documents, "lang", "idx"))
    hot = labels.one_hot(indexed, "idx", "vector")
    return hot.select("doc_id", F.array_join(
        vector_to_array("vector").cast("array<int>").cast("array<string>"), "").alias("hot"))


@query("predicted_class", """
    select vec_id, list_position(embedding, list_max(embedding)) - 1 as cls,
           round(cast(list_max(embedding) as double), 3) as top from embeddings""")
def predicted_class(spark, d):
    number, top = labels.predicted_class(F.col("embedding").cast("array<double>"))
    return bind.table(spark, d, "embeddings").select(
        "vec_id", number.cast("bigint").alias("cls"), top.alias("top"))


METRICS_SQL = """
    select round(sum(case when pred > 0 then hits / pred else 0 end * act) / sum(act), 3)
             as precision,
           round(sum(hits) / sum(act), 3) as recall,
           round(sum(case when hits > 0 then 2.0 * hits / (act + pred) else 0 end * act)
                 / sum(act), 3) as f1,
           cast(sum(act) as bigint) as rows
    from (select c, cast(count(*) filter (where a = c and b = c) as double) as hits,
                 cast(count(*) filter (where a = c) as double) as act,
                 cast(count(*) filter (where b = c) as double) as pred
          from (select distinct a as c from pairs union select distinct b from pairs)
          join pairs on a = c or b = c group by c)"""


@query("class_metrics", with_tables("", METRICS_SQL, pairs="""
    select quality as a, case when doc_id % 7 = 0 then 1 - quality else quality end as b
    from labels"""))
def class_metrics(spark, d):
    pairs = bind.table(spark, d, "labels").selectExpr(
        "quality as a", "case when doc_id % 7 = 0 then 1 - quality else quality end as b")
    return metrics.class_metrics(pairs, "a", "b")


@query("class_metrics_codes", with_tables("items", METRICS_SQL, pairs="""
    select CODE as a, OWN_CODE as b from items
    where CODE is not null and OWN_CODE is not null"""))
def class_metrics_codes(spark, d):
    pairs = bind.items(spark, d).where("CODE is not null and OWN_CODE is not null").selectExpr(
        "CODE as a", "OWN_CODE as b")
    return metrics.class_metrics(pairs, "a", "b")


EVALUATED_NAMES = ("PROCESSED_DESCRIPTION", "AN_DATA_QUALITY_LEVEL",
                   *(f"AN_UNSPSC_{level}" for level in LEVELS))


#: Cleaned description and its rating, for each item.
RATED_SQL = r"""
    select ID, cleaned, case when least(a, b, c) < 3 then 'Poor'
                             when a > 15 and b > 15 and c > 15 then 'Good'
                             else 'Acceptable' end as rating
    from (select ID, cleaned, length(regexp_replace(cleaned, '[^0-9a-z]', '', 'g')) as a,
                 length(regexp_replace(cleaned, '[^a-z]', '', 'g')) as b, length(cleaned) as c
          from (select ID, """ + CLEAN_SQL + """ as cleaned from (
                select ID, """ + WORDS_SQL.format("DESCRIPTION") + """ as words from items)))"""


@query("evaluate_items", with_tables("items commodity", f"""
    select v.ID, {DERIVED}, QUALITY as AN_CLASSIFICATION_QUALITY_COMMODITY,
           cleaned as PROCESSED_DESCRIPTION, rating as AN_DATA_QUALITY_LEVEL
    from ({VALIDATED}) v join rated using (ID)""", rated=RATED_SQL))
def evaluate_items(spark, d):
    evaluated = evaluate.evaluate_items(bind.items(spark, d), bind.commodity(spark, d))
    return evaluated.select("ID", *[f"AN_UNSPSC_{level}" for level in LEVELS],
                            "AN_CLASSIFICATION_QUALITY_COMMODITY", "PROCESSED_DESCRIPTION",
                            "AN_DATA_QUALITY_LEVEL")
