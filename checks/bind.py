"""The given tables seen as purchasing tables.

Every column is derived by an expression both engines read the same way, so the
Spark frame and the SQL common table expression are built from one text. Only
inputs are shared like this; the queries themselves are written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.session import materialize

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

LEVELS = ("SEGMENT", "FAMILY", "CLASS", "COMMODITY")

#: The batch window of the incremental queries.
START, END = "1997-01-01 00:00:00", "1998-12-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- expressions ---------------------------------------------------------------------

def digits(key: str) -> str:
    return f"cast(10000000 + ({key} * 7919) % 89999999 as string)"


def code(key: str) -> str:
    """A buyer's code: full, cut off at a level, missing or broken."""
    d = digits(key)
    return (f"case when {key} % 29 = 7 then cast(null as string) when {key} % 31 = 5 then '0' "
            f"when {key} % 37 = 5 then '00000000' when {key} % 41 = 3 then 'AB12' "
            f"when {key} % 6 = 0 then concat(substr({d}, 1, 6), '00') "
            f"when {key} % 6 = 1 then concat(substr({d}, 1, 4), '0000') "
            f"when {key} % 6 = 2 then concat(substr({d}, 1, 2), '000000') else {d} end")


def directory_code(key: str) -> str:
    """The code as the directory lists it, without unused levels."""
    d = digits(key)
    return (f"case when {key} % 6 = 0 then substr({d}, 1, 6) when {key} % 6 = 1 then "
            f"substr({d}, 1, 4) when {key} % 6 = 2 then substr({d}, 1, 2) else {d} end")


DESCRIPTION = """case when p_partkey % 17 = 0 then cast(null as string)
    when p_partkey % 13 = 4 then concat('#', cast(p_size as string), ' / ', cast(p_size as string))
    when p_partkey % 11 = 3 then p_brand
    when p_partkey % 5 = 1 then concat(p_name, ', ', p_type, ' (', p_brand, ') - ', p_name)
    when p_partkey % 19 = 2 then 'Not Available'
    else concat(p_name, ' ', p_type, ' ', p_brand, ' size ', cast(p_size as string)) end"""

PART = {
    "P_KEY": "p_partkey",
    "DESCRIPTION": DESCRIPTION,
    "CODE": code("p_partkey"),
    "ITEM_TYPE": "p_type",
    "BRAND": "p_brand",
}

COMMODITY = {
    "ID": "p_partkey",
    "PARENT": "p_partkey % 50",
    "CODE": directory_code("p_partkey"),
    "NAME": "p_name",
    "LEVEL_NAME": "case when p_partkey % 6 = 0 then 'Class' else 'Commodity' end",
    "VALID": "case when p_partkey % 4 = 0 then 0 else 1 end",
}

_ITEM_ID = ("concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', "
            "cast(l_partkey as string), '-', cast(l_suppkey as string), '-', "
            "cast(cast(round(l_extendedprice * 100) as bigint) as string))")

#: Purchase lines; PO_ITEM_ID is not unique.
LINE = {
    "ID": _ITEM_ID,
    "PO_ITEM_ID": "l_orderkey * 8 + l_linenumber",
    "PO_ID": "l_orderkey",
    "P_KEY": "l_partkey",
    "SUPPLIER_ORG": "l_suppkey",
    "SUPPLIER_PART": "case when l_suppkey % 9 = 0 then 'null' "
                     "else concat('SP-', cast(l_suppkey as string)) end",
    "MANUFACTURER_PART": "case when l_partkey % 10 = 3 then cast(null as string) "
                         "else concat('MP-', cast(l_partkey % 97 as string)) end",
    "IS_ADHOC": "l_linenumber % 2",
    "QUANTITY": "cast(l_quantity as bigint)",
    "UNIT_PRICE_USD": "l_extendedprice / l_quantity",
    "REQUESTED_DELIVERY_DATE": "l_shipdate",
    "UNIT_OF_MEASURE": "l_returnflag",
    "PRODUCT_ID": "case when l_linenumber = 7 then cast(null as string) "
                  "else cast(l_partkey as string) end",
    "VENDOR_CODE": f"case when l_linenumber = 1 then cast(null as string) when l_partkey % 3 = 0 "
                   f"then {code('l_partkey')} else {digits('(l_partkey + 1)')} end",
    "VENDOR_CONFIDENCE": "case when l_linenumber = 1 then cast(null as decimal(6,5)) "
                         "else cast(l_discount * 10 as decimal(6,5)) end",
    "OWN_CODE": f"case when l_suppkey % 2 = 0 then {code('l_partkey')} "
                f"else {digits('(l_partkey + 2)')} end",
    "OWN_CONFIDENCE": "cast(l_tax * 12 as decimal(6,5))",
}

ORDER = {
    "O_KEY": "o_orderkey",
    "BUYER_ORG": "o_custkey",
    "DASHBOARD_STATUS": "case o_orderstatus when 'F' then 'PO_NEW' when 'O' then 'PO_SHIPPED' "
                        "else 'PO_OBSOLETED' end",
    "IS_BLANKET": "case when o_orderpriority = '5-LOW' then 1 else 0 end",
    "DOCUMENT_DATE": "o_orderdate",
}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in columns.items()]


def _sql(columns: dict[str, str], source: str) -> str:
    return f"select {', '.join(_select(columns))} from {source}"


# -- Spark frames ---------------------------------------------------------------------

def commodity(spark, d) -> DataFrame:
    return table(spark, d, "part").selectExpr(*_select(COMMODITY))


def parts(spark, d) -> DataFrame:
    return table(spark, d, "part").selectExpr(*_select(PART))


def orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").selectExpr(*_select(ORDER))


def lines(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(*_select(LINE))


#: Parts up to which they are broadcast (some 100 bytes each); they are counted first.
FEW_PARTS = 2_000_000


def few_parts(spark, d) -> bool:
    return table(spark, d, "part").count() <= FEW_PARTS


def counted(parts_: DataFrame) -> DataFrame:
    """Parts, to be broadcast if they are few enough."""
    return F.broadcast(parts_) if parts_.count() <= FEW_PARTS else parts_


def lines_of_parts(spark, d, source: DataFrame | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """Lines with their part. The given columns are joined, and what is derived from them is
    computed after the join: a shuffle moves numbers, not texts."""
    given = table(spark, d, "lineitem") if source is None else source
    joined = given.join(counted(table(spark, d, "part")), F.col("l_partkey") == F.col("p_partkey"))
    return joined.selectExpr(*_select({**PART, **LINE, **(more or {})}))


def _lines_of_orders(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))


#: Given columns that items, and facts, are made of; the order's key is the line's.
_GIVEN = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "o_custkey", "o_orderdate",
          "o_orderpriority")
ITEM_GIVEN = (*_GIVEN, "l_discount", "l_tax", "o_orderstatus")
PART_GIVEN = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
FACT_GIVEN = (*_GIVEN, "l_quantity", "l_shipdate", "l_returnflag")
#: What ``ITEM`` and ``FACT`` take of lines and orders.
_NO_ITEM = ("QUANTITY", "UNIT_PRICE_USD", "REQUESTED_DELIVERY_DATE", "UNIT_OF_MEASURE")
_NO_FACT = ("ID", "VENDOR_CONFIDENCE", "OWN_CONFIDENCE", "DASHBOARD_STATUS")


def purchases(spark, d, columns=ITEM_GIVEN) -> DataFrame:
    """Given columns of lines with their order, written once: a query that reads items or facts
    several times moves the lines once, and only numbers."""
    return materialize(_lines_of_orders(spark, d).select(*columns), "purchases")


def items(spark, d, lines_: DataFrame | None = None) -> DataFrame:
    """Lines with order and part, named like the item table; ``lines_``: see :func:`purchases`."""
    given = _lines_of_orders(spark, d) if lines_ is None else lines_
    return _shaped(given, counted(table(spark, d, "part")))


def _shaped(given: DataFrame, parts_: DataFrame) -> DataFrame:
    """Items of the given columns of lines and orders, and of parts."""
    return _named(given.join(parts_, F.col("l_partkey") == F.col("p_partkey")))


def _named(joined: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    columns = {**PART, **LINE, **ORDER, "O_KEY": "l_orderkey", **{name: name for name in more}}
    wanted = {name: text for name, text in columns.items() if name not in _NO_ITEM}
    return joined.selectExpr(*_select(wanted)).selectExpr(*ITEM, *more)


#: Columns of ``items``; the same text serves as SQL.
ITEM = ("ID", "PO_ITEM_ID", "PO_ID", "DESCRIPTION", "SUPPLIER_ORG", "BUYER_ORG", "SUPPLIER_PART",
        "MANUFACTURER_PART",
        "case when P_KEY % 7 = 0 then cast(null as string) when P_KEY % 7 = 1 then 'NA' "
        "when P_KEY % 7 = 2 then '?' else BRAND end as MANUFACTURER_NAME",
        "ITEM_TYPE", "IS_ADHOC", "IS_BLANKET", "DASHBOARD_STATUS", "CODE", "DOCUMENT_DATE",
        "DOCUMENT_DATE as _DELTA_CREATED_ON", "DOCUMENT_DATE as _DELTA_UPDATED_ON",
        "CODE as AN_UNSPSC_COMMODITY", "VENDOR_CODE", "VENDOR_CONFIDENCE", "OWN_CODE",
        "OWN_CONFIDENCE", "P_KEY")

#: Network fact columns over lines and orders.
FACT = ("concat('AN', cast(SUPPLIER_ORG as string)) as SUPPLIER_ANID", "PO_ID as PO",
        "PO_ITEM_ID as ID", "BUYER_ORG", "SUPPLIER_ORG",
        "REQUESTED_DELIVERY_DATE", "DOCUMENT_DATE",
        "concat('C', cast(SUPPLIER_ORG % 5 as string)) as SHIP_TO_COUNTRY", "UNIT_OF_MEASURE",
        "QUANTITY", "UNIT_PRICE_USD", "PRODUCT_ID", "IS_BLANKET")


def fact(spark, d, lines_: DataFrame | None = None) -> DataFrame:
    given = _lines_of_orders(spark, d) if lines_ is None else lines_
    columns = {**LINE, **ORDER, "O_KEY": "l_orderkey"}
    return given.selectExpr(*_select({k: v for k, v in columns.items() if k not in _NO_FACT})).selectExpr(*FACT)


#: Product dimension from parts; broken codes stay NULL.
_LEGAL = "CODE is not null and length(CODE) = 8 and CODE <> '00000000'"
PRODUCT = ("cast(P_KEY as string) as ID",
           *(f"case when {_LEGAL} then substr(CODE, 1, {2 * n}) else cast(null as string) end "
             f"as UNSPSC_{level}" for n, level in enumerate(LEVELS, start=1)))


def products(spark, d) -> DataFrame:
    return parts(spark, d).selectExpr(*PRODUCT)


def _levels(name: str, source: str, condition: str) -> list[str]:
    return [f"case when {condition} then substr({source}, 1, {2 * n}) end as {name}_{level}"
            for n, level in enumerate(LEVELS, start=1)]


_ANSWERED = "P_KEY % 5 = 0 and VENDOR_CODE is not null"

#: The item table half-way through its enrichment.
ITEM_TABLE = (
    "ID", "PO_ITEM_ID", "DESCRIPTION", "lower(DESCRIPTION) as PROCESSED_DESCRIPTION",
    "MANUFACTURER_PART", "MANUFACTURER_NAME", "SUPPLIER_PART", "ITEM_TYPE", "IS_ADHOC",
    "SUPPLIER_ORG", "BUYER_ORG", "DASHBOARD_STATUS",
    "case when P_KEY % 3 = 0 then 'Poor' else 'Good' end as AN_DATA_QUALITY_LEVEL",
    *(f"cast(null as string) as AN_UNSPSC_{level}" for level in LEVELS[:-1]),
    "AN_UNSPSC_COMMODITY",
    *("case when P_KEY % 4 = 0 then cast(null as string) when P_KEY % 4 = 1 then 'Poor' "
      f"else 'Acceptable' end as AN_CLASSIFICATION_QUALITY_{level}" for level in LEVELS),
    *_levels("EXTERNAL_PREDICATED_UNSPSC", "VENDOR_CODE", _ANSWERED),
    "VENDOR_CONFIDENCE as EXTERNAL_PREDICATION_CONFIDENCE_COMMODITY",
    f"case when {_ANSWERED} then DOCUMENT_DATE end as EXTERNAL_PREDICATION_LASTUPDATED_AT",
    *_levels("SBN_PREDICATED_UNSPSC", "OWN_CODE", "P_KEY % 7 = 0"),
    *(f"case when P_KEY % 7 = 0 then OWN_CONFIDENCE end as SBN_PREDICTION_CONFIDENCE_{level}"
      for level in LEVELS),
    "case when P_KEY % 7 = 0 then DOCUMENT_DATE end as SBN_PREDICTION_LASTUPDATED_AT",
    "case when P_KEY % 7 = 0 then concat('M', cast(P_KEY % 2 as string)) end as MODEL_UUID",
    *(f"cast(null as string) as FINAL_REPORT_UNSPSC_{level}" for level in LEVELS),
    *(f"cast(null as decimal(6,5)) as FINAL_REPORT_CONFIDENCE_{level}" for level in LEVELS),
    "case when P_KEY % 53 = 0 then 'by hand' end as FINAL_REPORT_UNSPSC_MANUAL_LABELED",
    "cast(null as timestamp) as FINAL_REPORT_LASTUPDATED_AT", "'job' as FINAL_REPORT_SOURCE",
    "_DELTA_CREATED_ON", "_DELTA_UPDATED_ON")


def item_table(spark, d, lines_: DataFrame | None = None) -> DataFrame:
    return items(spark, d, lines_).selectExpr(*ITEM_TABLE)


def shape_items(spark, d, df: DataFrame, *more: str) -> DataFrame:
    """The item table's columns and ``more`` of given columns; parts are broadcast, so that rows
    stay where they are."""
    return name_items(df.join(F.broadcast(table(spark, d, "part")), F.col("l_partkey") == F.col("p_partkey")), *more)


def name_items(joined: DataFrame, *more: str) -> DataFrame:
    """The same of given columns of items and of their parts."""
    return _named(joined, more).selectExpr(*ITEM_TABLE, *more)


def given_items(spark, d) -> DataFrame:
    """Given columns of items, with their ID."""
    return _with_id(_lines_of_orders(spark, d).select(*ITEM_GIVEN))


def written_items(spark, d, with_parts: bool) -> DataFrame:
    """The same in files, also ``with_parts``: if these are many, their few words are moved and
    not what is made of them."""
    given = _lines_of_orders(spark, d).select(*ITEM_GIVEN)
    if with_parts:
        given = given.join(table(spark, d, "part").select(*PART_GIVEN), F.col("l_partkey") == F.col("p_partkey"))
    return _with_id(materialize(given, "given-items"))


def _with_id(given: DataFrame) -> DataFrame:
    return given.withColumn("ID", F.expr(_ITEM_ID))


# -- SQL ---------------------------------------------------------------------------------

_PURCHASES = "lines join orders_b on PO_ID = O_KEY"

CTE = {
    "commodity": _sql(COMMODITY, "part"),
    "parts": _sql(PART, "part"),
    "orders_b": _sql(ORDER, "orders"),
    "lines": _sql(LINE, "lineitem"),
    "items": f"select {', '.join(ITEM)} from {_PURCHASES} join parts using (P_KEY)",
    "fact": f"select {', '.join(FACT)} from {_PURCHASES}",
    "products": f"select {', '.join(PRODUCT)} from parts",
    "item_table": f"select {', '.join(ITEM_TABLE)} from items",
}
_NEEDS = {"items": ("lines", "orders_b", "parts"), "fact": ("lines", "orders_b"),
          "products": ("parts",), "item_table": ("lines", "orders_b", "parts", "items")}


def with_tables(names: str, body: str, **more: str) -> str:
    """``body`` with the named bound tables, and further common table expressions."""
    wanted: list[str] = []
    for name in names.split():
        for needed in (*_NEEDS.get(name, ()), name):
            if needed not in wanted:
                wanted.append(needed)
    parts_ = [f"{name} as ({CTE[name]})" for name in wanted]
    parts_ += [f"{name} as ({text})" for name, text in more.items()]
    return (f"with {', '.join(parts_)} {body}") if parts_ else body


# -- output helpers --------------------------------------------------------------------------

def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text and decimals as doubles, for a type-free comparison."""
    def shown(field):
        kind = field.dataType.simpleString()
        if kind.startswith("timestamp"):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if kind.startswith("decimal"):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)
    return df.select(*[shown(field) for field in df.schema.fields])


def sql_time(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') as {name or column.split('.')[-1]}"


# -- registry -------------------------------------------------------------------------------

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return add
