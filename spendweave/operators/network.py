"""Monthly spend per trading pair and commodity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import LEVELS, NETWORK_GROUP, UNKNOWN_CODE
from ..functions.measures import month_start, whole_amount
from .joins import left_lookup

#: Products up to which they are broadcast (some 150 bytes each); they are counted first.
FEW_PRODUCTS = 2_000_000

FACT_COLUMNS = ("SUPPLIER_ANID", "PO", "ID", "BUYER_ORG", "SUPPLIER_ORG",
                "REQUESTED_DELIVERY_DATE", "DOCUMENT_DATE", "SHIP_TO_COUNTRY",
                "UNIT_OF_MEASURE", "QUANTITY", "UNIT_PRICE_USD", "PRODUCT_ID")


def with_commodity(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Fact rows with the dimension's codes; NULL where there is no product."""
    code_columns = [f"UNSPSC_{level}" for level in LEVELS]
    products = dimension.select("ID", *code_columns).withColumnRenamed("ID", "__DIM")
    if dimension.count() <= FEW_PRODUCTS:
        products = F.broadcast(products)
    return left_lookup(fact, products, "PRODUCT_ID", "__DIM")


def network_lines(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Facts as they are counted: the group's columns by month and with codes, order, item,
    ``AMOUNT, QUANTITY, UNIT_PRICE_USD``."""
    coded = with_commodity(fact.select(*FACT_COLUMNS), dimension)
    return coded.withColumns({
        **{f"UNSPSC_{level}": F.coalesce(F.col(f"UNSPSC_{level}"), F.lit(UNKNOWN_CODE[level]))
           for level in LEVELS},
        "REQUESTED_DELIVERY_DATE": month_start(F.col("REQUESTED_DELIVERY_DATE")),
        "DOCUMENT_DATE": month_start(F.col("DOCUMENT_DATE")),
        "AMOUNT": whole_amount(F.col("QUANTITY"), F.col("UNIT_PRICE_USD")),
    }).select(*NETWORK_GROUP, "PO", "ID", "AMOUNT", "QUANTITY", "UNIT_PRICE_USD")


def items_have_one_order(lines: DataFrame) -> bool:
    """Whether no item is in several orders; two columns are read and aggregated."""
    orders = lines.where("ID is not null").groupBy("ID").agg(F.min("PO").alias("lo"), F.max("PO").alias("hi"),
                                                             F.max(F.col("PO").isNull()).alias("none"))
    return orders.where("lo <> hi or (none and lo is not null)").isEmpty()


def network_totals(fact: DataFrame, dimension: DataFrame, one_order: bool | None = None) -> DataFrame:
    """Amount, units, average price, orders and items per group and month.

    Items are counted by steps: lines by (group, order, item), these by (group, order), these
    by group. No row is multiplied, lines are moved once by group and order for the first two
    steps, and a large group is spread over its orders. That counts an item once if it has one order, which is looked
    up first (``one_order`` True skips it); otherwise Spark counts distinct values.
    """
    lines = network_lines(fact, dimension)
    if one_order is None:
        one_order = items_have_one_order(fact)
    if not one_order:
        return lines.groupBy(*NETWORK_GROUP).agg(
            F.sum("AMOUNT").alias("ORDER_AMOUNT"), F.sum("QUANTITY").alias("ORDER_UNITS"),
            F.avg("UNIT_PRICE_USD").alias("AVERAGE_UNIT_PRICE_USD"),
            F.count_distinct("PO").alias("PO_COUNT"), F.count_distinct("ID").alias("PO_ITEM_COUNT"))
    sums = ("AMOUNT", "QUANTITY", "PRICE", "PRICES")
    items = lines.repartition(*NETWORK_GROUP, "PO").groupBy(*NETWORK_GROUP, "PO", "ID").agg(
        F.sum("AMOUNT").alias("AMOUNT"), F.sum("QUANTITY").alias("QUANTITY"),
        F.sum("UNIT_PRICE_USD").alias("PRICE"), F.count("UNIT_PRICE_USD").alias("PRICES"))
    orders = items.groupBy(*NETWORK_GROUP, "PO").agg(F.count("ID").alias("ITEMS"), *[F.sum(s).alias(s) for s in sums])
    return orders.groupBy(*NETWORK_GROUP).agg(
        F.sum("AMOUNT").alias("ORDER_AMOUNT"), F.sum("QUANTITY").alias("ORDER_UNITS"),
        (F.sum("PRICE") / F.nullif(F.sum("PRICES"), F.lit(0))).alias("AVERAGE_UNIT_PRICE_USD"),
        F.count("PO").alias("PO_COUNT"), F.sum("ITEMS").alias("PO_ITEM_COUNT"))


# -- totals kept up to date by deltas ------------------------------------------------------

STATE_KEY = (*NETWORK_GROUP, "PO", "ID")
_SUMS = ("LINES", "AMOUNT", "AMOUNTS", "QUANTITY", "QUANTITIES", "PRICE", "PRICES")


def item_state(lines: DataFrame, sign: str | None = None) -> DataFrame:
    """Number of lines and exact sums by group, order and item; with ``sign`` (1 and -1) what
    they change by. Prices are added up as decimals, so that taking a line away leaves what
    was there without it."""
    factor = F.lit(1) if sign is None else F.col(sign)
    price = F.col("UNIT_PRICE_USD").cast("decimal(30,15)")
    counted = {"AMOUNT": F.col("AMOUNT"), "QUANTITY": F.col("QUANTITY"), "PRICE": price}
    sums = [F.sum(factor * F.coalesce(value, F.lit(0))).cast("decimal(38,15)" if name == "PRICE" else "bigint").alias(name)
            for name, value in counted.items()]
    counts = [F.sum(factor * value.isNotNull().cast("int")).alias(name)
              for name, value in zip(("AMOUNTS", "QUANTITIES", "PRICES"), counted.values(), strict=True)]
    return lines.groupBy(*STATE_KEY).agg(F.sum(factor).alias("LINES"), *sums, *counts).select(*STATE_KEY, *_SUMS)


def add_states(*states: DataFrame) -> DataFrame:
    """The sum of states; an item without lines has no row. A line taken away that was never
    counted fails."""
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    summed = both.groupBy(*STATE_KEY).agg(*[F.sum(s).cast(both.schema[s].dataType).alias(s) for s in _SUMS])
    checked = F.when(F.col("LINES") < 0, F.raise_error(F.lit("a line was removed that is not in the state"))).otherwise(
        F.col("LINES"))
    return summed.withColumn("LINES", checked).where("LINES <> 0")


def totals_of(state: DataFrame) -> DataFrame:
    """The totals of a state's groups, by steps as in :func:`network_totals`; an item counts
    once for every order that it is in."""
    sums = [s for s in _SUMS if s != "LINES"]
    orders = state.groupBy(*NETWORK_GROUP, "PO").agg(F.count("ID").alias("ITEMS"), *[F.sum(s).alias(s) for s in sums])
    groups = orders.groupBy(*NETWORK_GROUP).agg(
        *[F.sum(s).alias(s) for s in sums], F.count("PO").alias("PO_COUNT"), F.sum("ITEMS").alias("PO_ITEM_COUNT"))

    def known(value: str, count: str):
        return F.when(F.col(count) > 0, F.col(value))

    return groups.select(
        *NETWORK_GROUP, known("AMOUNT", "AMOUNTS").alias("ORDER_AMOUNT"), known("QUANTITY", "QUANTITIES").alias("ORDER_UNITS"),
        (known("PRICE", "PRICES").cast("double") / F.col("PRICES")).alias("AVERAGE_UNIT_PRICE_USD"),
        "PO_COUNT", "PO_ITEM_COUNT")
