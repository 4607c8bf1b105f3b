"""Codes, descriptions, reconciliation, metrics."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendweave.columns import LEVELS
from spendweave.functions import codes, text
from spendweave.functions.measures import month_start, whole_amount
from spendweave.operators import reconcile
from spendweave.operators.metrics import class_metrics
from spendweave.plans.evaluate import evaluate_items

from .conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("before, after", [
    ("Hex BOLT, zinc; hex", "hex bolt zinc"), ("M8.Nut", "m8 nut"), (None, ""),
    ("  Ring-pull  ", "ring pull"), ("oil oil OIL", "oil"), ("a[b]^c", "a b c")])
def test_clean_description(spark, before, after):
    found = one(spark, text.clean_description(F.lit(before).cast("string")))
    assert found == found.strip() and found.split() == after.split()


@pytest.mark.parametrize("cleaned, quality", [
    ("ab1234", "Poor"), ("abc", "Acceptable"), ("abcdefghijklmno", "Acceptable"),
    ("abcdefghijklmnop", "Good"), ("", "Poor"), ("1234567890123456789 ab", "Poor")])
def test_rate_description(spark, cleaned, quality):
    assert one(spark, text.rate_description(F.lit(cleaned))) == quality


def stripped(code):
    """By hand: pairs of zeros go from the end, the first pair stays."""
    code = code or "0"
    while len(code) > 2 and code.endswith("00"):
        code = code[:-2]
    return code


@pytest.mark.parametrize("code", ["40142000", "40140000", "40000000", "00000000", "40142010", "40100200", "0", None])
def test_strip_zero_pairs(spark, code):
    assert one(spark, codes.strip_zero_pairs(F.lit(code).cast("string"))) == stripped(code)


@pytest.mark.parametrize("label", ["40142008", "40142000", "40140000", "40000000"])
def test_levels_of_a_code(spark, label):
    deepest = len(stripped(label)) // 2
    assert one(spark, codes.deepest_level(F.lit(label))) == deepest
    for n in (1, 2, 3, 4):
        assert one(spark, codes.level_code(F.lit(label), n)) == (label[:2 * n] if n <= deepest else None)
        kept = one(spark, codes.level_confidence(F.lit(label), F.lit(0.6125), n))
        assert kept == (Decimal("0.61250") if n <= deepest else None)


def test_evaluate(spark):
    directory = {"31161501": 1, "311615": 1, "40": 1, "4014": 0}
    commodity = spark.createDataFrame([(int(code), valid) for code, valid in directory.items()],
                                      "CODE bigint, VALID int")
    given = [("i1", "Hexagonal bolt, galvanised", "31161501"), ("i2", "Bolt", "31161500"), ("i3", "x9", "40000000"),
             ("i4", "Copper pipe", "40140000"), ("i5", None, None), ("i6", "Gasket ring", "99999999")]
    found = rows(evaluate_items(spark.createDataFrame(given, "ID string, DESCRIPTION string, "
                                                             "AN_UNSPSC_COMMODITY string"), commodity),
                 "ID", *[f"AN_UNSPSC_{level}" for level in LEVELS],
                 "AN_CLASSIFICATION_QUALITY_SEGMENT", "AN_DATA_QUALITY_LEVEL")
    expected = []
    for item, shown, code in given:
        good, letters = directory.get(stripped(code)) == 1, sum(c.isalpha() for c in shown or "")
        expected.append((item, *(stripped(code)[:2 * n] if good else "0" for n in (1, 2, 3, 4)),
                         "Acceptable" if good else "Poor",
                         "Poor" if letters < 3 else "Good" if letters > 15 else "Acceptable"))
    assert found == expected


FINAL = ("ID string, AN_UNSPSC_COMMODITY string, EXTERNAL_PREDICATED_UNSPSC_COMMODITY string, "
         "EXTERNAL_PREDICATION_CONFIDENCE_COMMODITY double, SBN_PREDICATED_UNSPSC_COMMODITY string, "
         "SBN_PREDICTION_CONFIDENCE_COMMODITY double, AN_CLASSIFICATION_QUALITY_COMMODITY string")


def chosen(bought, vendor, vendor_sure, own, own_sure, quality):
    """By hand: who is sure enough wins; else a good or confirmed code of the buyer."""
    if vendor_sure > 0.8:
        return vendor, vendor_sure
    if own_sure > 0.8:
        return own, own_sure
    sure = vendor_sure if bought == vendor else own_sure if bought == own else None
    return (bought if quality == "Good" or sure is not None else None), sure


def test_final_code(spark):
    bought, vendor, own = "31161501", "31161620", "40142008"
    given = [(f"{n}", b, v, vs, o, os, q) for n, (b, v, vs, o, os, q) in enumerate(
        (b, v, vs, o, os, q) for b, v, o in ((bought, vendor, own), (bought, bought, own), (bought, vendor, bought))
        for vs in (0.55, 0.75, 0.84) for os in (0.6, 0.95) for q in ("", "Good"))]
    final = reconcile.final_code(spark.createDataFrame(given, FINAL))
    found = rows(final.withColumn("dated", F.col("FINAL_REPORT_LASTUPDATED_AT").isNotNull()), "ID",
                 "FINAL_REPORT_UNSPSC_SEGMENT", "FINAL_REPORT_UNSPSC_CLASS", "FINAL_REPORT_UNSPSC_COMMODITY",
                 "FINAL_REPORT_CONFIDENCE_FAMILY", "dated")
    expected = []
    for item, *facts in given:
        code, sure = chosen(*facts)
        expected.append((item, code and code[:2], code and code[:6], code, sure, sure is not None))
    assert found == sorted(expected, key=repr)


def test_measures(spark):
    row = spark.sql("select timestamp'2023-03-27 15:13:42' as t").select(
        month_start(F.col("t")).alias("m"), whole_amount(F.lit(-2.7), F.lit(1)).alias("a"),
        whole_amount(F.lit(3_000_000_000), F.lit(2.5)).alias("b")).first()
    assert str(row["m"]) == "2023-03-01 00:00:00" and (row["a"], row["b"]) == (-2, 7_500_000_000)


def test_class_metrics(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    found = class_metrics(spark.createDataFrame(pairs, "y string, p string"), "y", "p").first()
    # by hand: precision (4*3/4 + 2*2/3) / 7, recall 5/7, F1 (4*.75 + 2*.8) / 7
    assert tuple(found) == (0.619, 0.714, 0.657, 7)
