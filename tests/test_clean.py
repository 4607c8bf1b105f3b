"""Cleaning operators on made-up rows; what is expected is worked out from the rows."""

import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spendweave.columns import NA_SPELLINGS
from spendweave.operators import clean, dedup, joins
from spendweave.operators.dedup import keep_first
from spendweave.plans.features import TRAINING_CLEANING, training_table
from spendweave.session import materialize
from spendweave.sources.readers import load_table

from .conftest import rows

TOOLS = [("awl", 3, "hand"), ("adze", 7, "hand"), ("drill", 7, "power"), ("jigsaw", 12, "power"),
         ("sander", 5, "power"), ("vice", 9, None), ("clamp", 2, "bench"), ("anvil", 40, "bench"),
         ("saw", 4, "hand")]


@pytest.fixture
def tools(spark):
    return spark.createDataFrame(TOOLS, "tool string, weight bigint, kind string")


def names(kept):
    return sorted(t[0] for t in TOOLS if kept(*t))


@pytest.mark.parametrize("wanted", [None, ["power"], ["hand", "bench"], "NOT NULL"])
def test_equality_filter(tools, wanted):
    result = clean.transform(tools, {"filter": {"kind": wanted}})

    def kept(tool, weight, kind):
        return kind is None if wanted is None else (
            kind is not None if wanted == "NOT NULL" else kind in wanted)

    assert sorted(row["tool"] for row in result.collect()) == names(kept)


def test_instructions_in_one_go(tools):
    result = clean.transform(tools, {
        "filter": {"kind": ["hand", "power"]}, "ne_filter": {"tool": ["adze"]},
        "not_contains_char_filter": {"tool": "il"}, "regex_pattern_filter": {"tool": "sa[a-z]"},
        "sort_values": {"sort_columns": ["tool"], "is_ascending": False},
        "rename": {"tool": "item", "kind": "group"}, "select": ["item", "group"]})
    left = [(t, k) for t, _, k in TOOLS if k in ("hand", "power") and t != "adze" and "il" not in t
            and re.search("sa[a-z]", t)]
    assert [tuple(row) for row in result.collect()] == sorted(left, reverse=True)


def test_filters_and_missing_values(tools):
    def count(instruction, column, value):
        return clean.transform(tools, {instruction: {column: value}}).count()

    assert count("filter", "weight", 7) == len(names(lambda t, w, k: w == 7))
    # a missing value differs from nothing and contains nothing
    assert count("ne_filter", "kind", ["hand"]) == len(names(lambda t, w, k: k not in (None, "hand")))
    assert count("ne_filter", "kind", "hand") == len(TOOLS)     # not a list: no filter
    assert count("contains_char_filter", "kind", "an") == len(names(lambda t, w, k: "an" in (k or "")))
    assert count("not_contains_char_filter", "kind", "an") == len(
        names(lambda t, w, k: k is not None and "an" not in k))


def test_prefix_and_union(spark):
    left = spark.createDataFrame([(7, "oak"), (8, "elm")], "no bigint, wood string")
    right = spark.createDataFrame([("elm", 8), ("ash", 9), ("ash", 9)], "wood string, no bigint")
    assert clean.prefix_columns(left, "w").columns == ["w_no", "w_wood"]
    assert rows(clean.union_all(left, right)) == [(7, "oak"), (8, "elm"), (9, "ash")]
    assert clean.union_all(left, right, distinct=False).count() == 5


PART = "VENDOR string, BUYER string, LINE string, TEXT string, MAKER string, CODE string"
PARTS = [("v1", "b1", "10", "hex bolt m8", "m-1", "31161501"), ("null", "b1", "11", "hex nut m8", "NA", "31161701"),
         ("v2", "b2", "12", "gasket, rubber", "?", "31181501"), ("v2", "b2", "13", "gasket, rubber", "?", "31181501"),
         (None, "b3", "?", "hydraulic hose", "m-2", "40142001"), ("v3", "b3", "10", None, "nan", "40142002")]


@pytest.fixture
def parts(spark):
    return spark.createDataFrame(PARTS, PART)


def unified(value):
    return "N/A" if value is None or value in NA_SPELLINGS else value


def test_unify_and_filter(parts):
    result = clean.unify_and_filter_na(parts, {
        "columns": ["VENDOR", "LINE", "MAKER"], "na_vals_list": list(NA_SPELLINGS), "replacement_val": "N/A",
        "na_filter_instructions": {"not_contains_char_filter": {"LINE": "N/A"}}})
    assert rows(result, "VENDOR", "LINE", "MAKER") == sorted(
        tuple(map(unified, (p[0], p[2], p[4]))) for p in PARTS if unified(p[2]) != "N/A")


def test_unify_numbers(spark):
    numbers = spark.sql("select cast(31 as decimal(28,0)) as n union all select null")
    assert rows(clean.unify_na(numbers, "n", NA_SPELLINGS)) == [("31",), ("N/A",)]


def test_two_stage_duplicates(parts):
    """First by line, the later text stays; then by content, the lower line stays."""
    result = clean.drop_duplicates(parts, {"index_col": ["LINE"],
                                           "cat_cols": ["VENDOR", "BUYER", "TEXT", "MAKER", "CODE"]},
                                   [clean.F.col("TEXT").desc_nulls_last(), "LINE"])
    assert rows(result) == sorted((p for k, p in enumerate(PARTS) if k not in (3, 5)), key=repr)


def test_missing_values(parts):
    with_text = [p for p in PARTS if p[3] is not None]
    assert rows(clean.drop_missing(parts, {"subset": ["TEXT"], "how": "any"})) == sorted(with_text, key=repr)
    assert clean.drop_missing(parts).count() == sum(None not in p for p in PARTS)
    filled = clean.fill_missing(parts, {"value": "none", "subset": ["VENDOR"]})
    assert filled.where("VENDOR = 'none'").count() == 1 and filled.where("TEXT is null").count() == 1


def test_keep_first_is_stable(spark):
    many = spark.range(1000).selectExpr("id % 7 as k", "id % 3 as v", "id")
    one = keep_first(many.repartition(1), "k", ["v"])
    eight = keep_first(many.repartition(8), "k", ["v"])
    assert rows(one) == rows(eight) and one.count() == 7


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(10_000).selectExpr("if(id % 3 = 0, 0, id) as k", "id")
    plan = keep_first(hot, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


TRAIN = ("SUPPLIER_ORG string, BUYER_ORG string, PO_ITEM_ID string, DESCRIPTION string, "
         "SUPPLIER_PART string, MANUFACTURER_NAME string, MANUFACTURER_PART string, "
         "ITEM_TYPE string, IS_ADHOC string, CODE string")
CODES = ["31161501", "31161700", "40142001"]


def line(number, code, supplier="s1", text="hex bolt m8", part="m-1"):
    return (supplier, "b1", number, text, "sp", "maker", part, "good", "0", code)


LINES = [line("1", "31161501"), line("2", "31161501"),                 # the same but for the number
         line("3", "31161700", supplier=None, part="?"),               # a code of three levels
         line("4", "31169999"), line("5", "3116"), line("6", "00142001"), line("7", None),   # no legal codes
         line("8", "40142001", text="hose"), line("8", "40142001", text="hose, long"),      # one number
         line("null", "40142001", text="pipe"), line("9", "40142001", text="Not Available")]


@pytest.fixture
def raw_training(spark):
    return spark.createDataFrame(LINES, TRAIN)


@pytest.fixture
def reference(spark):
    return spark.createDataFrame([(code,) for code in CODES], "CODE string")


def test_legal_codes(raw_training, reference):
    result = clean.legal_codes(raw_training, reference)
    expected = sorted((c, c[:2], c[2:4], c[4:6], c[6:]) for *_, c in LINES if c in CODES)
    assert rows(result, "CODE", "SEGMENT", "FAMILY", "CLASS", "COMMODITY") == expected
    # without a directory the form decides alone
    assert clean.legal_codes(raw_training).count() == len(expected) + 1


def test_training_table(raw_training, reference):
    result = training_table(raw_training, reference, TRAINING_CLEANING, ["CODE"])
    found = rows(result, "PO_ITEM_ID", "SUPPLIER_ORG", "MANUFACTURER_PART", "CODE")
    assert len(found) == 3
    assert found[0][0] in ("1", "2") and found[0][1:] == ("s1", "m-1", "31161501")
    assert found[1:] == [("3", "N/A", "N/A", "31161700"), ("8", "s1", "m-1", "40142001")]


def test_counts_come_with_the_result(parts):
    seen = {"selected": Observation("selected"), "na_filtered": Observation("na_filtered")}
    clean.clean_items(parts, clean.Cleaning(), counts=seen).collect()
    assert seen["selected"].get["rows"] == len(PARTS) == seen["na_filtered"].get["rows"]


def test_semi_filter(spark):
    left = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3), (None, 4)], "k string, n int")
    right = spark.createDataFrame([("q", "x"), ("r", "y"), ("r", "z"), (None, "w")], "k string, o string")
    assert rows(joins.semi_filter(left, right, "k", "k")) == [("q", 2), ("r", 3)]


def test_left_lookup_spreads_nulls(spark):
    left = spark.range(100).selectExpr("id", "if(id % 3 = 0, null, id % 5) as k")
    right = spark.range(4).selectExpr("id as r", "id * 10 as v")
    spread = joins.left_lookup(left, right, "k", "r")
    assert rows(spread, "id", "v") == rows(left.join(right, left["k"] == right["r"], "left"),
                                           "id", "v")


def test_table_types(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert load_table(str(tmp_path / "t"), "parquet", spark).count() == 3
    with pytest.raises(ValueError):
        load_table(str(tmp_path / "t"), "orc", spark)


def test_rows_that_do_not_repeat_are_not_moved(spark, monkeypatch):
    data = [(1, None), (1, None), (None, 1), (2, 3), (2, 3), (2, 3), (4, 5)]
    files = materialize(spark.createDataFrame(data, "a int, b int"))
    few = dedup.distinct_rows(files)
    assert rows(few) == rows(files.distinct()) and few.count() == 4
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
    monkeypatch.setattr(dedup, "FEW_REPEATS", 1)
    assert rows(dedup.distinct_rows(files)) == rows(files.distinct())


def test_codes_of_the_reference_are_counted_and_broadcast(spark, raw_training, reference):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        twice = reference.unionByName(reference.limit(1)).unionByName(reference.limit(1).withColumn("CODE", F.lit(None)))
        plan = clean.legal_codes(raw_training, twice)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows(clean.legal_codes(raw_training, twice)) == rows(clean.legal_codes(raw_training, reference))
