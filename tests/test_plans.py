"""Whole plans in rounds, as the jobs run them."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from spendweave import columns as C
from spendweave import schemas
from spendweave.columns import LEVELS
from spendweave.operators import network as network_operator
from spendweave.operators.clean import align
from spendweave.plans import (evaluate, extract, finalize, inference, network, replicate, star,
                              vendor)
from spendweave.session import materialize

from .conftest import rows

#: A batch window, and moments on both of its edges and beyond.
T0, NOW = datetime(2019, 3, 1), datetime(2019, 9, 1)
MOMENTS = (T0 - timedelta(seconds=1), T0, T0 + timedelta(days=40), NOW, NOW + timedelta(seconds=1))


def inside(moment, start=T0, end=NOW):
    return start <= moment <= end




def frame(spark, schema, columns, data):
    """Rows with some columns of a table schema, the others NULL."""
    empty = spark.createDataFrame([], schema)
    kinds = {f.name: f.dataType.simpleString() for f in empty.schema}
    narrow = spark.createDataFrame(data, ", ".join(
        f"{name} {'bigint' if kinds[name].startswith('decimal(28') else kinds[name]}"
        for name in columns))
    return align(narrow, empty.schema)


def settle(df):
    """Cut the lineage between rounds, as a written table would."""
    return materialize(df, "round")


def lit(moment):
    return F.lit(moment)


# -- extract -----------------------------------------------------------------------------

def purchase(spark, seed):
    """Raw tables of random orders, as rows and as frames."""
    pick = random.Random(seed)
    orders = [(k, 900 + k, int(pick.random() < .2), pick.choice(MOMENTS)) for k in range(40)]
    documents = [(900 + k, 5, 6 + k % 2, f"PO_{k % 4}", pick.choice(MOMENTS)) for k in range(40)]
    lines = [(7000 + k, pick.randrange(40), f"thing {k % 9}") for k in range(120)]
    codes = [(60 + k, pick.choice(lines)[0], "UNSPSC", f"{10101010 + k}") for k in range(100)]
    orgs = [(5, "buyer", "The Buyer"), (6, "east", "East Ltd"), (7, "west", "West Ltd")]
    frames = {
        "po": frame(spark, schemas.PO, ["ID", "GENERIC_DOCUMENT", "IS_BLANKET", "_DELTA_UPDATED_ON"], orders),
        "cxml_document": frame(spark, schemas.CXML_DOCUMENT,
                               ["ID", "FROM_ORG", "TO_ORG", "DASHBOARD_STATUS", "_DELTA_UPDATED_ON"], documents),
        "po_item": frame(spark, schemas.PO_ITEM, ["ID", "PO", "DESCRIPTION"], lines),
        "po_item_commodity": frame(spark, schemas.PO_ITEM_COMMODITY, ["ID", "PO_ITEM", "DOMAIN", "CODE"], codes),
        "org": frame(spark, schemas.ORG, ["ID", "ANID", "NAME"], orgs)}
    return frames, orders, documents, lines, codes


def extracted(orders, documents, lines, codes, start, end):
    """ID -> code, status and supplier of what a window takes."""
    status = {d[0]: d for d in documents if inside(d[4], start, end)}
    taken = {o[0]: status[o[1]] for o in orders if not o[2] and inside(o[3], start, end) and o[1] in status}
    found = {}
    for line, order, _ in lines:
        if order in taken:
            own = [(k, code) for k, item, _, code in codes if item == line] or [(0, None)]
            for k, code in own:
                found[f"{line}-{k}"] = (code, taken[order][3], {6: "east", 7: "west"}[taken[order][2]])
    return found


def test_extract_takes_the_window_and_resets_enrichment(spark):
    raw, *tables = purchase(spark, 3)
    items = settle(extract.run(raw, spark.createDataFrame([], schemas.ITEM), T0, NOW, lit(NOW)))
    first = extracted(*tables, T0, NOW)
    assert rows(items, "ID", "AN_UNSPSC_COMMODITY", "DASHBOARD_STATUS", "SUPPLIER_ANID") == sorted(
        ((k, *v) for k, v in first.items()), key=repr)
    assert {r[0] for r in rows(items, "BUYER_NAME")} == {"The Buyer"}
    # half of the documents change after the window; what is extracted again loses its model
    later = NOW + timedelta(days=30)
    orders, documents, lines, codes = tables
    documents = [(*d[:3], "PO_LATER", later) if d[0] % 2 else d for d in documents]
    orders = [(*o[:3], later) if o[1] % 2 else o for o in orders]
    raw["po"] = frame(spark, schemas.PO, ["ID", "GENERIC_DOCUMENT", "IS_BLANKET", "_DELTA_UPDATED_ON"], orders)
    raw["cxml_document"] = frame(spark, schemas.CXML_DOCUMENT, ["ID", "FROM_ORG", "TO_ORG", "DASHBOARD_STATUS",
                                                                "_DELTA_UPDATED_ON"], documents)
    start = NOW + timedelta(days=10)
    second = settle(extract.run(raw, settle(items.withColumn("MODEL_UUID", F.lit("m"))), start, later, lit(later)))
    again = extracted(orders, documents, lines, codes, start, later)
    assert again and set(first) - set(again)
    assert {r.ID for r in second.where("MODEL_UUID is null").collect()} == set(again)
    assert {r.ID: r.DASHBOARD_STATUS for r in second.collect()} == {
        k: v[1] for k, v in {**first, **again}.items()}
    created = {r.ID: r._DELTA_CREATED_ON for r in second.collect()}
    assert all(created[k] == (NOW if k in first else later) for k in created)
    assert rows(extract.run(raw, second, start, later, lit(later))) == rows(second)


# -- evaluate ----------------------------------------------------------------------------

def test_evaluate_rewrites_only_what_changed(spark):
    commodity = spark.createDataFrame([("44121706", 1), ("441217", 1), ("4412", 0)], "CODE string, VALID int")
    names = ["ID", "DESCRIPTION", "AN_UNSPSC_COMMODITY", "_DELTA_UPDATED_ON"]
    data = [(f"i{k}", f"wooden pencil no {k}", ("44121706", "44120000", "0", None)[k % 4], MOMENTS[k % 5]) for k in range(20)]
    first = settle(evaluate.run(frame(spark, schemas.ITEM, names, data), commodity, T0, NOW, lit(NOW)))
    touched = {r.ID for r in first.where(F.col("PROCESSED_DESCRIPTION").isNotNull()).collect()}
    assert touched == {i for i, *_, moment in data if inside(moment)}
    edited = settle(first.withColumn("DESCRIPTION", F.expr("if(ID in ('i1', 'i2'), 'steel RULER', DESCRIPTION)")))
    later = NOW + timedelta(hours=1)
    second = evaluate.run(edited, commodity, T0, NOW, lit(later))
    assert rows(second.where(F.col("_DELTA_UPDATED_ON") == lit(later)), "ID", "PROCESSED_DESCRIPTION") == [
        (i, "steel ruler") for i in ("i1", "i2") if i in touched]


# -- vendor ------------------------------------------------------------------------------

VENDOR = ["ID", "PO_ITEM_ID", "DASHBOARD_STATUS", "DESCRIPTION", "PROCESSED_DESCRIPTION", "AN_DATA_QUALITY_LEVEL",
          "EXTERNAL_PREDICATED_UNSPSC_SEGMENT", "EXTERNAL_PREDICATED_UNSPSC_COMMODITY", "_DELTA_UPDATED_ON"]


def vendor_items(seed):
    pick = random.Random(seed)
    return [(f"v{k}", 500 + k, pick.choice(["PO_NEW", "PO_SENT", "PO_OBSOLETED"]), f"Text, {k % 12}", f"text {k % 12}",
             pick.choice(["Good", "Good", "Poor"]), pick.choice([None, None, "31"]), pick.choice([None, None, "31150000"]),
             pick.choice(MOMENTS)) for k in range(80)]


def test_export_lists_each_open_text_once(spark, tmp_path):
    data = vendor_items(8)
    items = frame(spark, schemas.ITEM, VENDOR, data)
    report = frame(spark, schemas.VENDOR_REPORT, ["PROCESSED_DESCRIPTION", "UNSPSC_SEGMENT"], [("text 1", "31"), ("text 4", None)])
    first = {}
    for row in sorted(data, key=lambda r: r[1]):
        if row[2] != "PO_OBSOLETED" and row[5] == "Good" and row[6] is None and row[7] is None and inside(row[8]):
            first.setdefault(row[4], row[1])
    candidates = vendor.export_candidates(items, T0, NOW)
    assert rows(candidates, "PROCESSED_DESCRIPTION", "PO_ITEM_ID") == sorted(first.items(), key=repr)
    path, known = str(tmp_path / "out"), {"text 1", "text 4"}
    marked = settle(vendor.run_export(items, report, path, T0, NOW, "2019-09-01"))
    assert {r[0] for r in rows(marked, "PROCESSED_DESCRIPTION")} == known | set(first)
    exported = spark.read.options(header=True, escape='"').csv(path)
    assert {(r.PROCESSED_DESCRIPTION, r.DESCRIPTION) for r in exported.collect()} == {
        (t, t.replace("text", "Text,")) for t in set(first) - known}
    again = vendor.run_export(items, marked, path, T0, NOW, "2019-09-01")        # nothing is left
    assert rows(again, "PROCESSED_DESCRIPTION") == rows(marked, "PROCESSED_DESCRIPTION")
    some = vendor.to_export(candidates, report, 2)
    assert [r[0] for r in rows(some, "PROCESSED_DESCRIPTION")] == sorted(set(first) - known)[:2]


def test_import_takes_the_newest_answer(spark):
    data = vendor_items(9)
    items = frame(spark, schemas.ITEM, VENDOR, data)
    report = frame(spark, schemas.VENDOR_REPORT, ["PROCESSED_DESCRIPTION"], [("text 0",)])
    names = ["DESCRIPTION", "PROCESSED_DESCRIPTION", *[f"PREDICATED_UNSPSC_{level}" for level in LEVELS],
             "PREDICATION_LASTUPDATED_AT"]
    answers = [(f"answer {k}", f"text {k % 5}", *[str(20 + k) + "11" * n for n in range(4)], T0 + timedelta(days=k)) for k in range(10)]
    merged_items, merged = vendor.run_import(items, report, frame(spark, schemas.VENDOR_FEED, names, answers), lit(NOW))
    newest = {f"text {k % 5}": (f"answer {k}", str(20 + k)) for k in range(10)}
    assert {r.PROCESSED_DESCRIPTION: (r.DESCRIPTION, r.UNSPSC_SEGMENT) for r in merged.collect()} == newest
    for r in merged_items.collect():
        expected = newest.get(r.PROCESSED_DESCRIPTION)
        assert (r.DESCRIPTION, r.EXTERNAL_PREDICATED_UNSPSC_SEGMENT) == (expected or next(
            (row[3], row[6]) for row in data if row[0] == r.ID))
        assert r.EXTERNAL_PREDICATION_CONFIDENCE_SEGMENT is None


def test_apply_leaves_answered_items_and_other_windows(spark):
    names = ["ID", "PROCESSED_DESCRIPTION", "EXTERNAL_PREDICATED_UNSPSC_SEGMENT", "EXTERNAL_PREDICATION_LASTUPDATED_AT",
             "_DELTA_UPDATED_ON"]
    data = [(f"a{k}", f"t{k % 3}", "10" if k % 4 == 0 else None, T0 if k % 4 == 0 else None, MOMENTS[k % 5]) for k in range(30)]
    stored = frame(spark, schemas.VENDOR_REPORT, ["DESCRIPTION", "PROCESSED_DESCRIPTION", "UNSPSC_SEGMENT",
                                                  "REPORT_LASTUPDATED_AT"], [("T1", "t1", "27", NOW), ("T2", "t2", "28", NOW)])
    result = vendor.run_apply(frame(spark, schemas.ITEM, names, data), stored, T0, NOW)
    segment = {"t1": "27", "t2": "28"}
    assert rows(result, "ID", "EXTERNAL_PREDICATED_UNSPSC_SEGMENT") == sorted(
        ((i, old if answered or not inside(moment) else segment.get(t)) for i, t, old, answered, moment in data), key=repr)


# -- finalize -----------------------------------------------------------------------------

def test_finalize_needs_confidence_and_no_hand(spark):
    names = ["ID", "EXTERNAL_PREDICATED_UNSPSC_COMMODITY", "EXTERNAL_PREDICATION_CONFIDENCE_COMMODITY",
             "FINAL_REPORT_UNSPSC_MANUAL_LABELED", "_DELTA_UPDATED_ON"]
    data = [(f"f{k}", "27112008", Decimal(k) / 10, "hand" if k % 3 == 2 else None, MOMENTS[k % 5]) for k in range(11)]
    result = finalize.run(frame(spark, schemas.ITEM, names, data), T0, NOW, lit(NOW))
    assert rows(result, "ID", "FINAL_REPORT_UNSPSC_FAMILY", "FINAL_REPORT_LASTUPDATED_AT") == sorted(
        ((i, *(("2711", NOW) if confidence > Decimal("0.8") and not hand and inside(moment) else (None, None)))
         for i, _, confidence, hand, moment in data), key=repr)


# -- star and network -------------------------------------------------------------------------

def test_star_over_rounds(spark):
    """Codes change, lines become obsolete, facts come late; a product is one item of a line."""
    pick = random.Random(6)
    names = ["ID", "PO_ITEM_ID", "DASHBOARD_STATUS", "FINAL_REPORT_UNSPSC_COMMODITY", "_DELTA_UPDATED_ON"]
    facts = [(k, None, int(k % 7 == 0), T0, T0) for k in range(20)]
    fact_schema = "ID bigint, PRODUCT_ID string, IS_BLANKET int, _DELTA_CREATED_ON timestamp, _DELTA_UPDATED_ON timestamp"
    fact = spark.createDataFrame(facts[:15], fact_schema)
    dimension, products, links = spark.createDataFrame([], schemas.DIMENSION), {}, {k: None for k in range(15)}
    start = T0
    for round_ in range(3):
        end = start + timedelta(days=30)
        items = [(f"p{k}-{n}", k, pick.choice(["PO_NEW", "PO_OBSOLETE"]), f"{round_}{k:02}{n}0000",
                  start + timedelta(days=pick.choice([-9, -3, 5, 20, 31]))) for k in range(20) for n in range(2)]
        best = defaultdict(list)
        for i, k, status, code, moment in items:
            if status != "PO_OBSOLETE" and start - timedelta(days=7) <= moment <= end:
                best[k].append((-moment.timestamp(), i, code))
        chosen = {k: min(found)[1:] for k, found in best.items()}
        products.update(chosen.values())
        links = {k: chosen[k][0] if k in chosen and k % 7 else v for k, v in links.items()}
        dimension, fact = map(settle, star.run(frame(spark, schemas.ITEM, names, items), dimension, fact, start, end, lit(end)))
        assert rows(dimension, "ID", "UNSPSC_COMMODITY") == sorted(products.items())
        assert {r.ID: r.PRODUCT_ID for r in fact.collect()} == links
        if round_ == 0:                       # late facts
            fact = settle(fact.unionByName(spark.createDataFrame(facts[15:], fact_schema)))
            links |= {k: None for k in range(15, 20)}
        start = end


def some_facts(spark, seed, n=300):
    pick = random.Random(seed)
    data = []
    for _ in range(n):
        po = pick.randrange(40)
        data.append((f"AN{po % 3}", po, po * 10 + pick.randrange(5), pick.choice([7, None]), po % 3,
                     datetime(2021, 1 + pick.randrange(3), 5), datetime(2021, 1 + po % 4, 9), pick.choice(["SE", None]), "EA",
                     pick.choice([1, 2, None]), pick.choice([1.25, 3.3333333, None]), str(pick.randrange(6)), 0))
    return spark.createDataFrame(data, schemas.FACT.split(", _DELTA")[0].replace("UNIT_PRICE_USD bigint", "UNIT_PRICE_USD double"))


def some_products(spark):
    return spark.createDataFrame([(str(k), *[f"{k}{'1' * n}" for n in (1, 3, 5, 7)]) for k in range(4)],
                                 "ID string, " + ", ".join(f"UNSPSC_{level} string" for level in LEVELS))


def totals_rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(
        *C.NETWORK_GROUP, "ORDER_AMOUNT", "ORDER_UNITS", "AVERAGE_UNIT_PRICE_USD", "PO_COUNT", "PO_ITEM_COUNT").collect()), key=repr)


def test_totals_by_steps_equal_distinct_counts(spark):
    facts, products = settle(some_facts(spark, 1)), some_products(spark)
    by_steps = network_operator.network_totals(facts, products)
    assert "Expand" not in by_steps._jdf.queryExecution().toString()
    assert totals_rows(by_steps) == totals_rows(network_operator.network_totals(facts, products, one_order=False))
    # an item in two orders: counted once in a group, so Spark counts
    twice = facts.unionByName(facts.withColumn("PO", F.col("PO") + 1000))
    assert "Expand" in network_operator.network_totals(twice, products)._jdf.queryExecution().toString()
    nowhere = facts.withColumn("PO", F.when(F.col("PO") % 2 == 0, F.col("PO")))
    assert totals_rows(network_operator.network_totals(nowhere, products)) == totals_rows(
        network_operator.network_totals(nowhere, products, one_order=False))


def test_incremental_totals_equal_a_recomputation(spark, tmp_path):
    """Rounds of late, changed and removed facts; some groups appear, some vanish."""
    products, path = some_products(spark), str(tmp_path / "state")
    facts = settle(some_facts(spark, 2))
    stamp = {name: F.lit("2020-01-01").cast("timestamp") for name in C.AUDIT}
    totals = settle(network.start_state(facts, products, path).withColumns(stamp))
    assert totals_rows(totals) == totals_rows(network_operator.network_totals(facts, products))
    for round_ in range(3):
        before = settle(facts.where(f"PO % 4 = {round_} and month(DOCUMENT_DATE) <> 4"))
        changed = before.where("PO % 3 <> 0").withColumns(
            {"QUANTITY": F.lit(5 + round_), "SHIP_TO_COUNTRY": F.lit("NO"), "PRODUCT_ID": F.lit("1")})
        late = some_facts(spark, 10 + round_, 20).where("month(DOCUMENT_DATE) < 3")
        after = settle(changed.unionByName(late))
        facts = settle(facts.where(f"not (PO % 4 = {round_} and month(DOCUMENT_DATE) <> 4)").unionByName(after))
        deltas = network.fact_deltas(before, after, products)
        new, months = network.update_totals(path, totals, deltas, lit(NOW))
        assert months <= 3
        kept = {r[:len(C.NETWORK_GROUP)] for r in totals_rows(totals)}
        totals = settle(new)
        assert totals_rows(totals) == totals_rows(network_operator.network_totals(facts, products))
        for r in totals.collect():           # what was there keeps its time of creation
            known = tuple(r[name] for name in C.NETWORK_GROUP) in kept
            assert known or r[C.CREATED] == NOW
    with pytest.raises(Exception, match="not in the state"):
        gone = network.fact_deltas(late.withColumn("PO", F.lit(99999)), late.limit(0), products)
        network.update_totals(path, totals, gone)


def test_network_job(spark):
    facts, products = settle(some_facts(spark, 4).where("SHIP_TO_COUNTRY is not null")), some_products(spark)
    empty = spark.createDataFrame([], schemas.NETWORK)
    start, end = datetime(2021, 1, 1), datetime(2021, 3, 31)
    totals = settle(network.run(facts, products, empty, start, end, now=lit(NOW)))
    groups = defaultdict(lambda: [set(), set(), 0])
    for r in facts.where("month(DOCUMENT_DATE) < 4").collect():
        code = f"{r.PRODUCT_ID}1111111" if int(r.PRODUCT_ID) < 4 else "99999999"
        orders, items, units = group = groups[r.SUPPLIER_ANID, r.BUYER_ORG, r.REQUESTED_DELIVERY_DATE.month,
                                              r.DOCUMENT_DATE.month, code]
        orders.add(r.PO)
        items.add(r.ID)
        group[2] = units + (r.QUANTITY or 0)
    assert {(r.SUPPLIER_ANID, r.BUYER_ORG, r.REQUESTED_DELIVERY_DATE.month, r.DOCUMENT_DATE.month, r.UNSPSC_COMMODITY):
            (r.PO_COUNT, r.PO_ITEM_COUNT, r.ORDER_UNITS or 0) for r in totals.where("BUYER_ORG is not null").collect()} == {
        k: (len(v[0]), len(v[1]), v[2]) for k, v in groups.items() if k[1] is not None}
    known = settle(totals.where("BUYER_ORG is not null"))
    again = network.run(facts.where("BUYER_ORG is not null"), products, known, start, end, now=lit(NOW))
    assert totals_rows(again) == totals_rows(known)
    # a NULL in the key: inserted again, unless NULLs may match
    nulls = settle(facts.withColumn("SHIP_TO_COUNTRY", F.lit(None).cast("string")))
    once = settle(network.run(nulls, products, empty, start, end))
    assert network.run(nulls, products, once, start, end).count() == 2 * once.count()
    assert network.run(nulls, products, once, start, end, null_safe=True).count() == once.count()


def test_commodity_dimension(spark):
    raw = spark.createDataFrame([(k, 31000000 + 7 * k, ("Class", "Commodity")[k % 2]) for k in range(9)],
                                "ID bigint, CODE bigint, LEVEL_NAME string")
    empty = spark.createDataFrame([], "ID bigint, CODE string, LEVEL_NAME string, _DELTA_CREATED_ON timestamp, "
                                      "_DELTA_UPDATED_ON timestamp")
    assert rows(replicate.load_commodity(raw, empty), "ID", "CODE", "LEVEL_NAME") == [
        (k, str(31000000 + 7 * k), ("Class", "Commodity")[k % 2]) for k in range(9)]


# -- inference ---------------------------------------------------------------------------------

def by_length(batches):
    """A stand-in model: the label depends on the text's length."""
    for batch in batches:
        yield pd.DataFrame({"CONCAT_FEATURE": batch["CONCAT_FEATURE"],
                            "predicted_label": batch["CONCAT_FEATURE"].str.len().map(lambda n: f"{20 + n % 60}340000"),
                            "predicted_label_proba": 0.625})


def test_inference_scores_a_text_once(spark):
    """Three rounds: new texts, known texts beside a new one, another model over all."""
    names = ["ID", "PO_ITEM_ID", "DESCRIPTION", "IS_ADHOC", "BUYER_ORG", "SUPPLIER_ORG", "_DELTA_CREATED_ON",
             "_DELTA_UPDATED_ON"]

    def items_of(keys, text, moment):
        return [(f"n{k}", k, text(k), 1, 3, 4, moment(k), moment(k)) for k in keys]

    first = items_of(range(20), lambda k: f"brush {'x' * (k % 4)}" if k % 6 else None, lambda k: MOMENTS[k % 5])
    scorer = inference.python_scorer(by_length)
    items = frame(spark, schemas.ITEM, names, first)
    items, report = map(settle, inference.run(items, spark.createDataFrame([], schemas.MODEL_REPORT), scorer, "A", T0, NOW,
                                              now=lit(NOW)))
    scored = {k for k in range(20) if k % 6 and inside(MOMENTS[k % 5])}
    found = items.where("MODEL_UUID is not null")
    assert {r.PO_ITEM_ID for r in found.collect()} == scored and report.count() == len({k % 4 for k in scored})
    assert found.where("SBN_PREDICATED_UNSPSC_FAMILY like '%34' and SBN_PREDICATED_UNSPSC_CLASS is null and "
                       "SBN_PREDICTION_CONFIDENCE_FAMILY = 0.625 and SBN_PREDICTION_CONFIDENCE_CLASS is null"
                       ).count() == len(scored)
    later = NOW + timedelta(days=2)
    more = items_of(range(100, 106), lambda k: "brush x" if k % 2 else "a comb", lambda k: NOW + timedelta(days=1))
    items, report = map(settle, inference.run(
        settle(items.unionByName(frame(spark, schemas.ITEM, names, more))), report, scorer, "A",
        NOW + timedelta(hours=12), later, now=lit(later)))
    assert {r.PO_ITEM_ID: r.SBN_PREDICTION_LASTUPDATED_AT for r in items.where("PO_ITEM_ID >= 100").collect()} == {
        k: NOW if k % 2 else later for k in range(100, 106)}
    known = report.count()
    last = later + timedelta(days=1)
    items, report = inference.run(items, report, scorer, "B", T0, last, now=lit(last))
    everything = {k for k in range(20) if k % 6 and MOMENTS[k % 5] >= T0} | set(range(100, 106))
    assert {r.PO_ITEM_ID for r in items.where("MODEL_UUID = 'B'").collect()} == everything
    assert report.where("MODEL_UUID = 'A'").count() == known


def test_join_sources_moves_few_lines_of_other_orders(spark):
    """Of a larger batch than is broadcast, a filter of its keys comes before the shuffle."""
    from spendweave.operators.joins import key_filter, maybe_in, semi_filter
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = spark.createDataFrame([(k,) for k in [*range(0, 5000, 5), 5, None]], "k long")
        many = spark.range(20000).selectExpr("case when id % 7 > 0 then id end as id", "id as v")
        near = maybe_in(many, "id", key_filter(few, "k"))
        found = semi_filter(near, few, "id", "k")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftSemi") < plan.index("__bits")
        assert near.count() < 900 and rows(found) == rows(semi_filter(many, few, "id", "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_large_source_is_merged_in_one_pass(spark, monkeypatch):
    from spendweave.operators import upsert as merging
    target = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "ID long, V string")
    source = spark.createDataFrame([(2, "x"), (3, "y"), (None, "z")], "ID long, V string")
    lookups = merging.upsert(target, source, "ID")
    monkeypatch.setattr(merging, "FEW_ROWS", 2)
    merged = merging.upsert(target, source, "ID")
    assert rows(merged) == rows(lookups)
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
