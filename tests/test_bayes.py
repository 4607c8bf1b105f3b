"""The classifier in tables against a plain one, numbers and top rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from spendweave.operators import bayes, numbering
from spendweave.plans import training

from .conftest import rows

WORDS = "bolt steel thread paper white office laptop screen keyboard cable red blue box".split()


def plain_bayes(data, most, levels):
    """A function text -> [(label, probability) of each level], with nested loops."""
    fit = [(t.split(), label) for t, label in data]
    count = {w: sum(t.count(w) for t, _ in fit) for w in {w for t, _ in fit for w in t}}
    kept = sorted(count, key=lambda w: (-count[w], w))[:most]
    idf = {w: round(math.log((len(fit) + 1) / (sum(w in t for t, _ in fit) + 1)) * 1e9) / 1e9 for w in kept}

    def children(node, up, down):
        own = [(t, label[:down]) for t, label in fit if label[:up] == node]
        for child in sorted({label for _, label in own}):
            texts = [t for t, label in own if label == child]
            sums = {w: sum(t.count(w) for t in texts) * idf[w] for w in kept}
            yield child, (math.log(len(texts) + 1) - math.log(len(own) + len({c for _, c in own})),
                          math.log(sum(sums.values()) + len(kept)), sums)

    def scores(text, node, up, down):
        found = [w for w in text.split() if w in idf]
        return {child: prior + sum(idf[w] * (math.log(sums[w] + 1) - slope) for w in found)
                for child, (prior, slope, sums) in children(node, up, down)}

    def predict(text):
        node, up, path = "", 0, []
        for down in levels or (99,):
            known = scores(text, node, up, down)
            best = min(known, key=lambda c: (-round(known[c], 7), c))
            path.append((best, 1 / sum(math.exp(s - known[best]) for s in known.values())))
            node, up = best, down
        return path

    return predict


@pytest.mark.parametrize("levels, most, bound", [((), 5, 10**6), ((), 100, 10**6), ((), 100, 0), ((), 5, 0),
                                                 ((2, 4, 6, 8), 5, 0), ((2, 4, 6, 8), 100, 0)])
def test_equals_a_plain_classifier(spark, levels, most, bound, monkeypatch):
    monkeypatch.setattr(bayes, "BROADCAST_WEIGHTS", bound)
    pick = random.Random(len(levels) + most)
    codes = [f"{a}{b}{c}00" for a in (10, 20) for b in (11, 12) for c in ("01", "02")]
    data = [(" ".join(pick.choices(WORDS, k=pick.randrange(6))), pick.choice(codes)) for _ in range(120)]
    frame = spark.createDataFrame(data, "feature string, code string")
    model = bayes.fit(frame, "feature", "code", most + 1, levels)
    texts = [" ".join(pick.choices([*WORDS, "unknown"], k=k)) for k in range(8)] + ["", "nothing known"]
    found = bayes.predict(model, spark.createDataFrame([(t,) for t in texts * 2], "feature string"), "feature", True)
    by_hand = plain_bayes(data, most, levels)
    answers = {}
    for r in found.collect():
        expected = by_hand(r.feature)
        assert r.level_labels == [label for label, _ in expected]
        assert r.level_probas == pytest.approx([p for _, p in expected], abs=6e-4)
        assert r.predicted_label_proba == pytest.approx(math.prod(p for _, p in expected), abs=6e-4)
        assert answers.setdefault(r.feature, r) == r
    assert found.count() == 2 * len(texts)


def test_no_class_and_missing_values(spark):
    empty = bayes.fit(spark.createDataFrame([("a b", None)], "feature string, code string"), "feature", "code", 10)
    asked = spark.createDataFrame([("a",), (None,)], "feature string")
    assert rows(bayes.predict(empty, asked, "feature")) == [("a", None, None), (None, None, None)]
    one = bayes.fit(spark.createDataFrame([("a b", "7"), (None, "7"), (None, "9")], "feature string, code string"),
                    "feature", "code", 10)
    assert {r.predicted_label for r in bayes.predict(one, asked, "feature").collect()} == {"7"}


def test_ties_go_to_the_smallest_label_and_rows_keep_their_columns(spark):
    frame = spark.createDataFrame([("a", "2"), ("a", "1")], "feature string, code string")
    asked = spark.createDataFrame([("a", 1, 5), ("zz", 2, 6)], "feature string, number int, row int")
    found = bayes.predict(bayes.fit(frame, "feature", "code"), asked, "feature")
    assert rows(found) == [("a", 1, 5, "1", 0.5), ("zz", 2, 6, "1", 0.5)]


def test_model_is_saved_and_holds_no_matrix(spark, tmp_path):
    pick = random.Random(5)
    data = [(f"w{pick.randrange(40)} w{pick.randrange(40)}", f"{10 + k % 60}000000") for k in range(300)]
    model = bayes.fit(spark.createDataFrame(data, "feature string, code string"), "feature", "code", 41, (2, 8))
    model.save(str(tmp_path))
    again = bayes.SparseBayes.load(spark, str(tmp_path))
    asked = spark.createDataFrame([("w1 w2",), ("w7",)], "feature string")
    assert rows(bayes.predict(model, asked, "feature")) == rows(bayes.predict(again, asked, "feature"))
    entries = model.weights.where("node = '0:'").select(F.sum(F.size("postings"))).first()[0]
    assert entries == len({(w, code) for text, code in data for w in text.split()})      # only what occurs


def test_classifier_of_many_codes_down_the_levels(spark):
    """Codes in the thousands; each is spelled by words of its levels."""
    codes = [f"{a}{b}{c}{d}" for a in range(10, 15) for b in range(10, 16) for c in range(10, 16) for d in range(10, 18)]
    data = [(i, code, f"s{code[:2]} f{code[:4]} c{code[:6]} x{code}") for i, code in enumerate(codes * 4)]
    table = spark.createDataFrame(data, "PO_ITEM_ID bigint, CODE string, DESCRIPTION string")
    options = training.TrainingOptions(threshold=2, sample=None, classifier="top_down")
    model, metrics = training.train(table, options, parts=["DESCRIPTION"])
    assert {r.digits: r.f1 > 0.95 for r in metrics.collect()} == {2: True, 4: True, 6: True, 8: True}
    assert model.levels == (2, 4, 6, 8)
    with pytest.raises(ValueError):
        training.fit_classifier(table, training.TrainingOptions(classifier="none"))


@pytest.mark.parametrize("levels", [(), (2, 8)])
def test_scoring_makes_no_rows_of_texts_and_classes(spark, levels, monkeypatch):
    """Whatever a text shares with the classes, a block of them gives one row for it."""
    monkeypatch.setattr(bayes, "BROADCAST_WEIGHTS", 200)
    monkeypatch.setattr(bayes, "LONG", 3)
    written = []
    keep = bayes.materialize
    monkeypatch.setattr(bayes, "materialize", lambda df, label="stage": written.append(keep(df, label)) or written[-1])
    data = [(f"all w{k % 7} v{k % 5}", f"{10 + k % 3}0000{10 + k % 20}") for k in range(120)]
    frame = spark.createDataFrame(data, "feature string, code string")
    model = bayes.fit(frame, "feature", "code", None, levels)
    del written[:]
    asked = spark.createDataFrame([(t, k) for k, (t, _) in enumerate(data)], "feature string, k int")
    answers = rows(bayes.predict(model, asked, "feature"))
    monkeypatch.setattr(bayes, "BROADCAST_WEIGHTS", 10**6)
    monkeypatch.setattr(bayes, "LONG", 10**6)
    assert answers == rows(bayes.predict(model, asked, "feature"))
    assert len(written) > 6 and max(df.count() for df in written) <= len(data)


def test_a_text_is_scored_in_the_block_of_its_node_only(spark, monkeypatch):
    """Below the root; blocks of classes are not all scored against every text."""
    monkeypatch.setattr(bayes, "BROADCAST_WEIGHTS", 60)
    scored = []
    keep = bayes.materialize
    monkeypatch.setattr(bayes, "materialize", lambda df, label="stage": keep(df, label) if label != "scores"
                        else scored.append(keep(df, label)) or scored[-1])
    data = [(f"all w{k % 7} v{k % 5}", f"{10 + k % 6}0000{10 + k % 20}") for k in range(120)]
    frame = spark.createDataFrame(data, "feature string, code string")
    model = bayes.fit(frame, "feature", "code", None, (2, 8))
    answers = rows(bayes.predict(model, frame, "feature"))
    below = [df.count() for df in scored if "node" in df.columns]
    assert len(below) > 2 and sum(below) == len({text for text, _ in data})
    monkeypatch.setattr(bayes, "BROADCAST_WEIGHTS", 10**6)
    assert answers == rows(bayes.predict(model, frame, "feature"))


@pytest.mark.parametrize("settings", [{"LONG": 1}, {"WIDE": 1, "CELLS": 300}])
def test_texts_are_scored_alike_one_by_one_and_together(spark, settings, monkeypatch):
    pick = random.Random(8)
    data = [(" ".join(pick.choices(WORDS, k=pick.randrange(9))), f"{pick.randrange(10, 40)}") for _ in range(200)]
    frame = spark.createDataFrame(data, "feature string, code string")
    model = bayes.fit(frame, "feature", "code", 12)
    # so many words that their sum is beyond the whole numbers of a double
    asked = frame.select("feature").unionByName(spark.createDataFrame([("bolt " * 3_000_000,)], "feature string"))
    expected = rows(bayes.predict(model, asked, "feature").drop("feature"))
    for name, value in settings.items():
        monkeypatch.setattr(bayes, name, value)
    assert rows(bayes.predict(model, asked, "feature").drop("feature")) == expected


def test_texts_to_score_lie_in_several_files(spark, monkeypatch):
    """So that all cores score them, however few bytes they are."""
    written = {}
    keep = bayes.materialize
    monkeypatch.setattr(bayes, "materialize", lambda df, label="stage": written.setdefault(label, keep(df, label)))
    frame = spark.createDataFrame([(f"w{k}", f"{k % 3}") for k in range(60)], "feature string, code string")
    model = bayes.fit(frame, "feature", "code")
    assert bayes.predict(model, frame, "feature").count() == 60
    assert written["texts"].count() == 60 and len(written["texts"].inputFiles()) > 4


def test_dense_numbers(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as v", "id % 7 as g").repartition(8)
    numbered = numbering.dense_number(df, ["v"], "n", 1)
    assert all(r.n == r.v + 1 for r in numbered.collect()) and numbered.count() == 1000
    assert numbering.dense_number(df.limit(0), ["v"], "n").count() == 0
    tied = numbering.dense_number(df, [F.desc("g")], "n")
    assert sorted(r.n for r in tied.collect()) == list(range(1000))
    assert [r.n for r in tied.where("g = 6").orderBy("n").collect()] == list(range(142))


@pytest.mark.parametrize("k", [0, 1, 5, 40, 99, 300, 500])
def test_top_rows(spark, k):
    pick = random.Random(k)
    data = [(i, pick.choice([1, 1, 2, 3, 1500, 1501, 9000, 2**40 + i % 3])) for i in range(300)]
    df = spark.createDataFrame(data, "id long, n long")
    assert rows(numbering.top_rows(df, k, "n", ["id"])) == sorted(sorted(data, key=lambda r: (-r[1], r[0]))[:k], key=repr)


def test_vocabulary_and_labels_need_no_single_task(spark):
    """Neither a top-k nor a window over all rows is left in the plans."""
    from spendweave.operators import labels, vocabulary
    pick = random.Random(3)
    data = [(k, " ".join(pick.choices([f"w{n}" for n in range(400)], k=30)), f"{pick.randrange(300)}") for k in range(200)]
    df = spark.createDataFrame(data, "k long, text string, label string")
    words = vocabulary.vocabulary(df, "text", "k", 101)
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "TakeOrdered" not in words._jdf.queryExecution().toString()
    assert "windowspecdefinition(word" not in plan and "__part" in plan
    count, first = {}, {}
    for k, text, _ in data:
        for pos, w in enumerate(text.split()):
            count[w] = count.get(w, 0) + 1
            first.setdefault(w, (k, pos))
    best = sorted(count, key=lambda w: (-count[w], first[w]))[:100]
    assert [r.word for r in words.orderBy("index").collect()] == best
    index = labels.label_index(df, "label")
    assert {r.label: r.label_index for r in index.collect()} == {
        v: n for n, v in enumerate(sorted({label for *_, label in data}))}
