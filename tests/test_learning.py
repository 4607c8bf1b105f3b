"""Labels, samples, word ids, training."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spendweave.functions import text
from spendweave.operators import labels, sampling, vocabulary
from spendweave.plans import training

from .conftest import rows


HARBOURS = ["oslo", "bari", "oslo", "kiel", "bari", "oslo", "nice", "oslo", "bari", "riga", "oslo"]


@pytest.fixture
def ships(spark):
    return spark.createDataFrame(list(enumerate(HARBOURS)), "ship bigint, harbour string")


def test_value_counts(ships):
    counted = [tuple(r) for r in labels.value_counts(ships, "harbour").collect()]
    assert counted[:2] == [("oslo", 5), ("bari", 3)]
    assert sorted(counted) == sorted((h, HARBOURS.count(h)) for h in set(HARBOURS))


def test_rare_values(ships):
    rare_ones = sorted({h for h in HARBOURS if HARBOURS.count(h) < 3})
    replaced, rare = labels.balance(ships, "harbour", "replace", 3, "elsewhere")
    assert rows(rare) == [(h,) for h in rare_ones]
    assert rows(labels.value_counts(replaced, "harbour")) == [("bari", 3), ("elsewhere", 3), ("oslo", 5)]
    kept, rare = labels.balance(ships, "harbour", "filter", 3)
    assert kept.count() == sum(h not in rare_ones for h in HARBOURS) and len(rows(rare)) == 3
    assert labels.balance(ships, "harbour", "no_action", 3)[0].count() == len(HARBOURS)


def test_null_labels(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("N/A",)], "l string")
    assert rows(labels.replace_rare(df, "l", 2, "x")[0]) == [("a",), ("a",), ("x",), ("x",)]
    assert rows(labels.keep_frequent(df, "l", 2)[0]) == [("a",), ("a",)]


def test_one_hot(spark):
    codes = ["31161501", "40142001", "31161501", "39121400", "31161501", "40142001", "27110000"]
    df = spark.createDataFrame(list(enumerate(codes)), "n int, code string")
    indexed = labels.index_labels(df, "code", labels.label_index(df, "code", "i"))
    hot = labels.one_hot(indexed, "i", "v").orderBy("n").select("i", vector_to_array("v").alias("v")).collect()
    places = {}
    for code, row in zip(codes, hot, strict=True):
        assert row["v"] == [float(k == row["i"]) for k in range(4)]
        assert places.setdefault(code, row["i"]) == row["i"]
    assert sorted(places.values()) == [0, 1, 2, 3]


def test_predicted_class(spark):
    number, top = labels.predicted_class("p")
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.0625, 0.9375, 0.0],)], "p array<double>")
    assert rows(df.select(number, top)) == [(1, 0.4), (1, 0.938)]


TEXTS = ["bolt nut bolt", "nut washer", "bolt pin"]


def test_word_ids(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "n bigint, t string")
    words = vocabulary.vocabulary(df, "t", "n", 100)
    # by count, then by first place
    number = {"bolt": 1, "nut": 2, "washer": 3, "pin": 4}
    assert dict(rows(words, "word", "index")) == number
    found = vocabulary.token_ids(df, "t", words)
    padded = found.withColumn("p", text.pad_ids(F.col("ids"), 4)).orderBy("n").collect()
    for row, shown in zip(padded, TEXTS, strict=True):
        ids = [number[w] for w in shown.split()]
        assert row["ids"] == ids and row["p"] == ids + [0] * (4 - len(ids))


def test_word_ids_do_not_depend_on_keys_or_size(spark):
    df = spark.createDataFrame([(1, "bolt nut"), (1, "nut"), (None, "bolt"), (2, None), (2, "")],
                               "n bigint, t string")
    small = spark.createDataFrame([("bolt", 1), ("nut", 2)], "word string, index int")
    large = small.unionByName(spark.range(200_000).selectExpr(
        "concat('x', id) as word", "cast(id + 3 as int) as index"))
    expected = sorted([(1, [1, 2]), (1, [2]), (None, [1]), (2, []), (2, [])], key=repr)
    for words in (small, large):
        assert rows(vocabulary.token_ids(df, "t", words), "n", "ids") == expected


def test_word_ids_with_text_keys_and_small_vocabulary(spark):
    df = spark.createDataFrame([(f"k{n}", t) for n, t in enumerate(TEXTS)], "n string, t string")
    words = vocabulary.vocabulary(df, "t", "n", 3)
    assert rows(words, "word", "index") == [("bolt", 1), ("nut", 2)]
    found = vocabulary.token_ids(df, "t", words).orderBy("n")
    assert [row["ids"] for row in found.collect()] == [[1, 2, 1], [2], [1]]


def test_long_sequences_keep_their_end(spark):
    ids = F.array(*[F.lit(i) for i in range(1, 8)])
    assert spark.range(1).select(text.pad_ids(ids, 3)).first()[0] == [5, 6, 7]


@pytest.mark.parametrize("n", [0, 1, 7, 40, 99, 100, 150])
def test_sample_size_and_stability(spark, n):
    df = spark.range(100).selectExpr("id", "id % 3 as v")
    one = sampling.sample_rows(df.repartition(1), n)
    eight = sampling.sample_rows(df.repartition(8), n)
    assert one.count() == min(n, 100) and rows(one) == rows(eight)


def test_sample_of_one_repeated_row(spark):
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 0, id) as k")
    for n in (10, 5_000, 9_999):
        assert sampling.sample_rows(df, n).count() == n


def test_sample_with_replacement(spark):
    drawn = sampling.sample_with_replacement(spark.range(1000), 1500)
    assert drawn.count() == 1500
    assert 600 < drawn.distinct().count() < 900      # expected: 1000 * (1 - exp(-1.5)) = 777


@pytest.mark.parametrize("n, share, held_back", [(5, 0.2, 1), (10, 0.35, 3), (7, 0.0, 0),
                                                 (3, 0.1, 0)])
def test_split(spark, n, share, held_back):
    fitting, rest = sampling.split_tail(spark.range(n), share)
    assert (fitting.count(), rest.count()) == (n - held_back, held_back)
    assert rows(fitting.union(rest)) == [(i,) for i in range(n)]


def test_training(spark):
    kinds = {"10101010": "bolt steel thread", "20202020": "paper white office",
             "30303030": "laptop screen keyboard"}
    data = [(i, code, f"{words} {i % 7}") for i in range(60)
            for code, words in [list(kinds.items())[i % 3]]]
    table = spark.createDataFrame(data, "PO_ITEM_ID bigint, CODE string, DESCRIPTION string")
    options = training.TrainingOptions(threshold=5, sample=50, validation_share=0.2)
    model, metrics = training.train(table, options, parts=["DESCRIPTION"])
    found = metrics.first()
    assert found["rows"] == 10 and found["f1"] == 1.0
    scored = training.score(model, spark.createDataFrame([("steel bolt",)], "CONCAT_FEATURE string"))
    assert scored.first()["predicted_label"] == "10101010"
    features = training.training_features(training.balanced_sample(
        table, options, parts=["DESCRIPTION"]), options)
    assert features.select(F.size("ids")).distinct().collect()[0][0] == 300
