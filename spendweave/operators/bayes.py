"""Naive Bayes over texts, with weights in tables instead of a matrix.

A model is three tables: words with their weights, word weights of classes as posting lists
(one row per parent class and word), and constants of classes. Nothing has the size of classes
times words, and nothing of that kind is held by the driver or a task.

A text's score for a class is

    prior - X * ln(total + words) + sum over its words of tf * idf * ln(s + 1),   X = sum of tf * idf,

where s is the class's weighted count of the word, 0 for words that the class does not have. So
words and classes that do not meet need no entry: the last term is added up from the posting
lists of a text's words, the rest are constants of the class. Pairs of texts and classes exist
in a task only, one text at a time; no row is made for them.

``levels`` cuts labels into a path (for codes 2, 4, 6 and 8 digits). Each level then has a
classifier for the children of every class above it, and a text goes down the path of its best
classes: a level scores its hundred children at most, however many codes there are. Without
levels, all labels are children of one root.

Weights are rounded to 1e-9 and added up as integers, so a result does not depend on the order
of a sum; of equal scores (to 1e-9) the smallest label wins.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import materialize
from .numbering import dense_number, top_rows

#: Units of stored weights.
UNIT = 1_000_000_000
#: Weights (12 bytes each) that travel with the tasks at once; a larger level is cut into blocks
#: of classes, and texts are scored against one after the other.
BROADCAST_WEIGHTS = 4_000_000
#: Classes of a node from which on texts are scored one by one, and of a word from which on they
#: share the sums of their beginnings.
LONG = 2048
#: Classes of a node from which on the words of half of them are rows of a matrix.
WIDE = 128
#: Classes and weights of the texts that are scored together (some 100 bytes each).
CELLS = 1_000_000
#: Scores so far below the best, and the logarithm of the classes, add nothing to a double.
LOW = 37
_WHOLE = "decimal(38,0)"
ROOT = "0:"


@dataclass(frozen=True)
class SparseBayes:
    """``words`` (word, idf), ``weights`` (node, word, postings of number and weight) and
    ``classes`` (node, number, label, prior, slope); idf and weights in units of 1e-9. The
    children of a node are numbered from 0 in the order of their labels."""

    words: DataFrame
    weights: DataFrame
    classes: DataFrame
    levels: tuple[int, ...] = ()

    def save(self, path: str) -> None:
        """Three Parquet tables and the levels."""
        for name in ("words", "weights", "classes"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        spark = self.words.sparkSession
        spark.createDataFrame([(json.dumps(self.levels),)], "levels string").coalesce(1).write.mode(
            "overwrite").json(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SparseBayes:
        tables = [spark.read.parquet(f"{path}/{name}") for name in ("words", "weights", "classes")]
        settings = spark.read.schema("levels string").json(f"{path}/settings").first()
        return cls(*tables, tuple(json.loads(settings["levels"])))


def _whole(column: Column) -> Column:
    return F.round(column * UNIT, 0).cast("long")


def _path(label: Column, levels: Sequence[int]) -> Column:
    """``(node, label)`` of each step from the root to a label; a node is a depth and the
    label's beginning there."""
    parts = [F.substring(label, 1, n) for n in levels] or [label]
    nodes = [F.lit(ROOT), *[_node(depth, part) for depth, part in enumerate(parts, start=1)]]
    return F.array(*[F.struct(node.alias("node"), part.alias("label"))
                     for node, part in zip(nodes, parts, strict=False)])


def _node(depth: int, label: Column) -> Column:
    return F.concat(F.lit(f"{depth}:"), label)


def _word_facts(tokens: DataFrame, most: int | None) -> tuple[DataFrame, int]:
    """``word, idf`` of the ``most`` most frequent words (of equally frequent ones the first
    in alphabetical order), and the number of texts."""
    once = F.transform(F.array_distinct("tokens"), lambda w: F.struct(
        w.alias("word"), F.lit(0).alias("n"), F.lit(1).alias("texts")))
    each = F.transform("tokens", lambda w: F.struct(w.alias("word"), F.lit(1).alias("n"), F.lit(0).alias("texts")))
    counts = materialize(tokens.select(F.inline(F.concat(each, once))).groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts")), "word-counts")
    kept = counts if most is None else top_rows(counts, most, "n", ["word"])
    total = tokens.count()
    idf = F.log((F.lit(total) + 1.0) / (F.col("texts") + 1.0))
    return materialize(kept.select("word", _whole(idf).alias("idf")), "words"), total


def fit(rows: DataFrame, feature: str, label: str, num_words: int | None = None,
        levels: Sequence[int] = ()) -> SparseBayes:
    """A model of the texts ``feature`` and their labels; rows without a label are left out.

    ``num_words`` - 1 words are kept, the most frequent ones. The counts by label and word are
    one partial aggregation; those of upper levels are sums of them.
    """
    tokens = materialize(rows.where(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("label"),
        F.coalesce(text.tokens(F.col(feature)), F.array().cast("array<string>")).alias("tokens")), "tokens")
    words, _ = _word_facts(tokens, None if num_words is None else num_words - 1)
    vocabulary = words.count()

    known = (tokens.select("label", F.explode("tokens").alias("word")).groupBy("label", "word")
             .agg(F.count(F.lit(1)).alias("n")).join(words, "word"))
    steps = materialize(
        known.withColumn("step", F.explode(_path(F.col("label"), levels)))
        .groupBy("step.node", F.col("step.label").alias("label"), "word")
        .agg(F.sum("n").alias("n"), F.first("idf").alias("idf"))
        .withColumn("s", F.col("n") * (F.col("idf") / UNIT)), "class-words")

    totals = steps.groupBy("node", "label").agg(F.sum(_whole(F.col("s")).cast(_WHOLE)).alias("total"))
    sizes = (tokens.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("step", F.explode(_path(F.col("label"), levels)))
             .groupBy("step.node", F.col("step.label").alias("label")).agg(F.sum("rows").alias("rows")))
    nodes = sizes.groupBy("node").agg(F.sum("rows").alias("node_rows"), F.count(F.lit(1)).alias("children"))
    slope = F.log(F.coalesce(F.col("total"), F.lit(0)).cast("double") / UNIT + vocabulary)
    prior = F.log(F.col("rows") + 1.0) - F.log(F.col("node_rows") + F.col("children").cast("double"))
    # the children of a node, at most all classes of the code system
    number = F.row_number().over(Window.partitionBy("node").orderBy("label")) - 1
    classes = materialize(
        sizes.join(nodes, "node").join(totals, ["node", "label"], "left")
        .select("node", number.alias("number"), "label", prior.alias("prior"), slope.alias("slope")), "classes")

    entry = F.struct("number", _whole(F.col("idf") / UNIT * F.log(F.col("s") + 1.0)).alias("weight"))
    weights = (steps.join(classes.select("node", "label", "number"), ["node", "label"])
               .groupBy("node", "word").agg(F.sort_array(F.collect_list(entry)).alias("postings")))
    return SparseBayes(words, materialize(weights, "class-weights"), classes, tuple(levels))


def _at(depth: int) -> Column:
    """Whether a row's node lies at ``depth``."""
    return F.col("node").startswith(f"{depth}:")


def _block(model: SparseBayes, words: DataFrame, depth: int, mine: Callable[[Column], Column]) -> Callable:
    """A function ``nodes, word ids, words of each text, X`` -> ``known, label, score, total`` of
    many texts, for the classes at ``depth`` of which ``mine(number)`` holds: the best class, and
    the sum of exp(score - best score) over them. ``known`` texts have a node with a class there."""
    classes = (model.classes.where(_at(depth) & mine(F.col("number"))).select("node", "number", "label", "prior", "slope")
               .toPandas().sort_values(["node", "number"]))
    lists = (model.weights.where(_at(depth)).join(words.select("word", "id"), "word")
             .select("node", "id", F.filter("postings", lambda p: mine(p["number"])).alias("mine")).where("size(mine) > 0")
             .select("node", "id", F.col("mine.number").alias("n"), F.col("mine.weight").alias("w")).toArrow())
    size = (words.agg(F.max("id")).first()[0] or 0) + 1
    index = pd.Index(classes["node"].unique())
    node = index.get_indexer(classes["node"])
    starts = np.searchsorted(node, np.arange(len(index) + 1))
    labels, prior, slope = (classes[name].to_numpy() for name in ("label", "prior", "slope"))
    # lists in the order of node and word; their entries are places among the node's classes
    number, weight = (lists.column(name).combine_chunks() for name in ("n", "w"))
    ends, weights = number.offsets.to_numpy(), weight.flatten().to_numpy()
    owner = index.get_indexer(lists.column("node").to_pandas())
    wide = int(classes["number"].max()) + 1 if len(classes) else 1
    places = (np.searchsorted(node * wide + classes["number"].to_numpy("int64"),
                              np.repeat(owner, np.diff(ends)) * wide + number.flatten().to_numpy())
              - np.repeat(starts[owner], np.diff(ends))).astype("int32")
    keys = owner * size + lists.column("id").to_numpy()
    order = np.argsort(keys)
    keys, begin, length = keys[order], ends[:-1][order].astype("int64"), np.diff(ends)[order].astype("int64")
    heaviest = np.maximum.reduceat(weights, ends[:-1])[order] if len(keys) else weights
    children = np.diff(starts)
    matrices: dict[int, tuple[np.ndarray, np.ndarray]] = {}      # filled by a task

    def matrix(n: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of a node's lists that have a weight for half its classes, else -1, and these
        lists as rows. It is no larger than twice the weights."""
        if n not in matrices:
            a, b = np.searchsorted(keys, [n * size, (n + 1) * size])
            full = np.flatnonzero(2 * length[a:b] >= children[n])
            row = np.full(b - a, -1)
            row[full] = np.arange(len(full))
            filled = np.zeros((len(full), children[n]))
            for k, at in enumerate(full + a):
                filled[k, places[begin[at]:begin[at] + length[at]]] = weights[begin[at]:begin[at] + length[at]]
            matrices[n] = row, filled
        return matrices[n]

    def entries_of(found: np.ndarray) -> np.ndarray:
        each = length[found]
        return np.repeat(begin[found] - np.cumsum(each) + each, each) + np.arange(each.sum())

    def scores(names: Sequence[str], ids: np.ndarray, counts: np.ndarray, xs: np.ndarray) -> tuple:
        nodes = index.get_indexer(names)
        known = nodes >= 0
        best, score, total = np.zeros(len(nodes), "int64"), np.zeros(len(nodes)), np.zeros(len(nodes))
        # a row for each different word of a text that has a list; rows of a text lie together
        text = np.repeat(np.arange(len(nodes)), counts)
        inside = known[text]
        pairs, times = np.unique(text[inside] * size + ids[inside], return_counts=True)
        text = pairs // size
        wanted = nodes[text] * size + pairs % size
        found = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        hit = keys[found] == wanted if len(keys) else np.zeros(len(found), bool)
        text, found, times = text[hit], found[hit], times[hit]
        rows = np.searchsorted(text, np.arange(len(nodes) + 1))
        large = np.zeros(len(nodes), bool)
        large[known] = children[nodes[known]] >= LONG

        def together(part: np.ndarray) -> None:
            """Texts of nodes with few classes: an entry for each class of each text."""
            n, place = nodes[part], np.full(len(nodes), -1)
            place[part] = np.arange(len(part))
            each = children[n]
            first = np.cumsum(each) - each
            mine = slice(rows[part[0]], rows[part[-1] + 1])
            of, lists_, tf = place[text[mine]], found[mine], times[mine]
            of, lists_, tf = of[of >= 0], lists_[of >= 0], tf[of >= 0]
            # whole numbers: a double adds them exactly below 2 ** 53
            exact = np.bincount(of, tf * heaviest[lists_].astype("float64")).max(initial=0) < 2 ** 53
            dense, added = np.zeros(len(of), bool), []
            if exact:
                lowest = np.searchsorted(keys, n * size)
                bounds = np.searchsorted(of, np.arange(len(part) + 1))
                for t in np.flatnonzero(each >= WIDE):
                    row, filled = matrix(n[t])
                    own = slice(bounds[t], bounds[t + 1])
                    at = row[lists_[own] - lowest[t]]
                    dense[own] = at >= 0
                    added.append((t, tf[own][at >= 0].astype("float64") @ filled[at[at >= 0]]))
            of, lists_, tf = of[~dense], lists_[~dense], tf[~dense]
            entry, repeats = entries_of(lists_), length[lists_]
            cell = np.repeat(first[of], repeats) + places[entry]
            weight_ = weights[entry] * np.repeat(tf, repeats)
            if exact:
                sums = np.bincount(cell, weight_.astype("float64"), each.sum()).astype("float64")
                for t, more in added:
                    sums[first[t]:first[t] + each[t]] += more
            else:
                sums = np.zeros(each.sum(), "int64")
                np.add.at(sums, cell, weight_)
            owner_ = np.repeat(np.arange(len(part)), each)
            at = np.arange(len(sums)) + (starts[n] - first)[owner_]
            value = prior[at] - (xs[part] / UNIT)[owner_] * slope[at] + sums / UNIT
            top = np.maximum.reduceat(value, first)
            ties = np.flatnonzero(value >= top[owner_] - 3e-9)
            ties = ties[np.lexsort((ties, -np.round(value[ties], 9), owner_[ties]))]
            ties = ties[np.searchsorted(owner_[ties], np.arange(len(part)))]
            best[part], score[part] = at[ties], value[ties]
            total[part] = np.add.reduceat(np.exp(value - value[ties][owner_]), first)

        def one_by_one(part: np.ndarray) -> None:
            """Texts of nodes with many classes; those that begin with the same long lists follow
            each other and share their sums."""
            begins = []
            for t in part:
                own = found[rows[t]:rows[t + 1]]
                far = length[own] >= LONG
                begins.append((nodes[t], sorted(zip((-length[own[far]]).tolist(), own[far].tolist(),
                                                    times[rows[t]:rows[t + 1]][far].tolist(), strict=True))))
            stack: list[tuple] = []
            for k in sorted(range(len(part)), key=lambda k: begins[k]):
                t, (n, shared) = part[k], begins[k]
                low, high = starts[n], starts[n + 1]
                path = [(n,), *shared]
                same = 0
                while same < min(len(stack), len(path)) and stack[same][0] == path[same]:
                    same += 1
                del stack[same:]
                for step in path[same:]:
                    if not stack:
                        stack.append((step, np.zeros(high - low, "int64")))
                        continue
                    sums, (_, at, tf) = stack[-1][1].copy(), step
                    a, b = begin[at], begin[at] + length[at]
                    sums[places[a:b]] += tf * weights[a:b]      # a class once a word
                    stack.append((step, sums))
                sums = stack[-1][1].copy()
                for at, tf in zip(found[rows[t]:rows[t + 1]], times[rows[t]:rows[t + 1]], strict=True):
                    if length[at] < LONG:
                        a, b = begin[at], begin[at] + length[at]
                        sums[places[a:b]] += tf * weights[a:b]
                value = np.multiply(slope[low:high], xs[t] / UNIT)
                np.subtract(prior[low:high], value, out=value)
                value += sums / UNIT
                # what lies lower adds less than a double's last digit, all of it together
                near = np.flatnonzero(value >= value.max() - LOW - np.log(high - low))
                value = value[near]
                ties = np.flatnonzero(value >= value.max() - 3e-9)
                first = ties[np.argmax(np.round(value[ties], 9))]
                best[t], score[t] = low + near[first], value[first]
                total[t] = np.exp(value - value[first]).sum()

        few = np.flatnonzero(known & ~large)
        if len(few):
            cost = (children[nodes[few]] + np.bincount(text, length[found], len(nodes))[few]).cumsum()
            cuts = np.flatnonzero(np.diff(cost // CELLS)) + 1
            for part in np.split(few, cuts):
                together(part)
        one_by_one(np.flatnonzero(known & large))
        return known, labels[best] if len(labels) else best.astype(str), score, total

    return scores


def _level(texts: DataFrame, model: SparseBayes, words: DataFrame, depth: int) -> DataFrame:
    """``texts`` with the best class of each among the children of its node, at ``depth``.

    Weights travel with the tasks in blocks of classes. Where each node fits into a block, a
    text is scored in its node's block only. Otherwise it gives one row for a block, and these
    are put together. A model of one block needs no shuffle.
    """
    classes = model.classes.where(_at(depth)).count()
    sizes = model.weights.where(_at(depth)).groupBy("node").agg(F.sum(F.size("postings")).alias("n"))
    size, largest = (n or 0 for n in sizes.agg(F.sum("n"), F.max("n")).first())
    blocks = max(1, min(-(-size // max(BROADCAST_WEIGHTS, 1)), classes))
    by_node = depth > 0 and largest <= BROADCAST_WEIGHTS

    def block(*columns: str | Column) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(blocks))

    def scored(source: DataFrame, k: int) -> DataFrame:
        scores = _block(model, words, depth, lambda number: (block("node") if by_node else block("node", number)) == k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("ids")
                known, label, score, total = scores(
                    batch.column("node").to_pandas(), ids.flatten().to_numpy(), pc.list_value_length(ids).to_numpy(),
                    batch.column("x").to_numpy())
                cells = [pa.array(label, "string", mask=~known), pa.array(score, mask=~known), pa.array(total, mask=~known)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *cells], [*batch.schema.names, "label", "score", "total"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields)
        return source.mapInArrow(run, f"{kinds}, label string, score double, total double")

    # what earlier levels found is computed once, not for every block
    if blocks > 1 and depth:
        texts = materialize(texts, "texts-by-class")
    if blocks == 1:
        found = scored(texts, 0).withColumn("probability", 1 / F.col("total"))
    elif by_node:
        each = [materialize(scored(texts.where(block("node") == k), k), "scores") for k in range(blocks)]
        found = reduce(DataFrame.unionByName, each).withColumn("probability", 1 / F.col("total"))
    else:
        short = texts.select("row", "node", "ids", "x")
        each = None
        for k in range(blocks):     # a block at a time: its rows are written before the next one is made
            rows = materialize(scored(short, k).where("label is not null").select("row", "label", "score", "total"), "scores")
            each = rows if each is None else each.unionByName(rows)
        best = each.groupBy("row").agg(
            F.min(F.struct((-F.round("score", 9)).alias("order"), "label", "score")).alias("best"),
            F.collect_list(F.struct("score", "total")).alias("shares_of_blocks"))
        total = F.aggregate("shares_of_blocks", F.lit(0.0), lambda sum_, s: sum_ + s["total"] * F.exp(s["score"] - F.col("best.score")))
        found = texts.join(best.select("row", F.col("best.label").alias("label"), (1 / total).alias("probability")), "row", "left")
    return found.withColumns({
        "node": _node(depth + 1, F.col("label")), "path": F.concat("path", F.array("label")),
        "shares": F.concat("shares", F.array("probability"))}).select(*texts.columns)


def predict(model: SparseBayes, rows: DataFrame, feature: str, by_level: bool = False) -> DataFrame:
    """``rows`` with ``predicted_label`` and ``predicted_label_proba``, rounded half-even to three
    digits; with levels the probability of the whole path. ``by_level`` adds ``level_labels``
    and ``level_probas``, one entry a level. A NULL text is one without words; without any
    class all is NULL.

    Rows are numbered and written once. Of equal texts (by digest) one is scored: its word
    numbers are written once and read for each level and block of classes.
    """
    digest = F.sha2(F.coalesce(F.col(feature).cast("string"), F.lit("")).cast("binary"), 256)
    numbered = materialize(rows.withColumns({"__row": F.monotonically_increasing_id(), "__key": digest}), "numbered")
    first = materialize(numbered.groupBy("__key").agg(F.min("__row").alias("__row")), "first-rows")
    words = materialize(dense_number(model.words, ["word"], "id"), "word-ids")
    known = (numbered.join(first, ["__row", "__key"], "left_semi")
             .select(F.col("__row").alias("row"), F.explode(text.tokens(F.col(feature))).alias("word")).join(words, "word")
             .groupBy("row").agg(F.sum("idf").alias("x"), F.collect_list(F.col("id").cast("int")).alias("ids")))
    # scoring is long for so few bytes: as many files as give all cores work
    tasks = 3 * rows.sparkSession.sparkContext.defaultParallelism
    texts = materialize(
        first.select(F.col("__row").alias("row"), F.col("__key").alias("key")).join(known, "row", "left").withColumns({
            "x": F.coalesce("x", F.lit(0)), "ids": F.coalesce("ids", F.array().cast("array<int>")), "node": F.lit(ROOT),
            "path": F.array().cast("array<string>"), "shares": F.array().cast("array<double>")})
        .repartition(tasks, "row"), "texts")
    for depth in range(len(model.levels) or 1):
        texts = _level(texts, model, words, depth)
    answer = texts.select(
        F.col("key").alias("__key"), F.element_at("path", -1).alias("predicted_label"),
        F.bround(F.aggregate("shares", F.lit(1.0), lambda p, q: p * q), 3).alias("predicted_label_proba"),
        F.col("path").alias("level_labels"),
        F.transform("shares", lambda p: F.bround(p, 3)).alias("level_probas"))
    wanted = ["predicted_label", "predicted_label_proba", *(["level_labels", "level_probas"] if by_level else [])]
    return numbered.join(answer, "__key").select(*rows.columns, *wanted)
