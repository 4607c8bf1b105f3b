"""Quality rules whose cutoffs come with a guarantee.

A rule rejects a text where one of its statistics lies above a cutoff. For each stratum (a
language) and rule the cutoffs of a fixed grid are tested on the labelled documents, loosest
first: a cutoff may be used if the exact (Clopper-Pearson) upper bound of the share of good
documents that it rejects stays within the rule's part of the allowed false rejections. The
first cutoff that fails ends the sequence, so one level serves a whole sequence; the level is
divided by the number of strata and rules (Bonferroni). Among the usable cutoffs the one that
separates the labelled documents best is taken. So, with probability ``1 - risk``, in no
stratum are more than ``allowed`` of the good documents rejected by the rules together. Where
there are too few labels to show that, nothing is rejected.

Exact copies among the labelled documents count once, so that the trials are independent.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

from .common import text_of

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\x0b\x0c\r"

#: Share of good documents that the rules together may reject in a stratum, and the
#: probability that the data mislead the tests.
ALLOWED, RISK = 0.02, 0.05

#: Rules, each with its statistic, and the grid of cutoffs, loosest first.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "capitals": "n_upper / greatest(word_chars, 1)",
    "shouting": "n_marks / greatest(n_words, 1)",
    "same_lines": "n_dup_lines / greatest(n_lines, 1)",
    "same_words": "n_repeat_words / greatest(n_words, 1)",
    "few_words": "1 - n_distinct_words / greatest(n_words, 1)",
}
GRID = tuple(round(1 - 0.02 * k, 2) for k in range(1, 50))

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper",
              "n_marks", "n_lines", "n_distinct_words")
#: A penalty so that good documents are given up only for many more bad ones.
_GOOD_WEIGHT = 10.0


def _repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in three-word windows found at least twice, and distinct words."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], "int64")
    if len(ids) < 4 or len(number) == len(ids):
        return 0, len(number)
    own = len(number)
    # two steps, so that the key of a window stays far from overflow
    _, pairs = np.unique(ids[:-1] * own + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1].astype("int64") * own + ids[2:], return_inverse=True,
                                   return_counts=True)
    often = counts[windows] > 1
    marked = np.zeros(len(ids), bool)
    for shift in range(3):
        marked[shift:shift + len(often)] |= often
    return int(marked.sum()), own


def measure(text: str) -> tuple[int, ...]:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    words = text.encode().split()           # bytes split at ASCII white space only
    repeated, distinct = _repeated_words(words)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return (len(words), len(text) - sum(map(text.count, _BLANK)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated, upper, text.count("!") + text.count("?"),
            len(lines), distinct)


def statistics(text: Column) -> Column:
    """The statistics as one struct."""
    @F.pandas_udf(", ".join(f"{name} long" for name in STATISTICS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=list(STATISTICS), dtype="int64")
    return run(text)


def stratum_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
             stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum, text_hash`` and the statistics, one row per input row."""
    found = docs.select(
        F.col(doc_id).alias("doc_id"), stratum_of(stratum).alias("stratum"), F.xxhash64(text_of(text)).alias("text_hash"), statistics(text_of(text)).alias("found"))
    return found.select("doc_id", "stratum", "text_hash", "found.*")


def upper_bound_holds(rejected: int, trials: int, share: float, level: float) -> bool:
    """Whether the Clopper-Pearson upper bound (one-sided, at ``level``) for ``rejected`` of
    ``trials`` is at most ``share``: P(X <= rejected) <= level for X binomial with ``share``."""
    if trials == 0 or rejected >= trials:
        return False
    log_tail, total = math.log(share), 0.0
    log_rest, base = math.log1p(-share), math.lgamma(trials + 1)
    for k in range(rejected + 1):
        total += math.exp(base - math.lgamma(k + 1) - math.lgamma(trials - k + 1)
                          + k * log_tail + (trials - k) * log_rest)
        if total > level:
            return False
    return True


def choose_cutoff(good: list[int], bad: list[int], share: float, level: float) -> float | None:
    """The cutoff of one stratum and rule; ``good[k]`` and ``bad[k]`` documents are first
    rejected by cutoff ``k`` of the grid, the last entries by none."""
    n_good, n_bad = sum(good), sum(bad)
    best, chosen, lost, caught = 0.0, None, 0, 0
    for k, cutoff in enumerate(GRID):
        lost, caught = lost + good[k], caught + bad[k]
        if not upper_bound_holds(lost, n_good, share, level):
            break
        gain = caught / max(n_bad, 1) - _GOOD_WEIGHT * lost / n_good
        if gain > best:
            best, chosen = gain, cutoff
    return chosen


def _rank(statistic: Column) -> Column:
    """Index of the loosest cutoff of the grid that rejects; the grid's length if none does."""
    return F.aggregate(F.array(*[F.lit(c) for c in GRID]), F.lit(0), lambda n, c: n + F.when(
        statistic > c, 0).otherwise(1))


def learn_cutoffs(found: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "quality",
                  allowed: float = ALLOWED, risk: float = RISK) -> DataFrame:
    """``stratum, rule, cutoff`` from the measured documents that have a label (1 is good)."""
    known = labels.filter(F.col(label).isNotNull() & F.col(label_id).isNotNull()).groupBy(
        F.col(label_id).alias("doc_id")).agg(F.max(label).alias("good"))
    labelled = found.join(known, "doc_id").dropDuplicates(["text_hash", "stratum"])
    ranks = F.explode(F.create_map(*[x for name, value in RULES.items()
                                     for x in (F.lit(name), _rank(F.expr(value)))])).alias("rule", "rank")
    counts = materialize(labelled.select("stratum", "good", ranks)
                         .groupBy("stratum", "rule", "rank")
                         .agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"),
                              F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("bad")),
                         "quality-counts")
    tests = max(1, counts.select("stratum").distinct().count()) * len(RULES)
    share, level = allowed / len(RULES), risk / tests

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        good, bad = [0] * (len(GRID) + 1), [0] * (len(GRID) + 1)
        for row in pdf.itertuples():
            good[row.rank], bad[row.rank] = int(row.good), int(row.bad)
        cutoff = choose_cutoff(good, bad, share, level)
        return pd.DataFrame([] if cutoff is None else [(pdf.stratum[0], pdf.rule[0], cutoff)],
                            columns=["stratum", "rule", "cutoff"])

    # at most 50 rows a group: the ranks of one stratum and rule
    return counts.groupBy("stratum", "rule").applyInPandas(
        choose, "stratum string, rule string, cutoff double")


def judge(found: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``found`` with ``base_failed, failed_rules, kept``."""
    wide = materialize(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(
        F.struct("rule", "cutoff"))).alias("cutoffs")), "quality-cutoffs")
    failed = F.array_compact(F.array(*[
        F.when(F.expr(value) > F.element_at("cutoffs", F.lit(name)), F.lit(name))
        for name, value in RULES.items()]))
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = found.join(wide, "stratum", "left").withColumns(
        {"base_failed": base, "failed_rules": failed}).drop("cutoffs")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def judge_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    stratum: str = "lang", allowed: float = ALLOWED, risk: float = RISK) -> DataFrame:
    """One row per input row: ``doc_id, stratum``, the statistics, ``base_failed,
    failed_rules, kept``.

    NULL and empty texts have no words and fail. A NULL stratum counts as the empty one. Rows that
    repeat are judged alike; a document with several labels is good if one says so; NULL
    labels are passed over; without labels only the base rules reject. An empty table stays
    empty. Other columns are not looked at.
    """
    found = materialize(measured(docs, text, doc_id, stratum), "quality")
    return judge(found, learn_cutoffs(found, labels, allowed=allowed, risk=risk)).drop("text_hash")


def keep_good_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                        stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they were.

    Rows are written once with their statistics, so that each text is measured once and none
    is shuffled: labels meet the statistics. NULL and empty texts fail; of repeated rows all
    stay or none; an empty table stays empty.
    """
    stats = F.struct(F.col(doc_id).alias("doc_id"), stratum_of(stratum).alias("stratum"),
                     F.xxhash64(text_of(text)).alias("text_hash"), statistics(text_of(text)).alias("found"))
    marked = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                                     stats.alias("__stats")), "measured")
    flat = ("__stats.doc_id", "__stats.stratum", "__stats.text_hash", "__stats.found.*")
    cutoffs = learn_cutoffs(marked.select(*flat), labels)
    return judge(marked.select("__row", *flat[1:]), cutoffs).filter("kept").select("__row.*")
