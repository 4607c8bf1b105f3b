"""URL filter: host and path rules, then a weighted vocabulary.

Rules are decided by comparisons in the plan. A URL that no rule fits is searched for the
terms of a vocabulary with an Aho-Corasick automaton (one pass for all terms); a term
counts only between boundaries, that is, no letter or digit next to it. One strict term or
``soft_hits`` distinct soft terms reject the URL.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = ("camgirl", "casino", "escort", "hentai", "malware", "phishing", "porn", "warez", "xxx")
SOFT = ("adult", "bet", "betting", "cheap", "cracked", "dating", "download", "free", "gamble",
        "jackpot", "loan", "nude", "pills", "poker", "promo", "sex", "slots", "torrent", "viagra",
        "winner")
SOFT_HITS = 2

#: (verdict, rule); a rule is a host and a path prefix.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))

_WORD = frozenset(string.ascii_lowercase + string.digits)
_LOWER = {ord(a): a.lower() for a in string.ascii_uppercase}


def _lower(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


@cache
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick
    found = ahocorasick.Automaton()
    for weight, terms in ((0, soft), (1, strict)):
        for term in terms:
            found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def hits(url: str | None, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """Distinct strict and soft terms that stand between boundaries in ``url``."""
    if not url or not strict and not soft:
        return 0, 0
    text, seen = url.translate(_LOWER), set()
    for end, (term, weight) in _automaton(strict, soft).iter(text):
        begin = end - len(term)
        if (begin < 0 or text[begin] not in _WORD) and (
                end + 1 == len(text) or text[end + 1] not in _WORD):
            seen.add((term, weight))
    n_strict = sum(weight for _, weight in seen)
    return n_strict, len(seen) - n_strict


def filter_urls(pages: DataFrame, url: str = "url", rules: Iterable[tuple[str, str]] = RULES,
                strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT,
                soft_hits: int = SOFT_HITS) -> DataFrame:
    """``pages`` with ``host, path, rule, n_strict, n_soft, verdict``; columns of these names
    are replaced.

    The longest rule that fits decides (of equally long ones the longer host). ``rules`` is
    a list for a person to keep, it becomes part of the plan. NULL URLs and those without
    ``://`` have an empty host and path; the vocabulary still reads the URL, a NULL one has
    no hits and is allowed. Repeated rows are judged alike, an empty table stays empty.
    """
    strict, soft = tuple(sorted(strict)), tuple(sorted(soft))
    shape, whole = r"://([^/?#]*)([^?#]*)", F.col(url).cast("string")
    host = _lower(F.coalesce(F.regexp_extract(whole, shape, 1), F.lit("")))
    path = F.coalesce(F.regexp_extract(whole, shape, 2), F.lit(""))

    ordered = sorted(rules, key=lambda r: (len(r[1]), r[1].find("/")))
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in ordered:                 # the longest comes last and wins
        at = text.find("/") if "/" in text else len(text)
        own, begin = text[:at].translate(_LOWER), text[at:]
        fits = ((F.col("host") == own) | F.endswith("host", F.lit("." + own))) & F.startswith(
            "path", F.lit(begin))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        said = F.when(fits, F.lit(verdict)).otherwise(said)

    @F.pandas_udf("n_strict int, n_soft int")
    def count(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([hits(u, strict, soft) for u in urls], columns=["n_strict", "n_soft"],
                            dtype="int32")

    counted = pages.withColumns({"host": host, "path": path, "__hits": count(whole)})
    judged = counted.withColumns({
        "rule": rule, "n_strict": F.col("__hits.n_strict"), "n_soft": F.col("__hits.n_soft"),
        "verdict": F.coalesce(said, F.when(
            (F.col("__hits.n_strict") > 0) | (F.col("__hits.n_soft") >= soft_hits), "block")
            .otherwise("allow"))})
    return judged.drop("__hits")
