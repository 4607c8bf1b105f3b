"""License notices in whole texts, exact phrases and short notices with a few errors.

Texts become their words (A-Z lower-cased, everything that is neither an ASCII letter or digit
nor beyond ASCII stands between words), joined by single blanks.

1. Seeds: a notice that may hold k errors is split into k + 1 pieces. An occurrence with at
   most k edits leaves at least one piece as it is (pigeonhole), so exact hits of the pieces
   find all candidates. One Aho-Corasick automaton looks for the pieces of all notices in one
   pass over a text.
2. Windows: a hit places its notice up to k characters to either side; windows that overlap
   are joined, so that a text of a thousand hits is verified in parts that add up to it.
3. Verification: ``regex`` matches the whole notice with bounded errors inside a window,
   from the beginning of a word to the end of one, and gives place and number of edits.

A notice without errors is the case k = 0: one piece, the notice itself.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Notice:
    """Words of a notice, its label, and the edits (characters put in, left out or changed)
    that an occurrence may hold. ``tail`` are further words that stand as they are: a version
    is no typing error."""

    words: str
    label: str
    errors: int = 0
    tail: str = ""

    def __post_init__(self):
        if plain_words(self.words) != self.words or not self.words or plain_words(self.tail) != self.tail:
            raise ValueError(f"{self.words!r}, {self.tail!r}: plain words are needed")
        if not 0 <= self.errors < len(self.words):
            raise ValueError(f"{self.words!r} cannot hold {self.errors} errors")

    @property
    def length(self) -> int:
        return len(self.words) + bool(self.tail) + len(self.tail)

    def pieces(self) -> list[tuple[int, str]]:
        """The seeds with their places, one more than there may be errors."""
        n, k = len(self.words), self.errors + 1
        return [(n * i // k, self.words[n * i // k:n * (i + 1) // k]) for i in range(k)]

    def pattern(self, errors: int) -> regex.Pattern:
        tail = regex.escape(" " + self.tail, special_only=True) if self.tail else ""
        return regex.compile(f"(?e)(?<= )(?:{regex.escape(self.words, special_only=True)}){{e<={errors}}}{tail}(?= )")


_ASCII = bytes(range(128)).lower()
_CLEAN = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in _ASCII) + bytes(range(128, 256))
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_words(text: str) -> str:
    """The words of a text, joined by single blanks."""
    return b" ".join(text.encode().translate(_CLEAN).split()).decode()


#: The phrases that are looked for as they stand.
PHRASES = (
    Notice("under the mit license", "mit"),
    Notice("apache license version 2", "apache-2"),
    Notice("cc by nc", "cc-by-nc"),
)

#: Short notices and the edits that they may hold (typing errors, a letter that scanning lost,
#: "licence" for "license"): usual wordings of usual licenses, a list for a person to extend.
NOTICES = (
    Notice("released under the mit license", "mit", 3),
    Notice("licensed under the mit license", "mit", 3),
    Notice("permission is hereby granted free of charge", "mit", 3),
    Notice("licensed under the apache license version", "apache-2", 3, "2 0"),
    Notice("except in compliance with the license", "apache-2", 3),
    Notice("licensed under cc by nc", "cc-by-nc", 2, "4 0"),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 3),
    Notice("creative commons attribution international", "cc-by", 3),
    Notice("creative commons attribution", "cc-by", 2, "4 0"),
    Notice("creative commons attribution sharealike", "cc-by-sa", 3),
    Notice("gnu general public license version", "gpl-3", 3, "3"),
    Notice("gnu general public license version", "gpl-2", 3, "2"),
    Notice("published by the free software foundation", "gpl", 3),
    Notice("gnu lesser general public license", "lgpl", 3),
    Notice("gnu affero general public license", "agpl", 3),
    Notice("mozilla public license version", "mpl-2", 3, "2 0"),
    Notice("redistributions of source code must retain", "bsd", 3),
    Notice("free and unencumbered software released", "unlicense", 3),
    Notice("permission to use copy modify and or distribute", "isc", 3),
    Notice("eclipse public license version", "epl-2", 3, "2 0"),
    Notice("boost software license version", "boost", 3, "1 0"),
    Notice("all rights reserved no part of this publication", "all-rights-reserved", 3),
)


class Search:
    """All places of some notices in texts."""

    def __init__(self, notices: Iterable[Notice]):
        import ahocorasick
        self.notices = tuple(notices)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for at, piece in notice.pieces():
                seeds.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()
        self.patterns = [[n.pattern(k) for k in range(n.errors + 1)] for n in self.notices]

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """By notice, the parts of ``text`` that an occurrence must lie in."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for i, at in owners:
                notice = self.notices[i]
                begin = end + 1 - size - at                      # of the notice, but for its edits
                lo = max(0, begin - notice.errors - 1)           # with a blank on either side
                hi = begin + notice.length + notice.errors + 1
                parts = found.setdefault(i, [])
                # hits of one notice come by their ends; a window may begin before the last one
                while parts and lo <= parts[-1][1] and notice.errors:
                    lo, hi = min(lo, parts[-1][0]), max(hi, parts[-1][1])
                    parts.pop()
                parts.append([lo, hi])
        return found

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(notice, first character, end, edits)`` of each occurrence in ``text``, which has a
        blank at either end. Those of a notice that may hold errors do not overlap."""
        found = []
        for i, parts in self.windows(text).items():
            notice = self.notices[i]
            for lo, hi in parts:
                if not notice.errors:                            # the seed is all of it
                    if text[lo:lo + 1] == " " and text.startswith(notice.tail and f" {notice.tail} " or " ", (
                            at := lo + 1 + len(notice.words))):
                        found.append((i, lo + 1, at + notice.length - len(notice.words), 0))
                    continue
                for match in self.patterns[i][-1].finditer(text[lo:hi]):
                    edits = sum(match.fuzzy_counts)
                    found.append((i, lo + match.start(), lo + match.end(), edits))
        return sorted(found, key=lambda m: (m[1], m[2], m[0]))

    def fewest(self, text: str, place: tuple[int, int, int, int]) -> int:
        """The fewest edits with which the notice stands about a place."""
        i, begin, end, edits = place
        reach = self.notices[i].errors + 1
        near = text[max(0, begin - reach):end + reach]
        for k in range(edits):
            if self.patterns[i][k].search(near):
                return k
        return edits


@cache
def _search(notices: tuple[Notice, ...]) -> Search:
    return Search(notices)


def _word_places(text: str, wanted: set[int]) -> dict[int, tuple[int, int]]:
    """Begin and end of the words of these numbers, in code points."""
    last, places = max(wanted), {}
    for number, word in enumerate(_WORD.finditer(text)):
        if number in wanted:
            places[number] = word.span()
        if number == last:
            break
    return places


def scan(text: str, search: Search) -> tuple[int, list[dict], float]:
    """Words of a text, its places (see :func:`scan_licenses`) and its score."""
    plain = plain_words(text)
    if not plain:
        return 0, [], 0.0
    padded = f" {plain} "
    places, at, blanks, score = [], 0, 0, 0.0
    for place in search(padded):
        i, begin, end, edits = place
        blanks += padded.count(" ", at, begin)
        at = begin
        notice = search.notices[i]
        first = blanks - 1
        places.append({"label": notice.label, "notice": i, "edits": edits, "first_word": first,
                       "last_word": first + padded.count(" ", begin, end)})
        score = max(score, 1 - (search.fewest(padded, place) if edits else 0) / notice.length)
    if places:
        spans = _word_places(text, {p[k] for p in places for k in ("first_word", "last_word")})
        for p in places:
            p["begin"], p["end"] = spans[p["first_word"]][0], spans[p["last_word"]][1]
    return plain.count(" ") + 1, places, score


PLACE = ("struct<label:string,notice:int,edits:int,first_word:long,last_word:long,begin:long,end:long>")
_PLACE = pa.struct([("label", pa.string()), ("notice", pa.int32()), ("edits", pa.int32()), *[
    (name, pa.int64()) for name in ("first_word", "last_word", "begin", "end")]])


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  phrases: Iterable[Notice] = PHRASES, notices: Iterable[Notice] = NOTICES) -> DataFrame:
    """One row per input row: ``doc_id, n_words, base, places, score``.

    ``base`` are the places of ``phrases`` (all, overlapping ones too), ``places`` those of
    ``notices``, in the order of the text: label, number of the notice, edits, first and last
    word (from 0), begin and end in the text (code points, end exclusive). An occurrence of a
    notice begins where a word begins and ends where one ends; several of one notice that
    overlap count once. ``score`` is the largest share of a notice or phrase that stands
    unchanged: 1 - edits / length, 0 without any. NULL and empty texts have no words, no places
    and score 0; repeated rows are scanned alike; an empty table stays empty; other columns are
    dropped. The lists are for a person to keep and travel with the tasks.
    """
    phrases, notices = tuple(phrases), tuple(notices)
    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        search = _search(phrases + notices)
        for batch in batches:
            words, base, more, scores = [], [], [], []
            for value in batch.column(1).to_pylist():
                n, places, score = scan(value, search)
                words.append(n)
                base.append([p for p in places if p["notice"] < len(phrases)])
                more.append([p | {"notice": p["notice"] - len(phrases)} for p in places
                             if p["notice"] >= len(phrases)])
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(base, pa.list_(_PLACE)),
                 pa.array(more, pa.list_(_PLACE)), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "base", "places", "score"])

    return given.mapInArrow(run, f"doc_id {kind}, n_words long, base array<{PLACE}>, places array<{PLACE}>, score double")


def labels_of(*places) -> Column:
    """Distinct labels of arrays of places, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*[
        F.transform(p, lambda x: x["label"]) for p in places]))), ",")
