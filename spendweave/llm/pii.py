"""Personal data: fixed shapes, and more found from their contexts by bootstrapping.

The shapes (mail address, IP address, payment card, phone number) give the seeds. Words
around a seed are a pattern; a pattern that mostly stands around seeds of one kind is
trusted and makes other identifier-like strings in the same place suspects of that kind.
Patterns and instances are a bipartite graph whose scores are computed in rounds, as joins
and aggregations: an instance is as certain as the patterns around it, a pattern as its
instances. Against a pattern count instances that cannot be of the kind; those that are
undecided do not. What ends with a high score and could be of the kind at all is added.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

from .common import text_of

KINDS = ("email", "ip", "card", "phone")

#: Rounds of scoring; what a pattern needs to be trusted: the share of what speaks for the
#: kind, and different seeds; the score from which an instance counts as found.
ROUNDS, TRUST, SEEDS, FOUND = 3, 0.9, 5, 0.9
#: Spans by text up to which the lookup is broadcast (some 200 bytes each).
BROADCAST_ROWS = 100_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_WORD = re.compile(r"\w+")
#: What a group of a number consists of, and what may stand between two.
_GROUP, _JOINTS = "0123456789.-()", "\x20.-()"
_OUTER = ".,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > after and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            found.append((begin, match.end()))
            after = match.end()
        else:
            after = at + 1
        at = text.find("@", after)
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the fixed shapes, by start, then by kind in the order listed."""
    if not _HINT.search(text):
        return []
    spans = [(*span, "email") for span in _emails(text)]
    spans += [(*m.span(), "ip") for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((*m.span(), "card"))
    spans += [(*m.span(), "phone") for m in _PHONE.finditer(text)
              if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def could_be(surface: str) -> list[str]:
    """Kinds that an identifier-like string outside the fixed shapes could be."""
    if "@" in surface:
        name, _, place = surface.partition("@")
        return ["email"] if len(name) > 1 and len(place) > 1 and "@" not in place else []
    if not surface.strip("0123456789.-()+/\x20"):
        digits = sum(map(str.isdigit, surface))
        return [kind for kind, fits in (("ip", surface.count(".") == 3 and digits >= 4 and "\x20" not in surface),
                                        ("card", 12 <= digits <= 19), ("phone", 7 <= digits <= 15)) if fits]
    return []


def _joins(text: str, a: tuple[int, int], b: tuple[int, int]) -> bool:
    """Whether two tokens are groups of one number, with blanks, dots, dashes and brackets between."""
    one, other = text[a[0]:a[1]], text[b[0]:b[1]]
    return not (text[a[1]:b[0]].strip(_JOINTS) or one.lstrip("+").strip(_GROUP) or other.strip(_GROUP)
                or "ip" in could_be(one) or "ip" in could_be(other))


def _unseen(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
    """``start, end, kinds`` of the tokens, where those of one number are joined: the longest
    run of groups, if it could be of some kind, or else its parts between brackets, stops and
    wide blanks, or else its tokens."""
    def joined(run):
        begin, end = run[0][0], run[-1][1]
        inside = text[begin:end]
        if len(run) > 1 and inside.count(")") > inside.count("(") and text[begin - 1:begin] == "(":
            begin -= 1
        return begin, end, could_be(text[begin:end])

    runs: list[list[tuple[int, int]]] = []
    for token in tokens:
        if runs and _joins(text, runs[-1][-1], token):
            runs[-1].append(token)
        else:
            runs.append([token])
    held = []
    for run in runs:
        whole = joined(run)
        if whole[2] or len(run) == 1:
            held.append(whole)
            continue
        parts = [[run[0]]]
        for before, token in zip(run, run[1:]):
            gap = text[before[1]:token[0]]
            if "(" in gap or ". " in gap or "  " in gap:
                parts.append([])
            parts[-1].append(token)
        for part in parts:
            one = joined(part)
            held += [one] if one[2] else [joined([token]) for token in part]
    return held


class _Context:
    """The words of a text around places in it, however long and however far."""

    def __init__(self, text: str):
        self.text = text
        spans = [word.span() for word in _WORD.finditer(text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def _words(self, first: int, last: int, lo: int, hi: int) -> list[str]:
        return [self.text[max(lo, self.starts[k]):min(hi, self.ends[k])].lower() for k in range(max(0, first), last)]

    def before(self, place: int) -> list[str]:
        """The last two; of a word that goes on past the place what stands before it."""
        k = bisect_left(self.starts, place)
        return self._words(k - 2, k, 0, place)

    def after(self, place: int) -> list[str]:
        """The first one, or what follows of it."""
        k = bisect_right(self.ends, place)
        return self._words(k, min(k + 1, len(self.ends)), place, len(self.text))


def mentions(text: str, spans: list[tuple[int, int, str]]) -> list[dict]:
    """Identifier-like strings with the patterns around them: the spans, and tokens with a
    digit or an at sign, or several that are groups of one number, which could be of some
    kinds or, as evidence only, of none."""
    if not spans and not _HINT.search(text):
        return []
    held = [(a, b, [], kind) for a, b, kind in spans]
    taken = sorted((a, b) for a, b, _ in spans)
    k, tokens = 0, []
    for token in _TOKEN.finditer(text):
        if not _HINT.search(token[0]):
            continue
        core = token[0].lstrip(_OUTER)
        begin = token.start() + len(token[0]) - len(core)
        core = core.rstrip(_OUTER)
        while k < len(taken) and taken[k][1] <= begin:
            k += 1
        if any(a < begin + len(core) and begin < b for a, b in taken[k:k + len(KINDS)]):
            continue
        if core:
            tokens.append((begin, begin + len(core)))
    held += [(a, b, kinds, None) for a, b, kinds in _unseen(text, tokens)]
    if not held:
        return []
    found, context = [], _Context(text)
    for begin, end, kinds, kind in held:
        left, right = context.before(begin), context.after(end)
        patterns = []
        if len(left) == 2:
            patterns.append(" ".join(left) + " _")
        if left and right:
            patterns.append(f"{left[-1]} _ {right[0]}")
        found.append({"start": begin, "end": end, "surface": text[begin:end].lower(), "kind": kind,
                      "kinds": kinds, "patterns": patterns})
    return found


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
_MENTION = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("surface", pa.string()), ("kind", pa.string()),
                      ("kinds", pa.list_(pa.string())), ("patterns", pa.list_(pa.string()))])
_SPANS = "array<struct<start:long,end:long,kind:string>>"


def _scan(docs: DataFrame) -> DataFrame:
    """``doc_id, row, text_key, base, mentions``; one pass over the texts."""
    given = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                        F.md5(F.col("text").cast("binary")).alias("text_key"), "text")
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            base, near = [], []
            for text in batch.column(3).to_pylist():
                spans = base_spans(text)
                base.append([{"start": a, "end": b, "kind": kind} for a, b, kind in spans])
                near.append(mentions(text, spans))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(base, pa.list_(_SPAN)), pa.array(near, pa.list_(_MENTION))],
                ["doc_id", "row", "text_key", "base", "mentions"])

    return given.mapInArrow(run, f"doc_id {kind}, row long, text_key string, base {_SPANS}, mentions "
                                 "array<struct<start:long,end:long,surface:string,kind:string,"
                                 "kinds:array<string>,patterns:array<string>>>")


def trusted_patterns(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern, kind, score`` of the patterns that the graph makes trustworthy.

    ``edges`` are distinct ``pattern, instance, kinds`` (what the instance could be, if it is
    no seed); ``seeds`` are ``instance, kind``. A pattern's score for a kind is the sum of its
    instances' scores over that sum plus the number of instances that speak against the kind:
    seeds of other kinds only, and others that could not be of it. It is trusted from TRUST
    on, with at least SEEDS different seeds. An instance that is no seed has the score of the
    best trusted pattern around it.
    """
    certain = seeds.select("instance", "kind", F.lit(1.0).alias("score"), F.lit(1).alias("seed"))
    possible = edges.select("pattern", "instance", F.explode("kinds").alias("kind")).unionByName(
        edges.select("pattern", "instance").join(seeds, "instance").select("pattern", "instance", "kind"))
    fitting = possible.distinct().groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("fitting"))
    width = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("width"))
    against = materialize(fitting.join(width, "pattern").select(
        "pattern", "kind", (F.col("width") - F.col("fitting")).alias("against")), "against")
    scores, trusted = certain, None
    for _ in range(rounds):
        sums = (edges.select("pattern", "instance").distinct().join(scores, "instance").groupBy("pattern", "kind")
                .agg(F.sum("score").alias("mass"), F.sum("seed").alias("seeds")))
        trusted = materialize(
            sums.join(against, ["pattern", "kind"])
            .withColumn("score", F.col("mass") / (F.col("mass") + F.col("against")))
            .filter((F.col("score") >= TRUST) & (F.col("seeds") >= SEEDS))
            .select("pattern", "kind", "score"), "patterns")
        reached = (possible.distinct().join(trusted, ["pattern", "kind"]).groupBy("instance", "kind")
                   .agg(F.max("score").alias("score"))
                   .join(seeds, ["instance", "kind"], "left_anti"))
        scores = certain.unionByName(reached.withColumn("seed", F.lit(0)))
    return trusted


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, row, text_key, base, added``, arrays of
    ``start, end, kind`` in code points, end exclusive.

    ``base`` holds the fixed shapes, per kind leftmost and not overlapping, ordered by start
    and then kind; ``added`` what the contexts add, never overlapping ``base``. NULL and
    empty texts have none; equal texts have equal spans; ids may repeat or be NULL; an empty
    table gives no rows; other columns are not looked at.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows = materialize(_scan(given), "mentions")
    each = rows.select("row", "text_key", F.explode("mentions").alias("m")).select("row", "text_key", "m.*")
    seeds = materialize(each.filter("kind is not null").select(F.col("surface").alias("instance"), "kind")
                        .distinct(), "seeds")
    # a surface that is a seed elsewhere counts as one, whatever else it could be
    seen = each.select(F.col("surface").alias("instance"), F.when(F.col("kind").isNull(), F.col("kinds")).otherwise(
        F.array().cast("array<string>")).alias("kinds"), F.explode("patterns").alias("pattern"))
    edges = materialize(seen.distinct().join(seeds.select("instance", F.lit(True).alias("seed")).distinct(), "instance", "left")
                        .select("pattern", "instance", F.when(F.col("seed"), F.array().cast("array<string>"))
                                .otherwise(F.col("kinds")).alias("kinds")).distinct(), "edges")
    trusted = trusted_patterns(edges, seeds)
    suspects = each.filter("kind is null").select(
        "row", "start", "end", F.explode("kinds").alias("kind"), "patterns")
    hits = (suspects.select("row", "start", "end", "kind", F.explode("patterns").alias("pattern"))
            .join(trusted.filter(F.col("score") >= FOUND), ["pattern", "kind"])
            .groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind")))
    added = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))
    return rows.drop("mentions").join(added, "row", "left").withColumn(
        "added", F.coalesce("added", F.array().cast(_SPANS)))


def ordered(spans: Column) -> Column:
    """Spans by start, then by kind as listed, then by end."""
    rank = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.array_sort(keyed)


def shown(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(ordered(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    parts, at = [], 0
    for begin, end, kind in sorted(spans):
        if begin >= at:
            parts += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                       n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced by ``[EMAIL]``, ``[IP]``,
    ``[CARD]`` or ``[PHONE]``; ``n_chars``, where present, is counted anew for these texts.
    All rows and columns stay; texts without personal data stay as they are."""
    found = find_personal_data(docs, text, doc_id).select(
        F.col("text_key").alias("__key"), F.concat("base", "added").alias("__spans")).filter(
        F.size("__spans") > 0)
    by_text = materialize(found.groupBy("__key").agg(F.first("__spans").alias("__spans")), "spans")
    if by_text.count() <= BROADCAST_ROWS:
        by_text = F.broadcast(by_text)

    @F.pandas_udf("string")
    def mask(texts, spans):
        return texts.combine(spans, lambda t, s: t if t is None or s is None else masked(
            t, [(x["start"], x["end"], x["kind"]) for x in s]))

    joined = docs.join(by_text, F.md5(text_of(text).cast("binary")) == F.col("__key"), "left")
    changed = F.col("__spans").isNotNull()
    new = joined.withColumn("__text", F.when(changed, mask(F.col(text), F.col("__spans"))).otherwise(F.col(text)))
    columns = []
    for field in docs.schema.fields:
        if field.name == text:
            columns.append(F.col("__text").alias(text))
        elif field.name == n_chars:
            columns.append(F.when(changed, F.length("__text").cast(field.dataType))
                           .otherwise(F.col(n_chars)).alias(n_chars))
        else:
            columns.append(F.col(field.name))
    return new.select(*columns)
