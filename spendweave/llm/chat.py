"""Chat formatting with a grammar that is read back.

Every turn is rendered between the marks of its role. The rendered text is then parsed
again by a deterministic grammar and compared with the source; a turn that does not come
back identically has its control strings escaped. DataFrame functions only.

    conversation = turn*
    turn         = "[INST] " text " [/INST]"                    user
                 | "<<SYS>>\\n" text "\\n<</SYS>>\\n"              system
                 | "<s>" text "</s>\\n"                          assistant
                 | "<|role:" hex of the role "|>" text "<|end|>\\n"   any other role

A text holds no control string. Escaping adds one backslash behind the first character of
each control string, also of one that already has some there, so it can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
         "assistant": ("<s>", "</s>\n")}
_REST = r"(/?INST\]|/?s>|</?SYS>>|\|role:|\|end\|>)"
CONTROL = r"([<\[])(\\*)" + _REST
ESCAPED = r"([<\[])\\(\\*)" + _REST
#: One turn; what is between the marks is checked afterwards.
TURN = (r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>\n.*?\n<</SYS>>\n|<s>.*?</s>\n"
        r"|<\|role:[0-9A-F]*\|>.*?<\|end\|>\n")
_OTHER_OPEN, _OTHER_CLOSE = r"^<\|role:[0-9A-F]*\|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def opening(role: Column) -> Column:
    shown = F.concat(F.lit("<|role:"), F.hex(F.encode(role, "UTF-8")), F.lit("|>"))
    for name, (begin, _) in MARKS.items():
        shown = F.when(role == name, F.lit(begin)).otherwise(shown)
    return shown


def closing(role: Column) -> Column:
    shown = F.lit(_OTHER_CLOSE)
    for name, (_, end) in MARKS.items():
        shown = F.when(role == name, F.lit(end)).otherwise(shown)
    return shown


def _inner(segment: Column, begin: int, end: int) -> Column:
    return F.substring(segment, begin + 1, F.length(segment) - begin - end)


def parsed_turn(segment: Column) -> Column:
    """Role and text of one rendered turn; NULL text where a control string stands inside."""
    head = F.regexp_extract(segment, _OTHER_OPEN, 0)
    role = F.decode(F.unhex(F.regexp_extract(head, r"^<\|role:([0-9A-F]*)\|>", 1)), "UTF-8")
    inner = F.substring(segment, F.length(head) + 1,
                        F.length(segment) - F.length(head) - len(_OTHER_CLOSE))
    for name, (begin, end) in MARKS.items():
        own = F.startswith(segment, F.lit(begin))
        role = F.when(own, F.lit(name)).otherwise(role)
        inner = F.when(own, _inner(segment, len(begin), len(end))).otherwise(inner)
    live = F.regexp_like(inner, F.lit(r"[<\[]" + _REST))
    return F.struct(role.alias("role"), F.when(~live, unescape(inner)).alias("text"))


def segments(formatted: Column) -> Column:
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text."""
    return F.transform(segments(formatted), parsed_turn)


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text",
                         trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, turns, loss_spans``.

    ``turns`` is what the parser reads back from ``formatted``; the query fails if it
    differs from the source. ``loss_spans`` are the code points (start, end exclusive) of
    ``formatted`` that hold the texts of role ``trained``, still escaped.

    Turns are ordered by ``turn``, then role and text, so ties and repeated rows have one
    order; NULL turns come first. NULL texts and roles count as empty, NULL ``conv_id`` is
    a conversation of its own. A conversation is one row of the result, thus held by one
    task; conversations are spread by their id. An empty table gives no rows. Other columns
    are dropped.
    """
    source = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    begin, end = opening(F.col("role")), closing(F.col("role"))
    plain = F.concat(begin, "text", end)
    back = segments(plain)
    same = (F.size(back) == 1) & (F.get(back, F.lit(0)) == plain) & (
        parsed_turn(plain).eqNullSafe(F.struct("role", "text")))
    rendered = source.withColumn("segment", F.when(same, plain).otherwise(
        F.concat(begin, escape(F.col("text")), end)))
    together = rendered.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "segment"))).alias("source"))
    formatted = together.withColumn(
        "formatted", F.array_join(F.transform("source", lambda t: t["segment"]), ""))
    read = formatted.withColumn("segments", segments(F.col("formatted"))).withColumn(
        "turns", F.transform("segments", parsed_turn))
    identical = (F.array_join("segments", "") == F.col("formatted")) & (
        F.col("turns") == F.transform("source", lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("text"))))
    # a running sum of the turns' lengths
    ends = F.aggregate(
        "segments", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>")
                             .alias("spans")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s)).alias("at"),
            F.when(F.startswith(s, F.lit(MARKS[trained][0])), F.array_append(a["spans"], F.struct(
                (a["at"] + len(MARKS[trained][0])).alias("start"),
                (a["at"] + F.length(s) - len(MARKS[trained][1])).alias("end"))))
            .otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    return read.select(
        "conv_id",
        F.when(identical, F.col("formatted")).otherwise(F.raise_error(
            F.lit("a conversation does not come back identically"))).alias("formatted"),
        "turns", ends.alias("loss_spans"))


def loss_text(formatted: Column, trained: str = "assistant") -> Column:
    """All text under the loss mask, unescaped, in order."""
    begin, end = (len(mark) for mark in MARKS[trained])
    own = F.filter(segments(formatted), lambda s: F.startswith(s, F.lit(MARKS[trained][0])))
    return F.array_join(F.transform(own, lambda s: unescape(_inner(s, begin, end))), "")
