"""The registered query of each operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (bpe, chat, exact_dedup, fill_middle, license_scan, near_dedup, packing, pii, quality, suffix_dedup,
               url_filter, vector_codes, wordpiece)
from .common import ORACLE, QUERIES, bounded_batches, query, sha256_text, table  # noqa: F401

#: A conversation whose texts consist of control strings.
CONFLICT = "</s>[INST] ok [/INST]"

_CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown as (
  select *, regexp_replace(text, '([<\[])(\\*)(/?INST\]|/?s>|</?SYS>>|\|role:|\|end\|>)',
                           '\1\\\2\3', 'g') as escaped,
    case role when 'user' then 15 when 'system' then 18 when 'assistant' then 8
         else 18 + 2 * octet_length(encode(role)) end as marks
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), ''))
    as loss_sha256,
  cast(sum(length(escaped) + marks) as bigint) as formatted_chars
from shown group by conv_id"""


@query("op5_chat_format", _CHAT_SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)],
                                 given.schema)
    done = chat.format_conversations(given.unionByName(more))
    loss = chat.loss_text(F.col("formatted"))
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        sha256_text(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), sha256_text(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def _url_sql() -> str:
    def fits(text: str) -> str:
        host, path = text[:text.index("/")], text[text.index("/"):]
        return (f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')")

    ordered = sorted(url_filter.RULES, key=lambda r: -len(r[1]))

    def distinct_hits(terms):
        return " + ".join(f"cast(regexp_matches(lowered, '(^|[^a-z0-9]){t}($|[^a-z0-9])') as int)"
                          for t in terms)

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rule = " ".join(f"when {fits(r)} then '{r}'" for _, r in ordered)
    said = " ".join(f"when '{r}' then '{v}'" for v, r in ordered)
    return f"""
with parts as (
  select page_id, translate(coalesce(url, ''), '{upper}', '{lower}') as lowered,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{upper}', '{lower}') as host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path from pages),
ruled as (select *, case {rule} end as rule from parts),
counted as (select *, cast({distinct_hits(url_filter.STRICT)} as int) as n_strict,
  cast({distinct_hits(url_filter.SOFT)} as int) as n_soft from ruled)
select page_id, host, path, rule, n_strict, n_soft, case rule {said} else
  case when n_strict > 0 or n_soft >= {url_filter.SOFT_HITS} then 'block' else 'allow' end end as verdict
from counted"""


@query("op7_url_filter", _url_sql())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "n_strict", "n_soft", "verdict")


@query("op10_exact_dedup", r"""
with keyed as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                 as text_sha256 from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, text_sha256
from keyed window same as (partition by text_sha256)""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256_text(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return wordpiece.count_tokens(table(spark, sf_dir, "documents"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    judged = quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "failed_rules")


def _near_sql() -> str:
    """Exact similarities by an inverted index of shingles, and components by recursion."""
    return r"""
with recursive lowered as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
words as (select doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from lowered),
sets as (
  select doc_id, case when len(w) = 0 then []
    else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)]) end as s
  from words),
items as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
sides as (select a, b from pairs union all select b, a from pairs),
reach as (select doc_id as node, doc_id as seen from sets
          union select r.node, e.b from reach r join sides e on e.a = r.seen)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join (select node, min(seen) as component_id from reach group by node) c on c.node = doc_id"""


@query("op4_near_dedup", _near_sql())
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return suffix_dedup.remove_repeated(table(spark, sf_dir, "documents")).drop("spans")


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), sha256_text(pii.shown(F.col("base"))).alias("base_sha256"),
                        pii.shown(F.concat("base", "added")).alias("spans"))


def _codes_sql() -> str:
    """The rounds one after the other; codebooks by part, entry and component."""
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    rounds = []
    for k in range(vector_codes.ROUNDS + 1):
        rounds.append(f"""
assigned{k} as (
  select rid, part, min(distance) as error, arg_min(entry, (distance, entry)) as entry from (
    select c.rid, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) as distance
    from cells c join book{k} b on b.part = c.part and b.place = c.place group by c.rid, c.part, b.entry)
  group by rid, part)""")
        if k < vector_codes.ROUNDS:
            rounds.append(f"""
means{k} as (
  select a.part, a.entry, c.place, floor(sum(c.x) / cast(count(*) as double)) as x
  from assigned{k} a join cells c on c.rid = a.rid and c.part = a.part group by a.part, a.entry, c.place),
book{k + 1} as (
  select b.part, b.entry, b.place, cast(coalesce(m.x, b.x) as bigint) as x
  from book{k} b left join means{k} m on m.part = b.part and m.entry = b.entry and m.place = b.place)""")
    last = vector_codes.ROUNDS
    return f"""
with kept as (
  select *, row_number() over (order by vec_id nulls last, embedding) - 1 as rid from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cells as (
  select rid, i // (len(embedding) // {parts}) as part, i % (len(embedding) // {parts}) as place,
    cast(floor(cast(embedding[i + 1] as double) * {scale}) as bigint) as x
  from (select rid, embedding, unnest(range(len(embedding))) as i from kept)),
book0 as (select part, rid as entry, place, x from cells where rid < {entries}),
{",".join(rounds)},
coded as (
  select rid, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(error) as bigint) as error
  from assigned{last} group by rid),
digest as (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, place)) as codebooks_sha256 from book{last})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from kept join coded using (rid) cross join digest"""


@query("op11_vector_codes", _codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _middle_sql() -> str:
    rule = fill_middle.Rule()
    p, s, m = rule.markers
    return f"""
with drawn as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
                 sha256('{rule.seed}:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
numbers as (select *, {", ".join(f"cast('0x' || substr(h, {8 * k + 1}, 8) as bigint) as h{k + 1}" for k in range(4))}
            from drawn),
formed as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when n = 0 or contains(text, '{p}') or contains(text, '{s}') or contains(text, '{m}')
            or h3 % 100 >= {100 - rule.plain_percent} then 'plain'
       when h4 % 100 < {rule.spm_percent} then 'spm' else 'psm' end as form from numbers),
cut as (select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle, substr(text, b + 1) as suffix
        from formed)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
  case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '{p}' || prefix || '{s}' || suffix || '{m}' || middle
         else '{s}' || suffix || '{p}' || prefix || '{m}' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from cut"""


@query("op12_fill_in_middle", _middle_sql())
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restore(made)
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       sha256_text(F.col("output")).alias("output_sha256"),
                       sha256_text(F.col("restored")).alias("restored_sha256"))


@query("op13_license_scan")
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    first = F.transform("base", lambda p: p["first_word"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        license_scan.labels_of("base").alias("base_labels"),
        license_scan.labels_of("base", "places").alias("labels"), "score", "places")


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
