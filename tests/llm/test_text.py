"""Chat formatting, URL filter, personal data, quality rules."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendweave.llm import chat, pii, quality, url_filter
from spendweave.llm.common import sha256_text

# -- chat -----------------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "", None, "<s>", "<\\s>", "<\\\\s> and <s>", "<<SYS>>\n\n<</SYS>>", "[/INST", "[",
         "<", "<|role:6F|>x<|end|>\n", "a\n</s>\n", "<<s>", "[\\\\INST]", "plain", "\\", "é </s> 日本", " [/INST] ",
         "x" * 30_000 + "</s>"]


def conversations(spark):
    rng = np.random.default_rng(4)
    roles = ["user", "assistant", "system", "tool", "", None, "user\n", "<s>"]
    rows = [(c, int(t), roles[rng.integers(0, len(roles))], NASTY[rng.integers(0, len(NASTY))], "clash")
            for c in range(25) for t in range(rng.integers(1, 7))]
    rows += [(100, 0, "user", "same", "x"), (100, 0, "user", "same", "x"), (None, None, "assistant", "n", "x"),
             (-1, 0, "user", NASTY[0], "x"), (-1, 1, "assistant", NASTY[0], "x")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")


def test_chat_comes_back(spark):
    rows, df = conversations(spark)
    found = {r.conv_id: r for r in chat.format_conversations(df).withColumns({
        "loss": chat.loss_text(F.col("formatted")), "read": chat.parse(F.col("formatted"))}).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text, _ in rows if c == conv))
        expected = [(role, text) for _, _, role, text in own]
        assert [(t.role, t.text) for t in r.turns] == expected
        assert [(t.role, t.text) for t in r.read] == expected
        assert r.loss == "".join(text for role, text in expected if role == "assistant")
        inside = "".join(re.sub(chat.ESCAPED, lambda m: "".join(m.groups()), r.formatted[s.start:s.end])
                         for s in r.loss_spans)
        assert inside == r.loss


def test_chat_plain_texts_are_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi <b> [x]"), (1, 1, "assistant", "yes\\")],
                               "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first().formatted == "[INST] hi <b> [x] [/INST]<s>yes\\</s>\n"
    assert chat.format_conversations(df.limit(0)).count() == 0
    plan = chat.format_conversations(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- URLs ------------------------------------------------------------------------------

URLS = {
    "http://a.net/x": ("a.net", "/x", "net/", "block"),
    "https://a.example.net/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "HTTP://Example.COM/de/": ("example.com", "/de/", "example.com/de/", "block"),
    "http://x.org/fr/casino": ("x.org", "/fr/casino", "org/fr/", "allow"),
    "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
    "http://a.net": ("a.net", "", None, "allow"),
    "http://a.net?x/": ("a.net", "", None, "allow"),
    "http://site.com/Casino": ("site.com", "/Casino", None, "block"),
    "http://site.com/casinos": ("site.com", "/casinos", None, "allow"),
    "http://site.com/poker": ("site.com", "/poker", None, "allow"),
    "http://site.com/poker/poker": ("site.com", "/poker/poker", None, "allow"),
    "http://poker.com/free-x": ("poker.com", "/free-x", None, "block"),
    "http://x.com/a?b=xxx": ("x.com", "/a", None, "block"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "http://h.com/" + "free" * 20_000: ("h.com", "/" + "free" * 20_000, None, "allow"),
    None: ("", "", None, "allow"),
}


def test_urls(spark):
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate([*URLS, None, "http://a.net/x"])],
                               "page_id long, url string, host string")
    rows = url_filter.filter_urls(df).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[r.url], r.url
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_url_terms_need_boundaries():
    def count(url):
        return url_filter.hits(url, ("xxx",), ("bet", "betting"))
    assert count("xxx") == (1, 0) and count("axxx xxx1") == (0, 0) and count("-XXX-xxx") == (1, 0)
    assert count("bet.betting") == (0, 2) and count("betting") == (0, 1) and count("ébeté") == (0, 1)


# -- personal data -----------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_by_hand(text):
    def digits(match):
        return re.sub("[^0-9]", "", match[0])

    found = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text)
              if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    found += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def test_base_shapes_equal_the_patterns():
    rng = np.random.default_rng(9)
    pool = ["a@b.c", "a@b", "@", ".", "+1", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", " ", "-",
            "4111111111111111", "(", ")", "0", "00012", "x", "é", "+49 (30) 123-4567", "a.b+c@d-e.f.g", "%", "\n", "..1"]
    for _ in range(3000):
        text = "".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 12)))
        assert pii.base_spans(text) == base_by_hand(text), text
    for long in ("1" * 50_000, "a" * 50_000 + "@", "1." * 20_000, "+1 " * 20_000, "a@" * 20_000):
        pii.base_spans(long)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")




def spark_rows(rows):
    return [(i, t, "clash", "k") for i, t in rows]


def test_contexts_find_unseen_identifiers(spark):
    rows = [(k, f"please call me at +1 (555) 555-{1000 + k} today") for k in range(30)]
    rows += [(100, "please call me at 555-123-4567 today"), (101, "we sold 555-123-4567 units"), (102, None), (103, ""),
             (104, "nothing here"), (105, "call me at 5551234567 today"), (None, "mail a@b.co, a@b.co")]
    df = spark.createDataFrame(spark_rows(rows), "doc_id long, text string, row string, kind string")
    found = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert len(found) == len(rows)
    assert [(s.start, s.end, s.kind) for s in found[100].added] == [(18, 30, "phone")]
    assert not found[101].added and not found[104].added and not found[104].base
    assert [s.kind for s in found[105].added] == ["phone"]
    assert [(s.start, s.end) for s in found[None].base] == [(5, 11), (13, 19)]
    text = dict(rows)
    for i, r in found.items():
        assert [(s.start, s.end, s.kind) for s in r.base] == base_by_hand(text[i] or "")
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_context_reaches_as_far_as_the_words_stand():
    long = "w" * 500
    text = f"{long} call{' ' * 300}5551234{' ' * 200}({long}"
    (mention,) = pii.mentions(text, [])
    assert mention["patterns"] == [f"{long} call _", f"call _ {long}"]
    whole = pii._Context("ab12cd ef")
    assert whole.before(2) == ["ab"] and whole.after(4) == ["cd"] and whole.before(9) == ["ab12cd", "ef"]
    assert whole.after(9) == [] and pii._Context("").before(0) == []


def test_undecided_instances_do_not_speak_against_a_pattern(spark):
    texts = [f"please call me at +1555555{1000 + k} today" for k in range(12)]
    texts += [f"please call me at 555444{1000 + k} today" for k in range(24)]
    texts += [f"the order number +1555333{1000 + k} was sent" for k in range(12)]
    texts += [f"the order number {100 + k} was sent" for k in range(12)] + ["the order number 5552221000 was sent"]
    texts += [f"from host 10.0.0.{k} and" for k in range(4)] + ["from host 300.0.0.1 and"]     # too few seeds
    df = spark.createDataFrame(spark_rows(enumerate(texts)), "doc_id long, text string, row string, kind string")
    found = {r.doc_id: [(s.start, s.end, s.kind) for s in r.added] for r in pii.find_personal_data(df).collect()}
    assert {i for i, added in found.items() if added} == set(range(12, 36))
    assert all(found[i] == [(18, 28, "phone")] for i in range(12, 36))


def test_unseen_numbers_in_groups(spark):
    def unseen(text):
        spans = pii.base_spans(text)
        return [(text[m["start"]:m["end"]], m["kinds"]) for m in pii.mentions(text, spans) if m["kinds"]]

    assert unseen("call 555 123 4567 now") == [("555 123 4567", ["phone"])]
    assert unseen("call (555) 123-4567, now") == [("(555) 123-4567", ["phone"])]
    assert unseen("call 555 - 123 - 4567.") == [("555 - 123 - 4567", ["phone"])]
    assert unseen("card 4111 1111 1111 1112 ok") == [("4111 1111 1111 1112", ["card"])]
    assert unseen("(555) 123-4567 (555) 987-6543") == [("(555) 123-4567", ["phone"]), ("(555) 987-6543", ["phone"])]
    assert unseen("host 300.0.0.1 555 123 4567") == [("300.0.0.1", ["ip"]), ("555 123 4567", ["phone"])]
    assert unseen("555 1234\n567 8901") == [("555 1234", ["phone"]), ("567 8901", ["phone"])]
    assert unseen("555, 123, 4567 and x5 12/34/5678") == [("12/34/5678", ["phone"])]
    (mention,) = pii.mentions("please call me at (555) 123-4567 today", [])
    assert mention["patterns"] == ["me at _", "at _ today"]

    rows = [(k, f"please call me at +1 (555) 555-{1000 + k} today") for k in range(12)]
    rows += [(100, "please call me at (555) 123-4567 today"), (101, "please call me at 555 123 4567 today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end, s.kind) for s in r.added] for r in pii.find_personal_data(df).collect()}
    assert found[100] == [(18, 32, "phone")] and found[101] == [(18, 30, "phone")]


def test_masking_keeps_rows_and_columns(spark):
    rows = [(1, "mail a@b.co now", 15), (1, "mail a@b.co now", 15), (2, None, None), (None, "clean", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    done = pii.mask_personal_data(df)
    assert done.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, done.collect()), key=repr) == sorted(
        [(1, "mail [EMAIL] now", 16)] * 2 + [(2, None, None), (None, "clean", 5)], key=repr)
    assert pii.masked("ab cd", [(0, 2, "ip"), (1, 4, "card")]) == "[IP]d"


# -- quality ---------------------------------------------------------------------------

def measured_by_hand(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[k:k + 3]) for k in range(len(found) - 2)]
    marked = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(marked))


TEXTS = ["", " ", "a", "a b c a b c", "a b a b a b a", "x\nx\n\n \nx y", "#* é|<>\n#*", "w " * 30, "one two three four " * 3,
         "A\u00a0b c\x0bd", " ".join(f"v{k % 7}" for k in range(60)), "\n\n", "a a a a"]


def test_measures_equal_brute_force():
    rng = np.random.default_rng(7)
    more = [" ".join(f"t{k}" for k in rng.integers(0, 4, n)) for n in range(0, 40)]
    for text in TEXTS + more:
        assert quality.measure(text)[:5] == measured_by_hand(text), text


def test_binomial_bound():
    # the exact upper bound for 0 of n at level 0.05 is 1 - 0.05 ** (1 / n)
    for n in (10, 100, 1000):
        bound = 1 - 0.05 ** (1 / n)
        assert quality.upper_bound_holds(0, n, bound * 1.001, 0.05)
        assert not quality.upper_bound_holds(0, n, bound * 0.999, 0.05)
    assert not quality.upper_bound_holds(0, 0, 0.5, 0.05) and not quality.upper_bound_holds(3, 3, 0.5, 0.05)
    tail = sum(math.comb(50, k) * 0.2**k * 0.8 ** (50 - k) for k in range(5))
    assert quality.upper_bound_holds(4, 50, 0.2, tail * 1.0001) and not quality.upper_bound_holds(4, 50, 0.2, tail * 0.999)


def labelled(spark, n, junk_share=0.3):
    rng = np.random.default_rng(11)
    rows, labels = [], []
    for k in range(n):
        bad = rng.random() < junk_share
        body = [f"w{x}" for x in rng.integers(0, 9000, 70)]
        rows.append((k, " ".join(w + "%%%" for w in body) if bad else " ".join(body), ("en", None)[k % 2], "clash"))
        if k % 2 == 0 or k < n // 2:
            labels.append((k, 0 if bad else 1))
    labels += [(None, 1), (3, None), (10**9, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string"),
            spark.createDataFrame(labels, "doc_id long, quality int"), rows)


def test_quality_rejects_junk_and_keeps_good(spark):
    docs, labels, rows = labelled(spark, 3000)
    found = quality.judge_documents(docs, labels, allowed=0.1).collect()
    assert len(found) == len(rows)
    text = {i: t for i, t, _, _ in rows}
    for r in found:
        assert not r.base_failed and r.kept == ("%" not in text[r.doc_id])


def test_quality_without_evidence_rejects_nothing_more(spark):
    docs, labels, rows = labelled(spark, 60)
    more = spark.createDataFrame([(900, None, "en", "x"), (900, None, "en", "x"), (901, "short", None, "x"),
                                  (902, "a b c " * 40, "fr", "x")], docs.schema)
    for given in (labels, labels.limit(0)):
        found = quality.judge_documents(docs.unionByName(more), given).collect()
        assert len(found) == len(rows) + 4
        assert {r.doc_id for r in found if not r.kept} == {900, 901, 902}
        assert {r.doc_id for r in found if r.base_failed} == {900, 901, 902}
    assert quality.judge_documents(docs.limit(0), labels).count() == 0
    left = quality.keep_good_documents(docs.unionByName(more), labels)
    assert left.columns == docs.columns and left.count() == len(rows)


def test_digest_helper(spark):
    assert spark.range(1).select(sha256_text(F.lit("é"))).first()[0] == hashlib.sha256("é".encode()).hexdigest()


@pytest.mark.parametrize("good,bad,expected", [
    ([0] * 49 + [4000], [50] + [0] * 49, 0.98), ([0] * 49 + [10], [50] + [0] * 49, None),
    ([0] * 10 + [4000] + [0] * 39, [0] * 5 + [9] + [0] * 44, 0.88)])
def test_cutoffs(good, bad, expected):
    assert quality.choose_cutoff(good + [0] * (50 - len(good)), bad, 0.02 / 6, 0.05 / 24) == expected
