"""Vector codes, fill-in-middle and license scans against plain versions of themselves."""

import hashlib
import json
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendweave.llm import fill_middle, license_scan, vector_codes
from spendweave.llm.license_scan import NOTICES, PHRASES, Notice

# ---- vector codes


def codes_by_hand(table, parts, entries, rounds, scale=256):
    """(codebooks, {row number: (code, error)}) with Python integers; rows are (id, vector)."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in table
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v in kept), default=0)
    width = -(-longest // parts)
    kept = [(i, v + [0] * (parts * width - len(v))) for i, v in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[v[p * width:(p + 1) * width] for _, v in order[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for step in range(rounds + 1):
        found = [[nearest(p, v[p * width:(p + 1) * width]) for p in range(parts)] for _, v in kept]
        if step == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                members = [v[p * width:(p + 1) * width] for (_, v), f in zip(kept, found, strict=True) if f[p][1] == k]
                if members:
                    books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    return books, [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for (i, _), f in zip(kept, found, strict=True)]


def check_codes(spark, table, **sizes):
    sizes = {"parts": 2, "entries": 3, "rounds": 2} | sizes
    frame = spark.createDataFrame([(i, v, i and i % 2) for i, v in table], "vec_id long, embedding array<double>, label int")
    codes, books = vector_codes.vector_codes(frame, **sizes)
    rows = codes.collect()
    by_hand, expected = codes_by_hand(table, sizes["parts"], sizes["entries"], sizes["rounds"])
    assert sorted(((r.vec_id, r.code, r.error) for r in rows), key=repr) == sorted(
        ((i, c, min(e, 2**63 - 1)) for i, c, e in expected), key=repr)
    flat = [x for part in by_hand for entry in part for x in entry]
    assert books.digest() == hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    totals = {}
    for r in rows:
        totals[r.label] = totals.get(r.label, 0) + r.error
    assert all(r.label_error == min(totals[r.label], 2**63 - 1) for r in rows)
    return rows, codes, books


def test_codes_of_random_vectors_with_gaps(spark):
    pick = random.Random(4)
    table = [(pick.choice([None, *range(9)]), pick.choice([None, [None, 1.0, 2.0, 3.0], [float("nan"), 1.0, 0.0, 0.0],
              [float("inf"), 0.0, 0.0, 0.0]]) if pick.random() < .2 else [pick.gauss(0, 1) for _ in range(4)])
             for _ in range(120)]
    check_codes(spark, table)


def test_codes_of_ties_repeats_and_odd_lengths(spark):
    same = [(i, [1.0, -1.0, 0.5]) for i in range(6)]
    rows, codes, books = check_codes(spark, [*same, (7, []), (8, [2.0]), (9, [1.0, -1.0, 0.5])])
    # the first entry moves away from the copies, the second, unused so far, is theirs
    assert len(rows) == 9 and {r.code for r in rows if r.vec_id < 6} == {"0101"}
    back = vector_codes.decode(codes, books).select("vec_id", "approximation").collect()
    assert all(len(r.approximation) == 4 for r in back)


def test_codes_of_large_components_need_limbs_and_wide_integers(spark):
    pick = random.Random(9)
    some = [(i, [pick.uniform(-1, 1) * 10 ** 5 for _ in range(4)]) for i in range(40)]
    check_codes(spark, some)
    assert vector_codes.limb_plan(2, 256 * 10 ** 5)[1] == 1 and vector_codes.limb_plan(96, 2**40)[1] == 2
    wide = [(i, [float(pick.randrange(-2**44, 2**44)) for _ in range(4)]) for i in range(20)]
    rows, _, _ = check_codes(spark, wide, rounds=0)
    assert max(r.error for r in rows) == 2**63 - 1


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(0, 2**32), st.integers(1, 70))
def test_dot_products_are_exact(bits, seed, width):
    pick = np.random.default_rng(seed)
    x, c = (pick.integers(-2**bits, 2**bits, (5, width)) for _ in range(2))
    x, c = (np.float64(m) for m in (x, c))                    # integers that float64 can hold
    largest = int(max(abs(x).max(), abs(c).max()))
    found = vector_codes.dot_products(x, c, largest)
    exact = [[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in c] for r in x]
    assert found.tolist() == exact


def test_codes_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label string, code string")
    codes, books = vector_codes.vector_codes(frame)
    assert codes.count() == 0 and books.digest() == hashlib.sha256(b"").hexdigest()


# ---- fill in the middle


def middle_by_hand(doc_id, text, rule=fill_middle.Rule()):
    text = text or ""
    digest = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n, (p, s, m) = len(text), rule.markers
    if not n or any(x in text for x in rule.markers) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    psm = p + text[:a] + s + text[b:] + m + text[a:b]
    spm = s + text[b:] + p + text[:a] + m + text[a:b]
    return doc_id, n, "spm" if h[3] % 100 < 20 else "psm", a, b - a, spm if h[3] % 100 < 20 else psm, text


def check_middle(spark, table, rule=fill_middle.Rule()):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in table], "doc_id long, text string, restored string, n int")
    back = fill_middle.restore(fill_middle.fill_in_middle(frame, rule=rule), rule)
    assert back.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted((middle_by_hand(i, t, rule) for i, t in table), key=repr)


def test_middle_of_odd_texts(spark):
    pick = random.Random(1)
    odd = ["", None, "<P>", "a<M>b", "<", "<S", "<P<S<M", "é", "日本語🎉", "ab\n\x00c", "><P"]
    table = [(i, pick.choice(odd) if i % 3 else "".join(pick.choices("aé🎉<PSM> \n", k=pick.randrange(40))))
             for i in range(400)]
    check_middle(spark, [*table, (None, "no id"), (None, None), (5, "again"), (5, "again")])


def test_middle_over_block_and_group_borders(spark, monkeypatch):
    pick = random.Random(2)
    long = ["".join(pick.choices("aé日🎉", k=n)) for n in (1, 4095, 4096, 40000, 131072, 300000)]
    check_middle(spark, list(enumerate(long * 3)))
    many = np.concatenate([[3], np.zeros(5, "int64"), [2]])      # empty parts share a place
    monkeypatch.setattr(fill_middle, "BLOCK", 2)
    got = np.concatenate([t for _, t in fill_middle.shifted(5, np.cumsum(many) - many, np.arange(7) * 10)])
    assert got.tolist() == [0, 1, 2, 63, 64]


def test_middle_with_other_markers_and_no_rows(spark):
    check_middle(spark, [(i, "some text that is cut") for i in range(50)], fill_middle.Rule("9", ("[pre]", "{suf}", "(mid)")))
    check_middle(spark, [])
    for marks in (("<P>", "<P>x", "<M>"), ("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "xy"), ("|a|", "b", "c")):
        with pytest.raises(ValueError):
            fill_middle.Rule(markers=marks)


def test_an_output_of_another_form_fails():
    data = np.frombuffer(b"plain", "uint8")
    with pytest.raises(ValueError):
        fill_middle.recover(data, np.array([5]), ["psm"], [b"<P>", b"<S>", b"<M>"])


# ---- license scans


def words_by_hand(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def least_edits(pattern, text):
    """By end in ``text``, the fewest edits of ``pattern`` ending there, from any word on: one
    row of the table of distances after the other."""
    chars = np.array([ord(c) for c in text])
    place = np.arange(len(text) + 1)
    row = np.where([i == 0 or text[i - 1] == " " for i in place], 0, 10**6)
    row = np.minimum.accumulate(row - place) + place             # characters put in before the first
    for p in pattern:
        below = row + 1
        below[1:] = np.minimum(below[1:], row[:-1] + (chars != ord(p)))
        row = np.minimum.accumulate(below - place) + place
    return row.tolist()


def notices_by_hand(words, notices):
    """{number of a notice: fewest edits} of those that occur."""
    text, found = " ".join(words), {}
    for k, notice in enumerate(notices):
        tail = f" {notice.tail}" if notice.tail else ""
        for end, edits in enumerate(least_edits(notice.words, text)):
            stop = end + len(tail)
            if edits <= notice.errors and text[end:stop] == tail and (stop == len(text) or text[stop] == " "):
                found[k] = min(edits, found.get(k, 99))
    return found


def base_of(words, phrases=PHRASES):
    found = []
    for notice in phrases:
        phrase = notice.words.split()
        found += [(i, notice.label) for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    return sorted(found)


def damaged(pick, notice):
    text = list(notice.words)
    for _ in range(pick.randrange(notice.errors + 3)):
        at = pick.randrange(len(text))
        text[at:at + pick.randrange(2)] = pick.choice(["", "x", "é", " ", "e"])
    return "".join(text) + pick.choice([" ", "-", "\n"]) + notice.tail


def check_licenses(spark, table, notices=NOTICES, phrases=PHRASES):
    frame = spark.createDataFrame([(i, t, 0) for i, t in table], "doc_id long, text string, base int")
    rows = license_scan.scan_licenses(frame, phrases=phrases, notices=notices).collect()
    texts = {}
    for i, t in table:
        texts.setdefault(i, []).append(t)
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in table)
    for r in rows:
        text = texts[r.doc_id][0] or ""
        words = words_by_hand(text)
        base, fuzzy = base_of(words, phrases), notices_by_hand(words, notices)
        assert r.n_words == len(words)
        assert sorted((p.first_word, p.label) for p in r.base) == base
        assert {p.notice for p in r.places} == set(fuzzy), text
        best = max([0.0, *[1.0 for _ in base], *[1 - e / notices[k].length for k, e in fuzzy.items()]])
        assert r.score == pytest.approx(best)
        for p in [*r.base, *r.places]:
            # the span holds exactly the words that are reported
            assert words_by_hand(text[p.begin:p.end]) == words[p.first_word:p.last_word + 1]
    return rows


def test_licenses_in_damaged_notices(spark):
    pick = random.Random(3)
    table = []
    for i in range(300):
        parts = [damaged(pick, pick.choice(NOTICES + PHRASES)) for _ in range(pick.randrange(3))]
        table.append((i, pick.choice([" and ", ". ", "\n", ""]).join(["some text", *parts, "end"])))
    check_licenses(spark, [*table, (900, None), (901, ""), (902, " .,"), (903, "UNDER the, MIT-License")])


def test_licenses_counted_at_every_place(spark):
    rows = check_licenses(spark, [(1, "CC BY-NC cc by nc by nc " * 3), (2, "a b a b a"), (2, "a b a b a")],
                          phrases=(*PHRASES, Notice("a b a", "aba")))
    assert {len(r.base) for r in rows if r.doc_id == 2} == {2}


def test_licenses_version_is_no_typing_error(spark):
    rows = check_licenses(spark, [(1, "GNU Generl Public Licence, version 3"), (2, "GNU General Public License, version 2.")])
    assert {r.doc_id: {p.label for p in r.places} for r in rows} == {1: {"gpl-3"}, 2: {"gpl-2"}}


def test_license_of_a_very_long_text_with_many_notices(spark):
    text = ("lorem ipsum " * 500 + "Licenced under the Apache License, Version 2.0. ") * 60
    rows = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(rows[0].base) == 60 and sum(p.label == "apache-2" for p in rows[0].places) == 60


def test_license_lists_are_checked(spark):
    for bad in (("Upper", "x", 0, ""), ("", "x", 0, ""), ("abc", "x", 3, ""), ("abc", "x", 0, "V.2")):
        with pytest.raises(ValueError):
            Notice(*bad)
    assert license_scan.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", max_size=60), st.integers(0, 3))
def test_search_equals_edit_distances_on_small_alphabets(text, errors):
    words = text.split()
    notices = (Notice("abca bc ab cab", "x", errors), Notice("bb cc", "y", min(errors, 2), "a"))
    _, places, score = license_scan.scan(text, license_scan.Search(notices))
    by_hand = notices_by_hand(words, notices)
    assert {p["notice"] for p in places} == set(by_hand)
    assert score == pytest.approx(max([0.0, *[1 - e / notices[k].length for k, e in by_hand.items()]]))


def test_registered_license_query_by_hand(spark):
    import os

    import __spark_entry__ as entry
    if not os.path.isdir(entry.SMOKE):
        pytest.skip("tables not present")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{entry.SMOKE}/documents.parquet").collect()}
    rows = entry.QUERIES["op13_license_scan"](spark, entry.SMOKE).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words = words_by_hand(docs[r.doc_id])
        base = base_of(words)
        labels = {label for _, label in base} | {NOTICES[k].label for k in notices_by_hand(words, NOTICES)}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None)
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert r.labels == ",".join(sorted(labels)) and json.dumps(r.score) and 0 <= r.score <= 1
