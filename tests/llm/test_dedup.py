"""Exact, near and substring deduplication against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendweave.llm import exact_dedup, near_dedup, suffix_dedup
from spendweave.llm.hashing import Substrings, shingles
from spendweave.llm.suffix_array import suffix_array

SCHEMA = "doc_id long, text string, keep_id string, row int, label string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "clash", 3, "x") for i, t in rows], SCHEMA)


def words(rng, n):
    return [f"w{k}" for k in rng.integers(0, 5000, n)]


# -- exact ----------------------------------------------------------------------------

def exact_by_hand(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    found = []
    for text, ids in groups.items():
        keep = min(ids, key=lambda i: (i is None, i))
        digest = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, keep, len(ids), digest) for i in ids]
    return sorted(found, key=repr)


@pytest.mark.parametrize("counters", [2, 256])
def test_exact_groups(spark, counters):
    rows = [(i, "hot  text") for i in range(40, 0, -1)] + [(100, "hot\ttext"), (3, "hot text"), (None, "hot text"),
            (200, None), (201, ""), (202, " "), (203, "\n\t"), (204, "a b"), (205, "a\u00a0b"), (None, "alone"),
            (7, "x" * 50_000)]
    found = exact_dedup.exact_duplicates(frame(spark, rows), counters=counters).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == exact_by_hand(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_drop_keeps_columns_and_one_row(spark):
    rows = [(1, "a b"), (1, "a  b"), (1, "a b"), (2, "a b"), (None, "c"), (None, "c"), (5, "d")]
    df = frame(spark, rows)
    left = exact_dedup.drop_exact_duplicates(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in left.collect() if r.doc_id) == [(False, 1), (False, 5)]
    assert left.filter("doc_id is null").count() == 1
    assert exact_dedup.exact_duplicates(df.limit(0)).count() == 0


def test_exact_is_native(spark):
    plan = exact_dedup.exact_duplicates(frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- near -----------------------------------------------------------------------------

def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return set()
    return {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))}


def near_by_hand(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                label[root(a)] = root(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(root(k), []).append(i)
    return sorted(((i, len(sets[k]), min(ids[root(k)], key=lambda x: (x is None, x)))
                   for k, (i, _) in enumerate(rows)), key=repr)


def near_rows(seed=0):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for base in range(6):
        original = words(rng, int(rng.integers(60, 200)))
        for copy in range(7):
            changed = list(original)
            for at in rng.integers(0, len(changed), copy):
                changed[at] = f"new{n}"
            rows.append((n * 3 % 97, " ".join(changed)))
            n += 1
        # a chain: each differs a little from the one before
        chain = list(original)
        for at in range(5):
            chain[10 * at:10 * at + 2] = [f"c{base}{at}", f"d{base}{at}"]
            rows.append((100 + n, " ".join(chain).upper()))
            n += 1
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE  two"), (505, "one two three four five"),
             (506, "one two three four five six"), (None, "one two"), (7, rows[0][1]), (7, rows[0][1]),
             (600, " ".join(words(rng, 30_000)))]
    return rows


def near(spark, rows):
    found = near_dedup.near_duplicates(frame(spark, rows)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)


@pytest.mark.parametrize("block", [near_dedup.BUCKET_BLOCK, 3])
def test_near_components(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", block)
    rows = near_rows()
    found = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert near(spark, rows) == near_by_hand(rows)
    assert sum(r.kept for r in found if r.n_shingles) == len({r.component_id for r in found if r.n_shingles})


def test_near_edges(spark):
    assert near_dedup.near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0
    df = frame(spark, [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "z"), (4, None), (5, None)])
    left = near_dedup.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5]


def test_odd_sketch_estimates_high_similarities():
    rng = np.random.default_rng(5)
    for share in (0.6, 0.75, 0.9, 0.97):
        errors = []
        for _ in range(20):
            union = rng.integers(0, 2**64, 2000, dtype="uint64")
            common, rest = int(2000 * share), 2000 - int(2000 * share)
            a, b = union[:common + rest // 2], np.concatenate([union[:common], union[common + rest // 2:]])
            level = max(near_dedup.level_of(len(x)) for x in (a, b))
            (n_a, x), (n_b, y) = (near_dedup.odd_sketch(s, level) for s in (a, b))
            differing = sum(int(w).bit_count() for w in (x ^ y).view("uint64"))
            errors.append(near_dedup.estimate(differing, n_a, n_b) - share)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.1


def test_odd_sketches_keep_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    rows = []
    for n, level in ((500, 0), (700, 0), (900, 0), (1024, 0), (1100, 1), (3000, 2)):
        together = n // 7 * 8                           # a and b lack an eighth each
        apart = together // 8
        for _ in range(2000):
            union = rng.integers(0, 2**64, together, dtype="uint64")
            (n_a, x), (n_b, y) = (near_dedup.odd_sketch(s, level) for s in (union[apart:], union[:together - apart]))
            rows.append((together - apart, level, n_a, n_b, *(x ^ y).tolist()))
    names = ["n_a", "at_a", "samples_a", "samples_b", *[f"w{k}_a" for k in near_dedup._WORDS]]
    pairs = spark.createDataFrame(pa.table(dict(zip(names, map(pa.array, zip(*rows)), strict=True)))).withColumns(
        {"n_b": F.col("n_a"), "own_a": F.col("at_a"), "own_b": F.col("at_a"),
         **{f"w{k}_b": F.lit(0).cast("long") for k in near_dedup._WORDS}})
    assert pairs.filter(near_dedup._not_ruled_out()).count() == len(rows)


def test_bands_find_pairs_at_the_threshold():
    same = (near_dedup.PERCENT / 100) ** near_dedup.BAND_ROWS
    assert (1 - same) ** near_dedup.BANDS < 1e-8


def test_words_that_a_polynomial_hash_confuses_stay_apart(spark):
    """Thue-Morse words collide under every polynomial modulo 2**64."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = one.translate({97: "b", 98: "a"})
    rows = [(1, one), (2, other), (3, f"x {one} y z w v"), (4, f"x {other} y z w v"), (5, one)]
    assert near(spark, rows) == near_by_hand(rows)
    assert not set(shingles(one)) & set(shingles(other))


@pytest.mark.parametrize("level", [0, 1, 3])
def test_block_pairs_equal_the_condition_pair_by_pair(level):
    rng = np.random.default_rng(level)
    sets, cls = [], []
    for k in range(40):
        n = int(near_dedup.SKETCH_SAMPLES * 2 ** level * rng.uniform(.6, 1.4)) if level else int(rng.integers(1, 900))
        base = np.random.default_rng(k % 5 + 100 * level).integers(0, 2**64, 2 * n, dtype="uint64")
        sets.append(np.unique(rng.choice(base, n, replace=False)))
        cls.append(k)
    own = [near_dedup.level_of(len(s)) for s in sets]
    sketch, thin = ([near_dedup.odd_sketch(s, v + more) for s, v in zip(sets, own, strict=True)] for more in (0, 1))
    component = rng.integers(0, 30, 40)
    group = {"cls": np.array(cls), "component": component, "size": np.array(list(map(len, sets))), "level": np.array(own),
             "samples": np.array([n for n, _ in sketch]), "sketch": np.stack([x for _, x in sketch]),
             "thinner_samples": np.array([n for n, _ in thin]), "thinner": np.stack([x for _, x in thin]),
             "block": np.array(cls) % 2, "lo": np.zeros(40, int), "hi": np.ones(40, int)}

    def open_pair(i, j):
        at = max(own[i], own[j])
        if abs(own[i] - own[j]) > 1 or component[i] == component[j] or 100 * min(len(sets[i]), len(sets[j])) < (
                near_dedup.PERCENT * max(len(sets[i]), len(sets[j]))):
            return False
        (n, x), (m, y) = ((sketch if own[k] == at else thin)[k] for k in (i, j))
        bounds = near_dedup.most_differing()[0 if at == 0 else 1]
        cell = (n + m) // near_dedup._CELL
        return int(np.bitwise_count(x ^ y).sum()) <= (bounds[cell] if cell < len(bounds) else near_dedup.SKETCH_BITS)

    found = set(zip(*(x.tolist() for x in near_dedup._block_pairs(group)), strict=True))
    assert found == {(min(i, j), max(i, j)) for i in range(0, 40, 2) for j in range(1, 40, 2) if open_pair(i, j)}
    one = {name: x[::2] for name, x in group.items()} | {"hi": np.zeros(20, int)}
    found = set(zip(*(x.tolist() for x in near_dedup._block_pairs(one)), strict=True))
    assert found == {(i, j) for i in range(0, 40, 2) for j in range(i + 2, 40, 2) if open_pair(i, j)}


def test_components_of_long_chains(spark):
    rng = np.random.default_rng(2)
    order = rng.permutation(60)
    links = [(int(a), int(b)) for a, b in zip(order[:29], order[1:30], strict=True)]
    links += [(int(a), int(order[30])) for a in order[31:]]
    df = spark.createDataFrame(links, "a long, b long")
    found = dict((r.node, r.component) for r in near_dedup.connected_components(df).collect())
    assert {found[int(x)] for x in order[:30]} == {int(min(order[:30]))}
    assert {found[int(x)] for x in order[30:]} == {int(min(order[30:]))}


# -- substrings -------------------------------------------------------------------------

def test_suffix_array_equals_sorting():
    rng = np.random.default_rng(0)
    for k in range(400):
        row = rng.integers(1, 2 + k % 5, int(rng.integers(1, 60)))
        row = np.append(np.tile(row[:7], 6) if k % 4 == 0 else row, 0)
        text = row.tolist()
        assert suffix_array(row).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_substring_hashes_depend_on_content_only():
    data = b"abcabcabc" * 3
    hashes = Substrings(data).windows(6)
    seen = {}
    for k, h in enumerate(hashes.tolist()):
        assert seen.setdefault(data[k:k + 6], h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(shingles("A b  c D e f")) == 2 and (shingles("a B c d E f") == shingles("A b  c D e f")).all()


def removed_by_hand(rows):
    seen, found = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (t or "").encode()
        marks = bytearray(len(data))
        for k in range(len(data) - 99):
            if data[k:k + 100] in seen:
                marks[k:k + 100] = b"\1" * 100
            seen.add(data[k:k + 100])
        kept = bytes(x for x, m in zip(data, marks, strict=True) if not m)
        runs = sum(1 for k, m in enumerate(marks) if m and (k == 0 or not marks[k - 1]))
        found.append((i, len(data), sum(marks), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def passage_rows():
    rng = np.random.default_rng(8)
    passage, other = " ".join(words(rng, 40)), " ".join(words(rng, 60))
    rows = []
    for k in range(30):
        cut = int(rng.integers(0, 30))
        rows.append((k * 7 % 31 + 1, " ".join(words(rng, 20)) + passage[cut:] + f" é{k} " + other[:100 + k]))
    rows += [(100, "ab" * 400), (101, "x" * 99), (102, "x" * 100), (103, "x" * 101), (104, "x" * 250), (105, None),
             (106, ""), (107, rows[0][1]), (108, rows[0][1]), (None, rows[1][1]), (109, "é" * 120),
             (110, other + " " + other), (111, "Ndnt " * 60 + passage)]
    return rows


@pytest.mark.parametrize("large", [suffix_dedup.LARGE_ANCHOR, 4])
def test_substrings_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE_ANCHOR", large)
    monkeypatch.setattr(suffix_dedup, "BLOCK_SEGMENTS", 40)
    rows = passage_rows()
    found = suffix_dedup.remove_repeated(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=repr) == (
        removed_by_hand(rows))


def test_substrings_of_repeated_rows_and_none(spark):
    rows = [(1, "q" * 10 + " ".join(f"v{k}" for k in range(60)))] * 3 + [(2, "short")]
    found = suffix_dedup.remove_repeated(frame(spark, rows)).collect()
    assert sorted(r.n_removed == r.n_bytes for r in found) == [False, False, True, True]
    assert suffix_dedup.remove_repeated(frame(spark, rows).limit(0)).count() == 0


def test_anchors_do_not_depend_on_the_surroundings(monkeypatch):
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 123, 3000).astype("uint8"))
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "_SPAN", 500)
    cut = suffix_dedup.anchors(data)

    def by_string(found):
        return {s: (h, a) for h, a, f, t in zip(*(x.tolist() for x in found), strict=True) for s in range(f, t + 1)}

    assert by_string(whole) == by_string(cut)
    assert sorted(by_string(whole)) == list(range(len(data) - 99))
