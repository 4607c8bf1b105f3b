"""The registered queries on the smallest tables, against their SQL or by hand."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import connect, difference
from spendweave.llm import bpe, packing, pii, wordpiece
from spendweave.llm.common import ORACLE, QUERIES
from spendweave.session import materialize

from .test_dedup import near_by_hand, removed_by_hand
from .test_text import base_by_hand, measured_by_hand

FOLDER = entry.SMOKE
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def texts():
    rows = connect(FOLDER).execute("select doc_id, text from documents order by doc_id").fetchall()
    return dict(rows)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES if name != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", ORACLE)
def test_equals_its_sql(spark, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    assert difference(found, connect(FOLDER).execute(ORACLE[name]).df()) is None


def test_op1_by_hand(spark, texts):
    found = QUERIES["op1_suffix_dedup"](spark, FOLDER).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=repr) == (
        removed_by_hand(list(texts.items())))


def test_op2_by_hand(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op2_personal_data"](spark, FOLDER).collect()}
    assert set(found) == set(texts)
    for i, text in texts.items():
        spans = base_by_hand(text)
        shown = ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)
        assert found[i].base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(filter(None, shown.split(","))) <= set(found[i].spans.split(","))
        assert [found[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in spans) for k in pii.KINDS]


def test_op8_by_hand(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, FOLDER).collect()}
    assert set(found) == set(texts)
    for i, text in texts.items():
        n_words, chars, symbols, lines, repeated = measured_by_hand(text)
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            n_words, chars, symbols, lines, repeated)
        assert r.base_failed == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert not (r.base_failed and r.kept)


def test_op3_by_hand(spark, texts):
    """Each id of the tokenizers library in exactly one piece, sequences gapless and short of
    1024 at a power of two only."""
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(packing.vocabulary_path(packing.VOCABULARY))
    docs, sequences = {}, {}
    for r in QUERIES["op3_packing"](spark, FOLDER).collect():
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for i, text in texts.items():
        ids, at = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    short = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0
        short += at < 1024
    assert short <= 11                      # one tail of a group, cut into powers of two


def test_op6_by_hand(spark, texts):
    import public_tokenizers
    import tiktoken
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.VOCABULARY),
                            special_tokens={})
    rows = QUERIES["op6_byte_bpe"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op9_by_hand(spark, texts):
    tokens = set(bpe.load_ranks(wordpiece.VOCABULARY))
    longest, known = max(map(len, tokens)), {}

    def pieces(word):
        if word not in known:
            at, n = 0, 0
            while at < len(word):
                at = next(e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in tokens)
                n += 1
            known[word] = n
        return known[word]

    rows = QUERIES["op9_token_counts"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        words = (texts[r.doc_id] or "").encode().split()
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(pieces(b" " + w) for w in words), 0)


def test_pipeline_by_hand(spark, texts):
    """Few labels prove no cutoff, so the base rules alone reject here."""
    from tokenizers import Tokenizer
    kept = {}
    for i, text in texts.items():
        n_words, _, _, _, repeated = measured_by_hand(text)
        if n_words >= 50 and 100 * repeated <= 50 * n_words:
            kept[i] = text
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i]), i)
    distinct = [(i, kept[i]) for i in sorted(first.values())]
    survivors = {i: dict(distinct)[i] for i, _, component in near_by_hand(distinct) if i == component}
    masked = {i: pii.masked(t, base_by_hand(t)) for i, t in survivors.items()}

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, expected = docs.columns, [set(kept), set(first.values()), set(survivors), set(survivors)]
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        docs = materialize(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} == ids, name
    assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {
        i: (t, len(t)) if t != survivors[i] else (t, len(survivors[i])) for i, t in masked.items()}

    own = Tokenizer.from_file(packing.vocabulary_path(packing.VOCABULARY))
    found = {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        found.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert {i: b"".join(ids for _, ids in sorted(pieces)) for i, pieces in found.items()} == {
        i: np.array(own.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes() for i, t in masked.items()}
