"""Byte-pair encoding, word-piece counts and packing against the libraries and brute force."""

import base64
import zlib

import numpy as np
import pytest

from spendweave.llm import bpe, packing, wordpiece

P = pytest.importorskip("public_tokenizers")

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "a \n  b\n", "\n\n x", "don't we'll",
       "ab" * 3000, "é" * 700 + "x", "日本語 テキスト 123 ４５", "a  b  c", "x\x85 y\x1c z", "tab\t\tend\t",
       "aaaa aaaaaaaaa!!!! 12345678901234567890", "<|endoftext|> x", "  two", "mid  two \n\n\n three   "]


def frame(spark, texts):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, sequence_id int")


@pytest.fixture(scope="module")
def library():
    import tiktoken
    with open(P.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def real(spark):
    return [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("text").collect()]


def test_bpe_equals_the_library_and_decodes(spark, library):
    texts = ODD + real(spark)
    df = frame(spark, texts)
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(df)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i].ids == library.encode_ordinary(text), text[:50]
        assert bytes(found[i].decoded) == text.encode()


def test_short_pieces_are_merged_without_a_tree(monkeypatch):
    ranks = bpe.load_ranks(bpe.VOCABULARY)
    pick = np.random.default_rng(3)
    pieces = [bytes(pick.choice(list(b"aabbtheins \xc3\xa9 0"), n)) for n in pick.integers(0, bpe.SHORT + 1, 500)]
    short = [bpe.merge(piece, ranks) for piece in pieces]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert short == [bpe.merge(piece, ranks) for piece in pieces]


def test_bpe_of_null_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(None, None), (1, "b a"), (1, "b a")], "doc_id long, text string")
    rows = bpe.encode(df).collect()
    assert [r.doc_id for r in rows] == [None, 1, 1]
    assert rows[0].ids == [] and rows[1].ids == rows[2].ids
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0


def longest_match(word, tokens):
    at, count = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in tokens), None)
        if end is None:
            return -1
        at, count = end, count + 1
    return count


def test_word_pieces_equal_greedy_matching():
    tokens = {b" a", b"ab", b"abc", b"abcd", b"b", b"c", b"bcx", b"d", b"x", b" ", b" abcde", b"a"}
    match = wordpiece.LongestMatch(tokens)
    rng = np.random.default_rng(3)
    for size in range(1, 9):
        for _ in range(300):
            word = b" " + bytes(rng.choice(list(b"abcdxe"), size))
            assert match(word) == longest_match(word, tokens), word


def test_word_piece_counts_on_documents(spark):
    texts = ODD + real(spark)[:60] + [None]
    tokens = set(bpe.load_ranks(wordpiece.VOCABULARY))
    for r in wordpiece.count_tokens(frame(spark, texts)).collect():
        words = (texts[r.doc_id] or "").encode().split()
        small = [w for w in words if len(w) < 200]
        expected = sum(longest_match(b" " + w, tokens) for w in small)
        assert r.n_words == len(words) and r.n_unknown == 0
        if len(small) == len(words):
            assert r.n_tokens == expected
    assert wordpiece.count_tokens(frame(spark, ["x"]).limit(0)).count() == 0


def test_packing_holds_every_id_once(spark):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path(packing.VOCABULARY))
    texts = ODD + real(spark) + [None, None, "<|endoftext|> x", "a <|endoftext|>b c d", "a <|endoftext |> b"]
    df = frame(spark, texts).repartition(7)
    rows = packing.pack(df, merged_partitions=3).collect()
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == zlib.crc32(bytes(r.ids))
            at += r.length
        assert at == len(ids)
    odd = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0
        odd += at < 1024
    assert odd <= 30
    assert packing.pack(df.limit(0)).count() == 0


def test_blanks_beside_other_white_space(library):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path(packing.VOCABULARY))
    texts = ["x \xa0 \xa0 y", "Prix : 5 \xa0 \xa0 \xa0 \xa0 Total", "a\t b", "a \tb", "a\n b", "a \n b", "\xa0 a", "a \xa0",
             " \n", "\n ", " \u3000 x", "a\u2028 b c", "\r \n \t x y"]
    for mark in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2003\u2029\u202f\u205f\u3000\u200b\ufeff":
        texts += [f"x {mark} {mark} y", f"x{mark} y", f"x {mark}y z", f"{mark} {mark}"]
    encoded = packing.Tokens(packing.VOCABULARY, packing.RANKS)(texts)
    for text, ids in zip(texts, encoded, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, text
    encode = bpe.encoder(bpe.VOCABULARY, None)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode_ordinary(text), text


def test_packing_keeps_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (2, None)], "doc_id long, text string")
    rows = packing.pack(df).collect()
    assert sum(r.length for r in rows if r.doc_id is None) == 6
    assert [r.length for r in rows if r.doc_id == 2] == [1]


def test_ranks_give_the_ids_of_the_vocabulary():
    """Every assigned code point beside letters, digits and blanks, and texts with an added token."""
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path(packing.VOCABULARY))
    encode = packing.Tokens(packing.VOCABULARY, packing.RANKS)
    points = [c for c in (*range(0x32400), *range(0xE0000, 0xE0200)) if not 0xD800 <= c < 0xE000]    # all assigned planes
    for at in range(0, len(points), 50_000):
        texts = [f"a{chr(c)} {chr(c)}b 1{chr(c)}'{chr(c)}" for c in points[at:at + 50_000]]
        known = own.encode_batch_fast(texts, add_special_tokens=False)
        assert all(np.frombuffer(ids, "<u4").tolist() == e.ids for ids, e in zip(encode(texts), known, strict=True))
    odd = ["<|endoftext|>", "x<|endoftext|>y", " <|endoftext|> ", "<|endoftext|", "ab" * 5000, " " * 3000, ""]
    slow = packing.Tokens(packing.VOCABULARY, None)
    for text, ids, same in zip(odd, encode(odd), slow(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids
        assert ids == same


def test_packer_fits_best_and_gives_up_the_fullest():
    packer = packing.Packer(window=10, most=2)

    def add(length):
        return [[len(p.ids) for p in w] for w in packer.add(packing.Piece(0, 0, np.zeros(length, "u4"), length))]

    assert add(6) == [] and add(8) == []            # two windows with 4 and 2 free
    assert add(2) == [[8, 2]]                       # best fit, full at once
    assert add(7) == [] and len(packer.open) == 2   # 4 and 3 free
    assert add(5) == [[7, 3]]                       # none fits: the fullest is topped up
    assert len(packer.open) == 1 and add(23) == [[10], [10]] and len(packer.open) == 2
    done, rest = packer.close()
    assert all(sum(len(p.ids) for p in w) == 10 for w in done) and sum(len(p.ids) for p in rest) < 10


@pytest.mark.parametrize("total", [1, 2, 7, 1023])
def test_tails_become_powers_of_two(total):
    pieces = [packing.Piece(k, 0, np.full(n, k, "u4"), n) for k, n in enumerate((total // 3, total - total // 3)) if n]
    windows = list(packing.powers_of_two(pieces))
    sizes = [sum(len(p.ids) for p in w) for w in windows]
    assert sum(sizes) == total and sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes)
    assert all(s & (s - 1) == 0 for s in sizes)
    assert np.concatenate([p.ids for w in windows for p in w]).tolist() == np.concatenate([p.ids for p in pieces]).tolist()


def test_word_piece_counts_of_repeated_rows_and_missing_ids(spark):
    df = spark.createDataFrame([(None, "some words"), (1, "some words"), (1, "some words"), (None, None)],
                               "doc_id long, text string")
    rows = wordpiece.count_tokens(df).collect()
    assert sorted((r.doc_id is None, r.n_words) for r in rows) == [(False, 2), (False, 2), (True, 0), (True, 2)]
    assert len({r.n_tokens for r in rows if r.n_words}) == 1


def test_decoded_replaces_a_column_of_its_name(spark):
    df = spark.createDataFrame([(1, "a b", "old")], "doc_id long, text string, decoded string")
    coded = bpe.encode(df)
    again = bpe.decode(coded.withColumn("decoded", coded["doc_id"]))
    assert again.columns.count("decoded") == 1 and bytes(again.first().decoded) == b"a b"
