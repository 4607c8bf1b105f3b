"""Byte-level byte-pair encoding with a segment tree, and decoding.

A piece of text is a row of bytes. The leaf of position ``i`` holds the rank of the token
that begins at ``i`` joined with its live right neighbour; the root is the leftmost minimum.
A merge changes the leaves of the position, of its left neighbour and of the swallowed one,
each in logarithmic time, so a piece of n bytes takes O(n log n) however long it is. The ranks
of a short piece, a word as a rule, are a list that is searched as a whole, which is faster there.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .pieces import Remembered, chunks

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_NONE = 1 << 62
#: Bytes up to which the ranks of a piece are a list.
SHORT = 48


def vocabulary_path(name_or_path: str) -> str:
    """A file of the public tokenizers by name; anything with a slash is a path."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers
    return public_tokenizers.path(name_or_path)


@cache
def load_ranks(name_or_path: str) -> dict[bytes, int]:
    with open(vocabulary_path(name_or_path), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a short piece: the leftmost minimum is searched in all ranks."""
    get, n = ranks.get, len(piece)
    cuts = list(range(n + 1))
    costs = [get(piece[i:i + 2], _NONE) for i in range(n - 1)]
    while costs and (low := min(costs)) != _NONE:
        i = costs.index(low)
        del cuts[i + 1], costs[i]
        if i < len(costs):
            costs[i] = get(piece[cuts[i]:cuts[i + 2]], _NONE)
        if i:
            costs[i - 1] = get(piece[cuts[i - 1]:cuts[i + 1]], _NONE)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    if (known := ranks.get(piece)) is not None:
        return [known]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    if n <= SHORT:
        return _merge_short(piece, ranks)
    width = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * width)            # leaf i at width + i: rank * width + i
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    for i in range(n - 1):
        if (rank := ranks.get(piece[i:i + 2])) is not None:
            tree[width + i] = rank * width + i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left < right else right
            if tree[node] == low:
                return
            tree[node] = low
            node >>= 1

    def pair(i: int) -> int:
        j = after[i]
        if j >= n:
            return _NONE
        rank = ranks.get(piece[i:after[j]])
        return _NONE if rank is None else rank * width + i

    while tree[1] != _NONE:
        i = tree[1] % width
        j = after[i]                        # swallowed
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        put(j, _NONE)
        put(i, pair(i))
        if (h := before[i]) >= 0:
            put(h, pair(h))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class Encoder:
    """Texts to packed little-endian 32-bit ids."""

    def __init__(self, name_or_path: str, pattern: str | None = None):
        import regex
        if pattern is None:
            import public_tokenizers
            pattern = public_tokenizers.PATTERN
        ranks = load_ranks(name_or_path)
        split = regex.compile(pattern).findall
        of_piece = Remembered(lambda p: np.array(merge(p.encode(), ranks), "<u4").tobytes())
        self._whole = lambda text: b"".join([of_piece[p] for p in split(text)])
        self._chunk = Remembered(lambda chunk: self._whole(" " + chunk))

    def __call__(self, text: str) -> bytes:
        head, rest = chunks(text)
        return self._whole(head) + b"".join(map(self._chunk.__getitem__, rest))


@cache
def encoder(name_or_path: str, pattern: str | None) -> Encoder:
    return Encoder(name_or_path, pattern)


def id_lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as an Arrow array of lists."""
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype="int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encode(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
           vocabulary: str = VOCABULARY, pattern: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array of int), without special tokens.

    ``vocabulary`` is a rank file: a name of the public tokenizers or a path that every
    executor has. NULL and empty texts have no ids; ids of repeated rows are equal; NULL
    ``doc_id`` is kept; an empty table stays empty; other columns are dropped. Pieces of any
    length are encoded whole.
    """
    def run(batches):
        find = encoder(vocabulary, pattern)
        for batch in batches:
            packed = [find(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), id_lists(packed)], ["doc_id", "ids"])

    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ids: str = "ids", into: str = "decoded",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, in column ``into`` (replaced if
    present). NULL ids decode to NULL, no ids to no bytes; an id outside the vocabulary is
    an error."""
    rest = [name for name in encoded.columns if name != into]

    def run(batches):
        token = {rank: text for text, rank in load_ranks(vocabulary).items()}.__getitem__
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            found = [b"".join(map(token, flat[a:b].tolist())) if ok else None
                     for a, b, ok in zip(ends[:-1], ends[1:], lists.is_valid().to_pylist(),
                                         strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, into])

    given = encoded.select(*rest)
    return given.mapInArrow(run, given.withColumn(into, F.lit(b"")).schema)
