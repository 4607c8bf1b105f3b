"""Packing of token ids into training windows with bounded space.

Each partition keeps a fixed number of open windows. A document's full windows leave at
once; the rest goes into the open window it fits best. Where none fits, the fullest window
is topped up from the rest and emitted. What is open at the end is merged: within the
partition first, then over groups of partitions, each of which hands over less than one
window. The last tail of a group is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

from .bpe import load_ranks, vocabulary_path
from .common import text_of

#: A vocabulary, and the same as a file of ranks.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
WINDOW, OPEN_WINDOWS, END_ID = 1024, 16, 0
#: Partitions whose tails are merged by one task: at most so many windows of ids.
MERGED_PARTITIONS = 256
_MERGED = 1 << 61



class Tokens:
    """Texts to packed ids of a vocabulary of the ``tokenizers`` library, as it comes.

    The same vocabulary as a file of ranks gives the same ids in half the time with
    ``tiktoken`` (compared over all code points in the tests). Texts that hold an added token,
    which the first library reads as one, go through that one.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._library = Tokenizer.from_file(vocabulary_path(vocabulary))
        self._added = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            import public_tokenizers
            import tiktoken
            self._fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                           mergeable_ranks=load_ranks(ranks)).encode_ordinary

    def _encode(self, text: str) -> list[int]:
        if self._fast is None or any(a in text for a in self._added):
            return self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self._fast(text)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            yield array("I", self._encode(text)).tobytes()


@cache
def tokens(vocabulary: str, ranks: str | None) -> Tokens:
    return Tokens(vocabulary, ranks)


@dataclass
class Piece:
    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:length], self.doc_tokens),
                Piece(self.doc_id, self.start + length, self.ids[length:], self.doc_tokens))


@dataclass
class Packer:
    """Open windows of one partition; ``add`` and ``close`` yield windows, lists of pieces."""
    window: int = WINDOW
    most: int = OPEN_WINDOWS
    open: list[tuple[int, list[Piece]]] = field(default_factory=list)   # free room, pieces

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.window:
            full, piece = piece.cut(self.window)
            yield [full]
        while len(piece.ids):
            fits = [(free, k) for k, (free, _) in enumerate(self.open) if free >= len(piece.ids)]
            if fits:
                free, k = min(fits)                         # best fit
                self.open[k][1].append(piece)
                self.open[k] = (free - len(piece.ids), self.open[k][1])
                if not self.open[k][0]:
                    yield self.open.pop(k)[1]
                return
            if len(self.open) < self.most:
                self.open.append((self.window - len(piece.ids), [piece]))
                return
            k = min(range(len(self.open)), key=lambda k: self.open[k][0])   # the fullest
            free, pieces = self.open.pop(k)
            some, piece = piece.cut(free)
            yield [*pieces, some]

    def close(self) -> tuple[list[list[Piece]], list[Piece]]:
        """Full windows out of what is open, and the pieces of less than one window."""
        done, current, free = [], [], self.window
        for _, pieces in sorted(self.open, key=lambda w: w[0]):
            for piece in pieces:
                while len(piece.ids):
                    some, piece = piece.cut(min(free, len(piece.ids)))
                    current.append(some)
                    free -= len(some.ids)
                    if not free:
                        done.append(current)
                        current, free = [], self.window
        self.open = []
        return done, current


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Windows of decreasing powers of two that hold ``pieces`` without padding."""
    rest = sum(len(p.ids) for p in pieces)
    pieces = list(pieces)
    while rest:
        free = 1 << (rest.bit_length() - 1)
        rest -= free
        current = []
        while free:
            some, after = pieces[0].cut(min(free, len(pieces[0].ids)))
            current.append(some)
            free -= len(some.ids)
            pieces[:1] = [after] if len(after.ids) else []
        yield current


_FIELDS = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
           "merge_group long, merge_order long")


def _rows(window: list[Piece], sequence: int | None, group: int = -1, order: int = -1) -> list[tuple]:
    rows, offset = [], 0
    for p in window:
        rows.append((p.doc_id, p.start, len(p.ids), p.ids.tobytes(), p.doc_tokens, sequence, offset,
                     group, order))
        offset += len(p.ids)
    return rows


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = VOCABULARY,
         window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID,
         merged_partitions: int = MERGED_PARTITIONS, ranks: str | None = RANKS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its ids and ``end_id``; ``start`` counts its ids before the piece and
    ``ids`` are the piece's ids as little-endian 32-bit numbers. A sequence holds at most
    ``window`` ids, its pieces follow each other from offset 0. NULL and empty texts are
    documents of ``end_id`` alone. Repeated rows and repeated or NULL ids are packed like
    any others, long documents span windows, an empty table gives no pieces, other columns
    are dropped. A retried task packs its partition in the same order and so alike.

    ``ranks`` is the vocabulary as a file of ranks, None where there is none (slower).
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(f.split()[0] for f in _FIELDS.split(", "))]
    end = np.array([end_id], "<u4").tobytes()

    def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def partition(batches):
        part, number, packer, schema = TaskContext.get().partitionId(), 0, Packer(window, open_windows), None
        encode = tokens(vocabulary, ranks)
        for batch in batches:
            schema = schema or pa.schema([pa.field("doc_id", batch.schema.field(0).type), *(
                pa.field(n, pa.binary() if n == "ids" else pa.int64()) for n in names[1:])])
            rows = []
            for own, packed in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()),
                                   strict=True):
                ids = np.frombuffer(packed + end, "<u4")
                for full in packer.add(Piece(own, 0, ids, len(ids))):
                    rows += _rows(full, (part << 32) + number)
                    number += 1
            yield batch_of(rows, schema)
        if schema is not None:
            full, rest = packer.close()
            rows = [r for k, w in enumerate(full) for r in _rows(w, (part << 32) + number + k)]
            yield batch_of(rows + _rows(rest, None, part // merged_partitions, part), schema)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        base = _MERGED + (key[0].as_py() << 32)
        table = table.sort_by([("merge_order", "ascending"), ("offset", "ascending")])
        packer = Packer(window, 1, [(0, [
            Piece(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
            for r in table.to_pylist()])])
        full, rest = packer.close()
        rows = [r for k, w in enumerate([*full, *powers_of_two(rest)]) for r in _rows(w, base + k)]
        return pa.Table.from_batches([batch_of(rows, table.schema)])

    schema = f"doc_id {kind}, {_FIELDS}"
    packed = materialize(given.mapInArrow(partition, schema), "pieces")
    tails = (packed.filter("merge_group >= 0").groupBy("merge_group").applyInArrow(merge, schema))
    return packed.filter("merge_group < 0").unionByName(tails).drop("merge_group", "merge_order")
