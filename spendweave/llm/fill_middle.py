"""Fill-in-middle texts by displacement scatter.

A text is cut twice; prefix, middle and suffix are put in another order with a marker before
each. Texts of a batch lie in one byte buffer, and no part is copied on its own:

1. Scan: the cuts, given in code points, become byte positions (bytes that do not continue a
   code point are counted by blocks).
2. Displacement: each part keeps its bytes together, so all of them move by one number. A
   difference array holds the change of that number where a part begins; its running sum is
   the shift of every byte, and one numpy scatter writes all outputs of the batch.
3. Back: the markers in an output give the lengths of its parts, hence the same displacement,
   and one gather at the shifted places reads the text again.

Scatter and gather run over blocks of the buffer with the running sum carried on, so memory
is the text, its output and a block, however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Of a hundred texts so many stay plain, and of the others so many have the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = "1"

#: Bytes of texts that are moved at once (a longer text goes alone), and bytes of a block.
GROUP_BYTES, BLOCK = 4 << 20, 1 << 16
_SCAN = 4096

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rule:
    """How texts are cut: numbers from a digest of seed and id, marks and shares."""

    seed: str = SEED
    markers: tuple[str, str, str] = MARKERS
    plain_percent: int = PLAIN_PERCENT
    spm_percent: int = SPM_PERCENT

    def __post_init__(self):
        # the marks are looked for in outputs; none may hide in or overlap another
        for mark in self.markers:
            if not mark or any(mark != other and mark in other for other in self.markers) or any(
                    mark[-k:] == other[:k] for other in self.markers for k in range(1, len(mark))):
                raise ValueError(f"marker {mark!r} is empty or overlaps another")
        if len(set(self.markers)) < 3:
            raise ValueError("three different markers are needed")

    def draws(self, doc_id) -> tuple[int, int, int, int]:
        shown = "" if doc_id is None else str(doc_id)
        digest = hashlib.sha256(f"{self.seed}:{shown}".encode()).hexdigest()
        return tuple(int(digest[8 * k:8 * k + 8], 16) for k in range(4))


def count_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of each range of a UTF-8 buffer."""
    at = _Points(data)
    return at.before(ends) - at.before(starts)


class _Points:
    """Positions of code points in a UTF-8 buffer, by counts of blocks of ``_SCAN`` bytes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        blocks = range(0, len(data), _SCAN)
        self.counts = np.zeros(len(blocks) + 1, "int64")
        np.cumsum([np.count_nonzero(self._first(at)) for at in blocks], out=self.counts[1:])

    def _first(self, at: int) -> np.ndarray:
        return (self.data[at:at + _SCAN] & 0xC0) != 0x80

    def before(self, places: np.ndarray) -> np.ndarray:
        """Code points that begin before each byte position."""
        return np.array([self.counts[p // _SCAN] + np.count_nonzero(self._first(p - p % _SCAN)[:p % _SCAN])
                         for p in places], "int64")

    def place(self, points: np.ndarray) -> np.ndarray:
        """Byte position of each code point, counted over the buffer; past the last, its end."""
        blocks = np.searchsorted(self.counts, points, "right") - 1
        return np.array([len(self.data) if b + 1 >= len(self.counts) else
                         b * _SCAN + np.flatnonzero(self._first(b * _SCAN))[p - self.counts[b]]
                         for b, p in zip(blocks, points, strict=True)], "int64")


def shifted(n: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks ``(first byte, target of each byte)`` of a buffer of n bytes, of which the byte
    ranges that begin at ``starts`` (ascending) move by ``shifts``."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        first, last = np.searchsorted(starts, (lo, hi))
        difference = np.zeros(hi - lo, "int64")
        np.add.at(difference, starts[first:last] - lo, change[first:last])   # empty ranges share a start
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = shift[-1]
        yield lo, shift + np.arange(lo, hi)


def _layout(lengths: np.ndarray, forms: Sequence[str], marks: Sequence[bytes]):
    """Where parts and marks stand in the outputs.

    ``lengths`` holds prefix, middle and suffix of each text in bytes. Returns the place of
    each part (same shape), (place, mark) of all marks and the ends of the outputs.
    """
    width = np.array([len(m) for m in marks])          # prefix, suffix, middle
    plain, spm = np.array([f == PLAIN for f in forms]), np.array([f == SPM for f in forms])
    sizes = lengths.sum(1) + np.where(plain, 0, width.sum())
    ends = np.cumsum(sizes)
    start = ends - sizes
    prefix, middle, suffix = lengths.T
    at = np.empty_like(lengths)
    at[:, 0] = start + np.where(plain, 0, np.where(spm, width[1] + suffix + width[0], width[0]))
    at[:, 2] = start + np.where(spm, width[1], width[0] + prefix + width[1])
    at[:, 1] = start + np.where(plain, prefix, prefix + suffix + width.sum())
    at[plain, 2] = (start + prefix + middle)[plain]
    places = [(at[~plain, column] - w, m) for column, w, m in zip((0, 2, 1), width, marks, strict=True)]
    return at, places, ends


def _moves(lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum(lengths.ravel()) - lengths.ravel()
    return starts, at.ravel() - starts


def reorder(data: np.ndarray, lengths: np.ndarray, forms: Sequence[str],
            marks: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of texts that lie one after the other in ``data``, and their ends."""
    at, places, ends = _layout(lengths, forms, marks)
    out = np.empty(ends[-1] if len(ends) else 0, "uint8")
    for place, mark in places:
        out[place[:, None] + np.arange(len(mark))] = np.frombuffer(mark, "uint8")
    for lo, target in shifted(len(data), *_moves(lengths, at)):
        out[target] = data[lo:lo + len(target)]
    return out, ends


def recover(out: np.ndarray, ends: np.ndarray, forms: Sequence[str],
            marks: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts from outputs that lie one after the other, and their ends."""
    whole = out.tobytes()
    lengths = np.zeros((len(ends), 3), "int64")
    for i, form in enumerate(forms):
        start, end = (int(ends[i - 1]) if i else 0), int(ends[i])
        if form == PLAIN:
            lengths[i] = end - start, 0, 0
            continue
        p, s, m = marks
        first, second = (s, p) if form == SPM else (p, s)
        between = whole.find(second, start, end)
        last = whole.find(m, between, end)
        if not whole.startswith(first, start, end) or between < 0 or last < 0:
            raise ValueError(f"output {i} is not of form {form}")
        a, b = between - start - len(first), last - between - len(second)
        lengths[i] = (b, end - last - len(m), a) if form == SPM else (a, end - last - len(m), b)
    at, _, _ = _layout(lengths, forms, marks)
    sizes = lengths.sum(1)
    data = np.empty(int(sizes.sum()), "uint8")
    for lo, source in shifted(len(data), *_moves(lengths, at)):
        data[lo:lo + len(source)] = out[source]
    return data, np.cumsum(sizes)


def _groups(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``GROUP_BYTES``, or one row."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > GROUP_BYTES:
            yield first, i
            first, total = i, 0
        total += size
    if len(sizes) > first:
        yield first, len(sizes)


def _buffers(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A binary column by groups of rows: first, last, their bytes and the ends in them."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], "int32", len(column) + 1, 4 * column.offset).astype("int64")
    held = column.buffers()[2]
    data = np.frombuffer(held, "uint8") if held is not None else np.zeros(0, "uint8")
    for first, last in _groups(np.diff(offsets)):
        yield first, last, data[offsets[first]:offsets[last]], offsets[first + 1:last + 1] - offsets[first]


def cut(data: np.ndarray, ends: np.ndarray, ids: Sequence, rule: Rule):
    """Form, code points (n, prefix, middle) and byte lengths of the parts of each text."""
    starts = np.append(0, ends[:-1])
    at = _Points(data)
    base = at.before(starts)
    n = at.before(ends) - base
    draws = np.array([rule.draws(i) for i in ids], "int64").reshape(-1, 4)
    lo = np.minimum(draws[:, 0] % (n + 1), draws[:, 1] % (n + 1))
    hi = np.maximum(draws[:, 0] % (n + 1), draws[:, 1] % (n + 1))
    marks, whole = [m.encode() for m in rule.markers], data.tobytes()
    marked = [any(whole.find(m, a, b) >= 0 for m in marks)
              for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    plain = (n == 0) | np.array(marked, bool) | (draws[:, 2] % 100 >= 100 - rule.plain_percent)
    forms = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < rule.spm_percent, SPM, PSM))
    lo, hi = np.where(plain, 0, lo), np.where(plain, 0, hi)
    first, second = (np.where(points == n, ends, at.place(base + points)) for points in (lo, hi))
    lengths = np.stack([first - starts, second - first, ends - second], 1)
    return forms.tolist(), n, lo, hi - lo, lengths


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   rule: Rule = Rule()) -> DataFrame:
    """One row per input row: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts code points; ``form`` is ``plain`` (the text itself), ``psm`` or ``spm``;
    ``output`` is text. NULL and empty texts are plain and empty, as are texts that hold a
    marker plain; the parts of plain texts are NULL. A NULL id draws as an empty one; rows
    that repeat an id are cut alike if their texts are; an empty table stays empty; other
    columns are dropped, whatever their names.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("bytes"))
    kind = given.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        marks = [m.encode() for m in rule.markers]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, last, data, ends in _buffers(batch.column(1)):
                forms, n, prefix, middle, lengths = cut(data, ends, ids[first:last], rule)
                out, places = reorder(data, lengths, forms, marks)
                plain = np.array([f == PLAIN for f in forms])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(n), pa.array(forms),
                    pa.array(prefix, mask=plain), pa.array(middle, mask=plain),
                    _binary(out, places)], names)

    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary"
    return given.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.append(0, ends).astype("int32")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def restore(outputs: DataFrame, rule: Rule = Rule(), output: str = "output", form: str = "form") -> DataFrame:
    """``outputs`` with ``restored``, the text that an output was made of, from the output and
    its form alone. A column of that name is replaced; a NULL output is read as empty, a NULL
    form as plain; an output that is not of its form fails."""
    kept = [c for c in outputs.columns if c.lower() != "restored"]
    given = outputs.select(*[F.col(f"`{c}`") for c in kept],
                           F.coalesce(F.col(output).cast("string"), F.lit("")).cast("binary").alias("__out"),
                           F.coalesce(F.col(form), F.lit(PLAIN)).alias("__form"))

    def run(batches):
        marks = [m.encode() for m in rule.markers]
        for batch in batches:
            forms = batch.column(len(kept) + 1).to_pylist()
            for first, last, out, ends in _buffers(batch.column(len(kept))):
                data, places = recover(out, ends, forms[first:last], marks)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(first, last - first) for c in batch.columns[:len(kept)]], _binary(data, places)],
                    [*kept, "restored"])

    schema = given.select(*[F.col(f"`{c}`") for c in kept], F.col("__out").alias("restored")).schema
    return given.mapInArrow(run, schema).withColumn("restored", F.col("restored").cast("string"))
