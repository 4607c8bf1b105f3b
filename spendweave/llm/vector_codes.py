"""Vector codes by product quantization, with exact integer arithmetic.

Components become integers, vectors are cut into parts, and every part is replaced by the
index of the nearest entry of its position's codebook. The work is dot products of parts with
entries, and these are exact:

1. Limbs: an integer is a sum of limbs times powers of two, of so few bits that any sum of
   their products stays below 2**53. A product of two matrices of limbs in float64 (BLAS)
   is then an exact integer.
2. Recombination: the products of limbs are shifted and added in int64 (Python integers where
   the components are too large for that), which gives the dot product.
3. ``|x|**2 - 2 x c + |c|**2``, and the first least entry.

Codebooks are bounded (parts x entries x width of a part) and travel with the tasks; a round
brings back sums by part and entry, added up in each task first. Sums are kept by limbs as
well, so they cannot overflow however many rows there are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_LONG = 2**63 - 1
#: Bits of a limb of a sum, so that the sum of 2**43 rows fits in 64 bits.
_SUM_BITS = 20
#: Rows multiplied at once.
_ROWS = 4096


def limbs(values: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """``values`` (float64 integers) as ``count`` arrays, the k-th in units of 2**(bits k);
    all but the last lie in [0, 2**bits)."""
    parts, rest = [], values
    for _ in range(count - 1):
        high = np.floor(np.ldexp(rest, -bits))
        parts.append(rest - np.ldexp(high, bits))
        rest = high
    return [*parts, rest]


def limb_plan(width: int, largest: int) -> tuple[int, int]:
    """Bits of a limb and their number, for parts of ``width`` components up to ``largest``."""
    bits = (53 - max(1, width).bit_length()) // 2
    count = 1
    while largest >= 1 << (bits * count):
        count += 1
    return bits, count


def fits_int64(width: int, largest: int) -> bool:
    """Whether distances of such parts, and all numbers on the way, stay below 2**63."""
    return width * (2 * largest + 2) ** 2 < 2**63


def as_integers(values: np.ndarray, wide: bool) -> np.ndarray:
    """Integer-valued floats as int64, or as Python integers."""
    if not wide:
        return values.astype("int64")
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def dot_products(x: np.ndarray, entries: np.ndarray, largest: int) -> np.ndarray:
    """Exact dot products of rows of integer-valued floats: int64, or Python integers where
    these would overflow."""
    bits, count = limb_plan(x.shape[1], largest)
    wide = not fits_int64(x.shape[1], largest)
    left, right = limbs(x, bits, count), limbs(entries, bits, count)
    total = as_integers(np.zeros((len(x), len(entries))), wide)
    for j, a in enumerate(left):
        for k, b in enumerate(right):
            # each entry is below width * 2**(2 bits) <= 2**53, so the product is exact
            total += as_integers(a @ b.T, wide) * (1 << bits * (j + k))
    return total


@dataclass(frozen=True)
class Codebooks:
    """Entries by part (float64 integers: parts x entries x width) and the bound of their
    and all rows' components."""

    entries: np.ndarray
    largest: int

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance, by row and part."""
        parts, _, width = self.entries.shape
        wide = not fits_int64(width, self.largest)
        codes = np.zeros((len(rows), parts), "int64")
        errors = np.zeros((len(rows), parts), object if wide else "int64")
        cut = rows.reshape(len(rows), parts, width)
        for at in range(0, len(rows), _ROWS):
            here = slice(at, at + _ROWS)
            for p in range(parts):
                x, c = np.ascontiguousarray(cut[here, p]), self.entries[p]
                xs, cs = as_integers(x, wide), as_integers(c, wide)
                distance = ((xs * xs).sum(1)[:, None] - 2 * dot_products(x, c, self.largest)
                            + (cs * cs).sum(1)[None, :])
                code = distance.argmin(1)                  # the first of equal ones
                codes[here, p] = code
                errors[here, p] = distance[np.arange(len(x)), code]
        return codes, errors

    def digest(self) -> str:
        shown = ",".join(str(int(v)) for v in self.entries.ravel())
        return hashlib.sha256(shown.encode()).hexdigest()


def usable(column: Column, scale: int = SCALE) -> Column:
    """Whether a vector is there and has finite components only, scaled ones included."""
    return column.isNotNull() & F.coalesce(F.forall(column, lambda v: F.abs(v.cast("double") * scale)
                                                    < F.lit(float("inf"))), F.lit(False))


def _matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Scaled floors as rows of ``width``, short vectors filled up with zeros."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    rows = np.zeros((len(column), width))
    rows[np.arange(width) < lengths[:, None]] = np.floor(values * scale)
    return rows


def _given(vectors: DataFrame, vector: str, scale: int, **others: str) -> DataFrame:
    columns = [F.col(f"`{given}`").alias(name) for name, given in others.items()]
    return vectors.select(*columns, F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(
        usable(F.col("vector"), scale))


def _seeds(kept: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the first rows by id."""
    facts = kept.agg(F.max(F.size("vector")).alias("long"),
                     F.max(F.aggregate("vector", F.lit(0.0), lambda most, v: F.greatest(
                         most, F.abs(v * scale) + 1))).alias("most")).first()
    width = -(-(facts["long"] or 0) // parts)
    # id and vector only; each task hands over as many rows as there are entries
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    rows = _matrix(first.column("vector").combine_chunks(), parts * width, scale)
    return Codebooks(np.ascontiguousarray(rows.reshape(len(rows), parts, width).transpose(1, 0, 2)),
                     int(facts["most"] or 0))


def _sums(kept: DataFrame, books: Codebooks, scale: int) -> DataFrame:
    """``part, entry, n`` and sums of components by limb, of all rows assigned to an entry."""
    parts, entries, width = books.entries.shape
    count = 1
    while books.largest >= 1 << (_SUM_BITS * count):
        count += 1
    names = [f"s{k}" for k in range(count * width)]

    def run(batches):
        n = np.zeros((parts, entries), "int64")
        sums = np.zeros((parts, entries, count * width), "int64")
        for batch in batches:
            rows = _matrix(batch.column(0), parts * width, scale)
            for at in range(0, len(rows), _ROWS):
                some = rows[at:at + _ROWS]
                codes, _ = books.assign(some)
                cut = np.concatenate([x.reshape(len(some), parts, width) for x in limbs(some, _SUM_BITS, count)], 2)
                for p in range(parts):
                    chosen = np.zeros((len(some), entries))
                    chosen[np.arange(len(some)), codes[:, p]] = 1
                    n[p] += np.bincount(codes[:, p], minlength=entries)
                    sums[p] += (chosen.T @ cut[:, p]).astype("int64")
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype("int32")), pa.array(entry.astype("int32")), pa.array(n[part, entry]),
             *[pa.array(column) for column in sums[part, entry].T]], ["part", "entry", "n", *names])

    found = kept.select("vector").mapInArrow(run, "part int, entry int, n long" + "".join(
        f", {name} long" for name in names))
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])


def _moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Codebooks of the floors of the means; entries without rows stay."""
    width = books.entries.shape[2]
    entries = books.entries.copy()
    for row in sums.collect():                          # one for each entry at most
        part, entry, n, *limb = row
        whole = [sum(s << (_SUM_BITS * k) for k, s in enumerate(limb[w::width])) for w in range(width)]
        entries[part, entry] = [float(s // n) for s in whole]
    return Codebooks(entries, books.largest)


def fit(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", *, parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks fitted on all usable rows, from the rows of the least ids on.

    A mean is a floor of exact sums; the floor of a mean of float64 integers beyond 2**53 is
    rounded to the nearest float64, all else is exact. Rows that share an id go in the order
    of their vectors, those without one come last; without rows there are no entries.
    """
    kept = _given(vectors, vector, scale, vec_id=vec_id)
    books = _seeds(kept, parts, entries, scale)
    for _ in range(rounds):
        books = _moved(books, _sums(kept, books, scale))
    return books


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding", vec_id: str = "vec_id",
           label: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error`` of every usable row.

    ``code`` has two hexadecimal digits a part (so at most 256 entries); ``error`` is the
    squared distance over all parts, 2**63 - 1 where it is larger. Vectors that are NULL or
    hold NULL or non-finite components (or such as are not finite once scaled) have no row.
    Short ones, and lengths that the parts do not divide, are filled up with zeros; empty
    ones are all zeros. Repeated rows are coded alike; other columns are dropped.
    """
    parts, entries, width = books.entries.shape
    if entries > 256:
        raise ValueError("two digits hold 256 entries")
    given = _given(vectors, vector, scale, vec_id=vec_id, label=label)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:2]]

    def run(batches):
        for batch in batches:
            codes, errors = books.assign(_matrix(batch.column(2), parts * width, scale))
            shown = [row.tobytes().hex() for row in codes.astype("uint8")]
            error = [min(int(e), _LONG) for e in errors.sum(1)] if parts else [0] * len(shown)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(shown, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"])

    return given.mapInArrow(run, ", ".join([*kinds, "code string", "error long"]))


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``codes`` with ``approximation``, the entries that a code names (array of doubles, still
    scaled); NULL for a NULL code. A column of that name is replaced."""
    parts = books.entries.shape[0]
    kept = [c for c in codes.columns if c.lower() != "approximation"]
    given = codes.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{code}`").cast("string").alias("__code"))

    def run(batches):
        for batch in batches:
            shown = batch.column(len(kept)).to_pylist()
            index = np.array([list(bytes.fromhex(c or "00" * parts)) for c in shown], "int64").reshape(-1, parts)
            rows = books.entries[np.arange(parts), index].reshape(len(shown), -1)
            values = [None if c is None else r for c, r in zip(shown, rows.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(values, pa.list_(pa.float64()))], [*kept, "approximation"])

    schema = given.select(*[F.col(f"`{c}`") for c in kept],
                          F.lit(None).cast("array<double>").alias("approximation")).schema
    return given.mapInArrow(run, schema)


def vector_codes(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
                 **settings) -> tuple[DataFrame, Codebooks]:
    """:func:`fit` and :func:`encode`, with ``label_error``: the errors of all rows of the same
    label (NULL is one of its own) added up, 2**63 - 1 where that is larger. A label may
    hold most rows: its sum is one partial aggregate, and the join's side of sums is small
    or is split by adaptive execution."""
    books = fit(vectors, vector, vec_id, **settings)
    codes = materialize(encode(vectors, books, vector, vec_id, label, settings.get("scale", SCALE)), "vector-codes")
    sums = codes.groupBy(F.col("label").alias("__label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)"))
        .cast("long").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label"), books
