"""Near-duplicates by MinHash bands, odd sketches and exact confirmation.

1. Each whole text becomes its set of word shingles. Texts with equal sets form a class, one
   node of the graph however many copies there are.
2. MinHash samples are grouped into bands; classes that agree in a band share a bucket.
3. Odd sketches: the hashes of a set below a threshold are samples of it by their least
   values; they are folded into a bitmap of parities. The number of bits in which two
   bitmaps differ gives the size of the symmetric difference of the samples, and with the
   sizes the similarity (at 1024 samples with a standard deviation of 0.012, or 0.018 where
   the samples are a part of the sets). Only candidate pairs that the sketch cannot rule out
   are confirmed on the full sets.
4. In each bucket the class with the most company is compared with the others (as many
   pairs as entries). Only buckets that still hold several components go on: their pairs
   across components are compared, which is what a link between components needs. A bucket
   is cut into blocks and its pairs of blocks are dealt out, so no task has more than the
   product of two blocks, however large the bucket.
5. Connected components by alternating large-star and small-star steps.

With 196 samples in 49 bands of four, a pair of similarity 0.75 shares no band with
probability 8e-9; the sketch rules out such a pair with a probability below 1e-7, by the
distribution of the differing bits. Buckets and groups have no caps.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

from .common import text_of
from .hashing import mix, shingles

SHINGLE_WORDS, PERCENT = 5, 75
BANDS, BAND_ROWS = 49, 4
SAMPLES = BANDS * BAND_ROWS
#: Bits of an odd sketch, and samples that it is meant for: larger sets are thinned out by
#: powers of two until so many are left.
SKETCH_BITS, SKETCH_SAMPLES = 1024, 1024
#: Probability with which two sets at the threshold may differ in more bits than allowed.
MISS = 1e-7
#: Entries of a block of an open bucket, as a rule.
BUCKET_BLOCK = 512
#: Keys up to which a lookup is broadcast (some 60 bytes each); beyond, it is shuffled.
BROADCAST_KEYS = 400_000

_FACTORS = mix(np.arange(1, SAMPLES + 1, dtype="uint64")) | np.uint64(1)
_BLOCK = 4096
#: (1 + J) / (1 - J) at the threshold: samples of both sets for one that differs.
_CELL = (100 + PERCENT) // (100 - PERCENT)


def samples(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set of mixed 64-bit hashes."""
    least = np.full(SAMPLES, np.uint64(2**64 - 1))
    for at in range(0, len(hashes), _BLOCK):
        np.minimum(least, (_FACTORS[:, None] * hashes[None, at:at + _BLOCK]).min(1), out=least)
    return least


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of samples."""
    parts = rows.reshape(len(rows), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype="uint64"), parts.shape[:2])
    for k in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def level_of(n: int) -> int:
    """How often a set of n is halved for its sketch."""
    return max(0, (n - 1) // SKETCH_SAMPLES).bit_length()


def odd_sketch(hashes: np.ndarray, level: int) -> tuple[int, np.ndarray]:
    """Samples of a set at a level (hashes below 2**64 / 2**level), their number and the
    bitmap of parities as 64-bit words."""
    if level:
        hashes = hashes[hashes < np.uint64(1 << (64 - level))]
    bits = (mix(hashes) % np.uint64(SKETCH_BITS)).astype("int64")
    odd = (np.bincount(bits, minlength=SKETCH_BITS) & 1).astype("uint8")
    return len(hashes), np.packbits(odd).view("int64")


def estimate(differing: float, samples_a: int, samples_b: int, bits: int = SKETCH_BITS) -> float:
    """Similarity estimated from the number of differing bits of two odd sketches."""
    if 2 * differing >= bits:
        return 0.0
    apart = -bits / 2 * math.log1p(-2 * differing / bits)
    return max(0.0, (samples_a + samples_b - apart) / (samples_a + samples_b + apart))


@cache
def most_differing() -> tuple[list[int], list[int]]:
    """Bits in which the sketches of sets at the threshold differ at most, but for MISS, by
    the samples of both over ``_CELL``: for sets sketched whole and for thinned ones.

    Sets of together s samples that are whole differ in s (1 - J) / (1 + J) elements at most.
    Of thinned ones, each of the m samples in the union is one of the difference with
    probability 1 - J; s = 2 m - the differing ones.
    """
    cells, far = 2 * SKETCH_SAMPLES * 3 // 2 // _CELL, SKETCH_SAMPLES
    bits, at = np.arange(SKETCH_BITS + 1), np.eye(1, SKETCH_BITS + 1)[0]
    odd = [at]                                       # odd bits after so many elements
    for _ in range(far):
        up, down = at * (SKETCH_BITS - bits) / SKETCH_BITS, at * bits / SKETCH_BITS
        at = np.append(down[1:], 0) + np.append(0, up[:-1])
        odd.append(at)
    odd = np.array(odd)

    def cut(chances: np.ndarray) -> np.ndarray:      # the least bound that is passed by MISS
        above = chances[..., ::-1].cumsum(-1)[..., ::-1] - chances
        return np.maximum.accumulate((above > MISS).sum(-1))

    logs = np.append(0, np.log(np.arange(1, 2 * _CELL * cells)).cumsum())
    thinned = np.zeros((cells, SKETCH_BITS + 1))
    worst = np.zeros(cells, int)
    for odd_one in (1, 2):                           # the two largest sums of a cell
        for cell in range(cells):
            s = _CELL * (cell + 1) - odd_one
            d = np.arange(s % 2, min(s, far) + 1, 2)
            m = (s + d) // 2
            weight = np.exp(logs[m] - logs[d] - logs[m - d] + d * math.log(1 - PERCENT / 100)
                            + (m - d) * math.log(PERCENT / 100))
            thinned[cell] = weight @ odd[d] / weight.sum()
        worst = np.maximum(worst, cut(thinned))
    return cut(odd[:2 * SKETCH_SAMPLES // _CELL + 1]).tolist(), worst.tolist()


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype="int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, row, text_key, n_shingles, digest, bands``, one row per input row."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        F.md5(text_of(text).cast("binary")).alias("text_key"), text_of(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sets = [shingles(t, SHINGLE_WORDS) for t in batch.column(3).to_pylist()]
            if not sets:
                continue
            rows = np.stack([samples(s) if len(s) else np.zeros(SAMPLES, "uint64") for s in sets])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets]),
                 _lists(band_keys(rows).view("int64"))],
                ["doc_id", "row", "text_key", "n_shingles", "digest", "bands"])

    return given.mapInArrow(run, f"doc_id {kind}, row long, text_key string, n_shingles long, "
                                 "digest string, bands array<long>")


_WORDS = range(SKETCH_BITS // 64)


def _sketches(sets: DataFrame) -> DataFrame:
    """Two rows per class, its sketch at its own level and at the next: sizes of similar sets
    differ by a third at most, so their levels by one. The words of a sketch are columns, so
    that a join condition over them stays in generated code."""
    kinds = F.explode(F.array(
        F.struct(F.col("level").alias("at"), F.col("samples").alias("samples"), F.col("sketch").alias("bits")),
        F.struct((F.col("level") + 1).alias("at"), F.col("thinner_samples").alias("samples"),
                 F.col("thinner").alias("bits"))))
    return sets.select("cls", "n", F.col("level").alias("own"), kinds.alias("k")).select(
        "cls", "n", "own", "k.at", "k.samples", *[F.get("k.bits", F.lit(w)).alias(f"w{w}") for w in _WORDS])


def _side(df: DataFrame, x: str) -> DataFrame:
    """Columns of one side of a pair, marked by its letter."""
    return df.select(*[F.col(c).alias(x if c == "cls" else f"{c}_{x}") for c in df.columns])


def _not_ruled_out() -> Column:
    """Whether sizes and sketches of the sides a and b leave open that two sets are similar."""
    few, many = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    differing = sum((F.bit_count(F.col(f"w{w}_a").bitwiseXOR(F.col(f"w{w}_b"))) for w in _WORDS), F.lit(0))

    def most(bounds: list[int]) -> Column:
        return F.expr(f"coalesce(get(array({', '.join(map(str, bounds))}), "
                      f"cast((samples_a + samples_b) div {_CELL} as int)), {SKETCH_BITS})")

    whole, thinned = most_differing()
    return ((F.col("at_a") == F.greatest("own_a", "own_b")) & (100 * few >= PERCENT * many)
            & (differing <= F.when(F.col("at_a") == 0, most(whole)).otherwise(most(thinned))))


def _full_sets(docs: DataFrame, text: str, needed: DataFrame) -> DataFrame:
    """``cls, hashes`` and the odd sketch of the classes in ``needed`` (``cls, text_key``)."""
    given = docs.select(F.md5(text_of(text).cast("binary")).alias("text_key"), text_of(text).alias("text"))
    if needed.count() <= BROADCAST_KEYS:
        needed = F.broadcast(needed)
    # copies of one text meet in a partial aggregation
    texts = given.join(needed, "text_key").groupBy("cls").agg(F.min("text").alias("text"))
    names = ["cls", "hashes", "n", "level", "samples", "sketch", "thinner_samples", "thinner"]

    def run(batches):
        for batch in batches:
            sets = [shingles(t, SHINGLE_WORDS) for t in batch.column(1).to_pylist()]
            if not sets:
                continue
            ends = np.cumsum([0, *map(len, sets)], dtype="int32")
            levels = [level_of(len(s)) for s in sets]
            own, thin = ([odd_sketch(s, level + more) for s, level in zip(sets, levels, strict=True)]
                         for more in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view("int64"))),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(levels, pa.int32()),
                 pa.array([n for n, _ in own], pa.int64()), _lists(np.stack([x for _, x in own])),
                 pa.array([n for n, _ in thin], pa.int64()), _lists(np.stack([x for _, x in thin]))], names)

    return texts.mapInArrow(run, "cls long, hashes array<long>, n long, level int, samples long, sketch array<long>, "
                                 "thinner_samples long, thinner array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("set_b"))
    both = pairs.join(right, "b").join(left, "a").withColumn(
        "shared", F.size(F.array_intersect("set_a", "set_b")))
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    return both.filter(100 * F.col("shared") >= PERCENT * union).select("a", "b")


_MEMBER = ("key", "lo", "hi", "block", "cls", "component", "size", "level", "samples", "sketch",
           "thinner_samples", "thinner")


def _block_pairs(group: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes of two blocks (or of one) of a bucket that lie in different components
    and that sizes and sketches do not rule out."""
    found_a, found_b = [np.zeros(0, "int64")], [np.zeros(0, "int64")]
    one = group["lo"][0] == group["hi"][0]
    whole, thinned = (np.array(bounds) for bounds in most_differing())
    left, right = (np.flatnonzero(group["block"] == group[side][0]) for side in ("lo", "hi"))
    for level in np.unique(group["level"][left]):
        for other in (level - 1, level, level + 1):       # similar sets are at most a level apart
            at = max(level, other)
            i, j = left[group["level"][left] == level], right[group["level"][right] == other]
            if not len(i) or not len(j):
                continue
            (bits_i, n_i), (bits_j, n_j) = (
                (group["sketch"][k], group["samples"][k]) if own == at else
                (group["thinner"][k], group["thinner_samples"][k]) for k, own in ((i, level), (j, other)))
            size_i, size_j = group["size"][i][:, None], group["size"][j][None, :]
            open_ = group["component"][i][:, None] != group["component"][j][None, :]
            open_ &= 100 * np.minimum(size_i, size_j) >= PERCENT * np.maximum(size_i, size_j)
            if one:
                open_ &= i[:, None] < j[None, :]
            if not open_.any():
                continue
            differing = np.zeros(open_.shape, "int16")
            for w in range(SKETCH_BITS // 64):
                differing += np.bitwise_count(bits_i[:, w][:, None] ^ bits_j[:, w][None, :])
            bounds = whole if at == 0 else thinned
            cell = (n_i[:, None] + n_j[None, :]) // _CELL
            most = np.where(cell < len(bounds), bounds[np.minimum(cell, len(bounds) - 1)], SKETCH_BITS)
            p, q = np.nonzero(open_ & (differing <= most))
            found_a.append(group["cls"][i[p]])
            found_b.append(group["cls"][j[q]])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return np.minimum(a, b), np.maximum(a, b)


def _across(members: DataFrame) -> DataFrame:
    """Candidate pairs ``a, b`` between components, from the members of open buckets (``key,
    cls, component, n`` entries in the bucket, and the sketch columns).

    A member goes to every pair of blocks that its block is in. Rows come sorted by pair, so
    a task holds one pair of blocks at a time.
    """
    blocks = F.ceil(F.col("n") / BUCKET_BLOCK).cast("int")
    dealt = (members.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .select(*_MEMBER).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi"))

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            ids = [kept.column(c).to_numpy() for c in ("key", "lo", "hi")]
            change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], 0)) + 1
            if len(change):
                yield from groups(kept.slice(0, change[-1]), np.append(0, change))
                kept = kept.slice(change[-1])
        if kept is not None and len(kept):
            yield from groups(kept, np.array([0, len(kept)]))

    def groups(table: pa.Table, ends: np.ndarray):
        columns = {}
        for name in _MEMBER:
            column = table.column(name).combine_chunks()
            flat = column.flatten().to_numpy().reshape(len(table), -1) if name in ("sketch", "thinner") else None
            columns[name] = column.to_numpy() if flat is None else flat
        pairs = [_block_pairs({name: x[lo:hi] for name, x in columns.items()})
                 for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(side)) for side in zip(*pairs, strict=True)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) of every node in ``links`` (``a, b``)."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        edges = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                            .filter("u <> v").distinct(), "edges")
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _links(docs: DataFrame, text: str, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between classes that connect all that are similar."""
    entries = classes.select("cls", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(entries.join(sizes, "key"), "buckets")
    company = materialize(shared.groupBy("cls").agg(F.sum("n").alias("company")), "company")
    own = materialize(classes.join(company, "cls", "left_semi"), "shared-classes")
    sets = materialize(_full_sets(docs, text, own.select("cls", "text_key")), "shingle-sets")
    facts = materialize(_sketches(sets), "sketches")

    known = shared.join(company, "cls")
    leaders = known.groupBy("key").agg(F.max(F.struct("company", "cls")).alias("leader"))
    stars = (known.join(leaders, "key").filter("cls <> leader.cls")
             .select(F.col("leader.cls").alias("a"), F.col("cls").alias("b")).distinct())
    likely = (stars.join(_side(facts, "b"), "b").join(_side(facts, "a"), "a")
              .filter((F.col("at_a") == F.col("at_b")) & _not_ruled_out()).select("a", "b"))
    first = materialize(_confirmed(likely, sets), "links")

    # what the stars left open: buckets with several components
    labels = connected_components(first)
    labelled = shared.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))

    def still_open(rows: DataFrame) -> DataFrame:
        several = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.count(F.lit(1)).alias("n")).filter("lo <> hi")
        return rows.select("key", "cls", "component").join(several.select("key", "n"), "key")

    rest = still_open(labelled).join(sets.drop("hashes").withColumnRenamed("n", "size"), "cls")
    return first.unionByName(materialize(_confirmed(_across(rest), sets), "links"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Texts are linked when their shingle sets have a Jaccard similarity of 0.75 or more;
    ``component_id`` is the smallest ``doc_id`` of the connected component, of which exactly
    one row is ``kept``. Texts of fewer than five words are one shingle; NULL, empty and
    blank texts have none and are linked with nothing. A NULL ``doc_id`` comes after every
    other; of rows that repeat one stays. An empty table gives no rows. Other columns are
    not looked at.
    """
    rows = materialize(signatures(docs, text, doc_id), "signatures")
    winner = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = materialize(rows.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("row").alias("cls"), F.min(winner).alias("winner")), "classes")
    classes = materialize(rows.join(first.select(F.col("cls").alias("row")), "row", "left_semi")
                          .select(F.col("row").alias("cls"), "text_key", "bands"),
                          "class-signatures")
    labels = materialize(connected_components(_links(docs, text, classes)), "labels")
    # of classes that are linked, the component's first row; all others have their own
    linked = first.join(labels.withColumnRenamed("node", "cls"), "cls").select("digest", "component", "winner")
    winners = materialize(linked.groupBy("component").agg(F.min("winner").alias("best")), "winners")
    members = materialize(linked.join(winners, "component").select("digest", "best"), "members")
    decided = materialize(first.join(members, "digest", "left").select(
        "digest", F.coalesce("best", "winner").alias("winner")), "decided")
    joined = rows.select("doc_id", "row", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    return joined.join(decided, "digest", "left").withColumn("winner", F.coalesce("winner", winner)).select(
        "doc_id", "n_shingles", F.col("winner.doc_id").alias("component_id"),
        (F.col("row") == F.col("winner.row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, columns as they were. ``doc_id`` identifies
    a row here; rows that share one stay or go together unless all are dropped."""
    decided = near_duplicates(docs, text, doc_id).groupBy(F.col("doc_id").alias("__nd_id")).agg(
        F.max("kept").alias("__nd_kept"))
    dropped = materialize(decided.filter(~F.col("__nd_kept")).select("__nd_id"), "near-dropped")
    if dropped.count() <= BROADCAST_KEYS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, F.col(doc_id).eqNullSafe(F.col("__nd_id")), "left_anti")
