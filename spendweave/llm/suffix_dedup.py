"""Removal of repeated substrings with suffix arrays.

A byte goes if a string of 100 bytes that covers it also starts earlier. The texts are cut
so that equal strings meet:

1. Every string of 100 bytes has an anchor, the substring of 24 bytes with the least hash in
   it. Equal strings have equal anchors, so only strings with the same anchor need to be
   compared. The strings of one anchor at one place form a segment (some 140 bytes).
2. Texts that are copies of another are removed as wholes. Anchors that occur once are left
   out; of equal segments (the same anchor and a 64-bit hash of the content) only the first
   goes on, the others are removed as wholes. Up to here only hashes are moved.
3. Where an anchor has several different segments, these are put into blocks by anchor. A
   block becomes one row of eight-byte symbols, aligned at the anchors, and its suffix array
   (linear grouping, see ``suffix_array``) brings strings with equal whole symbols together;
   the up to seven bytes at either end that no whole symbol covers are then compared.
4. An anchor with very many different segments is not put into one block: its strings are
   counted one by one in an ordinary aggregation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.session import materialize

from .common import sha256_text, text_of
from .hashing import Substrings, mix
from .suffix_array import suffix_array

STRING, ANCHOR, SYMBOL = 100, 24, 8
_PER_STRING = STRING - ANCHOR + 1          # anchors that a string has to choose from
#: Windows handled at once, so that a position fits the low bits of an anchor's key.
_SPAN = 1 << 20
_LOW = np.uint64((1 << 21) - 1)
#: Segments of a block, and those of one anchor above which they are not put into a block.
BLOCK_SEGMENTS, LARGE_ANCHOR = 1500, 2000
#: Estimated bytes up to which a lookup is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 64_000_000


def anchors(data: bytes) -> tuple[np.ndarray, ...]:
    """``hash, at, first, last`` of each segment: the strings that start in [first, last]
    have the anchor at ``at``."""
    found = []
    if len(data) >= STRING:
        hashes = Substrings(data).windows(ANCHOR)
        for low in range(0, len(data) - STRING + 1, _SPAN):
            part = hashes[low:low + _SPAN + _PER_STRING - 1]
            # of equal hashes the leftmost: the position is in the low bits
            least = (part & ~_LOW) | np.arange(len(part), dtype="uint64")
            width = 1
            while 2 * width <= _PER_STRING:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < _PER_STRING:
                rest = _PER_STRING - width
                least = np.minimum(least[:-rest], least[rest:])
            at = (least & _LOW).astype("int64")
            begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            ends = np.append(begins[1:], len(at)) - 1
            found.append((part[at[begins]], at[begins] + low, begins + low, ends + low))
    if not found:
        return np.zeros(0, "uint64"), *(np.zeros(0, "int64") for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def repeated_strings(segments: list[bytes], anchored: np.ndarray) -> np.ndarray:
    """For the strings of all segments, in order: whether an equal one stands before it.

    ``anchored`` are the places of the anchors in their segments."""
    lengths = np.array([len(s) for s in segments])
    offset = np.cumsum(lengths) - lengths
    raw = b"".join(segments)
    grid = anchored % SYMBOL                    # where the first whole symbol begins
    whole = (lengths - grid) // SYMBOL

    # symbols by rank; every segment ends with a separator, the row with the least symbol
    begin = np.cumsum(whole + 1) - whole - 1
    words = np.concatenate([np.frombuffer(raw, "<u8", m, o) for o, m in
                            zip((offset + grid).tolist(), whole.tolist(), strict=True)])
    row = np.ones(int((whole + 1).sum()) + 1, "int64")
    row[-1] = 0
    inside = np.ones(len(row), bool)
    inside[begin + whole] = inside[-1] = False
    row[inside] = np.unique(words, return_inverse=True)[1] + 2
    order = suffix_array(row)

    # strings: the first whole symbol in each, how many there are, and the bytes at its ends
    n = lengths - STRING + 1
    of = np.repeat(np.arange(len(segments)), n)
    start = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    left = (grid[of] - start) % SYMBOL
    depth = (STRING - left) // SYMBOL
    right = STRING - left - SYMBOL * depth
    first = begin[of] + (start + left - grid[of]) // SYMBOL
    bytes_ = np.frombuffer(raw + bytes(SYMBOL), "uint8").astype("uint64")
    at_byte = sum(bytes_[k:len(raw) + k] << np.uint64(8 * k) for k in range(SYMBOL))

    def part(where, count):
        return at_byte[np.minimum(where, len(raw) - 1)] & (
            (np.uint64(1) << (8 * count).astype("uint64")) - np.uint64(1))

    where = offset[of] + start
    head, tail = part(where, left), part(where + STRING - right, right)

    group = np.zeros(len(of), "int64")
    padded = np.concatenate([row, np.full(STRING // SYMBOL + 1, -1)])
    for d in np.unique(depth):
        same = np.ones(len(order) - 1, bool)     # neighbours with d equal symbols
        for k in range(d):
            same &= padded[order[1:] + k] == padded[order[:-1] + k]
        label = np.empty(len(row), "int64")
        label[order] = np.concatenate([[0], np.cumsum(~same)])
        mine = depth == d
        group[mine] = label[first[mine]]
    key = mix(mix(mix(group.astype("uint64") * np.uint64(8) + left.astype("uint64")) ^ head) + tail)
    _, earliest, inverse = np.unique(key, return_index=True, return_inverse=True)
    like = earliest[inverse]
    exact = (group == group[like]) & (left == left[like]) & (head == head[like]) & (tail == tail[like])
    if not exact.all():                          # two keys collided: compare the parts
        _, earliest, inverse = np.unique(np.stack([group.astype("uint64"), left.astype("uint64"), head, tail]),
                                         axis=1, return_index=True, return_inverse=True)
        like = earliest[inverse.ravel()]
    return like != np.arange(len(of))


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of the runs of true flags."""
    steps = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    return steps[::2], steps[1::2]


#: The order of segments.
_ORDER = ("no_id", "doc_id", "row", "first")


def segment_keys(data: bytes, found: tuple[np.ndarray, ...]) -> np.ndarray:
    """A hash of the content of each segment and of the place of its anchor."""
    _, at, first, last = found
    if not len(at):
        return np.zeros(0, "uint64")
    return mix(Substrings(data)(first, last + STRING) + (at - first).astype("uint64"))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype="int32")
    flat = np.concatenate(arrays) if arrays else np.zeros(0, "uint64")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view("int64")))


def _pass_one(docs: DataFrame) -> DataFrame:
    given = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.md5(F.col("text").cast("binary")).alias("text_key"),
        F.octet_length("text").cast("long").alias("n_bytes"), sha256_text(F.col("text")).alias("sha256"), "text")
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            hashes, segments = [], []
            for text in batch.column(5).to_pylist():
                found = anchors(data := text.encode())
                hashes.append(found[0])
                segments.append(segment_keys(data, found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], _lists(hashes), _lists(segments)],
                ["doc_id", "row", "text_key", "n_bytes", "sha256", "hashes", "segments"])

    return given.mapInArrow(run, f"doc_id {kind}, row long, text_key string, n_bytes long, "
                                 "sha256 string, hashes array<long>, segments array<long>")


def _small(df: DataFrame, row_bytes: int, *lists: str) -> DataFrame:
    """A hint to broadcast ``df`` where its size, counted before, allows it."""
    entries = sum((F.size(name) for name in lists), F.lit(0))
    rows, values = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(entries), F.lit(0))).first()
    return F.broadcast(df) if row_bytes * rows + 8 * values <= BROADCAST_BYTES else df


def _with_text(docs: DataFrame, wanted: DataFrame, unique: bool, *lists: str) -> DataFrame:
    """``wanted`` (``doc_id, text_key, row`` and lists) with the texts, each once."""
    keyed = docs.select(F.col("doc_id").alias("own_id"), F.md5(F.col("text").cast("binary")).alias("own_key"), "text")
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    found = keyed.join(_small(wanted, 150, *lists), same).drop("own_id", "own_key")
    return found if unique else found.dropDuplicates(["row"])


def _segments(texts: DataFrame) -> DataFrame:
    """The segments of the anchors in ``picks``: ``hash, at, segment, large`` and their order."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["hash", "at", "segment", "large", *_ORDER]

    def run(batches):
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "row", "text", "picks")}
            hashes, ats, pieces, large, firsts, source = [], [], [], [], [], []
            for k, (text, picks) in enumerate(zip(column["text"].to_pylist(), column["picks"].to_pylist(),
                                                  strict=True)):
                found = anchors(data := text.encode())
                chosen = np.array([p["pick"] for p in picks])
                hash_, at, first, last = (x[chosen] for x in found)
                hashes += hash_.view("int64").tolist()
                ats += (at - first).tolist()
                firsts += first.tolist()
                pieces += [data[a:b] for a, b in zip(first.tolist(), (last + STRING).tolist(), strict=True)]
                large += [p["large"] for p in picks]
                source += [k] * len(chosen)
            at_doc = pa.array(source, pa.int64())
            ids = column["doc_id"].take(at_doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(ats, pa.int64()), pa.array(pieces, pa.binary()),
                 pa.array(large, pa.bool_()), ids.is_null(), ids, column["row"].take(at_doc),
                 pa.array(firsts, pa.int64())], names)

    return texts.mapInArrow(run, f"hash long, at long, segment binary, large boolean, no_id boolean, "
                                 f"doc_id {kind}, row long, first long")


def _in_blocks(segments: DataFrame, blocks: int) -> DataFrame:
    """Removed spans ``row, begin, end`` within blocks of segments."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(name, "ascending") for name in _ORDER])
        pieces, rows = table.column("segment").to_pylist(), table.column("row").to_numpy()
        first = table.column("first").to_numpy()
        flags = repeated_strings(pieces, table.column("at").to_numpy())
        n = np.array([len(p) - STRING + 1 for p in pieces])
        of = np.repeat(np.arange(len(pieces)), n)
        start = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        # runs end with their segment: a false flag goes between
        spaced = np.zeros(len(of) + len(pieces), bool)
        spaced[np.arange(len(of)) + of] = flags
        begins, ends = _runs(spaced)
        last = np.searchsorted(np.arange(len(of)) + of, ends - 1)
        begin = np.searchsorted(np.arange(len(of)) + of, begins)
        return pa.table({"row": rows[of[begin]], "begin": first[of[begin]] + start[begin],
                         "end": first[of[last]] + start[last] + STRING})

    return segments.withColumn("block", F.pmod(F.xxhash64("hash"), F.lit(blocks))).groupBy(
        "block").applyInArrow(run, "row long, begin long, end long")


def _one_by_one(segments: DataFrame) -> DataFrame:
    """Removed spans of anchors with very many different segments."""
    kind = segments.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            hashes = [Substrings(s).windows(STRING).view("int64")
                      for s in batch.column(batch.schema.get_field_index("segment")).to_pylist()]
            of = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
            start = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, "int64")
            take = {n: batch.column(batch.schema.get_field_index(n)).take(pa.array(of, pa.int64()))
                    for n in ("hash", *_ORDER)}
            begin = take["first"].to_numpy(zero_copy_only=False) + start
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes) if hashes else np.zeros(0, "int64")), take["hash"], take["no_id"],
                 take["doc_id"], take["row"], pa.array(begin, pa.int64())],
                ["string", "hash", "no_id", "doc_id", "row", "first"])

    strings = segments.mapInArrow(run, f"string long, hash long, no_id boolean, doc_id {kind}, row long, first long")
    strings = materialize(strings, "strings")
    earliest = strings.groupBy("hash", "string").agg(F.min(F.struct(*_ORDER)).alias("earliest"))
    return (strings.join(earliest, ["hash", "string"])
            .filter("row <> earliest.row or first <> earliest.first")
            .select("row", F.col("first").alias("begin"), (F.col("first") + STRING).alias("end")))


def _first_segments(owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``row, pick`` of all anchors that occur more than once, and of those among them with
    the first of equal segments, with the number ``n`` of different segments of the anchor."""
    every = owners.select("doc_id", "row", F.posexplode(F.arrays_zip("hashes", "segments")).alias("pick", "a")).select(
        "doc_id", "row", "pick", F.col("a.hashes").alias("hash"), F.col("a.segments").alias("segment"))
    often = materialize(every.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"),
                        "repeated-anchors")
    repeated = every.join(_small(often, 32), "hash")
    firsts = repeated.groupBy("hash", "segment").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pick")).alias("first"))
    firsts = materialize(firsts.select("hash", "first.row", "first.pick"), "first-segments")
    several = firsts.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    return repeated.select("row", "pick"), firsts.join(several, "hash").select("row", "pick", "n")


def _removed(docs: DataFrame, owners: DataFrame, unique: bool) -> DataFrame:
    """Of each text that loses something: ``row``, the anchors in ``gone`` whose segments go
    as wholes, and ``spans`` (begin, end) found by comparison."""
    repeated, firsts = _first_segments(owners)
    marks = repeated.select("row", "pick", F.lit(0).alias("n")).unionByName(
        firsts.select("row", "pick", F.col("n").cast("int").alias("n")))
    by_row = marks.groupBy("row").agg(
        F.collect_list(F.when(F.col("n") == 0, F.col("pick"))).alias("all"),
        F.collect_list(F.when(F.col("n") > 0, F.col("pick"))).alias("kept"),
        F.collect_list(F.when(F.col("n") > 1, F.struct(
            "pick", (F.col("n") > LARGE_ANCHOR).alias("large")))).alias("picks"))
    by_row = materialize(by_row.select("row", F.array_except("all", "kept").alias("gone"), "picks"), "picks")

    keys = owners.select("doc_id", "text_key", "row")
    wanted = by_row.filter(F.size("picks") > 0).select("row", "picks")
    segments = _segments(_with_text(docs, materialize(keys.join(wanted, "row"), "compared"), unique, "picks"))
    counts = wanted.agg(F.coalesce(F.sum(F.size("picks")), F.lit(0))).first()[0]
    hot = wanted.filter(F.exists("picks", lambda p: p["large"])).limit(1).count()
    spans = _in_blocks(segments.filter("not large").drop("large"), max(1, -(-counts // BLOCK_SEGMENTS)))
    if hot:
        spans = spans.unionByName(_one_by_one(segments.filter("large").drop("large")))
    found = spans.groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    both = by_row.select("row", "gone").join(found, "row", "left").withColumn("spans", F.coalesce("spans", none))
    return keys.join(both.filter((F.size("gone") > 0) | (F.size("spans") > 0)), "row")


def remove_repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256``.

    Texts are taken as UTF-8 bytes. Each byte is removed that is covered by a string of 100
    bytes which also starts earlier: in a row with a smaller ``doc_id``, or before in the
    same text; strings may overlap and are looked for in the whole input. ``spans`` are the
    maximal removed runs (begin, end exclusive, in bytes), ``kept_sha256`` is the digest of
    the other bytes joined.

    NULL texts count as empty; texts below 100 bytes lose nothing. NULL ids come last; of
    repeated rows the first found keeps its bytes. An empty table gives no rows; other
    columns are not looked at.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows = materialize(_pass_one(docs), "anchors")
    keyed = rows.select("doc_id", F.col("doc_id").isNull().alias("no_id"), "row", "text_key")
    owner = materialize(keyed.groupBy("text_key").agg(
        F.min(F.struct("no_id", "doc_id", "row")).alias("owner")).select("text_key", F.col("owner.row").alias("owner_row")),
        "owners")
    own_rows = owner.select(F.col("owner_row").alias("row"))
    unique = keyed.groupBy("text_key", "doc_id").count().filter("count > 1").isEmpty()
    owners = rows.join(own_rows, "row").select("doc_id", "row", "text_key", "hashes", "segments")
    removed = materialize(_removed(docs, owners, unique), "removed")
    with_text = _with_text(docs, removed, unique, "gone", "spans")

    def run(batches):
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)).to_pylist()
                      for n in ("text", "gone", "spans")}
            merged, digests = [], []
            for value, whole, found in zip(column["text"], column["gone"], column["spans"], strict=True):
                data, gone = value.encode(), []
                _, _, first, last = anchors(data)
                ends = [(s["begin"], s["end"]) for s in found]
                ends += zip(first[whole].tolist(), (last[whole] + STRING).tolist(), strict=True)
                for begin, end in sorted(ends):
                    if gone and begin <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], end)
                    else:
                        gone.append([begin, end])
                kept, at = hashlib.sha256(), 0
                for begin, end in gone:
                    kept.update(data[at:begin])
                    at = end
                kept.update(data[at:])
                merged.append([{"begin": b, "end": e} for b, e in gone])
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")),
                 pa.array(merged, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(digests, pa.string())], ["row", "spans", "kept_sha256"])

    cut = with_text.select("row", "text", "gone", "spans").mapInArrow(
        run, "row long, spans array<struct<begin:long,end:long>>, kept_sha256 string")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    copy = (F.col("row") != F.col("owner_row")) & (F.col("n_bytes") >= STRING)
    all_rows = (rows.drop("hashes", "segments").join(owner, "text_key").join(cut, "row", "left"))
    gone = F.when(copy, whole).otherwise(F.coalesce("spans", none))
    return all_rows.withColumn("spans", gone).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "spans",
        F.when(copy, sha256_text(F.lit(""))).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"))
