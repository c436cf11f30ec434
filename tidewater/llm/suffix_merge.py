"""Substring dedup by merged Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Such windows
are found without sending all suffixes around:

1. Every window has an anchor, the gram in it with the least hash (the first of equals). Neighbouring
   windows with one anchor are a run. Equal windows have equal anchors at equal distances, so
   only runs with one key (their anchor's hash) can share windows, and no window occurs twice in a run.
2. Runs with equal bytes share all their windows. A run whose key has no other bytes shares none.
3. What is left are runs whose bytes stand nowhere else though their key does. These, and one run of each
   repeated bytes of such keys, are cut out of the texts and dealt to buckets by key; a bucket's
   strings are sorted in shards, and the shards' transforms merged (``interleave``).

Tasks settle runs that they see twice themselves and pass on one of them, so copies are no key's
burden. A key with more different runs than a bucket may hold is settled window by window, by
digests of the whole windows, as step 2 does for runs.

Digests compared within a key have 64 bits, grams compared within a bucket too, the windows of crowded
keys 128.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .interleave import gram_hashes, repeated_windows
from .shingles import byte_passes
from .storage import saved
from .tokens import mix64

LENGTH = 400
DEPTH = 8  # symbols a window has in the transforms
_PASS_BYTES = 1 << 18
_FLUSH_RUNS = 100_000
_BUCKET_BYTES = 1 << 19
_CROWDED = 4_000  # different runs of a key: 2 or 3 MB of strings at most in one merge
_SLICE_ROWS = 500  # texts held as Python objects at once
# A run's place: its first window's byte, a bit if it is settled, one if its bytes stood before, its windows.
_SHIFT, _SETTLED, _AGAIN, _COUNT = 14, 1 << 13, 1 << 12, (1 << 12) - 1
RUN = "key long, digest long, one long, two long, place long"
_RUN_ARROW = pa.schema([(name, pa.int64()) for name in ("key", "digest", "one", "two", "place")])


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[0::2], edges[1::2]


def _pieces(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans cut so that their lengths fit a place."""
    n = -(-(ends - starts) // _COUNT)
    owner = np.repeat(np.arange(len(starts)), n)
    first = starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * _COUNT
    return first, np.minimum(ends[owner], first + _COUNT)


def runs_of(texts: list[bytes], length: int, gram: int):
    """(text, first window, windows, key, digest) of the runs of all texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    total = int(windows.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    data = b"".join(texts)
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    least = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)  # first of equals
    width, grams = 1, length - gram + 1
    while 2 * width <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if grams > width:
        least = np.minimum(least[: width - grams], least[grams - width :])
    text = np.repeat(np.arange(len(texts)), windows)
    at = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    place = at + begins[text]
    anchor = (least[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.append(first, total))
    view, starts = memoryview(data), place[first]
    digests = b"".join(blake2b(view[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), (starts + count + length - 1).tolist()))
    return text[first], at[first], count, hashes[anchor[first]], np.frombuffer(digests, np.uint64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, _SLICE_ROWS):
            yield batch.slice(i, _SLICE_ROWS)


def _run_rows(length: int, gram: int):
    def flush(held: list) -> pa.RecordBatch:
        key, digest, one, two, start, count = (np.concatenate([h[i] for h in held]) for i in range(6))
        order = np.lexsort((start, two, one, digest, key))
        same = np.concatenate([[False], (key[order][1:] == key[order][:-1]) & (digest[order][1:] == digest[order][:-1])])
        again = np.zeros(len(key), bool)
        again[order] = same
        often = again.copy()
        often[order[:-1][same[1:]]] = True
        rows = [(key[~again], digest[~again], one[~again], two[~again], start[~again] << _SHIFT | np.where(often[~again], _AGAIN, 0) | count[~again])]
        if again.any():
            # Runs that stood before: their windows, neighbours together, are settled. They need
            # no key any more and take one that spreads them.
            by = np.lexsort((start[again], two[again], one[again]))
            a, b, s, c = (v[again][by] for v in (one, two, start, count))
            head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (s[1:] != s[:-1] + c[:-1])])
            firsts = np.flatnonzero(head)
            lasts = np.append(firsts[1:], len(s)) - 1
            owner = np.repeat(np.arange(len(firsts)), -(-(s[lasts] + c[lasts] - s[firsts]) // _COUNT))
            p, q = _pieces(s[firsts], s[lasts] + c[lasts])
            a, b = a[firsts][owner], b[firsts][owner]
            place = p << _SHIFT | _SETTLED | (q - p)
            spread = mix64(a.astype(np.uint64) ^ mix64(place.astype(np.uint64)))
            rows.append((spread, np.zeros(len(p), np.uint64), a, b, place))
        columns = [np.concatenate([r[i] for r in rows]) for i in range(5)]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], schema=_RUN_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _slices(batches):
            ones, twos = (batch.column(c).to_numpy() for c in ("one", "two"))
            for first, part in byte_passes(batch.column("text").to_pylist(), _PASS_BYTES):
                text, start, count, key, digest = runs_of(part, length, gram)
                if len(text):
                    held.append((key, digest, ones[first + text], twos[first + text], start, count))
                    size += len(text)
                if size >= _FLUSH_RUNS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _settle(runs: DataFrame, label: str) -> DataFrame:
    """Of runs (``RUN``), those that are no stranger to all others: one, two, place, and kind: 0 all
    windows repeat; 1 some may; 2 all do, and the run stands for its bytes. Kinds 1 and 2 have the key
    and how many different runs it has."""
    settled, count = F.col("place").bitwiseAND(_SETTLED) != 0, F.col("place").bitwiseAND(_AGAIN) != 0
    by_key, by_bytes = Window.partitionBy("key"), Window.partitionBy("key", "digest")
    ranked = runs.withColumn("order", F.dense_rank().over(by_key.orderBy("digest"))) \
        .withColumn("first", F.coalesce(F.lag("digest").over(by_key.orderBy("digest")) != F.col("digest"), F.lit(True))) \
        .withColumn("n", F.count(F.lit(1)).over(by_bytes)).withColumn("again", F.max(count).over(by_bytes)) \
        .withColumn("distinct", F.max("order").over(by_key))
    often = settled | F.col("again") | (F.col("n") > 1)
    mixed = (F.col("distinct") > 1) & ~settled
    kind = F.when(often, F.when(mixed & F.col("first"), 2).otherwise(0)).when(mixed, 1)
    held = ranked.select("one", "two", "place", kind.alias("kind"), F.when(kind > 0, F.col("key")).alias("key"), F.when(kind > 0, F.col("distinct")).alias("distinct"))
    return saved(held.where("kind is not null"), label)


STRING = "key long, one long, two long, start long, owned boolean, crowded boolean, data binary"


def _cut(length: int):
    """The bytes of the runs in ``list`` (place, kind, key and whether it is crowded of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, size = [], 0
            for one, two, text, runs in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "text", "list"))):
                data = text.encode("utf-8", "surrogatepass")
                for r in runs:
                    start = r["place"] >> _SHIFT
                    piece = data[start : start + (r["place"] & _COUNT) + length - 1]
                    rows.append((r["key"], one, two, start, r["kind"] == 1, r["crowded"], piece))
                    size += len(piece)
                if size >= 2 << 20:
                    yield _strings(rows)
                    rows, size = [], 0
            if rows:
                yield _strings(rows)

    return run


def _strings(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"key": pa.int64(), "one": pa.int64(), "two": pa.int64(), "start": pa.int64(), "owned": pa.bool_(), "crowded": pa.bool_(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))


def _merged(length: int, depth: int):
    """The windows of a bucket's strings that repeat, as places."""

    def run(group: pa.Table) -> pa.Table:
        found = repeated_windows(group.column("data").to_pylist(), length, depth)
        out = []
        for one, two, start, owned, flags in zip(*(group.column(c).to_pylist() for c in ("one", "two", "start", "owned")), found):
            if owned and flags.any():
                out += [(one, two, start + a << _SHIFT | b - a) for a, b in zip(*(x.tolist() for x in _spans(flags)))]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["one", "two", "place"])

    return run


def _windows(length: int):
    """Each window of the strings as a run of its own; the key is one half of its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two, start, data in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "start", "data"))):
                view = memoryview(data)
                n = len(data) - length + 1
                halves = np.frombuffer(b"".join(blake2b(view[i : i + length], digest_size=16).digest() for i in range(n)), np.int64).reshape(n, 2)
                place = start + np.arange(n) << _SHIFT | 1
                columns = [halves[:, 0], halves[:, 1], np.full(n, one), np.full(n, two), place]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_RUN_ARROW)

    return run


def _identity(id_col: str, text: Column) -> list[Column]:
    return [F.xxhash64(F.col(id_col), text).alias("one"), F.xxhash64(F.lit(1), text, F.col(id_col)).alias("two")]


RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()),
                       T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
_RESULT_ARROW = pa.struct([("n_bytes", pa.int64()), ("kept", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def repeated_places(docs: DataFrame, length: int = LENGTH, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(one, two, places): for each text, told by its hashes with its id, the windows that repeat."""
    if length % depth or length // depth > length or length >= _COUNT:
        raise ValueError(f"length {length} must be a multiple of {depth} below {_COUNT}")
    text = F.col(text_col).cast("string")
    texts = docs.select(*_identity(id_col, text), text.alias("text")).where(F.octet_length("text") >= length)
    runs = texts.mapInArrow(_run_rows(length, length // depth), RUN)
    settled = _settle(runs, "runs")
    open_ = settled.where("kind > 0")
    total = open_.agg(F.sum(F.col("place").bitwiseAND(_COUNT) + length - 1)).first()[0] or 0
    crowded = (F.col("distinct") > _CROWDED).alias("crowded")
    lists = open_.groupBy("one", "two").agg(F.collect_set(F.struct("place", "kind", "key", crowded)).alias("list"))  # of one text
    # Kept, as the texts would be joined once for each use.
    strings = saved(texts.join(lists, ["one", "two"]).mapInArrow(_cut(length), STRING), "strings")
    buckets = int(total // _BUCKET_BYTES) + 1
    merged = strings.where("not crowded").withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets))) \
        .groupBy("bucket").applyInArrow(_merged(length, depth), "one long, two long, place long")
    found = settled.where("kind <> 1").select("one", "two", "place").unionByName(merged)
    crowds = strings.where("crowded")
    if not crowds.isEmpty():
        windows = crowds.mapInArrow(_windows(length), RUN)
        found = found.unionByName(_settle(windows, "windows").select("one", "two", "place"))
    return found.groupBy("one", "two").agg(F.collect_set("place").alias("places"))  # of one text


def remove_long_repeats(docs: DataFrame, length: int = LENGTH, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
                        result_col: str = "repeats") -> DataFrame:
    """``docs`` with a struct ``result_col``: bytes of the UTF-8 text, the bytes kept, and the byte
    spans removed, which are all that a string of ``length`` bytes covers that starts more than
    once in the texts, in whichever documents. ``length`` is a multiple of ``depth``.

    A null text counts as empty; texts shorter than ``length`` are kept whole; a repeated row is a
    copy like any other, so both lose all their repeats; null ids are ids. An empty table stays
    empty; other columns pass unchanged, but one named ``result_col`` is an error.
    """
    if result_col in docs.columns:
        raise ValueError(f"the input has a column named {result_col}")
    places = repeated_places(docs, length, depth, id_col, text_col).toDF("_one", "_two", "_places")
    one, two = _identity(id_col, F.col(text_col).cast("string"))
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), one, two)
    joined = joined.join(places, (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")), "left")
    joined = joined.select("row", F.col(f"row.`{text_col}`").cast("string").alias("text"), F.col("_places").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            facts = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                spans = []
                if found:
                    place = np.array(found, np.int64)
                    depths = np.zeros(len(data) + 1, np.int64)
                    np.add.at(depths, place >> _SHIFT, 1)
                    np.add.at(depths, (place >> _SHIFT) + (place & _COUNT) + length - 1, -1)
                    spans = list(zip(*(x.tolist() for x in _spans(np.cumsum(depths[:-1]) > 0))))
                ends = [0, *(x for span in spans for x in span), len(data)]
                facts.append({"n_bytes": len(data), "kept": b"".join(data[a:b] for a, b in zip(ends[0::2], ends[1::2])),
                              "removed": [{"start": a, "end": b} for a, b in spans]})
            row = batch.column("row")
            yield pa.RecordBatch.from_arrays([*row.flatten(), pa.array(facts, _RESULT_ARROW)], names=[*row.type.names, result_col])

    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(result_col, RESULT)]))
