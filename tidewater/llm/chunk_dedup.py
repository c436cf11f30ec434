"""Substring dedup by content-defined chunks.

A gear hash over the bytes before a word decides whether a chunk starts there, so chunks of
equal passages are equal wherever the passages stand. What is compared, by digest, are spans: runs
of chunks of at least ``MIN_WORDS`` words that would have fewer without their first or without
their last chunk, so a stretch of chunks that stood together before is covered by spans that did.
Of equal spans the one in the smallest document (then the earliest) stays; what is removed are
chunks inside the others. Chunks that repeat one by one, as in ordinary language, stay.

A span's text is removed by mere chance only if two of the 64-bit digests collide: in 30 GB of text
(1.6 billion spans at 18.6 bytes, as in the given documents) that is expected of 0.07 spans in all.

Tasks settle repeats among their own spans and send on one occurrence of each digest, packed
by ranges of digests, so a passage that many documents share is no task's burden.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shingles import Words, byte_passes, span_hashes
from .storage import tidy
from .tokens import mix64

MIN_WORDS = 20
WINDOW = 16  # bytes that decide on a boundary
_LONG_WORD = 48
_FLUSH_SPANS = 1 << 18
_PASS_BYTES = 1 << 19  # of text whose hashes a task holds at once
_GROUP_BYTES = 12 << 20
_ENTRY_BYTES = 24
_BYTES_A_SPAN = 18
_NO_ID = (1 << 63) - 1


@lru_cache(maxsize=1)
def _gears() -> np.ndarray:
    return (mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x6EA5)) >> np.uint64(32)).astype(np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The 32-bit gear hash after each byte over the last ``WINDOW`` bytes: a byte's gear
    shifted by its distance, summed; by doubling the window."""
    h, width = _gears()[data], 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


class Chunks:
    """Chunks of a run of encoded texts: starts and ends in ``data``, words that start in
    each, and the number of chunks before each text (one entry more)."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts)
        self.data = words.data
        begins, starts = words.begins, words.starts
        owner = np.searchsorted(begins, starts, side="right") - 1
        gear = gear_hash(words.bytes)
        bits = gear[np.maximum(starts - 1, 0)] >> np.uint32(WINDOW - 2) & np.uint32(3)
        cut = starts[(bits == 0) & (starts - begins[owner] >= WINDOW)]
        lengths = words.ends - starts
        if len(lengths) and lengths.max() > _LONG_WORD:  # long words are cut inside, between code points
            inner = [np.zeros(0, np.int64)]
            for w in np.flatnonzero(lengths > _LONG_WORD):
                at = np.arange(starts[w] + WINDOW, words.ends[w])
                at = at[(words.bytes[at] & 0xC0) != 0x80]
                inner.append(at[gear[at - 1] >> np.uint32(WINDOW - 6) & np.uint32(63) == 0])
            cut = np.concatenate([cut, *inner])
        texts_at = begins[:-1][np.diff(begins) > 1]
        self.starts = np.unique(np.concatenate([texts_at, cut]))
        self.before = np.searchsorted(self.starts, begins)
        self.ends = np.empty(len(self.starts), np.int64)
        self.ends[:-1] = self.starts[1:]
        last = self.before[1:][np.diff(self.before) > 0] - 1
        self.ends[last] = begins[1:][np.diff(self.before) > 0] - 1
        self.words = np.diff(np.searchsorted(starts, np.append(self.starts, len(words.bytes))))
        # A stretch without white space counts as a word for every 12 bytes.
        self.words = np.maximum(self.words, (self.ends - self.starts) // 12)
        self.bytes = words.bytes

    def spans(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last chunk of each span, in order, and the number of spans before each text
        (one entry more). The last chunks ascend too."""
        n = np.diff(self.before)
        begin, end = np.repeat(self.before[:-1], n), np.repeat(self.before[1:], n)
        sums, chunk = np.concatenate([[0], np.cumsum(self.words)]), np.arange(len(self.words))
        last = np.searchsorted(sums, sums[:-1] + min_words) - 1  # shortest from each chunk on
        first = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1  # shortest up to each chunk
        on, back = last < end, first >= begin
        both = np.unique(np.concatenate([chunk[on] << 32 | last[on], first[back] << 32 | chunk[back]]))
        return both >> 32, both & 0xFFFFFFFF, np.searchsorted(both >> 32, self.before)

    def digests(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return span_hashes(self.bytes, self.starts[first], self.ends[last])


def _entries(parts: int, min_words: int):
    """Packed (digest, document, text tag and span number) for ``parts`` ranges of digests.
    Kind 0: the first occurrence of a digest in a flush; kind 1: later ones, without digest."""

    def flush(held: list) -> pa.RecordBatch:
        digest, doc, place = (np.concatenate([h[i] for h in held]) for i in range(3))
        order = np.lexsort((place, doc, digest))
        digest, doc, place = digest[order], doc[order], place[order]
        first = np.concatenate([[True], digest[1:] != digest[:-1]])
        head = np.maximum.accumulate(np.where(first, np.arange(len(digest)), 0))
        again = (doc != doc[head]) | (place != place[head])  # not so: the same row once more
        rows = []
        for kind, keep in ((0, first), (1, again)):
            d, o, p = digest[keep], doc[keep], place[keep]
            part = (d % np.uint64(parts)).astype(np.int64) if kind == 0 else _bucket(o, p, parts)
            by = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[by], np.arange(parts + 1))
            for k in range(parts):
                at = by[ends[k] : ends[k + 1]]
                if len(at):
                    digests = d[at].astype("<u8").tobytes() if kind == 0 else b""
                    rows.append((k, kind, digests, o[at].tobytes(), p[at].tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["part", "kind", "digests", "docs", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys, tags = batch.column("key").to_numpy(zero_copy_only=False), batch.column("tag").to_numpy(zero_copy_only=False)
            for first, part in byte_passes(batch.column("text").to_pylist(), _PASS_BYTES):
                chunks = Chunks(part)
                begin, end, before = chunks.spans(min_words)
                n = np.diff(before)
                owner = np.repeat(np.arange(first, first + len(part)), n)
                number = (np.arange(len(owner)) - np.repeat(before[:-1], n)).astype(np.uint64)
                held.append((chunks.digests(begin, end), keys[owner], tags[owner].astype(np.uint64) << np.uint64(32) | number))
                size += len(owner)
                if size >= _FLUSH_SPANS:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return run


def _bucket(doc: np.ndarray, place: np.ndarray, parts: int) -> np.ndarray:
    """The range of documents, told apart by id and text tag, that holds each entry's."""
    return (mix64(doc.astype(np.uint64) ^ mix64(place >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def _repeats(parts: int):
    """(bucket, docs, places): the spans of a range of digests that are not the first of
    theirs, packed by ranges of documents."""

    def run(group: pa.Table) -> pa.Table:
        docs, places, heads = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], []
        for row in group.to_pylist():
            doc, place = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["places"], np.uint64)
            if row["kind"]:
                docs.append(doc)
                places.append(place)
            else:
                heads.append((np.frombuffer(row["digests"], "<u8"), doc, place))
        if heads:
            digest, doc, place = (np.concatenate([h[i] for h in heads]) for i in range(3))
            order = np.lexsort((place, doc, digest))
            again = digest[order][1:] == digest[order][:-1]
            # A repeated row's span is no repeat of the same span of the same document.
            first = order[np.maximum.accumulate(np.where(np.concatenate([[True], ~again]), np.arange(len(order)), 0))]
            later = order[(doc[order] != doc[first]) | (place[order] != place[first])]
            docs.append(doc[later])
            places.append(place[later])
        doc, place = np.concatenate(docs), np.concatenate(places)
        bucket = _bucket(doc, place, parts)
        by = np.argsort(bucket, kind="stable")
        used, starts = np.unique(bucket[by], return_index=True)
        ends = np.append(starts[1:], len(by))
        return pa.table([pa.array(used, pa.int32()), pa.array([doc[by[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                         pa.array([place[by[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary())], names=["bucket", "docs", "places"])

    return run


def _by_document(group: pa.Table) -> pa.Table:
    """(key, tag, numbers): the repeated spans of each document of a range."""
    doc = np.concatenate([np.frombuffer(x, np.int64) for x in group.column("docs").to_pylist()])
    place = np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("places").to_pylist()])
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    tag = (place >> np.uint64(32)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]), [True]]))
    numbers = (place & np.uint64(0xFFFFFFFF)).astype("<u4")
    return pa.table([pa.array(doc[edge[:-1]], pa.int64()), pa.array(tag[edge[:-1]], pa.int64()),
                     pa.array([numbers[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())], names=["key", "tag", "numbers"])


def removed_runs(repeated: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Runs of repeated chunks (first, end) of ``min_words`` words or more; chunks of fewer than
    three words at either end of a run are left."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    out = []
    for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        while a < b and words[a] < 3:
            a += 1
        while a < b and words[b - 1] < 3:
            b -= 1
        if words[a:b].sum() >= min_words:
            out.append((a, b))
    return out


RESULT = T.StructType([T.StructField("n_chunks", T.LongType()), T.StructField("n_repeated", T.LongType()),
                       T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
_RESULT_ARROW = pa.struct([("n_chunks", pa.int64()), ("n_repeated", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                   result_col: str = "chunks") -> DataFrame:
    """``docs`` with repeated passages taken out of the text, and a struct ``result_col``: number
    of chunks, of chunks in a span that is not the first of its digest, and the removed byte
    spans of the UTF-8 text.

    Of equal spans the one in the smallest id stays, then the earliest in a text. A null text
    stays null and an empty one empty; rows with a null id come after all others; rows of one id
    and text count as one document, so they don't repeat each other; an empty table stays
    empty; other columns pass unchanged, but one named ``result_col`` is an error.
    """
    if result_col in docs.columns:
        raise ValueError(f"the input has a column named {result_col}")
    text = F.col(text_col).cast("string")
    key, tag = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))
    total = docs.agg(F.sum(F.octet_length(text))).collect()[0][0] or 0
    parts = int(max(8, -(-total * _ENTRY_BYTES // (_BYTES_A_SPAN * _GROUP_BYTES))))
    entries = docs.select(key.alias("key"), tag.alias("tag"), text.alias("text")) \
        .mapInArrow(tidy(_entries(parts, min_words)), "part int, kind int, digests binary, docs binary, places binary")
    repeated = entries.repartition(parts, "part").groupBy("part").applyInArrow(_repeats(parts), "bucket int, docs binary, places binary") \
        .groupBy("bucket").applyInArrow(_by_document, "key long, tag long, numbers binary")
    # The documents travel as one struct, so no column of theirs meets one of these.
    whole = docs.select(key.alias("key"), tag.alias("tag"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = whole.join(repeated, ["key", "tag"], "left").select("row", "numbers")
    at, names = docs.columns.index(text_col), [*docs.columns, result_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).flatten()
            texts, lists = own[at].to_pylist(), batch.column(1).to_pylist()
            out, facts = [], []
            for first, part in byte_passes(texts, _PASS_BYTES):
                chunks = Chunks(part)
                span_begin, span_end, before = chunks.spans(min_words)
                for i, data in enumerate(part):
                    a, b = int(chunks.before[i]), int(chunks.before[i + 1])
                    repeated_spans = before[i] + np.frombuffer(lists[first + i] or b"", "<u4").astype(np.int64)
                    depth = np.bincount(span_begin[repeated_spans] - a, minlength=b - a + 1) - np.bincount(span_end[repeated_spans] + 1 - a, minlength=b - a + 1)
                    flags = np.cumsum(depth[: b - a]) > 0
                    begin = int(chunks.starts[a]) if b > a else 0
                    spans = [(int(chunks.starts[a + s]) - begin, int(chunks.ends[a + e - 1]) - begin) for s, e in removed_runs(flags, chunks.words[a:b], min_words)]
                    facts.append({"n_chunks": b - a, "n_repeated": int(flags.sum()), "removed": [{"start": s, "end": e} for s, e in spans]})
                    if spans:
                        kept = [0, *(x for span in spans for x in span), len(data)]
                        out.append(b"".join(data[s:e] for s, e in zip(kept[0::2], kept[1::2])).decode("utf-8", "replace"))
                    else:
                        out.append(texts[first + i])
            own[at] = pa.array(out, own[at].type)
            yield pa.RecordBatch.from_arrays([*own, pa.array(facts, _RESULT_ARROW)], names=names)

    return joined.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField(result_col, RESULT)]))
