"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Documents are taken in chunks of a bounded number of characters. A chunk cuts its texts into
words and keeps each distinct word once; the documents become lists of word codes. The
distinct words of all chunks are shuffled by hash, so that each is encoded once, and their ids
go back to the chunks, where the codes pick them up by position. Words travel packed, a row for
each chunk and bucket of words, instead of a row for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType

from .storage import tidy
from .tokens import encoder, gather, mix64, passes

CHUNK_CHARS = 1 << 22


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_codes(codes: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, one plane of bytes after the other."""
    return _pack(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack_codes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Chunk:
    """Texts gathered for one chunk: words by hash, and their number in each text."""

    def __init__(self):
        self.keys, self.counts, self.hashes, self.joined, self.edges = [], [], [], [], []
        self.chars = 0

    def add(self, keys: list, enc, texts: list[str]) -> None:
        joined, edges, hashes, before = enc.words(texts)
        self.keys += keys
        self.counts.append(np.diff(before))
        self.hashes.append(hashes)
        self.joined.append(joined)
        self.edges.append(edges)
        self.chars += len(joined) + len(texts)

    def done(self, buckets: int):
        """The chunk's name (a digest of its words), its distinct words by bucket, and the
        words of its texts as codes that count the distinct words bucket by bucket."""
        hashes = np.concatenate(self.hashes)
        codes, distinct = pd.factorize(hashes)
        place = np.empty(len(distinct), np.int64)
        place[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        first = np.cumsum([0, *map(len, self.hashes)])
        part = np.searchsorted(first, place, side="right") - 1
        bucket = ((distinct >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = []
        for k, at in zip(part[order].tolist(), (place - first[part])[order].tolist()):
            edges = self.edges[k]
            words.append(self.joined[k][edges[at] : edges[at + 1]])
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        counts = np.concatenate(self.counts)
        return self._name(hashes, counts), words, ends, counts, rank[codes] if len(codes) else codes

    def _name(self, hashes: np.ndarray, counts: np.ndarray) -> int:
        turns = mix64(np.arange(1, len(hashes) + len(counts) + 1, dtype=np.uint64))
        values = np.concatenate([hashes, counts.astype(np.uint64)])
        return int((values * turns).sum(dtype=np.uint64)) ^ len(self.keys)


def _chunks(batches: Iterator[pa.RecordBatch], tokenizer_path: str):
    enc, chunk = encoder(tokenizer_path), _Chunk()
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        done = 0
        for part in passes(texts):
            chunk.add(keys[done : done + len(part)], enc, part)
            done += len(part)
            if chunk.chars >= CHUNK_CHARS:
                yield chunk
                chunk = _Chunk()
    if chunk.keys:
        yield chunk


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int): what the tokenizers library gives for each whole
    text without adding special tokens.

    ``docs`` is read twice and must give the same rows in the same order both times, as files
    and checkpoints do; if it doesn't, the job fails. A null text has no ids; a null id stays
    null; repeated rows are encoded each; an empty table gives no rows; other columns are left out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    # Each input partition adds a bounded number of chunks, so a bucket's size stays bounded.
    buckets = buckets or 4 * max(4, rows.rdd.getNumPartitions())

    def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, tokenizer_path):
            name, words, ends, _, _ = chunk.done(buckets)
            used = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            packed = [_pack("\0".join(w.replace("\1", "\1a").replace("\0", "\1b") for w in words[ends[b] : ends[b + 1]]).encode("utf-8", "surrogatepass"))
                      for b in used]
            yield pa.RecordBatch.from_arrays([pa.array([_signed(name)] * len(used), pa.int64()), pa.array(used, pa.int32()), pa.array(packed, pa.binary())],
                                             names=["chunk", "bucket", "words"])

    def encode_bucket(group: pa.Table) -> pa.Table:
        enc = encoder(tokenizer_path)
        lists = [[w.replace("\1b", "\0").replace("\1a", "\1") for w in _unpack(x).decode("utf-8", "surrogatepass").split("\0")]
                 for x in group.column("words").to_pylist()]
        code = {w: i for i, w in enumerate(dict.fromkeys(w for words in lists for w in words))}
        plain = [w for w in code if "\n" not in w and not w.startswith("<")]
        odd = [w for w in code if "\n" in w or w.startswith("<")]
        code = {w: i for i, w in enumerate([*plain, *odd])}
        parts = [enc.encode_words(part) for part in (plain, odd) if part]
        ids, counts = (np.concatenate(x) for x in zip(*parts))
        starts = np.cumsum(counts) - counts
        packed_ids, packed_counts = [], []
        for words in lists:
            rows = np.fromiter((code[w] for w in words), np.int64, len(words))
            packed_counts.append(_pack_codes(counts[rows]))
            packed_ids.append(_pack_codes(gather(ids, starts[rows], counts[rows])))
        return pa.table([group.column("chunk"), group.column("bucket"), pa.array(packed_counts, pa.binary()), pa.array(packed_ids, pa.binary())],
                        names=["chunk", "bucket", "counts", "ids"])

    def code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, tokenizer_path):
            name, words, _, counts, codes = chunk.done(buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_signed(name)], pa.int64()), pa.array([len(words)], pa.int64()), pa.array([chunk.keys], pa.list_(id_arrow)),
                 pa.array([_pack_codes(counts)], pa.binary()), pa.array([_pack_codes(codes)], pa.binary())],
                names=["chunk", "n_words", "keys", "counts", "codes"])

    def join_chunk(codes: pa.Table, ids: pa.Table) -> pa.Table:
        if not codes.num_rows:
            raise ValueError("the documents changed between two reads")
        ids = ids.sort_by("bucket")
        buckets_seen = ids.column("bucket").to_pylist()
        kept = [i for i, b in enumerate(buckets_seen) if not i or b != buckets_seen[i - 1]]  # equal chunks send equal words
        n = np.concatenate([np.zeros(0, np.int64), *(_unpack_codes(ids.column("counts")[i].as_py()).astype(np.int64) for i in kept)])
        flat = np.concatenate([np.zeros(0, np.uint32), *(_unpack_codes(ids.column("ids")[i].as_py()) for i in kept)])
        starts = np.cumsum(n) - n
        out = []
        for row in codes.to_pylist():
            if row["n_words"] != len(n):
                raise ValueError("the documents changed between two reads")
            words, counts = _unpack_codes(row["codes"]).astype(np.int64), _unpack_codes(row["counts"]).astype(np.int64)
            sizes = n[words]
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
            found = gather(flat, starts[words], sizes).astype(np.int32)
            lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(found)).cast(pa.list_(pa.int32()))
            out.append(pa.table([pa.array(row["keys"], id_arrow), lists], names=["doc_id", "ids"]))
        return pa.concat_tables(out)

    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    ids = rows.mapInArrow(tidy(word_rows), "chunk long, bucket int, words binary").groupBy("bucket") \
        .applyInArrow(encode_bucket, "chunk long, bucket int, counts binary, ids binary")
    codes = rows.mapInArrow(tidy(code_rows), f"chunk long, n_words long, keys array<{id_type}>, counts binary, codes binary")
    return codes.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(join_chunk, f"doc_id {id_type}, ids array<int>")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def piece_table(tokenizer_path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces by id, one after the other, and where each id's bytes start."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    # Byte-level pieces write each byte as a printable character: those that are so already
    # stand for themselves, the others, in order, for the characters from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)])


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` and the text of its ids, special tokens included. Bytes that are no UTF-8
    become replacement characters. A null array is an empty text; ids must lie in the
    vocabulary. The table of pieces has a row for each id of the vocabulary."""
    data, at = piece_table(tokenizer_path)
    where = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = part.column(where)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                counts = np.concatenate([[0], np.cumsum(np.array(lists.value_lengths().fill_null(0), np.int64))])
                sizes = at[flat + 1] - at[flat] if len(flat) else np.zeros(0, np.int64)
                chars = gather(data, at[flat] if len(flat) else sizes, sizes).tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes)])[counts].tolist()
                texts = [chars[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text_col])

    if text_col in encoded.columns:
        raise ValueError(f"the input has a column named {text_col}")
    return encoded.mapInArrow(tidy(run), StructType([*encoded.schema.fields, StructField(text_col, StringType())]))
