"""Token ids in files of independent blocks, coded by an adaptive context-mixing range coder.

A block's ids are cut into lanes that are coded in step, one id of each lane at a time, with
one range coder a lane and one model for the block. The model predicts an id from the last two
ids (order 2), one from the last id (order 1), and a distribution over all ids (order 0). Their
shares of the next id's probability are mixed by weights that adapt to how often predictions
of such confidence were right; the mixed distribution drives the coder. Every block starts with
a fresh model and carries checksums of its bytes and of its ids, so it can be read alone. A
file reads the same on any machine: arithmetic is in integers, or in doubles that are exact.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import finished_file
from .tokens import encoder, passes

MAGIC = b"TIDEIDS1"
BLOCK_TOKENS = 1 << 22
FILE_BYTES = 32 << 20
_LANE = 256
_MOST_LANES = 8192
_SLOTS = 18  # bits of an order-2 slot number
_TURNS = 8  # steps between two builds of the order-0 table
_GAIN = 32
_U = np.uint64
_LOW, _WORD, _FULL = _U(0xFFFFFFFF), _U(0xFFFF), _U((1 << 48) - 1)


class Model:
    """Predictions and their weights; encoder and decoder feed it the same ids in step.

    A prediction is an id and its confidence, packed: id * 16 + confidence.
    """

    def __init__(self, lanes: int, alphabet: int):
        if alphabet > 1 << 27:
            raise ValueError("ids must be below 2**27")
        self.table2, self.table1 = np.full(1 << _SLOTS, -16, np.int32), np.full(alphabet, -16, np.int32)
        self.last1, self.last2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.freq = np.ones(alphabet, np.int64)
        self.hits = np.tile(np.array([2, 1, 2], np.int64), (512, 1))
        # Confidence after a miss (first 16) and after a hit.
        self.next_sure = np.array([max(c // 2, 1) for c in range(16)] + [min(c + 1, 15) for c in range(16)], np.int32)
        self.turn = 0
        self._order0()
        self._weights()

    def _order0(self) -> None:
        if self.freq.sum() > 1 << 23:
            self.freq = (self.freq + 1) // 2
        self.below = np.concatenate([[0], np.cumsum(self.freq)])
        self.built, self.begin = self.freq.astype(_U), self.below.astype(_U)
        self.edges = self.below[1:].astype(np.int32)
        self.total = self.begin[-1]

    def _weights(self) -> None:
        total = self.hits.sum(axis=1)
        first = 1 + self.hits[:, 0] * 65533 // total
        second = 1 + self.hits[:, 1] * 65533 // total
        self.start = np.stack([np.zeros_like(first), first, first + second], axis=1).astype(_U).ravel()
        self.share = np.stack([first, second, 65536 - first - second], axis=1).astype(_U).ravel()

    def freq_of(self, ids: np.ndarray) -> np.ndarray:
        """Shares in the order-0 table as it was last built."""
        return self.built.take(ids)

    def predict(self, n: int) -> None:
        """Predictions for the first ``n`` lanes and the weights that go with them."""
        self.n = n
        self.context = self.last1[:n]
        self.slot = ((self.context * 0x9E3779B1 + self.last2[:n] * 0x85EBCA6B + 1) * 0x2C1B3C6D & 0xFFFFFFFF) >> 32 - _SLOTS
        two, one = self.table2.take(self.slot), self.table1.take(self.context)
        self.guess2, self.c2, self.guess1, self.c1 = two >> 4, two & 15, one >> 4, one & 15
        self.row = 3 * (self.c2 << 5 | self.c1 << 1 | (self.guess1 == self.guess2))

    def update(self, ids: np.ndarray, which: np.ndarray, literal: np.ndarray) -> None:
        n = self.n
        for table, at, guess, c in ((self.table2, self.slot, self.guess2, self.c2), (self.table1, self.context, self.guess1, self.c1)):
            hit = guess == ids
            table[at] = np.where(hit | (c > 1), guess, ids) << 4 | self.next_sure.take(c + (hit.astype(np.int32) << 4))
        hits = self.hits.reshape(-1)
        hits += 4 * np.bincount(self.row + which, minlength=len(hits))
        if self.turn % 32 == 31:
            big = self.hits.sum(axis=1) > 1 << 20
            self.hits[big] = (self.hits[big] + 1) // 2
        if self.turn < 16 or self.turn % 2:
            self._weights()
        if len(literal):
            np.add.at(self.freq, literal, _GAIN)
        self.turn += 1
        if self.turn % _TURNS == 0 or self.turn < 16:
            self._order0()
        self.last2[:n] = self.last1[:n]
        self.last1[:n] = ids


def _shape(n: int) -> tuple[int, int]:
    """Lanes of a block and the most ids of a lane; the first lanes are the longer ones."""
    lanes = min(max(1, n // _LANE), _MOST_LANES)
    return lanes, -(-n // lanes)


def _by_step(ids: np.ndarray, lanes: int, steps: int) -> np.ndarray:
    """Row ``i`` has the ``i``-th id of each lane; what the shorter lanes lack is left open."""
    longer = len(ids) % lanes or lanes
    cut = longer * steps
    grid = np.empty((steps, lanes), np.int32)
    grid[:, :longer] = ids[:cut].reshape(longer, steps).T
    grid[: steps - 1, longer:] = ids[cut:].reshape(lanes - longer, steps - 1).T
    return grid


def _by_lane(grid: np.ndarray, n: int) -> np.ndarray:
    """The ids that :func:`_by_step` laid out, one lane after the other."""
    steps, lanes = grid.shape
    longer = n % lanes or lanes
    return np.concatenate([grid[:, :longer].T.ravel(), grid[: steps - 1, longer:].T.ravel()])


def _symbols(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The number of ``edges`` at or below each value; sought in order, as neighbours then lie
    close together. There are at most ``_MOST_LANES`` values, from 0 to below 2**31."""
    packed = np.sort(values.astype(np.int64) << 32 | np.arange(len(values)))
    out = np.empty(len(values), np.int32)
    out[packed & 0xFFFFFFFF] = np.searchsorted(edges, (packed >> 32).astype(edges.dtype), side="right")
    return out


def encode_ids(ids: np.ndarray, alphabet: int) -> bytes:
    """The lanes' code words: their number of 16-bit words each, then the words."""
    n = len(ids)
    lanes, steps = _shape(n)
    grid = _by_step(ids, lanes, steps)
    model = Model(lanes, alphabet)
    low, size = np.zeros(lanes, _U), np.full(lanes, 1 << 48, _U)
    width = 3 * steps + 4
    words, first = np.zeros(lanes * width, np.uint16), np.arange(lanes) * width
    at = first.copy()

    def narrow(lane, unit, start, share):
        """Goes to the part of the interval; whole words of it go out."""
        lo, sz = low[lane] + unit * start, unit * share
        over = np.flatnonzero(lo > _FULL)  # carries go into the words already out
        if len(over):
            lo[over] &= _FULL
            k = over if isinstance(lane, slice) else lane[over]
            j = at[k] - 1
            while len(j):
                words[j] += np.uint16(1)
                j = j[words[j] == 0] - 1
        while True:
            short = np.flatnonzero(sz <= _LOW)
            if not len(short):
                break
            k, now = short if isinstance(lane, slice) else lane[short], lo[short]
            j = at[k]
            words[j] = now >> _U(32)
            at[k] = j + 1
            lo[short] = (now & _LOW) << _U(16)
            sz[short] <<= _U(16)
        low[lane], size[lane] = lo, sz

    for step in range(steps):
        live = lanes if step < n // lanes else n % lanes
        now = grid[step, :live]
        model.predict(live)
        which = np.where(now == model.guess2, 0, np.where(now == model.guess1, 1, 2))
        code = model.row + which
        narrow(slice(0, live), size[:live] >> _U(16), model.start.take(code), model.share.take(code))
        rest = np.flatnonzero(which == 2)
        literal = now[rest]
        if len(rest):
            narrow(rest, size[rest] // model.total, model.begin.take(literal), model.freq_of(literal))
        model.update(now, which, literal)
    for shift in (32, 16, 0):
        words[at] = low >> _U(shift) & _WORD
        at += 1
    at -= first
    out = words.reshape(lanes, width)[np.arange(width)[None, :] < at[:, None]]
    return at.astype("<u4").tobytes() + out.astype("<u2").tobytes()


def decode_ids(data: bytes, n: int, alphabet: int) -> np.ndarray:
    lanes, steps = _shape(n)
    counts = np.frombuffer(data, "<u4", lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(data, "<u2", offset=4 * lanes), np.zeros(4, np.uint16)])
    at = np.cumsum(counts) - counts
    if int(counts.sum()) + 4 != len(words):
        raise ValueError("a block's lanes don't add up")
    code = words[at].astype(_U) << _U(32) | words[at + 1].astype(_U) << _U(16) | words[at + 2]
    at += 3
    size = np.full(lanes, 1 << 48, _U)
    model = Model(lanes, alphabet)
    grid = np.empty((steps, lanes), np.int32)

    def narrow(lane, unit, start, share):
        co, sz = code[lane] - unit * start, unit * share
        while True:
            short = np.flatnonzero(sz <= _LOW)
            if not len(short):
                break
            k = short if isinstance(lane, slice) else lane[short]
            j = at[k]
            co[short] = co[short] << _U(16) | words.take(j, mode="clip")
            at[k] = j + 1
            sz[short] <<= _U(16)
        code[lane], size[lane] = co, sz

    for step in range(steps):
        live = lanes if step < n // lanes else n % lanes
        model.predict(live)
        lane = slice(0, live)
        unit = size[lane] >> _U(16)
        coded = code[lane]
        which = (coded >= unit * model.start.take(model.row + 1)).astype(np.int64) + (coded >= unit * model.start.take(model.row + 2))
        choice = model.row + which
        narrow(lane, unit, model.start.take(choice), model.share.take(choice))
        now = np.where(which == 0, model.guess2, model.guess1)
        rest = np.flatnonzero(which == 2)
        literal = now[:0]
        if len(rest):
            unit = size[rest] // model.total
            # Both are below 2**48, so the double nearest to their quotient has its whole part.
            value = np.minimum((code[rest].view(np.int64) / unit.view(np.int64)).astype(np.int32), np.int32(model.total - _U(1)))
            literal = _symbols(model.edges, value)
            narrow(rest, unit, model.begin.take(literal), model.freq_of(literal))
            now[rest] = literal
        model.update(now, which, literal)
        grid[step, :live] = now
    return _by_lane(grid, n).astype(np.uint32)


_HEAD = struct.Struct("<8sIIIII")


def write_block(ids: np.ndarray, keys: list[int | None], counts: list[int], ends: bool) -> bytes:
    """A block: head (magic, ids, alphabet, pieces, bytes of the code, checksum of the ids),
    the pieces' documents and lengths, whether the last piece ends its document, the code,
    and a checksum of all that."""
    alphabet = int(ids.max()) + 1 if len(ids) else 1
    code = encode_ids(ids, alphabet) if len(ids) else b""
    pieces = np.array([(k is not None, k or 0, c) for k, c in zip(keys, counts)], dtype=[("known", "u1"), ("doc", "<i8"), ("n", "<u4")])
    body = _HEAD.pack(MAGIC, len(ids), alphabet, len(pieces), len(code), zlib.crc32(ids.astype("<u4"))) + pieces.tobytes() + bytes([ends]) + code
    return body + struct.pack("<I", zlib.crc32(body))


def read_blocks(data: memoryview) -> Iterator[tuple[np.ndarray, list, list, bool]]:
    """(ids, documents, lengths, whether the last piece ends its document) of each block."""
    at = 0
    while at < len(data):
        magic, n, alphabet, pieces, size, check = _HEAD.unpack(data[at : at + _HEAD.size])
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        begin, at = at, at + _HEAD.size
        table = np.frombuffer(data[at : at + 13 * pieces], dtype=[("known", "u1"), ("doc", "<i8"), ("n", "<u4")])
        at += 13 * pieces
        ends = bool(data[at])
        code = bytes(data[at + 1 : at + 1 + size])
        at += 1 + size
        if zlib.crc32(data[begin:at]) != struct.unpack("<I", data[at : at + 4])[0]:
            raise ValueError("a block's bytes don't match their checksum")
        at += 4
        ids = decode_ids(code, n, alphabet) if n else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4")) != check:
            raise ValueError("a block's ids don't match their checksum")
        yield ids, [int(d) if k else None for k, d in zip(table["known"], table["doc"])], table["n"].astype(np.int64).tolist(), ends


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
              block_tokens: int = BLOCK_TOKENS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes each document's ids and then ``end_id`` in ascending order of document ids, and
    of texts for equal ids, over files whose names sort in that order; returns a row per file:
    name, ids, documents.

    A null text is empty, so it has the end id alone; null document ids come first; repeated
    rows are written each; an empty table writes no file; other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, written = encoder(tokenizer_path), TaskContext.get().partitionId(), []
        with ExitStack() as stack:
            out, sizes = None, [0, 0, 0]  # bytes, ids, documents
            held: list[np.ndarray] = []
            keys: list = []
            counts: list[int] = []

            def put(ends: bool):
                nonlocal out, sizes
                if out is None:
                    sizes = [0, 0, 0]
                    out = stack.enter_context(finished_file(folder, f"ids-{part:07d}-{len(written):05d}.tid"))
                block = write_block(np.concatenate([np.zeros(0, np.uint32), *held]), keys, counts, ends)
                out.write(block)
                sizes[0] += len(block)
                sizes[1] += sum(counts)
                sizes[2] += len(keys) - (not ends)
                held.clear()
                keys.clear()
                counts.clear()

            def close():
                nonlocal out
                if out is not None:
                    stack.pop_all().close()
                    written.append((f"ids-{part:07d}-{len(written):05d}.tid", sizes[1], sizes[2]))
                    out = None

            size = 0
            for batch in batches:
                names, texts, done = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
                for chunk in passes(texts):
                    flat, at = enc.encode(chunk)
                    for i in range(len(chunk)):
                        ids = np.append(flat[at[i] : at[i + 1]], np.uint32(end_id))
                        while size + len(ids) > block_tokens:  # the document goes on in the next block
                            head, ids = ids[: block_tokens - size], ids[block_tokens - size :]
                            if len(head):
                                held.append(head)
                                keys.append(names[done + i])
                                counts.append(len(head))
                            put(not len(head))
                            size = 0
                        held.append(ids)
                        keys.append(names[done + i])
                        counts.append(len(ids))
                        size += len(ids)
                        if sizes[0] >= file_bytes and out is not None:
                            put(True)
                            size = 0
                            close()
                    done += len(chunk)
            if keys:
                put(True)
            close()
        yield pa.RecordBatch.from_arrays([pa.array([w[i] for w in written], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         names=["name", "ids", "documents"])

    rows.mapInArrow(run, "name string, ids long, documents long").write.parquet(f"{folder}/_manifest")
    return spark.read.schema("name string, ids long, documents long").parquet(f"{folder}/_manifest")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (unsigned 32-bit, little endian) of
    every document of the files that :func:`write_ids` wrote to ``folder``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                start, held = 0, []
                for ids, keys, counts, ends in read_blocks(memoryview(content.as_buffer())):
                    rows, at = [], 0
                    for i, (key, n) in enumerate(zip(keys, counts)):
                        held.append(ids[at : at + n])
                        at += n
                        if ends or i + 1 < len(keys):
                            data = np.concatenate(held) if len(held) > 1 else held[0]
                            rows.append((key, start, data.astype("<u4").tobytes()))
                            start += len(data)
                            held = []
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path.rpartition("/")[2]] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary())))],
                        names=["name", "doc_id", "place", "ids"])

    manifest = spark.read.schema("name string, ids long, documents long").parquet(f"{folder}/_manifest")
    # Files of a task are in one window, then a row per task.
    named = manifest.withColumn("part", F.substring_index("name", "-", 2))
    inside, among = Window.partitionBy("part").orderBy("name"), Window.orderBy("part")
    until = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = named.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", until(among).alias("earlier"))
    before = named.select("part", "name", until(inside).alias("within")).join(parts, "part").select("name", (F.col("within") + F.col("earlier")).alias("before"))
    files = spark.read.format("binaryFile").load(f"{folder}/*.tid").select("path", "content")
    found = files.mapInArrow(run, "name string, doc_id long, place long, ids binary")
    return found.join(before, "name").select("doc_id", (F.col("place") + F.col("before")).alias("start"), "ids")
