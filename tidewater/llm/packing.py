"""Packing of documents into training sequences by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of each
document is placed, longest first, into the open window with the least room that still
takes it. Open windows stand in a segment tree indexed by their remaining capacity.

Every task packs its own documents, in buffers of a bounded number of tokens, so nothing is
shuffled and no task holds more than a buffer. A sequence id is the task's partition number
times 2**33 plus a running number, so ids never clash and a retried task gives them again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import tidy
from .tokens import encoder, passes

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
BUFFER_TOKENS = 1 << 22


class OpenWindows:
    """Windows that still take tokens: a segment tree over remaining capacities.

    Leaf ``c`` stands for capacity ``c`` and holds a stack of windows; a node's count is the
    number of windows below it.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: dict[int, list[int]] = {}

    def add(self, capacity: int, window: int) -> None:
        self.stacks.setdefault(capacity, []).append(window)
        self._change(capacity, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the window of the least capacity of at least ``need``."""
        node = need + self.leaves
        if not self.count[node]:
            # Up to the first right sibling that holds windows, then down its left side.
            while node > 1 and not (node % 2 == 0 and self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return capacity, self.stacks[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node //= 2


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The window and the offset of each piece, and the number of windows.

    Pieces of a whole window come first and fill one each; ties in length keep their order.
    """
    order = np.argsort(-lengths, kind="stable")
    at, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int((lengths == window).sum())
    at[order[:full]] = np.arange(full)
    tree, used = OpenWindows(window), full
    for i in order[full:].tolist():
        need = int(lengths[i])
        found = tree.tightest(need)
        if found is None:
            room, where = window, used
            used += 1
        else:
            room, where = found
        at[i], offset[i] = where, window - room
        if room > need:
            tree.add(room - need, where)
    return at, offset, used


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """One row per piece: where it starts in its document, its ids (unsigned 32-bit, little
    endian), the sequence that holds it and its offset there.

    Each document is its token ids and then ``end_id``; every id lies in exactly one piece.
    A null text is empty, so its only piece is the end id; a null id stays null; repeated rows
    are packed one by one; an empty table gives no rows; other columns are left out.
    """
    if window < 1:
        raise ValueError("window must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        base, used = TaskContext.get().partitionId() << 33, 0
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal held, size, used
            if not held:
                return None
            out, used = _packed(held, window, base, used)
            held, size = [], 0
            return out

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            done = 0
            for part in passes(texts):
                flat, at = enc.encode(part)
                for i in range(len(part)):
                    ids = np.append(flat[at[i] : at[i + 1]], np.uint32(end_id))
                    held.append((keys[done + i], ids))
                    size += len(ids)
                    if size >= buffer_tokens:
                        yield flush()
                done += len(part)
        if (out := flush()) is not None:
            yield out
        encoder.cache_clear()  # its table of words would stay in the worker, beside what later stages need

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(tidy(run), SCHEMA)


def _packed(held: list[tuple], window: int, base: int, used: int) -> tuple[pa.RecordBatch, int]:
    sizes = np.array([len(ids) for _, ids in held], np.int64)
    pieces = -(-sizes // window)
    doc = np.repeat(np.arange(len(held)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
    length = np.minimum(sizes[doc] - start, window)
    at, offset, n = best_fit_decreasing(length, window)
    flat = np.concatenate([ids for _, ids in held])
    ends = np.concatenate([[0], np.cumsum(4 * length)])
    ids = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat.astype("<u4"))])
    keys = pa.array([k for k, _ in held], pa.int64()).take(pa.array(doc))
    out = pa.RecordBatch.from_arrays(
        [keys, pa.array(start), pa.array(length), ids.cast(pa.binary()), pa.array(sizes[doc]), pa.array(base + used + at), pa.array(offset)],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return out, used + n
