"""Merging Burrows-Wheeler transforms by iterative interleave refinement.

The strings' alphabet are grams: a suffix starts at any byte and goes on gram by gram, so a few
symbols span many bytes. A shard sorts its own suffixes once and keeps, in that order, the symbol
before each: its transform. Shards are merged without comparing suffixes again. The interleave says
which shard each row of the merged transform comes from; sorting it stably by the symbols of the
rows gives the order by one symbol more. A row where a new block begins in round h shares h - 1
symbols with the row above: those are the common prefixes, and runs of rows that share ``depth``
symbols are the repeated intervals.
"""

from __future__ import annotations

import numpy as np

from .tokens import mix64

_BASE = 0x9E3779B97F4A7C15
_SHARD_ROWS = 1 << 18


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on, by doubling."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    span, width, parts = data.astype(np.uint64) + np.uint64(1), 1, {}
    parts[1] = span
    while 2 * width <= gram:
        span = span[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + span[width:]
        width *= 2
        parts[width] = span
    n, at, out = len(data) - gram + 1, 0, None
    for width in sorted(parts, reverse=True):
        if gram & width:
            part = parts[width][at : at + n]
            out = part if out is None else out * np.uint64(pow(_BASE, width, 1 << 64)) + part
            at += width
    return mix64(out)


def stable_order(values: np.ndarray) -> np.ndarray:
    """The stable sorting order of integers from 0 to below 2**32, by two digits."""
    values = values.astype(np.uint32)
    order = np.argsort((values & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    high = values >> np.uint32(16)
    return order if not high.any() else order[np.argsort(high[order].astype(np.uint16), kind="stable")]


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    order = stable_order(low)
    order = order[stable_order(high[order])]
    new = np.concatenate([[0], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out + np.int32(1)


def shard_transform(symbols: np.ndarray, last: np.ndarray, step: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in sorted order, symbol before each) of a shard. ``symbols`` holds the symbol that
    starts at each place of its strings, 0 where none fits; ``last`` the last place of each
    place's string. The order is by ``depth`` symbols, which is all that the merge looks at."""
    n, rank, reach = len(symbols), symbols, 1
    place = np.arange(n, dtype=np.int32)
    while reach < depth:
        next_ = place + reach * step
        low = np.where(next_ <= last, rank[np.minimum(next_, n - 1)], 0)
        rank, reach = _ranks(rank, low), 2 * reach
    order = stable_order(rank).astype(np.int32)
    before = order - np.int32(step)
    inside = (before >= 0) & (last[np.maximum(before, 0)] == last[order])
    return order, np.where(inside, symbols[np.maximum(before, 0)], 0)


def merge_transforms(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each row, symbols that it shares with the row above, up to ``depth``) of the
    merged transform. Symbol 0 ends a string: rows that follow it are the empty suffixes."""
    sizes = [len(t) for t in transforms]
    shard = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    symbols, total = np.concatenate(transforms), sum(sizes)
    shared, block = np.full(total, depth, np.int16), np.zeros(total, np.int32)
    shared[:1] = 0
    for round_ in range(1, depth + 1):
        row = np.empty(total, np.int32)
        row[stable_order(shard)] = symbols  # each shard's rows keep their order
        order = stable_order(row)
        shard, symbol, above = shard[order], row[order], block[order]
        edge = np.concatenate([[False], ((symbol[1:] != symbol[:-1]) | (above[1:] != above[:-1])) & (symbol[1:] != 0)])
        shared[edge & (shared == depth)] = round_ - 1
        block = np.cumsum(edge, dtype=np.int32)
    return shard, shared


def repeated_windows(strings: list[bytes], length: int, depth: int) -> list[np.ndarray]:
    """For each string, which of its windows of ``length`` bytes occur more than once in all strings."""
    step = length // depth
    sizes = np.array([len(s) for s in strings], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    windows = np.maximum(sizes - length + 1, 0)
    out = [np.zeros(w, bool) for w in windows]
    if not windows.sum():
        return out
    hashes = gram_hashes(np.frombuffer(b"".join(strings), np.uint8), step)
    order = np.argsort(hashes)
    new = np.concatenate([[True], hashes[order[1:]] != hashes[order[:-1]]])
    del hashes
    ids, often = np.empty(len(order), np.int32), np.empty(len(order), bool)
    ids[order] = np.cumsum(new, dtype=np.int32)  # from 1
    often[order] = ~new | ~np.append(new[1:], True)
    del order, new
    # A window with a gram that stands nowhere else stands nowhere else; the others, with what they
    # span, are the strings to merge.
    alive = np.ones(max(0, len(often) - (depth - 1) * step), bool)
    for k in range(depth):
        alive &= often[k * step : k * step + len(alive)]
    owner = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)[: len(alive)]
    alive &= np.arange(length, length + len(alive)) <= begins[owner + 1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], alive * (owner + 1)])) != 0)
    del owner
    starts, ends = [], []
    bounds = np.append(edges, len(alive))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if alive[a]:
            starts.append(a)
            ends.append(b - 1 + length)  # end of what the stretch's windows span
    if not starts:
        return out
    shards, first = [], 0
    while first < len(starts):
        end, rows = first, 0
        while end < len(starts) and (end == first or rows + ends[end] - starts[end] < _SHARD_ROWS):
            rows += ends[end] - starts[end] + 1
            end += 1
        at = np.concatenate([np.arange(a, b + 1, dtype=np.int32) for a, b in zip(starts[first:end], ends[first:end])])
        sizes_ = np.array([b - a + 1 for a, b in zip(starts[first:end], ends[first:end])], np.int64)
        last = np.repeat((np.cumsum(sizes_) - 1).astype(np.int32), sizes_)
        fits = last - np.arange(len(at), dtype=np.int32) >= step
        symbols = np.where(fits, ids[np.minimum(at, len(ids) - 1)], np.int32(0))
        order, transform = shard_transform(symbols, last, step, depth)
        shards.append((at, last, order, transform))
        first = end
    shard, shared = merge_transforms([s[3] for s in shards], depth)
    again = shared >= depth
    again[:-1] |= shared[1:] >= depth  # a row of a repeated interval shares with one beside it
    by_shard = again[stable_order(shard)]
    begin, hit = 0, np.zeros(len(often) + length, bool)
    for at, last, order, _ in shards:
        rows = by_shard[begin : begin + len(order)]
        begin += len(order)
        whole = last[order] - order >= length
        hit[at[order[rows & whole]]] = True
    for i, w in enumerate(windows.tolist()):
        if w:
            out[i] = hit[begins[i] : begins[i] + w]
    return out
