"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes of the UTF-8 text other than space, tab, line feed, vertical tab,
form feed and carriage return.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .tokens import _powers, mix64

BLANKS = b" \t\n\v\f\r"
_BYTES_PER_PASS = 1 << 21


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    blank = np.zeros(256, bool)
    blank[list(BLANKS)] = True
    return blank, mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED27))


def byte_passes(texts: list[str | None], limit: int = _BYTES_PER_PASS):
    """(index of the first, encoded texts) of runs of about ``limit`` bytes (null: empty)."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if part and size + len(data) > limit:
            yield first, part
            first, part, size = i, [], 0
        part.append(data)
        size += len(data)
    if part:
        yield first, part


class Words:
    """Words of a run of encoded texts: places in ``data`` (the texts, a line end after
    each), hashes, and the number of words before each text (one entry more)."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        data = b"\n".join(texts) + b"\n"
        self.data = data.lower() if lower else data
        self.bytes = np.frombuffer(self.data, np.uint8)
        blank, values = _tables()
        gap = blank[self.bytes]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.before = np.searchsorted(self.starts, self.begins)
        self.hashes = span_hashes(self.bytes, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans in ascending order: polynomials over scrambled bytes."""
    up, down = _powers()
    values = _tables()[1]
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(data) < len(up):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values[data] * up[: len(data)])])
        return mix64((sums[ends] - sums[starts]) * down[starts])
    # A text longer than the table of powers, piece by piece.
    out, step, i = np.empty(len(starts), np.uint64), len(up) // 2, 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + step, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        if b - a < len(up):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values[data[a:b]] * up[: b - a])])
            out[i:j] = (sums[ends[i:j] - a] - sums[starts[i:j] - a]) * down[starts[i:j] - a]
        else:  # one span longer than the table: its powers are made for it
            power = np.full(b - a, up[1], np.uint64)
            power[0] = 1
            out[i] = (values[data[a:b]] * np.multiply.accumulate(power)).sum(dtype=np.uint64)
        i = j
    return mix64(out)


def windows(hashes: np.ndarray, before: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside a text, in order, and the number of them
    before each text (one entry more). Texts with fewer words have none."""
    counts = np.diff(before)
    inside = np.maximum(counts - width + 1, 0)
    at = np.concatenate([[0], np.cumsum(inside)])
    first = np.repeat(before[:-1] - at[:-1], inside) + np.arange(at[-1])
    h = np.zeros(len(first), np.uint64)
    for j in range(width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[first + j]
    return mix64(h), at


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes over its words with A-Z lower-cased. With
    fewer words than ``width`` (but some), the whole sequence is the one shingle."""
    words = Words(texts, lower=True)
    h, at = windows(words.hashes, words.before, width)
    out = []
    for i in range(len(texts)):
        a, b = int(words.before[i]), int(words.before[i + 1])
        if 0 < b - a < width:
            one = np.uint64(b - a)
            for x in words.hashes[a:b]:
                one = np.uint64((int(one) * 0xD6E8FEB86659FD93 + int(x)) & (2**64 - 1))
            out.append(mix64(np.array([one])))
            continue
        s = np.sort(h[at[i] : at[i + 1]])
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
    return out
