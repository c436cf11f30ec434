"""Byte-level BPE ids for many texts, exactly as the tokenizers library gives them.

The pre-tokenizer's word pattern is applied to whole batches with numpy: code points are
classed (letter, number, white space, other), words start where the class changes, and the
contraction and white-space rules move a few of those starts. A word's ids don't depend on
its neighbours, so each distinct word of a task is encoded by the library once and the ids
of a text are gathered from that table.
"""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3

# Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000]

_CHARS_PER_PASS = 1 << 20
_CACHED_WORDS = 1_200_000
_WORDS_A_CALL = 1000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


@lru_cache(maxsize=1)
def _byte_characters() -> np.ndarray:
    """The character by which a byte-level vocabulary names each byte."""
    named = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = np.zeros(256, "<u2")
    table[named] = named
    others = np.setdiff1d(np.arange(256), named)
    table[others] = 256 + np.arange(len(others))
    return table


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    n = 2 * _CHARS_PER_PASS
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]))
                     for b in (_BASE, inverse))


def word_starts(codes: np.ndarray, first: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Flags of the code points that start a word.

    ``first`` flags the first code point of every segment; a segment flagged in ``whole``
    (over code points) is one word, which is how special tokens are passed.
    """
    kind = _class_table()[codes]
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    start = change.copy()
    after_space = np.zeros(len(codes), bool)  # a run of other characters that follows white space
    after_space[1:] = (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:]
    at = np.flatnonzero(after_space)
    start[at - 1] = True
    start[at[codes[at - 1] == 0x20]] = False
    # Contractions: a lone apostrophe that starts a word, then s, t, m, d, re, ve or ll.
    n = len(codes)
    at = np.flatnonzero((codes == 0x27) & start)
    at = at[at + 1 < n]
    at = at[change[at] & (kind[at + 1] == LETTER) & ~first[at + 1]]
    one = codes[at + 1]
    two = np.where((at + 2 < n), codes[np.minimum(at + 2, n - 1)], 0)
    same = (at + 2 < n) & ~first[np.minimum(at + 2, n - 1)]
    long = same & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    short = np.isin(one, [ord(c) for c in "stmd"])
    for hit, width in ((short, 2), (long, 3)):
        p = at[hit]
        start[p + 1] = False
        p = p + width
        p = p[p < n]
        start[p[(kind[p] == LETTER)]] = True
    if whole.any():
        start[whole] = False
        start[first] = True
    return start


class BpeEncoder:
    """Encodes lists of texts; keeps a bounded table of words it has met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model if self.tokenizer.normalizer is None else None
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.special_words = frozenset(special)
        self._forget()

    def _forget(self) -> None:
        # Hashes of the words met, in order, and their rows: most of them, and those met of late.
        self.known = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]
        self.flat = np.zeros(0, np.uint32)
        self.at = np.zeros(1, np.int64)

    def words(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The joined text, the place where each word starts in it (and its end), each word's
        hash, and the number of words before each text (one entry more than texts)."""
        segments, owner, whole = [], [], []
        for i, text in enumerate(texts):
            parts = self.special.split(text) if self.special and self.special.search(text) else (text,)
            for k, part in enumerate(parts):
                if part:
                    segments.append(part)
                    owner.append(i)
                    whole.append(k % 2 == 1)
        joined = "".join(segments)
        if not joined:
            return "", np.zeros(1, np.int64), np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        begins = np.cumsum(lengths) - lengths
        first = np.zeros(len(codes), bool)
        first[begins] = True
        whole = np.array(whole)
        start = word_starts(codes, first, np.repeat(whole, lengths) if whole.any() else whole)
        edges = np.append(np.flatnonzero(start), len(codes))
        chars = np.zeros(len(texts) + 1, np.int64)
        np.add.at(chars, np.array(owner) + 1, lengths)
        before = np.searchsorted(edges, np.cumsum(chars), side="left")
        return joined, edges, _hashes(codes, edges), before

    def _rows(self, joined: str, edges: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The table row of each word; words not met before are encoded and added."""
        if len(self.at) > _CACHED_WORDS:
            self._forget()
        codes, distinct = pd.factorize(hashes)
        place = np.empty(len(distinct), np.int64)
        place[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        order = np.argsort(distinct)
        sought, found = distinct[order], np.full(len(distinct), -1, np.int64)
        for keys, held in self.known:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
                hit = keys[at] == sought
                found[hit] = held[at[hit]]
        rows = np.empty(len(distinct), np.int64)
        rows[order] = found
        new = np.flatnonzero(rows < 0)
        if len(new):
            s, e = edges[place[new]].tolist(), edges[place[new] + 1].tolist()
            words = [joined[a:b] for a, b in zip(s, e)]
            odd = np.fromiter(("\n" in w or w[0] == "<" for w in words), bool, len(words))
            new = np.concatenate([new[~odd], new[odd]])
            for part in (list(compress(words, ~odd)), list(compress(words, odd))):
                if part:
                    ids, counts = self.encode_words(part)
                    self.flat = np.concatenate([self.flat, ids])
                    self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(counts)])
            rows[new] = np.arange(len(self.at) - 1 - len(new), len(self.at) - 1)
            self.known[1] = _merged(self.known[1], (distinct[new], rows[new]))
            if 8 * len(self.known[1][0]) > len(self.known[0][0]):
                self.known = [_merged(*self.known), (np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        return rows[codes]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that :meth:`words` cut, one after the other, and the number of each."""
        if self.model is None or not self.special_words.isdisjoint(words) or any("\n" in w for w in words):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        else:  # words are cut already: the library's model alone has to see them, byte by byte
            line_end = chr(_byte_characters()[0x0A])
            ids = []
            for i in range(0, len(words), _WORDS_A_CALL):
                data = np.frombuffer("\n".join(words[i : i + _WORDS_A_CALL]).encode(), np.uint8)
                for w in _byte_characters()[data].tobytes().decode("utf-16-le").split(line_end):
                    ids.append([t.id for t in self.model.tokenize(w)])
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start (one entry more)."""
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for part in passes(texts):
            joined, edges, hashes, before = self.words(part)
            rows = self._rows(joined, edges, hashes) if len(hashes) else np.zeros(0, np.int64)
            n = self.at[rows + 1] - self.at[rows]
            flat.append(gather(self.flat, self.at[rows], n))
            counts.append(np.diff(np.concatenate([[0], np.cumsum(n)])[before]))
        return np.concatenate(flat), np.cumsum(np.concatenate(counts))


def passes(texts):
    """Runs of texts of about ``_CHARS_PER_PASS`` characters (null: empty)."""
    part, size = [], 0
    for text in texts:
        text = text or ""
        if part and size + len(text) > _CHARS_PER_PASS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + counts[i]] for every i, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return values[shift + np.arange(total)]


def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, rows = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
    order = np.argsort(keys, kind="stable")
    return keys[order], rows[order]


@lru_cache(maxsize=1)
def _scrambled() -> np.ndarray:
    """Every code point scrambled."""
    return mix64(np.arange(1, 0x110001, dtype=np.uint64))


def _hashes(codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over scrambled code points, then scrambled."""
    up, down = _powers()
    values = _scrambled().take(codes)
    if len(codes) < len(up):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * up[: len(codes)])])
        return mix64((sums[edges[1:]] - sums[edges[:-1]]) * down[edges[:-1]])
    place = np.arange(len(codes)) - np.repeat(edges[:-1], np.diff(edges))  # a very long text
    power = np.ones(int(np.diff(edges).max()), np.uint64)
    power[1:] = _BASE
    return mix64(np.add.reduceat(values * np.multiply.accumulate(power)[place], edges[:-1]))


@lru_cache(maxsize=2)
def encoder(path: str) -> BpeEncoder:
    """The encoder of this Python worker."""
    return BpeEncoder(path)
