"""Quality rules: fixed limits over document statistics, then gradient-boosted trees.

The statistics of every whole text come from one pass. The trees are fitted on the driver
on a bounded sample of labelled documents (``SAMPLE_ROWS``), with monotonic constraints on
chosen statistics, and flattened into node arrays that score a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shingles import BLANKS, Words, byte_passes, windows
from .storage import tidy

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see and the direction in which a higher value may move the odds of
#: a good document (0: either).
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "distinct_share": 0, "digit_share": 0, "words_a_line": 0}
SAMPLE_ROWS = 4000
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


def statistics(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of ``COUNTS`` and the features of ``FEATURES``, a row for each text."""
    counts, features = np.zeros((len(texts), 5), np.int64), np.zeros((len(texts), len(FEATURES)))
    for first, part in byte_passes(texts):
        words = Words(part)
        n = np.diff(words.before)
        h, at = windows(words.hashes, words.before)
        owner = np.repeat(np.arange(len(part)), np.diff(at))
        repeat = _repeats(h, owner, words.before[:-1][owner] + np.arange(len(h)) - at[:-1][owner], len(words.hashes))
        repeated = np.diff(np.concatenate([[0], np.cumsum(repeat)])[words.before])
        for i, data in enumerate(part):
            text = texts[first + i] or ""
            lines = [x for x in data.split(b"\n") if x.strip(BLANKS)]
            chars = len(text) - (len(data) - len(data.translate(None, BLANKS)))
            symbols = len(data) - len(data.translate(None, SYMBOLS))
            dup = len(lines) - len(set(lines))
            k, w = first + i, int(n[i])
            counts[k] = w, chars, symbols, dup, repeated[i]
            distinct = len(np.unique(words.hashes[words.before[i] : words.before[i + 1]]))
            digits = len(data) - len(data.translate(None, b"0123456789"))
            features[k] = (np.log1p(w), chars / max(w, 1), symbols / max(chars, 1), dup / max(len(lines), 1),
                           repeated[i] / max(w, 1), distinct / max(w, 1), digits / max(chars, 1), w / max(len(lines), 1))
    return counts, features


def _repeats(h: np.ndarray, owner: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """Flags of the ``n`` words in a 5-word window whose hash its text has twice or more."""
    flags = np.zeros(n + 5, np.int64)
    if len(h):
        key = h ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(flags, word[twice], 1)
        np.add.at(flags, word[twice] + 5, -1)
    return np.cumsum(flags)[:n] > 0


@dataclass
class Trees:
    """Flattened trees: node arrays of all trees one after the other, and their roots."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of a good document. A leaf points to itself."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2,
        bins: int = 48, least: int = 8, ridge: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss over quantile bins.

    A split on a constrained feature must order its children's values, and their subtrees
    stay on their side of the middle, so the sum is monotone in that feature. With one class
    or no rows the result has no trees and odds that accept everything.
    """
    n = len(y)
    if not n or y.min() == y.max():
        empty = np.zeros(0)
        return Trees(empty.astype(int), empty, empty.astype(int), empty.astype(int), empty, empty.astype(int), 0, 5.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    rate_good = y.mean()
    base = float(np.log(rate_good / (1 - rate_good)))
    odds = np.full(n, base)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, level: int) -> int:
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        me = len(nodes)
        nodes.append([0, np.inf, me, me, rate * value])
        best = None
        for j in range(x.shape[1]) if level < depth and len(rows) >= 2 * least else ():
            size = len(edges[j]) + 1
            cg, ch, cn = (np.cumsum(np.bincount(binned[rows, j], w, size))[:-1] for w in (g[rows], h[rows], None))
            if not len(cg):
                continue
            rg, rh = g[rows].sum() - cg, h[rows].sum() - ch
            vl, vr = np.clip(-cg / (ch + ridge), low, high), np.clip(-rg / (rh + ridge), low, high)
            fair = (cn >= least) & (len(rows) - cn >= least)
            fair &= (monotone[j] * (vr - vl) >= 0) if monotone[j] else True
            gain = np.where(fair, -(cg * vl + 0.5 * (ch + ridge) * vl**2) - (rg * vr + 0.5 * (rh + ridge) * vr**2), -np.inf)
            k = int(np.argmax(gain))
            if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
                best = (gain[k], j, k, vl[k], vr[k])
        own = -(g[rows].sum() * value + 0.5 * (h[rows].sum() + ridge) * value**2)
        if best is None or best[0] <= own + 1e-6:
            return me
        _, j, k, vl, vr = best
        mid, to_left = (vl + vr) / 2, binned[rows, j] <= k
        bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}.get(monotone[j], ((low, high),) * 2)
        a = grow(rows[to_left], g, h, *bounds[0], level + 1)
        b = grow(rows[~to_left], g, h, *bounds[1], level + 1)
        nodes[me][:4] = [j, float(edges[j][k]), a, b]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        start = len(nodes)
        roots.append(grow(np.arange(n), p - y, p * (1 - p), -4.0, 4.0, 0))
        f, t, a, b, v = map(np.array, zip(*nodes))
        odds += Trees(f, t, a, b, v, np.array([start]), depth, 0.0).odds(x)
    f, t, a, b, v = map(np.array, zip(*nodes))
    return Trees(f.astype(int), t, a.astype(int), b.astype(int), v, np.array(roots), depth, base)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Trees:
    """Trees fitted on at most ``sample_rows`` labelled documents, those first by a hash of
    their id. Labels other than 0 and 1 and null ids are left out; of several labels of one
    document the lowest counts, of several texts of one id the one with the least statistics."""
    chosen = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The sample's size is bounded by sample_rows, so it may be broadcast.
    rows = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(tidy(_sample_features), "doc_id long, y int, x array<double>") \
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).orderBy("doc_id").collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.y for r in rows], float), list(FEATURES.values()))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, x = statistics(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


RESULT = T.StructType([*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()),
                       T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def quality_rules(docs: DataFrame, model: Trees, keep_at: float = 0.5, text_col: str = "text",
                  result_col: str = "quality") -> DataFrame:
    """``docs`` and a struct ``result_col``: the counts, ``base_failed`` (fewer than 10 words,
    or more than 20 % of them in 5-word windows found twice or more), the model's probability
    of a good document, and ``kept`` (not failed, and that probability at least ``keep_at``).

    A null text has no words, so it fails; repeated rows get the same result; an empty table
    stays empty; other columns pass unchanged, but a column named ``result_col`` is an error.
    """
    if result_col in docs.columns:
        raise ValueError(f"the input has a column named {result_col}")
    schema = T.StructType([*docs.schema.fields, T.StructField(result_col, RESULT)])
    at = docs.columns.index(text_col)
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, x = statistics(batch.column(at).to_pylist())
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
            p = 1 / (1 + np.exp(-model.odds(x)))
            parts = [*counts.T, failed, p, ~failed & (p >= keep_at)]
            result = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(parts, kinds)], names=RESULT.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, result], names=[*batch.schema.names, result_col])

    return docs.mapInArrow(tidy(run), schema)
