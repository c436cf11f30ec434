"""Similarity join on word shingles by parity sketches.

Two sets of Jaccard similarity 0.8 or more differ in at most a ninth of the sum of their sizes.
A parity sketch flips one bit for each shingle, so the Hamming distance of two sketches is at
most the number of shingles in which the sets differ. In a band of set sizes that difference is
at most D; sketches cut into P > D words of bits agree in P - D words or more, and so, in any
fixed order of (word number, content), share one of the first D + 1. That order puts words of
many flipped bits first: those are selective, and empty words are almost never used. The
join is exact: documents that share such a word are compared by a dense sketch and then by
their shingles.

Equal sets are one class from the start. Of a group that shares a word, first the pairs with
one centre are verified. Where that leaves a group in several components, pairs that would
join these follow, nearest sketches first, and in the end every pair across components that
is still left, so no link between components is lost and no group is expanded into all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shingles import byte_passes, shingle_sets
from .storage import saved, tidy
from .tokens import mix64

SKETCH_BITS = 1024
BROADCAST_ROWS = 500_000
_FLUSH_KEYS = 1_000_000
_GROUP_BYTES = 12 << 20
_SMALL_GROUP = 512
_ROUNDS = (1, 8, None)  # disjoint forests of pairs to try across components; None: all pairs
_TOKEN_MASK = np.uint64((1 << 48) - 1)


@lru_cache(maxsize=1)
def _bounds() -> np.ndarray:
    """First sizes of the bands: a set and one a quarter larger lie in one band or in two
    that follow each other."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(5 * out[-1] // 4 + 1)
    return np.array(out, np.int64)


def band_words(band: int) -> tuple[int, int]:
    """(first words of the order that are indexed, words of a sketch) of a band whose pairs
    have their smaller set in it."""
    largest = int(_bounds()[band + 1]) - 1
    need = largest // 4 + 1
    return need, need + need // 4 + 1


def sketch_tokens(shingles: np.ndarray, band: int) -> np.ndarray:
    """48-bit tokens of the indexed words of the parity sketch of sorted distinct hashes.

    A word's bits are a range of the hashes, which are too sparse to meet in one bit; a
    token is a hash of the word's number and of its flipped bits.
    """
    need, words = band_words(band)
    number = ((shingles >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    flipped = np.diff(np.append(starts, len(shingles)))
    content = np.bitwise_xor.reduceat(mix64(shingles), starts)
    salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    token = mix64(content ^ (number[starts] * np.uint64(0xC2B2AE3D27D4EB4F) + salt))
    if len(token) > need:
        token = token[np.lexsort((token, -flipped))[:need]]
    elif len(token) < need:
        missing = np.setdiff1d(np.arange(words, dtype=np.uint64), number[starts])
        empty = mix64(missing * np.uint64(0x165667B19E3779F9) + salt)
        token = np.concatenate([token, np.sort(empty)[: need - len(token)]])
    return token & _TOKEN_MASK


def all_tokens(shingles: np.ndarray) -> list[np.ndarray]:
    """Tokens of a set for pairs in which it is the smaller set, and the larger."""
    n = len(shingles)
    if n < 4:  # such a set is similar to an equal one only
        return []
    bounds = _bounds()
    band = int(np.searchsorted(bounds, n, side="right")) - 1
    out = [sketch_tokens(shingles, band)]
    if band and 4 * n <= 5 * (int(bounds[band]) - 1):
        out.append(sketch_tokens(shingles, band - 1))
    return out


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    mixed = mix64(shingles)
    return (int(mixed.sum(dtype=np.uint64)) & (1 << 63) - 1,
            int(np.bitwise_xor.reduce(mix64(mixed ^ np.uint64(0x27D4EB2F165667C5)))) & (1 << 63) - 1 if len(shingles) else 0)


def _dense(shingles: np.ndarray) -> bytes:
    odd = np.bincount((shingles % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, rows = batch.column(1).to_pylist(), []
        for _, part in byte_passes(texts):
            for s in shingle_sets(part):
                rows.append((len(s), *_digest(s), _dense(s)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
            names=["doc_id", "n_shingles", "h1", "h2", "sketch"])


def _token_rows(parts: int):
    """Packed (token, set) pairs for each of ``parts`` ranges of tokens. Of the sets of one
    flush that share a token the smallest digest goes on for it; the others come as edges."""

    def flush(tokens: list, owners: list) -> pa.RecordBatch:
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        first = np.concatenate([[True], token[1:] != token[:-1]])
        head = owner[first][np.cumsum(first) - 1]
        edge = ~first & (owner != head)
        rows = []
        for kind, t, o, c in ((0, token[first], owner[first], None), (1, token[edge], owner[edge], head[edge])):
            part = (t % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[by], np.arange(parts + 1))
            for p in range(parts):
                at = by[ends[p] : ends[p + 1]]
                if len(at):
                    rows.append((p, kind, t[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), o[at].tobytes(),
                                 b"" if c is None else c[at].tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["part", "kind", "tokens", "owners", "heads"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, size, seen = [], [], 0, set()
        for batch in batches:
            for _, part in byte_passes(batch.column(0).to_pylist()):
                for s in shingle_sets(part):
                    if len(s) < 4 or (own := _digest(s)[0]) in seen:
                        continue
                    seen.add(own)
                    for t in all_tokens(s):
                        tokens.append(t)
                        owners.append(np.full(len(t), own, np.int64))
                        size += len(t)
                if size >= _FLUSH_KEYS:
                    yield flush(tokens, owners)
                    tokens, owners, size, seen = [], [], 0, set()
        if size:
            yield flush(tokens, owners)

    return run


def _token_edges(group: pa.Table) -> pa.Table:
    """(token, a, b): in each group of sets that share a token, all with the smallest one."""
    def unpack(row):
        raw = np.frombuffer(row["tokens"], np.uint8).reshape(-1, 6)
        token = np.zeros((len(raw), 8), np.uint8)
        token[:, :6] = raw
        return token.view("<u8").ravel(), np.frombuffer(row["owners"], np.int64), np.frombuffer(row["heads"], np.int64)

    rows = group.to_pylist()
    heads = [unpack(r) for r in rows if r["kind"] == 0]
    edges = [unpack(r) for r in rows if r["kind"] == 1]
    token, owner = (np.concatenate([x[i] for x in heads]) for i in (0, 1))
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    first = np.concatenate([[True], token[1:] != token[:-1]])
    head = owner[first][np.cumsum(first) - 1]
    more = owner != head
    out = [(token[more], head[more], owner[more]), *((t, h, o) for t, o, h in edges)]
    t, a, b = (np.concatenate([x[i] for x in out]) for i in range(3))
    return pa.table([pa.array(t.astype(np.int64)), pa.array(a), pa.array(b)], names=["token", "a", "b"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether 100 times the intersection is at least 80 times the union."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 80 * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, last_set = None, None
    for batch in batches:
        a, b, texts_a, texts_b = (batch.column(i).to_pylist() for i in range(4))
        keep = []
        done = 0
        for _, part in byte_passes(texts_b):
            for i, y in enumerate(shingle_sets(part), done):
                if a[i] != last:
                    last, last_set = a[i], shingle_sets([(texts_a[i] or "").encode("utf-8", "surrogatepass")])[0]
                if similar(last_set, y):
                    keep.append(i)
            done += len(part)
        yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that meet the two necessary conditions: sizes, and the Hamming distance of the
    dense sketches."""
    for batch in batches:
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(n_a), -1) for c in ("sketch_a", "sketch_b"))
        far = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        keep = pa.array((5 * np.minimum(n_a, n_b) >= 4 * np.maximum(n_a, n_b)) & (9 * far <= n_a + n_b))
        yield batch.select(["a", "b"]).filter(keep)


_PAIRS_AT_ONCE = 200_000


def _pairs_of_groups(edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places (first, second) inside groups of neighbouring places, given where these
    start and the last ends, some ``_PAIRS_AT_ONCE`` at a time."""
    later = np.repeat(edges[1:], np.diff(edges)) - np.arange(edges[-1]) - 1  # places after each in its group
    ends = np.cumsum(later)
    first = 0
    while first < len(later):
        upto = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _PAIRS_AT_ONCE, side="right")))
        n = later[first:upto]
        left = np.repeat(np.arange(first, upto), n)
        yield left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        first = upto


def _across(forests: int | None):
    """Of groups that share a token the pairs of different components that may be similar: all
    of them, or only those of so many disjoint spanning forests, nearest sketches first."""

    def run(group: pa.Table) -> pa.Table:
        token, own, n, comp, side = (group.column(c).to_numpy() for c in ("token", "own", "n", "comp", "side"))
        bits = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(len(token), -1)
        order = np.lexsort((own, token))
        edges = np.flatnonzero(np.concatenate([[True], token[order][1:] != token[order][:-1], [True]]))
        found = [np.zeros((0, 3), np.int64)]
        for left, right in _pairs_of_groups(edges):
            i, j = order[left], order[right]
            # sides 0 and 1 are two chunks of a group, whose pairs are those between them
            fit = (comp[i] != comp[j]) & (own[i] != own[j]) & ((side[i] != side[j]) | (side[i] == 2)) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
            i, j = i[fit], j[fit]
            far = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
            both = n[i] + n[j]
            near = 9 * far <= both
            a, b = own[i[near]], own[j[near]]
            found.append(np.stack([far[near] * 10_000 // both[near], np.minimum(a, b), np.maximum(a, b)], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)  # nearest first
        out = list(dict.fromkeys(zip(pairs[:, 1].tolist(), pairs[:, 2].tolist())))
        if forests is not None:
            out = _forests(out, dict(zip(own.tolist(), comp.tolist())), forests)
        return pa.table([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def _forests(pairs: list[tuple[int, int]], component: dict[int, int], number: int) -> list[tuple[int, int]]:
    """The pairs that join two trees of one of ``number`` forests over the components, each
    taken in order by the first forest that it fits."""
    parents: list[dict[int, int]] = [{} for _ in range(number)]

    def find(parent, x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for a, b in pairs:
        for parent in parents:
            x, y = find(parent, component[a]), find(parent, component[b])
            if x != y:
                parent[x] = y
                out.append((a, b))
                break
    return out


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs of sets (digests a and b) those that are similar, by their documents' texts."""
    pairs = saved(pairs, "pairs")
    used = saved(pairs.select(F.col("a").alias("h1")).union(pairs.select(F.col("b").alias("h1"))).distinct().join(classes, "h1").select("h1", "rep"), "used")
    if used.count() <= BROADCAST_ROWS:
        used = F.broadcast(used)  # at most BROADCAST_ROWS rows of two integers
    texts = docs.join(used, docs["doc_id"] == used["rep"]).select("h1", "text").dropDuplicates(["h1"])
    a, b = texts.select(F.col("h1").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("h1").alias("b"), F.col("text").alias("text_b"))
    return saved(pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(tidy(_verify), "a long, b long"), "links")


def similarity_classes(docs: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """(sets, classes) of documents (doc_id, text; ids not null): each document's set size and
    digest, and the classes of equal sets with the digest that names their component."""
    spark = docs.sparkSession
    docs.mapInArrow(tidy(_set_rows), "doc_id long, n_shingles long, h1 long, h2 long, sketch binary").write.parquet(work)
    sets = spark.read.schema("doc_id long, n_shingles long, h1 long, h2 long, sketch binary").parquet(work)
    classes = saved(sets.where("n_shingles > 0").groupBy("h1", "h2", "n_shingles")
                    .agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")).withColumnRenamed("n_shingles", "n"), "classes")
    total = classes.agg(F.sum("n")).collect()[0][0] or 0
    parts = max(8, -(-int(total * 0.55 * 14) // _GROUP_BYTES))
    tokens = docs.select("text").mapInArrow(tidy(_token_rows(parts)), "part int, kind int, tokens binary, owners binary, heads binary")
    edges = saved(tokens.groupBy("part").applyInArrow(_token_edges, "token long, a long, b long"), "tokens")

    facts = classes.select(F.col("h1").alias("own"), "n", "sketch")
    side = lambda c: facts.select(F.col("own").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    stars = saved(edges.select("a", "b").distinct(), "stars")
    near = stars.join(side("b"), "b").join(side("a"), "a").mapInArrow(_near_rows, "a long, b long")
    label = saved(connected_components(_verified(near, classes, docs)), "components")
    tested = stars
    # Tokens whose sets are not all in one component yet: compare across components, first a few
    # pairs that would join them, then all that are left.
    for forests in _ROUNDS:
        pairs = _open_pairs(edges, stars, label, facts, forests, parts)
        if pairs is None:
            break
        pairs = saved(pairs.join(tested, ["a", "b"], "left_anti"), "open-pairs")
        if pairs.isEmpty():
            continue
        tested = tested.unionByName(pairs)
        label = _joined(label, _verified(pairs, classes, docs))
    return sets, classes.join(label.select(F.col("node").alias("h1"), "component"), "h1", "left") \
        .select("h1", "h2", "n", "rep", F.coalesce("component", "h1").alias("component"))


def _open_pairs(edges: DataFrame, stars: DataFrame, label: DataFrame, facts: DataFrame, forests: int | None, parts: int) -> DataFrame | None:
    """Pairs across components of the sets that share a token (see ``_across``), or none where
    each token's sets are in one component."""
    comp = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"comp_{c}"))
    apart = stars.join(comp("a"), "a", "left").join(comp("b"), "b", "left") \
        .where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")
    open_tokens = edges.join(apart, ["a", "b"], "left_semi").select("token").distinct()
    open_edges = saved(edges.join(open_tokens, "token", "left_semi"), "open-tokens")
    if open_edges.isEmpty():
        return None
    members = open_edges.select("token", F.col("a").alias("own")).union(open_edges.select("token", F.col("b").alias("own"))).distinct()
    chunks = F.ceil(F.col("m") / _SMALL_GROUP).cast("int")
    sizes = members.groupBy("token").agg(F.count("*").alias("m")).where(f"m > {_SMALL_GROUP}").select("token", chunks.alias("chunks"))
    members = members.join(facts, "own").join(comp("own"), "own", "left").withColumn("comp", F.coalesce("comp_own", "own")) \
        .join(sizes, "token", "left").select("token", "own", "n", "comp", "sketch", F.coalesce("chunks", F.lit(1)).alias("chunks"))
    mine = F.pmod(F.xxhash64("own"), F.col("chunks")).cast("int")
    # A large group is cut into chunks, and each pair of chunks is a group of its own; small
    # groups are put together by a hash of their token.
    members = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .withColumn("side", F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).cast("int")) \
        .withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    bucket = F.when(F.col("chunks") == 1, F.pmod(F.col("token"), F.lit(16 * parts))).otherwise(F.col("token"))
    return members.groupBy(bucket.alias("bucket"), "low", "high", F.col("chunks")).applyInArrow(_across(forests), "a long, b long").distinct()


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links: components of the components that these join."""
    if links.isEmpty():
        return label
    comp = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"comp_{c}"))
    upper = saved(connected_components(links.join(comp("a"), "a", "left").join(comp("b"), "b", "left")
                                       .select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))), "components")
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    single = ends.join(label, "node", "left_anti").withColumn("component", F.col("node"))
    return saved(label.unionByName(single).join(upper.toDF("component", "upper"), "component", "left")
                 .select("node", F.coalesce("upper", "component").alias("component")), "components")


def ngram_components(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles (distinct 5-word shingles, A-Z lower-cased) and component_id: the
    smallest document that links of Jaccard similarity 0.8 or more reach. ``work`` is a fresh
    shared folder.

    A text without words, or null, has no shingles and links with nothing; with one to four
    words the whole sequence is its shingle. A null id comes back with a null component and
    links with nothing; equal texts are linked; an empty table gives no rows; other columns
    are left out. ``docs`` is read more than once and should be files or a checkpoint.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets, classes = similarity_classes(rows.where("doc_id is not null"), work)
    least = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = classes.join(least, "component").select("h1", "h2", F.col("n").alias("n_shingles"), "component_id")
    found = sets.drop("sketch").join(of_class, ["h1", "h2", "n_shingles"], "left") \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    without = rows.where("doc_id is null").mapInArrow(tidy(_set_rows), "doc_id long, n_shingles long, h1 long, h2 long, sketch binary") \
        .select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return found.unionByName(without)
