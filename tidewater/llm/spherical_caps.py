"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector belongs to the filters whose direction it exceeds a
threshold on, so near vectors share filters. The directions are a product code: each is a
codeword of a first half of the (rotated) coordinates with one of the second half, and the
sum of two short lists of scores decodes a vector to all its filters. Vectors are joined on
filters and pairs are verified by cosine in double precision.

A vector takes every filter above the threshold, and at least so many of the best. The number of
filters grows with the number of vectors, so that a filter holds about ``VECTORS_A_FILTER`` vectors.
How many a vector takes follows from a miss rate that is measured before the join: random pairs at
the threshold cosine, in the table's own dimension and with its own code, are decoded, and a vector
takes more filters, then the code gets fewer and larger ones, until at most ``MISSES`` of these pairs
share none. So recall holds at any size and dimension; in few dimensions or for very many vectors
buckets are what grows. Pairs above the threshold are missed less often.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import saved, tidy

THRESHOLD = 0.95
FILTERS_LEAST = 26
FILTERS_MOST = 90
MISSES = 0.001
_TRIALS = 2_000
VECTORS_A_FILTER = 64
CHUNK = 512
BROADCAST_ROWS = 200_000
_DECODED = "rep long, copies long, embedding array<{}>, filters array<int>"


def codewords_a_half(vectors: int) -> int:
    """So many that about FILTERS_LEAST * vectors / VECTORS_A_FILTER directions arise."""
    return int(np.clip(np.ceil((FILTERS_LEAST * vectors / VECTORS_A_FILTER) ** 0.5), 48, 40_000))


@lru_cache(maxsize=8)
def _code(dims: int, half_words: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Unit codewords of the two halves, in the coordinates of a random rotation."""
    rng = np.random.default_rng([seed, dims, half_words])
    turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    first = max(1, dims // 2)
    out = []
    for part in (turn[:, :first], turn[:, first:]):
        words = rng.normal(size=(part.shape[1], half_words))
        words /= np.maximum(np.linalg.norm(words, axis=0), 1e-300)
        out.append(part @ words / 2**0.5)
    return out[0], out[1]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way. Rows must not be zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def pairs_at(cosine: float, dims: int, n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors, and one at that cosine from each."""
    rng = np.random.default_rng([seed, dims])
    a, z = unit(rng.normal(size=(n, dims))), rng.normal(size=(n, dims))
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    return a, unit(cosine * a + (1 - cosine**2) ** 0.5 * z)


def missed(cosine: float, dims: int, half_words: int, least: int, trials: int) -> float:
    """Share of random pairs at that cosine without a filter in common."""
    a, b = pairs_at(cosine, dims, trials)
    return float(np.mean([not np.isin(x, y, assume_unique=True).any() for x, y in zip(decode_filters(a, half_words, least), decode_filters(b, half_words, least))]))


@lru_cache(maxsize=32)
def code_for(dims: int, vectors: int, cosine: float = THRESHOLD) -> tuple[int, int]:
    """(codewords of a half, filters that a vector takes at least) for so many vectors."""
    # Halves of one to three coordinates have room for few directions; more would only be equal ones.
    half, least = min(codewords_a_half(vectors), {0: 1, 1: 2, 2: 16, 3: 48}.get(dims // 2, 1 << 30)), FILTERS_LEAST
    while half > 1:
        trials = _TRIALS if half <= 4_000 else _TRIALS // 4
        if missed(cosine, dims, half, least, trials) <= MISSES:
            break
        if least < FILTERS_MOST:
            least = min(FILTERS_MOST, least * 3 // 2)
        else:
            half = half * 2 // 3
    return half, least


def decode_filters(vectors: np.ndarray, half_words: int, least_filters: int = FILTERS_LEAST) -> list[np.ndarray]:
    """The ascending filter numbers of each unit vector."""
    dims = vectors.shape[1]
    a, b = _code(dims, half_words)
    share = min(0.5, least_filters / half_words**2)
    threshold = NormalDist().inv_cdf(1 - share) / dims**0.5
    # The k-th best sum is one of those whose places in the two sorted lists multiply to at most k.
    k = min(least_filters, half_words**2)
    top = [(i, j) for i in range(min(k, half_words)) for j in range(min(k // (i + 1), half_words))]
    ti, tj = np.array([t[0] for t in top]), np.array([t[1] for t in top])
    out = []
    for x, y in zip(vectors @ a, vectors @ b):
        ox, oy = np.argsort(-x, kind="stable"), np.argsort(-y, kind="stable")
        sx, sy = x[ox], y[oy]
        least = min(threshold, np.partition(sx[ti] + sy[tj], len(ti) - k)[len(ti) - k]) - 1e-12  # sums round
        counts = np.searchsorted(-sy, sx - least, side="right")  # of second halves for each first half
        rows = int((counts > 0).sum())
        counts = counts[:rows]
        second = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        out.append(np.sort(np.repeat(ox[:rows], counts) * half_words + oy[second]).astype(np.int32))
    return out


def _decode_rows(codes: dict[int, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            values, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(lengths)
            filters: list = [None] * len(lengths)
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                for part in np.array_split(at, -(-len(at) // 2048)):
                    rows = values[(ends[part] - dims)[:, None] + np.arange(dims)]
                    for i, found in zip(part.tolist(), decode_filters(unit(rows), *codes[int(dims)])):
                        filters[i] = found
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(filters, pa.list_(pa.int32()))], names=[*batch.schema.names, "filters"])

    return run


def bucket_links(rep: np.ndarray, copies: np.ndarray, vectors: np.ndarray, side: np.ndarray, filters: list[np.ndarray],
                 own: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the vectors of one filter: those with links, the rows linked by pairs that share no
    earlier filter, and a vector of each one's local component. ``side`` is 2 for a whole
    bucket; else only pairs of a 0 and a 1 count."""
    near = vectors @ vectors.T >= threshold
    np.fill_diagonal(near, False)
    if (side != 2).any():
        near &= side[:, None] != side[None, :]
    used = np.flatnonzero(near.any(axis=1))
    if not len(used):
        return rep[:0], copies[:0], rep[:0]
    near = near[np.ix_(used, used)]
    # Pairs that share an earlier filter are counted there.
    earlier = [f[f < own] for f in (filters[i] for i in used)]
    names, place, n = np.unique(np.concatenate(earlier), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(used)), [len(f) for f in earlier])
    shared = np.cumsum(n > 1) - 1
    keep = n[place] > 1
    has = np.zeros((len(used), int((n > 1).sum())), np.float32)
    has[row[keep], shared[place[keep]]] = 1
    for at in range(0, has.shape[1], 4096):
        near &= has[:, at : at + 4096] @ has[:, at : at + 4096].T == 0
    linked = near @ copies[used]
    root = np.arange(len(used))
    while True:  # the least place among neighbours, and among theirs
        least = np.minimum(root, np.where(near, root[None, :], len(used)).min(axis=1))
        least = least[least]
        if (least == root).all():
            break
        root = least
    some = linked > 0
    return rep[used][some], linked[some], rep[used][root][some]


def _bucket_rows(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        out: list[tuple] = []

        def close():
            if len(held) > 1:
                for dims in {len(h[2]) for h in held}:
                    rows = [h for h in held if len(h[2]) == dims]
                    rep, copies, vectors, side, filters = zip(*rows)
                    out.append(bucket_links(np.array(rep), np.array(copies), unit(np.stack(vectors).astype(np.float64)), np.array(side), list(filters), last[0], threshold))

        def rows():
            parts = [np.concatenate([np.zeros(0, np.int64), *(o[i] for o in out)]).astype(np.int64) for i in range(3)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["rep", "links", "root"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("filter", "low", "high"))))
            rep, copies, side = (batch.column(c).to_pylist() for c in ("rep", "copies", "side"))
            vectors, filters = batch.column("embedding"), batch.column("filters")
            for i, key in enumerate(keys):
                if key != last:
                    close()
                    held, last = [], key
                held.append((rep[i], copies[i], vectors[i].values.to_numpy(zero_copy_only=False), side[i], filters[i].values.to_numpy(zero_copy_only=False)))
            yield rows()
        close()
        yield rows()

    return run


def near_vectors(table: DataFrame, work: str, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links (other rows whose vector has cosine ``threshold`` or more), component_id
    (the smallest vec_id that links reach) and kept (whether that is its own).

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a
    null id, link with nothing. Equal vectors are one class from the start, whose rows link with
    each other; vectors of different length don't link; an empty table gives no rows; other
    columns are left out. ``work`` is a fresh shared folder.
    """
    spark = table.sparkSession
    # Vectors of single precision travel as they are; cosines are of doubles.
    kind = "float" if table.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    valid = rows.where(good)
    classes = valid.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).select("rep", "copies", "embedding")
    classes = saved(classes, "vector-classes")
    # A code for each length of vectors; lengths are few, and a row each comes to the driver.
    sizes = classes.groupBy(F.size("embedding").alias("dims")).count().collect()
    codes = {r["dims"]: code_for(r["dims"], r["count"], max(threshold, 0.0)) for r in sizes}
    classes.mapInArrow(tidy(_decode_rows(codes), 2000), _DECODED.format(kind)).write.parquet(work)
    decoded = spark.read.schema(_DECODED.format(kind)).parquet(work)
    members = decoded.select("rep", "copies", "embedding", "filters", F.explode("filters").alias("filter"))
    sizes = saved(decoded.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("n")) \
        .where(F.col("n") > CHUNK).select("filter", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "bucket-sizes")
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)  # at most BROADCAST_ROWS pairs of integers
    # A large bucket is cut into chunks, and each pair of chunks is compared on its own.
    mine = F.pmod(F.xxhash64("rep", "embedding"), F.coalesce("chunks", F.lit(1))).cast("int")
    members = members.join(sizes, "filter", "left").withColumn("mine", mine) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).cast("int")
    members = members.select("filter", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), side.alias("side"),
                             "rep", "copies", "embedding", "filters")
    # A bucket's rows are hashed to one partition and stand side by side in it.
    found = saved(members.repartition("filter", "low", "high").sortWithinPartitions("filter", "low", "high") \
        .mapInArrow(_bucket_rows(threshold), "rep long, links long, root long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    label = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    facts = classes.join(links, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = valid.join(facts, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
