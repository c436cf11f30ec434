import random

import numpy as np
import pytest

from tidewater.llm.components import connected_components
from tidewater.llm.parity_join import all_tokens, band_words, ngram_components, similar
from tidewater.llm.storage import shared_folder

SCHEMA = "doc_id long, text string, token long, a long, component_id string"


def shingles(text):
    words = tuple((text or "").encode().lower().split())
    return frozenset(words[i : i + 5] for i in range(max(len(words) - 4, min(len(words), 1)))) if len(words) != 0 else frozenset()


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def corpus(seed):
    """Texts with near copies around the threshold, a shared passage and chains of copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice([3, 5, 7, 8, 9, 12, 20, 45, 90, 200]))]
        if rng.random() < 0.3:
            at = rng.randrange(len(base) + 1)
            base[at:at] = passage
        out.append(base)
        for _ in range(rng.randrange(5)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(base) // 40, len(base) // 25])):
                kind, at = rng.randrange(3), rng.randrange(len(copy))
                if kind == 0:
                    copy[at] = word()
                elif kind == 1:
                    copy.insert(at, word())
                elif len(copy) > 1:
                    del copy[at]
            out.append(copy)
            if rng.random() < 0.4:
                base = copy
    rng.shuffle(out)
    texts = [rng.choice([" ", "\n", "\t"]).join(w.upper() if rng.random() < 0.2 else w for w in words) for words in out]
    return texts + ["", None, " \n", "One", "one", "a b c d", "A b C d", "a b c", "é x é"]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    docs = [(i * 3, t) for i, t in enumerate(corpus(seed))]
    frame = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], SCHEMA).repartition(4).checkpoint()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(frame, shared_folder(spark, "test")).collect())
    assert got == brute(docs)


def test_group_around_a_centre_that_links_with_few(spark):
    """Many different texts share most words of one passage; only some are similar."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(100)]
    docs = [(i, " ".join(passage[:90] + [f"{i % 40}x{k}" for k in range(rng.choice([2, 12, 30]))])) for i in range(160)]
    frame = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], SCHEMA).repartition(3).checkpoint()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(frame, shared_folder(spark, "test")).collect())
    assert got == brute(docs)


def test_nulls_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, 1, 1, "x"), (5, text, 1, 1, "x"), (5, text, 1, 1, "x"), (2, text, 1, 1, "x"), (7, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).checkpoint()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(frame, shared_folder(spark, "test")).collect()), key=str)
    assert got == sorted([(None, 26, None), (5, 26, 2), (5, 26, 2), (2, 26, 2), (7, 0, 7)], key=str)
    assert ngram_components(spark.createDataFrame([], SCHEMA), shared_folder(spark, "test")).isEmpty()


def test_similar_sets_share_a_token():
    rng = np.random.default_rng(4)
    pairs = 0
    for _ in range(3000):
        n = int(rng.integers(4, 120))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.delete(x, rng.choice(len(x), rng.integers(0, max(1, len(x) // 8) + 1), replace=False))
        y = np.unique(np.concatenate([y, rng.integers(0, 1 << 63, rng.integers(0, max(1, len(x) // 8) + 1)).astype(np.uint64)]))
        if similar(x, y):
            pairs += 1
            tokens = [set(np.concatenate(all_tokens(s)).tolist()) if len(s) > 3 else set() for s in (x, y)]
            assert np.array_equal(x, y) or tokens[0] & tokens[1]
    assert pairs > 500


def test_difference_bound_of_bands():
    bounds = [1]
    while len(bounds) < 40:
        bounds.append(5 * bounds[-1] // 4 + 1)
    for band in range(30):
        need, words = band_words(band)
        small, large = bounds[band + 1] - 1, 5 * (bounds[band + 1] - 1) // 4
        assert need > (small + large) // 9 and words > need


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(999, i) for i in range(500, 700)] + [(1, 1)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 401)}, **{i: 500 for i in [*range(500, 700), 999]}}
