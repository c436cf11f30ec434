import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import interleave, suffix_merge
from tidewater.llm.interleave import gram_hashes, merge_transforms, repeated_windows, shard_transform
from tidewater.llm.queries import op12_suffix_merge
from tidewater.llm.suffix_merge import remove_long_repeats

SCHEMA = "doc_id long, text string, place int, one string, kind string, row int"


def brute(texts, length):
    """(removed bytes' flags) of each text, by all windows."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                flags[i : i + length] = True
        out.append(flags)
    return out


def expected(rows, length):
    out = []
    for (doc_id, text, *_), flags in zip(rows, brute([r[1] for r in rows], length)):
        data = np.frombuffer((text or "").encode(), np.uint8)
        spans = int((np.diff(np.concatenate([[0], flags.astype(int)])) > 0).sum())
        out.append((doc_id, len(data), int(flags.sum()), spans, hashlib.sha256(data[~flags].tobytes()).hexdigest()))
    return sorted(out, key=str)


def sentences(rng, n):
    return " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def corpus(rng):
    shared = [sentences(rng, 80) for _ in range(6)]
    texts = [sentences(rng, rng.randint(0, 300)) for _ in range(40)]
    for _ in range(40):  # passages in other texts, whole or in part, more than once
        parts = [sentences(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(1, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, 200)
            parts += [p[a : a + rng.randint(380, 600)], sentences(rng, rng.randint(0, 40))]
        texts.append(" ".join(parts))
    for _ in range(20):  # near copies
        t = texts[rng.randint(0, 5)]
        i = rng.randint(0, max(0, len(t) - 1))
        texts.append(t[:i] + "!" + t[i + 1 :])
    texts += [texts[3]] * 5 + ["a" * 3000, "b" * 399, "c" * 400, "d" * 401, "xy" * 500, "日本" * 300, "", None, None, "z" * 400, "z" * 400]
    return [(i, t, 1, "o", "k", 2) for i, t in enumerate(texts)]


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in op12_suffix_merge(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_equals_brute_force(spark, tmp_path):
    rows = corpus(random.Random(1))
    rows += [rows[50], (None, rows[2][1], None, None, None, None), (3, rows[60][1], 0, "o", "k", 2)]
    assert run(spark, tmp_path, rows) == expected(rows, 400)


def test_crowded_keys_and_many_buckets(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(suffix_merge, "_CROWDED", 3)
    monkeypatch.setattr(suffix_merge, "_BUCKET_BYTES", 5000)
    monkeypatch.setattr(suffix_merge, "_FLUSH_RUNS", 30)
    rows = corpus(random.Random(2))
    assert run(spark, tmp_path, rows) == expected(rows, 400)


def test_texts_are_cut_once_for_all_keys(spark, monkeypatch, tmp_path):
    """With usual and crowded keys, the texts are joined with their runs and cut once, not for each kind."""
    monkeypatch.setattr(suffix_merge, "_CROWDED", 3)
    calls, cut = [], suffix_merge._cut
    monkeypatch.setattr(suffix_merge, "_cut", lambda length: calls.append(length) or cut(length))
    rows = corpus(random.Random(2))
    assert run(spark, tmp_path, rows) == expected(rows, 400)
    assert calls == [400]


@pytest.mark.parametrize("length,depth", [(16, 8), (8, 4), (24, 2), (12, 12)])
def test_other_lengths(spark, length, depth):
    rng = random.Random(length)
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 60))), 1, "o", "k", 2) for i in range(120)]
    got = remove_long_repeats(spark.createDataFrame(rows, SCHEMA), length, depth).collect()
    flags = dict(zip((r[0] for r in rows), brute([r[1] for r in rows], length)))
    for r in got:
        mine = np.zeros(r["repeats"]["n_bytes"], bool)
        for s in r["repeats"]["removed"]:
            mine[s["start"] : s["end"]] = True
        assert (mine == flags[r["doc_id"]]).all() and r["repeats"]["kept"] == bytes(np.frombuffer(r["text"].encode(), np.uint8)[~mine])


def test_no_rows_and_no_long_texts(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    rows = [(1, None, 1, "o", "k", 2), (2, "short", 1, "o", "k", 2)]
    assert run(spark, tmp_path / "b", rows) == expected(rows, 400)


def test_a_very_long_text(spark, tmp_path):
    rng = random.Random(5)
    text = sentences(rng, 150_000)
    rows = [(1, text + text[1000:5000], 1, "o", "k", 2), (2, text[7000:7500], 1, "o", "k", 2)]
    assert run(spark, tmp_path, rows) == expected(rows, 400)


def test_merged_transform_is_that_of_all_strings():
    """Against sorting all suffixes: shards' rows, and symbols shared with the row above."""
    rng = random.Random(7)
    step, depth = 2, 5
    for _ in range(30):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 25))).encode() for _ in range(rng.randint(1, 6))]
        hashes = sorted({s[i : i + step] for s in strings for i in range(len(s) - step + 1)})
        parts, suffixes = [], []
        for shard, s in enumerate(strings):
            symbols = np.array([hashes.index(s[i : i + step]) + 1 if i + step <= len(s) else 0 for i in range(len(s) + 1)])
            order, transform = shard_transform(symbols, np.full(len(s) + 1, len(s)), step, depth)
            parts.append(transform)
            suffixes += [(tuple(symbols[i : len(s) + 1 : step][:depth].tolist()), shard) for i in range(len(s) + 1)]
        cut = lambda t: t[: t.index(0)] if 0 in t else t
        want = sorted((cut(t), shard) for t, shard in suffixes)
        shard, shared = merge_transforms(parts, depth)
        for i, (row, _) in enumerate(want):
            both = zip(row, want[i - 1][0]) if i else ()
            common = 0
            for a, b in both:
                if a != b:
                    break
                common += 1
            if row:  # empty suffixes are not told apart, and equal ones share all that is looked at
                assert shared[i] == (depth if i and row == want[i - 1][0] else common)
        for key in {r for r, _ in want}:
            at = [i for i, (r, _) in enumerate(want) if r == key]
            assert sorted(shard[at].tolist()) == sorted(want[i][1] for i in at)


def test_repeated_windows_in_shards(monkeypatch):
    monkeypatch.setattr(interleave, "_SHARD_ROWS", 60)
    rng = random.Random(9)
    for _ in range(150):
        letters = rng.choice(["ab", "abcd", "a"])
        base = "".join(rng.choice(letters) for _ in range(60))
        strings = [(base[rng.randint(0, 50) :] if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))).encode() for _ in range(rng.randint(1, 8))]
        for length, depth in ((8, 4), (16, 8), (8, 8), (12, 4)):
            seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
            for s, got in zip(strings, repeated_windows(strings, length, depth)):
                assert got.tolist() == [seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)]


def test_gram_hashes():
    data = np.frombuffer(b"abcabcabcxabc" * 3, np.uint8)
    for gram in (1, 2, 3, 7, 10, 39, 40):
        got = gram_hashes(data, gram)
        parts = [bytes(data[i : i + gram]) for i in range(len(data) - gram + 1)]
        assert len(got) == len(parts) and len(set(got.tolist())) == len(set(parts))
