import random

import numpy as np
import pyarrow as pa

from tidewater.llm import chunk_dedup
from tidewater.llm.chunk_dedup import MIN_WORDS, Chunks, gear_hash, remove_repeats, removed_runs

SCHEMA = "doc_id long, text string, numbers int, key string, tag string"


def brute(docs):
    """Cleaned texts: chunks compared by their bytes, one document after the other."""
    seen, out = {}, {}
    for key, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        data = (text or "").encode()
        chunks = Chunks([data])
        flags = np.zeros(len(chunks.starts), bool)
        for i, (a, b) in enumerate(zip(chunks.starts, chunks.ends)):
            flags[i] = seen.setdefault(data[a:b], (key, text, i)) != (key, text, i)
        kept, at = b"", 0
        for s, e in removed_runs(flags, chunks.words, MIN_WORDS):
            kept += data[at : chunks.starts[s]]
            at = chunks.ends[e - 1]
        out[key, text] = None if text is None else (kept + data[at:]).decode()
    return out


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgéü") for _ in range(rng.randint(1, 8))) for _ in range(n))


def test_gear_hash_is_the_rolling_one():
    data = np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    from tidewater.llm.chunk_dedup import WINDOW, _gears

    got, h = gear_hash(data), 0
    for i in range(len(data)):
        h = sum(int(_gears()[data[i - j]]) << j for j in range(min(WINDOW, i + 1))) & 0xFFFFFFFF
        assert int(got[i]) == h


def test_chunks_cover_texts_and_don_t_depend_on_neighbours():
    rng = random.Random(2)
    texts = [words(rng, rng.randint(0, 200)).encode() for _ in range(30)] + [b"", b" ", "日本語".encode() * 500, b"x" * 3000, b"\n\n a"]
    together = Chunks(texts)
    for i, text in enumerate(texts):
        alone = Chunks([text])
        a, b, begin = together.before[i], together.before[i + 1], sum(len(t) + 1 for t in texts[:i])
        assert (together.starts[a:b] - begin).tolist() == alone.starts.tolist() and (together.ends[a:b] - begin).tolist() == alone.ends.tolist()
        assert b"".join(text[s:e] for s, e in zip(alone.starts, alone.ends)) == text


def test_shared_passages_go_and_the_rest_stays(spark):
    rng = random.Random(3)
    passage = words(rng, 60)
    line = words(rng, 9) + ".\n"
    docs = []
    for i in range(60):
        own = words(rng, 80).split(" ")
        at = rng.randrange(80)
        text = " ".join(own[:at]) + (f" {passage} " if i % 3 == 0 else f"\n{line}") + " ".join(own[at:])
        docs.append((i * 7, text))
    docs += [(5, None), (6, ""), (8, docs[1][1]), (None, docs[1][1]), (1000, words(rng, 30000)), (1001, "日本語" * 400), (1002, "語" + "日本語" * 400)]
    frame = spark.createDataFrame([(d, t, 1, "k", "t") for d, t in docs + docs[:3]], SCHEMA).repartition(4)
    got = remove_repeats(frame).collect()
    want = brute(docs)
    originals = dict(docs)
    assert len(got) == len(docs) + 3
    cleaned = {}
    for r in got:
        cleaned.setdefault(r.doc_id, r.text)
        assert r.text == want[r.doc_id, originals[r.doc_id]]
        removed = b"".join(originals[r.doc_id].encode()[x.start : x.end] for x in r.chunks.removed) if r.text is not None else b""
        assert len(removed) + len((r.text or "").encode()) == len((originals[r.doc_id] or "").encode())
    assert passage in cleaned[0] and all(len(cleaned[i].split()) < 100 for i in range(21, 400, 21))
    assert all(cleaned[i * 7] == docs[i][1] for i in range(60) if i % 3)
    assert cleaned[7] == docs[1][1] and cleaned[8] == ""  # copies: the smallest id stays


def test_only_verbatim_repeats_go(spark):
    """A small vocabulary: nearly every chunk repeats somewhere, hardly any 20 words do."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(9)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(70) for _ in range(8)]
    docs = {}
    for i in range(400):
        docs[i] = prose(60) + (passages[i % 8] if i % 5 == 0 else []) + prose(60)
    frame = spark.createDataFrame([(i, " ".join(t), 1, "k", "t") for i, t in docs.items()], SCHEMA).repartition(3)
    seen, repeats = set(), {}  # places of words in 20 words that stood before
    for i in sorted(docs):
        for at in range(len(docs[i]) - MIN_WORDS + 1):
            window = tuple(docs[i][at : at + MIN_WORDS])
            if window in seen:
                repeats.setdefault(i, set()).update(range(at, at + MIN_WORDS))
            seen.add(window)
    gone = {}
    for r in remove_repeats(frame).collect():
        data = " ".join(docs[r.doc_id]).encode()
        for x in r.chunks.removed:
            first = data[: x.start].count(b" ")
            gone.setdefault(r.doc_id, set()).update(range(first, first + len(data[x.start : x.end].split())))
    assert all(places <= repeats.get(i, set()) for i, places in gone.items())
    later = [i for i in docs if i % 5 == 0 and i >= 40]
    assert set(gone) == set(later) and all(len(gone[i]) > 45 for i in later)


def test_spans_cover_each_repeated_stretch():
    rng = random.Random(7)
    texts = [words(rng, rng.randint(0, 120)).encode() for _ in range(40)] + [b"", ("日本語" * 300).encode(), b"x" * 900]
    chunks = Chunks(texts)
    first, last, before = chunks.spans(MIN_WORDS)
    for i in range(len(texts)):
        a, b = int(chunks.before[i]), int(chunks.before[i + 1])
        want = [(k, m) for k in range(a, b) for m in range(k, b) if (n := chunks.words[k : m + 1]).sum() >= MIN_WORDS and min(n[1:].sum(), n[:-1].sum()) < MIN_WORDS]
        assert list(zip(first[before[i] : before[i + 1]], last[before[i] : before[i + 1]])) == want


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_tasks_pass_spans_on_before_they_are_many():
    """However many spans a task finds, it holds and sends some 2**18 of them at once, all in the end."""
    rng = np.random.default_rng(5)
    vocabulary = np.array([f"w{i}x" for i in range(30_000)])
    texts = [" ".join(vocabulary[rng.integers(0, len(vocabulary), 4000)]) for _ in range(360)]
    batch = pa.record_batch({"key": pa.array(range(360), pa.int64()), "tag": pa.array([7] * 360, pa.int64()), "text": texts})
    sent = [sum(len(d) // 8 for d in b.column("docs").to_pylist()) for b in chunk_dedup._entries(8, MIN_WORDS)(iter([batch]))]
    assert sum(sent) == sum(len(Chunks([t.encode()]).spans(MIN_WORDS)[0]) for t in texts) > 500_000
    assert max(sent) < 400_000
