import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import range_coder
from tidewater.llm.range_coder import decode_ids, encode_ids, read_blocks, read_ids, write_block, write_ids
from tidewater.llm.storage import shared_folder
from tidewater.llm.tokens import BpeEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 900), st.sampled_from([1, 2, 7, 300, 50257]), st.integers(0, 2**32 - 1), st.booleans())
def test_round_trip(n, alphabet, seed, repeats):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, alphabet, n).astype(np.uint32)
    if repeats:
        ids = np.resize(ids[: n // 3 + 1], n)
    assert (decode_ids(encode_ids(ids, alphabet), n, alphabet) == ids).all()


def test_many_lanes_and_compression():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 50257, (200, 6)).astype(np.uint32)
    ids = words[rng.zipf(1.3, 60_000) % 200].ravel()[:200_000]
    code = encode_ids(ids, 50257)
    assert (decode_ids(code, len(ids), 50257) == ids).all() and len(code) < len(ids) * 0.8


def test_a_whole_block_of_words():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 50257, (5000, 4)).astype(np.uint32)
    ids = words[rng.zipf(1.2, 600_000) % 5000].ravel()
    ids = ids[: 8192 * 256 + 5000]
    code = encode_ids(ids, 50257)
    shares = np.bincount(ids) / len(ids)
    entropy = -(shares[shares > 0] * np.log2(shares[shares > 0])).sum()
    assert (decode_ids(code, len(ids), 50257) == ids).all() and len(code) * 8 < len(ids) * entropy * 0.6
    with pytest.raises(ValueError):
        encode_ids(np.array([1 << 28], np.uint32), (1 << 28) + 1)


def test_blocks_are_checked_and_read_alone():
    ids = np.arange(1000, dtype=np.uint32) % 37
    one, two = write_block(ids, [5, None], [400, 600], True), write_block(ids[:10], [7], [10], False)
    assert [(b[1], b[2], b[3]) for b in read_blocks(memoryview(one + two))] == [([5, None], [400, 600], True), ([7], [10], False)]
    assert (next(read_blocks(memoryview(two)))[0] == ids[:10]).all()
    for at in (10, 60, len(one) - 2):
        broken = bytearray(one)
        broken[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            list(read_blocks(memoryview(bytes(broken))))


def test_files_in_document_order(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(i, f"text number {i} " * (i % 40), "x") for i in range(0, 600, 2)]
    rows += [(7, None, None), (9, "", "x"), (11, "word " * 9000, "x"), (12, "again", "x"), (12, "again", "x"), (12, "other", "x"), (None, "no id", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, name string").repartition(4)
    folder = shared_folder(spark, "test")
    files = write_ids(frame, PATH, folder, block_tokens=1500, file_bytes=3000)
    assert files.agg({"documents": "sum"}).collect()[0][0] == len(rows) and files.count() > 3
    got = read_ids(spark, folder).orderBy("start").collect()
    start, seen = 0, []
    for r in got:
        assert r.start == start
        start += len(r.ids) // 4
        seen.append((r.doc_id, zlib.crc32(r.ids)))
    want = [(i, zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for i, t, _ in rows]
    assert [s[0] for s in seen] == sorted((w[0] for w in want), key=lambda d: (d is not None, d))
    assert sorted(seen, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert write_ids(spark.createDataFrame([], "doc_id long, text string"), PATH, shared_folder(spark, "test")).isEmpty()


def test_words_go_to_the_model_alone(monkeypatch):
    """New words are split already, so the library's whole chain doesn't see them again; ids stay the library's."""
    enc, whole = BpeEncoder(PATH), Tokenizer.from_file(PATH)
    words = [w for c in range(0x20, 0x3000) if (w := chr(c)).isprintable() and c != 0x20] + [" the", "don", "'t", "   ", "\t", "\x00\x7f", "\U0001f600é"]
    want = [whole.encode(w, add_special_tokens=False).ids for w in words]
    monkeypatch.setattr(enc, "tokenizer", None)
    ids, counts = enc.encode_words(words)
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    text = "Ein Text, dann\n\n  noch  einer: don't <|endoftext|> été \U0001f600\x00"
    assert BpeEncoder(PATH).encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n,lanes", [(1, 1), (12, 4), (13, 4), (7, 7), (15, 4)])
def test_lanes_by_step_and_back(n, lanes):
    ids = np.arange(n, dtype=np.int32)
    grid = range_coder._by_step(ids, lanes, -(-n // lanes))
    cuts = np.split(ids, np.cumsum([n // lanes + (k < n % lanes) for k in range(lanes)])[:-1])
    assert all(grid[: len(c), k].tolist() == c.tolist() for k, c in enumerate(cuts))
    assert range_coder._by_lane(grid, n).tolist() == ids.tolist()


def test_symbols_of_values():
    rng = np.random.default_rng(3)
    edges = np.cumsum(rng.integers(1, 9, 500)).astype(np.int32)
    values = rng.integers(0, edges[-1], 3000).astype(np.int32)
    assert range_coder._symbols(edges, values).tolist() == np.searchsorted(edges, values, side="right").tolist()
