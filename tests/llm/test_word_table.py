import random

import public_tokenizers
from tokenizers import Tokenizer

from tidewater.llm.packing import best_fit_decreasing, pack
from tidewater.llm.tokens import BpeEncoder
from tidewater.llm.word_table import decode, encode

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, decoded string, length int"


def texts(seed=1, n=300):
    rng = random.Random(seed)
    parts = [*"abz'stmdrelv  \n\t'12é中 !?.,<|>_\x00\x01\x1c٣ⅷ²", "\U0001f600", "<|endoftext|>", "'re", "'ll", "'ve", " the"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        None, "", " ", "\n", "'s", "a" * 5000, "<|endoftext|>", "x <|endoftext|><|endoftext|> y\n\n"]


def test_batch_encoder_gives_the_library_ids():
    library, cases = Tokenizer.from_file(PATH), texts(n=5000)
    ids, at = BpeEncoder(PATH).encode(cases)
    for i, text in enumerate(cases):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_encode_and_decode_through_tables(spark):
    library, cases = Tokenizer.from_file(PATH), texts()
    rows = [(i if i % 50 else None, t, "x", "y", 1) for i, t in enumerate(cases)] + [(3, "twice twice", None, None, None)] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).checkpoint()
    got = sorted((str(r.doc_id), r.ids, r.decoded) for r in decode(encode(docs, PATH), PATH).collect())
    want = []
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(key), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_decode_of_broken_bytes(spark):
    library = Tokenizer.from_file(PATH)
    rows = [([random.Random(i).randrange(50257) for _ in range(20)],) for i in range(50)] + [([],), (None,)]
    for r in decode(spark.createDataFrame(rows, "ids array<int>"), PATH).collect():
        assert r.decoded == library.decode(r.ids or [], skip_special_tokens=False)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert encode(empty, PATH).isEmpty() and pack(empty, PATH).isEmpty()


def test_packing_keeps_every_id_once(spark):
    library, cases = Tokenizer.from_file(PATH), texts(n=200)
    rows = [(i, t, None, None, i) for i, t in enumerate(cases)] + [(None, "a b", None, None, 0)] * 2
    pieces = pack(spark.createDataFrame(rows, SCHEMA).repartition(2), PATH, window=64, buffer_tokens=2000).collect()
    documents = {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.start)):
        documents.setdefault(p.doc_id, []).append(p)
    for i, text in enumerate(cases):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert b"".join(bytes(p.ids) for p in documents[i]) == b"".join(x.to_bytes(4, "little") for x in ids)
        assert [p.start for p in documents[i]] == list(range(0, len(ids), 64)) and {p.doc_tokens for p in documents[i]} == {len(ids)}
    assert len(documents[None]) == 2
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 64


def test_best_fit_takes_the_tightest_window():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(200):
        lengths = rng.integers(1, 33, rng.integers(1, 60))
        at, offset, used = best_fit_decreasing(lengths, 32)
        room, want = [], np.zeros(len(lengths), int)
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in room if r >= lengths[i]]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - lengths[i])
            else:
                room.append(32 - lengths[i])
        assert used == len(room) and sorted(32 - np.bincount(at, lengths, used).astype(int)) == sorted(room)
