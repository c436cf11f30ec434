import random

import corpus_pipeline
from tidewater.llm.queries import ORACLES, QUERIES


def test_stages_drop_what_they_should_and_keep_the_rest(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcdeghinorst") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage = text(70)
    rows = [(i, text(150)) for i in range(60)]
    near = rows[3][1].split(" ")
    near[75] = "changed"
    rows += [(100, rows[2][1]), (101, " ".join(near)), (102, f"{text(40)} {passage} {text(40)}"), (103, f"{text(50)} {passage} {text(30)}"), (104, "too short"), (105, None)]
    bad = [(200 + i, " ".join(w + "$$$" for w in text(60).split(" "))) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows + bad], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(200 + i, 0, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame, kept = docs, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        frame = spark.read.parquet(f"{tmp_path}/{number}")
        assert frame.columns == docs.columns
        kept.append({r.doc_id: r for r in frame.collect()})
    clean = set(range(60))
    assert set(kept[0]) == clean | {100, 101, 102, 103} and set(kept[1]) == clean | {102, 103} == set(kept[2])
    assert all(kept[2][i].text == dict(rows)[i] for i in clean | {102})
    assert len(kept[2][103].text.split()) < 105 and kept[2][103].n_chars == len(kept[2][103].text)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == clean | {102, 103}


def test_near_copies_go_by_row(spark, tmp_path):
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choice("abcdeghinorst") for _ in range(rng.randint(2, 8))) for _ in range(120))
    first, second, clean, other = text(), text(), text(), text()
    near = first.rsplit(" ", 1)[0] + " changed"
    rows = [(1, first, "b"), (2, second, "b"), (2, second, "a"), (2, second, "b"), (3, clean, "b"), (3, near, "b"), (4, other, "b"), (None, first, "b"), (None, first, "b")]
    frame = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/docs")
    out = corpus_pipeline.near_copies(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    assert out.columns == frame.columns
    want = [(1, first, "b"), (2, second, "a"), (3, clean, "b"), (4, other, "b"), (None, first, "b"), (None, first, "b")]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=key) == want


def test_stages_with_odd_columns_and_empty_tables(spark, tmp_path):
    """Null values, clashing names, a map column, no n_chars, no rows: every stage has a result."""
    rng = random.Random(3)
    text = lambda: " ".join("".join(rng.choice("abcdeghinorst") for _ in range(rng.randint(2, 8))) for _ in range(60))
    texts = [text() for _ in range(6)]
    schema = "doc_id long, text string, key string, tag int, row string, _row int, _copy string, _rest int, _quality int, _chunks int, count int, m map<string,int>"
    rows = [(i, t, "k", 1, "r", 2, "c", 3, 4, 5, 6, {"a": i}) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "k", 1, "r", 2, "c", 3, 4, 5, 6, {"a": 9}), (None, texts[1], *[None] * 10), (7, None, *[None] * 10), (8, "", *[None] * 10), (None, None, *[None] * 10)]
    spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, held in (("some", rows), ("none", []), ("nulls", [(None,) * 12] * 3)):
        spark.createDataFrame(held, schema).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        for _, stage in corpus_pipeline.STAGES[:3]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        near = corpus_pipeline.near_copies(spark, docs, str(tmp_path)).collect()
        passages = corpus_pipeline.repeated_passages(spark, docs, str(tmp_path)).collect()
        packed = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
        assert len(passages) == len(held) and (len(packed) >= len(held))
        if name == "some":
            assert sorted((r.doc_id is None, r.doc_id or 0) for r in near) == [(False, i) for i in (0, 1, 2, 3, 4, 5, 7, 8)] + [(True, 0), (True, 0)]
            assert [r.m for r in near if r.doc_id == 0] == [{"a": 0}]


def test_registered_queries():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "packing"]
