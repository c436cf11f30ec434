import hashlib
import random
import zlib

from tidewater.llm.merkle_manifest import FAN_OUT, build_manifest, fold, proof_text, prove
from tidewater.llm.queries import LEAF_COLUMNS, op13_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, path string, sid int, idx int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def up(nodes):
    """Levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + FAN_OUT]) for i in range(0, len(levels[-1]), FAN_OUT)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // FAN_OUT * FAN_OUT
        out.append((nodes[start:i], nodes[i + 1 : start + FAN_OUT]))
        i //= FAN_OUT
    return out


def brute(docs):
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    trees, rows = {}, []
    for source in sorted({d[1] for d in docs}, key=first):
        mine = sorted((d for d in docs if d[1] == source), key=lambda d: (first(d[0]), leaf(d, d[4])))
        trees[source] = (mine, up([leaf(d, d[4]) for d in mine]))
    top = up([levels[-1][0] for _, levels in trees.values()])
    for sid, (mine, levels) in enumerate(trees.values()):
        for i, d in enumerate(mine):
            path = way(levels, i) + way(top, sid)
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0 and d[4] is not None
            node = leaf(d, d[4].replace("\n", "") if hit else d[4])
            for left, right in path:
                node = sha(*left, node, *right)
            rows.append((d[0], leaf(d, d[4]), levels[-1][0], top[-1][0], sha(*[x for left, right in path for x in left + right]), node, node == top[-1][0]))
    return sorted(rows, key=str)


def docs(rng, sizes):
    out = []
    for source, n in sizes.items():
        for i in range(n):
            out.append((i * 7 + rng.randint(0, 6), source, rng.choice(["en", None]), i, rng.choice(["a\nb", "", None, "é\n" * 9, "x" * 50_000]), "clash", 1, 2))
    return out


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle_manifest(spark, str(tmp_path))
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_equals_brute_force(spark, tmp_path):
    rng = random.Random(1)
    rows = docs(rng, {"a": 82, "b": 1, None: 4, "é": 3, "Z": 10, "": 2})
    rows += [rows[5], rows[5], rows[5], (None, "a", None, None, None, "p", 0, 0), (None, None, None, None, "t\n", "p", 0, 0)]
    got = run(spark, tmp_path, rows)
    assert got == brute(rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_one_source_one_row_and_no_rows(spark, tmp_path):
    one = [(4, "s", "en", 1, "a\nb", "", 0, 0)]
    assert run(spark, tmp_path / "one", one) == brute(one)
    assert run(spark, tmp_path / "none", []) == []


def test_some_leaves_only(spark):
    rows = docs(random.Random(3), {"a": 40, "b": 5, "c": 1})
    frame = spark.createDataFrame(rows, SCHEMA)
    manifest = build_manifest(frame, LEAF_COLUMNS, "doc_id", "source")
    whole = {(r["grp"], r["id"], r["leaf"]): r["path"] for r in prove(manifest).collect()}
    wanted = spark.createDataFrame([(rows[3][0],), (rows[44][0],), (10**9,)], "anything long")
    some = prove(manifest, wanted).select("*", fold("path", "leaf").alias("root"), proof_text("path").alias("t")).collect()
    ids = {rows[3][0], rows[44][0]}
    assert {(r["grp"], r["id"]) for r in some} == {(g, i) for g, i, _ in whole if i in ids}
    assert all(r["path"] == whole[r["grp"], r["id"], r["leaf"]] and r["root"] == manifest.root for r in some)


def test_records_are_stored_by_content(spark):
    rows = [(1, "s", "en", 1, "t", "", 0, 0)] * 27
    manifest = build_manifest(spark.createDataFrame(rows, SCHEMA), LEAF_COLUMNS, "doc_id", "source")
    assert [level.select("digest").distinct().count() for level in manifest.levels] == [1, 1, 1]
    assert prove(manifest).count() == 27
