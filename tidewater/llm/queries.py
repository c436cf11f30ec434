"""Registered queries of the training-data operators, with production parameters.

Each reads its whole table, applies its operator and derives the contract's columns from the
operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_dedup import remove_repeats
from .merkle_manifest import build_manifest, fold, leaf_digest, proof_text, prove
from .packing import pack
from .parity_join import ngram_components
from .page_diff import extract_text
from .quality_trees import COUNTS, quality_rules, train
from .range_coder import read_ids, write_ids
from .spherical_caps import THRESHOLD, near_vectors
from .storage import shared_folder
from .suffix_merge import LENGTH, remove_long_repeats
from .url_rules import LOWER, PATTERN_RULES, UPPER, host_rule, judge_urls
from .warc import read_warc, write_warc
from .whitening import fit_whitening, identity_error, whiten
from .word_table import decode, encode

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), BYTE_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# The rules of the contract.
HOST_RULES = (host_rule("allow", "org/"), host_rule("block", "example.org/es/"), host_rule("block", "example.org/en/1"),
              host_rule("allow", "com/fr/"), host_rule("block", "com/de/"))


def op1_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), shared_folder(spark, "vectors"))


def op2_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "ids")
    if write_ids(table(spark, sf_dir, "documents"), BYTE_BPE, folder).isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_ids(spark, folder).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, HOST_RULES + PATTERN_RULES)
    rule = F.when(F.col("rule").isin([r.name for r in HOST_RULES]), F.col("rule"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    if write_warc(table(spark, sf_dir, "pages"), folder).isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    records = read_warc(spark, folder, f"{folder}-candidates")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents"), BYTE_BPE), BYTE_BPE)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *(f"quality.{c}" for c in (*COUNTS, "base_failed", "kept")))


def op7_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(table(spark, sf_dir, "pages"), shared_folder(spark, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_shared", "n_marked")


def op8_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), shared_folder(spark, "shingles"))


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("chunks.removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cleaned.select("doc_id", "text", "chunks.n_chunks", "chunks.n_repeated", removed.alias("removed_bytes"),
                          F.transform("chunks.removed", lambda x: x["start"]).alias("removed_from"),
                          F.transform("chunks.removed", lambda x: x["end"]).alias("removed_to"))


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(rows)
    if model is None or not len(model.values):
        return spark.createDataFrame([], WHITENED)
    shares = F.array(*[F.lit(v) for v in model.explained])
    by_row = whiten(rows.select("vec_id", "embedding"), model).select(
        "vec_id", F.col("whitening.deviation").try_cast("long").alias("deviation"), F.posexplode("whitening.whitened").alias("at", "whitened"))
    return by_row.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                         shares[F.col("at")].alias("explained"), F.lit(identity_error(rows, model)).alias("identity_error"))


def op12_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_long_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("repeats.removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cleaned.select("doc_id", "repeats.n_bytes", removed.alias("n_removed"), F.size("repeats.removed").cast("long").alias("n_spans"),
                          F.sha2("repeats.kept", 256).alias("kept_sha256"))


# The columns of a leaf.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Tampering takes the line ends out of every other document's text.
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    held = leaf_digest([tampered if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    manifest = build_manifest(docs, LEAF_COLUMNS, "doc_id", "source", {"held": held})
    proven = prove(manifest).select(F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).alias("root"),
                                    F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), fold(F.col("path"), F.col("held")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spherical_caps": op1_spherical_caps,
    "op2_range_coder": op2_range_coder,
    "op3_url_rules": op3_url_rules,
    "op4_warc": op4_warc,
    "op5_word_table": op5_word_table,
    "op6_quality_trees": op6_quality_trees,
    "op7_page_diff": op7_page_diff,
    "op8_parity_join": op8_parity_join,
    "op9_chunk_dedup": op9_chunk_dedup,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_suffix_merge": op12_suffix_merge,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def _op3_sql() -> str:
    fits = ", ".join(f"('{r.name}', '{r.verdict}', '{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}')" for r in HOST_RULES)
    blocked = " OR ".join(f"regexp_matches(host || path, '{r.pattern}')" for r in PATTERN_RULES)
    return f"""WITH rules(rule, verdict, rhost, rpath) AS (VALUES {fits}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host,
                 regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts),
best AS (SELECT p.*, (SELECT max(struct_pack(n := length(r.rule), rule := r.rule, verdict := r.verdict)) FROM rules r
           WHERE (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)) AS b FROM parts p)
SELECT page_id, host, path, b.rule AS rule,
       COALESCE(b.verdict, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict FROM best"""


# The unsigned CRC-32 of a text's bytes: the rule of its polynomial, eight bits a byte.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT), lambda c, b:
    list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295::BIGINT))"""


def _op13_sql() -> str:
    def leaf(text: str) -> str:
        values = {c: f"CAST({c} AS VARCHAR)" for c in LEAF_COLUMNS} | {"text": text}
        return "sha256(" + " || ".join(f"COALESCE(strlen({v}) || ':' || {v}, '-')" for v in values.values()) + ")"

    def tree(name: str, base: str) -> str:
        runs = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], '')))"
        return f"{name} AS (SELECT source, 0 AS level, nodes FROM {base} UNION ALL SELECT source, level + 1, {runs} FROM {name} WHERE len(nodes) > 1)"

    def path(levels: str, place: str) -> str:
        run = f"({place} // CAST(pow(3, l.level) AS BIGINT))"
        side = lambda a, b: f"array_to_string(l.nodes[{a} : {b}], '')"
        return f"""list(struct_pack(l := {side(f"{run} // 3 * 3 + 1", run)}, r := {side(f"{run} + 2", f"{run} // 3 * 3 + 3")})
            ORDER BY l.level) FILTER (len(l.nodes) > 1)"""

    crc = _CRC32.format("CAST(doc_id AS VARCHAR)")
    return f"""WITH RECURSIVE leaves AS (SELECT doc_id, source, {leaf("text")} AS leaf,
  {leaf(f"CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS held FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
bottoms AS (SELECT source, list(leaf ORDER BY idx) AS nodes FROM ranked GROUP BY source),
{tree("levels", "bottoms")},
subroots AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS sid FROM levels WHERE len(nodes) = 1),
tops AS (SELECT NULL AS source, list(subroot ORDER BY sid) AS nodes FROM subroots),
{tree("top_levels", "tops")},
root AS (SELECT nodes[1] AS root FROM top_levels WHERE len(nodes) = 1),
lower_paths AS (SELECT d.source, d.idx, {path("l", "d.idx")} AS path FROM ranked d JOIN levels l ON d.source IS NOT DISTINCT FROM l.source GROUP BY d.source, d.idx),
upper_paths AS (SELECT s.source, s.subroot, {path("l", "s.sid")} AS path FROM subroots s CROSS JOIN top_levels l GROUP BY s.source, s.subroot),
proofs AS (SELECT r.doc_id, r.leaf, r.held, u.subroot, root, list_concat(COALESCE(p.path, []), COALESCE(u.path, [])) AS path
  FROM ranked r JOIN lower_paths p ON r.source IS NOT DISTINCT FROM p.source AND r.idx = p.idx JOIN upper_paths u ON r.source IS NOT DISTINCT FROM u.source CROSS JOIN root),
folded AS (SELECT *, list_reduce(list_prepend(struct_pack(l := held, r := ''), path), lambda n, s: struct_pack(l := sha256(s.l || n.l || s.r), r := '')).l AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


# What separates words, and the digits of base32.
_WORD = r"[^\x20\x09-\x0D]+"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _reached(ids: str, links: str) -> str:
    """A table ``reached`` (id, component_id): the smallest id that links lead to, itself included."""
    return f"""walk AS (SELECT id, id AS other FROM {ids} UNION SELECT w.id, l.b FROM walk w JOIN {links} l ON w.other = l.a),
reached AS (SELECT id, min(other) AS component_id FROM walk GROUP BY id)"""


def _op1_sql() -> str:
    sound = "list_bool_and(list_transform(embedding, lambda x: COALESCE(isfinite(x), false))) AND list_bool_or(list_transform(embedding, lambda x: COALESCE(x <> 0, false)))"
    return f"""WITH RECURSIVE given AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE {sound}),
links AS MATERIALIZED (SELECT x.id AS a, y.id AS b FROM given x JOIN given y ON x.id <> y.id WHERE list_cosine_similarity(x.v, y.v) >= {THRESHOLD}),
{_reached("given", "links")}
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, COALESCE(r.component_id, vec_id) AS component_id,
       COALESCE(r.component_id, vec_id) = vec_id AS kept FROM embeddings e LEFT JOIN reached r ON r.id = e.vec_id"""


def _op4_sql() -> str:
    # A digest's 40 hexadecimal digits, five of them to four of base32.
    digit = lambda shift: f"substr('{_BASE32}', CAST(n >> {shift} & 31 AS INTEGER) + 1, 1)"
    digits = " || ".join(digit(shift) for shift in (15, 10, 5, 0))
    base32 = f"array_to_string(list_transform(list_transform(range(8), lambda i: CAST('0x' || substr(digest, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT)), lambda n: {digits}), '')"
    return f"""WITH held AS (SELECT page_id, COALESCE(html, '') AS payload FROM pages),
firsts AS (SELECT *, sha1(payload) AS digest, min(page_id) OVER (PARTITION BY payload) AS first FROM held)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {base32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM firsts"""


def _op8_sql() -> str:
    return f"""WITH RECURSIVE split AS (SELECT doc_id AS id, regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{_WORD}') AS w FROM documents),
sets AS MATERIALIZED (SELECT id, list_distinct(list_transform(range(1, greatest(len(w) - 3, CAST(len(w) > 0 AS INTEGER) + 1)),
  lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM split),
members AS (SELECT id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (SELECT x.id AS a, y.id AS b, count(*) AS shared, any_value(x.n + y.n) AS total FROM members x JOIN members y ON x.shingle = y.shingle AND x.id <> y.id GROUP BY x.id, y.id),
links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * shared >= 80 * (total - shared)),
{_reached("sets", "links")}
SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN reached USING (id)"""


def _op12_sql() -> str:
    # Texts as hexadecimal digits, two a byte; windows by their 128-bit digests.
    return f"""WITH texts AS MATERIALIZED (SELECT doc_id, strlen(COALESCE(text, '')) AS n, hex(encode(COALESCE(text, ''))) AS digits FROM documents),
starts AS (SELECT doc_id, digits, unnest(range(n - {LENGTH - 1})) AS i FROM texts WHERE n >= {LENGTH}),
windows AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(digits, CAST(2 * i + 1 AS BIGINT), {2 * LENGTH})) AS digest FROM starts),
repeats AS (SELECT doc_id, i FROM windows WHERE digest IN (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1)),
steps AS (SELECT *, COALESCE(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {LENGTH}, true) AS fresh FROM repeats),
runs AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
spans AS (SELECT doc_id, min(i) AS first, max(i) + {LENGTH} AS past FROM runs GROUP BY doc_id, run),
edges AS (SELECT doc_id, first, past, true AS span FROM spans UNION ALL SELECT doc_id, n, n, false FROM texts),
gaps AS (SELECT *, COALESCE(lag(past) OVER (PARTITION BY doc_id ORDER BY first, span DESC), 0) AS since FROM edges)
SELECT doc_id, any_value(n) AS n_bytes, CAST(COALESCE(sum(past - first), 0) AS BIGINT) AS n_removed, count(*) FILTER (span) AS n_spans,
       sha256(unhex(string_agg(substr(digits, CAST(2 * since + 1 AS BIGINT), CAST(2 * (first - since) AS BIGINT)), '' ORDER BY first, span DESC))) AS kept_sha256
FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id"""


ORACLES: dict[str, str] = {
    "op1_spherical_caps": _op1_sql(),
    "op3_url_rules": _op3_sql(),
    "op4_warc": _op4_sql(),
    "op8_parity_join": _op8_sql(),
    "op12_suffix_merge": _op12_sql(),
    "op13_merkle_manifest": _op13_sql(),
}
