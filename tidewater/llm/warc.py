"""WARC archives of pages: writing with revisit records, and reading by boundary chains.

Reading doesn't trust a record's magic line, which payloads may hold too. Tasks emit every
place that looks like a record with the place where its successor would start. Pointer
jumping, inside blocks of a file with numpy and between blocks with joins, finds what a walk
from the start of each file reaches; only those records are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import exists
from .storage import finished_file, saved

MAGIC = b"WARC/1.0\r\n"
FILE_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20
BROADCAST_ROWS = 200_000
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_FIELDS = re.compile(rb"(?m)^(WARC-Type|WARC-Record-ID|WARC-Payload-Digest|WARC-Refers-To|Content-Length): *([^\r\n]*)\r$")
_HTTP_LENGTH = re.compile(rb"(?mi)^Content-Length: *(\d+)\r$")
_URN = re.compile(rb"<urn:page:(-?\d+)>")


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1 of the payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response record, or, with ``refers_to``, a revisit record that holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return MAGIC + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload digest, refers_to) of the pages whose payload, of at least
    ``least_bytes`` bytes, also belongs to a smaller page id."""
    ids = pages.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least_bytes)) \
        .select("page_id", F.sha1("payload").alias("sha")).distinct()
    first = ids.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return ids.join(first, "sha").where("page_id <> refers_to")


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
               id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one record per row into archives below ``folder``; returns a row per archive:
    name, records, bytes.

    Of records with equal payloads of at least ``least_bytes`` bytes those with the smallest id
    are responses and the others revisit that id. A null payload is empty; a row with a null
    id is a response; repeated rows are written each; an empty table writes no archive; other
    columns are left out.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    revisits(rows, least_bytes).write.parquet(f"{folder}/_revisits")
    again = spark.read.schema("sha string, page_id long, refers_to long").parquet(f"{folder}/_revisits")
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)  # at most BROADCAST_ROWS short rows
    rows = rows.withColumn("sha", F.sha1("payload")).join(again, ["page_id", "sha"], "left").drop("sha") \
        .select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, written = TaskContext.get().partitionId(), 0, []
        with ExitStack() as stack:
            out, name, records, size = None, "", 0, 0
            for batch in batches:
                for page, url, payload, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    if out is None:
                        name = f"pages-{part:06d}-{number:06d}.warc"
                        out = stack.enter_context(finished_file(folder, name))
                        number, records, size = number + 1, 0, 0
                    data = record(page, url, payload.encode("utf-8", "surrogatepass"), refers_to, date)
                    out.write(data)
                    records, size = records + 1, size + len(data)
                    if size >= file_bytes:
                        stack.pop_all().close()
                        written.append((name, records, size))
                        out = None
            if out is not None:
                written.append((name, records, size))
        yield pa.RecordBatch.from_arrays([pa.array([w[i] for w in written], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         names=["name", "records", "bytes"])

    rows.mapInArrow(run, "name string, records long, bytes long").write.parquet(f"{folder}/_manifest")
    return spark.read.schema("name string, records long, bytes long").parquet(f"{folder}/_manifest")


CANDIDATE = ("file string, block long, offset long, successor long, leaves_at long, size long, record_type string, page_id long, "
             "payload_bytes long, payload_digest string, refers_to long, sound boolean")
# A record starts a file or follows the blank line that ends another one. So the heads of candidates
# don't overlap, and a scan reads no stretch between two blank lines more than twice.
_START = re.compile(rb"(?:\A|(?<=\r\n\r\n))" + re.escape(MAGIC))


def candidates(archives: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every place of an archive (rows of Spark's ``binaryFile`` source) that parses as a
    record: where its successor would start, and where the chain from it leaves its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _scan(path, memoryview(data.as_buffer()), block_bytes)

    return archives.select("path", "content").mapInArrow(run, CANDIDATE)


def _scan(path: str, data: memoryview, block_bytes: int) -> Iterator[pa.RecordBatch]:
    rows = []
    for m in _START.finditer(data):
        end = _find(data, b"\r\n\r\n", m.start())
        if end < 0:
            continue
        fields = dict(_FIELDS.findall(data[m.start() : end + 2]))
        try:
            successor = end + 4 + int(fields[b"Content-Length"]) + 4
        except (KeyError, ValueError):
            continue
        if successor > len(data) or successor <= m.start() or bytes(data[successor - 4 : successor]) != b"\r\n\r\n":
            continue
        head = _find(data, b"\r\n\r\n", end + 4)
        length = _HTTP_LENGTH.search(data[end + 4 : head + 2]) if 0 <= head < successor else None
        own, other = _URN.match(fields.get(b"WARC-Record-ID", b"")), _URN.match(fields.get(b"WARC-Refers-To", b""))
        rows.append((m.start(), successor, fields.get(b"WARC-Type", b"").decode("utf-8", "replace"), int(own[1]) if own else None,
                     int(length[1]) if length else None, fields.get(b"WARC-Payload-Digest", b"").decode("utf-8", "replace").removeprefix("sha1:"),
                     int(other[1]) if other else None, head + 4 if length else None))
    if not rows:
        return
    offset, successor = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    sound = _sound(data, rows)
    leaves = leave_blocks(offset, successor, block_bytes)
    n = len(rows)
    yield pa.RecordBatch.from_arrays(
        [pa.array([path] * n), pa.array(offset // block_bytes), pa.array(offset), pa.array(successor), pa.array(leaves), pa.array([len(data)] * n),
         *(pa.array([r[i] for r in rows], t) for i, t in zip(range(2, 7), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))),
         pa.array(sound, pa.bool_())],
        names=[c.split()[0] for c in CANDIDATE.split(", ")])


def _sound(data: memoryview, rows: list[tuple]) -> list[bool | None]:
    """For responses on the file's own chain, whose payloads don't overlap: whether length and digest
    are the payload's. None for other candidates, which are not worth reading."""
    where, out, at = {r[0]: i for i, r in enumerate(rows)}, [None] * len(rows), 0
    while at in where:
        i = where[at]
        _, at, kind, _, length, digest, _, start = rows[i]
        if kind == "response":
            payload = data[start : at - 4] if start is not None and start <= at - 4 else None
            out[i] = payload is not None and len(payload) == length and payload_digest(payload) == digest
    return out


def _find(data: memoryview, what: bytes, start: int) -> int:
    """Where ``what`` is first found from ``start`` on, looked for in growing pieces; or -1."""
    step = 4096
    while start < len(data):
        at = bytes(data[start : start + step]).find(what)
        if at >= 0:
            return start + at
        if start + step >= len(data):
            return -1
        start, step = start + step - len(what) + 1, min(2 * step, 1 << 20)
    return -1


def leave_blocks(offset: np.ndarray, successor: np.ndarray, block_bytes: int) -> np.ndarray:
    """Where the chain from each candidate first reaches another block (or a place that is
    no candidate), by pointer jumping."""
    at = np.searchsorted(offset, successor)
    known = at < len(offset)
    known[known] &= offset[at[known]] == successor[known]
    inside = known & (successor // block_bytes == offset // block_bytes)
    jump = np.where(inside, at, np.arange(len(offset)))  # the last candidates in a block point to themselves
    while True:
        further = jump[jump]
        if (further == jump).all():
            return successor[jump]
        jump = further


def reachable(found: DataFrame) -> DataFrame:
    """Of the candidates those that a walk from offset 0 of their file reaches."""
    spark = found.sparkSession
    jump = found.select("file", "offset", F.col("leaves_at").alias("to"), "block")
    entries = jump.join(jump.select("file", F.col("to").alias("offset")).distinct(), ["file", "offset"], "left_semi") \
        .unionByName(jump.where("offset = 0")).distinct()
    blocks = found.agg(F.max("block")).collect()[0][0] or 0
    reached = entries.where("offset = 0").select("file", "offset", "block")
    hop = entries.select("file", "offset", "to").checkpoint()
    places = entries.select("file", F.col("offset").alias("to"), F.col("block").alias("to_block"))
    # After k rounds hop goes 2**k blocks on, and reached holds the first 2**k entries of a walk.
    for _ in range(int(blocks + 1).bit_length()):
        onward = reached.join(hop, ["file", "offset"]).join(places, ["file", "to"]) \
            .select("file", F.col("to").alias("offset"), F.col("to_block").alias("block"))
        reached = reached.unionByName(onward).distinct().checkpoint()
        again = hop.select("file", F.col("offset").alias("to"), F.col("to").alias("further"))
        hop = hop.join(again, ["file", "to"]).select("file", "offset", F.col("further").alias("to")).checkpoint()
    entered = reached.select("file", "block", F.col("offset").alias("entry"))
    # A block's candidates are bounded by its bytes.
    return found.join(entered, ["file", "block"]).groupBy("file", "block").applyInPandas(_walk, CANDIDATE)


def _walk(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("offset")
    where = dict(zip(block["offset"], range(len(block))))
    successor = block["successor"].to_numpy()
    keep, at = [], int(block["entry"].iloc[0])
    while at in where:
        keep.append(where[at])
        at = int(successor[where[at]])
    return block.iloc[keep].drop(columns="entry")


def read_warc(spark: SparkSession, folder: str, work: str) -> DataFrame:
    """The response and revisit records of the archives (``*.warc``) in ``folder``: file,
    offset, record_type, page_id, payload_bytes, payload_digest, refers_to. ``work`` is a fresh
    shared folder for the candidates.

    Raises if there is no archive; if an archive's chain does not end at its end (a record is cut off or
    its length was changed); if a response's payload has another length or digest than its head says;
    and, where ``write_warc`` left its manifest, if an archive is missing or holds other numbers of
    records or bytes.
    """
    archives = spark.read.format("binaryFile").load(f"{folder}/*.warc")
    candidates(archives).write.parquet(work)
    kept = saved(reachable(spark.read.schema(CANDIDATE).parquet(work)), "warc-records")
    _check(spark, archives, kept, folder)
    return kept.where("record_type in ('response', 'revisit')") \
        .select("file", "offset", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to")


def _check(spark: SparkSession, archives: DataFrame, kept: DataFrame, folder: str) -> None:
    name = F.substring_index("file", "/", -1)
    ends = kept.groupBy("file").agg(F.max("successor").alias("end"), F.count(F.lit(1)).alias("records"),
                                    F.min(F.struct(F.coalesce("sound", F.lit(True)).alias("sound"), "offset")).alias("first"))
    found = archives.select(F.col("path").alias("file"), F.col("length").alias("size")).join(ends, "file", "left").withColumn("name", name)
    manifest = f"{folder}/_manifest"
    if exists(spark, manifest):
        written = spark.read.schema("name string, records long, bytes long").parquet(manifest).toDF("name", "n", "bytes")
        found = found.join(written, "name", "full")
    else:
        found = found.withColumns({"n": F.coalesce("records", F.lit(0)).cast("long"), "bytes": F.col("size")})
    wrong = F.when(F.col("size").isNull(), "is missing").when(F.col("n").isNull(), "is not in the manifest") \
        .when(F.coalesce("end", F.lit(0)) != F.col("size"), F.concat(F.lit("holds no record at byte "), F.coalesce("end", F.lit(0)))) \
        .when(~F.col("first.sound"), F.concat(F.lit("has a damaged record at byte "), F.col("first.offset"))) \
        .when((F.coalesce("records", F.lit(0)) != F.col("n")) | (F.col("bytes") != F.col("size")), "is not what the manifest says")
    damaged = found.select("name", wrong.alias("wrong")).where("wrong is not null").orderBy("name").limit(5).collect()
    if damaged:
        raise ValueError("damaged archives: " + "; ".join(f"{r['name']} {r['wrong']}" for r in damaged))
