import base64
import hashlib

import time

import numpy as np
import pytest

from tidewater.llm.storage import shared_folder
from tidewater.llm.warc import candidates, leave_blocks, reachable, read_warc, record, write_warc

SCHEMA = "page_id long, url string, html string, file string"


def brute(pages):
    first = {}
    for page, _, html, _ in pages:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html, _ in pages:
        data = (html or "").encode()
        again = page is not None and first[html or ""] != page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                    first[html or ""] if again else None))
    return sorted(out, key=str)


def test_round_trip_with_magic_in_payloads(spark):
    fake = record(99, "http://x/", b"inner", None, "1970-01-01T00:00:00Z").decode()
    pages = [(1, "http://a/", "<p>é</p>", "x"), (2, None, None, None), (3, "u\r\nX: y", "", "x"), (4, "u", fake, "x"), (4, "u", fake, "x"),
             (5, "u", "WARC/1.0\r\n" * 3, "x"), (6, "u", "<p>é</p>", "x"), (None, "u", "<p>é</p>", "x"), (7, "u", fake * 400, "x"),
             (8, "u", fake + "tail", "x")]
    folder = shared_folder(spark, "test")
    written = write_warc(spark.createDataFrame(pages, SCHEMA).repartition(3), folder, file_bytes=4000)
    assert written.agg({"records": "sum"}).collect()[0][0] == len(pages)
    got = read_warc(spark, folder, folder + "-work").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == brute(pages)


def test_chains_over_small_blocks(spark):
    fake = record(99, "http://x/", b"inner", None, "1970-01-01T00:00:00Z").decode()
    pages = [(i, "u", fake * (i % 7) + "x" * (37 * i % 900), None) for i in range(200)]
    folder = shared_folder(spark, "test")
    write_warc(spark.createDataFrame(pages, SCHEMA).coalesce(1), folder)
    found = candidates(spark.read.format("binaryFile").load(folder + "/*.warc"), block_bytes=1000)
    assert found.count() > 400
    assert sorted(r.page_id for r in reachable(found).collect()) == list(range(200))


def test_least_bytes_and_empty_table(spark):
    pages = [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abcd", None), (4, "u", "abcd", None)]
    folder = shared_folder(spark, "test")
    write_warc(spark.createDataFrame(pages, SCHEMA), folder, least_bytes=3)
    kinds = {r.page_id: r.record_type for r in read_warc(spark, folder, folder + "-work").collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert write_warc(spark.createDataFrame([], SCHEMA), shared_folder(spark, "test")).isEmpty()


def test_pointer_jumping_inside_blocks():
    offset, successor = np.array([0, 10, 20, 35, 50]), np.array([10, 20, 35, 51, 60])
    assert leave_blocks(offset, successor, 30).tolist() == [35, 35, 35, 51, 60]


def test_hostile_payloads_take_seconds(spark):
    """Ten megabytes of what could be record starts, with and without blank lines and lengths."""
    lengths = "".join(f"\r\n\r\nWARC/1.0\r\nContent-Length: {i}\r\n" for i in range(200_000))
    pages = [(1, "u", "WARC/1.0\r\n" * 1_000_000, None), (2, "u", "\r\n\r\nWARC/1.0\r\n" * 700_000, None), (3, "u", lengths, None), (4, "u", "plain", None)]
    folder, began = shared_folder(spark, "test"), time.time()
    write_warc(spark.createDataFrame(pages, SCHEMA).coalesce(1), folder)
    got = read_warc(spark, folder, folder + "-work").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == brute(pages)
    assert time.time() - began < 90


@pytest.mark.parametrize("damage,message", [("payload", "damaged record"), ("cut", "holds no record"), ("gone", "missing"), ("start", "holds no record"), ("record", "manifest")])
def test_damage_is_seen(spark, tmp_path, damage, message):
    folder = f"file://{tmp_path}/warc"
    pages = [(i, "u", f"<p>page {i}</p>" * 20, None) for i in range(30)]
    write_warc(spark.createDataFrame(pages, SCHEMA).coalesce(2), folder)
    files = sorted((tmp_path / "warc").glob("*.warc"))
    data = files[0].read_bytes()
    second = data.index(b"WARC/1.0", 10)
    changed = {"payload": data.replace(b"page 3<", b"page X<", 1), "cut": data[:-50], "start": b"x" + data, "record": data[second:]}
    files[0].unlink()
    if damage != "gone":
        files[0].write_bytes(changed[damage])
    for hidden in (tmp_path / "warc").glob(".*.crc"):
        hidden.unlink()
    with pytest.raises(ValueError, match=message):
        read_warc(spark, folder, folder + "-work")
