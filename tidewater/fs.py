"""Small path helpers over the Hadoop FileSystem API that Spark itself writes through.

Only metadata calls live here (exists / delete / list children); they run on the driver
and touch a bounded number of partition directories, never row data.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.delete(hpath, recursive))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty when it does not exist)."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hpath)]


def _visible_below(root_uri: str, file_uri: str) -> bool:
    rel = file_uri[len(root_uri):] if file_uri.startswith(root_uri) else file_uri.rsplit("/", 1)[-1]
    return not any(seg.startswith(("_", ".")) for seg in rel.strip("/").split("/") if seg)


def first_data_file(spark: SparkSession, path: str) -> str | None:
    """URI of one data file below ``path``, skipping hidden files and folders (``_SUCCESS``,
    ``.spark-staging-*``, ``_temporary``) the way Spark's readers do; ``None`` if none."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return None
    root = fs.makeQualified(hpath).toString().rstrip("/")
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        uri = it.next().getPath().toString()
        if _visible_below(root, uri):
            return uri
    return None


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one visible data file somewhere below it."""
    return first_data_file(spark, path) is not None


def glob_dirs(spark: SparkSession, pattern: str) -> set[str]:
    """Paths matching a glob pattern (one listing per wildcard level, not one call per path)."""
    fs, hpath = _fs_and_path(spark, pattern)
    found = fs.globStatus(hpath)
    if found is None:
        return set()
    return {status.getPath().toString() for status in found}


def touch(spark: SparkSession, path: str) -> int:
    """Create an empty file and return its modification time as the file system records it
    (server clock, milliseconds), so later comparisons need no synchronised client clocks."""
    fs, hpath = _fs_and_path(spark, path)
    fs.create(hpath, True).close()
    return int(fs.getFileStatus(hpath).getModificationTime())


_ONE_BY_ONE = 32


def existing(spark: SparkSession, paths) -> list[str]:
    """Those of ``paths`` that exist: asked for one by one when they are few, else found in one
    listing of each parent folder."""
    paths = list(paths)
    if len(paths) <= _ONE_BY_ONE:
        return [p for p in paths if exists(spark, p)]
    parents = {p.rstrip("/").rsplit("/", 1)[0] for p in paths}
    with ThreadPoolExecutor(max_workers=16) as pool:
        children = dict(zip(parents, pool.map(lambda p: set(list_children(spark, p)), parents)))
    return [p for p in paths if p.rstrip("/").rsplit("/", 1)[1] in children[p.rstrip("/").rsplit("/", 1)[0]]]


def data_files(spark: SparkSession, *paths: str) -> list[str]:
    """URIs of all data files below ``paths``, from Spark's file index (the listing that a read
    of the folders makes; hidden files are skipped, and no file is opened)."""
    present = existing(spark, paths)
    if not present:
        return []
    listed = spark.read.schema("listed int").option("recursiveFileLookup", "true").parquet(*present)
    # The index writes local URIs with an empty authority and quotes them; paths elsewhere here do neither.
    return [unquote("file:/" + f[len("file:///"):] if f.startswith("file:///") else f) for f in listed.inputFiles()]


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; ``None`` when it does not exist."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file, replacing an older one."""
    fs, hpath = _fs_and_path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(content.encode("utf-8")))
    finally:
        out.close()


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified URI of ``path`` (scheme and authority added), without a trailing slash."""
    fs, hpath = _fs_and_path(spark, path)
    return fs.makeQualified(hpath).toString().rstrip("/")


def list_entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(name, is_directory)`` of the direct children of ``path`` (empty when missing)."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [(st.getPath().getName(), bool(st.isDirectory())) for st in fs.listStatus(hpath)]


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, hsrc = _fs_and_path(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(hsrc, jvm.org.apache.hadoop.fs.Path(dst)))


def create_exclusive(spark: SparkSession, path: str, content: str) -> bool:
    """Create ``path`` only if it does not exist (``overwrite=false``); False if it does.
    Atomic on HDFS and local file systems."""
    fs, hpath = _fs_and_path(spark, path)
    try:
        out = fs.create(hpath, False)
    except Exception as e:  # py4j wraps FileAlreadyExistsException
        if "FileAlreadyExists" in str(e) or fs.exists(hpath):
            return False
        raise
    try:
        out.write(bytearray(content.encode("utf-8")))
    finally:
        out.close()
    return True


def set_modification_time(spark: SparkSession, path: str, ms: int) -> None:
    fs, hpath = _fs_and_path(spark, path)
    fs.setTimes(hpath, int(ms), -1)


def modification_time(spark: SparkSession, path: str) -> int | None:
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return None
    return int(fs.getFileStatus(hpath).getModificationTime())


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path`` (one call to the file system)."""
    fs, hpath = _fs_and_path(spark, path)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def files_with_sizes(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """``(name, bytes)`` of the visible files directly in ``folder``."""
    fs, hpath = _fs_and_path(spark, folder)
    found = [(st.getPath().getName(), int(st.getLen())) for st in fs.listStatus(hpath) if not st.isDirectory()]
    return [(n, size) for n, size in found if not n.startswith(("_", "."))]


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    fs.mkdirs(hpath)


def write_text_at_once(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file that is either there as a whole or not; one that is there already is replaced."""
    part = f"{path}.part-{os.urandom(4).hex()}"
    write_text(spark, part, content)
    if exists(spark, path):
        delete(spark, path)
    if not rename(spark, part, path):
        raise OSError(f"could not move {part} to {path}")
