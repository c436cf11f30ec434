"""What the engine remembers of a lake table's data files: content digests and key filters.

Data files never change and their names carry the id of the job that wrote them, so a fact about a
file holds as long as the file is there. Facts are kept by file name beside the tables
(``_tidewater_facts``): those of files that are gone are ignored, and files without facts, whoever
wrote them, are read when facts are asked for. No writer has to keep anything up to date.

* A digest is the row count with order-independent sums and the xor of 64-bit row hashes. Digests add
  up, so a partition's is that of its files, and equals that of any frame with the same rows.
* A key filter is a Bloom filter of the file's keys: two 64-bit words for each key, six bits in
  each, 32 bits a key, so a key that the file lacks passes about once in a hundred thousand times.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import fs

FACTS_FOLDER = "_tidewater_facts"
_BITS_A_KEY = 32
_PICKS = 6  # bits that a key sets in each of its two words
_COMPACT_FILES = 64
_PATHS_NAMED = 5_000


# ---------------------------------------------------------------- row digests

def _hashable(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(c)), {"ignoreNullFields": "false"})
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c


def row_hash(schema: T.StructType) -> Column:
    """64-bit hash of a row's columns in the order of their names; NULLs count, and where they stand."""
    fields = sorted(schema.fields, key=lambda f: f.name)
    values = [_hashable(f.name, f.dataType) for f in fields]
    return F.xxhash64(*values, F.array(*[F.col(f"`{f.name}`").isNull() for f in fields]))


DIGEST = ("n", "low", "middle", "high", "mixed")


def digest_of(h: Column) -> list[Column]:
    """Aggregates of a row hash: count, sums of its three parts of 21 or 22 bits (which hold 2**41
    rows), xor."""
    return [F.count(F.lit(1)).alias("n"), F.sum(h.bitwiseAND(F.lit((1 << 22) - 1))).alias("low"),
            F.sum(F.shiftrightunsigned(h, 22).bitwiseAND(F.lit((1 << 21) - 1))).alias("middle"),
            F.sum(F.shiftrightunsigned(h, 43)).alias("high"), F.bit_xor(h).alias("mixed")]


def combined() -> list[Column]:
    """The same of rows of digests."""
    return [*[F.sum(c).alias(c) for c in ("n", "low", "middle", "high")], F.bit_xor("mixed").alias("mixed")]


def partition_digests(df: DataFrame, partition_cols: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One digest a partition, over ``columns``; combined map-side, one row a partition and task is shuffled."""
    hashed = df.select(*partition_cols, row_hash(T.StructType([df.schema[c] for c in columns])).alias("_h"))
    return hashed.groupBy(*partition_cols).agg(*digest_of(F.col("_h")))


# ---------------------------------------------------------------- the store

@dataclass
class Facts:
    """The facts of one kind about a table's files."""

    spark: SparkSession
    root: str  # folder of this table and kind
    schema: T.StructType

    def _version(self) -> int:
        done = [int(c) for c, is_dir in fs.list_entries(self.spark, self.root) if is_dir and c.isdigit() and fs.exists(self.spark, f"{self.root}/{c}/_SUCCESS")]
        return max(done, default=0)

    def read(self) -> DataFrame:
        version = self._version()
        if not version:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{version}")

    def add(self, rows: DataFrame) -> None:
        rows.select(self.schema.fieldNames()).write.mode("append").parquet(f"{self.root}/{max(1, self._version())}")

    def compact(self, present: DataFrame) -> None:
        """Once there are many fact files: only the facts of files that are still there, as a new version."""
        version = self._version()
        if sum(1 for c, _ in fs.list_entries(self.spark, f"{self.root}/{version}") if c.endswith(".parquet")) < _COMPACT_FILES:
            return
        self.read().join(present, "file", "left_semi").select(self.schema.fieldNames()).repartition(1 + present.count() // 10_000) \
            .write.parquet(f"{self.root}/{version + 1}")
        for c, is_dir in fs.list_entries(self.spark, self.root):
            if is_dir and c.isdigit() and int(c) <= version:
                fs.delete(self.spark, f"{self.root}/{c}")


DIGEST_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("columns", T.StringType()),
                              *[T.StructField(c, T.LongType()) for c in DIGEST]])
KEYS_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("keys", T.StringType()),
                            T.StructField("n", T.LongType()), T.StructField("words", T.LongType()), T.StructField("filter", T.BinaryType())])


def facts(spark: SparkSession, lake_root: str, table: str, kind: str) -> Facts:
    schema = {"digests": DIGEST_SCHEMA, "keys": KEYS_SCHEMA}[kind]
    return Facts(spark, f"{lake_root.rstrip('/')}/{FACTS_FOLDER}/{table.strip('/')}/{kind}", schema)


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Data files of a lake table relative to its folder, by Spark's file index."""
    root = fs.qualify(spark, path)
    return [f[len(root) + 1:] for f in fs.data_files(spark, path)]


def _with_file(spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of those files with ``_file``, their name relative to the table. Very many files are
    read as the table, without the others' rows: each path that is named is looked up by itself."""
    few = len(files) <= _PATHS_NAMED
    df = spark.read.schema(schema).option("basePath", path.rstrip("/")).parquet(*[f"{path}/{f}" for f in files] if few else [path])
    name = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    df = df.withColumn("_file", F.substring(name, len(fs.qualify(spark, path)) + 2, 1 << 20))
    # the listing that the driver holds anyway
    return df if few else df.join(F.broadcast(spark.createDataFrame([(f,) for f in files], "_file string")), "_file", "left_semi")


def file_digests(spark: SparkSession, lake_root: str, table: str, path: str, files: Sequence[str], schema: T.StructType,
                 columns: Sequence[str]) -> DataFrame:
    """(file and its digest) of each of the table's ``files`` over ``columns``. Files without
    a stored digest of these columns are read, and theirs stored."""
    tag = ", ".join(f"{c}: {schema[c].dataType.simpleString()}" for c in sorted(columns))
    store = facts(spark, lake_root, table, "digests")
    present = spark.createDataFrame([(f,) for f in files], "file string")
    known = store.read().where(F.col("columns") == tag).join(present, "file", "left_semi").dropDuplicates(["file"]).select("file", *DIGEST)
    missing = [r[0] for r in present.join(known, "file", "left_anti").collect()]
    if not missing:
        return known
    rows = _with_file(spark, path, missing, schema)
    digests = rows.select("_file", row_hash(T.StructType([schema[c] for c in columns])).alias("_h")).groupBy(F.col("_file").alias("file")).agg(*digest_of(F.col("_h")))
    # A file without rows has no group.
    whole = spark.createDataFrame([(f,) for f in missing], "file string").join(digests, "file", "left").na.fill(0, list(DIGEST))
    store.add(whole.withColumn("columns", F.lit(tag)))
    store.compact(present)
    return store.read().where(F.col("columns") == tag).join(present, "file", "left_semi").dropDuplicates(["file"]).select("file", *DIGEST)


# ---------------------------------------------------------------- key filters

def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _words(h: Column, words: Column) -> list[Column]:
    """The two words of a key: (number, bits). Low bits of the hash number one, high bits the
    other; six bits of a word come from six digits of a scrambled hash."""
    out = []
    for salt, number in ((1, h), (2, F.shiftrightunsigned(h, 32))):
        mixed = F.xxhash64(h, F.lit(salt))
        bits = F.lit(0).cast("long")
        for i in range(_PICKS):
            bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
        out.append(F.struct(F.pmod(number, words).alias("word"), bits.alias("bits")))
    return out


def _pack(group: pa.Table) -> pa.Table:
    """The words of one file's filter, in order, as bytes."""
    first = group.slice(0, 1).to_pylist()[0]
    filter_ = np.zeros(first["words"], np.int64)
    filter_[group.column("word").to_numpy()] = group.column("bits").to_numpy()
    return pa.table({"file": [first["file"]], "keys": [first["keys"]], "n": [first["n"]], "words": [first["words"]], "filter": [filter_.tobytes()]},
                    schema=pa.schema([("file", pa.string()), ("keys", pa.string()), ("n", pa.int64()), ("words", pa.int64()), ("filter", pa.binary())]))


def key_filters(spark: SparkSession, lake_root: str, table: str, path: str, files: Sequence[str], schema: T.StructType,
                keys: Sequence[str]) -> DataFrame:
    """(file, n, words, filter) of each of ``files``; missing ones are built from the key columns and stored."""
    tag = ", ".join(f"{c}: {schema[c].dataType.simpleString()}" for c in keys)
    store = facts(spark, lake_root, table, "keys")
    present = spark.createDataFrame([(f,) for f in files], "file string")

    def stored() -> DataFrame:
        return store.read().where(F.col("keys") == tag).join(present, "file", "left_semi").dropDuplicates(["file"])

    missing = [r[0] for r in present.join(store.read().where(F.col("keys") == tag).select("file"), "file", "left_anti").collect()]
    if missing:
        rows = _with_file(spark, path, missing, schema).select(F.col("_file").alias("file"), key_hash(keys).alias("h"))
        counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        sized = counts.withColumn("words", F.greatest(F.lit(8), F.ceil(F.col("n") * _BITS_A_KEY / 64)).cast("long"))
        set_ = rows.join(sized, "file").select("file", "n", "words", F.explode(F.array(*_words(F.col("h"), F.col("words")))).alias("w")) \
            .groupBy("file", "n", "words", F.col("w.word").alias("word")).agg(F.bit_or("w.bits").alias("bits"))
        built = set_.withColumn("keys", F.lit(tag)).groupBy("file").applyInArrow(_pack, KEYS_SCHEMA)
        empty = spark.createDataFrame([(f,) for f in missing], "file string").join(counts, "file", "left_anti") \
            .select("file", F.lit(tag).alias("keys"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("words"), F.lit(b"").alias("filter"))
        store.add(built.unionByName(empty))
        store.compact(present)
    return stored().select("file", "n", "words", "filter")


def files_that_may_hold(filters: DataFrame, changes: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files whose filter lets at least one key of ``changes`` pass. The distinct keys' hashes go
    to every task, so the caller bounds their number; a filter is read where it lies."""
    words = _words(F.col("h"), F.lit(1).cast("long"))
    probe = changes.select(key_hash(keys).alias("h")).distinct().select("h", *[w["bits"].alias(f"b{i}") for i, w in enumerate(words)]).toPandas()
    if probe.empty:
        return []
    h = probe["h"].to_numpy(np.int64)
    held = changes.sparkSession.sparkContext.broadcast(
        (h, (h.view(np.uint64) >> np.uint64(32)).astype(np.int64), *(probe[f"b{i}"].to_numpy(np.int64) for i in range(2))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, one, two = held.value
        for batch in batches:
            hit = []
            for file, words, filter_ in zip(*(batch.column(c).to_pylist() for c in ("file", "words", "filter"))):
                if not words:
                    continue
                bits = np.frombuffer(filter_, np.int64)
                at = np.flatnonzero(bits[first % words] & one == one)
                if len(at) and (bits[second[at] % words] & two[at] == two[at]).any():
                    hit.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.string())], names=["file"])

    return [r[0] for r in filters.select("file", "words", "filter").mapInArrow(run, "file string").collect()]
