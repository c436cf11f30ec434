"""Reads of lake tables: the whole table, or an explicit list of partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import fs
from tidewater.functions.partitions import GRAINS, partition_dir


def lake_exists(spark: SparkSession, path: str) -> bool:
    return fs.has_data_files(spark, path)


def lake_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole lake table; ``year/month/day`` appear as columns from the directory names.
    Filters on them prune directories; other filters are pushed to the Parquet scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _int_partitions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    fixes = {c: F.col(c).cast("int") for c in cols
             if c in df.columns and not isinstance(df.schema[c].dataType, T.IntegerType)}
    return df.withColumns(fixes) if fixes else df


def lake_partition_scan(spark: SparkSession, root: str, partitions: Iterable[Sequence],
                        cols: Sequence[str] = GRAINS["day"], schema: T.StructType | None = None) -> DataFrame | None:
    """Only the listed partition directories, with the partition columns kept (basePath).

    Only those directories are listed, so the cost does not grow with the size of the rest
    of the lake. Partitions that do not exist yet are skipped; ``None`` when none exist.
    """
    paths = [partition_dir(root, p, cols) for p in partitions]
    present = fs.existing(spark, paths)
    if not present:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.option("basePath", root.rstrip("/")).parquet(*present)
    return _int_partitions(df, cols)
