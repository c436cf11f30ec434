"""Writes of lake tables.

By default a write goes through ``REBALANCE(partition columns)``: rows of one partition
meet in one shuffle partition, and with AQE on Spark coalesces small ones and splits a
skewed one (a day holding a third of the table becomes several tasks and files, not one
straggler). The ``as_is`` layout skips that shuffle where the input is already laid out
(see ``LAYOUTS``). ``max_records_per_file`` is an extra cap on file size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.functions.curve import z_order
from tidewater.functions.partitions import partition_dir


# "rebalance": one shuffle by the partition columns (default; right for any input order).
# "as_is": no shuffle; each task writes the partitions it holds. Only for inputs already
# clustered by the partitioning time (e.g. a source stored in time order), where it saves
# the shuffle; on unclustered input it multiplies files by the number of tasks.
LAYOUTS = ("rebalance", "as_is")
_PLACE = "__tw_place"


def _prepare(df: DataFrame, partition_cols: Sequence[str], layout: str = "rebalance", cluster_by: Sequence[str] = ()):
    if cluster_by:
        # Ranges of (partition, place on the curve): a partition's rows spread over as many tasks as
        # its share asks for, and each file's row groups are narrow in the clustering columns.
        place = z_order(df, cluster_by) if len(cluster_by) > 1 else F.col(f"`{cluster_by[0]}`")
        order = [*partition_cols, _PLACE]
        return df.withColumn(_PLACE, place).repartitionByRange(*order).sortWithinPartitions(*order).drop(_PLACE).write
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; use one of {LAYOUTS}")
    if layout == "as_is":
        return df.write
    shaped = df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")
    return shaped.write


def write_lake(df: DataFrame, path: str, partition_cols: Sequence[str], mode: str,
               dynamic: bool = False, max_records_per_file: int | None = None,
               layout: str = "rebalance", cluster_by: Sequence[str] = ()) -> None:
    """``cluster_by`` sorts each partition's rows along a curve over those columns instead of any layout."""
    w = _prepare(df, partition_cols, layout, cluster_by).mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if mode == "overwrite":
        # Explicit either way: a session default of "dynamic" must not turn a full replace
        # into a partition-scoped one (or the reverse).
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)


def lake_append(df: DataFrame, path: str, partition_cols: Sequence[str], **kw) -> None:
    """Add the rows as new files; existing files are untouched."""
    write_lake(df, path, partition_cols, "append", **kw)


def lake_replace(df: DataFrame, path: str, partition_cols: Sequence[str], **kw) -> None:
    """Replace the whole table with ``df`` (static overwrite). Not for a frame that reads
    ``path`` itself; use ``lake_replace_where`` for that."""
    write_lake(df, path, partition_cols, "overwrite", **kw)


def lake_replace_where(df: DataFrame, path: str, partition_cols: Sequence[str],
                       drop: Iterable[Sequence] = (), **kw) -> None:
    """Overwrite exactly the partitions present in ``df`` (dynamic overwrite), then delete
    the listed ``drop`` partitions (ones that must end up empty). Other partitions are not
    touched. ``df`` may read the partitions it replaces: files are swapped at job commit."""
    write_lake(df, path, partition_cols, "overwrite", dynamic=True, **kw)
    drop_partitions(df.sparkSession, path, drop, partition_cols)


def drop_partitions(spark: SparkSession, root: str, partitions: Iterable[Sequence],
                    cols: Sequence[str]) -> list[str]:
    """Delete partition directories (and parents left empty). Returns the deleted paths."""
    dropped = []
    for p in partitions:
        d = partition_dir(root, p, cols)
        if fs.delete(spark, d):
            dropped.append(d)
        parent = d.rsplit("/", 1)[0]
        while parent.rstrip("/") != root.rstrip("/") and not fs.list_children(spark, parent):
            fs.delete(spark, parent)
            parent = parent.rsplit("/", 1)[0]
    return dropped


__all__ = ["LAYOUTS", "write_lake", "lake_append", "lake_replace", "lake_replace_where", "drop_partitions"]
