"""Compaction: many small files of a partition become few of about the target size.

Appends leave a file or more a partition each time. Their files are packed into bins by size (first fit,
largest first, partition by partition: a list of names and sizes, no rows), each bin is one task and
one new file, and the new files are swapped in by a plan like an unpartitioned refresh: a job
that dies is finished, or undone, by the next one on the table.
"""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tidewater import fs
from tidewater.functions.partitions import partition_dir
from tidewater.operators.filefacts import _with_file, files_below
from tidewater.plans.context import EngineContext

TARGET_BYTES = 256 * 1024 * 1024
_FULL = 0.75  # of the target; a file of that size is left alone

log = logging.getLogger("tidewater")


def pack_files(files: Iterable[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of two files or more, of at most ``target`` bytes together, that together hold every
    file below the full size that can be put with another one."""
    bins: list[list] = []
    for name, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if size >= _FULL * target:
            continue
        for held in bins:
            if held[0] + size <= target:
                held[0] += size
                held[1].append(name)
                break
        else:
            bins.append([size, [name]])
    return [names for _, names in bins if len(names) > 1]


def compact_table(ctx: EngineContext, name: str, target_bytes: int = TARGET_BYTES, partitions: Sequence[tuple] | None = None):
    """Rewrites the small files of the table, or of the listed partitions, as fewer ones. The rows
    stay the same; a partition keeps at most one file more than its bytes need at half-full bins.
    Partitions with one file are not looked at."""
    from tidewater.plans.jobs import JobResult, _check_layout, _recover, finish_swap, lake_schema, write_swap_plan

    spec, spark, path = ctx.spec(name), ctx.spark, ctx.table_path(name)
    cols = list(spec.partition_cols)
    with ctx.lock(name, "compact"):
        _recover(ctx, name)
        if not _check_layout(spark, name, path, cols):
            return JobResult(name, "compact", "no_changes", note="no table")
        wanted = None if partitions is None else {partition_dir("", p, cols).strip("/") for p in partitions}
        folders: dict[str, int] = {}
        for f in files_below(spark, path):
            folder = f.rsplit("/", 1)[0] if "/" in f else ""
            if wanted is None or folder in wanted:
                folders[folder] = folders.get(folder, 0) + 1
        several = sorted(d for d, n in folders.items() if n > 1)
        with ThreadPoolExecutor(max_workers=16) as pool:
            listed = list(pool.map(lambda d: fs.files_with_sizes(spark, f"{path}/{d}" if d else path), several))
        bins = [[f"{d}/{n}" if d else n for n in names] for d, files in zip(several, listed) for names in pack_files(files, target_bytes)]
        if not bins:
            return JobResult(name, "compact", "no_changes")
        old = [f for names in bins for f in names]
        numbered = spark.createDataFrame([(f, i) for i, names in enumerate(bins) for f in names], "_file string, _bin int")
        rows = _with_file(spark, path, old, lake_schema(spark, path, cols)).join(F.broadcast(numbered), "_file")  # a row a file
        shaped = rows.repartitionById(len(bins), F.col("_bin")).drop("_file", "_bin")
        folder = f".tidewater-refresh-{os.urandom(6).hex()}"
        write = shaped.write.mode("overwrite")
        (write.partitionBy(*cols) if cols else write).parquet(f"{path}/{folder}")
        new = files_below(spark, f"{path}/{folder}")
        ctx.check_lock(name)
        plan = {"staging": folder, "new": new, "old": old}
        write_swap_plan(spark, path, json.dumps(plan))
        finish_swap(spark, path, plan)
    log.info("compact %s: %d files became %d", name, len(old), len(new))
    return JobResult(name, "compact", "written", None, note=f"{len(old)} files became {len(new)}")
