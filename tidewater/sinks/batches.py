"""Appends that happen once per batch, however often the job is run again.

A batch's files are written to a hidden folder of the table first. Its plan, with all their names,
is written next to the tables (``_tidewater_batches/<table>/<batch>.plan``) before the first one is
moved to its partition, and renamed to ``.done`` after the last. Run again, a batch that is done
adds nothing; one with a plan is finished from it; one without is written anew, and what its
dead attempt left is removed.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidewater import fs
from tidewater.sinks.lake import write_lake

BATCHES_FOLDER = "_tidewater_batches"
STAGING_PREFIX = ".tidewater-batch-"
_MOVES_AT_ONCE = 16


def batches_folder(lake_root: str, table: str) -> str:
    return f"{lake_root.rstrip('/')}/{BATCHES_FOLDER}/{table.strip('/')}"


def _name(batch: str) -> str:
    """A file name for any batch id."""
    plain = "".join(c if c.isalnum() or c in "-." else "_" for c in batch)[:80]
    return plain if plain == batch else f"{plain}-{hashlib.sha256(batch.encode()).hexdigest()[:16]}"


def batch_files(spark: SparkSession, lake_root: str, table: str, batch: str) -> list[str] | None:
    """Files, relative to the table's folder, that a finished batch added; None if it is not finished."""
    text = fs.read_text(spark, f"{batches_folder(lake_root, table)}/{_name(batch)}.done")
    return None if text is None else json.loads(text)["files"]


def _finish(spark: SparkSession, path: str, plan_path: str, check: Callable[[], None]) -> None:
    plan = json.loads(fs.read_text(spark, plan_path))
    staging = f"{path}/{plan['staging']}"
    root = fs.qualify(spark, staging)
    waiting = {f[len(root) + 1:] for f in fs.data_files(spark, staging)}

    def move(name: str) -> None:
        target = f"{path}/{name}"
        fs.make_dirs(spark, target.rsplit("/", 1)[0])
        if not fs.rename(spark, f"{staging}/{name}", target):
            raise OSError(f"could not move {name} of {staging}")

    check()
    with ThreadPoolExecutor(max_workers=_MOVES_AT_ONCE) as pool:
        for done in [pool.submit(move, n) for n in plan["files"] if n in waiting]:
            done.result()
    if not fs.rename(spark, plan_path, plan_path.removesuffix(".plan") + ".done"):
        raise OSError(f"could not rename {plan_path}")
    fs.delete(spark, staging)


def recover_batches(spark: SparkSession, lake_root: str, table: str, path: str, check: Callable[[], None] = lambda: None) -> int:
    """Finishes batches whose job died between its plan and the last move, and removes what was
    staged without a plan. Every job calls it first, under the table's lock."""
    folder = batches_folder(lake_root, table)
    plans = [c for c, _ in fs.list_entries(spark, folder) if c.endswith(".plan")]
    for plan in plans:
        _finish(spark, path, f"{folder}/{plan}", check)
    for child, is_dir in fs.list_entries(spark, path):
        if is_dir and child.startswith(STAGING_PREFIX):
            fs.delete(spark, f"{path}/{child}")
    return len(plans)


def append_once(df: DataFrame, path: str, partition_cols: Sequence[str], lake_root: str, table: str, batch: str,
                check: Callable[[], None] = lambda: None, **kw) -> bool:
    """Adds the rows as batch ``batch`` of the table; False if that batch is there already (``df``
    is not evaluated then). Interrupted batches must have been recovered before."""
    spark = df.sparkSession
    folder = batches_folder(lake_root, table)
    if fs.exists(spark, f"{folder}/{_name(batch)}.done"):
        return False
    staging = f"{STAGING_PREFIX}{os.urandom(8).hex()}"
    write_lake(df, f"{path}/{staging}", partition_cols, "overwrite", **kw)
    root = fs.qualify(spark, f"{path}/{staging}")
    files = sorted(f[len(root) + 1:] for f in fs.data_files(spark, f"{path}/{staging}"))
    check()
    plan = f"{folder}/{_name(batch)}.plan"
    fs.write_text_at_once(spark, plan, json.dumps({"staging": staging, "files": files}))
    _finish(spark, path, plan, check)
    return True
