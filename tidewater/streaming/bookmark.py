"""Incremental ingestion with Structured Streaming: the streaming checkpoint is the bookmark.

A folder receives change files (Parquet) — exported from the source by ``export_changes``
or dropped by any CDC tool. ``ingest_changes`` reads that folder as a file stream with
``trigger(availableNow=True)``: each run processes exactly the files that arrived since the
previous run, however old their time stamps (the checkpoint remembers names) and then stops, like a scheduled batch job
that keeps its bookmark. Every micro-batch goes through ``foreachBatch`` into the same
jobs as the batch path: ``upsert_changes`` (update) or ``append_changes`` with key dedupe
(insert). Both are idempotent, so a micro-batch replayed after a failure leaves the same
lake; together with the checkpoint this gives exactly-once results in the lake. Updates
keep the newest version by the change column, so a late file with older changes does not
overwrite newer ones.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewater import fs
from tidewater.functions.windows import as_date
from tidewater.operators.changes import change_window
from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import append_changes, upsert_changes


# The file source forgets, and by default never reads, files older than this against the newest
# it has seen; no file gets that old, so a late one is read whenever it comes. The price is a
# checkpoint that remembers every file name.
_NEVER_TOO_OLD = "36500d"


def checkpoint_location(ctx: EngineContext, name: str, action: str, changes_dir: str) -> str:
    """Default bookmark folder: next to the lake tables, hidden from partition discovery; one
    for each table, action and drop folder."""
    folder = hashlib.sha256(fs.qualify(ctx.spark, changes_dir).encode()).hexdigest()[:16]
    return f"{ctx.lake_root}/_tidewater_checkpoints/{name}/{action}-{folder}"


def export_changes(ctx: EngineContext, name: str, changes_dir: str, as_of=None, days: int = 1,
                   role: str = "changed") -> None:
    """Append the source's change window (``role`` "changed" or "created") to the drop folder."""
    spec = ctx.spec(name)
    column = spec.change_column if role == "changed" else spec.created_column
    if not column:
        raise ValueError(f"table {name!r} has no {role} column")
    window = change_window(ctx.source.table(name), column, as_date(as_of), days)
    window.write.mode("append").parquet(changes_dir)


def ingest_changes(ctx: EngineContext, name: str, changes_dir: str, schema: T.StructType,
                   action: str = "update", checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None, latest_only: bool = True,
                   wait: bool = True) -> StreamingQuery:
    """Run the stream over the files not yet processed, then stop (availableNow).

    ``latest_only`` keeps the newest version of a key when several arrive in one batch.
    """
    if action not in ("update", "insert"):
        raise ValueError("action must be 'update' or 'insert'")

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if action == "update":
            upsert_changes(ctx, name, batch, latest_only=latest_only)
        else:
            append_changes(ctx, name, batch, dedupe_on_key=True)

    reader = ctx.spark.readStream.schema(schema).option("maxFileAge", _NEVER_TOO_OLD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.parquet(changes_dir).writeStream
             .queryName(f"tidewater-{action}-{name}")
             .option("checkpointLocation", checkpoint or checkpoint_location(ctx, name, action, changes_dir))
             .foreachBatch(apply)
             .trigger(availableNow=True)
             .start())
    if wait:
        query.awaitTermination()
    return query
