"""Run by test_task_retries.py in its own JVM: master local[4,4] lets each task be retried
up to 4 times. The source frame fails the first attempt of some of its tasks (the failure
is injected in the test's input, not in the library); the jobs must still produce exactly
the failure-free result."""

import datetime as dt
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(out_root: str, marks: str) -> None:
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    import __spark_entry__ as E
    from tidewater.plans.context import EngineContext
    from tidewater.plans.jobs import refresh_table, update_table
    from tidewater.sources.files import FrameSource
    from tidewater.sources.lake import lake_scan

    spark = (SparkSession.builder.master("local[4,4]").appName("retries")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    sf = "/root/testdata/sf0.001"

    @F.udf(T.LongType())
    def flaky(v):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            os.makedirs(marks, exist_ok=True)
            open(os.path.join(marks, f"{ctx.stageId()}-{ctx.partitionId()}-{os.getpid()}-{id(v)}"), "w").close()
            raise RuntimeError("injected task failure")
        return v

    def with_failures(df):
        return df.repartition(4).withColumn("event_id", flaky("event_id"))

    ctx = EngineContext(spark, FrameSource({"events": lambda: with_failures(E.events_loaded(spark, sf))}),
                        out_root, {"events": E.EVENTS_MOVING_SPEC})
    refresh_table(ctx, "events")
    after_refresh = lake_scan(spark, ctx.table_path("events")).count()
    ctx.source = FrameSource({"events": lambda: with_failures(E.events_changed(spark, sf))})
    update_table(ctx, "events", dt.date(2024, 1, 25), 1)
    lake = lake_scan(spark, ctx.table_path("events"))
    rows = sorted((r.event_id, r.value, str(r.last_updated_at)) for r in lake.collect())
    print(json.dumps({"after_refresh": after_refresh, "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
