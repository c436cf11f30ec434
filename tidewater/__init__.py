"""tidewater: date-partitioned Parquet lake ingestion and change-data-capture on Spark.

The package is organised the way a Spark user would split such a job:

* ``tidewater.sources``   – where rows come from (files, JDBC, in-memory frames) and lake reads
* ``tidewater.sinks``     – lake writes (append, full replace, partition-scoped replace, drops)
* ``tidewater.functions`` – column expressions (partition columns, paths, windows, stamps)
* ``tidewater.operators`` – DataFrame -> DataFrame building blocks (change window, merge, quality)
* ``tidewater.plans``     – the user-level jobs (refresh / insert / update, run_action, CLI)
* ``tidewater.streaming`` – the same jobs driven incrementally by Structured Streaming

Everything is expressed with the DataFrame API so Catalyst does pushdown, pruning and join
planning; nothing is collected to the driver except partition lists, whose size is bounded by
the number of lake partitions, never by the number of rows.
"""

__version__ = "0.1.0"
