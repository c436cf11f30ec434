"""Where rows come from: source tables (files, JDBC, frames) and lake reads."""

from tidewater.sources.catalog import list_source_tables, scan_one_or_many, table_counts  # noqa: F401
from tidewater.sources.files import FrameSource, ParquetSource  # noqa: F401
from tidewater.sources.jdbc import JdbcPartitioning, JdbcSource  # noqa: F401
from tidewater.sources.lake import lake_exists, lake_partition_scan, lake_scan  # noqa: F401
