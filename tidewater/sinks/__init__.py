"""Lake writes."""

from tidewater.sinks.lake import (  # noqa: F401
    drop_partitions,
    lake_append,
    lake_replace,
    lake_replace_where,
    write_lake,
)
