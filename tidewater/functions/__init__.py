"""Column expressions (JVM-side built-ins only; no Python UDFs)."""

from tidewater.functions.partitions import (  # noqa: F401
    GRAINS,
    PARTITION_DATE,
    derive_partition_columns,
    partition_columns,
    partition_dir,
    partition_filter,
    partition_key_strings,
    partition_path,
    partition_predicate_frame,
)
from tidewater.functions.windows import (  # noqa: F401
    as_date,
    change_window_condition,
    window_bounds,
    window_partition_dates,
)
from tidewater.functions.stamps import change_stamp, column_defaults  # noqa: F401
