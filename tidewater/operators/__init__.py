"""DataFrame -> DataFrame operators."""

from tidewater.operators.changes import (  # noqa: F401
    change_window,
    has_changes,
    has_changes_frame,
    latest_per_key,
)
from tidewater.operators.inventory import (  # noqa: F401
    collect_partitions,
    distinct_partitions,
    partition_inventory,
    preview,
    row_count,
)
from tidewater.operators.merge import (  # noqa: F401
    align_columns,
    drop_stale_changes,
    merge_image,
    touched_partitions,
    unchanged_rows,
)
from tidewater.operators.quality import (  # noqa: F401
    REFERENCE_CONSTRAINTS,
    Constraints,
    ForeignKey,
    dq_summary,
    dq_allowed_values,
    dq_decimal_fit,
    dq_foreign_key,
    dq_max_length,
    dq_missing_references,
    dq_not_null,
    dq_primary_key,
    dq_unique,
)
from tidewater.operators.staging import Staged, cleanup_scratch, materialise  # noqa: F401
