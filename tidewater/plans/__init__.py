"""User-level jobs and their configuration."""

from tidewater.plans.context import EngineContext  # noqa: F401
from tidewater.plans.jobs import (  # noqa: F401
    ActionFailed,
    JobResult,
    append_changes,
    insert_table,
    prepare_and_save,
    refresh_table,
    run_action,
    run_table,
    update_table,
    upsert_changes,
)
from tidewater.plans.specs import ACTIONS, REFERENCE_TABLES, ActionSpec, TableSpec, action_parameters  # noqa: F401
