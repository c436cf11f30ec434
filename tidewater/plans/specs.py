"""What each table and each action needs to know."""

from __future__ import annotations

from dataclasses import dataclass

from tidewater.functions.partitions import partition_columns


@dataclass(frozen=True)
class TableSpec:
    """One source table.

    ``created_column`` drives ``insert`` windows and, by default, the lake partitioning;
    ``change_column`` (last-updated stamp) drives ``update`` windows. ``partition_column``
    overrides the partitioning column (set it to the change column to let rows move with
    their last change). ``stable_partitions=True`` promises that a key never changes partition,
    not even by a correction of its created stamp; only then does ``update`` skip looking the
    changed keys up outside their own partitions. ``references`` names the tables that this one's
    foreign keys point to: a full run loads them first. ``evolve`` lets new columns and wider types
    into the lake (see ``plans.evolution``); ``cluster_by`` sorts the rows of a partition along a
    curve over those columns.
    """

    name: str
    keys: tuple[str, ...] = ()
    created_column: str | None = None
    change_column: str | None = None
    partition_column: str | None = None
    grain: str = "day"
    stable_partitions: bool = False
    references: tuple[str, ...] = ()
    evolve: bool = False
    cluster_by: tuple[str, ...] = ()

    def __post_init__(self):
        partition_columns(self.grain)  # validates
        if isinstance(self.keys, str):
            object.__setattr__(self, "keys", (self.keys,))
        else:
            object.__setattr__(self, "keys", tuple(self.keys))
        for name in ("references", "cluster_by"):
            value = getattr(self, name)
            object.__setattr__(self, name, (value,) if isinstance(value, str) else tuple(value))

    @property
    def partition_by(self) -> str | None:
        return self.partition_column or self.created_column

    @property
    def partition_cols(self) -> tuple[str, ...]:
        return partition_columns(self.grain) if self.partition_by else ()

    @property
    def moves_with_change(self) -> bool:
        """Whether rows are expected to leave their partition with every change."""
        return self.partition_by == self.change_column


@dataclass(frozen=True)
class ActionSpec:
    """An action: allowed modes, which time column selects rows, and how it writes."""

    name: str
    modes: tuple[str, ...]
    time_role: str | None  # "created" | "changed" | None (whole table)
    write: str  # "append" | "upsert" | "overwrite"


# Fixed values of the actions (same modes and time roles as the job being replaced).
ACTIONS: dict[str, ActionSpec] = {
    "insert": ActionSpec("insert", ("full", "partial"), "created", "append"),
    "update": ActionSpec("update", ("full", "partial"), "changed", "upsert"),
    "refresh": ActionSpec("refresh", ("full", "partial"), None, "overwrite"),
}


def action_parameters(action: str) -> ActionSpec:
    try:
        return ACTIONS[action]
    except KeyError:
        raise ValueError(f"unknown action {action!r}; use one of {sorted(ACTIONS)}") from None


# The three tables of the financial source schema and their CDC columns.
REFERENCE_TABLES: dict[str, TableSpec] = {
    "customers": TableSpec("customers", ("customer_id",), "created_at", "last_updated_at"),
    "accounts": TableSpec("accounts", ("account_id",), "created_at", "last_updated_at", references=("customers",)),
    "transactions": TableSpec("transactions", ("transaction_id",), "created_at", None, references=("accounts",)),
}
