"""Data-quality checks: the source's constraints (NOT NULL, PRIMARY KEY, UNIQUE,
REFERENCES, value lists, VARCHAR(n), NUMERIC(p,s)) re-run over lake or source frames.
Each check returns the violating rows (empty frame = check passed)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FOUND = "__tw_found"


def _any(conds):
    out = None
    for c in conds:
        out = c if out is None else (out | c)
    return out if out is not None else F.lit(False)


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of ``columns`` is NULL."""
    return df.where(_any(F.col(c).isNull() for c in columns))


def dq_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n``.

    A hash aggregate with map-side partial counts: a hot key costs one row per task in the
    shuffle, however many rows it has.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def dq_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of a UNIQUE column set that repeat (NULLs are exempt, as in SQL)."""
    return dq_primary_key(df.where(~_any(F.col(c).isNull() for c in columns)), columns)


def dq_missing_references(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                          parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct (non-NULL) references of ``child`` with no parent row, with ``n_refs``, the
    number of child rows holding each.

    References are counted first (map-side partial aggregation collapses a hot key to one
    row per task before any shuffle) and only then matched with the distinct parent keys.
    The match is a left join + NULL test rather than an anti-join on purpose: the optimizer
    would push an anti-join below the aggregation and shuffle every child row.
    """
    child_keys = list(child_keys)
    parent_keys = list(parent_keys or child_keys)
    refs = (child.where(~_any(F.col(c).isNull() for c in child_keys))
            .groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n_refs")))
    parents = (parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)])
               .distinct().withColumn(_FOUND, F.lit(True)))
    return (refs.join(parents, child_keys, "left")
            .where(F.col(_FOUND).isNull()).select(*child_keys, "n_refs"))


def dq_foreign_key(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                   parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row.

    The missing references are found on pre-aggregated keys (``dq_missing_references``)
    and semi-joined back to the child rows; AQE broadcasts them when they are few.
    """
    missing = dq_missing_references(child, parent, child_keys, parent_keys).drop("n_refs")
    return child.join(missing, list(child_keys), "left_semi")


def dq_allowed_values(df: DataFrame, column: str, allowed: Iterable, allow_null: bool = True) -> DataFrame:
    """Rows whose ``column`` is outside the allowed list."""
    c = F.col(column)
    bad = ~c.isin(list(allowed))
    if not allow_null:
        bad = bad | c.isNull()
    return df.where(F.coalesce(bad, F.lit(not allow_null)))


def dq_max_length(df: DataFrame, column: str, max_length: int) -> DataFrame:
    """Rows whose string ``column`` is longer than ``max_length`` characters (VARCHAR(n))."""
    return df.where(F.length(F.col(column)) > max_length)


def dq_decimal_fit(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Rows whose value does not fit NUMERIC(precision, scale): too many integer digits
    (the cast overflows to NULL) or more decimals than ``scale`` (the cast changes it)."""
    c = F.col(column)
    cast = c.try_cast(f"decimal({precision},{scale})")
    return df.where(c.isNotNull() & (cast.isNull() | (cast != c)))


# ------------------------------------------------------------------ a table's whole rule set

@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Constraints:
    """The constraint set of one table, as its DDL states it."""

    not_null: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    allowed: Mapping[str, tuple] = field(default_factory=dict)
    max_length: Mapping[str, int] = field(default_factory=dict)
    decimal: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    references: tuple[ForeignKey, ...] = ()


def _row_rules(c: Constraints) -> list[tuple[str, str, object]]:
    rules = [("not_null", col, F.col(col).isNull()) for col in c.not_null]
    for col, values in c.allowed.items():
        rules.append(("allowed_values", col, F.coalesce(~F.col(col).isin(list(values)), F.lit(False))))
    for col, n in c.max_length.items():
        rules.append(("max_length", col, F.coalesce(F.length(F.col(col)) > n, F.lit(False))))
    for col, (p, s) in c.decimal.items():
        cast = F.col(col).try_cast(f"decimal({p},{s})")
        rules.append(("decimal_fit", col, F.col(col).isNotNull() & (cast.isNull() | (cast != F.col(col)))))
    return rules


def dq_summary(df: DataFrame, constraints: Constraints,
               parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(rule, columns, violations)`` for every rule of ``constraints``.

    All row-level rules are counted in ONE aggregate pass over ``df`` (a conditional count
    per rule, partial aggregation map-side). Key rules add one aggregate each: duplicate
    rows beyond the first for PRIMARY KEY / UNIQUE, child rows without a parent for each
    reference (on pre-aggregated references, see ``dq_missing_references``).
    """
    parents = parents or {}
    parts: list[DataFrame] = []
    rules = _row_rules(constraints)
    if rules:
        counts = df.agg(*[F.count(F.when(cond, F.lit(1))).alias(f"r{i}") for i, (_, _, cond) in enumerate(rules)])
        stacked = ", ".join(f"'{kind}', '{col}', r{i}" for i, (kind, col, _) in enumerate(rules))
        parts.append(counts.selectExpr(f"stack({len(rules)}, {stacked}) AS (rule, columns, violations)"))
    key_sets = [("primary_key", constraints.primary_key)] if constraints.primary_key else []
    key_sets += [("unique", cols) for cols in constraints.unique]
    for kind, cols in key_sets:
        src = df if kind == "primary_key" else df.where(~_any(F.col(c).isNull() for c in cols))
        dup = dq_primary_key(src, cols).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
        parts.append(dup.select(F.lit(kind).alias("rule"), F.lit(",".join(cols)).alias("columns"),
                                F.col("violations").cast("long")))
    for fk in constraints.references:
        if fk.parent not in parents:
            raise ValueError(f"no parent frame given for {fk.parent!r}")
        missing = dq_missing_references(df, parents[fk.parent], fk.columns, fk.parent_columns)
        parts.append(missing.agg(F.coalesce(F.sum("n_refs"), F.lit(0)).cast("long").alias("violations"))
                     .select(F.lit("foreign_key").alias("rule"), F.lit(",".join(fk.columns)).alias("columns"),
                             "violations"))
    if not parts:
        raise ValueError("no rules given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Constraints of the financial source schema (NOT NULL, keys, value lists stated
# in the DDL comments, VARCHAR lengths, NUMERIC(15,2)).
REFERENCE_CONSTRAINTS: dict[str, Constraints] = {
    "customers": Constraints(
        not_null=("customer_id", "first_name", "last_name", "email", "is_active", "created_at", "last_updated_at"),
        primary_key=("customer_id",),
        unique=(("email",),),
        max_length={"first_name": 100, "last_name": 100, "email": 255, "phone_number": 20},
    ),
    "accounts": Constraints(
        not_null=("account_id", "customer_id", "account_type", "balance", "status", "created_at", "last_updated_at"),
        primary_key=("account_id",),
        allowed={"account_type": ("CHECKING", "SAVINGS", "LOAN"), "status": ("OPEN", "CLOSED", "FROZEN")},
        max_length={"account_type": 50, "status": 20},
        decimal={"balance": (15, 2)},
        references=(ForeignKey(("customer_id",), "customers", ("customer_id",)),),
    ),
    "transactions": Constraints(
        not_null=("transaction_id", "account_id", "transaction_type", "amount", "transaction_time",
                  "ingestion_time", "created_at"),
        primary_key=("transaction_id",),
        allowed={"transaction_type": ("DEPOSIT", "WITHDRAWAL", "TRANSFER")},
        max_length={"transaction_type": 50},
        decimal={"amount": (15, 2)},
        references=(ForeignKey(("account_id",), "accounts", ("account_id",)),),
    ),
}
