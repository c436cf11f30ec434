"""The financial source schema's rules (constraints and column defaults) on small fixtures
whose violations are counted by hand."""

import datetime as dt
from decimal import Decimal

from tidewater.functions.stamps import REFERENCE_DEFAULTS, column_defaults
from tidewater.operators.quality import REFERENCE_CONSTRAINTS, dq_summary

T = dt.datetime(2024, 1, 1)
CUSTOMERS = "customer_id long, first_name string, last_name string, email string, phone_number string, " \
            "current_address string, is_active boolean, created_at timestamp_ntz, last_updated_at timestamp_ntz"
ACCOUNTS = "account_id long, customer_id long, account_type string, balance decimal(20,4), status string, " \
           "created_at timestamp_ntz, last_updated_at timestamp_ntz"


def _summary(df, table, parents=None):
    out = dq_summary(df, REFERENCE_CONSTRAINTS[table], parents)
    return {(r.rule, r.columns): r.violations for r in out.collect() if r.violations}


def test_customer_rules(spark):
    customers = spark.createDataFrame([
        (1, "Ada", "Stone", "s@x", "555-0100", "1 Quay\nPort", True, T, T),
        (2, "C" * 101, "Vale", "s@x", None, None, True, T, T),          # name too long, email repeats
        (2, "Ivo", None, "i@x", "+1-" + "9" * 20, None, None, T, T),       # id repeats, 2 NULLs, phone too long
    ], CUSTOMERS)
    assert _summary(customers, "customers") == {
        ("not_null", "last_name"): 1, ("not_null", "is_active"): 1, ("max_length", "first_name"): 1,
        ("max_length", "phone_number"): 1, ("primary_key", "customer_id"): 1, ("unique", "email"): 1}


def test_account_rules_with_reference(spark):
    customers = spark.createDataFrame([(1, "a", "b", "e", None, None, True, T, T)], CUSTOMERS)
    accounts = spark.createDataFrame([
        (10, 1, "CHECKING", Decimal("10.50"), "OPEN", T, T),
        (11, 1, "BROKERAGE", Decimal("1.239"), "OPEN", T, T),             # type not allowed, 3 decimals
        (12, 7, "LOAN", Decimal("10000000000000.00"), "SUSPENDED", T, T),  # no customer 7, too big, bad status
    ], ACCOUNTS)
    assert _summary(accounts, "accounts", {"customers": customers}) == {
        ("allowed_values", "account_type"): 1, ("allowed_values", "status"): 1,
        ("decimal_fit", "balance"): 2, ("foreign_key", "customer_id"): 1}


def test_account_defaults(spark):
    accounts = spark.createDataFrame([(10, 1, "LOAN", None, None, None, None)], ACCOUNTS)
    row = column_defaults(accounts, REFERENCE_DEFAULTS["accounts"]).first()
    assert row.balance == Decimal("0") and row.status == "OPEN"
    assert row.created_at is not None and row.last_updated_at is not None
    tx = spark.createDataFrame([(None, 5)], "transaction_id string, account_id long")
    got = column_defaults(tx, {"transaction_id": REFERENCE_DEFAULTS["transactions"]["transaction_id"]}).first()
    assert len(got.transaction_id) == 36
