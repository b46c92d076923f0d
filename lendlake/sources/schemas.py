"""Typed schemas of the four raw inputs (B6). All columns are nullable; no keys
are declared, so validity is decided by the staging rules, not by the store."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_MONEY = DecimalType(18, 2)
_RATE = DecimalType(9, 6)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


CUSTOMERS = _s(
    ("customer_id", StringType()),
    ("full_name", StringType()),
    ("city", StringType()),
    ("segment", StringType()),
    ("monthly_income", _MONEY),
    ("created_at", DateType()),
)

LOANS = _s(
    ("loan_id", StringType()),
    ("customer_id", StringType()),
    ("origination_date", DateType()),
    ("principal_amount", _MONEY),
    ("annual_rate", _RATE),
    ("term_months", LongType()),
    ("loan_status", StringType()),
    ("product_type", StringType()),
)

INSTALLMENTS = _s(
    ("installment_id", StringType()),
    ("loan_id", StringType()),
    ("installment_number", LongType()),
    ("due_date", DateType()),
    ("principal_due", _MONEY),
    ("interest_due", _MONEY),
    ("installment_status", StringType()),
)

PAYMENTS = _s(
    ("payment_id", StringType()),
    ("loan_id", StringType()),
    ("installment_id", StringType()),
    ("payment_date", DateType()),
    ("payment_amount", _MONEY),
    ("payment_channel", StringType()),
    ("payment_status", StringType()),
    ("loaded_at", TimestampType()),
)

RAW_SCHEMAS = {
    "customers": CUSTOMERS,
    "loans": LOANS,
    "installments": INSTALLMENTS,
    "payments": PAYMENTS,
}
