"""Staging layer (A1-A5): clean, standardise and flag every raw row.

No row is dropped: validity is data (``is_valid``, ``is_anomalous``,
``is_orphan``, ``is_loan_mismatch``) plus the text of the first failing rule
(``quality_issue``). Rules are tested on the cleaned value while the message
quotes the raw one (N2). Load-time columns are added by the sink (N22).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.functions.rules import not_in, reason, validity
from lendlake.functions.text import (
    blank_to_null,
    capitalize_first,
    clean_upper,
    is_blank,
    message,
    text,
    trim_ws,
)
from lendlake.operators.keys import key_set, one_per_key
from lendlake.operators.marts import LOAN_ATTRIBUTES

CUSTOMER_COLUMNS = [
    "customer_id", "full_name", "city", "segment", "monthly_income", "created_at",
    "is_valid", "quality_issue",
]
LOAN_COLUMNS = [
    "loan_id", "customer_id", "origination_date", "principal_amount", "annual_rate",
    "monthly_rate", "term_months", "loan_status", "product_type", "cohort_month",
    "is_valid", "quality_issue",
]
INSTALLMENT_COLUMNS = [
    "installment_id", "loan_id", "installment_number", "due_date", "principal_due",
    "interest_due", "total_due", "installment_status", "is_valid", "is_anomalous",
    "quality_issue",
]
PAYMENT_COLUMNS = [
    "payment_id", "loan_id", "installment_id", "payment_date", "payment_amount",
    "payment_channel", "payment_status", "loaded_at", "is_orphan", "is_loan_mismatch",
    "is_valid", "quality_issue",
]
REJECTED_COLUMNS = [
    "payment_id", "loan_id", "installment_id", "payment_date", "payment_amount",
    "payment_channel", "payment_status", "quality_issue",
]


def _non_positive(c):
    return F.col(c).isNull() | (F.col(c) <= 0)


def _negative(c):
    return F.col(c).isNull() | (F.col(c) < 0)


def customer_rules(segments: Sequence[str]) -> list:
    """Ordered (failure condition, reason) rules of a customer row."""
    return [
        (F.col("customer_id").isNull(), K.REASON_NULL_CUSTOMER_ID),
        (is_blank("full_name"), K.REASON_NULL_FULL_NAME),
        (is_blank("city"), K.REASON_NULL_CITY),
        (not_in(clean_upper("segment"), segments),
         message(K.REASON_UNKNOWN_SEGMENT, F.col("segment"))),
        (_non_positive("monthly_income"), K.REASON_BAD_INCOME),
    ]


def customer_columns() -> list:
    return [
        F.col("customer_id"),
        trim_ws("full_name").alias("full_name"),
        capitalize_first("city").alias("city"),
        clean_upper("segment").alias("segment"),
        F.col("monthly_income"),
        F.col("created_at"),
    ]


def stg_customers(customers: DataFrame, segments: Sequence[str] = K.SEGMENTS) -> DataFrame:
    """A1: trim name, capitalise city, upper segment, flag."""
    rules = customer_rules(segments)
    return customers.select(
        *customer_columns(),
        validity([c for c, _ in rules]).alias("is_valid"),
        reason(rules).alias("quality_issue"),
    )


def loan_rules(missing_customer: Column) -> list:
    """Ordered rules of a loan row; ``missing_customer`` is the parent test."""
    bad_rate = (
        F.col("annual_rate").isNull() | (F.col("annual_rate") <= 0) | (F.col("annual_rate") >= 1)
    )
    return [
        (F.col("loan_id").isNull(), K.REASON_NULL_LOAN_ID),
        (F.col("customer_id").isNull(), K.REASON_NULL_CUSTOMER_ID),
        (missing_customer, message(K.REASON_MISSING_CUSTOMER, text("customer_id"))),
        (_non_positive("principal_amount"), K.REASON_BAD_PRINCIPAL),
        (bad_rate, K.REASON_BAD_RATE),
        (_non_positive("term_months"), K.REASON_BAD_TERM),
        (not_in(clean_upper("loan_status"), K.LOAN_STATUSES),
         message(K.REASON_UNKNOWN_LOAN_STATUS, F.col("loan_status"))),
    ]


def loan_columns() -> list:
    return [
        F.col("loan_id"),
        F.col("customer_id"),
        F.col("origination_date"),
        F.col("principal_amount"),
        F.col("annual_rate"),
        F.round(F.col("annual_rate") / F.lit(12), 6).cast(K.RATE).alias("monthly_rate"),
        F.col("term_months"),
        clean_upper("loan_status").alias("loan_status"),
        trim_ws("product_type").alias("product_type"),
        F.trunc("origination_date", "MM").alias("cohort_month"),
    ]


def stg_loans(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """A2: monthly rate, cohort month, flags; the customer must exist and be valid."""
    valid_customers = key_set(customers.where("is_valid"), "customer_id", "_customer_ok")
    j = loans.join(valid_customers, "customer_id", "left")
    rules = loan_rules(F.col("_customer_ok").isNull())
    return j.select(
        *loan_columns(),
        validity([c for c, _ in rules]).alias("is_valid"),
        reason(rules).alias("quality_issue"),
    )


def installment_rules(missing_loan: Column) -> list:
    """Ordered validity rules of an installment row (the anomaly rule, which
    does not invalidate, is added to the reasons only)."""
    return [
        (F.col("installment_id").isNull(), K.REASON_NULL_INSTALLMENT_ID),
        (F.col("loan_id").isNull(), K.REASON_NULL_LOAN_ID),
        (missing_loan, message(K.REASON_MISSING_LOAN, text("loan_id"))),
        (_negative("principal_due"), K.REASON_BAD_PRINCIPAL_DUE),
        (_negative("interest_due"), K.REASON_BAD_INTEREST_DUE),
        (not_in(clean_upper("installment_status"), K.INSTALLMENT_STATUSES),
         message(K.REASON_UNKNOWN_INSTALLMENT_STATUS, F.col("installment_status"))),
    ]


def total_due() -> Column:
    return (F.col("principal_due") + F.col("interest_due")).cast("decimal(19,2)")


def installment_columns() -> list:
    return [
        F.col("installment_id"),
        F.col("loan_id"),
        F.col("installment_number"),
        F.col("due_date"),
        F.col("principal_due"),
        F.col("interest_due"),
        total_due().alias("total_due"),
        clean_upper("installment_status").alias("installment_status"),
    ]


def beyond_term(number: Column, term: Column) -> Column:
    """Installment number above the loan's term (NULL compares as not beyond)."""
    return F.coalesce(number > term, F.lit(False))


def stg_installments(installments: DataFrame, loans: DataFrame) -> DataFrame:
    """A3: total due, flags; anomalous (number beyond term) is not invalid."""
    valid_loans = (
        # The same copy of a loan as in the marts, so the same term.
        one_per_key(loans.where("is_valid"), "loan_id", LOAN_ATTRIBUTES)
        .select("loan_id", F.col("term_months").alias("_term"))
        .withColumn("_loan_ok", F.lit(True))
    )
    j = installments.join(valid_loans, "loan_id", "left")
    anomalous = F.col("_loan_ok").isNotNull() & beyond_term(
        F.col("installment_number"), F.col("_term")
    )
    failures = installment_rules(F.col("_loan_ok").isNull())
    head, mid, tail = K.REASON_NUMBER_OVER_TERM
    over_term = message(head, text("installment_number"), mid, text("_term"), tail)
    return j.select(
        *installment_columns(),
        validity([c for c, _ in failures]).alias("is_valid"),
        F.when(anomalous, True).otherwise(False).alias("is_anomalous"),
        reason(failures + [(anomalous, over_term)]).alias("quality_issue"),
    )


def payment_status() -> Column:
    return clean_upper("payment_status")


def payment_own_failures() -> list:
    """Failure conditions of a payment that need no other table."""
    return [not_in(payment_status(), K.ACCEPTED_PAYMENT_STATUSES), F.col("payment_amount") <= 0]


def payment_columns() -> list:
    return [
        F.col("payment_id"),
        F.col("loan_id"),
        F.col("installment_id"),
        F.col("payment_date"),
        F.col("payment_amount"),
        F.coalesce(blank_to_null("payment_channel"), F.lit(K.UNKNOWN_CHANNEL)).alias(
            "payment_channel"
        ),
        payment_status().alias("payment_status"),
        F.col("loaded_at"),
    ]


def stg_payments(payments: DataFrame, installments: DataFrame) -> DataFrame:
    """A4: channel default, flags; a payment must hit a valid, normal installment
    of its own loan. A NULL payment loan is not a mismatch (N20)."""
    valid_installments = (
        one_per_key(installments.where("is_valid AND NOT is_anomalous"), "installment_id", ["loan_id"])
        .withColumnRenamed("loan_id", "_inst_loan_id")
        .withColumn("_inst_ok", F.lit(True))
    )
    j = payments.join(valid_installments, "installment_id", "left")
    status = payment_status()
    orphan = F.col("_inst_ok").isNull()
    mismatch = F.col("_inst_loan_id").isNotNull() & (F.col("_inst_loan_id") != F.col("loan_id"))
    is_orphan = F.when(orphan, True).otherwise(False)
    is_mismatch = F.when(mismatch, True).otherwise(False)
    head, tail = K.REASON_LOAN_MISMATCH
    reasons = [
        (status == "REVERSED", K.REASON_REVERSED),
        (status == "PENDING", K.REASON_PENDING),
        (F.col("payment_amount") <= 0, K.REASON_NON_POSITIVE_AMOUNT),
        (is_orphan, message(K.REASON_MISSING_INSTALLMENT, text("installment_id"))),
        (is_mismatch, message(head, text("loan_id"), tail)),
    ]
    failures = payment_own_failures() + [is_orphan, is_mismatch]
    return j.select(
        *payment_columns(),
        is_orphan.alias("is_orphan"),
        is_mismatch.alias("is_loan_mismatch"),
        validity(failures).alias("is_valid"),
        reason(reasons).alias("quality_issue"),
    )


def payments_rejected(payments: DataFrame) -> DataFrame:
    """A5: audit view of the payments that do not count as collections."""
    return payments.where(~F.col("is_valid")).select(*REJECTED_COLUMNS)


def passes(rules_or_failures: list) -> Column:
    """TRUE when no failure condition of the list is TRUE (rule order is
    irrelevant for the flag itself)."""
    conds = [r[0] if isinstance(r, tuple) else r for r in rules_or_failures]
    return validity(conds)
