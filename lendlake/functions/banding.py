"""Range banding (C8, C10, E10): ageing bucket and loan health."""

from __future__ import annotations

from pyspark.sql import Column

from lendlake import constants as K
from lendlake.functions.rules import first_match


def ageing_bucket(status: Column, due_date: Column, as_of: Column, days: Column) -> Column:
    """Bucket of one installment as of a date; ``days`` = as_of - due_date.

    PAID first, then not yet due, then the day bands; OTRO only when the due
    date is NULL (N13).
    """
    rules = [(status == K.BUCKET_PAID, K.BUCKET_PAID), (due_date >= as_of, K.BUCKET_CURRENT)]
    rules += [(days.between(lo, hi), label) for lo, hi, label in K.BUCKET_BOUNDS]
    rules += [(days > K.MODERATE_MAX_DAYS, K.BUCKET_90_PLUS)]
    return first_match(rules, K.BUCKET_OTHER)


def loan_health(max_days: Column) -> Column:
    """Health class from the worst days overdue; NULL falls to SEVERE."""
    return first_match(
        [
            (max_days == 0, K.HEALTH_UP_TO_DATE),
            (max_days <= K.MILD_MAX_DAYS, K.HEALTH_MILD),
            (max_days <= K.MODERATE_MAX_DAYS, K.HEALTH_MODERATE),
        ],
        K.HEALTH_SEVERE,
    )
