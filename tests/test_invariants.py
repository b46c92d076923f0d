
from pyspark.sql import functions as F

from lendlake.plans.registry import context
from lendlake.operators import questions
from tests.conftest import SMOKE


def _one(df, expr):
    return df.agg(expr.alias("v")).first().v


def test_staging_keeps_every_row(spark):
    c = context(spark, SMOKE)
    for name in ("customers", "loans", "installments", "payments"):
        assert getattr(c.staged, name).count() == getattr(c.raw, name).count(), name


def test_valid_plus_rejected_is_all(spark):
    c = context(spark, SMOKE)
    p = c.staged.payments
    assert p.where("is_valid").count() + c.staged.rejected_payments.count() == p.count()


def test_balances_and_arrears(spark):
    c = context(spark, SMOKE)
    m = c.mart
    assert m.where(F.col("balance_due") < 0).count() == 0
    s = c.summary
    arrears_plus_current = _one(s, F.sum(F.col("saldo_mora") + F.col("saldo_vigente")))
    unpaid = _one(m, F.sum(F.when(F.col("installment_status") != "PAID", F.col("balance_due"))
                           .when(F.col("is_overdue"), F.col("balance_due")).otherwise(0)))
    assert arrears_plus_current == unpaid
    assert _one(s, F.sum("num_installments")) == m.count()
    assert _one(s, F.sum("total_balance_due")) == _one(m, F.sum("balance_due"))


def test_origination_totals_agree(spark):
    c = context(spark, SMOKE)
    total = _one(c.origination, F.sum("monto_desembolsado"))
    assert total == _one(c.staged.loans.where("is_valid"), F.sum("principal_amount"))
    for q in (questions.q01a_disbursed_by_day, questions.q01b_disbursed_by_city,
              questions.q01c_disbursed_by_segment, questions.q01d_disbursed_by_day_city_segment):
        assert _one(q(c.origination), F.sum("monto_total_COP")) == total


def test_collections_totals_agree(spark):
    c = context(spark, SMOKE)
    daily = questions.q02_collections_by_day(c.collections)
    assert _one(daily, F.sum("recaudo_total_COP")) == _one(c.collections, F.sum("recaudo_total"))
    valid_with_loan = c.staged.payments.where("is_valid AND loan_id IS NOT NULL")
    assert _one(daily, F.sum("numero_pagos")) == valid_with_loan.count()  # N20
