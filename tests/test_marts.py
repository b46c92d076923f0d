"""Mart, summary and collections semantics on invented rows; both mart plans
(over staging, and single pass over the inputs) must give the same rows."""

import datetime as dt
from decimal import Decimal as D

import pytest

from lendlake.operators import marts, views
from lendlake.plans.layers import Settings, build_marts, stage
from lendlake.sources.raw import literal_inputs
from tests.test_rules import cust, inst, loan, pay

AS_OF = dt.date(2025, 4, 14)


def days_before(n):
    return AS_OF - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def raw(spark):
    installments = [
        inst("I1", lid="L1", number=1, due=days_before(5), status="DUE"),  # overpaid
        inst("I2", lid="L1", number=2, due=days_before(5), status="PARTIAL"),  # two payments
        inst("B0", lid="L2", number=1, due=AS_OF, status="DUE"),
        inst("B1", lid="L2", number=2, due=days_before(1), status="DUE"),
        inst("B30", lid="L2", number=3, due=days_before(30), status="DUE"),
        inst("B31", lid="L2", number=4, due=days_before(31), status="DUE"),
        inst("B60", lid="L2", number=5, due=days_before(60), status="DUE"),
        inst("B61", lid="L2", number=6, due=days_before(61), status="DUE"),
        inst("B90", lid="L2", number=7, due=days_before(90), status="DUE"),
        inst("B91", lid="L2", number=8, due=days_before(91), status="DUE"),
        inst("LATE", lid="L3", number=1, due=AS_OF + dt.timedelta(days=3), status="LATE"),
        inst("NODUE", lid="L3", number=2, due=None, status="DUE"),
        inst("NOST", lid="L3", number=3, due=days_before(10), status=None),
        inst("PAID", lid="L3", number=4, due=days_before(40), status="PAID"),
        inst("ANOM", lid="L3", number=40, due=days_before(40), status="DUE"),
    ]
    payments = [
        pay("P1", lid="L1", iid="I1", amount=D("500.00"), date=days_before(4)),
        pay("P2", lid="L1", iid="I2", amount=D("20.00"), date=days_before(3)),
        pay("P3", lid="L1", iid="I2", amount=D("30.00"), date=days_before(2)),
        pay("P4", lid="L3", iid="LATE", amount=D("10.00"), date=days_before(1)),
        pay("P5", lid="L2", iid="B1", amount=D("10.00"), date=AS_OF),  # DUE paid late
        pay("P6", lid="L3", iid="PAID", amount=D("110.00"), date=days_before(1)),
        pay("P7", lid=None, iid="I2", amount=D("5.00"), date=days_before(1)),  # N20
        pay("P8", lid="L2", iid="I1", amount=D("99.00"), date=days_before(1)),  # mismatch
        pay("P9", lid="L3", iid="ANOM", amount=D("99.00"), date=days_before(1)),  # orphan
    ]
    return literal_inputs(
        spark,
        customers=[cust("C1")],
        loans=[loan("L1"), loan("L2"), loan("L3", term=12)],
        installments=installments,
        payments=payments,
    )


@pytest.fixture(scope="module")
def mart(raw):
    return marts.dm_cartera_from_inputs(
        raw.customers, raw.loans, raw.installments, raw.payments, AS_OF
    )


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_both_mart_plans_agree(raw, mart):
    s = Settings(analysis_date=AS_OF)
    staged = build_marts(stage(raw, s), s).cartera
    assert _rows(staged) == _rows(mart)


def test_mart_rows(mart):
    m = {r.installment_id: r for r in mart.collect()}
    assert "ANOM" not in m  # anomalous installments stay out of the mart
    assert m["I1"].balance_due == D("0.00") and m["I1"].total_paid == D("500.00")
    assert m["I2"].total_paid == D("55.00") and m["I2"].num_payments == 3  # no fan-out
    buckets = {k: m[k].mora_bucket for k in ("B0", "B1", "B30", "B31", "B60", "B61", "B90", "B91")}
    assert buckets == {
        "B0": "VIGENTE", "B1": "MORA_1_30", "B30": "MORA_1_30", "B31": "MORA_31_60",
        "B60": "MORA_31_60", "B61": "MORA_61_90", "B90": "MORA_61_90", "B91": "MORA_90_MAS",
    }
    assert not m["B0"].is_overdue and m["B0"].days_overdue == 0  # N12
    late = m["LATE"]
    assert late.is_overdue and late.days_overdue == -3 and late.mora_bucket == "VIGENTE"  # N11
    assert m["NODUE"].mora_bucket == "OTRO"  # N13
    nost = m["NOST"]
    assert (nost.is_overdue, nost.days_overdue, nost.mora_bucket) == (False, 0, "MORA_1_30")  # N24
    assert m["PAID"].mora_bucket == "PAID" and not m["PAID"].is_overdue


def test_summary_health(spark):
    from lendlake.functions.banding import loan_health
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(d,) for d in (0, 1, 30, 31, 90, 91, -5, None)], "d bigint")
    got = [r.h for r in df.select(loan_health(F.col("d")).alias("h")).collect()]
    assert got == [
        "AL_DIA", "ATRASO_LEVE", "ATRASO_LEVE", "ATRASO_MODERADO", "ATRASO_MODERADO",
        "DETERIORO_SEVERO", "ATRASO_LEVE", "DETERIORO_SEVERO",
    ]


def test_summary_totals(mart):
    s = {r.loan_id: r for r in marts.dm_resumen_credito(mart).collect()}
    l2 = s["L2"]
    assert l2.num_installments == 8 and l2.max_days_overdue == 91
    assert l2.loan_health == "DETERIORO_SEVERO"
    assert l2.saldo_mora + l2.saldo_vigente == l2.total_balance_due  # all unpaid


def test_collections_arrears_flag(spark):
    due = dt.date(2025, 3, 1)
    later = dt.date(2025, 3, 20)
    raw = literal_inputs(
        spark,
        customers=[cust("C1")],
        loans=[loan("L1")],
        installments=[
            inst("LATE", number=1, due=dt.date(2025, 4, 1), status="LATE"),
            inst("PART", number=2, due=due, status="PARTIAL"),
            inst("DUE", number=3, due=due, status="DUE"),
            inst("PAID", number=4, due=due, status="PAID"),
        ],
        payments=[pay(f"P{k}", iid=k, date=later) for k in ("LATE", "PART", "DUE", "PAID")],
    )
    st = stage(raw)
    pe = views.collections_enriched(st.customers, st.loans, st.installments, st.payments)
    flags = {r.payment_id: r.aplica_mora for r in pe.collect()}
    assert flags == {"PLATE": True, "PPART": True, "PDUE": False, "PPAID": False}  # N15


def test_both_collections_plans_agree(raw):
    st = stage(raw, Settings(analysis_date=AS_OF))
    staged = views.collections_enriched(st.customers, st.loans, st.installments, st.payments)
    lean = views.collections_from_inputs(raw.customers, raw.loans, raw.installments, raw.payments)
    cols = sorted(set(lean.columns))
    assert set(cols) <= set(staged.columns)  # the star join also carries customer_id
    assert _rows(staged.select(*cols)) == _rows(lean.select(*cols))
    assert {r.payment_id for r in lean.collect()} == {"P1", "P2", "P3", "P4", "P5", "P6"}


def test_payments_meet_copied_installments_in_every_plan_alike(spark):
    day, due = dt.date(2024, 12, 31), dt.date(2024, 6, 1)

    def line(id_, loan, number=1, total=100):
        return (id_, loan, number, due, D(total), D("1.00"), "DUE")

    def paid_(n, loan, id_, amount, status="CONFIRMED"):
        return (f"P{n}", loan, id_, dt.date(2024, 6, n), D(amount), "PSE", status, None)

    raw = literal_inputs(
        spark,
        customers=[("C1", "Ana", "bogota", "SME", D("10.00"), None), ("C1", "Eva", "cali", "SME", D("11.00"), None)],
        loans=[(f"L{i}", "C1" if i < 5 else "C9", dt.date(2024, 1, i), D("1000.00"), D("0.240000"), 12, "ACTIVE", "SME")
               for i in (1, 2, 2, 3, 5)],
        installments=[
            line("I1", "L1"), line("I1", "L1"),  # the same row twice
            line("I2", "L1"), line("I2", "L2", total=200), line("I2", "L5"),  # copies in other loans, one not valid
            line("I3", "L3"), line("I4", "L3", number=13), line("I5", None), line(None, "L3"), line("I6", "L3"),
        ],
        payments=[
            paid_(1, "L1", "I1", "5.00"), paid_(2, None, "I1", "6.00"), paid_(3, "L2", "I1", "7.00"),
            paid_(4, "L1", "I2", "8.00"), paid_(5, "L2", "I2", "9.00"), paid_(6, "L2", "I2", "9.50"), paid_(7, "L5", "I2", "1.00"),
            paid_(8, None, "I3", "2.00"), paid_(9, "L3", "I4", "3.00"), paid_(10, None, None, "4.00"), paid_(11, "L1", "I6", "4.00"),
            paid_(12, "L3", "I3", "2.50", "REVERSED"), paid_(13, "L2", "I1", "7.00"),
        ],
    )
    settings = Settings(analysis_date=day, segments=("SME",))
    s = stage(raw, settings)
    args = (raw.customers, raw.loans, raw.installments, raw.payments, day, ("SME",))
    plans = [
        marts.dm_cartera(s.customers, s.loans, s.installments, s.payments, day),
        marts.dm_cartera_from_inputs(*args),
        marts.dm_cartera_by_loan(*args),
    ]
    rows = [sorted(map(repr, df.collect())) for df in plans]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 6
    paid = sorted((r.installment_id, r.loan_id, str(r.total_paid), r.num_payments, r.last_payment_date and r.last_payment_date.day)
                  for r in plans[2].collect())
    assert paid == [
        ("I1", "L1", "11.00", 2, 2), ("I1", "L1", "11.00", 2, 2), ("I2", "L1", "18.50", 2, 6),
        ("I2", "L2", "18.50", 2, 6), ("I3", "L3", "2.00", 1, 8), ("I6", "L3", "0.00", 0, None),
    ]
    assert plans[2].dtypes == plans[1].dtypes
