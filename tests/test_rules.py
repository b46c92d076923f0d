"""Rule fixture: one invented row per branch of the staging rules (FIXTURES.md
section 2), checked through the public staging functions."""

import datetime as dt
from decimal import Decimal as D

from lendlake.plans.layers import stage
from lendlake.sources.raw import literal_inputs

DAY = dt.date(2025, 1, 10)
TS = dt.datetime(2025, 1, 10, 8, 0)


def cust(cid, name="Ana", city="bogota", segment="PREMIUM", income=D("1000.00")):
    return (cid, name, city, segment, income, DAY)


def loan(lid, cid="C1", principal=D("1000.00"), rate=D("0.240000"), term=12, status="ACTIVE",
         product="Digital"):
    return (lid, cid, DAY, principal, rate, term, status, product)


def inst(iid, lid="L1", number=1, due=DAY, principal=D("100.00"), interest=D("10.00"),
         status="DUE"):
    return (iid, lid, number, due, principal, interest, status)


def pay(pid, lid="L1", iid="I1", amount=D("50.00"), channel="PSE", status="CONFIRMED",
        date=DAY, loaded=TS):
    return (pid, lid, iid, date, amount, channel, status, loaded)


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_customer_rules(spark):
    raw = literal_inputs(
        spark,
        customers=[
            cust("C1", name="  Ana \t", city=" bogota\t"),
            cust("C2", city="santa MARTA"),
            cust(None),
            cust("C4", name="   "),
            cust("C5", city=None),
            cust("C6", segment="Gold"),
            cust("C7", segment=None),
            cust("C8", income=D("0")),
            cust("C9", income=D("-5")),
            cust("C10", income=None),
            cust("C11", name=None, segment="Gold", income=None),
            cust("C12", segment=" mass market "),
        ],
    )
    rows = stage(raw).customers.collect()
    c = {r.customer_id: r for r in rows}
    assert c["C1"].is_valid and c["C1"].full_name == "Ana" and c["C1"].city == "Bogota"
    assert c["C2"].city == "Santa marta"
    null_id = [r for r in rows if r.customer_id is None][0]
    assert (null_id.is_valid, null_id.quality_issue) == (False, "NULL customer_id")
    assert c["C4"].quality_issue == "NULL full_name"
    assert c["C5"].quality_issue == "NULL city"
    assert (c["C6"].is_valid, c["C6"].quality_issue) == (False, "Segmento no reconocido: Gold")
    assert c["C7"].is_valid and c["C7"].quality_issue is None  # N1
    for k in ("C8", "C9", "C10"):
        assert (c[k].is_valid, c[k].quality_issue) == (False, "monthly_income inválido")
    assert c["C11"].quality_issue == "NULL full_name"  # first failing rule only
    assert c["C12"].is_valid and c["C12"].segment == "MASS MARKET"


def test_loan_rules(spark):
    raw = literal_inputs(
        spark,
        customers=[cust("C1"), cust("C2", segment="Gold")],
        loans=[
            loan("L1", rate=D("0.250000")),
            loan("L2", cid="C9"),
            loan("L3", cid="C2"),
            loan("L4", principal=D("0")),
            loan("L5", rate=D("0")),
            loan("L6", rate=D("1")),
            loan("L7", rate=None),
            loan("L8", term=0),
            loan("L9", status="closed "),
            loan("L10", status=None),
            loan("L11", status="paused"),
        ],
    )
    lo = by_id(stage(raw).loans, "loan_id")
    assert lo["L1"].is_valid and lo["L1"].monthly_rate == D("0.020833")
    assert lo["L1"].cohort_month == dt.date(2025, 1, 1)
    assert lo["L2"].quality_issue == "customer_id no existe: C9"
    assert lo["L3"].quality_issue == "customer_id no existe: C2"  # invalid parent
    assert lo["L4"].quality_issue == "principal_amount inválido"
    for k in ("L5", "L6", "L7"):
        assert lo[k].quality_issue == "annual_rate inválida"
    assert lo["L8"].quality_issue == "term_months inválido"
    assert lo["L9"].is_valid and lo["L9"].loan_status == "CLOSED"
    assert lo["L10"].is_valid  # N1
    assert lo["L11"].quality_issue == "loan_status desconocido: paused"


def test_installment_rules(spark):
    raw = literal_inputs(
        spark,
        customers=[cust("C1"), cust("C2", income=None)],
        loans=[loan("L1", term=3), loan("L2", cid="C2")],
        installments=[
            inst("I1", number=3),
            inst("I2", number=4),
            inst("I3", lid="L2"),
            inst("I4", principal=D("-1")),
            inst("I5", interest=None),
            inst("I6", status="X"),
            inst("I7", principal=D("0"), interest=D("0")),
            inst("I8", status=" paid"),
        ],
    )
    i = by_id(stage(raw).installments, "installment_id")
    assert i["I1"].is_valid and not i["I1"].is_anomalous and i["I1"].quality_issue is None
    assert i["I2"].is_valid and i["I2"].is_anomalous  # N6
    assert i["I2"].quality_issue == "Nro cuota (4) supera plazo del crédito (3)"
    assert i["I3"].quality_issue == "loan_id no existe: L2"
    assert i["I4"].quality_issue == "principal_due inválido"
    assert i["I5"].quality_issue == "interest_due inválido"
    assert i["I6"].quality_issue == "Status desconocido: X"
    assert i["I7"].is_valid and i["I7"].total_due == D("0.00")
    assert i["I8"].installment_status == "PAID"


def test_payment_rules(spark):
    raw = literal_inputs(
        spark,
        customers=[cust("C1")],
        loans=[loan("L1", term=2), loan("L2")],
        installments=[inst("I1"), inst("I2", number=3), inst("I3", lid="L2")],
        payments=[
            pay("P1"),
            pay("P2", status="REVERSED"),
            pay("P3", status="PENDING"),
            pay("P4", amount=D("0")),
            pay("P5", status="FAILED"),
            pay("P6", status=None),
            pay("P7", amount=None),
            pay("P8", iid="I9"),
            pay("P9", iid="I2"),
            pay("P10", lid="L2"),
            pay("P11", lid=None),
            pay("P12", lid="L2", status="PENDING"),
            pay("P13", channel=None),
            pay("P14", channel="  "),
        ],
    )
    p = by_id(stage(raw).payments, "payment_id")
    assert p["P1"].is_valid and p["P1"].quality_issue is None
    assert (p["P2"].is_valid, p["P2"].quality_issue) == (False, "Pago revertido")
    assert p["P3"].quality_issue == "Pago pendiente de confirmación"
    assert p["P4"].quality_issue == "Monto cero o negativo"
    assert (p["P5"].is_valid, p["P5"].quality_issue) == (False, None)  # N9
    assert p["P6"].is_valid and p["P7"].is_valid  # N1
    assert p["P8"].is_orphan and p["P8"].quality_issue == "installment_id no existe: I9"
    assert p["P9"].is_orphan  # anomalous installment, N7
    assert p["P10"].is_loan_mismatch and not p["P10"].is_valid
    assert p["P10"].quality_issue == "loan_id del pago (L2) no coincide con loan de la cuota"
    assert not p["P11"].is_loan_mismatch and p["P11"].is_valid  # N20
    assert p["P12"].quality_issue == "Pago pendiente de confirmación"  # N10
    assert p["P13"].payment_channel == "UNKNOWN" and p["P14"].payment_channel == "UNKNOWN"
    rejected = {r.payment_id for r in stage(raw).rejected_payments.collect()}
    assert rejected == {"P2", "P3", "P4", "P5", "P8", "P9", "P10", "P12"}
