"""Materialized run of all layers and the streaming upsert."""

import datetime as dt
from decimal import Decimal as D

from lendlake.plans import materialize
from lendlake.plans.layers import Settings
from lendlake.sources.raw import literal_inputs, literal_rows
from lendlake.sources.schemas import PAYMENTS
from lendlake.sources.versions import VersionedTable
from lendlake.streaming.upserts import BUCKET, read_target, start_upserts
from tests.test_rules import cust, inst, loan, pay


def test_materialized_run(spark, tmp_path):
    raw = literal_inputs(
        spark,
        customers=[cust("C1")],
        loans=[loan("L1")],
        installments=[inst("I1", due=dt.date(2025, 1, 1)), inst("I2", number=2)],
        payments=[pay("P1", amount=D("110.00")), pay("P2", status="REVERSED")],
    )
    out = materialize.run(spark, raw, str(tmp_path), Settings(analysis_date="2025-04-14"), gate=False)
    m = {r.installment_id: r for r in out["mart"].collect()}
    assert m["I1"].balance_due == D("0.00") and m["I2"].total_paid == D("0.00")
    assert [r.payment_id for r in spark.table("vw_payments_rejected").collect()] == ["P2"]
    assert list((tmp_path / "tables" / "cartera_facts" / "data").glob("*/cohort_month=2025-01-01"))
    assert out["summary"].count() == 1


def test_streaming_upsert(spark, tmp_path):
    src, target, ckpt = (str(tmp_path / n) for n in ("src", "target", "ckpt"))
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    literal_rows(spark, "payments", [pay("P1", loaded=t1), pay("P2", loaded=t1)]).write.parquet(
        src + "/batch1"
    )
    q = start_upserts(spark, src + "/*", PAYMENTS, target, ckpt, available_now=True)
    q.awaitTermination(120)
    literal_rows(
        spark, "payments", [pay("P1", amount=D("99.00"), loaded=t2), pay("P3", loaded=t2)]
    ).write.parquet(src + "/batch2")
    q = start_upserts(spark, src + "/*", PAYMENTS, target, ckpt, available_now=True)
    q.awaitTermination(120)
    table = VersionedTable(spark, target)
    snap = {r.payment_id: r.payment_amount for r in read_target(table).collect()}
    assert snap == {"P1": D("99.00"), "P2": D("50.00"), "P3": D("50.00")}
    # A stream that starts over with a fresh checkpoint adds to what is there.
    literal_rows(spark, "payments", [pay("P4", loaded=t2)]).write.parquet(str(tmp_path / "more" / "batch"))
    for _ in range(2):
        q = start_upserts(spark, str(tmp_path / "more" / "*"), PAYMENTS, target, ckpt + "2", available_now=True)
        q.awaitTermination(120)
    assert {r.payment_id for r in read_target(table).collect()} == {"P1", "P2", "P3", "P4"}
    first, last = table.manifest(0)["parts"], table.manifest()["parts"]
    assert any(last[p] == c for p, c in first.items())  # untouched buckets keep their files
    assert all(p.startswith(f"{BUCKET}=") for p in last)


def test_create_input_tables(spark, tmp_path):
    from lendlake.sources.raw import create_input_tables

    create_input_tables(spark, "lendlake_raw_test", str(tmp_path / "raw"))
    create_input_tables(spark, "lendlake_raw_test", str(tmp_path / "raw"))  # idempotent
    cols = [c.name for c in spark.catalog.listColumns("lendlake_raw_test.payments")]
    assert cols[:3] == ["payment_id", "loan_id", "installment_id"] and "loaded_at" in cols
    assert spark.table("lendlake_raw_test.loans").count() == 0


def test_scheduled_run_equals_single_pass_queries(spark, tmp_path):
    """Stored staging -> marts gives the same rows as the single-pass plans."""
    from lendlake.plans.registry import TEST_SETTINGS, queries
    from lendlake.sources.adapters import inputs_from_tpch
    from tests.conftest import SMOKE

    out = materialize.run(spark, inputs_from_tpch(spark, SMOKE), str(tmp_path), TEST_SETTINGS,
                          register=False, gate=False)
    qs = queries()
    for key, name in (("mart", "a6_dm_cartera"), ("summary", "a7_dm_resumen_credito"),
                      ("collections", "a9_vw_recaudo_diario")):
        lean = qs[name](spark, SMOKE)
        stored = out[key].select(*lean.columns)
        assert stored.count() == lean.count()
        assert stored.exceptAll(lean).count() == 0 and lean.exceptAll(stored).count() == 0, key
