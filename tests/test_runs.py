"""Incremental runs: equal to a full one, safe to kill, held back by the gate, by name."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lendlake.operators import quality as qc
from lendlake.plans import runs
from lendlake.plans.layers import Settings
from lendlake.plans.registry import TEST_SETTINGS
from lendlake.plans.warehouse import Warehouse, drop_old, register
from lendlake.sources.adapters import inputs_from_tpch
from lendlake.sources.raw import RawInputs, literal_inputs
from tests.conftest import SMOKE
from tests.test_rules import cust, inst, loan, pay

SETTINGS = Settings(analysis_date="2025-04-14")
LATER = Settings(analysis_date="2025-05-20")
EARLY = "2001-11-01"
T1, T2 = dt.datetime(2025, 2, 1), dt.datetime(2025, 3, 1)
TABLES = [
    "stg_customers", "stg_loans", "stg_installments", "stg_payments", "dm_cartera", "dm_resumen_credito",
    "vw_originacion_diaria", "vw_recaudo_diario", "vw_cartera_cohorte", "vw_top_mora", "vw_bi_completo",
    "vw_payments_rejected",
]


def loan_of(lid, month, cid="C1"):
    row = list(loan(lid, cid))
    row[2] = dt.date(2025, month, 10)
    return tuple(row)


CUSTOMERS = [cust("C1"), cust("C2", name="Luz")]
LOANS = [loan_of("L1", 1), loan_of("L2", 2), loan_of("L3", 3, "C2"), loan_of("L4", 4)]
DUE = dt.date(2025, 3, 10)
INSTALLMENTS = [
    inst("I1", "L1", due=DUE), inst("I2", "L2", due=DUE), inst("I3", "L3", due=DUE), inst("I4", "L4", 99, due=DUE),
    inst("I5", "L4", due=None),
]
FIRST = [
    pay("P1", "L1", "I1", loaded=T1), pay("P2", "L2", "I2", loaded=T1), pay("P3", "L3", "I3", loaded=T1),
    pay("P4", "L4", "I4", loaded=T1), pay(None, "L1", "I1", D("1.00"), loaded=T1), pay("P9", "L1", "I1", loaded=None),
]
SECOND = [
    pay("P1", "L1", "I1", status="REVERSED", loaded=T2), pay("P5", "L3", "I3", D("60.00"), loaded=T2),
    pay("P6", "L9", "I3", loaded=T2), pay(None, "L2", "I2", D("2.00"), loaded=T2),
]


def inputs(spark, payments, customers=CUSTOMERS, loans=LOANS, installments=INSTALLMENTS):
    return literal_inputs(spark, customers=customers, loans=loans, installments=installments, payments=payments)


def content(spark, root):
    """All published rows, without load times."""
    lake = Warehouse(spark, root)
    frames = {n: lake.read(n).drop(runs.STAGE_LOAD, runs.MART_LOAD) for n in TABLES}
    return {n: sorted(map(str, df.select(*sorted(df.columns)).collect())) for n, df in frames.items()}


def test_an_incremental_run_equals_a_full_one(spark, tmp_path):
    one, all_at_once = str(tmp_path / "one"), str(tmp_path / "all")
    runs.refresh(spark, inputs(spark, FIRST), one, SETTINGS, gate=False, buckets=8)
    raw = inputs(spark, FIRST + SECOND)
    release = runs.refresh(spark, raw, one, LATER, gate=False)
    runs.refresh(spark, raw, all_at_once, LATER, gate=False, buckets=8)
    assert content(spark, one) == content(spark, all_at_once)
    assert release.number == 1 and release.mark == "2025-03-01 00:00:00" and release.properties["new_payments"] == 4
    # P1 and the payment without id belong to January's and February's cohort, P5 to March's.
    assert release.properties["rebuilt_cohorts"] == [f"cohort_month=2025-0{m}-01" for m in (1, 2, 3)]
    dates = Warehouse(spark, one).read("dm_cartera").select("analysis_date").distinct().collect()
    assert [r[0] for r in dates] == [dt.date(2025, 5, 20)]


def test_changed_parents_restage_their_payments_and_cohorts(spark, tmp_path):
    one, anew = str(tmp_path / "one"), str(tmp_path / "anew")
    runs.refresh(spark, inputs(spark, FIRST), one, SETTINGS, gate=False, buckets=8)
    raw = inputs(
        spark, FIRST,
        customers=[CUSTOMERS[0], cust("C2", name="Sol")],  # another name: L3's cohort
        loans=[loan_of("L1", 4), *LOANS[1:]],  # another cohort
        installments=[
            inst("I1", "L1", due=DUE), inst("I2", "L2", due=DUE, status="X"),  # no longer valid
            inst("I3", "L3", due=DUE), inst("I4", "L4", 2, due=DUE),  # within the term now; I5 gone
        ],
    )
    release = runs.refresh(spark, raw, one, SETTINGS, gate=False)
    assert release.properties["new_payments"] == 0
    assert len(release.properties["rebuilt_cohorts"]) == 4
    runs.refresh(spark, raw, anew, SETTINGS, gate=False, buckets=8)
    assert content(spark, one) == content(spark, anew)
    # Nothing changed: no cohort is rebuilt, no payment written.
    before = Warehouse(spark, one).table("stg_payments").manifest()["parts"]
    release = runs.refresh(spark, raw, one, SETTINGS, gate=False)
    assert release.properties["rebuilt_cohorts"] == []
    assert Warehouse(spark, one).table("stg_payments").manifest()["parts"] == before


class Killed(Exception):
    pass


def test_a_run_killed_between_steps_can_be_run_again(spark, tmp_path):
    root, whole = str(tmp_path / "root"), str(tmp_path / "whole")
    runs.refresh(spark, inputs(spark, FIRST), root, SETTINGS, gate=False, buckets=4)
    before = content(spark, root)
    raw = inputs(spark, FIRST + SECOND)
    lake = Warehouse(spark, root)
    for step in ("increment", "payments", "facts", "controls"):

        def kill(done, step=step):
            if done == step:
                raise Killed

        with pytest.raises(Killed):
            runs.refresh(spark, raw, root, SETTINGS, gate=False, after_step=kill)
        assert lake.release().number == 0 and lake.release().mark == "2025-02-01 00:00:00"
    assert content(spark, root) == before
    assert runs.refresh(spark, raw, root, SETTINGS, gate=False).properties["new_payments"] == 4
    runs.refresh(spark, raw, whole, SETTINGS, gate=False, buckets=4)
    assert content(spark, root) == content(spark, whole)


def test_a_failed_critical_control_holds_the_release_back(spark, tmp_path):
    root = str(tmp_path / "root")
    good = [r for r in FIRST if r[0] != "P4"]
    clean = {"installments": INSTALLMENTS[:3]}
    runs.refresh(spark, inputs(spark, good, **clean), root, SETTINGS)
    before = content(spark, root)
    bad = inputs(spark, good, customers=[*CUSTOMERS, cust("C1")], **clean)  # a copied key: C02
    with pytest.raises(runs.PublicationBlocked) as e:
        runs.refresh(spark, bad, root, SETTINGS)
    assert [r["control_id"] for r in e.value.failed] == ["C02"]
    assert Warehouse(spark, root).release().number == 0 and content(spark, root) == before
    assert runs.refresh(spark, bad, root, SETTINGS, gate=False).number == 1


def test_names_last_beyond_the_session(spark, tmp_path):
    root = str(tmp_path / "root")
    lake = Warehouse(spark, root)
    runs.refresh(spark, inputs(spark, FIRST), root, SETTINGS, gate=False, buckets=4)
    register(lake, "lake_test")
    other = spark.newSession()
    for name in TABLES:
        stored = lake.read(name)
        named = other.table(f"lake_test.{name}")
        assert sorted(named.columns) == sorted(stored.columns), name
        assert dict(named.dtypes) == dict(stored.dtypes), name
        cols = sorted(stored.columns)
        assert sorted(map(str, named.select(*cols).collect())) == sorted(map(str, stored.select(*cols).collect())), name
    runs.refresh(spark, inputs(spark, FIRST + SECOND), root, LATER, gate=False)
    ranked = "SELECT loan_id, ranking_mora FROM lake_test.vw_top_mora ORDER BY ranking_mora"
    old = other.sql(ranked).collect()
    register(lake, "lake_test")
    drop_old(lake, "lake_test")
    lake.expire(keep=1)
    assert other.sql("SELECT DISTINCT analysis_date FROM lake_test.dm_cartera").first()[0] == dt.date(2025, 5, 20)
    assert [r.ranking_mora for r in other.sql(ranked).collect()] == [1, 2] and len(old) == 3  # L3 was paid
    assert len([t for t in spark.catalog.listTables("lake_test") if t.name.startswith("stg_loans__v")]) == 1
    spark.sql("DROP DATABASE lake_test CASCADE")


def test_whole_test_tables_in_two_runs(spark, tmp_path):
    """The test tables, payments in two parts: as the lazy single pass over all, and
    the report as the lazy one; a stretch of ranks is read by its numbers."""
    raw = inputs_from_tpch(spark, SMOKE)
    early = RawInputs(raw.customers, raw.loans, raw.installments, raw.payments.where(f"loaded_at < '{EARLY}'"))
    root = str(tmp_path / "root")
    first = runs.refresh(spark, early, root, TEST_SETTINGS, gate=False, buckets=8)
    second = runs.refresh(spark, raw, root, TEST_SETTINGS, gate=False)
    assert first.properties["rebuilt_cohorts"] is None and 0 < len(second.properties["rebuilt_cohorts"])
    assert set(second.properties["rebuilt_cohorts"]) < set(second.properties["prints"])
    from lendlake.plans.registry import context

    lazy = context(spark, SMOKE)
    lake = Warehouse(spark, root)
    for name, want in (("dm_cartera", lazy.mart), ("dm_resumen_credito", lazy.summary), ("vw_recaudo_diario", lazy.collections)):
        got = lake.read(name).select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
    report = qc.control_report(lazy.raw, lazy.staged, lazy.mart)
    got = lake.read("control_report").select(*report.columns)
    assert got.exceptAll(report).isEmpty() and report.exceptAll(got).isEmpty()

    from lendlake.operators.ranking import read_ranked

    ranking = lake.table("vw_top_mora")
    some = read_ranked(ranking, "ranking_mora", 10, 20)
    assert sorted(r.ranking_mora for r in some.collect()) == list(range(10, 21))
    assert read_ranked(ranking, "ranking_mora", 10**9, 10**9).collect() == []
    assert lake.read("vw_top_mora").agg(F.max("ranking_mora")).first()[0] == lake.read("vw_top_mora").count()
