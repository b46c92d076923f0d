"""Plans that move and derive each row as few times as they need."""

import datetime as dt

from pyspark.sql import functions as F

from lendlake.operators import incremental as inc
from lendlake.operators import marts, quality
from lendlake.plans import registry_more
from lendlake.plans.registry import queries
from lendlake.sources.adapters import installments_from_tpch, payments_from_tpch
from lendlake.sources.raw import literal_inputs
from lendlake.sources.versions import VersionedTable
from tests.conftest import SMOKE
from tests.test_bucketed import exchanges, without_broadcasts  # noqa: F401
from tests.test_rules import cust, inst, loan, pay

LINES = (
    "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
    "l_quantity double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_and_null_keys_of_lines_are_grouped_as_before(spark):
    day = dt.datetime(1995, 1, 1)
    line = (1, 2, 7, 5, 100.0, 1.0, 0.5, "N", "O", day)
    rows = [line, line, (1, 2, 8, 5, 50.0, 2.0, 0.0, "R", "O", day), (None, 2, 7, 5, 10.0, 1.0, 0.0, "N", "F", day),
            (2, None, 7, 5, 20.0, 1.0, 0.0, "N", "F", day)]
    lines = spark.createDataFrame(rows, LINES)
    inst = {(r.installment_id, r.loan_id): (float(r.principal_due), r.installment_status)
            for r in installments_from_tpch(lines).collect()}
    assert inst == {("1-2", 1): (250.0, "LATE"), ("2", None): (10.0, "PAID"), ("2", 2): (20.0, "PAID")}
    paid = sorted((r.payment_id, r.installment_id, float(r.payment_amount)) for r in payments_from_tpch(lines).collect())
    assert paid == [("1-2-7-5", "1-2", 1200.0), ("1-2-8-5", "1-2", 0.0), ("2-7-5", "2", 0.0), ("2-7-5", "2", 0.0)]


def test_staged_installments_move_once(spark, without_broadcasts):  # noqa: F811
    # customers and nations, customers and loans to each other, loans by loan, lines by order
    assert exchanges(queries()["c7_reason_rule"](spark, SMOKE)) <= 6


def test_the_rebuilt_mart_reads_stored_facts(spark, monkeypatch):
    seen = []
    rebuild = registry_more.inc.rebuild_partitions
    monkeypatch.setattr(registry_more.inc, "rebuild_partitions", lambda m, t, *a: (seen.extend([m, t]), rebuild(m, t, *a))[1])
    queries()["k3_rebuilt_mart"](spark, SMOKE)
    assert len(seen) == 2
    for df in seen:
        assert "lineitem" not in _plan(df) and "Join" not in _plan(df)


def test_the_rebuilt_mart_moves_to_its_cohorts_once(spark, monkeypatch, tmp_path):
    moves, kept = [], spark.conf.get("lendlake.warehouse", None)
    write, as_dealt = VersionedTable._write, VersionedTable.write_parts

    def seen(df, dealt):
        moves.append((dealt, "lineitem" in _plan(df), exchanges(df)))

    monkeypatch.setattr(VersionedTable, "_write", lambda t, df, by, dealt=False: (
        seen(df, dealt), write(t, df, by, dealt))[1])
    monkeypatch.setattr(VersionedTable, "write_parts", lambda t, df, by: (seen(df, True), as_dealt(t, df, by))[1])
    spark.conf.set("lendlake.warehouse", str(tmp_path))
    try:
        mart = queries()["k3_rebuilt_mart"](spark, SMOKE)
    finally:
        spark.conf.set("lendlake.warehouse", kept) if kept else spark.conf.unset("lendlake.warehouse")
    # Both states of the mart; then the first version and the rebuilt cohorts, from stored rows.
    assert [m[:2] for m in moves] == [(False, True), (True, False), (True, False)]
    assert moves[1][2] == 0 and mart.count() > 0
    # The rows of both states are not kept beside the two versions of the mart.
    assert not list(tmp_path.glob("cartera_states-*")) and len(list(tmp_path.glob("cartera_facts-*/versions/*.json"))) == 2


JAN, FEB, MAR = (dt.date(2025, m, 15) for m in (1, 2, 3))
EARLY, LATE = dt.datetime(1998, 12, 31), dt.datetime(1999, 1, 2)
MARK = dt.datetime(1999, 1, 1)


def _inputs_around_the_mark(spark):
    """Loans of three cohorts and of none; payments before, at and after the mark, and without a load time."""
    loans = [loan(f"L{i}")[:2] + (day,) + loan("")[3:] for i, day in enumerate((JAN, FEB, MAR, None), 1)]
    return literal_inputs(
        spark,
        customers=[cust("C1", segment="BUILDING"), cust("C9", segment="FURNITURE")],
        loans=[*loans, loans[0], ("L5", "C9", *loans[0][2:])],
        installments=[
            inst("I1", lid="L1"), inst("I2", lid="L1", number=2), inst("I3", lid="L2"), inst("I3", lid="L2"),
            inst("I4", lid="L3"), inst("I5", lid="L4"), inst("I6", lid="L4", number=13), inst("I7", lid="L5"),
            inst("I8", lid="L1", number=3), inst("I8", lid="L2", number=3),
        ],
        payments=[
            pay("P1", "L1", "I1", loaded=EARLY), pay("P2", "L1", "I1", loaded=LATE, date=MAR), pay("P3", None, "I1", loaded=LATE),
            pay("P4", None, "I1", loaded=MARK), pay("P5", "L1", "I2", loaded=None), pay("P6", "L2", "I3", loaded=None),
            pay("P7", "L2", "I3", loaded=EARLY), pay("P8", "L3", "I4", loaded=None), pay("P9", "L3", "I4", loaded=EARLY),
            pay("P10", "L4", "I5", loaded=LATE), pay("P11", "L1", "I5", loaded=LATE), pay("P12", "L4", "I6", loaded=LATE),
            pay("P13", "L1", "I8", loaded=LATE), pay("P14", "L2", "I8", loaded=EARLY), pay("P15", "L2", "I8", loaded=None),
            pay("P16", "L3", "I4", status="REVERSED", loaded=EARLY), pay("P17", "L5", "I7", loaded=LATE),
        ],
    )


def test_two_states_of_the_mart_from_one_pass(spark):
    raw = _inputs_around_the_mark(spark)
    until = F.col("loaded_at") <= inc.as_mark(MARK)
    parents, accepted = (raw.customers, raw.loans, raw.installments), ("BUILDING",)
    states = marts.cartera_in_two_states(*parents, raw.payments, until, accepted)
    for facts, payments in (
        (marts.facts_until(states), raw.payments.where(until)), (marts.facts_of_all(states), raw.payments)
    ):
        for build in (marts.dm_cartera_from_inputs, marts.dm_cartera_by_loan):
            want = build(*parents, payments, MAR, accepted).select(*marts.FACT_COLUMNS)
            assert sorted(map(repr, facts.collect())) == sorted(map(repr, want.collect()))
            assert facts.dtypes == want.dtypes
    assert facts.count() == 8


def test_only_cohorts_with_later_payments_are_rebuilt(spark):
    class Inputs:
        raw = _inputs_around_the_mark(spark)

    Inputs.spark = spark
    raw = Inputs.raw
    until = F.col("loaded_at") <= inc.as_mark(MARK)
    before, after = (
        marts.dm_cartera_from_inputs(raw.customers, raw.loans, raw.installments, p, "1999-06-30", ("BUILDING",))
        for p in (raw.payments.where(until), raw.payments)
    )
    # The cohort of March has no payment after the mark, but one without a load time.
    march = F.coalesce(F.col("cohort_month") == MAR.replace(day=1), F.lit(False))
    want = before.where(march).union(after.where(~march))
    assert before.exceptAll(after).where(march).count() == 1
    got = registry_more._k3r(Inputs)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_dealt_cohorts_are_written_as_they_are_read(spark, tmp_path):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("p")).repartition(8)
    source, table = (VersionedTable(spark, str(tmp_path / n)) for n in ("source", "table"))
    source.replace(rows, "p")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    table.replace(source.read(), "p", dealt=True)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    new = source.read().withColumn("id", -F.col("id"))
    touched = spark.createDataFrame([(None,), (1,), (7,)], "p long")
    inc.rebuild_partitions(new, touched, table, None, True)
    got = {(r.id, r.p) for r in table.read().collect()}
    assert got == {(-r.id if r.p in (None, 1) else r.id, r.p) for r in rows.collect()}
    assert len(list((tmp_path / "table").rglob("*.parquet"))) <= 4 + 2
    source.drop()
    assert source.version() is None and table.read().count() == 1000


def test_upserted_batches_are_scans_of_stored_payments(spark, monkeypatch):
    seen = []
    merge = registry_more.merge_into
    monkeypatch.setattr(registry_more, "merge_into", lambda t, part, *a, **k: (seen.append(part), merge(t, part, *a, **k))[1])
    queries()["k2_bucketed_upsert"](spark, SMOKE)
    assert len(seen) == 2
    for df in seen:
        assert "lineitem" not in _plan(df) and "Aggregate" not in _plan(df)


def test_the_mart_is_joined_and_moved_once(spark, without_broadcasts):  # noqa: F811
    # The installments with their loans (six, in two branches that share them when
    # they run), payments, chosen installments and the mart's rows.
    assert exchanges(queries()["a6_dm_cartera"](spark, SMOKE)) <= 15
    assert exchanges(queries()["b8_run_parameter"](spark, SMOKE)) <= 16
    assert exchanges(queries()["q05_dataset_bi"](spark, SMOKE)) <= 16
    assert exchanges(queries()["q03_cartera_por_cohorte"](spark, SMOKE)) <= 18
    assert exchanges(queries()["k15_mart_statistics"](spark, SMOKE)) <= 36


def test_the_summary_needs_no_exchange_after_the_mart(spark, without_broadcasts):  # noqa: F811
    qs = queries()
    assert exchanges(qs["b8_run_parameter"](spark, SMOKE)) <= exchanges(qs["a6_dm_cartera"](spark, SMOKE))


def test_the_extract_is_sorted_before_columns_are_derived(spark):
    plan = queries()["q05_dataset_bi"](spark, SMOKE)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Sort":
        assert plan.children().size() == 1
        plan = plan.children().head()
    moved = {plan.output().apply(i).name() for i in range(plan.output().size())}
    derived = {"cohort_label", "mes_vencimiento", "mora_bucket", "is_overdue", "days_overdue", "analysis_date",
               "balance_due", "pct_cobrado", "annual_rate_pct", "total_due", "cuota_pagada_completa"}
    assert "installment_id" in moved and not moved & derived


def test_the_extract_comes_in_order(spark):
    rows = [(r.fecha_desembolso, r.id_credito, r.numero_cuota) for r in queries()["q05_dataset_bi"](spark, SMOKE).collect()]
    assert rows and rows == sorted(rows, key=lambda r: (-r[0].toordinal(), *r[1:]))


def test_installments_move_without_their_loan_or_totals(spark, without_broadcasts):  # noqa: F811
    plan = _plan(queries()["b8_run_parameter"](spark, SMOKE))
    below = plan[plan.index("Window"):]
    moved = below[below.index("Exchange hashpartitioning(installment_id"):].splitlines()[1]
    assert "installment_status" in moved
    assert not any(c in moved for c in ("full_name", "city", "segment", "total_due", "product_type"))


def test_lines_move_as_what_is_summed(spark):
    lines = spark.createDataFrame([], LINES)
    for df in (installments_from_tpch(lines), payments_from_tpch(lines)):
        moved = df._jdf.queryExecution().optimizedPlan()
        while moved.nodeName() != "RepartitionByExpression":
            moved = moved.children().head()
        names = {moved.output().apply(i).name() for i in range(moved.output().size())}
        assert not names & {"l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "installment_id"}


def test_mart_statistics_sum_the_summary(spark):
    class Staged:
        customers = spark.createDataFrame([(True,), (False,)], "is_valid boolean")
        loans = spark.createDataFrame([(True, 5), (False, 7)], "is_valid boolean, principal_amount int")
        payments = customers

    mart = spark.createDataFrame(
        [("L1", "LATE"), ("L1", "LATE"), ("L2", "PAID")], "loan_id string, installment_status string")
    columns = "num_installments long, total_programmed int, total_paid int, total_balance_due int, saldo_mora int"
    summary = spark.createDataFrame([(2, 30, 10, 20, 20), (1, 5, 5, 0, 0)], columns)
    got = {r.metric: int(r.value) for r in quality.mart_statistics(Staged, mart, summary).collect()}
    assert got == {
        "valid_customers": 1, "valid_loans": 1, "disbursed": 5, "valid_payments": 1, "rejected_payments": 1,
        "mart_installments": 3, "programmed": 35, "collected": 15, "balance": 20, "arrears": 20,
        "loans_in_arrears": 1, "loans_with_late_installment": 1,
    }
    none = {r.metric: r.value for r in quality.mart_statistics(Staged, mart.limit(0), summary.limit(0)).collect()}
    assert none["mart_installments"] == 0 and none["programmed"] is None


def test_totals_by_key_are_stored_without_another_exchange(spark, tmp_path):
    from lendlake.sources.buckets import bucket_bytes, read_bucketed, write_bucketed

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(1000).groupBy((F.col("id") % 90).alias("k")).agg(F.count("*").alias("n"))
    path = str(tmp_path / "t")
    write_bucketed(df, path, "k", n, dealt=True)
    assert len(list((tmp_path / "t").glob("*.parquet"))) <= n and len(bucket_bytes(spark, path)) <= n
    back = read_bucketed(spark, path, df.schema, "k", n)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert exchanges(back.groupBy("k").agg(F.max("n"))) == 0


def test_only_the_totals_are_stored_as_dealt(spark, monkeypatch):
    from lendlake.plans import bucketed

    seen = {}
    write = bucketed.write_bucketed
    monkeypatch.setattr(bucketed, "write_bucketed", lambda df, path, key, n, dealt=False: (
        seen.update({path.rsplit("/", 1)[1]: dealt}), write(df, path, key, n, dealt=dealt))[1])
    queries()["a7_resumen_from_buckets"](spark, SMOKE)
    assert seen == {"stg_customers": False, "stg_loans": False, "stg_installments": False, "payment_totals": True}
