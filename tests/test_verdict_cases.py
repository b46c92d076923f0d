"""Copied parent keys, rows without keys, replays and read errors."""

import datetime as dt
from decimal import Decimal as D
from types import SimpleNamespace

from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.operators import incremental as inc
from lendlake.operators import marts
from lendlake.operators import quality as qc
from lendlake.plans.layers import Settings, build_marts, stage
from lendlake.plans.registry import queries
from lendlake.session import cluster_conf
from lendlake.sources.raw import literal_inputs
from lendlake.sources.versions import VersionedTable
from lendlake.streaming import upserts
from tests.conftest import SMOKE

DAY = dt.date(2025, 1, 10)


def test_partitions_follow_the_input_without_a_cap():
    conf = cluster_conf(100 * 1024**4, 1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409_600


def test_default_date_is_today():
    assert marts.as_date(Settings().analysis_date) == dt.datetime.now(dt.timezone.utc).date()


def test_upsert_keeps_rows_without_key(spark):
    schema = "k long, ts int, v string"
    old = spark.createDataFrame([(1, 1, "a"), (None, 1, "x")], schema)
    new = spark.createDataFrame([(1, 2, "b"), (None, 2, "y"), (3, 1, "c")], schema)
    got = sorted(map(tuple, inc.upsert(old, new, "k", ["ts"]).collect()), key=str)
    assert got == sorted([(1, 2, "b"), (3, 1, "c"), (None, 1, "x"), (None, 2, "y")], key=str)


def test_batches_of_several_writers_all_stay(spark, tmp_path):
    schema = "k string, ts int, v string"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    table = VersionedTable(spark, str(tmp_path / "t"))
    one = [frame(("a", 1, "x"), ("b", 1, "x")), frame(("b", 2, "y")), frame(("c", 1, "x"), (None, 1, "z"))]
    for n, b in [*enumerate(one), (2, one[2]), (0, one[0])]:  # the last two are replays
        upserts.merge_into(table, b, "k", ["ts"], 8, ("first", n))
    assert table.version() == 2
    # Another checkpoint counts its batches from 0 again.
    for n, b in enumerate([frame(("d", 1, "x")), frame(("e", 1, "x")), frame(("b", 1, "old"))]):
        upserts.merge_into(table, b, "k", ["ts"], 8, ("second", n))
    got = sorted(map(tuple, upserts.read_target(table).collect()), key=str)
    want = [("a", 1, "x"), ("b", 2, "y"), ("c", 1, "x"), ("d", 1, "x"), ("e", 1, "x"), (None, 1, "z")]
    assert got == sorted(want, key=str)


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("ts"))
    upserts.merge_into(table, rows, "k", ["ts"], 16)
    upserts.merge_into(table, spark.createDataFrame([(3, 2)], "k long, ts int"), "k", ["ts"])
    old, new = table.manifest(0)["parts"], table.manifest(1)["parts"]
    assert len(old) == 16 and sum(old[p] != new[p] for p in old) == 1
    assert upserts.read_target(table).count() == 500
    folder = table.folder(next(c for p, c in new.items() if old[p] != c))
    assert spark.read.parquet(folder).count() < 60  # the touched bucket's rows only


def test_copies_of_parents_lose_nothing_valid(spark):
    """A loan copied under an unknown customer, an installment copied under an
    unknown loan, and copies with another term: both paths give the same."""
    loan = ("C1", dt.date(2025, 1, 1), D(1000), D("0.2"))
    raw = literal_inputs(
        spark,
        customers=[("C1", "Ana", "cali", K.SEGMENTS[0], D(500), None), ("C1", "Ana", "cali", K.SEGMENTS[0], D(500), None)],
        loans=[
            ("L1", *loan, 12, "ACTIVE", "X"), ("L1", "C9", *loan[1:], 12, "ACTIVE", "X"), ("L1", *loan, 6, "ACTIVE", "X"),
        ],
        installments=[
            ("I1", "L1", 1, DAY, D(100), D(10), "PARTIAL"), ("I1", "L9", 1, DAY, D(100), D(10), "PARTIAL"),
            ("I8", "L1", 8, DAY, D(100), D(10), "DUE"),
        ],
        payments=[("P1", "L1", "I1", DAY, D(50), "PSE", "CONFIRMED", None), ("P2", None, "I1", DAY, D(7), "PSE", "CONFIRMED", None)],
    )
    settings = Settings(analysis_date="2025-02-01")
    staged = sorted(map(tuple, build_marts(stage(raw, settings), settings).cartera.collect()))
    single = marts.dm_cartera_from_inputs(raw.customers, raw.loans, raw.installments, raw.payments, "2025-02-01", settings.segments)
    assert staged == sorted(map(tuple, single.collect()))
    paid = {r.installment_id: float(r.total_paid) for r in single.collect()}
    assert paid["I1"] == 57.0 and "I8" in paid
    plan = single._jdf.queryExecution().optimizedPlan().toString()
    assert "_paid" in plan  # payments are summed before they meet the join


def test_rebuild_of_null_emptied_and_new_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "mart"))
    schema = "id int, cohort date"
    jan, feb, mar, apr = (dt.date(2025, m, 1) for m in (1, 2, 3, 4))
    table.replace(spark.createDataFrame([(1, jan), (2, feb), (3, None), (4, mar)], schema), "cohort")
    new = spark.createDataFrame([(1, jan), (5, None), (6, apr), (4, mar)], schema)
    touched = spark.createDataFrame([(feb,), (None,), (apr,)], "cohort date")
    for _ in range(2):  # a repeated rebuild changes nothing
        inc.rebuild_partitions(new, touched, table)
        got = {(r.id, r.cohort) for r in table.read().collect()}
        assert got == {(1, jan), (5, None), (6, apr), (4, mar)}


def test_rebuild_writes_few_files(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "mart"))
    mart = spark.range(1000).select("id", (F.col("id") % 3).alias("p")).repartition(8)
    table.replace(mart.limit(0), "p")
    inc.rebuild_partitions(mart, mart.select("p").distinct(), table)
    assert table.read().count() == 1000
    assert len(list((tmp_path / "mart").rglob("*.parquet"))) <= 3


def test_collections_move_installments_once(spark):
    """The join compares loans as a condition, so its only key is the
    installment, by which the installments are dealt already."""
    df = queries()["a9_vw_recaudo_diario"](spark, SMOKE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join" in line and "_inst_id" in line]
    assert joins and all("[installment_id" in j and "[_inst_id" in j and "loan_id#" in j for j in joins)
    assert not any("_inst_loan" in j.split("]")[1] for j in joins)


def test_rates_and_statuses(spark):
    flags = lambda *v: spark.createDataFrame([(x,) for x in v], "is_valid boolean")
    staged = SimpleNamespace(
        customers=flags(True), loans=flags(*[True] * 5, False), installments=flags(True),
        payments=flags(*[True] * 97, *[False] * 3),
    )
    got = {(r.control_id, r.table_name): r.status for r in qc.validity_rates(staged).collect()}
    assert got[("C14", "stg_payments")] == "WARN" and got[("C12", "stg_payments")] == "PASS"
    assert got[("C12", "stg_loans")] == "FAIL" and len(got) == 5
    loans = spark.createDataFrame(
        [(1, 1, 5, " active"), (2, 1, 5, "FROZEN"), (3, 1, 5, None)],
        "loan_id int, customer_id int, principal_amount int, loan_status string",
    )
    customers = spark.createDataFrame([(1,)], "customer_id int")
    failed = {r.control_id: r.failed for r in qc.loan_controls(loans, customers).collect()}
    assert failed == {"C03": 0, "C04": 0, "C15": 1}  # NULL counts as known, as in staging


def test_statuses_outside_the_domain_are_listed(spark):
    loans = spark.createDataFrame([("ACTIVE",), (" frozen",), ("FROZEN",), (None,)], "loan_status string")
    got = {r.value: r.rows for r in qc.unknown_values(loans, "loan_status", K.LOAN_STATUSES).collect()}
    assert got == {"FROZEN": 2, None: 1}


def test_reason_classes(spark):
    texts = [
        ("Pago revertido", "Pago revertido"), ("installment_id no existe: 7-1", "installment_id no existe"),
        ("loan_id del pago (9) no coincide con loan de la cuota", "loan_id del pago"), (None, None),
    ]
    df = spark.createDataFrame(texts, "t string, want string").withColumn("got", qc.reason_class(F.col("t")))
    assert all(r.got == r.want for r in df.collect())
