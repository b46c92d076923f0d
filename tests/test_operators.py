"""Ranking, incremental operators, controls and plan shapes."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lendlake.operators import incremental as inc
from lendlake.operators import quality as qc
from lendlake.operators.ranking import global_row_number, read_ranked, store_ranked
from lendlake.plans.registry import queries
from lendlake.sources.versions import VersionedTable
from tests.conftest import SMOKE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_row_number_matches_window(spark):
    base = spark.read.parquet(f"{SMOKE}/orders.parquet").select(
        "o_orderkey", (F.col("o_custkey") % 7).alias("k")  # many ties on k
    )
    order = [F.col("k").desc(), F.col("o_orderkey").asc()]
    ours = global_row_number(base, order, "rn")
    brute = base.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, brute.collect()))
    # The rows are never windowed: the only window is the running total over
    # one row per range.
    assert "row_number" not in _plan(ours)


def test_stored_ranking_opens_the_ranges_it_needs(spark, tmp_path):
    base = spark.read.parquet(f"{SMOKE}/orders.parquet").select(
        "o_orderkey", (F.col("o_custkey") % 7).alias("k")
    )
    order = [F.col("k").desc(), F.col("o_orderkey").asc()]
    table = VersionedTable(spark, str(tmp_path / "ranking"))
    store_ranked(base, order, table, ranges=6)
    whole = read_ranked(table, "rn")
    brute = base.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, brute.collect()))
    some = read_ranked(table, "rn", 700, 720)
    assert sorted(r.rn for r in some.collect()) == list(range(700, 721))
    assert len(some.inputFiles()) <= 2 < len(whole.inputFiles())
    store_ranked(base.limit(0), order, table)
    assert read_ranked(table, "rn").collect() == [] and read_ranked(table, "rn", version=0).count() == base.count()


def test_top_k_plans_as_take_ordered(spark):
    df = queries()["q04_top_atraso"](spark, SMOKE)
    df.collect()
    assert "TakeOrderedAndProject" in _plan(df)


def test_flag_filter_reaches_scan(spark):
    df = queries()["b2_scan_derived_table"](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_valid), EqualTo(is_valid,true)]" in plan


def test_new_rows_and_mark(spark):
    t = [dt.datetime(2025, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(1, t[0]), (2, t[1]), (3, t[2])], "id int, loaded_at timestamp_ntz")
    assert [r.id for r in inc.new_rows(df, "loaded_at", "2025-01-02 00:00:00").collect()] == [3]
    row = inc.advance_mark(df, "loaded_at", "2025-01-02 00:00:00").first()
    assert row.new_rows == 1 and row.new_mark == t[2]
    none = inc.advance_mark(df, "loaded_at", "2030-01-01 00:00:00").first()
    assert none.new_rows == 0 and none.new_mark == dt.datetime(2030, 1, 1)


def test_upsert_latest_wins(spark):
    schema = "k string, ts timestamp_ntz, v int"
    t0, t1, t2 = (dt.datetime(2025, 1, d) for d in (1, 2, 3))
    target = spark.createDataFrame([("a", t0, 1), ("b", t1, 2)], schema)
    source = spark.createDataFrame([("a", t1, 10), ("a", t2, 11), ("c", t0, 3), ("b", t0, 0)], schema)
    got = {r.k: r.v for r in inc.upsert(target, source, "k", ["ts"]).collect()}
    assert got == {"a": 11, "b": 2, "c": 3}  # older source row does not replace b


def test_rebuild_touched_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "mart"))
    df = spark.createDataFrame([(1, "2025-01"), (2, "2025-02")], "id int, cohort string")
    table.replace(df, "cohort")
    new = spark.createDataFrame([(3, "2025-02")], "id int, cohort string")
    inc.rebuild_partitions(new, new.select("cohort").distinct(), table)
    assert sorted((r.id, r.cohort) for r in table.read().collect()) == [(1, "2025-01"), (3, "2025-02")]
    assert sorted((r.id, r.cohort) for r in table.read(0).collect()) == [(1, "2025-01"), (2, "2025-02")]


def test_duplicate_key_control(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [(r.k, r.copies) for r in qc.duplicated_keys(df, "k").collect()] == [("a", 2)]


def test_parent_copies_do_not_fan_out(spark):
    """A parent key held by many copies joins as one row (no pair explosion)."""
    from lendlake.operators.keys import one_per_key

    parents = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    children = spark.range(50).select(F.lit(7).alias("k"))
    joined = children.join(one_per_key(parents, "k", ["v"]), "k")
    assert joined.count() == 50 and joined.first().v == 999


def test_ledger_of_displaced_copies(spark):
    from lendlake.operators.keys import displaced, one_per_key

    rows = [("a", 1, "x"), ("a", 2, "x"), ("a", 2, "x"), ("a", 2, "w"), ("b", 1, "x"), (None, 1, "x"), ("c", None, None), ("c", None, None)]
    df = spark.createDataFrame(rows, "k string, v int, other string")
    got = {(r.k, r.v, r.other): (r.chosen.v, r.reason, r.copies) for r in displaced(df, "k", ["v"]).collect()}
    other, same = "another row was chosen for its key", "repeats the chosen row"
    assert got == {
        ("a", 1, "x"): (2, other, 1), ("a", 2, "x"): (2, same, 1), ("a", 2, "w"): (2, same, 1),
        ("c", None, None): (None, same, 1),
    }
    items = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    left_out = displaced(items, "l_orderkey", ["l_shipdate", "l_linenumber"])
    chosen = one_per_key(items, "l_orderkey", ["l_shipdate", "l_linenumber"]).count()
    assert chosen + left_out.agg(F.sum("copies")).first()[0] == items.count()


def test_cohort_view_counts_distinct_without_copying_rows(spark):
    from lendlake.operators.views import vw_cartera_cohorte
    from lendlake.plans.registry import context

    mart = context(spark, SMOKE).mart
    group = ["cohort_month", "city", "segment", "product_type", "mora_bucket"]
    plain = mart.groupBy(*group).agg(F.countDistinct("loan_id").alias("l"), F.countDistinct("installment_id").alias("i"))
    # Copies: the same installments once more, and once under another loan.
    copied = mart.union(mart).union(mart.withColumn("loan_id", F.col("loan_id") + 1))
    for df in (mart, copied):
        got = vw_cartera_cohorte(df).select(*group, "num_creditos", "num_cuotas")
        want = df.groupBy(*group).agg(F.countDistinct("loan_id"), F.countDistinct("installment_id"))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert "Expand" not in _plan(vw_cartera_cohorte(mart)) and "Expand" in _plan(plain)
