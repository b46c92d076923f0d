"""Hot keys: one loan and one installment hold a third of all rows. Results
must stay whole and exact (checked against plain aggregates)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from lendlake.operators import marts, views
from lendlake.session import cluster_conf
from lendlake.sources.raw import literal_rows

N = 3000


def _inputs(spark):
    customers = literal_rows(spark, "customers", [("C1", "Ana", "bogota", "SME", D("10.00"), None)])
    loans = literal_rows(
        spark, "loans",
        [("L0", "C1", dt.date(2024, 1, 5), D("1000.00"), D("0.240000"), N // 3, "ACTIVE", "Digital")]
        + [(f"L{i}", "C1", dt.date(2024, 2, 1), D("10.00"), D("0.120000"), 12, "ACTIVE", "SME")
           for i in range(1, 40)],
    )
    # A third of the installments belong to L0; a third of the payments hit I0.
    inst = spark.range(N).select(
        F.concat(F.lit("I"), F.col("id").cast("string")).alias("installment_id"),
        F.when(F.col("id") < N // 3, F.lit("L0"))
        .otherwise(F.concat(F.lit("L"), (F.col("id") % 39 + 1).cast("string"))).alias("loan_id"),
        F.when(F.col("id") < N // 3, F.col("id") + 1).otherwise(F.lit(1)).alias("installment_number"),
        F.lit(dt.date(2024, 6, 1)).alias("due_date"),
        F.lit(D("10.00")).cast("decimal(18,2)").alias("principal_due"),
        F.lit(D("1.00")).cast("decimal(18,2)").alias("interest_due"),
        F.lit("DUE").alias("installment_status"),
    )
    pays = spark.range(3 * N).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("payment_id"),
        F.lit(None).cast("string").alias("loan_id"),
        F.when(F.col("id") < N, F.lit("I0"))
        .otherwise(F.concat(F.lit("I"), (F.col("id") % N).cast("string"))).alias("installment_id"),
        F.lit(dt.date(2024, 6, 2)).alias("payment_date"),
        F.lit(D("0.01")).cast("decimal(18,2)").alias("payment_amount"),
        F.lit("PSE").alias("payment_channel"),
        F.lit("CONFIRMED").alias("payment_status"),
        F.lit(None).cast("timestamp").alias("loaded_at"),
    )
    return customers, loans, inst, pays


def test_hot_keys_stay_exact(spark):
    customers, loans, inst, pays = _inputs(spark)
    mart = marts.dm_cartera_from_inputs(customers, loans, inst, pays, dt.date(2024, 12, 31), ("SME",))
    assert mart.count() == N  # every installment, none dropped
    expected = {r.installment_id: r.n for r in pays.groupBy("installment_id").agg(F.count("*").alias("n")).collect()}
    got = {r.installment_id: r.num_payments for r in mart.select("installment_id", "num_payments").collect()}
    assert got == expected
    assert got["I0"] == N + 2  # the hot key: ids 0..N-1, plus N and 2N
    summary = {r.loan_id: r for r in marts.dm_resumen_credito(mart).collect()}
    assert summary["L0"].num_installments == N // 3
    total = mart.agg(F.sum("total_paid")).first()[0]
    assert total == D("0.01") * 3 * N
    ranked = views.vw_top_mora(marts.dm_resumen_credito(mart))
    ranks = sorted(r.ranking_mora for r in ranked.collect())
    assert ranks == list(range(1, len(ranks) + 1))


def test_cluster_conf_sizes():
    conf = cluster_conf(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 16000
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)
