"""Staging stored in buckets: same rows, few exchanges, hot buckets, other sessions."""

import re

import pytest
from pyspark.sql import functions as F

from lendlake.plans.bucketed import MANIFEST, BucketedStaging
from lendlake.plans.registry import TEST_SETTINGS, queries
from lendlake.sources.adapters import inputs_from_tpch
from lendlake.sources.buckets import bucket_bytes, has_hot_bucket, read_bucketed, write_bucketed
from tests.conftest import SMOKE

BROADCASTS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|single|Round)", df._jdf.queryExecution().executedPlan().toString()))


def same(a, b):
    b = b.select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def without_broadcasts(spark):
    for k in BROADCASTS:
        spark.conf.set(k, "-1")
    yield
    for k in BROADCASTS:
        spark.conf.unset(k)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    out = BucketedStaging(spark, str(tmp_path_factory.mktemp("staging") / "run"))
    out.store(inputs_from_tpch(spark, SMOKE), TEST_SETTINGS)
    return out


def test_marts_of_stored_staging_equal_the_single_pass(spark, store):
    qs = queries()
    marts = store.marts(TEST_SETTINGS)
    same(marts.cartera, qs["a6_dm_cartera"](spark, SMOKE))
    same(marts.resumen, qs["a7_dm_resumen_credito"](spark, SMOKE))
    same(store.table("stg_payments"), qs["a4_stg_payments"](spark, SMOKE))


def test_the_mart_exchanges_three_times_and_the_summary_no_more(store, without_broadcasts):
    marts = store.marts(TEST_SETTINGS)
    assert exchanges(marts.cartera) <= 3
    assert exchanges(marts.resumen) <= 3
    plan = marts.cartera._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 3 and "SortMergeJoin" in plan


def test_another_session_reads_the_buckets(spark, store, without_broadcasts):
    other = spark.newSession()
    for k in BROADCASTS:
        other.conf.set(k, "-1")
    there = BucketedStaging(other, store._root).marts(TEST_SETTINGS)
    assert exchanges(there.resumen) <= 3
    assert there.resumen.count() == store.marts(TEST_SETTINGS).resumen.count()


def test_an_unfinished_store_is_not_read(spark, tmp_path):
    store = BucketedStaging(spark, str(tmp_path / "run"))
    raw = inputs_from_tpch(spark, SMOKE)
    broken = raw.payments.withColumn("payment_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.store(type(raw)(raw.customers, raw.loans, raw.installments, broken), TEST_SETTINGS)
    assert (tmp_path / "run" / "stg_loans").exists() and not (tmp_path / "run" / MANIFEST).exists()
    with pytest.raises(LookupError):
        store.marts(TEST_SETTINGS)


def test_a_table_with_a_hot_bucket_is_shuffled_instead(spark, tmp_path, without_broadcasts):
    """One key holds a third of the rows; nulls and an empty table are stored too."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id"))
    df = spark.range(30_000).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    path = str(tmp_path / "t")
    write_bucketed(df, path, "k", 16)
    assert sum(bucket_bytes(spark, path).values()) > 0 and not has_hot_bucket(spark, path, 16)
    grouped = read_bucketed(spark, path, df.schema, "k", 16).groupBy("k").agg(F.max("v").alias("m"))
    assert exchanges(grouped) == 0
    same(grouped, df.groupBy("k").agg(F.max("v").alias("m")))
    threshold = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    spark.conf.set(threshold, "1KB")
    try:
        assert has_hot_bucket(spark, path, 16)
        plain = read_bucketed(spark, path, df.schema, "k", 16)
        assert exchanges(plain.groupBy("k").agg(F.max("v"))) == 1
        same(plain, df)
    finally:
        spark.conf.unset(threshold)
    empty = str(tmp_path / "empty")
    write_bucketed(df.limit(0), empty, "k", 4)
    assert read_bucketed(spark, empty, df.schema, "k", 4).collect() == []
