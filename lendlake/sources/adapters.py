"""Bridge from the TPC-H-like test tables to the four canonical raw inputs.

The real pipeline reads customers, loans, installments and payments as they
land (``raw.read_raw``). The test data has orders and line items instead; the
rules below derive the same four inputs from them, with every branch of the
validity rules hit (see FIXTURES.md section 4). The same rules, written as SQL
CTEs, head every oracle query.

Ids: ``customer_id`` and ``loan_id`` keep the source ``bigint`` keys (cheaper
joins than text); ``installment_id`` and ``payment_id`` are composite text keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.constants import MONEY, RATE
from lendlake.sources.raw import RawInputs, read_table

# --- Fixed values of the test-data mapping ----------------------------------
# Segments of the test data accepted as valid (FURNITURE is the unknown one).
TEST_SEGMENTS = ("BUILDING", "MACHINERY", "AUTOMOBILE", "HOUSEHOLD")
# Order status -> loan status.
ORDER_STATUS_TO_LOAN = {"P": "ACTIVE", "F": "CLOSED", "O": "DEFAULT"}
# max(returnflag || linestatus) -> installment status; anything else is PARTIAL.
LINE_FLAGS_TO_STATUS = {"RO": "LATE", "RF": "PAID", "NF": "PAID", "NO": "DUE"}
# Payment channel by supplier key modulo 5 (3 is a blank, 4 is NULL).
CHANNELS = ("PSE", "ACH", "CASH", " ", None)
# Analysis date of the checked queries.
TEST_ANALYSIS_DATE = "1999-06-30"
# --- End of fixed values ----------------------------------------------------


def _map(c, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def customers_from_tpch(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customers <- customer + nation (city = nation name)."""
    n = nation.select(F.col("n_nationkey"), F.col("n_name").alias("city"))
    return customer.join(n, customer.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("city"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast(MONEY).alias("monthly_income"),
        F.lit(None).cast("date").alias("created_at"),
    )


def loans_from_tpch(orders: DataFrame) -> DataFrame:
    """loans <- orders; rate (key % 40) / 100, term 3 x priority digit."""
    rate = (F.col("o_orderkey") % 40).cast("decimal(4,0)") * F.lit(0.01).cast("decimal(3,2)")
    return orders.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("origination_date"),
        F.col("o_totalprice").cast(MONEY).alias("principal_amount"),
        rate.cast(RATE).alias("annual_rate"),
        (F.substring("o_orderpriority", 1, 1).cast("bigint") * 3).alias("term_months"),
        _map(F.col("o_orderstatus"), ORDER_STATUS_TO_LOAN).alias("loan_status"),
        F.substr(F.col("o_orderpriority"), F.lit(3)).alias("product_type"),
    )


_FLAG_CODES = {ord(k[0]) * 256 + ord(k[1]): v for k, v in LINE_FLAGS_TO_STATUS.items()}


def _installment_key(orderkey, linenumber):
    return F.concat_ws("-", orderkey.cast("string"), linenumber.cast("string"))


def _units(c, scale: int):
    """Exact integer units of a value with at most log10(scale) decimals
    (cents for scale 100); long sums keep the aggregate hash-based and cheap."""
    return F.floor(F.col(c) * scale + F.lit(0.5))


def _from_units(c, scale: int):
    """Integer units back to an exact decimal."""
    digits = len(str(scale)) - 1
    return F.col(c).cast("decimal(38,0)") * F.lit(10 ** -digits).cast(f"decimal({digits + 1},{digits})")


def installments_from_tpch(lineitem: DataFrame) -> DataFrame:
    """installments <- lineitem grouped by (orderkey, linenumber).

    Lines are dealt by order: the grouping and the join to the loans, whose key it
    is, then need no further exchange. Nearly every line is an installment of its
    own, so summing before the exchange would only fill memory and spill. Lines move
    as the numbers to be summed, no more.
    """
    lines = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        _units("l_extendedprice", 100).alias("price"),
        _units("l_quantity", 100).alias("quantity"),
        # returnflag || linestatus as an integer code, so the aggregate keeps a
        # fixed-width buffer and runs hash-based.
        (F.ascii("l_returnflag") * 256 + F.ascii("l_linestatus")).alias("code"),
    )
    g = lines.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("ship"),
        F.sum("price").alias("principal"),
        F.sum("quantity").alias("interest"),
        F.max("code").alias("flags"),
    )
    return g.select(
        _installment_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("installment_id"),
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_linenumber").cast("bigint").alias("installment_number"),
        F.col("ship").cast("date").alias("due_date"),
        _from_units("principal", 100).cast(MONEY).alias("principal_due"),
        _from_units("interest", 100).cast(MONEY).alias("interest_due"),
        _map(F.col("flags"), _FLAG_CODES, "PARTIAL").alias("installment_status"),
    )


def payments_from_tpch(lineitem: DataFrame) -> DataFrame:
    """payments <- lineitem grouped by (orderkey, linenumber, partkey, suppkey).

    The amount is 12 x sum(price x discount) rounded half-up to cents; the
    products are summed exactly in 1/10000 units. Lines are dealt by installment
    id, so grouping and joining the payments by it needs no further exchange; the id
    itself is made again where they arrive.
    """
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = lineitem.select(
        *keys,
        "l_shipdate",
        (_units("l_extendedprice", 100) * _units("l_discount", 100)).alias("product"),
    )
    key = _installment_key(F.col("l_orderkey"), F.col("l_linenumber"))
    g = lines.repartition(key).withColumn("installment_id", key).groupBy("installment_id", *keys).agg(
        F.max("l_shipdate").alias("ship"),
        F.sum("product").alias("paid"),
    )
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    channel = _map(supp % 5, dict(enumerate(CHANNELS)))
    status = (
        F.when(part % 11 == 0, F.lit("REVERSED"))
        .when(part % 13 == 0, F.lit("PENDING"))
        .otherwise(F.lit("CONFIRMED"))
    )
    return g.select(
        F.concat_ws("-", *[F.col(k).cast("string") for k in keys]).alias("payment_id"),
        (F.col("l_orderkey") + F.when(part % 50 == 0, 1).otherwise(0)).alias("loan_id"),
        F.col("installment_id"),
        F.date_add(F.col("ship").cast("date"), (supp % 10).cast("int")).alias("payment_date"),
        (_from_units("paid", 10000) * F.lit(12)).cast(MONEY).alias("payment_amount"),
        channel.alias("payment_channel"),
        status.alias("payment_status"),
        F.col("ship").alias("loaded_at"),
    )


def inputs_from_tpch(spark: SparkSession, root: str) -> RawInputs:
    """All four canonical inputs from the test tables under ``root``."""
    lineitem = read_table(spark, root, "lineitem")
    return RawInputs(
        customers=customers_from_tpch(
            read_table(spark, root, "customer"), read_table(spark, root, "nation")
        ),
        loans=loans_from_tpch(read_table(spark, root, "orders")),
        installments=installments_from_tpch(lineitem),
        payments=payments_from_tpch(lineitem),
    )
