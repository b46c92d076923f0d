"""Data-quality controls (K4-K15) and the control report.

Each control yields rows ``(control_id, table_name, control, severity,
failed, total, status)``. Controls on the same table are computed in one
aggregation pass (several conditional counts in one ``agg``) and then
unpivoted, so the report reads each table once plus one lookup join per
foreign key. Status: PASS when nothing fails, else WARN for a warning and
FAIL for a critical control; rate controls compare a share with a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.functions.text import blank_to_null, clean_upper
from lendlake.operators.keys import key_set, one_per_key

REPORT_COLUMNS = ["control_id", "table_name", "control", "severity", "failed", "total", "status"]

CRITICAL, WARNING = "critical", "warning"

# --- Fixed values: the controls of the quality evidence, in report order ----
CONTROLS = {
    "C01": ("customers", "required fields not null", CRITICAL),
    "C02": ("customers", "customer_id unique", CRITICAL),
    "C03": ("loans", "customer_id exists in customers", CRITICAL),
    "C04": ("loans", "principal_amount > 0", CRITICAL),
    "C05": ("installments", "loan_id exists in loans", CRITICAL),
    "C06": ("installments", "installment_number within term", WARNING),
    "C07": ("payments", "payment_status in known domain", WARNING),
    "C08": ("payments", "confirmed payment_amount > 0", WARNING),
    "C09": ("payments", "payment_channel not null", WARNING),
    "C10": ("payments", "installment_id exists in installments", WARNING),
    "C11": ("payments", "loan_id equals installment loan", WARNING),
    "C12": ("staging", "validity rate >= 85%", CRITICAL),
    "C13": ("dm_cartera", "installment_id unique", CRITICAL),
    "C14": ("stg_payments", "rejected rate <= 2%", WARNING),
    "C15": ("loans", "loan_status in known domain", WARNING),
}
REQUIRED = {
    "customers": ("customer_id", "full_name", "city", "segment", "monthly_income"),
}
# --- End of fixed values ----------------------------------------------------


def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): NULL conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))


def _status(failed: Column, severity: Column) -> Column:
    return (
        F.when(failed == 0, "PASS").when(severity == WARNING, "WARN").otherwise("FAIL")
    )


def _rows(agg: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Unpivot one aggregate row with columns ``{id}`` (failed) and ``total``
    into one control row per id."""
    stacked = agg.select(
        F.col("total"),
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("control_id"), F.col(i).alias("failed")) for i in ids])
        ).alias("c"),
    )
    meta = F.create_map(
        *[x for i in ids for x in (F.lit(i), F.struct(*[F.lit(v) for v in CONTROLS[i]]))]
    )
    m = meta[F.col("c.control_id")]
    return stacked.select(
        F.col("c.control_id").alias("control_id"),
        m["col1"].alias("table_name"),
        m["col2"].alias("control"),
        m["col3"].alias("severity"),
        F.col("c.failed").cast("bigint").alias("failed"),
        F.col("total").cast("bigint").alias("total"),
    ).withColumn("status", _status(F.col("failed"), F.col("severity")))


def required_not_null(df: DataFrame, cols: Sequence[str]) -> Column:
    """K4: any of the required fields is NULL."""
    conds = [F.col(c).isNull() for c in cols]
    return reduce(lambda a, b: a | b, conds)


def duplicated_keys(df: DataFrame, key: str) -> DataFrame:
    """K5: non-NULL keys that occur more than once, with their count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def _per_key(df: DataFrame, key: str, **extra: Column) -> DataFrame:
    """One pass: rows per key (partial aggregation before the shuffle), plus
    extra per-key counts; NULL keys form their own group."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), *[c.alias(n) for n, c in extra.items()])


def _dup_rows(per_key: DataFrame, key: str) -> Column:
    """Rows whose non-NULL key occurs more than once."""
    return F.sum(F.when(F.col(key).isNotNull() & (F.col("copies") > 1), F.col("copies")).otherwise(0))


def customer_controls(customers: DataFrame) -> DataFrame:
    """C01 and C02 on the raw customers, in one aggregation."""
    nulls = count_if(required_not_null(customers, REQUIRED["customers"]))
    per_key = _per_key(customers, "customer_id", nulls=nulls)
    agg = per_key.agg(
        F.sum("nulls").alias("C01"),
        _dup_rows(per_key, "customer_id").alias("C02"),
        F.sum("copies").alias("total"),
    )
    return _rows(agg, ["C01", "C02"])


def loan_controls(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """C03 (foreign key), C04 (positive principal) and C15 (known status) in one
    pass over loans."""
    j = loans.join(key_set(customers, "customer_id", "_has_customer"), "customer_id", "left")
    agg = j.agg(
        count_if(F.col("_has_customer").isNull()).alias("C03"),
        count_if(F.col("principal_amount").isNull() | (F.col("principal_amount") <= 0)).alias("C04"),
        count_if(~clean_upper("loan_status").isin(*K.LOAN_STATUSES)).alias("C15"),
        F.count(F.lit(1)).alias("total"),
    )
    return _rows(agg, ["C03", "C04", "C15"])


def installment_controls(installments: DataFrame, loans: DataFrame) -> DataFrame:
    """C05 (foreign key) and C06 (number within term) in one pass."""
    terms = one_per_key(loans, "loan_id", ["term_months"]).withColumn("_has_loan", F.lit(True))
    j = installments.join(terms, "loan_id", "left")
    agg = j.agg(
        count_if(F.col("_has_loan").isNull()).alias("C05"),
        count_if(F.col("installment_number") > F.col("term_months")).alias("C06"),
        F.count(F.lit(1)).alias("total"),
    )
    return _rows(agg, ["C05", "C06"])


def payment_controls(payments: DataFrame, installments: DataFrame) -> DataFrame:
    """C07-C11 in one pass over payments joined to their installment."""
    inst = (
        one_per_key(installments, "installment_id", ["loan_id"])
        .withColumnRenamed("loan_id", "_inst_loan")
        .withColumn("_has_inst", F.lit(True))
    )
    j = payments.join(inst, "installment_id", "left")
    status = clean_upper("payment_status")
    agg = j.agg(
        count_if(F.coalesce(~status.isin(*K.KNOWN_PAYMENT_STATUSES), F.lit(True))).alias("C07"),
        count_if((status == "CONFIRMED")
                 & (F.col("payment_amount").isNull() | (F.col("payment_amount") <= 0))).alias("C08"),
        count_if(blank_to_null("payment_channel").isNull()).alias("C09"),
        count_if(F.col("_has_inst").isNull()).alias("C10"),
        count_if(F.col("_inst_loan") != F.col("loan_id")).alias("C11"),
        F.count(F.lit(1)).alias("total"),
    )
    return _rows(agg, ["C07", "C08", "C09", "C10", "C11"])


def validity_rates(staged, min_rate: float = K.MIN_VALID_RATE) -> DataFrame:
    """Share of valid rows per staging table against the threshold (C12),
    and the share of rejected payments against its alert level (C14). One
    aggregate for each staging table gives every rate of that table."""
    counts = reduce(
        DataFrame.unionByName,
        [
            getattr(staged, name).agg(
                F.lit(f"stg_{name}").alias("table_name"),
                count_if(~F.col("is_valid")).cast("bigint").alias("failed"),
                F.count(F.lit(1)).cast("bigint").alias("total"),
            )
            for name in ("customers", "loans", "installments", "payments")
        ],
    )
    return rates(counts, min_rate)


def rates(counts: DataFrame, min_rate: float = K.MIN_VALID_RATE) -> DataFrame:
    """C12 and C14 from ``(table_name, failed, total)``, wherever it was counted."""
    every = F.array(F.lit("C12"))
    ids = F.when(F.col("table_name") == CONTROLS["C14"][0], F.array(F.lit("C12"), F.lit("C14"))).otherwise(every)
    each = counts.withColumn("control_id", F.explode(ids))
    is_validity = F.col("control_id") == "C12"
    share = F.col("failed").cast("double") / F.nullif(F.col("total"), F.lit(0)).cast("double")
    ok = F.when(is_validity, (F.lit(1.0) - share) >= min_rate).otherwise(share <= K.MAX_REJECTED_RATE)
    return each.select(
        "control_id",
        "table_name",
        F.when(is_validity, CONTROLS["C12"][1]).otherwise(CONTROLS["C14"][1]).alias("control"),
        F.when(is_validity, CRITICAL).otherwise(WARNING).alias("severity"),
        "failed",
        "total",
        F.when(F.coalesce(ok, F.lit(True)), "PASS").when(is_validity, "FAIL").otherwise("WARN").alias("status"),
    )


def mart_unique(mart: DataFrame) -> DataFrame:
    """installment_id unique in the installment mart."""
    per_key = _per_key(mart, "installment_id")
    agg = per_key.agg(
        _dup_rows(per_key, "installment_id").alias("C13"), F.sum("copies").alias("total")
    )
    return _rows(agg, ["C13"])


def control_report(raw, staged, mart: DataFrame) -> DataFrame:
    """Every control, one row each."""
    parts = [
        customer_controls(raw.customers),
        loan_controls(raw.loans, raw.customers),
        installment_controls(raw.installments, raw.loans),
        payment_controls(raw.payments, raw.installments),
        validity_rates(staged),
        mart_unique(mart),
    ]
    return reduce(DataFrame.unionByName, [p.select(*REPORT_COLUMNS) for p in parts])


def unknown_values(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """K9: values outside the domain (after trim/upper) with their row count."""
    v = clean_upper(col)
    return (
        df.where(F.coalesce(~v.isin(*domain), F.lit(True)))
        .groupBy(v.alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def reject_breakdown(payments: DataFrame) -> DataFrame:
    """Rejected payments per reason with the amount kept out of collections."""
    return (
        payments.where(~F.col("is_valid"))
        .groupBy("quality_issue")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("payment_amount").cast(K.MONEY_SUM).alias("amount"),
        )
    )


def reason_class(reason: Column) -> Column:
    """The constant part of a reason text: what precedes the quoted raw values."""
    return F.regexp_extract(reason, r"^([^:(]*[^:( ])", 1)


def reject_classes(payments: DataFrame) -> DataFrame:
    """K14 by class of reason: a handful of groups, however many ids are quoted."""
    return (
        payments.where(~F.col("is_valid"))
        .groupBy(reason_class(F.col("quality_issue")).alias("reason_class"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("payment_amount").cast(K.MONEY_SUM).alias("amount"),
        )
    )


def mart_statistics(staged, mart: DataFrame, summary: DataFrame) -> DataFrame:
    """Headline figures of the mart as (metric, value) rows.

    ``summary`` is the loan summary of ``mart``: it adds up every row of the mart, so
    the mart's sums are those of the summary and its wide rows are made once. Only
    the loans with a late installment are read from the mart itself.
    """
    val = K.MONEY_SUM
    c = staged.customers.agg(count_if(F.col("is_valid")).cast(val).alias("valid_customers"))
    lo = staged.loans.agg(
        count_if(F.col("is_valid")).cast(val).alias("valid_loans"),
        F.sum(F.when(F.col("is_valid"), F.col("principal_amount"))).cast(val).alias("disbursed"),
    )
    p = staged.payments.agg(
        count_if(F.col("is_valid")).cast(val).alias("valid_payments"),
        count_if(~F.col("is_valid")).cast(val).alias("rejected_payments"),
    )
    m = summary.agg(
        F.coalesce(F.sum("num_installments"), F.lit(0)).cast(val).alias("mart_installments"),
        F.sum("total_programmed").cast(val).alias("programmed"),
        F.sum("total_paid").cast(val).alias("collected"),
        F.sum("total_balance_due").cast(val).alias("balance"),
        F.sum("saldo_mora").cast(val).alias("arrears"),
        count_if(F.col("saldo_mora") > 0).cast(val).alias("loans_in_arrears"),
    )
    late = mart.where(F.col("installment_status") == "LATE").agg(
        F.countDistinct("loan_id").cast(val).alias("loans_with_late_installment")
    )
    parts = [c, lo, p, m, late]
    return reduce(
        DataFrame.unionByName,
        [
            part.select(
                F.explode(
                    F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                              for n in part.columns])
                ).alias("m")
            ).select("m.metric", "m.value")
            for part in parts
        ],
    )
