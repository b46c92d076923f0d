"""BI views (A8-A12): origination, collections, cohort, top arrears, wide set.

Views stay lazy: each function returns a plan over the staging or mart
DataFrames it is given (read from storage in production, derived in tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.functions.ratios import exact_mean, pct
from lendlake.operators.keys import one_per_key
from lendlake.operators.marts import arrears_sums
from lendlake.operators.ranking import global_row_number


def month_label(c: str) -> F.Column:
    """FORMAT_DATE('%Y-%m', d)."""
    return F.date_format(F.col(c), "yyyy-MM")


def vw_originacion_diaria(customers: DataFrame, loans: DataFrame) -> DataFrame:
    """Originations per day, month, city, segment and product."""
    cust = one_per_key(customers.where("is_valid"), "customer_id", ["city", "segment"])
    j = loans.where("is_valid").join(cust, "customer_id", "inner")
    return j.groupBy(
        "origination_date",
        month_label("origination_date").alias("mes_originacion"),
        "city",
        "segment",
        "product_type",
    ).agg(
        F.countDistinct("loan_id").alias("num_creditos"),
        F.sum("principal_amount").cast(K.MONEY_SUM).alias("monto_desembolsado"),
        exact_mean(F.col("principal_amount")).alias("ticket_promedio"),
        exact_mean(F.col("annual_rate")).alias("tasa_promedio"),
        exact_mean(F.col("term_months")).alias("plazo_promedio"),
    )


def collections_enriched(
    customers: DataFrame, loans: DataFrame, installments: DataFrame, payments: DataFrame
) -> DataFrame:
    """Valid payments with their installment, valid loan and valid customer (D6),
    and whether each one was applied to arrears (N15)."""
    inst = one_per_key(installments, "installment_id", ["due_date", "installment_status"])
    lo = one_per_key(loans.where("is_valid"), "loan_id", ["customer_id"])
    cust = one_per_key(customers.where("is_valid"), "customer_id", ["city", "segment"])
    j = (
        payments.where("is_valid")
        .select("payment_id", "payment_date", "payment_amount", "payment_channel",
                "loan_id", "installment_id")
        .join(inst, "installment_id", "inner")
        .join(lo, "loan_id", "inner")
        .join(cust, "customer_id", "inner")
    )
    return j.withColumn("aplica_mora", applied_to_arrears())


def collections_from_inputs(
    customers: DataFrame, loans: DataFrame, installments: DataFrame, payments: DataFrame,
    segments=K.SEGMENTS,
) -> DataFrame:
    """The same rows as ``collections_enriched``, in one join.

    A valid payment must hit a valid, normal installment of its own loan, and
    the star join on the payment's loan drops a NULL loan (N20); so joining
    the payments that pass their own rules to the valid installments on
    installment_id, with equal loans, gives exactly the valid, joined payments,
    and the installment rows already carry the loan's customer attributes. The
    loans are compared by two inequalities, which Spark keeps as a condition of
    the join: as a join key they would move the installments a second time.
    """
    from lendlake.operators.marts import InputParts

    parts = InputParts(customers, loans, installments, payments, segments)
    inst = one_per_key(
        parts.normal_installments(), "installment_id",
        ["loan_id", "due_date", "installment_status", "city", "segment"],
    ).withColumnsRenamed({"installment_id": "_inst_id", "loan_id": "_inst_loan"})
    j = parts.payments.select(
        "payment_id", "payment_date", "payment_amount", "payment_channel", "loan_id",
        "installment_id",
    )
    same_loan = j["loan_id"].between(inst["_inst_loan"], inst["_inst_loan"])
    same_installment = j["installment_id"] == inst["_inst_id"]
    j = j.join(inst, same_installment & same_loan, "inner").drop("_inst_id", "_inst_loan")
    return j.withColumn("aplica_mora", applied_to_arrears())


def applied_to_arrears() -> F.Column:
    """Payment applied to an installment in arrears."""
    status = F.col("installment_status")
    late = (F.col("due_date") < F.col("payment_date")) & ~status.isin("PAID", "DUE")
    return F.when(status == "LATE", True).when(late, True).otherwise(False)


def collections_by_day(pe: DataFrame) -> DataFrame:
    """A9's aggregation over enriched valid payments."""
    amount = F.col("payment_amount")
    mora = F.sum(F.when(F.col("aplica_mora"), amount).otherwise(F.lit(0)))
    g = pe.groupBy(
        "payment_date",
        month_label("payment_date").alias("mes_pago"),
        "city",
        "segment",
        "payment_channel",
    ).agg(
        F.countDistinct("payment_id").alias("num_pagos"),
        F.sum(amount).cast(K.MONEY_SUM).alias("recaudo_total"),
        mora.cast(K.MONEY_SUM).alias("recaudo_en_mora"),
        F.sum(F.when(~F.col("aplica_mora"), amount).otherwise(F.lit(0)))
        .cast(K.MONEY_SUM)
        .alias("recaudo_vigente"),
    )
    return g.withColumn("pct_recaudo_mora", pct(F.col("recaudo_en_mora"), F.col("recaudo_total")))


def vw_recaudo_diario(
    customers: DataFrame, loans: DataFrame, installments: DataFrame, payments: DataFrame
) -> DataFrame:
    """Collections per day, month, city, segment and channel, split into
    arrears and current."""
    return collections_by_day(collections_enriched(customers, loans, installments, payments))


def vw_cartera_cohorte(mart: DataFrame) -> DataFrame:
    """A10: portfolio per cohort month, city, segment, product and bucket.
    ``num_creditos`` counts loans per bucket and does not add up over buckets.

    Both exact distinct counts come from one chain of plain aggregations, without
    copying the rows once a count: rows are first reduced by (group, installment,
    loan), which needs no shuffle where the mart lies by installment; an
    installment counts with the least of its loans; then loans per group, then groups.
    """
    group = ["cohort_month", "city", "segment", "product_type", "mora_bucket"]
    mora, vigente = arrears_sums(
        F.col("installment_status"), F.col("is_overdue"), F.col("balance_due")
    )
    money = {
        "total_programado": F.sum("total_due"),
        "total_pagado": F.sum("total_paid"),
        "saldo_pendiente": F.sum("balance_due"),
        "saldo_mora": mora,
        "saldo_vigente": vigente,
    }
    again = [F.sum(c).cast(K.MONEY_SUM).alias(c) for c in money] + [F.max("max_dias_mora").alias("max_dias_mora")]
    pairs = mart.groupBy(*group, "installment_id", "loan_id").agg(
        *[s.cast(K.MONEY_SUM).alias(c) for c, s in money.items()],
        F.max("days_overdue").alias("max_dias_mora"),
    )
    counts_here = Window.partitionBy(*group, "installment_id").orderBy("loan_id")
    first = (F.row_number().over(counts_here) == 1) & F.col("installment_id").isNotNull()
    loans = pairs.withColumn("_first", first.cast("bigint")).groupBy(*group, "loan_id").agg(
        *again, F.sum("_first").alias("num_cuotas")
    )
    g = loans.groupBy(*group).agg(
        *again, F.count("loan_id").alias("num_creditos"), F.sum("num_cuotas").alias("num_cuotas")
    )
    return g.select(
        "cohort_month",
        month_label("cohort_month").alias("cohort_label"),
        *group[1:],
        "num_creditos",
        "num_cuotas",
        *money,
        "max_dias_mora",
    )


TOP_MORA_COLUMNS = [
    "loan_id", "customer_id", "full_name", "city", "segment", "loan_status",
    "loan_principal", "max_days_overdue", "saldo_mora", "total_balance_due", "total_paid",
    "loan_health",
]


def arrears_order() -> list[F.Column]:
    """Largest arrears first, then worst delay; loan_id breaks ties."""
    return [
        F.col("saldo_mora").desc_nulls_last(),
        F.col("max_days_overdue").desc_nulls_last(),
        F.col("loan_id").asc_nulls_first(),
    ]


def vw_top_mora(summary: DataFrame) -> DataFrame:
    """Every loan in arrears with its rank, computed without a
    single-partition window (see ``ranking``)."""
    in_arrears = summary.where(F.col("saldo_mora") > 0).select(*TOP_MORA_COLUMNS)
    return global_row_number(in_arrears, arrears_order(), "ranking_mora")


def vw_bi_completo(mart: DataFrame) -> DataFrame:
    """The mart plus month labels, rate %, collected % and fully-paid flag."""
    return mart.select(
        "origination_date",
        "cohort_month",
        month_label("cohort_month").alias("cohort_label"),
        "due_date",
        month_label("due_date").alias("mes_vencimiento"),
        "last_payment_date",
        "analysis_date",
        "city",
        "segment",
        "product_type",
        "loan_id",
        "customer_id",
        "full_name",
        "loan_status",
        "loan_principal",
        "annual_rate",
        F.round(F.col("annual_rate") * 100, 2).cast("decimal(9,2)").alias("annual_rate_pct"),
        "term_months",
        "installment_id",
        "installment_number",
        "installment_status",
        "mora_bucket",
        "is_overdue",
        "days_overdue",
        "principal_due",
        "interest_due",
        "total_due",
        "total_paid",
        "balance_due",
        "num_payments",
        pct(F.col("total_paid"), F.col("total_due")).alias("pct_cobrado"),
        F.when(F.col("total_paid") >= F.col("total_due"), True)
        .otherwise(False)
        .alias("cuota_pagada_completa"),
    )
