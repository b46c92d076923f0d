"""Business questions (Q01a-Q05) over the BI views and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.functions.ratios import pct
from lendlake.operators.marts import arrears_sums
from lendlake.operators.views import TOP_MORA_COLUMNS, arrears_order, month_label


def _disbursed(origination: DataFrame, *keys) -> DataFrame:
    return origination.groupBy(*keys).agg(
        F.sum("monto_desembolsado").cast(K.MONEY_SUM).alias("monto_total_COP")
    )


def q01a_disbursed_by_day(origination: DataFrame) -> DataFrame:
    """Disbursed per day, oldest first."""
    return (
        _disbursed(origination, F.col("origination_date").alias("fecha_desembolso"))
        .orderBy(F.col("fecha_desembolso").asc())
    )


def q01b_disbursed_by_city(origination: DataFrame) -> DataFrame:
    """Disbursed per city, largest first."""
    return _disbursed(origination, "city").orderBy(F.col("monto_total_COP").desc())


def q01c_disbursed_by_segment(origination: DataFrame) -> DataFrame:
    """Disbursed per segment, largest first."""
    return _disbursed(origination, "segment").orderBy(F.col("monto_total_COP").desc())


def q01d_disbursed_by_day_city_segment(origination: DataFrame) -> DataFrame:
    """Disbursed per day, city and segment; latest day first, then amount."""
    return _disbursed(
        origination,
        F.col("origination_date").alias("fecha_desembolso"),
        F.col("city").alias("ciudad"),
        F.col("segment").alias("segmento"),
    ).orderBy(F.col("fecha_desembolso").desc(), F.col("monto_total_COP").desc())


def q02_collections_by_day(collections: DataFrame) -> DataFrame:
    """Collections per day and the part applied to arrears."""
    return (
        collections.groupBy(F.col("payment_date").alias("fecha_pago"))
        .agg(
            F.sum("num_pagos").cast("bigint").alias("numero_pagos"),
            F.sum("recaudo_total").cast(K.MONEY_SUM).alias("recaudo_total_COP"),
            F.sum("recaudo_en_mora").cast(K.MONEY_SUM).alias("recaudo_en_mora_COP"),
        )
        .orderBy("fecha_pago")
    )


def q03_cohort_health(mart: DataFrame) -> DataFrame:
    """Current vs arrears per cohort and segment, with arrears and collection
    percentages. ``cartera_originada`` sums the loan principal once per
    installment, as the source question does (N16)."""
    mora, vigente = arrears_sums(
        F.col("installment_status"), F.col("is_overdue"), F.col("balance_due")
    )
    base = mart.groupBy(
        "cohort_month", month_label("cohort_month").alias("cohort_label"), "segment"
    ).agg(
        F.countDistinct("loan_id").alias("num_creditos"),
        F.sum("loan_principal").cast(K.MONEY_SUM).alias("cartera_originada"),
        F.sum("total_due").cast(K.MONEY_SUM).alias("total_programado"),
        F.sum("total_paid").cast(K.MONEY_SUM).alias("total_recaudado"),
        F.sum("balance_due").cast(K.MONEY_SUM).alias("saldo_total"),
        mora.alias("saldo_mora"),
        vigente.alias("saldo_vigente"),
        F.max("days_overdue").alias("max_dias_mora"),
        F.count(F.when(F.col("is_overdue"), 1)).alias("cuotas_en_mora"),
        F.count("installment_id").alias("cuotas_totales"),
    )
    # Sort by the hidden cohort_month first, then project.
    return base.orderBy("cohort_month", "segment").select(
        F.col("cohort_label").alias("cohorte"),
        F.col("segment").alias("segmento"),
        "num_creditos",
        "cartera_originada",
        "total_programado",
        "total_recaudado",
        "saldo_total",
        "saldo_vigente",
        "saldo_mora",
        pct(F.col("saldo_mora"), F.col("saldo_total")).alias("pct_mora"),
        pct(F.col("cuotas_en_mora"), F.col("cuotas_totales")).alias("pct_cuotas_mora"),
        "max_dias_mora",
        pct(F.col("total_recaudado"), F.col("total_programado")).alias("pct_cobertura_recaudo"),
    )


TOP_K = 10


def q04_top_arrears(summary: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k loans with the largest arrears.

    Written as a rank filter over a global window; Catalyst turns
    ``row_number() <= k`` with no partition into a top-k (each task keeps k
    rows, the driver merges k per task), so nothing is fully sorted.
    """
    ranked = (
        summary.where(F.col("saldo_mora") > 0)
        .select(*TOP_MORA_COLUMNS)
        .withColumn("ranking_mora", F.row_number().over(Window.orderBy(*arrears_order())))
        .where(F.col("ranking_mora") <= k)
    )
    return ranked.orderBy("ranking_mora").select(
        F.col("ranking_mora").cast("bigint").alias("ranking"),
        "loan_id",
        F.col("full_name").alias("cliente"),
        F.col("city").alias("ciudad"),
        F.col("segment").alias("segmento"),
        F.col("loan_status").alias("estado_credito"),
        F.col("loan_principal").alias("monto_original_COP"),
        F.col("total_paid").alias("total_pagado_COP"),
        F.col("saldo_mora").alias("saldo_en_mora_COP"),
        F.col("total_balance_due").alias("saldo_total_pendiente_COP"),
        F.col("max_days_overdue").alias("dias_maximo_mora"),
        F.col("loan_health").alias("clasificacion_salud"),
    )


def bi_order() -> list[Column]:
    """Latest origination first."""
    return [F.col("origination_date").desc(), F.col("loan_id").asc(), F.col("installment_number").asc()]


def q05_bi_dataset(bi: DataFrame, in_order: bool = False) -> DataFrame:
    """The wide BI extract with business names, latest origination first. A ``bi``
    made from rows ``in_order`` isn't sorted again."""
    return (bi if in_order else bi.orderBy(*bi_order())).select(
        F.col("analysis_date").alias("fecha_analisis"),
        F.col("origination_date").alias("fecha_desembolso"),
        F.col("cohort_label").alias("cohorte_originacion"),
        F.col("due_date").alias("fecha_vencimiento_cuota"),
        "mes_vencimiento",
        F.col("last_payment_date").alias("ultimo_pago"),
        F.col("city").alias("ciudad"),
        F.col("segment").alias("segmento"),
        F.col("product_type").alias("tipo_producto"),
        F.col("loan_id").alias("id_credito"),
        F.col("customer_id").alias("id_cliente"),
        F.col("full_name").alias("nombre_cliente"),
        F.col("loan_status").alias("estado_credito"),
        F.col("loan_principal").alias("monto_desembolsado"),
        F.round(F.col("annual_rate_pct"), 2).cast("decimal(9,2)").alias("tasa_ea_pct"),
        F.col("term_months").alias("plazo_meses"),
        F.col("installment_id").alias("id_cuota"),
        F.col("installment_number").alias("numero_cuota"),
        F.col("installment_status").alias("estado_cuota"),
        F.col("mora_bucket").alias("bucket_mora"),
        F.col("is_overdue").alias("en_mora"),
        F.col("days_overdue").alias("dias_mora"),
        F.col("principal_due").alias("capital_programado"),
        F.col("interest_due").alias("intereses_programados"),
        F.col("total_due").alias("cuota_total_programada"),
        F.col("total_paid").alias("total_pagado"),
        F.col("balance_due").alias("saldo_pendiente"),
        F.col("num_payments").alias("num_pagos_realizados"),
        F.col("pct_cobrado").alias("porcentaje_cobrado"),
        "cuota_pagada_completa",
    )


def q03_principal_per_cohort(summary: DataFrame) -> DataFrame:
    """Originated principal per cohort and segment counting each loan once
    (from the loan summary), next to Q03's per-installment sum (N16)."""
    return summary.groupBy(
        month_label("cohort_month").alias("cohorte"), F.col("segment").alias("segmento")
    ).agg(
        F.count(F.lit(1)).alias("num_creditos"),
        F.sum("loan_principal").cast(K.MONEY_SUM).alias("principal_distinct"),
    )
