"""Registered queries for primitives (2.2-2.8) and documented controls and
incremental operators (2.11). Each is a small plan over the whole test tables
that exercises one inventory id through the library's own building blocks."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.functions.ratios import exact_mean, pct
from lendlake.functions.text import (
    blank_to_null,
    capitalize_first,
    message,
    text,
    trim_ws,
)
from lendlake.operators import incremental as inc
from lendlake.operators import quality as qc
from lendlake.operators import views
from lendlake.operators.keys import displaced, key_set, one_per_key
from lendlake.operators.marts import (
    arrears_sums,
    cartera_in_two_states,
    facts_of_all,
    facts_until,
    payments_per_installment,
)
from lendlake.operators.marts import as_of as mart_as_of
from lendlake.operators.ranking import global_row_number
from lendlake.operators.staging import REJECTED_COLUMNS
from lendlake.plans import catalog
from lendlake.plans.bucketed import BucketedStaging
from lendlake.plans.layers import Settings, stored
from lendlake.plans.registry import TEST_SETTINGS, Ctx, query
from lendlake.sources.adapters import TEST_SEGMENTS
from lendlake.sources.versions import VersionedTable
from lendlake.streaming.upserts import merge_into, read_target

# --- Fixed values of the checked incremental runs ---------------------------
PAYMENTS_MARK = "1999-01-01 00:00:00"
EVENTS_MARK = "2024-01-15 00:00:00"
ALT_ANALYSIS_DATE = "2000-12-31"
# --- End of fixed values ----------------------------------------------------

def as_of():
    return F.lit(_dt.date.fromisoformat(str(TEST_SETTINGS.analysis_date)))


def _valid_customers(c: Ctx, *cols: str):
    return one_per_key(c.staged.customers.where("is_valid"), "customer_id", list(cols))


# --- 2.2 scans, sources, sinks ------------------------------------------------

query("b1_scan_raw_customers")(lambda c: c.raw.customers)
query("b1_scan_raw_loans")(lambda c: c.raw.loans)
query("b1_scan_raw_installments")(lambda c: c.raw.installments)
query("b1_scan_raw_payments")(lambda c: c.raw.payments)


@query("b2_scan_derived_table")
def _b2(c: Ctx):
    """Scan of a stored staging table; the flag filter reaches the Parquet scan."""
    stored = catalog.materialize(c.spark, "stg_loans", c.staged.loans)
    return stored.where("is_valid").select("loan_id", "customer_id", "principal_amount")


@query("b3_scan_view")
def _b3(c: Ctx):
    """A business question as SQL text over a permanent view of a stored table."""
    stored = catalog.materialize(c.spark, "originacion_diaria", c.origination)
    catalog.create_view(c.spark, "vw_originacion_diaria", "originacion_diaria", stored.columns)
    return c.spark.sql(
        "SELECT segment, SUM(monto_desembolsado) AS monto_total_COP "
        f"FROM {c.spark.catalog.currentDatabase()}.vw_originacion_diaria GROUP BY segment"
    )


@query("b4_create_or_replace_table")
def _b4(c: Ctx):
    """Full refresh of a staging table, read back from storage."""
    return catalog.materialize(c.spark, "stg_customers", c.staged.customers)


@query("b5_create_or_replace_view")
def _b5(c: Ctx):
    """The audit view, a permanent view over the stored staging of payments."""
    catalog.materialize(c.spark, "stg_payments", c.staged.payments)
    return catalog.create_view(c.spark, "vw_payments_rejected", "stg_payments", REJECTED_COLUMNS, "NOT is_valid")


@query("b8_run_parameter")
def _b8(c: Ctx):
    """The loan summary at another analysis date."""
    alt = Ctx(c.spark, c.root, Settings(analysis_date=ALT_ANALYSIS_DATE, segments=TEST_SEGMENTS))
    return alt.summary


# --- 2.3 projections, filters, predicates, conditionals -----------------------

query("c1_project_rename")(
    lambda c: c.staged.payments.select(
        F.col("payment_id").alias("id_pago"),
        F.col("payment_date").alias("fecha_pago"),
        F.col("payment_amount").alias("monto"),
        F.col("payment_channel").alias("canal"),
    )
)
query("c2_select_star")(lambda c: c.staged.installments.where("is_valid AND NOT is_anomalous"))
query("c3_computed_column")(
    lambda c: c.raw.installments.withColumn(
        "total_due", (F.col("principal_due") + F.col("interest_due")).cast("decimal(19,2)")
    )
)
query("c4_flag_filter")(lambda c: c.staged.loans.where(F.col("is_valid")))
query("c5_comparison_filter")(
    lambda c: c.summary.where(F.col("saldo_mora") > 0).select("loan_id", "saldo_mora")
)
query("c6_validity_rule")(lambda c: c.staged.customers.select("customer_id", "is_valid"))
query("c7_reason_rule")(
    lambda c: c.staged.installments.where(F.col("quality_issue").isNotNull()).select(
        "installment_id", "quality_issue"
    )
)
query("c8_range_banding")(
    lambda c: c.summary.select("loan_id", "max_days_overdue", "loan_health")
)
query("c9_domain_test")(
    lambda c: c.raw.installments.groupBy(
        "installment_status",
        F.upper(trim_ws("installment_status")).isin(*K.INSTALLMENT_STATUSES).alias("in_domain"),
    ).agg(F.count(F.lit(1)).alias("rows"))
)
query("c10_between")(
    lambda c: c.mart.where(F.col("days_overdue").between(31, 60)).select(
        "installment_id", "days_overdue"
    )
)
query("c11_is_null")(
    lambda c: c.mart.where(F.col("last_payment_date").isNull()).select("installment_id", "loan_id")
)
query("c12_comparisons")(
    lambda c: c.mart.select(
        "installment_id",
        (F.col("total_paid") >= F.col("total_due")).alias("fully_paid"),
        (F.col("due_date") < F.col("analysis_date")).alias("past_due"),
        (F.col("installment_status") != "PAID").alias("not_paid"),
    )
)
query("c13_and_or_not")(
    lambda c: c.mart.where(
        (F.col("is_overdue") & ~(F.col("installment_status") == "LATE"))
        | (~F.col("is_overdue") & (F.col("balance_due") > 0))
    ).select("installment_id", "is_overdue", "installment_status")
)
query("c14_bool_predicate")(
    lambda c: c.mart.groupBy("segment").agg(
        F.sum(F.when(F.col("is_overdue"), F.col("balance_due")).otherwise(F.lit(0)))
        .cast(K.MONEY_SUM)
        .alias("saldo_mora")
    )
)

# --- 2.4 joins ----------------------------------------------------------------

query("d1_inner_join")(
    lambda c: c.staged.loans.where("is_valid")
    .join(_valid_customers(c, "city"), "customer_id", "inner")
    .select("loan_id", "customer_id", "city")
)


@query("d2_join_extra_predicate")
def _d2(c: Ctx):
    cust = one_per_key(c.staged.customers, "customer_id", ["is_valid", "segment"]).select(
        F.col("customer_id").alias("c_id"), F.col("is_valid").alias("c_valid"), "segment"
    )
    lo = c.staged.loans.where("is_valid")
    return lo.join(cust, (lo.customer_id == cust.c_id) & cust.c_valid, "inner").select(
        "loan_id", "segment"
    )


query("d3_left_join")(
    lambda c: c.staged.loans.join(_valid_customers(c, "city"), "customer_id", "left").select(
        "loan_id", "city"
    )
)
query("d4_existence_flag")(
    lambda c: c.raw.loans.join(
        key_set(c.staged.customers.where("is_valid"), "customer_id", "_ok"), "customer_id", "left"
    ).select("loan_id", F.col("_ok").isNotNull().alias("has_valid_customer"))
)
query("d5_cross_key_check")(
    lambda c: c.staged.payments.select("payment_id", "loan_id", "is_orphan", "is_loan_mismatch")
)
query("d6_star_join")(
    lambda c: views.collections_enriched(
        c.staged.customers, c.staged.loans, c.staged.installments, c.staged.payments
    ).select("payment_id", "city", "segment", "due_date", "aplica_mora")
)
query("d7_join_preaggregated")(
    lambda c: c.staged.installments.where("is_valid AND NOT is_anomalous")
    .join(payments_per_installment(c.staged.payments), "installment_id", "left")
    .select("installment_id", "total_paid", "num_payments")
)

# --- 2.5 aggregation ------------------------------------------------------------

query("e1_sum")(
    lambda c: c.staged.payments.where("is_valid").groupBy("payment_channel").agg(
        F.sum("payment_amount").cast(K.MONEY_SUM).alias("recaudo")
    )
)
query("e2_max")(
    lambda c: c.mart.groupBy("loan_id").agg(
        F.max("due_date").alias("last_due_date"),
        F.max("installment_number").alias("max_installment"),
    )
)
query("e3_avg")(
    lambda c: c.staged.loans.where("is_valid").groupBy("product_type").agg(
        exact_mean(F.col("principal_amount")).alias("ticket_promedio")
    )
)
query("e4_count_star")(
    lambda c: c.staged.payments.groupBy("payment_status").agg(F.count(F.lit(1)).alias("rows"))
)
query("e5_count_column")(
    lambda c: c.mart.groupBy("mora_bucket").agg(F.count("last_payment_date").alias("with_payment"))
)
query("e6_count_distinct")(
    lambda c: c.mart.groupBy("city").agg(
        F.countDistinct("loan_id").alias("num_creditos"),
        F.countDistinct("customer_id").alias("num_clientes"),
    )
)


@query("e7_conditional_sum")
def _e7(c: Ctx):
    mora, vigente = arrears_sums(
        F.col("installment_status"), F.col("is_overdue"), F.col("balance_due")
    )
    return c.mart.groupBy("segment").agg(mora.alias("saldo_mora"), vigente.alias("saldo_vigente"))


query("e8_conditional_count")(
    lambda c: c.mart.groupBy("cohort_month").agg(qc.count_if(F.col("is_overdue")).alias("cuotas_en_mora"))
)


@query("e9_guarded_ratio")
def _e9(c: Ctx):
    mora, _ = arrears_sums(F.col("installment_status"), F.col("is_overdue"), F.col("balance_due"))
    g = c.mart.groupBy("city").agg(
        mora.alias("saldo_mora"), F.sum("balance_due").cast(K.MONEY_SUM).alias("saldo_total")
    )
    return g.select("city", pct(F.col("saldo_mora"), F.col("saldo_total")).alias("pct_mora"))


query("e10_band_over_aggregate")(
    lambda c: c.summary.groupBy("loan_health").agg(F.count(F.lit(1)).alias("loans"))
)
query("e11_group_by_columns")(
    lambda c: c.staged.loans.where("is_valid").groupBy("product_type", "loan_status").agg(
        F.sum("principal_amount").cast(K.MONEY_SUM).alias("monto")
    )
)
query("e12_group_by_expression")(
    lambda c: c.staged.payments.where("is_valid").groupBy(
        views.month_label("payment_date").alias("mes_pago")
    ).agg(F.sum("payment_amount").cast(K.MONEY_SUM).alias("recaudo"))
)


@query("e13_group_by_all")
def _e13(c: Ctx):
    catalog.register_views(c.spark, mart=c.mart)
    return c.spark.sql(
        "SELECT loan_id, city, segment, COUNT(*) AS cuotas, "
        "CAST(SUM(balance_due) AS DECIMAL(38,2)) AS saldo FROM dm_cartera GROUP BY ALL"
    )


query("e14_two_level_aggregation")(
    lambda c: c.collections.groupBy("city").agg(
        F.sum("recaudo_total").cast(K.MONEY_SUM).alias("recaudo_total"),
        F.sum("num_pagos").cast("bigint").alias("num_pagos"),
    )
)

# --- 2.6 windows, 2.7 sorts and top-k ------------------------------------------

query("f1_global_row_number")(
    lambda c: global_row_number(
        c.staged.loans.where("is_valid").select("loan_id", "principal_amount"),
        [F.col("principal_amount").desc_nulls_last(), F.col("loan_id").asc_nulls_first()],
        "ranking",
    )
)
query("g1_sort_mixed")(
    lambda c: c.staged.payments.where("is_valid")
    .orderBy(F.col("payment_date").desc(), F.col("payment_amount").asc(), F.col("payment_id"))
    .select("payment_id", "payment_date", "payment_amount")
)


@query("g2_sort_by_position")
def _g2(c: Ctx):
    catalog.register_views(c.spark, loans=c.staged.loans)
    return c.spark.sql(
        "SELECT product_type, CAST(SUM(principal_amount) AS DECIMAL(38,2)) AS monto "
        "FROM stg_loans WHERE is_valid GROUP BY product_type ORDER BY 2 DESC"
    )


query("g3_sort_hidden_column")(
    lambda c: c.mart.groupBy("cohort_month", views.month_label("cohort_month").alias("cohorte"))
    .agg(F.count(F.lit(1)).alias("cuotas"))
    .orderBy("cohort_month")
    .select("cohorte", "cuotas")
)
query("g4_topk_rank_filter")(
    lambda c: c.staged.payments.where("is_valid")
    .select("payment_id", "payment_amount")
    .withColumn(
        "rn",
        F.row_number().over(
            Window.orderBy(F.col("payment_amount").desc_nulls_last(), F.col("payment_id"))
        ).cast("bigint"),
    )
    .where(F.col("rn") <= 5)
)

# --- 2.8 scalar functions --------------------------------------------------------

query("h1_trim")(lambda c: c.raw.customers.select("customer_id", trim_ws("full_name").alias("v")))
query("h2_upper")(lambda c: c.raw.customers.select("customer_id", F.upper("full_name").alias("v")))
query("h3_lower")(lambda c: c.raw.customers.select("customer_id", F.lower("city").alias("v")))
query("h4_left")(
    lambda c: c.raw.customers.select("customer_id", F.substring(trim_ws("city"), 1, 1).alias("v"))
)
query("h5_substring")(
    lambda c: c.raw.customers.select("customer_id", F.substr(trim_ws("city"), F.lit(2)).alias("v"))
)
query("h6_concat")(
    lambda c: c.staged.installments.select(
        "installment_id",
        message("loan ", text("loan_id"), " / ", text("installment_number")).alias("v"),
    )
)
query("h7_capitalize_first")(
    lambda c: c.raw.customers.select("customer_id", capitalize_first("city").alias("v"))
)
query("h8_coalesce")(
    lambda c: c.mart.select(
        "installment_id", F.coalesce("last_payment_date", "due_date").alias("v")
    )
)
query("h9_nullif")(
    lambda c: c.raw.payments.select("payment_id", blank_to_null("payment_channel").alias("v"))
)
query("h10_round")(
    lambda c: c.staged.loans.select(
        "loan_id", F.round(F.col("annual_rate") * 100, 2).cast("decimal(9,2)").alias("v")
    )
)
query("h11_greatest")(
    lambda c: c.mart.select(
        "installment_id",
        F.greatest(F.col("total_due") - F.col("total_paid"), F.lit(0)).cast(K.MONEY_SUM).alias("v"),
    )
)
query("h12_arithmetic")(
    lambda c: c.raw.installments.select(
        "installment_id",
        (F.col("principal_due") + F.col("interest_due")).cast("decimal(19,2)").alias("plus"),
        (F.col("principal_due") - F.col("interest_due")).cast("decimal(19,2)").alias("minus"),
        (F.col("interest_due") * 2).cast("decimal(19,2)").alias("times"),
        (F.col("principal_due").cast("double") / F.lit(4.0)).alias("divided"),
    )
)
query("h13_date_trunc_month")(
    lambda c: c.raw.loans.select("loan_id", F.trunc("origination_date", "MM").alias("v"))
)
query("h14_format_date")(
    lambda c: c.raw.loans.select("loan_id", views.month_label("origination_date").alias("v"))
)
query("h15_date_diff")(
    lambda c: c.raw.installments.select(
        "installment_id", F.datediff(as_of(), F.col("due_date")).cast("bigint").alias("v")
    )
)
query("h16_date_literal")(
    lambda c: c.raw.installments.where(F.col("due_date") < as_of()).groupBy("installment_status").agg(
        F.count(F.lit(1)).alias("rows")
    )
)


@query("h17_current_timestamp")
def _h17(c: Ctx):
    """Load time added at the sink: present, and not before the run began."""
    began = F.lit(_dt.datetime.now(_dt.timezone.utc))
    stamped = catalog.with_load_time(c.staged.customers, "_stg_loaded_at")
    return stamped.select(
        "customer_id",
        F.col("_stg_loaded_at").isNotNull().alias("has_load_time"),
        (F.col("_stg_loaded_at") >= began).alias("within_run"),
    )




@query("h18_date_comparison")
def _h18(c: Ctx):
    inst = one_per_key(c.staged.installments, "installment_id", ["due_date"])
    return c.staged.payments.join(inst, "installment_id", "inner").select(
        "payment_id", (F.col("payment_date") > F.col("due_date")).alias("paid_late")
    )


# --- 2.11 controls -----------------------------------------------------------------

query("k4_required_not_null")(lambda c: qc.customer_controls(c.raw.customers).where("control_id = 'C01'"))
query("k5_unique_key")(lambda c: qc.customer_controls(c.raw.customers).where("control_id = 'C02'"))
query("k5_duplicated_keys")(lambda c: qc.duplicated_keys(c.raw.installments, "loan_id"))
query("k6_foreign_key")(
    lambda c: qc.loan_controls(c.raw.loans, c.raw.customers).where("control_id = 'C03'")
)
query("k7_positive_amount")(
    lambda c: qc.payment_controls(c.raw.payments, c.raw.installments).where("control_id = 'C08'")
)
query("k8_number_within_term")(
    lambda c: qc.installment_controls(c.raw.installments, c.raw.loans).where("control_id = 'C06'")
)
query("k9_known_status")(
    lambda c: qc.payment_controls(c.raw.payments, c.raw.installments).where("control_id = 'C07'")
)
query("k9_unknown_values")(
    lambda c: qc.unknown_values(c.raw.customers, "segment", TEST_SEGMENTS)
)
query("k10_channel_not_null")(
    lambda c: qc.payment_controls(c.raw.payments, c.raw.installments).where("control_id = 'C09'")
)
query("k11_loan_consistency")(
    lambda c: qc.payment_controls(c.raw.payments, c.raw.installments).where("control_id = 'C11'")
)
query("k9_known_loan_status")(
    lambda c: qc.loan_controls(c.raw.loans, c.raw.customers).where("control_id = 'C15'")
)
query("k9_unknown_loan_status")(
    lambda c: qc.unknown_values(c.raw.loans, "loan_status", K.LOAN_STATUSES)
)
query("k12_validity_rate")(lambda c: qc.validity_rates(c.staged))
query("k13_control_report")(lambda c: qc.control_report(c.raw, c.staged, c.mart))
query("k14_reject_breakdown")(lambda c: qc.reject_breakdown(c.staged.payments))
query("k14_reject_classes")(lambda c: qc.reject_classes(c.staged.payments))
query("k15_mart_statistics")(lambda c: qc.mart_statistics(c.staged, c.mart, c.summary))

# --- 2.11 incremental ----------------------------------------------------------------

query("k1_incremental_payments")(lambda c: inc.new_rows(c.raw.payments, "loaded_at", PAYMENTS_MARK))
query("k1_watermark_payments")(lambda c: inc.advance_mark(c.raw.payments, "loaded_at", PAYMENTS_MARK))


def _events(c: Ctx):
    from lendlake.sources.raw import read_table

    return read_table(c.spark, c.root, "events")


query("k1_incremental_events")(lambda c: inc.new_rows(_events(c), "ts", EVENTS_MARK))
query("k1_watermark_events")(lambda c: inc.advance_mark(_events(c), "ts", EVENTS_MARK))


@query("k2_upsert_events")
def _k2e(c: Ctx):
    ev = _events(c)
    mark = inc.as_mark(EVENTS_MARK)
    return inc.upsert(ev.where(F.col("ts") <= mark), ev.where(F.col("ts") > mark), "user_id",
                      ["ts", "event_id"])


@query("k2_upsert_payments")
def _k2p(c: Ctx):
    p = c.raw.payments
    mark = inc.as_mark(PAYMENTS_MARK)
    return inc.upsert(p.where(F.col("loaded_at") <= mark), p.where(F.col("loaded_at") > mark),
                      "payment_id", ["loaded_at"])


query("k3_touched_partitions")(
    lambda c: inc.touched_partitions(
        c.mart, inc.new_rows(c.raw.payments, "loaded_at", PAYMENTS_MARK), "loan_id", "cohort_month"
    )
)


@query("k2_bucketed_upsert")
def _k2b(c: Ctx):
    """The payments up to the mark as a stored table in key buckets, into which those
    after it are merged: only their buckets are written anew."""
    # Derived from the source once: both batches, and the search for the second one's
    # buckets, are filters over the stored rows.
    p = stored("raw_payments", c.raw.payments)
    mark = inc.as_mark(PAYMENTS_MARK)
    table = _scratch_table(c, "payments")
    for part in (p.where(F.col("loaded_at") <= mark), p.where(F.col("loaded_at") > mark)):
        merge_into(table, part, "payment_id", ["loaded_at"], buckets=8)
    return read_target(table)


def _scratch_table(c: Ctx, name: str) -> VersionedTable:
    return VersionedTable(c.spark, f"{catalog.table_root(c.spark)}/{name}-{uuid.uuid4().hex}")


@query("k3_rebuilt_mart")
def _k3r(c: Ctx):
    """The mart's facts as of the mark, stored by cohort, with the cohorts touched
    by the later payments rebuilt; read back whole as of the analysis date."""
    raw, mark = c.raw, inc.as_mark(PAYMENTS_MARK)
    # Both marts come from one pass whose rows move to their cohorts once: what is
    # written from the stored rows, the first version and the rebuilt cohorts, stays there.
    states = _scratch_table(c, "cartera_states")
    states.replace(
        cartera_in_two_states(
            raw.customers, raw.loans, raw.installments, raw.payments,
            F.col("loaded_at") <= mark, TEST_SETTINGS.segments,
        ),
        "cohort_month",
    )
    table = _scratch_table(c, "cartera_facts")
    table.replace(facts_until(states.read()), "cohort_month", dealt=True)
    facts = facts_of_all(states.read())
    new = inc.new_rows(raw.payments, "loaded_at", PAYMENTS_MARK)
    touched = inc.touched_partitions(facts, new, "installment_id", "cohort_month")
    inc.rebuild_partitions(facts, stored("touched_cohorts", touched), table, None, True)
    states.drop()
    return mart_as_of(table.read(), TEST_SETTINGS.analysis_date)


@query("k5_displaced_copies")
def _k5d(c: Ctx):
    """Events that are not their user's newest one, with the one chosen for the user."""
    return displaced(_events(c), "user_id", ["ts", "event_id"]).select(
        "event_id", "user_id", F.col("chosen.event_id").alias("chosen_event_id"), "reason", "copies"
    )


def _from_buckets(c: Ctx):
    """The marts over staging stored in buckets of their join keys."""
    store = BucketedStaging(c.spark, f"{catalog.table_root(c.spark)}/staging-{uuid.uuid4().hex}")
    store.store(c.raw, c.settings)
    return store.marts(c.settings)


query("a6_cartera_from_buckets")(lambda c: _from_buckets(c).cartera)
query("a7_resumen_from_buckets")(lambda c: _from_buckets(c).resumen)
