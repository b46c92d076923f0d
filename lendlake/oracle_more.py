"""Oracle SQL for the primitive, control and incremental queries."""

from __future__ import annotations

from lendlake.oracle import (
    ANALYSIS_DATE,
    BASE,
    MART,
    MARTS,
    ORIGINACION,
    RECAUDO,
    RESUMEN,
    _trim,
    register,
)

D = ANALYSIS_DATE
PAY_MARK = "TIMESTAMP '1999-01-01 00:00:00'"
EV_MARK = "TIMESTAMP '2024-01-15 00:00:00'"
M38 = "DECIMAL(38,2)"

# --- 2.2 ------------------------------------------------------------------------
register("b1_scan_raw_customers", BASE, "SELECT * FROM raw_customers")
register("b1_scan_raw_loans", BASE, "SELECT * FROM raw_loans")
register("b1_scan_raw_installments", BASE, "SELECT * FROM raw_installments")
register("b1_scan_raw_payments", BASE, "SELECT * FROM raw_payments")
register(
    "b2_scan_derived_table", BASE,
    "SELECT loan_id, customer_id, principal_amount FROM stg_loans WHERE is_valid",
)
register(
    "b3_scan_view", BASE + (ORIGINACION,),
    f'SELECT segment, CAST(sum(monto_desembolsado) AS {M38}) AS "monto_total_COP" '
    "FROM vw_originacion_diaria GROUP BY segment",
)
register("b4_create_or_replace_table", BASE, "SELECT * FROM stg_customers")
register(
    "b5_create_or_replace_view", BASE,
    """SELECT payment_id, loan_id, installment_id, payment_date, payment_amount, payment_channel,
              payment_status, quality_issue FROM stg_payments WHERE is_valid = FALSE""",
)
ALT = "DATE '2000-12-31'"
register(
    "b8_run_parameter",
    BASE + (MART.replace(D, ALT), RESUMEN),
    "SELECT * FROM dm_resumen_credito",
)

# --- 2.3 ------------------------------------------------------------------------
register(
    "c1_project_rename", BASE,
    "SELECT payment_id AS id_pago, payment_date AS fecha_pago, payment_amount AS monto, "
    "payment_channel AS canal FROM stg_payments",
)
register("c2_select_star", BASE,
         "SELECT * FROM stg_installments WHERE is_valid = TRUE AND is_anomalous = FALSE")
register("c3_computed_column", BASE,
         "SELECT *, CAST(principal_due + interest_due AS DECIMAL(19,2)) AS total_due FROM raw_installments")
register("c4_flag_filter", BASE, "SELECT * FROM stg_loans WHERE is_valid = TRUE")
register("c5_comparison_filter", MARTS + (RESUMEN,),
         "SELECT loan_id, saldo_mora FROM dm_resumen_credito WHERE saldo_mora > 0")
register("c6_validity_rule", BASE, "SELECT customer_id, is_valid FROM stg_customers")
register("c7_reason_rule", BASE,
         "SELECT installment_id, quality_issue FROM stg_installments WHERE quality_issue IS NOT NULL")
register("c8_range_banding", MARTS + (RESUMEN,),
         "SELECT loan_id, max_days_overdue, loan_health FROM dm_resumen_credito")
register(
    "c9_domain_test", BASE,
    f"""SELECT installment_status,
               upper({_trim('installment_status')}) IN ('PAID','LATE','DUE','PARTIAL') AS in_domain,
               count(*) AS rows
        FROM raw_installments GROUP BY 1, 2""",
)
register("c10_between", MARTS,
         "SELECT installment_id, days_overdue FROM dm_cartera WHERE days_overdue BETWEEN 31 AND 60")
register("c11_is_null", MARTS,
         "SELECT installment_id, loan_id FROM dm_cartera WHERE last_payment_date IS NULL")
register(
    "c12_comparisons", MARTS,
    """SELECT installment_id, total_paid >= total_due AS fully_paid,
              due_date < analysis_date AS past_due, installment_status <> 'PAID' AS not_paid
       FROM dm_cartera""",
)
register(
    "c13_and_or_not", MARTS,
    """SELECT installment_id, is_overdue, installment_status FROM dm_cartera
       WHERE (is_overdue AND NOT installment_status = 'LATE') OR (NOT is_overdue AND balance_due > 0)""",
)
register(
    "c14_bool_predicate", MARTS,
    f"""SELECT segment, CAST(sum(CASE WHEN is_overdue THEN balance_due ELSE 0 END) AS {M38}) AS saldo_mora
        FROM dm_cartera GROUP BY segment""",
)

# --- 2.4 ------------------------------------------------------------------------
CUST_CITY = """(SELECT customer_id, max(city) AS city FROM stg_customers
                WHERE is_valid AND customer_id IS NOT NULL GROUP BY customer_id)"""
register(
    "d1_inner_join", BASE,
    f"""SELECT l.loan_id, l.customer_id, c.city FROM stg_loans l
        JOIN {CUST_CITY} c ON l.customer_id = c.customer_id WHERE l.is_valid""",
)
register(
    "d2_join_extra_predicate", BASE,
    """SELECT l.loan_id, c.r.segment AS segment FROM stg_loans l
       JOIN (SELECT customer_id, max(struct_pack(is_valid := is_valid, segment := segment)) AS r
             FROM stg_customers WHERE customer_id IS NOT NULL GROUP BY customer_id) c
         ON l.customer_id = c.customer_id AND c.r.is_valid
       WHERE l.is_valid""",
)
register(
    "d3_left_join", BASE,
    f"SELECT l.loan_id, c.city FROM stg_loans l LEFT JOIN {CUST_CITY} c ON l.customer_id = c.customer_id",
)
register(
    "d4_existence_flag", BASE,
    """SELECT l.loan_id, vc.customer_id IS NOT NULL AS has_valid_customer
       FROM raw_loans l LEFT JOIN trusted_customer vc ON l.customer_id = vc.customer_id""",
)
register("d5_cross_key_check", BASE,
         "SELECT payment_id, loan_id, is_orphan, is_loan_mismatch FROM stg_payments")
register("d6_star_join", BASE + (RECAUDO,),
         "SELECT payment_id, city, segment, due_date, aplica_mora FROM collected")
register(
    "d7_join_preaggregated", MARTS,
    """SELECT ic.installment_id, p.total_paid, p.num_payments FROM normal_installment ic
       LEFT JOIN paid p ON ic.installment_id = p.installment_id""",
)

# --- 2.5 ------------------------------------------------------------------------
register("e1_sum", BASE,
         f"SELECT payment_channel, CAST(sum(payment_amount) AS {M38}) AS recaudo "
         "FROM stg_payments WHERE is_valid GROUP BY payment_channel")
register("e2_max", MARTS,
         "SELECT loan_id, max(due_date) AS last_due_date, max(installment_number) AS max_installment "
         "FROM dm_cartera GROUP BY loan_id")
register("e3_avg", BASE,
         "SELECT product_type, CAST(sum(principal_amount) AS DOUBLE) / nullif(count(principal_amount), 0) "
         "AS ticket_promedio FROM stg_loans WHERE is_valid GROUP BY product_type")
register("e4_count_star", BASE,
         "SELECT payment_status, count(*) AS rows FROM stg_payments GROUP BY payment_status")
register("e5_count_column", MARTS,
         "SELECT mora_bucket, count(last_payment_date) AS with_payment FROM dm_cartera GROUP BY mora_bucket")
register("e6_count_distinct", MARTS,
         "SELECT city, count(DISTINCT loan_id) AS num_creditos, count(DISTINCT customer_id) AS num_clientes "
         "FROM dm_cartera GROUP BY city")
register(
    "e7_conditional_sum", MARTS,
    f"""SELECT segment,
               CAST(sum(CASE WHEN is_overdue THEN balance_due ELSE 0 END) AS {M38}) AS saldo_mora,
               CAST(sum(CASE WHEN NOT is_overdue AND installment_status <> 'PAID'
                             THEN balance_due ELSE 0 END) AS {M38}) AS saldo_vigente
        FROM dm_cartera GROUP BY segment""",
)
register("e8_conditional_count", MARTS,
         "SELECT cohort_month, count(CASE WHEN is_overdue THEN 1 END) AS cuotas_en_mora "
         "FROM dm_cartera GROUP BY cohort_month")
register(
    "e9_guarded_ratio", MARTS,
    f"""SELECT city, round(100.0 * CAST(saldo_mora AS DOUBLE) / nullif(CAST(saldo_total AS DOUBLE), 0), 2)
               AS pct_mora
        FROM (SELECT city,
                     CAST(sum(CASE WHEN is_overdue THEN balance_due ELSE 0 END) AS {M38}) AS saldo_mora,
                     CAST(sum(balance_due) AS {M38}) AS saldo_total
              FROM dm_cartera GROUP BY city)""",
)
register("e10_band_over_aggregate", MARTS + (RESUMEN,),
         "SELECT loan_health, count(*) AS loans FROM dm_resumen_credito GROUP BY loan_health")
register("e11_group_by_columns", BASE,
         f"SELECT product_type, loan_status, CAST(sum(principal_amount) AS {M38}) AS monto "
         "FROM stg_loans WHERE is_valid GROUP BY product_type, loan_status")
register("e12_group_by_expression", BASE,
         f"SELECT strftime(payment_date, '%Y-%m') AS mes_pago, CAST(sum(payment_amount) AS {M38}) AS recaudo "
         "FROM stg_payments WHERE is_valid GROUP BY strftime(payment_date, '%Y-%m')")
register("e13_group_by_all", MARTS,
         f"SELECT loan_id, city, segment, count(*) AS cuotas, CAST(sum(balance_due) AS {M38}) AS saldo "
         "FROM dm_cartera GROUP BY ALL")
register("e14_two_level_aggregation", BASE + (RECAUDO,),
         f"SELECT city, CAST(sum(recaudo_total) AS {M38}) AS recaudo_total, "
         "CAST(sum(num_pagos) AS BIGINT) AS num_pagos FROM vw_recaudo_diario GROUP BY city")

# --- 2.6, 2.7 ---------------------------------------------------------------------
register(
    "f1_global_row_number", BASE,
    """SELECT loan_id, principal_amount,
              row_number() OVER (ORDER BY principal_amount DESC NULLS LAST, loan_id ASC NULLS FIRST)
                  AS ranking
       FROM stg_loans WHERE is_valid""",
)
register("g1_sort_mixed", BASE,
         "SELECT payment_id, payment_date, payment_amount FROM stg_payments WHERE is_valid "
         "ORDER BY payment_date DESC, payment_amount ASC, payment_id")
register("g2_sort_by_position", BASE,
         f"SELECT product_type, CAST(sum(principal_amount) AS {M38}) AS monto FROM stg_loans "
         "WHERE is_valid GROUP BY product_type ORDER BY 2 DESC")
register(
    "g3_sort_hidden_column", MARTS,
    """SELECT cohorte, cuotas FROM (
           SELECT cohort_month, strftime(cohort_month, '%Y-%m') AS cohorte, count(*) AS cuotas
           FROM dm_cartera GROUP BY 1, 2) ORDER BY cohort_month""",
)
register(
    "g4_topk_rank_filter", BASE,
    """SELECT * FROM (
           SELECT payment_id, payment_amount,
                  row_number() OVER (ORDER BY payment_amount DESC NULLS LAST, payment_id) AS rn
           FROM stg_payments WHERE is_valid) WHERE rn <= 5""",
)

# --- 2.8 ------------------------------------------------------------------------
register("h1_trim", BASE, f"SELECT customer_id, {_trim('full_name')} AS v FROM raw_customers")
register("h2_upper", BASE, "SELECT customer_id, upper(full_name) AS v FROM raw_customers")
register("h3_lower", BASE, "SELECT customer_id, lower(city) AS v FROM raw_customers")
register("h4_left", BASE, f"SELECT customer_id, left({_trim('city')}, 1) AS v FROM raw_customers")
register("h5_substring", BASE, f"SELECT customer_id, substring({_trim('city')}, 2) AS v FROM raw_customers")
register(
    "h6_concat", BASE,
    "SELECT installment_id, 'loan ' || CAST(loan_id AS VARCHAR) || ' / ' "
    "|| CAST(installment_number AS VARCHAR) AS v FROM stg_installments",
)
register(
    "h7_capitalize_first", BASE,
    f"SELECT customer_id, upper(left({_trim('city')}, 1)) || lower(substring({_trim('city')}, 2)) AS v "
    "FROM raw_customers",
)
register("h8_coalesce", MARTS,
         "SELECT installment_id, coalesce(last_payment_date, due_date) AS v FROM dm_cartera")
register("h9_nullif", BASE,
         f"SELECT payment_id, nullif({_trim('payment_channel')}, '') AS v FROM raw_payments")
register("h10_round", BASE,
         "SELECT loan_id, CAST(round(annual_rate * 100, 2) AS DECIMAL(9,2)) AS v FROM stg_loans")
register("h11_greatest", MARTS,
         f"SELECT installment_id, CAST(greatest(total_due - total_paid, 0) AS {M38}) AS v FROM dm_cartera")
register(
    "h12_arithmetic", BASE,
    """SELECT installment_id,
              CAST(principal_due + interest_due AS DECIMAL(19,2)) AS plus,
              CAST(principal_due - interest_due AS DECIMAL(19,2)) AS minus,
              CAST(interest_due * 2 AS DECIMAL(19,2)) AS times,
              CAST(principal_due AS DOUBLE) / 4.0 AS divided
       FROM raw_installments""",
)
register("h13_date_trunc_month", BASE,
         "SELECT loan_id, CAST(date_trunc('month', origination_date) AS DATE) AS v FROM raw_loans")
register("h14_format_date", BASE,
         "SELECT loan_id, strftime(origination_date, '%Y-%m') AS v FROM raw_loans")
register("h15_date_diff", BASE,
         f"SELECT installment_id, date_diff('day', due_date, {D}) AS v FROM raw_installments")
register("h16_date_literal", BASE,
         f"SELECT installment_status, count(*) AS rows FROM raw_installments WHERE due_date < {D} "
         "GROUP BY installment_status")
register("h17_current_timestamp", BASE,
         "SELECT customer_id, TRUE AS has_load_time, TRUE AS within_run FROM stg_customers")
register(
    "h18_date_comparison", BASE,
    """SELECT p.payment_id, p.payment_date > i.due_date AS paid_late FROM stg_payments p
       JOIN (SELECT installment_id, max(due_date) AS due_date FROM stg_installments
             WHERE installment_id IS NOT NULL GROUP BY installment_id) i
         ON p.installment_id = i.installment_id""",
)

# --- 2.11 controls ------------------------------------------------------------------


def _ctrl(cid: str, table: str, control: str, severity: str, failed: str, total: str, src: str) -> str:
    return f"""SELECT '{cid}' AS control_id, '{table}' AS table_name, '{control}' AS control,
                      '{severity}' AS severity, CAST({failed} AS BIGINT) AS failed,
                      CAST({total} AS BIGINT) AS total FROM {src}"""


def _with_status(sql: str) -> str:
    return f"""SELECT control_id, table_name, control, severity, failed, total,
                      CASE WHEN failed = 0 THEN 'PASS' WHEN severity = 'warning' THEN 'WARN'
                           ELSE 'FAIL' END AS status
               FROM ({sql})"""


C01 = _ctrl(
    "C01", "customers", "required fields not null", "critical",
    "count(CASE WHEN customer_id IS NULL OR full_name IS NULL OR city IS NULL OR segment IS NULL "
    "OR monthly_income IS NULL THEN 1 END)", "count(*)", "raw_customers",
)
C02 = _ctrl(
    "C02", "customers", "customer_id unique", "critical",
    "sum(CASE WHEN customer_id IS NOT NULL AND copies > 1 THEN copies ELSE 0 END)", "sum(copies)",
    "(SELECT customer_id, count(*) AS copies FROM raw_customers GROUP BY customer_id)",
)
LOANS_J = """(SELECT l.*, k.customer_id IS NOT NULL AS has_customer FROM raw_loans l
              LEFT JOIN (SELECT DISTINCT customer_id FROM raw_customers WHERE customer_id IS NOT NULL) k
                ON l.customer_id = k.customer_id)"""
C03 = _ctrl("C03", "loans", "customer_id exists in customers", "critical",
            "count(CASE WHEN NOT has_customer THEN 1 END)", "count(*)", LOANS_J)
C04 = _ctrl("C04", "loans", "principal_amount > 0", "critical",
            "count(CASE WHEN principal_amount IS NULL OR principal_amount <= 0 THEN 1 END)", "count(*)",
            LOANS_J)
INST_J = """(SELECT i.installment_number, t.loan_id AS t_loan, t.term_months FROM raw_installments i
             LEFT JOIN (SELECT loan_id, max(term_months) AS term_months FROM raw_loans
                        WHERE loan_id IS NOT NULL GROUP BY loan_id) t ON i.loan_id = t.loan_id)"""
C05 = _ctrl("C05", "installments", "loan_id exists in loans", "critical",
            "count(CASE WHEN t_loan IS NULL THEN 1 END)", "count(*)", INST_J)
C06 = _ctrl("C06", "installments", "installment_number within term", "warning",
            "count(CASE WHEN installment_number > term_months THEN 1 END)", "count(*)", INST_J)
PAY_J = """(SELECT p.*, i.installment_id AS i_id, i.loan_id AS i_loan FROM raw_payments p
            LEFT JOIN (SELECT installment_id, max(loan_id) AS loan_id FROM raw_installments
                       WHERE installment_id IS NOT NULL GROUP BY installment_id) i
              ON p.installment_id = i.installment_id)"""
_ST = f"upper({_trim('payment_status')})"
C07 = _ctrl("C07", "payments", "payment_status in known domain", "warning",
            f"count(CASE WHEN coalesce({_ST} NOT IN ('CONFIRMED','REVERSED','PENDING'), TRUE) THEN 1 END)",
            "count(*)", PAY_J)
C08 = _ctrl("C08", "payments", "confirmed payment_amount > 0", "warning",
            f"count(CASE WHEN {_ST} = 'CONFIRMED' AND (payment_amount IS NULL OR payment_amount <= 0) "
            "THEN 1 END)", "count(*)", PAY_J)
C09 = _ctrl("C09", "payments", "payment_channel not null", "warning",
            f"count(CASE WHEN nullif({_trim('payment_channel')}, '') IS NULL THEN 1 END)", "count(*)", PAY_J)
C10 = _ctrl("C10", "payments", "installment_id exists in installments", "warning",
            "count(CASE WHEN i_id IS NULL THEN 1 END)", "count(*)", PAY_J)
C11 = _ctrl("C11", "payments", "loan_id equals installment loan", "warning",
            "count(CASE WHEN i_loan <> loan_id THEN 1 END)", "count(*)", PAY_J)
C13 = _ctrl(
    "C13", "dm_cartera", "installment_id unique", "critical",
    "sum(CASE WHEN installment_id IS NOT NULL AND copies > 1 THEN copies ELSE 0 END)", "sum(copies)",
    "(SELECT installment_id, count(*) AS copies FROM dm_cartera GROUP BY installment_id)",
)


def _rate(table: str) -> str:
    return f"""SELECT 'C12' AS control_id, 'stg_{table}' AS table_name, 'validity rate >= 85%' AS control,
                      'critical' AS severity,
                      CAST(count(CASE WHEN NOT is_valid THEN 1 END) AS BIGINT) AS failed,
                      CAST(count(*) AS BIGINT) AS total FROM stg_{table}"""


C15 = _ctrl("C15", "loans", "loan_status in known domain", "warning",
            f"count(*) FILTER (upper({_trim('loan_status')}) NOT IN ('ACTIVE','CLOSED','DEFAULT'))",
            "count(*)", "raw_loans")

RATES = " UNION ALL ".join(_rate(t) for t in ("customers", "loans", "installments", "payments"))
REJECTED = _ctrl("C14", "stg_payments", "rejected rate <= 2%", "warning",
                 "count(*) FILTER (NOT is_valid)", "count(*)", "stg_payments")
VALIDITY = f"""SELECT control_id, table_name, control, severity, failed, total,
       CASE WHEN total = 0 THEN 'PASS'
            WHEN control_id = 'C12' AND 1.0 - CAST(failed AS DOUBLE) / total < 0.85 THEN 'FAIL'
            WHEN control_id = 'C14' AND CAST(failed AS DOUBLE) / total > 0.02 THEN 'WARN'
            ELSE 'PASS' END AS status
  FROM ({RATES} UNION ALL {REJECTED})"""

register("k4_required_not_null", BASE, _with_status(C01))
register("k5_unique_key", BASE, _with_status(C02))
register(
    "k5_duplicated_keys", BASE,
    """SELECT loan_id, count(*) AS copies FROM raw_installments
       WHERE loan_id IS NOT NULL GROUP BY loan_id HAVING count(*) > 1""",
)
register("k6_foreign_key", BASE, _with_status(C03))
register("k7_positive_amount", BASE, _with_status(C08))
register("k8_number_within_term", BASE, _with_status(C06))
register("k9_known_status", BASE, _with_status(C07))
register(
    "k9_unknown_values", BASE,
    f"""SELECT upper({_trim('segment')}) AS value, count(*) AS rows FROM raw_customers
        WHERE coalesce(upper({_trim('segment')}) NOT IN ('BUILDING','MACHINERY','AUTOMOBILE','HOUSEHOLD'), TRUE)
        GROUP BY 1""",
)
register("k10_channel_not_null", BASE, _with_status(C09))
register("k11_loan_consistency", BASE, _with_status(C11))
register("k9_known_loan_status", BASE, _with_status(C15))
register(
    "k9_unknown_loan_status", BASE,
    """SELECT loan_status AS value, count(*) AS rows FROM raw_loans
       WHERE loan_status IS NULL OR loan_status NOT IN ('ACTIVE', 'CLOSED', 'DEFAULT') GROUP BY loan_status""",
)
register("k12_validity_rate", BASE, VALIDITY)
register(
    "k13_control_report", MARTS,
    " UNION ALL ".join(_with_status(c) for c in (C01, C02, C03, C04, C05, C06, C07, C08, C09, C10, C11, C15))
    + f" UNION ALL {VALIDITY} UNION ALL {_with_status(C13)}",
)
register(
    "k14_reject_breakdown", BASE,
    f"""SELECT quality_issue, count(*) AS rows, CAST(sum(payment_amount) AS {M38}) AS amount
        FROM stg_payments WHERE is_valid = FALSE GROUP BY quality_issue""",
)
register(
    "k14_reject_classes", BASE,
    f"""SELECT c AS reason_class, count(*) AS rows, CAST(sum(payment_amount) AS {M38}) AS amount
        FROM stg_payments
        JOIN (VALUES ('Pago revertido'), ('Pago pendiente de confirmación'), ('Monto cero o negativo'),
                     ('installment_id no existe'), ('loan_id del pago')) k(c)
          ON starts_with(quality_issue, c)
        WHERE NOT is_valid GROUP BY c""",
)
register(
    "k15_mart_statistics", MARTS + (RESUMEN,),
    f"""SELECT 'valid_customers' AS metric,
               CAST(count(CASE WHEN is_valid THEN 1 END) AS {M38}) AS value FROM stg_customers
        UNION ALL SELECT 'valid_loans', CAST(count(CASE WHEN is_valid THEN 1 END) AS {M38}) FROM stg_loans
        UNION ALL SELECT 'disbursed', CAST(sum(CASE WHEN is_valid THEN principal_amount END) AS {M38})
                  FROM stg_loans
        UNION ALL SELECT 'valid_payments', CAST(count(CASE WHEN is_valid THEN 1 END) AS {M38}) FROM stg_payments
        UNION ALL SELECT 'rejected_payments', CAST(count(CASE WHEN NOT is_valid THEN 1 END) AS {M38})
                  FROM stg_payments
        UNION ALL SELECT 'mart_installments', CAST(count(*) AS {M38}) FROM dm_cartera
        UNION ALL SELECT 'programmed', CAST(sum(total_due) AS {M38}) FROM dm_cartera
        UNION ALL SELECT 'collected', CAST(sum(total_paid) AS {M38}) FROM dm_cartera
        UNION ALL SELECT 'balance', CAST(sum(balance_due) AS {M38}) FROM dm_cartera
        UNION ALL SELECT 'arrears', CAST(sum(CASE WHEN is_overdue THEN balance_due ELSE 0 END) AS {M38})
                  FROM dm_cartera
        UNION ALL SELECT 'loans_with_late_installment',
                  CAST(count(DISTINCT CASE WHEN installment_status = 'LATE' THEN loan_id END) AS {M38})
                  FROM dm_cartera
        UNION ALL SELECT 'loans_in_arrears', CAST(count(CASE WHEN saldo_mora > 0 THEN 1 END) AS {M38})
                  FROM dm_resumen_credito""",
)

# --- 2.11 incremental ----------------------------------------------------------------
register("k1_incremental_payments", BASE, f"SELECT * FROM raw_payments WHERE loaded_at > {PAY_MARK}")
register(
    "k1_watermark_payments", BASE,
    f"""SELECT {PAY_MARK} AS old_mark, count(*) AS new_rows, coalesce(max(loaded_at), {PAY_MARK}) AS new_mark
        FROM raw_payments WHERE loaded_at > {PAY_MARK}""",
)
register("k1_incremental_events", BASE, f"SELECT * FROM events WHERE ts > {EV_MARK}")
register(
    "k1_watermark_events", BASE,
    f"""SELECT {EV_MARK} AS old_mark, count(*) AS new_rows, coalesce(max(ts), {EV_MARK}) AS new_mark
        FROM events WHERE ts > {EV_MARK}""",
)


def _latest(src: str, key: str, order: str, where: str) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (
                  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
                  FROM {src} WHERE {key} IS NOT NULL AND {where}) WHERE rn = 1)"""


def _upsert(src: str, key: str, order: str, ts: str, mark: str, cols: list[str]) -> str:
    t = _latest(src, key, order, f"{ts} <= {mark}")
    s = _latest(src, key, order, f"{ts} > {mark}")
    sel = ", ".join(
        f"coalesce(s.{key}, t.{key}) AS {c}" if c == key
        else f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
        for c in cols
    )
    return f"SELECT {sel} FROM {t} t FULL OUTER JOIN {s} s ON t.{key} = s.{key}"


register(
    "k2_upsert_events", BASE,
    _upsert("events", "user_id", "ts DESC, event_id DESC", "ts", EV_MARK,
            ["event_id", "ts", "user_id", "event_type", "value", "props"]),
)
register(
    "k2_upsert_payments", BASE,
    _upsert("raw_payments", "payment_id", "loaded_at DESC", "loaded_at", PAY_MARK,
            ["payment_id", "loan_id", "installment_id", "payment_date", "payment_amount",
             "payment_channel", "payment_status", "loaded_at"]),
)
register(
    "k2_bucketed_upsert", BASE,
    _upsert("raw_payments", "payment_id", "loaded_at DESC", "loaded_at", PAY_MARK,
            ["payment_id", "loan_id", "installment_id", "payment_date", "payment_amount",
             "payment_channel", "payment_status", "loaded_at"]),
)
register(
    "k5_displaced_copies", BASE,
    """SELECT event_id, user_id, chosen_event_id, 'another row was chosen for its key' AS reason,
         CAST(1 AS BIGINT) AS copies
       FROM (SELECT event_id, user_id, row_number() OVER w AS place, first_value(event_id) OVER w AS chosen_event_id
             FROM events WHERE user_id IS NOT NULL
             WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC))
       WHERE place > 1""",
)
register(
    "k3_touched_partitions", MARTS,
    f"""SELECT DISTINCT cohort_month FROM dm_cartera
        WHERE loan_id IN (SELECT loan_id FROM raw_payments WHERE loaded_at > {PAY_MARK})""",
)
register("k3_rebuilt_mart", MARTS, "SELECT * FROM dm_cartera")
