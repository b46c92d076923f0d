"""Marts (A6, A7): the installment-level portfolio as of a date and the
loan-level summary.

Plan shape: valid payments are aggregated per installment *before* any join
(the optimizer will not do this for us, and it also prevents fan-out), and the
customer and loan sides are reduced to one row per key. Over staging,
installments join the payment totals on ``installment_id`` and then the loans on
``loan_id``, so the loan summary needs no further shuffle; from the inputs they
join the loans first, which also gives the term for the anomaly test, and are left
by installment or by loan.

The mart is made in two steps. ``cartera_facts`` holds what doesn't depend on the
analysis date and can be stored by cohort; ``as_of`` adds the ageing columns on
read, so every row carries one date whenever its cohort was written (K3).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake import constants as K
from lendlake.functions.banding import ageing_bucket, loan_health
from lendlake.operators.keys import one_per_key

MART_COLUMNS = [
    "loan_id", "customer_id", "full_name", "city", "segment", "product_type",
    "origination_date", "cohort_month", "loan_principal", "annual_rate", "monthly_rate",
    "term_months", "loan_status", "installment_id", "installment_number", "due_date",
    "principal_due", "interest_due", "total_due", "installment_status", "total_paid",
    "last_payment_date", "num_payments", "balance_due", "is_overdue", "days_overdue",
    "mora_bucket", "analysis_date",
]

#: What depends on the analysis date.
AS_OF_COLUMNS = ["is_overdue", "days_overdue", "mora_bucket", "analysis_date"]
FACT_COLUMNS = [c for c in MART_COLUMNS if c not in AS_OF_COLUMNS]

SUMMARY_KEYS = [
    "loan_id", "customer_id", "full_name", "city", "segment", "product_type",
    "origination_date", "cohort_month", "loan_principal", "annual_rate", "term_months",
    "loan_status",
]

LOAN_ATTRIBUTES = [
    "customer_id", "product_type", "origination_date", "cohort_month", "principal_amount",
    "annual_rate", "monthly_rate", "term_months", "loan_status",
]


def as_date(value: _dt.date | str | None) -> _dt.date:
    """Run parameter (B8): a date, ISO text, or None for today (UTC, as the sessions)."""
    if value is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def payments_per_installment(payments: DataFrame) -> DataFrame:
    """Valid payments summed per installment (D7's pre-aggregated side)."""
    return (
        payments.where("is_valid")
        .groupBy("installment_id")
        .agg(
            F.sum("payment_amount").cast(K.MONEY_SUM).alias("total_paid"),
            F.max("payment_date").alias("last_payment_date"),
            F.count(F.lit(1)).alias("num_payments"),
        )
    )


def enriched_loans(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Valid loans with the attributes of their valid customer."""
    cust = one_per_key(customers.where("is_valid"), "customer_id", ["full_name", "city", "segment"])
    lo = one_per_key(loans.where("is_valid"), "loan_id", LOAN_ATTRIBUTES)
    return lo.join(cust, "customer_id", "inner")


def overdue_flags(status: Column, due: Column, as_of: Column) -> tuple[Column, Column, Column]:
    """(is_overdue, days_overdue, mora_bucket) of one installment."""
    days = F.datediff(as_of, due).cast("bigint")
    overdue_cond = (status == "LATE") | ((due < as_of) & (status != "PAID"))
    is_overdue = (
        F.when(status == "LATE", True).when((due < as_of) & (status != "PAID"), True).otherwise(False)
    )
    days_overdue = F.when(overdue_cond, days).otherwise(F.lit(0).cast("bigint"))
    return is_overdue, days_overdue, ageing_bucket(status, due, as_of, days)


def cartera_facts(
    customers: DataFrame,
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """One row per valid, normal installment of a valid loan with what was paid."""
    return facts_with_totals(customers, loans, installments, payments_per_installment(payments))


def facts_with_totals(
    customers: DataFrame, loans: DataFrame, installments: DataFrame, paid: DataFrame
) -> DataFrame:
    """The facts from payments that are already summed per installment."""
    j = normal_installments(installments).join(paid, "installment_id", "left").join(
        enriched_loans(loans, customers), "loan_id", "inner"
    )
    return _fact_columns(j)


def normal_installments(installments: DataFrame) -> DataFrame:
    return installments.where("is_valid AND NOT is_anomalous").select(
        "installment_id", "loan_id", "installment_number", "due_date", "principal_due",
        "interest_due", "total_due", "installment_status",
    )


def as_of(facts: DataFrame, analysis_date: _dt.date | str | None = None) -> DataFrame:
    """A6 from its facts: the ageing columns as of a date."""
    day = F.lit(as_date(analysis_date))
    flags = overdue_flags(F.col("installment_status"), F.col("due_date"), day)
    aged = dict(zip(AS_OF_COLUMNS, [*flags, day]))
    return facts.select(*[aged[c].alias(c) if c in aged else F.col(c) for c in MART_COLUMNS])


def dm_cartera(
    customers: DataFrame,
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
    analysis_date: _dt.date | str | None = None,
) -> DataFrame:
    """One row per valid, normal installment of a valid loan, as of a date."""
    return as_of(cartera_facts(customers, loans, installments, payments), analysis_date)


#: Ending of the columns that hold what the payments after a mark add.
LATER = "_later"
#: Totals of all payments: no condition, no ending.
ALL_PAYMENTS: dict[str, Column | None] = {"": None}


def _plus(a: str, b: str) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


class InputParts:
    """Building blocks of the single-pass plans over the canonical inputs.

    Every table is filtered by its own row rules; each "parent exists and is
    valid" rule becomes the inner join the plan needs anyway, so no staging
    table is re-derived in several branches of one plan.
    """

    def __init__(self, customers, loans, installments, payments, segments=K.SEGMENTS):
        from lendlake.operators import staging as S

        self.customers = one_per_key(
            customers.where(S.passes(S.customer_rules(segments))).select(*S.customer_columns()),
            "customer_id",
            ["full_name", "city", "segment"],
        )
        # Valid loans of valid customers, with the customer's attributes; one
        # row per loan is chosen among these only, so a copy that points at an
        # unknown customer can't displace a valid one.
        valid = loans.where(S.passes(S.loan_rules(F.lit(False)))).select(*S.loan_columns())
        self.loans = one_per_key(
            valid.join(self.customers, "customer_id", "inner"),
            "loan_id",
            [*LOAN_ATTRIBUTES, "full_name", "city", "segment"],
        )
        # Installments passing their own rules (parent and term tested at the join).
        self.installments = installments.where(
            S.passes(S.installment_rules(F.lit(False)))
        ).select(*S.installment_columns())
        self.payments = payments.where(S.passes(S.payment_own_failures())).select(
            *S.payment_columns()
        )
        self.beyond_term = S.beyond_term

    def normal_installments(self) -> DataFrame:
        """Valid, normal installments of valid loans, with loan attributes."""
        return self.installments.join(self.loans, "loan_id", "inner").where(
            ~self.beyond_term(F.col("installment_number"), F.col("term_months"))
        )

    def paid_per_installment(self, normal: DataFrame) -> DataFrame:
        """Valid payments summed per installment: summed per (installment,
        loan) first, so a hot installment meets the join as a few rows, then
        matched to the loan of the valid, normal installment (the same rule as
        in staging, whatever copies the raw table holds)."""
        per_loan = self._paid("installment_id", "loan_id")
        # The due date comes along so that this branch reads the installments with
        # the columns of the mart's own branch, and their shuffle is shared.
        chosen = one_per_key(normal, "installment_id", ["loan_id", "due_date"])
        inst_loan = chosen.select("installment_id", "loan_id")
        return (
            per_loan.join(inst_loan.withColumnRenamed("loan_id", "_inst_loan"), "installment_id", "inner")
            .where(F.col("loan_id").isNull() | (F.col("loan_id") == F.col("_inst_loan")))
            .groupBy("installment_id")
            .agg(
                F.sum("_paid").cast(K.MONEY_SUM).alias("total_paid"),
                F.max("_last").alias("last_payment_date"),
                F.sum("_n").alias("num_payments"),
            )
        )

    def _paid(
        self, *keys: str, payments: DataFrame | None = None, states: dict[str, Column | None] = ALL_PAYMENTS
    ) -> DataFrame:
        def of(state: Column | None, value: Column) -> Column:
            return value if state is None else F.when(state, value)

        return (self.payments if payments is None else payments).groupBy(*keys).agg(*[
            total
            for end, state in states.items()
            for total in (
                F.sum(of(state, F.col("payment_amount"))).cast(K.MONEY_SUM).alias(f"_paid{end}"),
                F.max(of(state, F.col("payment_date"))).alias(f"_last{end}"),
                F.count(of(state, F.lit(1))).alias(f"_n{end}"),
            )
        ])

    def paid_installments(self, until: Column | None = None) -> DataFrame:
        """Valid, normal installments of valid loans with what was paid, dealt by loan.

        They move by installment with no more than their own columns: the total is
        derived, and the loan's attributes are joined, after the last move. The loan
        that payments of an installment must name is found among its copies by a window
        over the rows the payments are joined to; those that name it and those that
        name none are summed and joined apart, so each row meets at most one of either.

        With ``until``, a condition on payments, the totals are of those that meet it,
        and columns ending in ``LATER`` hold what the others add.
        """
        states = ALL_PAYMENTS
        if until is not None:
            met = F.coalesce(until, F.lit(False))
            states = {"": met, LATER: ~met}
        terms = self.loans.select("loan_id", "term_months")
        normal = self.installments.drop("total_due").join(terms, "loan_id", "inner").where(
            ~self.beyond_term(F.col("installment_number"), F.col("term_months"))
        ).drop("term_months")
        copies = Window.partitionBy("installment_id")
        inst = normal.withColumn("_inst_loan", F.max("loan_id").over(copies))
        named = self._paid(
            "installment_id", "loan_id", payments=self.payments.where(F.col("loan_id").isNotNull()), states=states
        ).withColumnsRenamed({"installment_id": "_inst_id", "loan_id": "_pay_loan"})
        unnamed = self._paid(
            "installment_id", payments=self.payments.where(F.col("loan_id").isNull()), states=states
        ).withColumnsRenamed({f"{c}{end}": f"{c}{end}_0" for c in ("_paid", "_last", "_n") for end in states})
        # Two inequalities stay a condition of the join; as a join key the loan would
        # move the installments once more.
        same_loan = F.col("_pay_loan").between(F.col("_inst_loan"), F.col("_inst_loan"))
        j = inst.join(named, (F.col("installment_id") == F.col("_inst_id")) & same_loan, "left")
        j = j.join(unnamed, "installment_id", "left")
        totals = [
            total
            for end in states
            for total in (
                _plus(f"_paid{end}", f"_paid{end}_0").cast(K.MONEY_SUM).alias(f"total_paid{end}"),
                F.greatest(f"_last{end}", f"_last{end}_0").alias(f"last_payment_date{end}"),
                _plus(f"_n{end}", f"_n{end}_0").alias(f"num_payments{end}"),
            )
        ]
        paid = j.select(*normal.columns, *totals)
        return paid.join(self.loans, "loan_id", "inner")


def dm_cartera_from_inputs(
    customers: DataFrame,
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
    analysis_date: _dt.date | str | None = None,
    segments=K.SEGMENTS,
) -> DataFrame:
    """A6 straight from the canonical raw inputs.

    Same rows as ``dm_cartera`` over the staging layer, without building the
    staging tables: installments join their valid loans (which also gives the
    term for the anomaly test), then their payment totals. The rows lie by
    installment, and a reader of no paid amounts joins no payments.
    """
    parts = InputParts(customers, loans, installments, payments, segments)
    normal = parts.normal_installments()
    j = normal.join(parts.paid_per_installment(normal), "installment_id", "left")
    return as_of(_fact_columns(j), analysis_date)


def dm_cartera_by_loan(
    customers: DataFrame,
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
    analysis_date: _dt.date | str | None = None,
    segments=K.SEGMENTS,
    order: Sequence[Column] = (),
) -> DataFrame:
    """The same rows for readers of the whole mart, in fewer bytes moved: they lie by
    loan, so the loan summary needs no further shuffle. With an ``order`` of the loan's
    and installment's own columns they are sorted before anything is derived from them.
    """
    from lendlake.operators.staging import total_due

    j = InputParts(customers, loans, installments, payments, segments).paid_installments()
    if order:
        j = j.orderBy(*order)
    return as_of(_fact_columns(j.withColumn("total_due", total_due())), analysis_date)


def cartera_in_two_states(
    customers: DataFrame,
    loans: DataFrame,
    installments: DataFrame,
    payments: DataFrame,
    until: Column,
    segments=K.SEGMENTS,
) -> DataFrame:
    """What the facts of two marts are made from, in one pass over the inputs: the mart
    of the payments that meet ``until`` and that of all payments. Both have the same
    installments and loans, so their rows are moved and stored once, each with its
    totals up to the mark and, apart, what later payments add. ``facts_until`` and
    ``facts_of_all`` read the marts' facts off these rows, derived columns included.
    """
    return InputParts(customers, loans, installments, payments, segments).paid_installments(until)


def facts_until(states: DataFrame) -> DataFrame:
    """The facts from the payments up to the mark of ``cartera_in_two_states``."""
    from lendlake.operators.staging import total_due

    return _fact_columns(states.withColumn("total_due", total_due()))


def facts_of_all(states: DataFrame) -> DataFrame:
    """The facts from all payments of ``cartera_in_two_states``."""
    return facts_until(states.withColumns({
        "total_paid": _plus("total_paid", f"total_paid{LATER}").cast(K.MONEY_SUM),
        "last_payment_date": F.greatest("last_payment_date", f"last_payment_date{LATER}"),
        "num_payments": _plus("num_payments", f"num_payments{LATER}"),
    }))


def _fact_columns(j: DataFrame) -> DataFrame:
    total_paid = F.coalesce(F.col("total_paid"), F.lit(0)).cast(K.MONEY_SUM)
    made = {
        "loan_principal": F.col("principal_amount"),
        "total_paid": total_paid,
        "num_payments": F.coalesce(F.col("num_payments"), F.lit(0)),
        "balance_due": F.greatest(F.col("total_due") - total_paid, F.lit(0)).cast(K.MONEY_SUM),
    }
    return j.select(*[made.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS])


def arrears_sums(status: Column, is_overdue: Column, balance: Column) -> tuple[Column, Column]:
    """(saldo_mora, saldo_vigente) aggregates: overdue balance and current
    balance of installments not yet paid (E7)."""
    zero = F.lit(0)
    mora = F.sum(F.when(is_overdue, balance).otherwise(zero)).cast(K.MONEY_SUM)
    vigente = F.sum(
        F.when(~is_overdue & (status != "PAID"), balance).otherwise(zero)
    ).cast(K.MONEY_SUM)
    return mora, vigente


def dm_resumen_credito(mart: DataFrame) -> DataFrame:
    """One row per loan with totals, arrears, worst delay and health."""
    mora, vigente = arrears_sums(
        F.col("installment_status"), F.col("is_overdue"), F.col("balance_due")
    )
    g = mart.groupBy(*SUMMARY_KEYS, "analysis_date").agg(
        F.count("installment_id").alias("num_installments"),
        F.sum("total_due").cast(K.MONEY_SUM).alias("total_programmed"),
        F.sum("total_paid").cast(K.MONEY_SUM).alias("total_paid"),
        F.sum("balance_due").cast(K.MONEY_SUM).alias("total_balance_due"),
        mora.alias("saldo_mora"),
        vigente.alias("saldo_vigente"),
        F.max("days_overdue").alias("max_days_overdue"),
    )
    return g.select(
        *SUMMARY_KEYS,
        "num_installments", "total_programmed", "total_paid", "total_balance_due",
        "saldo_mora", "saldo_vigente", "max_days_overdue",
        loan_health(F.col("max_days_overdue")).alias("loan_health"),
        "analysis_date",
    )
