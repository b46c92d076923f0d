"""One incremental run as a transaction.

A run reads the payments loaded after the mark of the last release, merges them
into the stored payments, rebuilds the cohorts of the mart that anything touched,
checks the result, and appends a release. All of it becomes visible with that last
step, the mark included: a run that is killed before it leaves the release before in
place, and the next run starts from there.

* Customers, loans and installments carry no load time, so their staging is
  written anew. Rows and failures are counted while they are written
  (``Observation``); the controls take these counts and don't scan again.
* Payments lie in buckets by a hash of payment_id. A run stages the buckets that
  hold a new payment, or a payment whose installment changed its loan or validity; the
  others' files are taken over.
* The mart is stored as facts by cohort, free of the analysis date. A cohort is
  rebuilt if one of its installments got other valid payments, or if the print of its
  installments, loans and customers changed (a sum of row hashes, so any order gives
  the same). Ageing is added on read, with the release's date in every row.
* A failed critical control holds the release back (``PublicationBlocked``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lendlake.operators import incremental as inc
from lendlake.operators import marts, staging, views
from lendlake.operators import quality as qc
from lendlake.operators.keys import one_per_key
from lendlake.operators.ranking import store_ranked
from lendlake.plans.catalog import with_load_time
from lendlake.plans.layers import Settings
from lendlake.plans.warehouse import Release, Warehouse
from lendlake.sources.raw import RawInputs
from lendlake.streaming.upserts import BUCKET, BUCKETS, in_buckets, touched_buckets

STAGE_LOAD, MART_LOAD = "_stg_loaded_at", "_loaded_at"
RAW_PAYMENT = [
    "payment_id", "loan_id", "installment_id", "payment_date", "payment_amount", "payment_channel",
    "payment_status", "loaded_at",
]
COHORT = "cohort_month"
_NULL = "__HIVE_DEFAULT_PARTITION__"


class PublicationBlocked(RuntimeError):
    """A critical control failed; ``failed`` holds its report rows."""

    def __init__(self, failed: list):
        super().__init__("; ".join(f"{r['control_id']} {r['table_name']}: {r['failed']} of {r['total']}" for r in failed))
        self.failed = failed


def _folder(cohort: _dt.date | None) -> str:
    return f"{COHORT}={_NULL if cohort is None else cohort.isoformat()}"


class Run:
    """The steps of one run, in order; ``refresh`` calls them all."""

    def __init__(
        self, spark: SparkSession, raw: RawInputs, lake: Warehouse, settings: Settings, full: bool, buckets: int
    ):
        self.spark, self.raw, self.lake, self.settings = spark, raw, lake, settings
        self.day = marts.as_date(settings.analysis_date)
        self.last = lake.release()
        self.before: Release | None = None if full else self.last
        self.buckets = buckets
        self.versions: dict[str, int] = {}
        self.counts: dict[str, tuple[int, int]] = {}  # failed, total of each staging table
        self.new_payments = 0
        self.mark: str | None = self.before.mark if self.before else None

    # Reading and writing

    def current(self, name: str) -> DataFrame:
        """The table as this run wrote it, without columns of the storage and load time."""
        df = self.lake.table(name).read(self.versions[name])
        return df.drop(BUCKET, STAGE_LOAD, MART_LOAD)

    def old(self, name: str, parts: list[str] | None = None) -> DataFrame:
        df = self.lake.table(name).read(self.before.tables[name], parts)
        return df.drop(BUCKET, STAGE_LOAD, MART_LOAD)

    def store(self, name: str, df: DataFrame, load: str = MART_LOAD) -> DataFrame:
        self.versions[name] = self.lake.table(name).replace(with_load_time(df, load))
        return self.current(name)

    def store_staging(self, name: str, df: DataFrame) -> DataFrame:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("total"), qc.count_if(~F.col("is_valid")).alias("failed"))
        stored = self.store(name, counted, STAGE_LOAD)
        self.counts[name] = (seen.get["failed"], seen.get["total"])
        return stored

    # Steps

    def parents(self) -> None:
        customers = self.store_staging("stg_customers", staging.stg_customers(self.raw.customers, self.settings.segments))
        loans = self.store_staging("stg_loans", staging.stg_loans(self.raw.loans, customers))
        self.store_staging("stg_installments", staging.stg_installments(self.raw.installments, loans))

    def increment(self) -> DataFrame:
        """The raw payments after the mark, up to the newest one there is now, so rows
        that arrive meanwhile wait for the next run."""
        payments = self.raw.payments.select(*RAW_PAYMENT)
        if self.mark is None:
            row = payments.agg(F.count(F.lit(1)).alias("new_rows"), F.max("loaded_at").alias("new_mark")).first()
            until = F.lit(True) if row["new_mark"] is None else (
                F.col("loaded_at").isNull() | (F.col("loaded_at") <= inc.as_mark(row["new_mark"]))
            )
        else:
            row = inc.advance_mark(payments, "loaded_at", self.mark).first()
            until = F.col("loaded_at") <= inc.as_mark(row["new_mark"])
            payments = inc.new_rows(payments, "loaded_at", self.mark)
        self.new_payments = row["new_rows"]
        self.mark = None if row["new_mark"] is None else row["new_mark"].isoformat(sep=" ")
        return payments.where(until)

    def payments(self, new: DataFrame) -> DataFrame | None:
        """Stage what the increment and changed installments touch; the installments
        whose valid payments changed (None: all)."""
        table = self.lake.table("stg_payments")
        installments = self.current("stg_installments")
        if self.before is None:
            merged = inc.upsert(new.limit(0), new, "payment_id", ["loaded_at"])
            staged = in_buckets(staging.stg_payments(merged, installments), "payment_id", self.buckets)
            self.versions["stg_payments"] = table.replace(with_load_time(staged, STAGE_LOAD), BUCKET)
            self._count_payments(None)
            return None
        base = self.before.tables["stg_payments"]
        self.buckets = self.before.properties["buckets"]
        touched = set(touched_buckets(new, "payment_id", self.buckets))
        changed = self._changed_installments()
        old = self.old("stg_payments")
        touched |= set(touched_buckets(old.join(changed, "installment_id", "left_semi"), "payment_id", self.buckets))
        before = self.old("stg_payments", sorted(touched))
        merged = inc.upsert(before.select(*RAW_PAYMENT), new, "payment_id", ["loaded_at"])
        staged = in_buckets(staging.stg_payments(merged, installments), "payment_id", self.buckets)
        self.versions["stg_payments"] = table.replace_parts(with_load_time(staged, STAGE_LOAD), touched, base)
        self._count_payments(touched)
        after = table.read(self.versions["stg_payments"], touched)
        paid = ["installment_id", "payment_id", "payment_date", "payment_amount"]
        was, now = (df.where("is_valid").select(*paid) for df in (before, after))
        return was.exceptAll(now).union(now.exceptAll(was)).select("installment_id").distinct()

    def _count_payments(self, touched: set[str] | None) -> None:
        """Counts by bucket, kept in the release: only written buckets are counted."""
        table = self.lake.table("stg_payments")
        counts = {} if touched is None else {
            b: n for b, n in self.before.properties["payment_counts"].items() if b not in touched
        }
        rows = table.read(self.versions["stg_payments"], touched).groupBy(BUCKET).agg(
            qc.count_if(~F.col("is_valid")).alias("failed"), F.count(F.lit(1)).alias("total")
        )
        counts |= {f"{BUCKET}={r[BUCKET]}": [r["failed"], r["total"]] for r in rows.collect()}
        self.payment_counts = counts
        self.counts["stg_payments"] = tuple(sum(c[k] for c in counts.values()) for k in (0, 1))

    def _changed_installments(self) -> DataFrame:
        """Installments that a payment may be matched to otherwise than before."""
        was, now = (
            one_per_key(marts.normal_installments(df), "installment_id", ["loan_id"]).select(
                "installment_id", F.col("loan_id").alias(side), F.lit(True).alias(f"in_{side}")
            )
            for df, side in ((self.old("stg_installments"), "was"), (self.current("stg_installments"), "now"))
        )
        same = F.col("was").eqNullSafe(F.col("now")) & F.col("in_was").eqNullSafe(F.col("in_now"))
        return was.join(now, "installment_id", "full_outer").where(~same).select("installment_id")

    def _parents_of_mart(self) -> DataFrame:
        loans = marts.enriched_loans(self.current("stg_loans"), self.current("stg_customers"))
        return marts.normal_installments(self.current("stg_installments")).join(loans, "loan_id", "inner")

    def facts(self, repaid: DataFrame | None) -> set[str] | None:
        """Rebuild the touched cohorts; their folders (None: all)."""
        whole = self._parents_of_mart()
        prints = whole.groupBy(COHORT).agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.xxhash64(*sorted(whole.columns)).cast("decimal(20,0)")).cast("string").alias("print"),
        )
        table = self.lake.table("cartera_facts")
        self.prints = {_folder(r[COHORT]): [r["rows"], r["print"]] for r in prints.collect()}
        names = ("stg_customers", "stg_loans", "stg_installments", "stg_payments")
        customers, loans, installments, payments = map(self.current, names)
        if repaid is None:
            facts = marts.cartera_facts(customers, loans, installments, payments)
            self.versions["cartera_facts"] = table.replace(with_load_time(facts, MART_LOAD), COHORT)
            return None
        was = self.before.properties["prints"]
        touched = {c for c in was.keys() | self.prints.keys() if was.get(c) != self.prints.get(c)}
        repaid_cohorts = whole.join(repaid, "installment_id", "left_semi").select(COHORT).distinct().collect()
        touched |= {_folder(r[COHORT]) for r in repaid_cohorts}
        days = [c.split("=")[1] for c in touched]
        in_touched = F.col(COHORT).cast("string").isin([d for d in days if d != _NULL])
        if _NULL in days:
            in_touched = in_touched | F.col(COHORT).isNull()
        their_loans = loans.where(in_touched)
        theirs = installments.join(their_loans.select("loan_id").distinct(), "loan_id", "left_semi")
        their_payments = payments.join(theirs.select("installment_id").distinct(), "installment_id", "left_semi")
        # A loan may have copies in other cohorts: it is chosen among all, then filtered.
        facts = marts.cartera_facts(customers, loans, theirs, their_payments).where(in_touched)
        self.versions["cartera_facts"] = table.replace_parts(
            with_load_time(facts, MART_LOAD), touched, self.before.tables["cartera_facts"]
        )
        return touched

    def products(self) -> None:
        """What is read off the facts and staging as of the run's date."""
        names = ("stg_customers", "stg_loans", "stg_installments", "stg_payments")
        customers, loans, installments, payments = map(self.current, names)
        mart = marts.as_of(self.current("cartera_facts"), self.day)
        summary = self.store("dm_resumen_credito", marts.dm_resumen_credito(mart))
        self.store("vw_originacion_diaria", views.vw_originacion_diaria(customers, loans))
        self.store("vw_recaudo_diario", views.vw_recaudo_diario(customers, loans, installments, payments))
        self.store("vw_cartera_cohorte", views.vw_cartera_cohorte(mart))
        in_arrears = summary.where(F.col("saldo_mora") > 0).select(*views.TOP_MORA_COLUMNS)
        self.versions["vw_top_mora"] = store_ranked(in_arrears, views.arrears_order(), self.lake.table("vw_top_mora"))

    def controls(self) -> DataFrame:
        """The control report; the rates come from the counts made while writing."""
        raw = self.raw
        parts = [
            qc.customer_controls(raw.customers),
            qc.loan_controls(raw.loans, raw.customers),
            qc.installment_controls(raw.installments, raw.loans),
            qc.payment_controls(raw.payments, raw.installments),
            qc.rates(self.spark.createDataFrame(
                [(t, *self.counts[t]) for t in sorted(self.counts)], "table_name string, failed long, total long"
            )),
            qc.mart_unique(self.current("cartera_facts")),
        ]
        return self.store("control_report", reduce(DataFrame.unionByName, [p.select(*qc.REPORT_COLUMNS) for p in parts]))

    def publish(self, touched: set[str] | None) -> Release:
        properties = {
            "new_payments": self.new_payments,
            "rebuilt_cohorts": None if touched is None else sorted(touched),
            "buckets": self.buckets,
            "payment_counts": self.payment_counts,
            "prints": self.prints,
        }
        return self.lake.publish(self.last, self.versions, self.day.isoformat(), self.mark, properties)


def refresh(
    spark: SparkSession,
    raw: RawInputs,
    root: str,
    settings: Settings = Settings(),
    full: bool = False,
    gate: bool = True,
    buckets: int = BUCKETS,
    after_step: Callable[[str], None] = lambda step: None,
) -> Release:
    """Run all steps and publish. The first run, or a ``full`` one, takes all
    payments. ``gate=False`` publishes in spite of failed critical controls;
    ``after_step`` is told of each finished step."""
    run = Run(spark, raw, Warehouse(spark, root), settings, full, buckets)
    new = run.increment()
    after_step("increment")
    run.parents()
    after_step("parents")
    repaid = run.payments(new)
    after_step("payments")
    touched = run.facts(repaid)
    after_step("facts")
    run.products()
    after_step("products")
    report = run.controls()
    after_step("controls")
    if gate:
        failed = report.where((F.col("severity") == qc.CRITICAL) & (F.col("status") == "FAIL")).collect()
        if failed:
            raise PublicationBlocked(failed)
    return run.publish(touched)
