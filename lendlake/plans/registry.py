"""

Each entry takes ``(spark, sf_dir)``, reads the test tables under ``sf_dir``
through the adapter and returns a lazy DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lendlake.operators import marts, questions, views
from lendlake.plans.layers import Settings, stage, stored
from lendlake.sources.adapters import TEST_ANALYSIS_DATE, TEST_SEGMENTS, inputs_from_tpch

TEST_SETTINGS = Settings(analysis_date=TEST_ANALYSIS_DATE, segments=TEST_SEGMENTS)

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

_SOURCES: dict[tuple, object] = {}
_CONTEXTS: dict[tuple, "Ctx"] = {}


def _session_key(spark: SparkSession) -> tuple:
    return (spark.sparkContext.applicationId, id(spark._jsparkSession))


def raw_inputs(spark: SparkSession, root: str):
    """The canonical inputs over ``root``, declared once per session: later
    queries reuse the same source plans (nothing is cached but the plan; each
    action reads the files)."""
    key = (*_session_key(spark), root)
    if key not in _SOURCES:
        _SOURCES[key] = inputs_from_tpch(spark, root)
    return _SOURCES[key]


def context(spark: SparkSession, root: str, store_staging: bool = False) -> "Ctx":
    """The layers over ``root`` for this session, declared once and shared by
    all queries, as an application keeps its DataFrames: only lazy plans are
    kept, every action still reads the data. ``forget()`` drops them."""
    key = (*_session_key(spark), root, store_staging)
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Ctx(spark, root, store_staging=store_staging)
    return _CONTEXTS[key]


def forget() -> None:
    """Drop the declared source and layer plans (e.g. after new files land)."""
    _SOURCES.clear()
    _CONTEXTS.clear()


class Ctx:
    """Lazily built layers over one test-data folder."""

    def __init__(
        self, spark: SparkSession, root: str, settings: Settings = TEST_SETTINGS,
        store_staging: bool = False,
    ):
        self.spark = spark
        self.root = root
        self.settings = settings
        self.store_staging = store_staging

    @cached_property
    def raw(self):
        return raw_inputs(self.spark, self.root)

    @cached_property
    def staged(self):
        # Queries that read several staging layers store them once (each layer
        # is then computed a single time); others keep one lazy plan.
        return stage(self.raw, self.settings, persist=stored if self.store_staging else None)

    def _cartera(self, build: Callable[..., DataFrame], **how) -> DataFrame:
        r = self.raw
        return build(
            r.customers, r.loans, r.installments, r.payments,
            self.settings.analysis_date, self.settings.segments, **how,
        )

    @cached_property
    def marts(self):
        from lendlake.plans.layers import Marts

        cartera = self._cartera(marts.dm_cartera_from_inputs)
        return Marts(cartera, marts.dm_resumen_credito(self.mart_by_loan))

    @cached_property
    def mart_by_loan(self) -> DataFrame:
        """The mart for queries that read its paid amounts and need it by loan or in whole."""
        return self._cartera(marts.dm_cartera_by_loan)

    @property
    def mart(self) -> DataFrame:
        return self.marts.cartera

    @property
    def summary(self) -> DataFrame:
        return self.marts.resumen

    @cached_property
    def origination(self) -> DataFrame:
        s = self.staged
        return views.vw_originacion_diaria(s.customers, s.loans)

    @cached_property
    def collections(self) -> DataFrame:
        r = self.raw
        return views.collections_by_day(
            views.collections_from_inputs(
                r.customers, r.loans, r.installments, r.payments, self.settings.segments
            )
        )

    @cached_property
    def bi(self) -> DataFrame:
        return views.vw_bi_completo(self.mart_by_loan)

    @cached_property
    def bi_in_order(self) -> DataFrame:
        """Sorted as q05 wants it while the rows are narrow: their labels, ageing,
        rates and balances are made after the sort."""
        return views.vw_bi_completo(self._cartera(marts.dm_cartera_by_loan, order=questions.bi_order()))


def query(name: str, store_staging: bool = False):
    """Register ``fn(ctx) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Ctx], DataFrame]) -> Callable[[Ctx], DataFrame]:
        REGISTRY[name] = lambda spark, root: fn(context(spark, root, store_staging))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn

    return wrap


# --- 2.1 datasets -----------------------------------------------------------

query("a1_stg_customers")(lambda c: c.staged.customers)
query("a2_stg_loans")(lambda c: c.staged.loans)
query("a3_stg_installments")(lambda c: c.staged.installments)
query("a4_stg_payments")(lambda c: c.staged.payments)
query("a5_payments_rejected")(lambda c: c.staged.rejected_payments)
query("a6_dm_cartera")(lambda c: c.mart_by_loan)
query("a7_dm_resumen_credito")(lambda c: c.summary)
query("a8_vw_originacion_diaria")(lambda c: c.origination)
query("a9_vw_recaudo_diario")(lambda c: c.collections)
query("a10_vw_cartera_cohorte")(lambda c: views.vw_cartera_cohorte(c.mart))
query("a11_vw_top_mora")(lambda c: views.vw_top_mora(c.summary))
query("a12_vw_bi_completo")(lambda c: c.bi)
query("q01a_desembolso_dia")(lambda c: questions.q01a_disbursed_by_day(c.origination))
query("q01b_desembolso_ciudad")(lambda c: questions.q01b_disbursed_by_city(c.origination))
query("q01c_desembolso_segmento")(lambda c: questions.q01c_disbursed_by_segment(c.origination))
query("q01d_desembolso_dia_ciudad_segmento")(
    lambda c: questions.q01d_disbursed_by_day_city_segment(c.origination)
)
query("q02_recaudo_diario")(lambda c: questions.q02_collections_by_day(c.collections))
query("q03_cartera_por_cohorte")(lambda c: questions.q03_cohort_health(c.mart_by_loan))
query("q03_principal_distinct")(lambda c: questions.q03_principal_per_cohort(c.summary))
query("q04_top_atraso")(lambda c: questions.q04_top_arrears(c.summary))
query("q05_dataset_bi")(lambda c: questions.q05_bi_dataset(c.bi_in_order, in_order=True))


def queries() -> dict[str, QueryFn]:
    # Import for the side effect of registering the remaining families.
    from lendlake.plans import registry_more  # noqa: F401

    return dict(REGISTRY)
