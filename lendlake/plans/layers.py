"""The layered build: raw -> staging -> marts -> views, as lazy DataFrames.

``stage`` and ``build_marts`` only declare plans; nothing runs until a sink or
an action. ``plans.materialize`` writes the layers in dependency order.
"""

from __future__ import annotations

import datetime as _dt
import posixpath
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from lendlake import constants as K
from lendlake.operators import marts, staging
from lendlake.session import checkpoint_dir
from lendlake.sources.raw import RawInputs


@dataclass(frozen=True)
class Settings:
    """The run parameters: analysis date (B8) and the accepted segments."""

    analysis_date: _dt.date | str | None = None  # today
    segments: Sequence[str] = field(default=K.SEGMENTS)


class Staged:
    """A1-A5, each built on first use from the layer before it.

    ``persist`` (optional) is applied to the layers that join to their parent
    (loans, installments, payments): every later consumer then reads the
    stored rows instead of re-running the lookup joins in each branch of its
    plan, as the source pipeline does with its staging tables.
    """

    def __init__(
        self,
        raw: RawInputs,
        settings: Settings = Settings(),
        persist: Callable[[str, DataFrame], DataFrame] | None = None,
    ):
        self.raw = raw
        self.settings = settings
        self._persist = persist or (lambda name, df: df)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers, self.settings.segments)

    @cached_property
    def loans(self) -> DataFrame:
        return self._persist("stg_loans", staging.stg_loans(self.raw.loans, self.customers))

    @cached_property
    def installments(self) -> DataFrame:
        return self._persist(
            "stg_installments", staging.stg_installments(self.raw.installments, self.loans)
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self._persist(
            "stg_payments", staging.stg_payments(self.raw.payments, self.installments)
        )

    @property
    def rejected_payments(self) -> DataFrame:
        return staging.payments_rejected(self.payments)


@dataclass(frozen=True)
class Marts:
    cartera: DataFrame
    resumen: DataFrame


def stage(
    raw: RawInputs,
    settings: Settings = Settings(),
    persist: Callable[[str, DataFrame], DataFrame] | None = None,
) -> Staged:
    """A1-A4 in dependency order (each layer reads the one before)."""
    return Staged(raw, settings, persist)


def stored(name: str, df: DataFrame) -> DataFrame:
    """Persist hook: write the layer once as a Parquet table in the shared
    folder (under ``spark.checkpoint.dir``) and read it back. Columnar and
    written in one pass; later plans scan it with pruning and pushed filters,
    and a lost executor re-reads files instead of recomputing the lineage."""
    spark = df.sparkSession
    path = posixpath.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def build_marts(staged: Staged, settings: Settings = Settings()) -> Marts:
    """A6 then A7 (A7 reads A6)."""
    cartera = marts.dm_cartera(
        staged.customers, staged.loans, staged.installments, staged.payments,
        settings.analysis_date,
    )
    return Marts(cartera, marts.dm_resumen_credito(cartera))
