"""The scheduled full run (B4): write every layer in dependency order, publish, and
name the result. ``plans.runs`` has the steps; an incremental run is
``runs.refresh`` without ``full``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendlake.plans import runs
from lendlake.plans.catalog import VIEW_NAMES, register_views
from lendlake.plans.layers import Settings
from lendlake.plans.warehouse import Warehouse
from lendlake.sources.raw import RawInputs


def run(
    spark: SparkSession,
    raw: RawInputs,
    root: str,
    settings: Settings = Settings(),
    register: bool = True,
    gate: bool = True,
) -> dict[str, DataFrame]:
    """Build and publish all layers under ``root``; return the stored tables (and
    register them as temporary views for SQL users of this session when
    ``register``; ``warehouse.register`` gives lasting names)."""
    runs.refresh(spark, raw, root, settings, full=True, gate=gate)
    out = published(spark, root)
    if register:
        register_views(spark, **out)
    return out


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The frames of the last release, without load times."""
    lake = Warehouse(spark, root)
    release = lake.release()
    frames = {key: lake.read(name, release) for key, name in VIEW_NAMES.items()}
    return {key: df.drop(runs.STAGE_LOAD, runs.MART_LOAD) for key, df in frames.items()}
