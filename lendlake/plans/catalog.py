"""Sinks and names (B4, B5, H17): stored tables, views, load-time columns.

``plans.warehouse`` publishes and names whole runs; these are for single tables.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.session import checkpoint_dir
from lendlake.sources.versions import VersionedTable

# View names of the source pipeline's layers.
VIEW_NAMES = {
    "customers": "stg_customers",
    "loans": "stg_loans",
    "installments": "stg_installments",
    "payments": "stg_payments",
    "rejected": "vw_payments_rejected",
    "mart": "dm_cartera",
    "summary": "dm_resumen_credito",
    "origination": "vw_originacion_diaria",
    "collections": "vw_recaudo_diario",
    "cohort": "vw_cartera_cohorte",
    "top_arrears": "vw_top_mora",
    "bi": "vw_bi_completo",
}


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """CREATE OR REPLACE TEMP VIEW for each given layer (B5), so SQL users can
    query them by the source pipeline's names."""
    for key, df in frames.items():
        df.createOrReplaceTempView(VIEW_NAMES.get(key, key))


def with_load_time(df: DataFrame, name: str = "_loaded_at") -> DataFrame:
    """Add the load timestamp at the sink (H17, N22); kept out of checked data."""
    return df.withColumn(name, F.current_timestamp())


def table_root(spark: SparkSession) -> str:
    """Folder for stored tables: ``lendlake.warehouse`` if set, else a
    ``tables`` folder next to the shared checkpoint folder."""
    root = spark.conf.get("lendlake.warehouse", None)
    return root or posixpath.join(checkpoint_dir(spark), "tables")


KEPT = 8  # versions of a stored table


def materialize(
    spark: SparkSession, name: str, df: DataFrame, load_time: str | None = "_stg_loaded_at"
) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS (B4): a new version of table ``name`` (with its
    load time), and the rows of that version without it. Other sessions may write
    and read the same table: each reads a version as a whole."""
    table = VersionedTable(spark, posixpath.join(table_root(spark), name))
    version = table.replace(with_load_time(df, load_time) if load_time else df)
    table.expire(KEPT)
    stored = table.read(version)
    return stored.drop(load_time) if load_time else stored


def create_view(spark: SparkSession, name: str, table: str, columns: list[str], where: str = "TRUE") -> DataFrame:
    """CREATE OR REPLACE VIEW (B5) over the last version of a stored table: a
    permanent object of the current database, there for every session of the catalog."""
    stored = VersionedTable(spark, posixpath.join(table_root(spark), table))
    folder = stored.folder(stored.manifest()["parts"][""])
    full = f"{spark.catalog.currentDatabase()}.{name}"
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {', '.join(columns)} FROM parquet.`{folder}` WHERE {where}")
    return spark.table(full)
