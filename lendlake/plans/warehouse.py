"""The published warehouse: one release names one version of every table.

A run writes new table versions first; they become visible together when its
release is appended, in one step (B4, S4). Readers follow the last release, so
they never see tables of different runs, and a run that is killed, or that is
held back by a failed control, leaves the release before it in place.

``register`` gives a release lasting names (B3, B5): external catalog tables over
its folders, and permanent views by the source pipeline's names, all made by
SQL, so every session on the same catalog can use them.
"""

from __future__ import annotations

import datetime as _dt
import posixpath
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lendlake import constants as K
from lendlake.operators.marts import AS_OF_COLUMNS, MART_COLUMNS, as_of
from lendlake.operators.ranking import read_ranked
from lendlake.operators.staging import REJECTED_COLUMNS
from lendlake.operators.views import TOP_MORA_COLUMNS
from lendlake.sources.versions import ManifestLog, VersionedTable

DATABASE = "lendlake"
HIDDEN = ("lake_bucket", "_range", "_pos")  # columns of the storage


@dataclass(frozen=True)
class Release:
    number: int
    tables: dict[str, int]
    analysis_date: str
    mark: str | None
    properties: dict = field(default_factory=dict)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.releases = ManifestLog(spark, posixpath.join(self.root, "releases"))

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, posixpath.join(self.root, "tables", name))

    def release(self, number: int | None = None) -> Release | None:
        number = self.releases.last() if number is None else number
        return None if number is None else Release(number=number, **self.releases.get(number))

    def publish(
        self, after: Release | None, tables: dict[str, int], analysis_date: str, mark: str | None, properties: dict
    ) -> Release:
        """Append the release that follows ``after``; Conflict if another run did so
        in the meantime."""
        number = 0 if after is None else after.number + 1
        document = {"tables": tables, "analysis_date": analysis_date, "mark": mark, "properties": properties}
        self.releases.append(number, document)
        return Release(number=number, **document)

    def read(self, name: str, release: Release | None = None) -> DataFrame:
        """A table, or the mart, the ranking or a plain view, of a release (the last)."""
        release = release or self.release()
        if release is None:
            raise LookupError(f"{self.root} has no release")
        if name == "dm_cartera":
            return as_of(self.read("cartera_facts", release), release.analysis_date)
        if name == "vw_payments_rejected":
            return self.read("stg_payments", release).where("NOT is_valid").select(*REJECTED_COLUMNS)
        if name == "vw_bi_completo":
            from lendlake.operators.views import vw_bi_completo

            return vw_bi_completo(self.read("dm_cartera", release))
        if name == "vw_top_mora":
            return read_ranked(self.table(name), "ranking_mora", version=release.tables[name])
        return self.table(name).read(release.tables[name]).drop(*HIDDEN)

    def expire(self, keep: int = 3) -> None:
        """Keep the last releases, and of each table the versions that they name
        and any newer one (a run that is under way)."""
        numbers = self.releases.numbers()
        kept = [self.release(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.releases.remove(n)
        for name in kept[-1].tables if kept else ():
            table = self.table(name)
            pinned = {r.tables[name] for r in kept if name in r.tables}
            newer = [n for n in table.log.numbers() if n > max(pinned)]
            table.expire(keep=1, pinned=[*pinned, *newer])


# --- Catalog objects -----------------------------------------------------------


def _literal(day: str) -> str:
    return f"DATE'{_dt.date.fromisoformat(day).isoformat()}'"


def mart_sql(day: str, facts: str = "cartera_facts") -> str:
    """dm_cartera as SQL over its facts, as of a date."""
    d, status = _literal(day), "installment_status"
    days = f"CAST(datediff({d}, due_date) AS BIGINT)"
    overdue = f"{status} = 'LATE' OR (due_date < {d} AND {status} <> 'PAID')"
    bands = " ".join(f"WHEN {days} BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in K.BUCKET_BOUNDS)
    aged = dict(zip(AS_OF_COLUMNS, [
        f"CASE WHEN {overdue} THEN TRUE ELSE FALSE END",
        f"CASE WHEN {overdue} THEN {days} ELSE 0L END",
        f"CASE WHEN {status} = '{K.BUCKET_PAID}' THEN '{K.BUCKET_PAID}' WHEN due_date >= {d} THEN '{K.BUCKET_CURRENT}'"
        f" {bands} WHEN {days} > {K.MODERATE_MAX_DAYS} THEN '{K.BUCKET_90_PLUS}' ELSE '{K.BUCKET_OTHER}' END",
        d,
    ]))
    columns = ", ".join(f"{aged[c]} AS {c}" if c in aged else c for c in MART_COLUMNS)
    return f"SELECT {columns} FROM {facts}"


BI_SQL = """
SELECT origination_date, cohort_month, date_format(cohort_month, 'yyyy-MM') AS cohort_label, due_date,
  date_format(due_date, 'yyyy-MM') AS mes_vencimiento, last_payment_date, analysis_date, city, segment, product_type,
  loan_id, customer_id, full_name, loan_status, loan_principal, annual_rate,
  CAST(round(annual_rate * 100, 2) AS DECIMAL(9, 2)) AS annual_rate_pct, term_months, installment_id,
  installment_number, installment_status, mora_bucket, is_overdue, days_overdue, principal_due, interest_due,
  total_due, total_paid, balance_due, num_payments,
  round(100D * CAST(total_paid AS DOUBLE) / nullif(CAST(total_due AS DOUBLE), 0D), 2) AS pct_cobrado,
  CASE WHEN total_paid >= total_due THEN TRUE ELSE FALSE END AS cuota_pagada_completa
FROM {mart}
"""


def _external(spark: SparkSession, database: str, name: str, table: VersionedTable, version: int) -> str:
    """An external catalog table over the folders of one version; its full name."""
    full = f"{database}.{name}__v{version}"
    if spark.catalog.tableExists(full):
        return full
    manifest = table.manifest(version)
    schema = StructType.fromJson(manifest["schema"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    column = manifest["partition_by"]
    if column is None:
        where = table.folder(manifest["parts"][""])
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet LOCATION '{where}'")
        return full
    spark.sql(
        f"CREATE TABLE {full} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{table.path}/catalog'"
    )
    for part, commit in manifest["parts"].items():
        value = part.split("=", 1)[1]
        value = "NULL" if value == "__HIVE_DEFAULT_PARTITION__" else f"'{value}'"
        spark.sql(
            f"ALTER TABLE {full} ADD IF NOT EXISTS PARTITION (`{column}` = {value})"
            f" LOCATION '{table.folder(commit, part)}'"
        )
    return full


def register(lake: Warehouse, database: str = DATABASE, release: Release | None = None) -> list[str]:
    """Permanent names for a release (the last): CREATE OR REPLACE VIEW for each
    table and view of the source pipeline. Returns the names."""
    spark, release = lake.spark, release or lake.release()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    views: dict[str, str] = {}
    for name, version in release.tables.items():
        table = lake.table(name)
        full = _external(spark, database, name, table, version)
        columns = [f"`{c}`" for c in StructType.fromJson(table.manifest(version)["schema"]).names if c not in HIDDEN]
        views[name] = f"SELECT {', '.join(columns)} FROM {full}"
        if name == "vw_top_mora":
            ranges = table.manifest(version)["properties"]["ranges"]
            rows = ", ".join(f"({p.split('=')[1]}, {b}L)" for p, (b, _) in ranges.items()) or "(0, 0L)"
            # One literal row a range: the join is broadcast by its size.
            views[name] = (
                f"SELECT {', '.join(f't.`{c}`' for c in TOP_MORA_COLUMNS)}, o.before + t._pos + 1 AS ranking_mora"
                f" FROM {full} t JOIN (VALUES {rows}) AS o(r, before) ON t._range = o.r"
            )
    views["dm_cartera"] = mart_sql(release.analysis_date, f"{database}.cartera_facts")
    views["vw_payments_rejected"] = f"SELECT {', '.join(REJECTED_COLUMNS)} FROM {database}.stg_payments WHERE NOT is_valid"
    views["vw_bi_completo"] = BI_SQL.format(mart=f"{database}.dm_cartera")
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
    return sorted(views)


def drop_old(lake: Warehouse, database: str = DATABASE, keep: Iterable[Release] = ()) -> None:
    """Drop the catalog tables of versions that no kept release (nor the last) names."""
    spark = lake.spark
    named = {f"{n}__v{v}" for r in [lake.release(), *keep] for n, v in r.tables.items()}
    for t in spark.catalog.listTables(database):
        if t.tableType == "EXTERNAL" and "__v" in t.name and t.name not in {n.lower() for n in named}:
            spark.sql(f"DROP TABLE {database}.{t.name}")


