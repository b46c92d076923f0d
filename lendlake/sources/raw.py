"""Raw inputs: reading (B1), creating empty typed tables (B6) and literal rows
for fixtures (B7)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lendlake.sources.schemas import RAW_SCHEMAS


@dataclass(frozen=True)
class RawInputs:
    """The four canonical inputs of the pipeline, as lazy DataFrames."""

    customers: DataFrame
    loans: DataFrame
    installments: DataFrame
    payments: DataFrame


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one Parquet table ``{root}/{name}.parquet`` (B1).

    Only the columns and rows a query uses are read: Catalyst prunes the read
    schema and pushes filters into the Parquet scan.
    """
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_raw(spark: SparkSession, root: str) -> RawInputs:
    """Read the four canonical raw tables stored as Parquet under ``root``."""
    return RawInputs(
        *[spark.read.schema(RAW_SCHEMAS[n]).parquet(f"{root}/{n}") for n in RAW_SCHEMAS]
    )


def create_input_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """CREATE SCHEMA / TABLE IF NOT EXISTS for the four raw inputs."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in RAW_SCHEMAS.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        loc = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet{loc}"
        )


def literal_rows(spark: SparkSession, name: str, rows: Iterable[Sequence]) -> DataFrame:
    """Typed DataFrame from literal rows of one raw table (B7); fixtures only."""
    return spark.createDataFrame(list(rows), RAW_SCHEMAS[name])


def literal_inputs(spark: SparkSession, **tables: Iterable[Sequence]) -> RawInputs:
    """RawInputs from literal rows; a table not given is empty."""
    return RawInputs(*[literal_rows(spark, n, tables.get(n, [])) for n in RAW_SCHEMAS])
