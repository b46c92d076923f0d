"""Staging stored in buckets of the mart's join keys.

Customers lie in buckets of customer_id, loans of loan_id, installments and the
payments' totals of installment_id. The mart over them exchanges the loans to
their customers and back and the installments to their loans, three times in all;
the payments, the largest table, do not move, and the loan summary adds nothing.
The stored payments themselves stay in their own order: what the mart needs of
them is summed before it is moved, so a hot installment costs a row a task.

A store is complete once its manifest is there, which is written last; without it
``BucketedStaging`` refuses to read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendlake.operators import marts, staging
from lendlake.plans.layers import Marts, Settings
from lendlake.sources.buckets import read_bucketed, write_bucketed
from lendlake.sources.files import Files
from lendlake.sources.raw import RawInputs

MANIFEST = "manifest.json"
PAYMENTS = "stg_payments"


class BucketedStaging:
    """One stored run of the staging layer under ``root``, a folder of its own."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root.rstrip("/")
        self._files = Files(spark, self._root)

    def _path(self, name: str) -> str:
        return f"{self._root}/{name}"

    def manifest(self) -> dict:
        if MANIFEST not in self._files.names(self._root):
            raise LookupError(f"no complete store in {self._root}")
        return json.loads(self._files.read_text(self._path(MANIFEST)))

    def store(self, raw: RawInputs, settings: Settings = Settings(), buckets: int | None = None) -> None:
        """Stage all inputs, each layer once, each from the stored one before it.

        ``buckets`` should be at least the session's shuffle partitions (the
        default): Spark shuffles a table with fewer buckets again."""
        dealt = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        n = buckets or dealt
        tables: dict[str, dict] = {}

        def kept(name: str, key: str, df: DataFrame, grouped: bool = False) -> DataFrame:
            write_bucketed(df, self._path(name), key, n, dealt=grouped and n == dealt)
            tables[name] = {"key": key, "buckets": n, "schema": df.schema.jsonValue()}
            return read_bucketed(self._spark, self._path(name), df.schema, key, n)

        customers = kept(
            "stg_customers", "customer_id", staging.stg_customers(raw.customers, settings.segments)
        )
        loans = kept("stg_loans", "loan_id", staging.stg_loans(raw.loans, customers))
        installments = kept(
            "stg_installments", "installment_id", staging.stg_installments(raw.installments, loans)
        )
        payments = staging.stg_payments(raw.payments, installments)
        payments.write.parquet(self._path(PAYMENTS))
        tables[PAYMENTS] = {"schema": payments.schema.jsonValue()}
        totals = marts.payments_per_installment(self._plain(PAYMENTS, payments.schema))
        kept("payment_totals", "installment_id", totals, grouped=True)
        self._files.create(self._path(MANIFEST), json.dumps({"tables": tables}))

    def _plain(self, name: str, schema: T.StructType) -> DataFrame:
        return self._spark.read.schema(schema).parquet(self._path(name))

    def table(self, name: str) -> DataFrame:
        """A stored table: a name of the staging layer, or ``payment_totals``."""
        spec = self.manifest()["tables"][name]
        schema = T.StructType.fromJson(spec["schema"])
        if "key" not in spec:
            return self._plain(name, schema)
        return read_bucketed(self._spark, self._path(name), schema, spec["key"], spec["buckets"])

    def marts(self, settings: Settings = Settings()) -> Marts:
        """A6 and A7 as of the settings' date."""
        facts = marts.facts_with_totals(
            self.table("stg_customers"), self.table("stg_loans"),
            self.table("stg_installments"), self.table("payment_totals"),
        )
        cartera = marts.as_of(facts, settings.analysis_date)
        return Marts(cartera, marts.dm_resumen_credito(cartera))
