"""Versioned tables: write new files, then switch.

A table is a folder of Parquet data and numbered manifests::

    <path>/data/lake_commit=<id>/[<column>=<value>/]part-*.parquet
    <path>/versions/<n>.json

A commit's files are written once and never changed. A manifest names the
folders that make up one version, one for each value of the partition column (or
one for all), so a version can take over the partitions that it does not change
from the version before. It is created under a number that no other has, in one
step: before that step readers see the old version, after it the new one, and of
two writers one gets a Conflict. A write that stops half-way leaves files that
no manifest names. Manifests are as large as the table has partitions, never as
its rows.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lendlake.sources.files import Conflict, Files

__all__ = ["Conflict", "ManifestLog", "VersionedTable"]

_COMMIT = "lake_commit"
_SPLITS = "spark.sql.files.maxPartitionBytes"
_DEALT_SPLIT = 32 * 1024 * 1024


@contextmanager
def _small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in small splits. A partitioned write sorts each task's rows by
    partition, some ten times their Parquet bytes: small splits are sorted in memory."""
    set_before = spark.conf.get(_SPLITS)
    spark.conf.set(_SPLITS, str(_DEALT_SPLIT))
    try:
        yield
    finally:
        spark.conf.set(_SPLITS, set_before)


class ManifestLog:
    """Numbered JSON documents in a folder, each created once and never changed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder
        self.files = Files(spark, folder)

    def _file(self, number: int) -> str:
        return posixpath.join(self.folder, f"{number:010d}.json")

    def numbers(self) -> list[int]:
        names = (n.removesuffix(".json") for n in self.files.names(self.folder) if n.endswith(".json"))
        return sorted(int(n) for n in names if n.isdigit())

    def get(self, number: int) -> dict:
        return json.loads(self.files.read_text(self._file(number)))

    def last(self) -> int | None:
        return max(self.numbers(), default=None)

    def append(self, number: int, document: dict) -> int:
        self.files.create(self._file(number), json.dumps(document, sort_keys=True))
        return number

    def remove(self, number: int) -> None:
        self.files.delete(self._file(number))


@dataclass(frozen=True)
class Written:
    """Files that no manifest names yet."""

    table: VersionedTable
    schema: StructType
    partition_by: str
    path: str
    parts: dict[str, str]

    def rows(self) -> DataFrame:
        spark = self.table.spark
        if not self.parts:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.path)

    def commit(self, properties: dict | None = None) -> int:
        return self.table._commit(self.schema, self.partition_by, self.parts, properties)


class VersionedTable:
    """One table; versions are counted by the table itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.data = posixpath.join(self.path, "data")
        self.log = ManifestLog(spark, posixpath.join(self.path, "versions"))

    def version(self) -> int | None:
        """The current version's number, None before the first."""
        return self.log.last()

    def manifest(self, version: int | None = None) -> dict | None:
        version = self.version() if version is None else version
        return None if version is None else self.log.get(version)

    def read(
        self, version: int | None = None, parts: Iterable[str] | None = None, schema: StructType | None = None
    ) -> DataFrame:
        """The rows of a version (of some of its partition folders). ``schema`` is for
        a table without a version yet: it reads as empty."""
        manifest = self.manifest(version)
        if manifest is None:
            if schema is None:
                raise LookupError(f"{self.path} has no version")
            return self.spark.createDataFrame([], schema)
        schema = StructType.fromJson(manifest["schema"])
        wanted = manifest["parts"] if parts is None else {p: manifest["parts"][p] for p in parts if p in manifest["parts"]}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        folders = [self.folder(commit, part) for part, commit in sorted(wanted.items())]
        reader = self.spark.read.schema(schema).option("basePath", self.data)
        return reader.parquet(*folders).select(*schema.names)

    def folder(self, commit: str, part: str = "") -> str:
        return posixpath.join(self.data, f"{_COMMIT}={commit}", part) if part else posixpath.join(
            self.data, f"{_COMMIT}={commit}"
        )

    def _write(self, df: DataFrame, partition_by: str | None, dealt: bool = False) -> dict[str, str]:
        """Write one commit's files; the folders that it filled. Rows that are ``dealt``
        lie by partition already and stay in their tasks."""
        commit = uuid.uuid4().hex
        path = self.folder(commit)
        if partition_by is None:
            df.write.parquet(path)
            return {"": commit}
        # A few files of bounded size a partition, a large one split among tasks.
        if dealt:
            with _small_splits(self.spark):
                df.write.partitionBy(partition_by).parquet(path)
        else:
            df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
        return {n: commit for n in self.log.files.names(path) if "=" in n}

    def write_parts(self, df: DataFrame, partition_by: str) -> Written:
        """Files of ``df`` as they are dealt, not yet a version: look at them, then
        ``commit`` them."""
        commit = uuid.uuid4().hex
        path = self.folder(commit)
        df.write.partitionBy(partition_by).parquet(path)
        parts = {n: commit for n in self.log.files.names(path) if "=" in n}
        return Written(self, df.schema, partition_by, path, parts)

    def _commit(self, schema: StructType, partition_by: str | None, parts: dict, properties: dict | None) -> int:
        last = self.version()
        document = {
            "schema": json.loads(schema.json()), "partition_by": partition_by, "parts": parts,
            "properties": properties or {},
        }
        return self.log.append(0 if last is None else last + 1, document)

    def replace(
        self, df: DataFrame, partition_by: str | None = None, properties: dict | None = None, dealt: bool = False
    ) -> int:
        """CREATE OR REPLACE TABLE AS: a new version holding ``df`` alone."""
        return self._commit(df.schema, partition_by, self._write(df, partition_by, dealt), properties)

    def replace_parts(
        self, df: DataFrame, touched: Iterable[str], base: int, properties: dict | None = None, dealt: bool = False
    ) -> int:
        """A new version in which the touched partition folders hold the rows of
        ``df`` (none: the partition is gone) and all others are those of version
        ``base``. Rows of ``df`` outside the touched partitions are an error. Rows read
        from files of the same partitions are ``dealt`` and move no more."""
        old = self.log.get(base)
        written = self._write(df.select(*StructType.fromJson(old["schema"]).names), old["partition_by"], dealt)
        touched = set(touched)
        if not written.keys() <= touched:
            raise ValueError(f"rows outside the touched partitions: {sorted(written.keys() - touched)[:5]}")
        kept = {p: c for p, c in old["parts"].items() if p not in touched}
        return self._commit(StructType.fromJson(old["schema"]), old["partition_by"], kept | written, properties)

    def drop(self) -> None:
        """Remove the table with all its versions."""
        self.log.files.delete(self.path)

    def expire(self, keep: int = 2, pinned: Iterable[int] = ()) -> list[int]:
        """Remove all but the last ``keep`` versions and the pinned ones, with the
        files that only they name. Files of writes that never became a version
        stay, as their writer may still be at work."""
        numbers = self.log.numbers()
        stay = {*numbers[-keep:], *pinned}
        gone = [n for n in numbers if n not in stay]
        named = {(p, c) for n in numbers if n in stay for p, c in self.log.get(n)["parts"].items()}
        doomed = {(p, c) for n in gone for p, c in self.log.get(n)["parts"].items()} - named
        for n in gone:  # the manifests first: no reader finds a version without its files
            self.log.remove(n)
        for part, commit in sorted(doomed):
            self.log.files.delete(self.folder(commit, part))
        return gone
