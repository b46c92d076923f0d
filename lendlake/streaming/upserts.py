"""Upserts into a stored table, batch by batch or as a stream (K1, K2).

The target is a versioned table whose rows lie in partitions by a hash of their
key. A batch is reduced to its newest row per key, only the buckets that hold one
of its keys are read and merged with the batch ``upsert``, and the next
version takes over the files of all others. So a batch costs what it touches, and
a reader sees all of it or nothing.

Versions are counted by the target. What has been applied is recorded in the
version itself, as the last batch of each writer (a stream's query id, which
lives in its checkpoint), in the same step as the rows: a replayed batch changes
nothing, and a stream that starts over with a fresh checkpoint is another writer
whose batches come on top.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lendlake.operators.incremental import upsert
from lendlake.sources.files import Files
from lendlake.sources.versions import Conflict, VersionedTable

BUCKET = "lake_bucket"
BUCKETS = 64
ATTEMPTS = 5  # writers that get in between


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def in_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.select("*", bucket_of(key, buckets))


def read_target(table: VersionedTable, schema: StructType | None = None, version: int | None = None) -> DataFrame:
    """The target's rows (none before its first version, if ``schema`` is given)."""
    return table.read(version, schema=schema).drop(BUCKET)


def touched_buckets(batch: DataFrame, key: str, buckets: int) -> list[str]:
    """The partition folders that hold a key of the batch: at most ``buckets`` names."""
    found = batch.select(bucket_of(key, buckets)).distinct().collect()
    return [f"{BUCKET}={r[0]}" for r in found]


def merge_into(
    table: VersionedTable,
    batch: DataFrame,
    key: str,
    order: Sequence[str],
    buckets: int = BUCKETS,
    writer: tuple[str, int] | None = None,
    base: int | None = None,
    properties: dict | None = None,
) -> int:
    """MERGE a batch by key: the new version's number (the current one's if the
    writer's batch was applied already).

    ``writer`` is (id, number of its batch). ``base`` merges into that version
    rather than the current one. The number of buckets is fixed by the first
    version.
    """
    for attempt in range(ATTEMPTS):
        version = table.version() if base is None else base
        try:
            if version is None:
                new = upsert(batch.limit(0), batch, key, order)
                applied = dict([writer] if writer else [])
                record = {"buckets": buckets, "key": key, "applied": applied, **(properties or {})}
                return table.replace(in_buckets(new, key, buckets), BUCKET, record)
            record = dict(table.manifest(version)["properties"])
            applied = dict(record["applied"])
            if writer and applied.get(writer[0], -1) >= writer[1]:
                return version
            applied |= dict([writer] if writer else [])
            record |= {"applied": applied, **(properties or {})}
            n = record["buckets"]
            touched = touched_buckets(batch, key, n)
            old = table.read(version, touched).drop(BUCKET)
            merged = upsert(old, batch.select(*old.columns), key, order)
            return table.replace_parts(in_buckets(merged, key, n), touched, version, record)
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("unreachable")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint."""
    metadata = Files(spark, checkpoint).read_text(posixpath.join(checkpoint, "metadata"))
    return json.loads(metadata)["id"]


def start_upserts(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    key: str = "payment_id",
    order: Sequence[str] = ("loaded_at",),
    available_now: bool = False,
    buckets: int = BUCKETS,
    keep: int = 10,
) -> StreamingQuery:
    """Start the stream from ``source_dir`` (Parquet files) into ``target``, keeping
    its last ``keep`` versions."""
    table = VersionedTable(spark, target)

    def apply(batch: DataFrame, number: int) -> None:
        merge_into(table, batch, key, list(order), buckets, writer=(query_id(spark, checkpoint), number))
        table.expire(keep)

    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
