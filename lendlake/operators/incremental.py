"""Incremental loading (K1-K3).

K1 reads the rows that arrived after a stored high-water mark and advances
the mark. K2 upserts by key: the newest row per key wins, newest by
``(ts, tie-breaker)``; both sides are reduced to one row per key first, so the
merge is a 1:1 full outer join whatever the duplication of the input. K3
rebuilds only the mart partitions an increment touches, in a new version of the
table. ``plans.runs`` makes one transaction of them, whose release holds the mark.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.sources.versions import VersionedTable


def as_mark(value: _dt.datetime | str) -> Column:
    """A watermark literal (timestamp without time zone), built from text so no
    session or process time zone shifts it."""
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    _dt.datetime.fromisoformat(value)  # validate
    return F.lit(value).cast("timestamp_ntz")


def new_rows(df: DataFrame, ts_col: str, mark: _dt.datetime | str) -> DataFrame:
    """K1: rows strictly after the mark (pushed into the Parquet scan)."""
    return df.where(F.col(ts_col) > as_mark(mark))


def advance_mark(df: DataFrame, ts_col: str, mark: _dt.datetime | str) -> DataFrame:
    """K1: one row ``(old_mark, new_rows, new_mark)``; the mark never moves back."""
    inc = new_rows(df, ts_col, mark)
    return inc.agg(
        F.count(F.lit(1)).alias("new_rows"),
        F.max(ts_col).alias("_max"),
    ).select(
        as_mark(mark).alias("old_mark"),
        "new_rows",
        F.coalesce(F.col("_max"), as_mark(mark)).alias("new_mark"),
    )


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row per key by ``order`` (lexicographic), as one aggregate:
    partial aggregation combines a hot key map-side, no per-key sort."""
    payload = [c for c in df.columns if c != key]
    ordered = list(order) + [c for c in payload if c not in order]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*ordered)).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in payload])
    )


def upsert(target: DataFrame, source: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """K2: MERGE by key (update matched with the newer row, insert new).

    Both sides are reduced to their newest row per key; a source row replaces
    the target row unless the target row is newer by ``order``. Rows without a
    key match nothing: the target's stay and the source's are inserted.
    """
    cols = [c for c in target.columns]
    t = latest_per_key(target, key, order).select(
        key, F.struct(*[c for c in cols if c != key]).alias("_t")
    )
    s = latest_per_key(source.select(*cols), key, order).select(
        key, F.struct(*[c for c in cols if c != key]).alias("_s")
    )
    j = t.join(s, key, "full_outer")
    t_key = F.struct(*[F.col(f"_t.{c}") for c in order])
    s_key = F.struct(*[F.col(f"_s.{c}") for c in order])
    use_source = F.col("_s").isNotNull() & (F.col("_t").isNull() | (s_key >= t_key))
    row = F.when(use_source, F.col("_s")).otherwise(F.col("_t"))
    merged = j.select(key, row.alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in cols if c != key]
    ).select(*cols)
    no_key = F.col(key).isNull()
    return merged.union(target.where(no_key).select(*cols)).union(source.where(no_key).select(*cols))


def touched_partitions(
    mart_keys: DataFrame, increment: DataFrame, key: str, partition_col: str
) -> DataFrame:
    """K3: the partitions (e.g. cohort months) holding a key of the increment.
    Both sides are reduced to distinct keys before the join."""
    keys = increment.where(F.col(key).isNotNull()).select(key).distinct()
    parts = mart_keys.select(key, partition_col).where(F.col(key).isNotNull()).distinct()
    return parts.join(keys, key, "left_semi").select(partition_col).distinct()


def partition_folders(values: DataFrame, partition_col: str) -> list[str]:
    """The folder names of partition values (one column; a name for each partition)."""
    jvm = values.sparkSession.sparkContext._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    rows = values.select(F.col(partition_col).cast("string")).distinct().collect()
    return [names.getPartitionPathString(partition_col, r[0]) for r in rows]


def rebuild_partitions(
    mart: DataFrame, touched: DataFrame, table: VersionedTable, base: int | None = None, dealt: bool = False
) -> int:
    """K3: a new version of a partitioned mart table in which only the touched
    partitions are written; all others keep their files.

    Touched partitions with rows hold those of ``mart``, those left without rows are
    gone, and nothing changes for readers before the new version is there. Rows are
    rebalanced by partition first, so a partition is a few files of bounded size and a
    large one is split among tasks; a ``dealt`` mart, read from a table stored by the
    same partitions, lies so already and is written as it is read. A touched NULL partition is rebuilt too.
    ``touched`` must come from the keys of the old and the new mart, or partitions
    that the increment empties or adds are missed. Store the mart's facts (``marts.
    cartera_facts``), not its ageing columns: those follow the date of the reader.
    """
    base = table.version() if base is None else base
    partition_col = table.manifest(base)["partition_by"]
    same = mart[partition_col].eqNullSafe(touched[partition_col])
    # No more values than the manifest names partitions: the mart needn't move to meet them.
    rows = mart.join(F.broadcast(touched), same, "left_semi")
    return table.replace_parts(rows, partition_folders(touched, partition_col), base, dealt=dealt)
