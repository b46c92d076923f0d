"""Global ROW_NUMBER without a single-task window (F1).

``row_number().over(Window.orderBy(...))`` moves every row into one partition.
Here the rows are range-partitioned on the full order (ties broken by a unique
key, so ranges split evenly even when many rows share a value) and sorted
inside each range. In the same pass each row gets its range id and its
position in the range, and the rows are written once as Parquet to the shared
checkpoint folder, which fixes bounds and positions and cuts the lineage. A
row's number is then the count of rows in earlier ranges plus its position.
Only one small table, one row per range, is windowed and broadcast.

``store_ranked`` keeps the ranges as a versioned table instead, with each range's
first number in its manifest: ``read_ranked`` declares no job, and a stretch of
numbers opens only the files of its ranges.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.session import checkpoint_dir
from lendlake.sources.versions import VersionedTable

_POSITION_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` plus ``name`` = 1-based position in ``order`` (must be a total order)."""
    spark = df.sparkSession
    path = posixpath.join(checkpoint_dir(spark), "ranking", uuid.uuid4().hex)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    _tagged(ranged).write.parquet(path)
    tagged = spark.read.parquet(path)
    sizes = tagged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: the running total is a window over at most
    # spark.sql.shuffle.partitions rows, not over the data.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        tagged.join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("bigint"))
        .drop("_range", "_pos", "_off")
    )


def _tagged(ranged: DataFrame) -> DataFrame:
    """Sorted ranges with their number and each row's position."""
    here = F.spark_partition_id()
    first = F.shiftleft(here.cast("bigint"), _POSITION_BITS)
    return ranged.select(
        "*", here.alias("_range"), (F.monotonically_increasing_id() - first).alias("_pos")
    )


def store_ranked(
    df: DataFrame, order: Sequence[Column], table: VersionedTable, ranges: int | None = None
) -> int:
    """Write ``df`` in ranges of ``order`` as a new version of ``table``; its
    properties name each range's [rows before it, rows]. Spark chooses the number
    of ranges by their size unless it is given."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    ranged = dealt.sortWithinPartitions(*order)
    written = table.write_parts(_tagged(ranged), "_range")
    # One row a range, counted from the files' footers.
    counts = written.rows().groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
    places, before = {}, 0
    for r in counts:
        places[f"_range={r['_range']}"] = [before, r["n"]]
        before += r["n"]
    return written.commit({"ranges": places})


def read_ranked(
    table: VersionedTable, name: str, first: int | None = None, last: int | None = None, version: int | None = None
) -> DataFrame:
    """The stored rows with their number ``name``; of numbers ``first`` to ``last``
    only the ranges that hold some are opened."""
    version = table.version() if version is None else version
    ranges = table.manifest(version)["properties"]["ranges"]
    inside = [
        part for part, (before, n) in ranges.items()
        if (first is None or before + n >= first) and (last is None or before < last)
    ]
    before = F.create_map(*[F.lit(x) for p in inside for x in (int(p.split("=")[1]), ranges[p][0])]) if inside else None
    rows = table.read(version, parts=inside)
    number = F.lit(None) if before is None else before[F.col("_range")] + F.col("_pos") + 1
    ranked = rows.withColumn(name, number.cast("bigint")).drop("_range", "_pos")
    if first is not None:
        ranked = ranked.where(F.col(name) >= first)
    return ranked if last is None else ranked.where(F.col(name) <= last)
