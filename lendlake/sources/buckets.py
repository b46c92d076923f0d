"""Parquet tables stored in buckets of a key, so that joins and aggregates on the
key need no exchange.

Rows go to buckets by the hash that Spark's exchanges use. The write is a
rebalance by key: a bucket that outgrows the advisory size is written by several
tasks, so a key that holds a third of all rows does not pass through one of them.

A bucket is read by one task, though. ``read_bucketed`` therefore looks at the
buckets' sizes: by the rule by which AQE calls a shuffle partition skewed, a table
with a hot bucket is read as plain files. Joins then shuffle it, and AQE splits the
hot partition. Both ways give the same rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendlake.sources.files import Files

_BUCKET = re.compile(r"_(\d{5,})(?:\.|$)")
_SKEW = "spark.sql.adaptive.skewJoin.skewedPartition"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, dealt: bool = False) -> None:
    """``df`` as a new folder of Parquet files in ``buckets`` buckets of ``key``,
    sorted by it within a file. ``dealt``: its last step is an aggregate by ``key``
    over as many shuffle partitions, so each bucket is in one task already."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    spread = df if dealt else df.hint("rebalance", buckets, key)
    spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the entry only; the files are not the catalog's


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of each bucket that has files."""
    out: Counter = Counter()
    for name, size in Files(spark, path).lengths(path).items():
        if found := _BUCKET.search(name):
            out[int(found.group(1))] += size
    return dict(out)


def has_hot_bucket(spark: SparkSession, path: str, buckets: int) -> bool:
    """Whether a bucket is skewed as AQE defines it: larger than its threshold and
    than its factor times the median bucket."""
    sizes = bucket_bytes(spark, path)
    every = [*sizes.values(), *[0] * (buckets - len(sizes))]
    factor = float(spark.conf.get(f"{_SKEW}Factor"))
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    least = to_bytes(spark.conf.get(f"{_SKEW}ThresholdInBytes"))
    return max(every) > max(least, factor * median(every))


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The table, in any session; with its buckets unless one of them is hot."""
    if has_hot_bucket(spark, path, buckets):
        return spark.read.schema(schema).parquet(path)
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out
