"""Join-side helpers that keep every join N:1.

A parent table may carry copies of a key (the staging layer never drops rows).
Joining children to such a parent would emit every (child, copy) pair, so the
parent side of each join is first reduced to one row per key with a
skew-safe hash aggregate (partial aggregation runs map-side, so a key holding a
third of all rows is combined before the shuffle). Copies are then reported by
the unique-key controls instead of multiplying rows downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_set(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Distinct keys plus a TRUE marker column, for existence tests."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().withColumn(flag, F.lit(True))


def one_per_key(df: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """One row per non-NULL key; with copies, the greatest payload wins.

    ``max(struct(...))`` is deterministic, needs no sort and aggregates
    partially before the shuffle.
    """
    payload = list(payload)
    if not payload:
        return df.where(F.col(key).isNotNull()).select(key).distinct()
    if len(payload) == 1:
        return (
            df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.max(payload[0]).alias(payload[0]))
        )
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*payload)).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in payload])
    )


#: Why a row was not chosen.
REPEATED = "repeats the chosen row"
OUTRANKED = "another row was chosen for its key"


def displaced(df: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """The ledger of ``one_per_key``: each distinct row of a non-NULL key that was not
    chosen, with the chosen payload (``chosen``), the ``reason`` and how many
    ``copies`` of it there are; of the chosen row itself, the copies beyond the first.

    Equal rows are counted first, so a key that holds very many copies reaches the
    join as its distinct rows. Chosen and displaced rows add up to the input's rows with a key.
    """
    rest = [c for c in df.columns if c != key and c not in payload]
    row = F.struct(*payload, *rest)
    counted = df.where(F.col(key).isNotNull()).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    best = counted.groupBy(F.col(key).alias("_key")).agg(F.max(row).alias("_best"))
    j = counted.join(best, F.col(key) == F.col("_key")).withColumn("_is_best", row.eqNullSafe(F.col("_best")))
    equal = F.struct(*payload).eqNullSafe(F.struct(*[F.col(f"_best.{c}") for c in payload]))
    return j.select(
        *df.columns,
        F.struct(*[F.col(f"_best.{c}").alias(c) for c in payload]).alias("chosen"),
        F.when(equal, REPEATED).otherwise(OUTRANKED).alias("reason"),
        (F.col("copies") - F.col("_is_best").cast("bigint")).alias("copies"),
    ).where("copies > 0")
