"""Training-order materialisation by a keyed permutation (op4).

Documents are tokenised and cut into sequences of at most LENGTH ids. The
sequences are stored once with their partition and position, so counting the
partitions numbers them 0..N-1 without a sort. A keyed Feistel network over the
least even number of bits that holds N, walked along its cycles until it falls
below N, permutes the numbers: each sequence's slot in training order is
computed on its own, from key and N alone. Slots fall into shards of
SHARD slots; a shard's range is known beforehand, so its rows go to one task
by partition id, are sorted there and make fixed-stride records. Record s of the training
order is at byte (s mod SHARD) x stride of shard s // SHARD, which is what
sequential and resumed reads need.

Record: length (unsigned 32-bit), then LENGTH ids, unsigned 16-bit, zero
padded, all little-endian.

Cases: a null or empty text is the end id alone; repeated documents are
written each; rows without doc_id are written like any other; an empty table
gives no records; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.packing import tokenised
from lendlake.llm.tables import map_rows, stored

LENGTH = 1024
SHARD = 4096
KEY = 20260101
ROUNDS = 6


def stride(length: int = LENGTH) -> int:
    return 4 + 2 * length


def _round(x: np.ndarray, key: int, r: int, mask: np.uint64) -> np.ndarray:
    h = x + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD6E8FEB86659FD93) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) & mask


def slots(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """The permutation of 0..n-1 at each index."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = np.asarray(index, np.uint64).copy()
    walk = np.arange(len(out))
    while len(walk):
        x = out[walk]
        left, right = x >> half, x & mask
        for r in range(rounds):
            left, right = right, left ^ _round(right, key, r, mask)
        out[walk] = (left << half) | right
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)


def _positions(batches: Iterator[list]) -> Iterator[list]:
    part, pos = TaskContext.get().partitionId(), 0
    for columns in batches:
        rows = []
        for row in zip(*columns):
            short = np.frombuffer(row[-1], "<u4").astype("<u2").tobytes()
            rows.append((part, pos, *row[:-1], short))
            pos += 1
        yield rows


_ROW = "doc_id long, piece int, start long, length long, ids_crc32 long"


def materialise(docs: DataFrame, key: int = KEY, length: int = LENGTH, shard: int = SHARD, path: str | None = None) -> DataFrame:
    """One row for each sequence, in slot order within its shard's partition:
    slot, shard, doc_id, piece, start, length, ids_crc32, record."""
    cut = tokenised(docs, length, path, with_ids=True)
    kept = stored(map_rows(cut, _positions, "part int, pos long, " + _ROW + ", ids binary"))
    sizes = kept.groupBy("part").count().orderBy("part").collect()  # one row for each partition
    before, n = {}, 0
    for r in sizes:
        before[r["part"]] = n
        n += r["count"]
    sent = kept.sparkSession.sparkContext.broadcast(before)

    def numbered(batches: Iterator[list]) -> Iterator[list]:
        for part, pos, *rest in batches:
            index = np.array([sent.value[p] for p in part], np.int64) + np.array(pos, np.int64)
            to = slots(index, n, key)
            yield list(zip(to.tolist(), (to // shard).tolist(), *rest))

    def records(batches: Iterator[list]) -> Iterator[list]:
        for columns in batches:
            yield [
                (*row[:-1], struct.pack("<I", row[6 - 1]) + row[-1].ljust(2 * length, b"\0")) for row in zip(*columns)
            ]

    shards = max(1, -(-n // shard))
    ranged = (
        map_rows(kept, numbered, "slot long, shard long, " + _ROW + ", ids binary")
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("slot")
    )
    return map_rows(ranged, records, "slot long, shard long, " + _ROW + ", record binary")


def write_shards(materialised: DataFrame, path: str) -> None:
    """One file for each shard, in ``path/shard=K``: its records in slot order,
    each followed by a line feed (so the stride is ``stride() + 1``). Spark's
    committed text sink writes the bytes as they are."""
    out = materialised.select("shard", "slot", F.col("record").cast("string").alias("value"))
    out.sortWithinPartitions("shard", "slot").select("shard", "value").write.partitionBy("shard").text(path)
