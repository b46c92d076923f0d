"""Target-distribution importance resampling on hashed word runs (op12).

A text becomes UTF-8 bytes; one 256-byte table lower-cases A-Z and blanks
separators, ``bytes.split`` gives the words (bytes of other scripts stay as they
are), and a run of words is hashed by going on from the crc32 of the run one word
shorter. Each task counts its buckets in a Counter and hands out one row a
bucket, so what is shuffled is bounded by tasks times buckets. The gains, one
integer a bucket, are the only thing that goes to the driver and to the tasks,
bounded by ``buckets``. A second pass adds up each document's gains; a Gumbel key
from the document's id makes the draw without replacement a plain order by score,
which ``global_row_number`` numbers in ranges, never in one task.

Cases: a null or empty text has no words, weight 0, and is never drawn; a row
without doc_id counts in the corpus but has no score and is not drawn (nor counted
among those to draw from); equal scores go to the smaller doc_id, rows that
repeat a doc_id are drawn each, ordered by weight and number of features; an
empty table gives no rows, an empty target makes all gains those of t = 0; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import id_text, map_rows, stored
from lendlake.operators.ranking import global_row_number

LONGEST = 1
BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    c if c >= 128 or c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def features(found: list[bytes], longest: int, buckets: int) -> list[int]:
    """The buckets of all runs of 1 to ``longest`` consecutive words."""
    sums = [crc32(w) for w in found]
    out = [s % buckets for s in sums]
    for n in range(1, longest):
        sums = [crc32(w, crc32(b" ", s)) for s, w in zip(sums, found[n:])]
        out += [s % buckets for s in sums]
    return out


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all texts; each task reduces its own first."""

    def counted(batches: Iterator[list]) -> Iterator[list]:
        total: Counter[int] = Counter()
        for (texts,) in batches:
            for t in texts:
                total.update(features(words(t), longest, buckets))
        yield list(total.items())

    rows = map_rows(docs.select(docs["text"].cast("string")), counted, "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> list[int]:
    """Each bucket's gain in thousandths of log importance: at most ``buckets`` rows
    of either side reach the driver."""
    source = {r["bucket"]: r["n"] for r in bucket_counts(docs, longest, buckets).collect()}
    wanted = {r["bucket"]: r["n"] for r in bucket_counts(target, longest, buckets).collect()}
    all_s, all_t = float(sum(source.values()) + buckets), float(sum(wanted.values()) + buckets)
    return [
        math.floor(1000 * math.log((wanted.get(b, 0) + 1) * all_s / ((source.get(b, 0) + 1) * all_t)))
        for b in range(buckets)
    ]


def gumbel(doc_id: int, seed: int) -> int:
    """The document's random key in thousandths, the same in every run."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int], longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every document."""

    def weighed(batches: Iterator[list]) -> Iterator[list]:
        for ids, texts in batches:
            rows = []
            for i, t in zip(ids, texts):
                found = words(t)
                buckets = features(found, longest, len(gain))
                weight = sum([gain[b] for b in buckets])
                score = None if i is None else weight + gumbel(i, seed)
                rows.append((i, len(found), len(buckets), weight, score))
            yield rows

    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    return map_rows(id_text(docs), weighed, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Every document with its weight and score, and its rank if it is drawn:
    ``percent`` of the documents of at least ``least_words`` words, by score."""
    every = stored(scored(docs, gains(docs, target, longest, buckets), longest, seed))
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    drawn = every.where(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id"), F.col("weight"), F.col("n_features")]
    ranked = global_row_number(every.where(able), order, "rank")
    rest = every.where(~able).withColumn("rank", F.lit(None).cast("long"))
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", rank.alias("rank"), "n_words")
