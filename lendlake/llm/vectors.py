"""Near-duplicate vectors by randomised-rotation binary codes (op10).

Equal vectors of a label are one class first. Each class vector is scaled to
unit length and rotated by a fixed random rotation; its code is the signs of
its coordinates, stored with the correction factor f = <rotated, code> (the
code scaled to unit length). For a pair, <x, code of y> / f(y) is an unbiased
estimate of the cosine, within EPSILON sqrt((1 - f^2) / f^2 / (D - 1)) with very high
probability. Pairs whose upper bound reaches the threshold are recomputed exactly in
double precision; only those that reach it link.

Candidates: several tables, each keyed by the signs of fresh random projections, so
that tables miss independently of each other; the number of bits follows the label's
size, and the number of tables is such that a pair at the threshold shares a key with
probability RECALL, at any size. A pair is looked at in the first
table that it shares only. Groups larger than BLOCK are compared by pairs of
blocks, so no group is ever in one task. What leaves a task are link counts and
one edge for each linked vector, not pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite values, and
vectors without a label, link with nothing and are their own component; vectors of
different lengths never link; equal rows are other vectors to each other; rows without
vec_id are left out; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.llm.graph import components
from lendlake.llm.tables import map_rows, stored

THRESHOLD = 0.93
EPSILON = 3.0
RECALL = 0.99
#: Class vectors that a key's group has on average.
GROUP = 512
BLOCK = 1024
SEED = 7


@functools.cache
def rotation(dim: int) -> np.ndarray:
    """The same random rotation everywhere."""
    q, r = np.linalg.qr(np.random.RandomState(SEED).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated vectors, signs as +-1, correction factors)."""
    x = unit @ rotation(unit.shape[1])
    signs = np.where(x >= 0, 1.0, -1.0)
    return x, signs, (x * signs).sum(1) / math.sqrt(x.shape[1])


def tables_for(n: int, dim: int, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a key, tables) for a label with n class vectors; one table without
    keys, so that all blocks of a label meet, for a recall of 1."""
    if recall >= 1:
        return 0, 1
    bits = min(dim, 32, max(0, math.ceil(math.log2(max(1, n) / GROUP))))
    agree = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(1 - recall) / math.log(1 - agree))


@functools.cache
def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    """The same independent normal directions everywhere: (table, dim, bit)."""
    return np.random.RandomState(SEED + 1).normal(size=(tables, dim, bits))


def keys_of(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Each vector's key in each table: its sides of the table's planes."""
    out = np.zeros((len(unit), tables), np.int64)
    for t, p in enumerate(planes(unit.shape[1], bits, tables)):
        out[:, t] = (unit @ p > 0) @ (np.int64(1) << np.arange(bits))
    return out


def _valid(batches: Iterator[list]) -> Iterator[list]:
    for ids, labels, lists in batches:
        rows = []
        for i, label, v in zip(ids, labels, lists):
            x = np.array(v or (), np.float64)
            # A label, and a finite vector with a length: all else links with nothing.
            with np.errstate(over="ignore"):
                good = label is not None and len(x) > 0 and np.isfinite(x).all() and 0 < np.linalg.norm(x) < np.inf
            rows.append((i, label, x.tobytes() if good else None))
        yield rows


def _entries(batches: Iterator[list], recall: float) -> Iterator[list]:
    for reps, copies, vecs, sizes, labels, dims in batches:
        rows = []
        alike: dict[tuple[int, int], list[int]] = {}  # rows whose keys are made alike
        for r, (v, n) in enumerate(zip(vecs, sizes)):
            alike.setdefault((n, len(v)), []).append(r)
        for (n, _), part in alike.items():
            x = np.stack([np.frombuffer(vecs[r]) for r in part])
            bits, tables = tables_for(n, x.shape[1], recall)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            for r, keys in zip(part, keys_of(unit, bits, tables).tolist()):
                rows += [(reps[r], copies[r], vecs[r], n, labels[r], dims[r], t, k) for t, k in enumerate(keys)]
        yield rows


def _compared(key: tuple, pdf: pd.DataFrame, recall: float) -> pd.DataFrame:
    """Links within a block, or between two: (rep, links, root of its part)."""
    _, _, table, _, i, j = key
    pdf = pdf.sort_values("rep")
    x = np.stack([np.frombuffer(v) for v in pdf["vec"]])
    norm = np.linalg.norm(x, axis=1)
    rotated, signs, f = codes(x / norm[:, None])
    keys = keys_of(x / norm[:, None], *tables_for(int(pdf["n"].iloc[0]), x.shape[1], recall))
    rep, m, block = pdf["rep"].to_numpy(), pdf["m"].to_numpy(), pdf["block"].to_numpy()
    bound = EPSILON * np.sqrt(np.maximum(0, 1 - f**2) / f**2 / max(1, x.shape[1] - 1))
    links = np.zeros(len(rep), np.int64)
    root = np.arange(len(rep))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a in range(0, len(rep), 256):
        part = slice(a, a + 256)
        near = (rotated[part] @ signs.T) / math.sqrt(x.shape[1]) / f + bound >= THRESHOLD
        near &= np.arange(len(rep))[None, :] > np.arange(len(rep))[part][:, None]
        if i != j:
            near &= block[None, :] != block[part][:, None]
        for t in range(table):
            near &= keys[None, :, t] != keys[part, None, t]
        one, two = np.nonzero(near)
        one += a
        for lo in range(0, len(one), 1 << 14):
            u, v = one[lo : lo + (1 << 14)], two[lo : lo + (1 << 14)]
            linked = (x[u] * x[v]).sum(1) / (norm[u] * norm[v]) >= THRESHOLD
            u, v = u[linked], v[linked]
            np.add.at(links, u, m[v])
            np.add.at(links, v, m[u])
            for p, q in zip(u.tolist(), v.tolist()):
                p, q = find(p), find(q)
                root[max(p, q)] = min(p, q)
    own = np.flatnonzero(links)
    return pd.DataFrame({"a": rep[own], "links": links[own], "b": rep[[find(k) for k in own]]}).astype("int64")


def near_vectors(rows: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    ``recall`` is the probability that a pair at the threshold is found (a closer
    one: more). With 1 the result is exact: each label's vectors are compared by
    all pairs of blocks, at a cost that grows with the square of its size.
    """
    read = rows.select(
        rows["vec_id"].cast("long"), rows["label"].cast("string"), rows["embedding"].cast("array<double>")
    ).where("vec_id IS NOT NULL")
    valid = stored(map_rows(read, _valid, "vec_id long, label string, vec binary"))
    usable = valid.where("vec IS NOT NULL")
    classes = usable.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    dim = F.octet_length("vec") / 8
    classes = stored(classes.withColumn("dim", dim.cast("int")))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    sized = classes.join(sizes, ["label", "dim"])
    entries = map_rows(
        sized.select("rep", "m", "vec", "n", "label", "dim"),
        lambda it: _entries(it, recall),
        "rep long, m long, vec binary, n long, label string, dim int, table int, key long",
    )
    keyed = stored(entries)
    where = ["label", "dim", "table", "key"]
    blocks = F.ceil(F.count("*") / F.lit(BLOCK)).cast("int")
    groups = keyed.groupBy(*where).agg(blocks.alias("blocks"), F.count("*").alias("size")).where("size > 1")
    block: Column = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    copies = (
        keyed.join(groups, where)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select(*where, "i", "j", "rep", "m", "vec", "n", "block")
    )

    def compared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _compared(key, pdf, recall)

    found = stored(
        copies.groupBy("label", "dim", "table", "key", "i", "j").applyInPandas(compared, "a long, links long, b long")
    )
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b"))
    members = valid.join(classes, ["label", "vec"], "left")
    component = F.coalesce("root", "rep", "vec_id")
    return (
        members.join(links, members["rep"] == links["a"], "left")
        .join(roots, members["rep"] == roots["node"], "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("m") - 1, F.lit(0))).alias("n_links"),
            component.alias("component_id"),
            (F.col("vec_id") == component).alias("kept"),
        )
    )
