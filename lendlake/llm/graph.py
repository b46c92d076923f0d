"""Connected components by alternating stars.

Cases: pairs of a node with itself, repeated pairs and either direction mean the
same; a null end makes no link; no pairs give no rows.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.session import checkpoint_dir
from lendlake.sources.files import Files


def components(edges: DataFrame, each_round: Callable[[int], None] = lambda n: None) -> DataFrame:
    """From ``(a long, b long)`` the component of each node that has an edge to another:
    ``(node, root)``, the root being the smallest node of the component.

    A large star links all greater neighbours of a node to the smallest of it and its
    neighbours, a small star does so with the smaller ones; neither takes a component
    apart. In turn they make a component a star around its smallest node, in
    a number of rounds that grows with the logarithm of its size, whatever the order of the
    ids along a chain (at most 12 for chains of 2,000). The pairs never grow in
    number, a node's neighbours never meet in one task (their minimum combines before the
    shuffle; Spark splits the join of a hot node), and each round's table replaces the one
    before in the shared folder.
    """
    spark = edges.sparkSession
    folder = posixpath.join(checkpoint_dir(spark), f"llm-components-{uuid.uuid4().hex}")
    files = Files(spark, folder)

    def store(df: DataFrame, name: str) -> DataFrame:
        path = posixpath.join(folder, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = store(links.where("a <> b AND a IS NOT NULL AND b IS NOT NULL").distinct(), "0")
    for n in count(1):
        if _settled(pairs):
            break
        each_round(n)
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("to").alias("b"))
        large = store(large, f"{n}-large")
        least = large.groupBy("a").agg(F.min("b").alias("to"))
        small = large.join(least, "a").where("b <> to").select(F.col("b").alias("a"), F.col("to").alias("b"))
        pairs = store(small.union(least).distinct(), f"{n}")
        for done in (f"{n - 1}", f"{n}-large"):
            files.delete(posixpath.join(folder, done))
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(pairs.select("b", "b").distinct())


def _settled(pairs: DataFrame) -> bool:
    """Whether all pairs form stars: each node above has one node below, which is
    above no other."""
    above = pairs.select(F.col("a").alias("node"), F.col("b").alias("low"))
    seen = above.union(pairs.select("b", F.lit(None).cast("long")))
    many = (F.col("lowest") != F.col("highest")) | (F.col("lowest").isNotNull() & (F.col("rows") > F.col("lows")))
    found = seen.groupBy("node").agg(
        F.min("low").alias("lowest"), F.max("low").alias("highest"), F.count("low").alias("lows"), F.count("*").alias("rows")
    )
    return found.where(many).isEmpty()
