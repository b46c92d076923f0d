"""Prefix trie of conversations by blocks of turns (op13).

Conversations are rebuilt (``rebuilt_blocks``) in one sorted stream: those that
share a first part lie in one family of twenty, the one that gives it first. The
stream cuts each into blocks of BLOCK turns. A block's key is a digest of the key
before it and its turns' digests, so it names the whole sequence up to its end.

Conversations are grouped by block keys first: one hash aggregation gives each
distinct block with its members. Only where the blocks that follow the same
sequence differ, siblings, are turn boundaries looked at: the distinct sibling blocks
(not their conversations) are cut into turns and grouped again. Elsewhere the turns
of a block have its members as they are.

Subtree sums need no walk down the trie. A conversation represents the nodes whose
smallest member it is, from some depth on to its end. Of its words, R lie before
that depth; these others store for it, and a node's saved words are

    sum of R over its members - R of its own conversation - (members - 1) * words above it.

Its leaves are the members that represent a childless node. So both are sums over
members, made in the same two steps as the members' counts. All aggregations
combine before their shuffle; a node's children reach its row by way of
(parent, part) pairs, so a node with very many children is spread over PARTS tasks;
the ids that end at a node are packed in ranges of the total order before they
meet, and hashed as a stream. A conversation itself is streamed in one task,
in memory of one block.

Cases: rows without conv_id are left out; null role or text is empty; turns of
equal number go by the digest of role and text, repeated rows are turns of their
own; a conversation without turns of its own or of its base ends at the root; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import crc_mod, map_rows, stored

BLOCK = 4
FAMILY = 20
SHARED = 4  # a conversation takes over 0 to 3 turns
PARTS = 256
SEGMENT = 1 << 15  # bytes of ids packed in a row

ROOT = bytes(16)
_DIGEST = 16

_BLOCKS = (
    "conv_id long, before binary, key binary, start long, n int, digests binary, words binary, "
    "above long, total long, ends boolean"
)


def _key(before: bytes, digests: bytes) -> bytes:
    return hashlib.blake2b(before + digests, digest_size=_DIGEST).digest()


class _Blocks:
    """The blocks of one conversation, given its turns one after the other."""

    def __init__(self, conv_id: int, out: list[tuple]):
        self.conv_id, self.out = conv_id, out
        self.before, self.start, self.above = ROOT, 0, 0
        self.digests: list[bytes] = []
        self.words: list[int] = []

    def add(self, digest: bytes, words: int) -> None:
        if len(self.digests) == BLOCK:
            self._close(False)
        self.digests.append(digest)
        self.words.append(words)

    def _close(self, ends: bool) -> None:
        digests, n = b"".join(self.digests), len(self.digests)
        key = _key(self.before, digests) if n else ROOT
        total = self.above + sum(self.words)
        packed = struct.pack(f"<{n}q", *self.words)
        self.out.append((self.conv_id, self.before, key, self.start, n, digests, packed, self.above, total, ends))
        self.before, self.start, self.above = key, self.start + n, total
        self.digests, self.words = [], []

    def close(self) -> None:
        self._close(True)


def rebuilt_blocks(conversations: DataFrame) -> DataFrame:
    """The rebuilt conversations in blocks, one row each; the last one ``ends``."""
    c = conversations
    turns = c.select(
        c["conv_id"].cast("long").alias("conv_id"),
        c["turn"].alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = turns.select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"),
        "conv_id",
        "turn",
        F.substring(F.unhex(F.sha2(whole, 256)), 1, _DIGEST).alias("digest"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = ["family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    streamed = (
        rows.repartition("family")
        .sortWithinPartitions(*order)
        .select("family", "conv_id", "digest", "words", crc_mod("conv_id", SHARED).alias("shared"))
    )

    def cut(batches: Iterator[list]) -> Iterator[list]:
        family = current = None
        heads: list[tuple[bytes, int]] = []  # the first turns of the family's base
        blocks: _Blocks | None = None
        own = 0
        out: list[tuple] = []
        for columns in batches:
            for f, c, digest, words, shared in zip(*columns):
                if c != current:
                    if blocks:
                        blocks.close()
                    if f != family:
                        family, heads = f, []
                    current, own, blocks = c, 0, _Blocks(c, out)
                    if c != f:
                        for turn in heads[:shared]:
                            blocks.add(*turn)
                if c == f:  # the base's first turns are its own
                    if own < SHARED - 1:
                        heads.append((digest, words))
                    blocks.add(digest, words)
                elif own >= shared:
                    blocks.add(digest, words)
                own += 1
                if len(out) >= 4096:
                    yield out
                    out = blocks.out = []
        if blocks:
            blocks.close()
        yield out

    return map_rows(streamed, cut, _BLOCKS)


_TURNS = (
    "key binary, node binary, parent binary, depth long, words long, above long, "
    "conv_id long, n_convs long, alone boolean"
)


def _turns(batches: Iterator[list]) -> Iterator[list]:
    """The nodes along each distinct block."""
    for columns in batches:
        rows = []
        for before, key, start, n, digests, packed, above, conv_id, n_convs, alone in zip(*columns):
            parent = before
            for j, words in enumerate(struct.unpack(f"<{n}q", packed), 1):
                node = _key(before, digests[: j * _DIGEST])
                rows.append((key, node, parent, start + j, words, above, conv_id, n_convs, alone))
                parent, above = node, above + words
        yield rows


def _end_digests(blocks: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the ids that end at each node, ascending, hashed."""
    ends = blocks.where("ends").select("key", "conv_id")

    def packed(batches: Iterator[list]) -> Iterator[list]:
        held: list[str] = []
        key = first = None
        size = 0
        for keys, ids in batches:
            out = []
            for k, i in zip(keys, ids):
                if held and (k != key or size > SEGMENT):
                    out.append((key, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    key, first = k, i
                held.append(str(i))
                size += len(held[-1]) + 1
            yield out
        if held:
            yield [(key, first, ",".join(held))]

    def hashed(batches: Iterator[list]) -> Iterator[list]:
        key = digest = None
        for keys, _, parts in batches:
            out = []
            for k, part in zip(keys, parts):
                if k == key:
                    digest.update(b",")
                else:
                    if digest:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(part.encode())
            yield out
        if digest:
            yield [(key, digest.hexdigest())]

    ranged = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    segments = map_rows(ranged, packed, "node binary, first long, ids string")
    joined = segments.repartition("node").sortWithinPartitions("node", "first")
    return map_rows(joined, hashed, "node binary, ends_sha256 string")


def _folded(rows: DataFrame, keys: list[str], *sums) -> DataFrame:
    """Turn rows as nodes: those of a block without siblings are nodes already, the
    rest is grouped."""
    plain = rows.where("alone").select(*keys, *[x for x, _ in sums])
    grouped = rows.where("NOT alone").groupBy(*keys).agg(*[x for _, x in sums])
    return plain.unionByName(grouped)


def nodes(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    blocks = stored(rebuilt_blocks(conversations))
    described = ["before", "key", "start", "n", "digests", "words", "above"]
    distinct = blocks.where("n > 0").groupBy(*described).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    # The key of the only block that follows some sequence.
    only = distinct.groupBy("before").agg(F.count(F.lit(1)).alias("blocks"), F.max("key").alias("key"))
    only = only.where("blocks = 1").select("key", F.lit(True).alias("alone"))
    marked = distinct.join(only, "key", "left").withColumn("alone", F.coalesce("alone", F.lit(False)))
    turns = stored(map_rows(marked.select(*described, "conv_id", "n_convs", "alone"), _turns, _TURNS))

    found = _folded(
        turns, ["node", "parent", "depth", "words", "above"],
        (F.col("conv_id"), F.min("conv_id").alias("conv_id")),
        (F.col("n_convs"), F.sum("n_convs").alias("n_convs")),
    )
    ends = blocks.where("ends")
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), zero.alias("depth"),
        zero.alias("words"), zero.alias("above"), "conv_id", "n_convs",
    )
    part = F.pmod(F.xxhash64("node"), F.lit(PARTS)).alias("part")
    found = stored(found.unionByName(root).select("*", part))

    below = found.where("depth > 0").groupBy("parent", "part").agg(F.count(F.lit(1)).alias("n"))
    children = below.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n_children"))
    owner = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    owner = below.select("parent", "part").join(owner, "parent")
    whole = stored(found.join(owner, ["parent", "part"], "left").join(children, "node", "left").drop("part"))

    # What each conversation brings to the sums of the nodes that it is a member of.
    leaf = F.col("n_children").isNull().cast("long")
    own = whole.groupBy("conv_id").agg(F.min("above").alias("first"), F.sum(leaf).alias("leaves"))
    brought = ends.select("conv_id", "total").join(own, "conv_id", "left").select(
        "conv_id",
        F.coalesce("first", "total").alias("before_own"),
        F.coalesce("leaves", F.lit(0)).cast("long").alias("leaves"),
    )
    brought = stored(brought)
    of_root = brought.agg(F.sum("before_own").alias("others"), F.sum("leaves").alias("leaves"))
    of_block = blocks.where("n > 0").select("conv_id", "key").join(brought, "conv_id").groupBy("key").agg(
        F.sum("before_own").alias("others"),
        F.sum("leaves").alias("leaves"),
        F.min(F.struct("conv_id", "before_own")).alias("least"),
    )
    sums = _folded(
        turns.select("key", "node", "alone").join(of_block, "key"), ["node"],
        (F.col("others"), F.sum("others").alias("others")),
        (F.col("leaves"), F.sum("leaves").alias("leaves")),
        (F.col("least"), F.min("least").alias("least")),
    ).select("node", (F.col("others") - F.col("least.before_own")).alias("others"), "leaves")
    sums = sums.unionByName(of_root.select(F.lit(ROOT).alias("node"), "others", "leaves"))

    saved = F.col("others") - (F.col("n_convs") - 1) * F.col("above")
    return (
        whole.join(sums, "node")
        .join(_end_digests(blocks), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            saved.alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
