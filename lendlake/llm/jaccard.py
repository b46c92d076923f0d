"""N-gram Jaccard join with token-combination prefixes (op2).

A document's tokens are its distinct 5-word shingles (64-bit hashes). Two
documents link when their sets have a Jaccard similarity of at least 0.75.

1. *Which shingles are shared.* Every chunk sends its sorted shingle hashes to
   buckets of the hash range and learns which of them other documents have
   too. A set of n shingles that links has at least ceil(0.75 n) shared ones;
   documents with fewer can't link and need nothing further.
2. *Classes of equal sets.* The rest is grouped by a 128-bit digest of the
   set; one representative stands for each class.
3. *Near copies first.* Representatives with an equal min-hash are verified
   against one of them, and the links found are contracted.
4. *Prefixes.* Representatives order their shared shingles by class, rare
   ones first. If two sets must share ``a`` of ``s`` shingles, they share one of
   the first ``s - a + 1``, and ``j`` more among ``j`` more. Frequent shingles fall
   into ``j`` groups by hash and the prefix is extended by ``j``, so similar sets
   share a rare shingle, or two frequent ones of a group: rare shingles are
   indexed singly, frequent ones by pairs within their group (``j`` follows the
   set size, so the pairs stay in proportion to it). Sets of seven or fewer
   index their frequent shingles singly too.
5. *Verification.* Members of a signature's group are verified on their
   shingles against one of them, for a few rounds, skipping what is connected
   already; so a large group of near copies costs a few comparisons a member,
   not all pairs. What is still unconnected is compared in full: all pairs in
   groups of up to ``RARE`` members, pairs of blocks of sets in larger ones.
6. *Components.* Links contract to components (smallest doc_id reachable).

Cases: a text without words (null or empty) has an empty set, links with
nothing and is its own component; with fewer than five words the whole
sequence is the only shingle; equal texts, also under one doc_id, are one
class; rows that share a doc_id but differ in their text are judged each, and a
component is named by the least doc_id of its rows; rows without doc_id are left
out; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm import chunks as C
from lendlake.llm.graph import components
from lendlake.llm.tables import map_rows, stored

SIZE = 5
#: Seed with which xxhash64 gives what the SQL function of that name does.
HASH_SEED = 42
PERCENT = 75
#: Shingles of more representatives than this are frequent.
RARE = 16
#: Bits of the map of frequent shingles (1 MB, whatever the corpus); a rare
#: shingle that shares its bit with a frequent one is treated as frequent.
MAP_BITS = 23
#: Min-hashes whose groups are merged before the prefixes are indexed.
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: How often groups of a signature are compared with one of their members
#: before what is still unconnected is compared in full.
STAR_ROUNDS = 2
#: Members of a block when a large group has to be compared in full.
BLOCK = 256
#: Bits of a shingle hash by which buckets compare: a false agreement keeps a
#: document for the exact steps, no more.
BITS = 40

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


class _Hashes(dict):
    """Word hashes, kept for the words of one chunk."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: bytes | None, known: _Hashes, size: int = SIZE) -> np.ndarray:
    """The text's distinct shingles as ascending 64-bit hashes."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = C.mix(out ^ h[j : len(h) - k + 1 + j])
    return np.unique(out)


def _need(n):
    """The least overlap that a set of n must have with any set it links to."""
    return -(-n * PERCENT // 100)


def _sets(chunk: C.Chunk) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each document's shingles; the chunk's distinct ones at BITS bits, and
    which of these two documents of the chunk have."""
    known = _Hashes()
    sets = [shingle_hashes(t, known) for _, t in chunk.texts()]
    every = np.sort(np.concatenate([np.unique(s >> np.uint64(64 - BITS)) for s in sets] or [np.empty(0, np.uint64)]))
    first = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.empty(0, bool)
    at = np.flatnonzero(first)
    return sets, every[first], np.diff(np.concatenate([at, [len(every)]])) > 1


def _hash_blobs(batches: Iterator[list], buckets: int) -> Iterator[list]:
    for columns in batches:
        for row in zip(*columns):
            chunk = C.unpack(*row)
            _, mine, _ = _sets(chunk)
            cut = C.by_bucket(mine, BITS, buckets)
            yield [
                (b, chunk.chunk, C.pack_sorted(mine[cut[b] : cut[b + 1]]))
                for b in range(buckets)
                if cut[b + 1] > cut[b]
            ]


def _survivors(batches: Iterator[list], buckets: int) -> Iterator[list]:
    """(doc_id, n, text_hash, digest, shared): shared is null for documents that can't link."""
    for columns in batches:
        for chunk, n, payload, answers in zip(*columns):
            c = C.unpack(chunk, n, payload)
            sets, mine, local = _sets(c)
            cut = C.by_bucket(mine, BITS, buckets)
            shared = local.copy()
            for a in answers or ():
                lo, hi = cut[a["bucket"]], cut[a["bucket"] + 1]
                bits = np.frombuffer(C.unsqueeze(a["flags"]), np.uint8)
                shared[lo:hi] |= np.unpackbits(bits, count=hi - lo).astype(bool)
            rows = []
            for (i, text), s in zip(c.texts(), sets):
                text_hash = int(np.uint64(xxhash.xxh64_intdigest(text or b"", HASH_SEED)).view(np.int64))
                keep = s[shared[np.searchsorted(mine, s >> np.uint64(64 - BITS))]] if len(s) else s
                if len(s) and len(keep) >= _need(len(s)):
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    rows.append((i, len(s), text_hash, digest, keep.tobytes()))
                else:
                    rows.append((i, len(s), text_hash, None, None))
            yield rows


def _token_blobs(batches: Iterator[list], buckets: int) -> Iterator[list]:
    """The representatives' shingles with counts, packed by bucket."""
    for (sets,) in batches:
        tokens, counts = np.unique(
            np.concatenate([np.frombuffer(s, np.uint64) for s in sets]), return_counts=True
        )
        cut = C.by_bucket(tokens, 64, buckets)
        yield [
            (b, C.pack_sorted(tokens[cut[b] : cut[b + 1]]), C.squeeze(counts[cut[b] : cut[b + 1]].astype("<u4").tobytes()))
            for b in range(buckets)
            if cut[b + 1] > cut[b]
        ]


def _frequent_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """64-bit words of the map of frequent shingles that a bucket sets."""
    tokens = np.concatenate([C.unpack_sorted(b) for b in pdf["payload"]])
    counts = np.concatenate([np.frombuffer(C.unsqueeze(b), "<u4") for b in pdf["counts"]])
    tokens, at = np.unique(tokens, return_inverse=True)
    often = tokens[np.bincount(at, weights=counts) > RARE]
    bit = np.unique(often & np.uint64((1 << MAP_BITS) - 1))
    word, at = np.unique(bit >> np.uint64(6), return_inverse=True)
    bits = np.zeros(len(word), np.uint64)
    np.bitwise_or.at(bits, at, np.uint64(1) << (bit & np.uint64(63)))
    return pd.DataFrame({"word": word.astype(np.int64), "bits": bits.view(np.int64)})


def frequent_map(reps: DataFrame, buckets: int) -> np.ndarray:
    """The map of frequent shingles: at most 2**MAP_BITS bits reach the driver."""
    blobs = map_rows(reps.select("shared"), lambda it: _token_blobs(it, buckets), "bucket int, payload binary, counts binary")
    words = (
        blobs.groupBy("bucket")
        .applyInPandas(_frequent_words, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
    )
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in words.toLocalIterator():
        out[r.word] = r.bits
    return out.view(np.uint64)


def _level(n: int) -> int:
    return n.bit_length() - 1


def _pairs_at(order: np.ndarray, rare: int, length: int, level: int) -> np.ndarray:
    """Signatures of the frequent part of a prefix, for partners of which the
    larger has 2**level shingles or more."""
    groups = max(4, (1 << level) >> 3)
    many = np.sort(order[rare : length + groups])
    of = (many >> np.uint64(11)) % np.uint64(groups)
    out = [np.empty(0, np.uint64)]
    by = np.argsort(of, kind="stable")
    edges = np.flatnonzero(np.diff(of[by])) + 1
    for t in np.split(many[by], edges):
        if len(t) > 1:
            a, b = np.triu_indices(len(t), 1)
            out.append(C.mix(C.mix(t[a] + np.uint64(level)) ^ t[b]))
    return np.concatenate(out)


def signatures(n: int, shared: np.ndarray, often: np.ndarray) -> np.ndarray:
    """What a set of ``n`` shingles is indexed by."""
    length = len(shared) - _need(n) + 1
    rare = int((~often).sum())
    order = np.concatenate([shared[~often], shared[often]])  # within a class by hash
    out = [order[: min(length, rare)]]
    if rare < length:
        level = _level(n)
        if level <= 2:
            out.append(order[rare:length])
        else:
            out.append(_pairs_at(order, rare, length, level))
        if 4 * n >= 3 << (level + 1):  # its partners may be a level up
            if level + 1 > 2:
                out.append(_pairs_at(order, rare, length, level + 1))
    return np.unique(np.concatenate(out)).view(np.int64)


def _prefix_rows(batches: Iterator[list], frequent: np.ndarray) -> Iterator[list]:
    for reps, sizes, sets in batches:
        for rep, n, packed in zip(reps, sizes, sets):
            s = np.frombuffer(packed, np.uint64)
            bit = s & np.uint64((1 << MAP_BITS) - 1)
            often = (frequent[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            yield [(v, rep, n) for v in signatures(n, s, often).tolist()]


def _min_hashes(batches: Iterator[list]) -> Iterator[list]:
    for reps, sizes, sets in batches:
        rows = []
        for rep, n, packed in zip(reps, sizes, sets):
            s = np.frombuffer(packed, np.uint64)
            rows += [(int(C.mix(s ^ np.uint64(seed)).min().view(np.int64)), rep, n) for seed in SEEDS]
        yield rows


def _links(n1: int, a: np.ndarray, n2: int, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (n1 + n2 - both)


def _verified(batches: Iterator[list]) -> Iterator[list]:
    for columns in batches:
        yield [
            (a, b)
            for a, n1, s1, b, n2, s2 in zip(*columns)
            if _links(n1, np.frombuffer(s1, np.uint64), n2, np.frombuffer(s2, np.uint64))
        ]


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n1"), F.col("shared").alias("s1"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n2"), F.col("shared").alias("s2"))
    rows = pairs.select("a", "b").distinct().join(one, "a").join(two, "b")
    return map_rows(rows.select("a", "n1", "s1", "b", "n2", "s2"), _verified, "a long, b long")


def _sizes_fit(a: str, b: str):
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _stars(entries: DataFrame, seed: int = 0) -> DataFrame:
    """Each member of a signature's group with one member of it, unless they
    are connected already: (a, b)."""
    mark = F.xxhash64(F.lit(seed), "rep")
    first = (
        entries.groupBy("sig")
        .agg(F.min_by(F.struct("rep", "n", "comp"), mark).alias("first"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .where("lo <> hi")
        .select("sig", "first")
    )
    return (
        entries.join(first, "sig")
        .where((F.col("first.comp") != F.col("comp")) & _sizes_fit("n", "first.n"))
        .select(F.least("first.rep", "rep").alias("a"), F.greatest("first.rep", "rep").alias("b"))
    )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each two sets."""
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.cumsum(counts > 1) - 1  # only shingles of two members count
    row, column = row[counts[at] > 1], column[at][counts[at] > 1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [lo, lo + width])
        x = np.zeros((len(sets), width), np.float32)
        x[row[i:j], column[i:j] - lo] = 1
        out += x @ x.T
    return out


def _in_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a group that connect what wasn't yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    both = _overlaps([np.frombuffer(s, np.uint64) for s in pdf["shared"]])
    n = pdf["n"].to_numpy(np.int64)
    links = 100 * both >= PERCENT * (n[:, None] + n[None, :] - both)
    comp, rep = pdf["comp"].tolist(), pdf["rep"].tolist()
    out = []
    for x, y in np.argwhere(np.triu(links, 1)).tolist():
        if find(comp[x]) != find(comp[y]):
            root[find(comp[x])] = find(comp[y])
            out.append((rep[x], rep[y]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _connected(entries: DataFrame, links: DataFrame) -> DataFrame:
    """The entries with the component that their representative has so far."""
    comps = components(links).select(F.col("node").alias("rep"), F.col("root").alias("now"))
    return entries.join(comps, "rep", "left").withColumn("comp", F.coalesce("now", "rep")).drop("now")


def _merged_groups(large: DataFrame) -> DataFrame:
    """Large groups (sig, rep, comp, m), those with common members merged to
    one where comparing the union takes fewer comparisons than each group."""
    if large.isEmpty():
        return large
    at = -F.abs(F.shiftright("sig", 1)) - 1  # below every doc_id that is joined here
    nodes = components(large.select(F.col("rep").alias("a"), at.alias("b")))
    rows = stored(
        large.withColumn("a", F.col("rep")).join(nodes.withColumnRenamed("node", "a"), "a").select("sig", "rep", "comp", "m", "root")
    )
    each = rows.select("root", "sig", "m").distinct().groupBy("root").agg(F.sum(F.col("m") * F.col("m")).alias("apart"))
    union = rows.select("root", "rep", "comp").distinct()
    size = union.groupBy("root").agg(F.count("*").alias("all"))
    best = each.join(size, "root").select("root", "all", (F.col("all") * F.col("all") <= F.col("apart")).alias("merge"))
    merged = union.join(best.where("merge"), "root").select(F.col("root").alias("sig"), "rep", "comp", F.col("all").alias("m"))
    return rows.join(best.where("NOT merge").select("root"), "root", "left_semi").select("sig", "rep", "comp", "m").union(merged)


def _leftover_links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a signature's group that aren't connected yet."""
    mark = F.xxhash64("rep")
    groups = (
        entries.groupBy("sig")
        .agg(
            F.count("*").alias("m"),
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.bit_xor(mark).alias("x"),
            F.sum(F.pmod(mark, F.lit(1 << 30))).alias("y"),
        )
        .where("lo <> hi")
        .groupBy("m", "x", "y")  # groups of the same members are compared once
        .agg(F.min("sig").alias("sig"))
        .select("sig", "m")
    )
    left = stored(entries.join(groups, "sig"))
    small, large = left.where(F.col("m") <= RARE), left.where(F.col("m") > RARE)
    other = small.select("sig", F.col("rep").alias("rep2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"))
    pairs = (
        small.join(other, "sig")
        .where((F.col("rep") < F.col("rep2")) & (F.col("comp") != F.col("comp2")) & _sizes_fit("n", "n2"))
        .select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    )
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    placed = _merged_groups(large).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    copies = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "sig", "rep", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    in_blocks = (
        copies.join(sets, "rep")
        .groupBy("sig", "i", "j")
        .applyInPandas(_in_block, "a long, b long")
    )
    return verify(pairs, sets).union(in_blocks)


def _placed(docs: DataFrame) -> DataFrame:
    """One row for each document with doc_id: doc_id, n, text_hash, component_id,
    and root, the component's number (null: it can't link)."""
    chunked = C.pack_chunks(docs)
    size = chunked.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    buckets = C.bucket_count(3 * size)
    blobs = map_rows(chunked, lambda it: _hash_blobs(it, buckets), "bucket int, chunk long, payload binary")
    answered = C.with_answers(chunked, C.shared_flags(blobs))
    scanned = stored(
        map_rows(
            answered.select("chunk", "n", "payload", "answers"),
            lambda it: _survivors(it, buckets),
            "doc_id long, n int, text_hash long, digest binary, shared binary",
        )
    )
    maybe = scanned.where("digest IS NOT NULL")
    # Classes get numbers of their own: rows with one doc_id may hold different texts.
    numbered = maybe.groupBy("digest").agg(F.min("doc_id").alias("first"))
    classes = stored(numbered.withColumn("rep", F.monotonically_increasing_id()))
    sets = stored(
        maybe.join(classes, (maybe["digest"] == classes["digest"]) & (maybe["doc_id"] == classes["first"]))
        .select("rep", "n", "shared")
        .dropDuplicates(["rep"])
    )
    frequent = sets.sparkSession.sparkContext.broadcast(frequent_map(sets, buckets))
    alike = map_rows(sets, _min_hashes, "sig long, rep long, n int").withColumn("comp", F.col("rep"))
    links = stored(verify(_stars(alike), sets))
    entries = stored(
        map_rows(sets, lambda it: _prefix_rows(it, frequent.value), "sig long, rep long, n int")
    )
    for seed in range(1, STAR_ROUNDS + 1):
        links = stored(links.union(verify(_stars(_connected(entries, links), seed), sets)))
    links = stored(links.union(_leftover_links(_connected(entries, links), sets)))
    final = components(links)
    roots = classes.join(final, classes["rep"] == final["node"], "left")
    roots = stored(roots.select("digest", "first", F.coalesce("root", "rep").alias("root")))
    leasts = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(leasts, "root").select("digest", "root", "component_id")
    placed = maybe.select("doc_id", "n", "text_hash", "digest").join(named, "digest")
    alone = scanned.where("digest IS NULL").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")})
    columns = ["doc_id", "n", "text_hash", "component_id", "root"]
    return placed.select(*columns).union(alone.select(*columns))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each document with doc_id: doc_id, n_shingles, component_id."""
    return _placed(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are the first of their
    component: of each group the row of least doc_id stays (one row, if several
    have it), and of equal rows without words one. Rows without doc_id stay."""
    rows = _placed(docs)
    least = F.min(F.struct("doc_id", "text_hash")).alias("row")
    of_groups = rows.where("root IS NOT NULL").groupBy("root").agg(least).select("row.*")
    alone = rows.where("root IS NULL").select("doc_id", "text_hash").distinct()
    firsts = of_groups.union(alone).toDF("first_id", "first_hash")
    own = next(c for c in (f"text_hash{k}" for k in count()) if c not in docs.columns)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    hashed = docs.where(docs["doc_id"].isNotNull()).withColumn(own, F.xxhash64(text))
    same = (hashed["doc_id"].cast("long") == firsts["first_id"]) & (hashed[own] == firsts["first_hash"])
    kept = hashed.join(firsts, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
    return kept.unionByName(docs.where(docs["doc_id"].isNull()))
