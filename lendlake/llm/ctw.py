"""Language-model scores by context-tree weighting (op3).

The model reads lower-cased UTF-8 bytes. Each byte is decomposed into eight
binary decisions; each decision has a context tree over the preceding DEPTH
bytes. A node estimates its bit by Krichevsky-Trofimov from its counts, and
weights its own estimate against that of its children, half and half a
priori, so the prediction mixes the estimates of all depths. A context that
training never saw adds nothing: the walk ends at the deepest seen node. Byte
255, which no text has, stands before each text (as context) and ends it.

The counts of a batch determine the tree, so training is an aggregation:

1. Chunks count their distinct grams (DEPTH context bytes and the byte that
   follows) and send them, packed, to buckets by the hash of the two nearest
   context bytes: a bucket holds whole subtrees from depth 2 on.
2. A bucket adds up the counts, computes the weighted probabilities bottom up
   and predicts every gram from depth DEPTH to 2. What it adds to the nodes
   above is summed over the buckets: at most 256 x 255 nodes at depth 1.
3. With these the prediction of each gram is finished and goes back to the
   chunks that have it, which add up log10 P over whole texts.

The base score needs the training count of every word: words go to buckets by
their hash and the counts come back in the same way. No table of the model is
sent whole to any task; a chunk gets the rows that its text needs.

Cases: a null text counts as empty; an empty text has the end token only;
without training documents every decision has probability 1/2 and all counts
are 0; repeated documents count and are scored each; rows without doc_id are
left out; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm import chunks as C
from lendlake.llm.tables import crc_mod, map_rows, stored

DEPTH = 5
#: Contexts of fewer bytes than this are finished on the summed nodes.
TOP = 2
FOLDS, HELD_OUT = 7, 2
#: Chunks are larger here, as each sends its distinct grams once.
CHUNK_BYTES = 8 << 20
#: Bytes of a chunk that are looked at together.
_BATCH = 1 << 20

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_HALF = float(np.log(0.5))


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


# --- grams and words of a chunk ---------------------------------------------


def _text(chunk: C.Chunk, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts, each after ``depth`` and before one byte 255; where
    in it the bytes to predict of each text begin (one more: the end)."""
    pad = b"\xff"
    body = pad * depth + (pad * (depth + 1)).join((t or b"").translate(_LOWER) for _, t in chunk.texts()) + pad
    begin = np.concatenate([[0], np.cumsum(np.maximum(chunk.lens, 0) + 1 + depth)]) + depth
    return np.frombuffer(body, np.uint8), begin


def _keys(b: np.ndarray, depth: int, lo: int, hi: int) -> np.ndarray:
    """Grams of the bytes lo..hi: the context from the nearest byte on, then
    the byte itself."""
    out = np.zeros(hi - lo, np.uint64)
    for j in [*range(1, depth + 1), 0]:
        out <<= np.uint64(8)
        out |= b[lo - j : hi - j]
    return out


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ascending array and how often each occurs."""
    if not len(a):
        return a, np.empty(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return a[at], np.diff(np.concatenate([at, [len(a)]]))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return values, np.bincount(place, np.concatenate([p[1] for p in parts]), len(values)).astype(np.int64)


def _batches(begin: np.ndarray, depth: int) -> Iterator[tuple[int, int, int, int]]:
    """Texts i..j and their span of bytes to predict, a few megabytes each."""
    i = 0
    while i < len(begin) - 1:
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + _BATCH)))
        j = min(j, len(begin) - 1)
        yield i, j, int(begin[i]), int(begin[j] - depth)
        i = j


def grams(chunk: C.Chunk, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's distinct grams, ascending, and their training counts."""
    b, begin = _text(chunk, depth)
    train = np.array([not held_out(i) for i in chunk.ids.tolist()], bool)
    parts = []
    for i, j, lo, hi in _batches(begin, depth):
        keys = _keys(b, depth, lo, hi)
        use = np.repeat(train[i:j].astype(np.int8) * 2 - 1, np.diff(begin[i : j + 1]))[: hi - lo]
        gaps = (begin[i + 1 : j] - lo)[:, None] - np.arange(1, depth + 1)[None, :]
        use[gaps.ravel()] = 0  # the bytes 255 before a text are context only
        parts.append(_runs(np.sort(keys[use > 0])))
        rest, _ = _runs(np.sort(keys[use < 0]))
        parts.append((rest, np.zeros(len(rest), np.int64)))
    return _summed(parts) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _by_context(keys: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the grams by bucket, then key, and where each bucket begins."""
    near = keys >> np.uint64(8 * (depth + 1 - TOP))
    bucket = (C.mix(near) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    odd = 0x9E3779B97F4A7C15
    out = []
    for x in (odd, pow(odd, -1, 1 << 64)):
        factors = np.full(n + 1, x, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def _word_hashes(chunk: C.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and how many each text has. Words
    are told by these hashes: of polynomials in an odd number, scrambled."""
    data = np.frombuffer(chunk.data.translate(_LOWER), np.uint8)
    off = chunk.offsets
    hashes, counts = [], np.zeros(len(chunk.ids), np.int64)
    power, inverse = _powers(_BATCH + int(np.max(chunk.lens, initial=0)) + 1)
    code = C.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for i, j, lo, hi in _batches(off, 0):
        b = data[lo:hi]
        inside = (b != 32) & ((b < 9) | (b > 13))
        edge = off[i + 1 : j] - lo  # texts end words too
        edge = edge[(edge > 0) & (edge < len(b))]
        start, stop = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        start[edge] = inside[edge]
        stop[edge - 1] = inside[edge - 1]
        start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code[b] * power[: len(b)], dtype=np.uint64)])
        h = (total[stop] - total[start]) * inverse[start]
        hashes.append(C.mix(h ^ (stop - start).astype(np.uint64)))
        counts[i:j] = np.diff(np.searchsorted(start, off[i : j + 1] - lo))
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64), counts


def words(chunk: C.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the chunk's distinct words, ascending, and their training
    counts."""
    hashes, counts = _word_hashes(chunk)
    train = np.repeat([not held_out(i) for i in chunk.ids.tolist()], counts)
    rest, _ = _runs(np.sort(hashes[~train]))
    return _summed([_runs(np.sort(hashes[train])), (rest, np.zeros(len(rest), np.int64))])


class Lookup:
    """A hash table from uint64 keys to numbers, built and read by array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.filled = np.zeros(1 << bits, bool)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, values.dtype)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = ~self.filled[slot]
            self.keys[slot[free]] = keys[left[free]]
            self.filled[slot] = True
            won = self.keys[slot] == keys[left]
            self.values[slot[won]] = values[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9FB21C651E98DF25)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys, all of which are in the table."""
        slot = self._slot(keys)
        left = np.flatnonzero(self.keys[slot] != keys)
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            left = left[self.keys[slot[left]] != keys[left]]
        return self.values[slot]


def _blobs(batches: Iterator[list], depth: int, buckets: int) -> Iterator[list]:
    """(kind, bucket, chunk, payload, counts): grams are kind 0, words 1."""
    for columns in batches:
        for row in zip(*columns):
            chunk = C.unpack(*row)
            keys, counts = grams(chunk, depth)
            order, cut = _by_context(keys, depth, buckets)
            rows = _packed(0, chunk.chunk, keys[order], counts[order], cut)
            del keys, counts, order
            keys, counts = words(chunk)
            yield rows + _packed(1, chunk.chunk, keys, counts, C.by_bucket(keys, 64, buckets))


def _packed(kind: int, chunk: int, keys: np.ndarray, counts: np.ndarray, cut: np.ndarray) -> list[tuple]:
    return [
        (
            kind, b, chunk, C.squeeze(C.pack_sorted(keys[cut[b] : cut[b + 1]])),
            C.squeeze(counts[cut[b] : cut[b + 1]].astype("<u4").tobytes()),
        )
        for b in range(len(cut) - 1)
        if cut[b + 1] > cut[b]
    ]


# --- buckets -------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    z = x + 8.0
    rise = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    return (
        (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi)
        + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(rise)
    )


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of a zeros, b ones."""
    small = np.arange(4096.0)
    half, whole = _log_gamma(small + 0.5), _log_gamma(small + 1)

    def of(table: np.ndarray, n: np.ndarray, shift: float) -> np.ndarray:
        out = table[np.minimum(n, 4095).astype(np.int64)]
        far = n > 4095
        out[far] = _log_gamma(n[far] + shift)
        return out

    return of(half, a, 0.5) + of(half, b, 0.5) - np.log(np.pi) - of(whole, a + b, 1.0)


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, top: int = TOP):
    """Predict every gram from the depths ``depth`` to ``top`` (ascending keys).

    Returns (probability of each of the eight bits; whether any node of the
    walk was seen; nodes at depth top - 1 as ids, zeros, ones, and the summed
    log weighted probabilities of their children).
    """
    n = len(keys)
    p = np.full((n, 8), 0.5)
    seen = np.zeros((n, 8), bool)
    byte = (keys & np.uint64(255)).astype(np.int64)
    below: list[np.ndarray | None] = [None] * 8  # of each gram: its node's log weighted probability
    rows = np.arange(n)
    firsts = rows  # one gram for each (context, byte) of the current depth
    total = counts.astype(np.float64)
    nodes_up: list[tuple] = []
    for d in range(depth, top - 2, -1):
        context = keys >> np.uint64(8 * (depth + 1 - d)) if d else np.zeros(n, np.uint64)
        if d < depth:
            code = (context[firsts] << np.uint64(8)) | byte[firsts].astype(np.uint64)
            _, pick, merged = np.unique(code, return_index=True, return_inverse=True)
            total = np.bincount(merged, weights=total)
            firsts, rows = firsts[pick], merged[rows]
        ctx, sym = context[firsts], byte[firsts]
        for k in range(8):
            prefix = sym >> (8 - k)
            new = np.ones(len(firsts), bool)
            new[1:] = (ctx[1:] != ctx[:-1]) | (prefix[1:] != prefix[:-1])
            at, node = np.flatnonzero(new), np.cumsum(new) - 1
            one = (sym >> (7 - k)) & 1
            both = np.add.reduceat(total, at) if len(at) else total
            ones = np.add.reduceat(total * one, at) if len(at) else total
            zeros = both - ones
            children = np.zeros(len(at))
            if d < depth:
                child_node, value = below[k]
                parent = node[rows[child_node]]
                children = np.bincount(parent, weights=value, minlength=len(at))
            if d == top - 1:
                heap = (1 << k) | prefix[at]
                nodes_up.append(((ctx[at].astype(np.int64) << 8) | heap, zeros, ones, children))
                continue
            own = log_kt(zeros, ones)
            weighted = own if d == depth else _HALF + np.logaddexp(own, children)
            weighted[both == 0] = 0.0
            weight = np.ones(len(at)) if d == depth else np.exp(_HALF + own - weighted)
            mine = node[rows]
            bit = one[rows]
            kt = (np.where(bit, ones[mine], zeros[mine]) + 0.5) / (both[mine] + 1)
            w = np.where(seen[:, k], weight[mine], 1.0)
            here = both[mine] > 0
            p[:, k] = np.where(here, w * kt + (1 - w) * p[:, k], p[:, k])
            seen[:, k] |= here
            below[k] = (firsts[at], weighted)
    return p, seen, tuple(map(np.concatenate, zip(*nodes_up)))


def _grow(key: tuple, pdf: pd.DataFrame, depth: int) -> pd.DataFrame:
    """A bucket's subtrees, with each chunk's places among the grams."""
    lists = [C.unpack_sorted(C.unsqueeze(x)) for x in pdf["payload"]]
    counts = np.concatenate([np.frombuffer(C.unsqueeze(x), "<u4") for x in pdf["counts"]])
    keys, place = np.unique(np.concatenate(lists), return_inverse=True)
    p, seen, up = subtrees(keys, np.bincount(place, weights=counts), depth)
    body = keys.tobytes() + p.tobytes() + np.packbits(seen).tobytes()
    return pd.DataFrame({
        "bucket": [key[0]], "n": [len(keys)], "trees": [C.squeeze(body)],
        "chunks": [pdf["chunk"].to_numpy().tobytes()], "sizes": [np.array([len(x) for x in lists], np.int64).tobytes()],
        "places": [C.squeeze(place.astype(np.int32).tobytes())],
        "up": [C.squeeze(b"".join(x.astype(np.float64).tobytes() for x in up))],
    })


def _nodes_up(batches: Iterator[list]) -> Iterator[list]:
    for (packed,) in batches:
        for x in packed:
            yield list(zip(*np.frombuffer(C.unsqueeze(x)).reshape(4, -1).tolist()))


def top_nodes(nodes: np.ndarray) -> np.ndarray:
    """From the summed (id, zeros, ones, children) at depth 1 the weight of each
    node's own estimate and its estimate of a one: (2, 257 * 256, 3) by depth
    and id (256 x context + prefix), with a count as third."""
    out = np.zeros((2, 256 * 256, 3))
    summed = np.zeros((256, 3))
    for depth in (1, 0):
        if depth:
            ids, zeros, ones, children = nodes[:, 0].astype(np.int64), nodes[:, 1], nodes[:, 2], nodes[:, 3]
        else:
            ids, (zeros, ones, children) = np.arange(256), summed.T
        own = log_kt(zeros, ones)
        weighted = np.where(zeros + ones > 0, _HALF + np.logaddexp(own, children), 0.0)
        out[depth, ids] = np.stack([np.exp(_HALF + own - weighted), (ones + 0.5) / (zeros + ones + 1), zeros + ones], 1)
        if depth:
            np.add.at(summed, ids & 255, np.stack([zeros, ones, weighted], 1))
    return out


def finished(keys: np.ndarray, p: np.ndarray, seen: np.ndarray, top: np.ndarray, depth: int) -> np.ndarray:
    """log10 of the probability of each gram's byte in its context."""
    byte = (keys & np.uint64(255)).astype(np.int64)
    near = (keys >> np.uint64(8 * depth)).astype(np.int64)
    out = np.zeros(len(keys))
    for k in range(8):
        q, known = p[:, k], seen[:, k]
        heap = (1 << k) | (byte >> (8 - k))
        one = (byte >> (7 - k)) & 1
        for d in (1, 0):
            weight, estimate, count = top[d, (near << 8 | heap) if d else heap].T
            kt = np.where(one, estimate, 1 - estimate)
            w = np.where(known, weight, 1.0)
            q = np.where(count > 0, w * kt + (1 - w) * q, q)
            known = known | (count > 0)
        out += np.log10(q)
    return out


def _predicted(batches: Iterator[list], top: np.ndarray, depth: int) -> Iterator[list]:
    for columns in batches:
        for bucket, n, trees, chunk_ids, sizes, places in zip(*columns):
            raw = C.unsqueeze(trees)
            p = np.frombuffer(raw, np.float64, 8 * n, 8 * n).reshape(n, 8)
            seen = np.unpackbits(np.frombuffer(raw, np.uint8, offset=72 * n), count=8 * n).reshape(n, 8).astype(bool)
            logs = finished(np.frombuffer(raw, np.uint64, n), p, seen, top, depth).astype(np.float32)
            ends = np.cumsum(np.frombuffer(sizes, np.int64))
            parts = np.split(np.frombuffer(C.unsqueeze(places), np.int32), ends[:-1])
            for chunk, part in zip(np.frombuffer(chunk_ids, np.int64).tolist(), parts):
                yield [(chunk, bucket, C.squeeze(logs[part].tobytes()))]


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """The training counts of a bucket's words for each chunk; the bucket's
    tokens and distinct words stand in its first row."""
    lists = [C.unpack_sorted(C.unsqueeze(x)) for x in pdf["payload"]]
    counts = np.concatenate([np.frombuffer(C.unsqueeze(x), "<u4") for x in pdf["counts"]])
    found, place = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(place, counts, len(found)).astype(np.int64)
    sums, distinct = np.zeros((2, len(lists)), np.int64)
    sums[0], distinct[0] = total.sum(), np.count_nonzero(total)
    parts = np.split(total[place], np.cumsum([len(x) for x in lists])[:-1])
    return pd.DataFrame({
        "chunk": pdf["chunk"], "bucket": pdf["bucket"], "tokens": sums, "words": distinct,
        "counts": [C.squeeze(x.tobytes()) for x in parts],
    })


# --- scores ----------------------------------------------------------------------


def _scored(batches: Iterator[list], depth: int, buckets: int, tokens: int, words: int, train_docs: int) -> Iterator[list]:
    base = tokens + words + 1
    end = np.log10((train_docs + 1) / base)
    for columns in batches:
        for chunk_id, n, payload, counted, logged in zip(*columns):
            chunk = C.unpack(chunk_id, n, payload)
            keys, _ = grams(chunk, depth)
            order, cut = _by_context(keys, depth, buckets)
            logs = np.zeros(len(keys), np.float32)
            for x in logged or ():
                logs[order[cut[x["bucket"]] : cut[x["bucket"] + 1]]] = np.frombuffer(C.unsqueeze(x["logs"]), np.float32)
            log_of = Lookup(keys, logs)
            b, begin = _text(chunk, depth)
            score = np.zeros(len(chunk.ids))
            for i, j, lo, hi in _batches(begin, depth):
                edges = begin[i : j + 1] - lo
                each = np.zeros(hi - lo + depth)
                keys = _keys(b, depth, lo, hi)
                inner = np.ones(hi - lo, bool)
                inner[(edges[1:-1, None] - np.arange(1, depth + 1)[None, :]).ravel()] = False
                each[: hi - lo][inner] = log_of(keys[inner])
                score[i:j] = np.add.reduceat(each, edges[:-1])
            hashes, tokens_in = _word_hashes(chunk)
            keys, _ = _runs(np.sort(hashes))
            c = np.zeros(len(keys), np.int64)
            cut = C.by_bucket(keys, 64, buckets)
            for x in counted or ():
                c[cut[x["bucket"]] : cut[x["bucket"] + 1]] = np.frombuffer(C.unsqueeze(x["counts"]), np.int64)
            w = Lookup(keys, np.arange(len(keys), dtype=np.int32))(hashes)
            edges = np.concatenate([[0], np.cumsum(tokens_in)])
            known = np.diff(np.concatenate([[0], np.cumsum(c[w] > 0)])[edges]) + (train_docs > 0)
            word_logs = np.append(np.log10((c + 1) / base)[w], 0.0)
            base_score = np.where(tokens_in > 0, np.add.reduceat(word_logs, edges[:-1]), 0.0) + end
            bits = -score / np.log10(2) / (np.maximum(chunk.lens, 0) + 1)
            yield [
                (i, held_out(i), n + 1, k, tokens, x, s, y)
                for i, n, k, x, s, y in zip(
                    chunk.ids.tolist(), tokens_in.tolist(), known.tolist(), base_score.tolist(), score.tolist(), bits.tolist()
                )
            ]


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row for each document with doc_id: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score (log10 of the model's
    probability), bits_per_byte (code length, the end counted as a byte)."""
    chunked = C.pack_chunks(docs, CHUNK_BYTES)
    size = chunked.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    buckets = C.bucket_count(3 * size)
    train_docs = docs.where(F.col("doc_id").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD_OUT)).count()
    blobs = stored(
        map_rows(chunked, lambda it: _blobs(it, depth, buckets), "kind int, bucket int, chunk long, payload binary, counts binary")
    )
    trees = stored(
        blobs.where("kind = 0")
        .groupBy("bucket")
        .applyInPandas(
            lambda key, pdf: _grow(key, pdf, depth),
            "bucket int, n int, trees binary, chunks binary, sizes binary, places binary, up binary",
        )
    )
    up = (
        map_rows(trees.select("up"), _nodes_up, "node double, zeros double, ones double, children double")
        .groupBy("node")
        .agg(F.sum("zeros"), F.sum("ones"), F.sum("children"))
    )
    top = top_nodes(np.array([tuple(r) for r in up.collect()], float).reshape(-1, 4))  # 256 x 255 rows at most
    send = chunked.sparkSession.sparkContext.broadcast(top)
    logs = map_rows(
        trees.select("bucket", "n", "trees", "chunks", "sizes", "places"),
        lambda it: _predicted(it, send.value, depth),
        "chunk long, bucket int, logs binary",
    )
    counted = stored(
        blobs.where("kind = 1")
        .groupBy("bucket")
        .applyInPandas(_counted, "chunk long, bucket int, tokens long, words long, counts binary")
    )
    tokens, words = counted.agg(F.sum("tokens"), F.sum("words")).first()
    tokens, words = (tokens or 0) + train_docs, (words or 0) + (train_docs > 0)
    ready = C.with_answers(chunked, counted.select("chunk", "bucket", "counts")).withColumnRenamed("answers", "counted")
    ready = C.with_answers(ready, logs).select("chunk", "n", "payload", "counted", "answers")
    return map_rows(
        ready,
        lambda it: _scored(it, depth, buckets, tokens, words, train_docs),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double, bits_per_byte double",
    )
