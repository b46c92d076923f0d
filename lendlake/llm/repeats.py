"""Removal of repeated byte strings with sorted suffix buckets (op9).

Every byte covered by a 50-byte string that also starts in a document with a
smaller doc_id goes. All 50-byte strings are decided, in three steps:

1. *Anchors.* The 24-byte gram of least hash (leftmost on ties) in a 50-byte
   string is its anchor, so equal strings have equal anchors at equal offsets;
   neighbouring strings mostly share theirs (one anchor for about 14 strings).
2. *Candidates.* Chunks send their anchors' hashes to buckets of the hash range
   and learn which of them other documents have too (op2's exchange).
3. *Bucket refinement.* The shared anchors go, with the 26 bytes on either side,
   to the bucket of their hash. The initial buckets, those of the anchor gram,
   are refined by sorting on the identifiers of the 8-byte buckets at the
   later offsets (to the right, and mirrored to the left). One sorted order
   with its common-prefix lengths gives the bucket identifiers for every
   depth, and these are reused for every string around the anchor: a string
   that begins ``o`` bytes before the anchor is identified by the left bucket of
   depth ``o`` and the right one of depth ``26 - o``. The least doc_id of each such
   pair decides. Byte for byte equality is decided on the bytes, not on hashes.

A chunk sends equal surroundings of an anchor once, with the least doc_id. So a
passage that a third of all documents share brings its bucket at most some
hundred bytes from each chunk, and is sorted there, never compared pairwise.

Cases: a null text counts as empty; texts of fewer than 50 bytes keep all;
equal texts under one doc_id don't remove each other (no smaller doc_id);
rows without doc_id are left out; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm import chunks as C
from lendlake.llm.tables import map_rows, stored

SPAN = 50
GRAM = 24
SIDE = SPAN - GRAM  # offsets 0..SIDE of an anchor in a string
BITS = 40  # of an anchor's hash by which buckets compare
_BLOCK = (1 << 16) - SPAN
#: Small chunks: their rows stay small for the JVM, which holds several.
CHUNK_BYTES = 1 << 20
#: Text for each bucket, about: a bucket is refined in memory at once.
BUCKET_BYTES = 4 << 20
_WIDTH = 80  # bytes of a window: left side, gram, right side, 4 of padding


@dataclass
class Anchors:
    """Anchors of a chunk; ``lo`` to ``hi`` are the offsets of the strings
    that have this anchor, before the anchor."""

    hash: np.ndarray  # 48 bits
    at: np.ndarray  # in the chunk's bytes
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray  # index in the chunk

    def take(self, which) -> Anchors:
        return Anchors(self.hash[which], self.at[which], self.lo[which], self.hi[which], self.doc[which])


def anchors(chunk: C.Chunk) -> Anchors:
    off = chunk.offsets
    n = len(chunk.data)
    text = np.frombuffer(chunk.data + b"\0" * 64, np.uint8)
    lens = np.maximum(chunk.lens, 0)
    ok = np.zeros(n + 1, np.int8)  # strings may start from a document's start to 50 before its end
    long = lens >= SPAN
    np.add.at(ok, off[:-1][long], 1)
    np.add.at(ok, off[1:][long] - SPAN + 1, -1)
    ok = np.cumsum(ok, dtype=np.int8)[:n].astype(bool)
    found: list[tuple] = []
    for base in range(0, n, _BLOCK):
        size = min(_BLOCK, n - base)
        starts = ok[base : base + size]
        if not starts.any():
            continue
        b = text[base : base + size + SPAN + 8].astype(np.uint64)
        w = b[:-1] | b[1:] << np.uint64(8)
        w = w[:-2] | w[2:] << np.uint64(16)
        w = w[:-4] | w[4:] << np.uint64(32)
        k = size + SIDE
        h = w[:k] * np.uint64(0x9E3779B97F4A7C15)
        h ^= w[8 : k + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
        h += w[16 : k + 16]
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9FB21C651E98DF25)
        h &= np.uint64(0xFFFFFFFFFFFF0000)
        h |= np.arange(k, dtype=np.uint64)
        least, span = h, 1
        while 2 * span <= SIDE + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = SIDE + 1 - span
        least = np.minimum(least[: len(least) - rest], least[rest:])[:size]
        change = np.empty(size, bool)
        change[0] = True
        change[1:] = least[1:] != least[:-1]
        change[1:] |= starts[1:] != starts[:-1]
        first = np.flatnonzero(change)
        last = np.concatenate([first[1:], [size]]) - 1
        use = starts[first]
        first, last = first[use], last[use]
        m = least[first]
        at = (m & np.uint64(0xFFFF)).astype(np.int64)
        found.append((m >> np.uint64(16), at + base, at - last, at - first))
    if not found:
        empty = np.empty(0, np.int64)
        return Anchors(empty.astype(np.uint64), empty, empty, empty, empty)
    hashes, at, lo, hi = map(np.concatenate, zip(*found))
    return Anchors(hashes, at, lo, hi, np.searchsorted(off[1:], at, side="right"))


def _known(a: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes at BITS bits, each anchor's place among them, and
    which of them two documents of the chunk have."""
    values, place = np.unique(a.hash >> np.uint64(48 - BITS), return_inverse=True)
    low = np.full(len(values), np.iinfo(np.int64).max)
    high = np.full(len(values), -1)
    np.minimum.at(low, place, a.doc)
    np.maximum.at(high, place, a.doc)
    return values, place, low < high


def _hash_blobs(batches: Iterator[list], buckets: int) -> Iterator[list]:
    for columns in batches:
        for row in zip(*columns):
            chunk = C.unpack(*row)
            values, _, _ = _known(anchors(chunk))
            cut = C.by_bucket(values, BITS, buckets)
            yield [
                (b, chunk.chunk, C.pack_sorted(values[cut[b] : cut[b + 1]]))
                for b in range(buckets)
                if cut[b + 1] > cut[b]
            ]


def _windows(chunk: C.Chunk, at: np.ndarray) -> np.ndarray:
    """The bytes from SIDE before each anchor on, _WIDTH of them."""
    text = np.frombuffer(b"\0" * SIDE + chunk.data + b"\0" * _WIDTH, np.uint8)
    out = text[at[:, None] + np.arange(_WIDTH)[None, :]]
    out[:, SPAN + SIDE :] = 0
    return out


@dataclass
class Classes:
    """Shared anchors of a chunk with equal surroundings, by hash; ``member``
    gives the class of each of the anchors ``own``."""

    own: Anchors
    member: np.ndarray
    first: np.ndarray  # an anchor of each class
    doc_id: np.ndarray  # least of each class
    cut: np.ndarray  # where each bucket begins
    windows: np.ndarray


def _classes(chunk: C.Chunk, answers: list | None, buckets: int) -> Classes:
    a = anchors(chunk)
    values, place, shared = _known(a)
    cut = C.by_bucket(values, BITS, buckets)
    for x in answers or ():
        lo, hi = cut[x["bucket"]], cut[x["bucket"] + 1]
        bits = np.frombuffer(C.unsqueeze(x["flags"]), np.uint8)
        shared[lo:hi] |= np.unpackbits(bits, count=hi - lo).astype(bool)
    own = a.take(shared[place])
    windows = _windows(chunk, own.at)
    mark = (own.lo * (SIDE + 1) + own.hi).astype(np.uint64)
    for w in windows.view("<u8").T:
        mark = C.mix(mark ^ w)
    # By hash, then by surroundings; a class is told by 48 and 64 bits of hash.
    order = np.lexsort((chunk.ids[own.doc], mark, own.hash))
    new = np.ones(len(order), bool)
    new[1:] = (own.hash[order][1:] != own.hash[order][:-1]) | (mark[order][1:] != mark[order][:-1])
    member = np.empty(len(order), np.int64)
    member[order] = np.cumsum(new) - 1
    first = order[new]
    return Classes(
        own, member, first, chunk.ids[own.doc[first]], C.by_bucket(own.hash[first], 48, buckets), windows
    )


def _window_blobs(batches: Iterator[list], buckets: int) -> Iterator[list]:
    for columns in batches:
        for chunk, n, payload, answers in zip(*columns):
            c = _classes(C.unpack(chunk, n, payload), answers, buckets)
            rows = []
            for b in range(buckets):
                i = c.first[c.cut[b] : c.cut[b + 1]]
                if len(i):
                    body = [
                        c.own.hash[i].tobytes(), c.doc_id[c.cut[b] : c.cut[b + 1]].tobytes(),
                        c.own.lo[i].astype(np.int8).tobytes(), c.own.hi[i].astype(np.int8).tobytes(), c.windows[i].tobytes(),
                    ]
                    rows.append((b, int(chunk), len(i), C.squeeze(b"".join(body))))
            yield rows


def _sorted_depths(bucket: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Refine buckets by the bytes of ``sides``, 8-byte bucket identifiers at a
    time: the sorted order, and how many leading bytes each entry has in
    common with the one before it in its bucket (-1: another bucket)."""
    words = np.zeros((len(sides), 32), np.uint8)
    words[:, :SIDE] = sides
    later = words.view(">u8").astype(np.uint64)
    order = np.lexsort((*later.T[::-1], bucket))
    s = sides[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE)
    common[bucket[order][1:] != bucket[order][:-1]] = -1
    return order, np.concatenate([[-1], common])


def repeated(hashes: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each anchor a mask: bit o is set if the string that begins o bytes
    before it is one that also starts in a document with a smaller doc_id."""
    n = len(hashes)
    out = np.zeros(n, np.uint32)
    if not n:
        return out
    gram = np.ascontiguousarray(windows[:, SIDE : SIDE + GRAM]).view("<u8")
    order = np.lexsort((gram[:, 2], gram[:, 1], gram[:, 0], hashes))
    new = np.ones(n, bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (gram[order][1:] != gram[order][:-1]).any(axis=1)
    bucket = np.empty(n, np.int64)
    bucket[order] = np.cumsum(new)
    right, right_common = _sorted_depths(bucket, windows[:, SIDE + GRAM : SPAN + SIDE])
    left, left_common = _sorted_depths(bucket, windows[:, SIDE - 1 :: -1] if SIDE else windows[:, :0])
    left_id, right_id = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(SIDE + 1):
        here = np.flatnonzero((lo <= o) & (o <= hi))
        if not len(here):
            continue
        left_id[left] = np.cumsum(left_common < o)
        right_id[right] = np.cumsum(right_common < SIDE - o)
        key = left_id[here] * np.int64(n + 1) + right_id[here]
        by = np.argsort(key)
        first = np.ones(len(by), bool)
        first[1:] = key[by][1:] != key[by][:-1]
        least = np.minimum.reduceat(doc[here][by], np.flatnonzero(first))
        out[here[by]] |= (least[np.cumsum(first) - 1] < doc[here][by]).astype(np.uint32) << np.uint32(o)
    return out


def _answer_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    parts = []
    for n, payload in zip(pdf["n"], pdf["payload"]):
        raw = C.unsqueeze(payload)
        parts.append((
            np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.int64, n, 8 * n),
            np.frombuffer(raw, np.int8, n, 16 * n), np.frombuffer(raw, np.int8, n, 17 * n),
            np.frombuffer(raw, np.uint8, n * _WIDTH, 18 * n).reshape(n, _WIDTH),
        ))
    masks = repeated(*map(np.concatenate, zip(*parts)))
    ends = np.cumsum([len(p[0]) for p in parts])
    return pd.DataFrame({
        "chunk": pdf["chunk"], "bucket": pdf["bucket"],
        "masks": [C.squeeze(m.tobytes()) for m in np.split(masks, ends[:-1])],
    })


def _cut_out(batches: Iterator[list], buckets: int, with_kept: bool) -> Iterator[list]:
    for columns in batches:
        for chunk_id, n, payload, flags, masks in zip(*columns):
            chunk = C.unpack(chunk_id, n, payload)
            c = _classes(chunk, flags, buckets)
            mask = np.zeros(len(c.first), np.uint32)
            for x in masks or ():
                mask[c.cut[x["bucket"]] : c.cut[x["bucket"] + 1]] = np.frombuffer(C.unsqueeze(x["masks"]), np.uint32)
            own, m = c.own, mask[c.member]
            later = chunk.ids[own.doc] > c.doc_id[c.member]  # a smaller doc_id of its class is here
            edge = np.zeros(len(chunk.data) + 1, np.int32)
            for o in range(SIDE + 1):
                begin = own.at[(m >> np.uint32(o) & np.uint32(1) == 1) | later & (own.lo <= o) & (o <= own.hi)] - o
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + SPAN, -1)
            gone = np.cumsum(edge)[:-1] > 0
            text = np.frombuffer(chunk.data, np.uint8)
            off = chunk.offsets
            rows = []
            for d, i in enumerate(chunk.ids.tolist()):
                g, t = gone[off[d] : off[d + 1]], text[off[d] : off[d + 1]]
                removed = int(np.count_nonzero(g))
                kept = t[~g].tobytes() if removed else t.tobytes()
                spans = int(np.count_nonzero(g[1:] & ~g[:-1])) + int(g[0]) if removed else 0
                row = (i, len(t), removed, spans, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_kept else row)
            yield rows


def remove_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """One row for each document with doc_id: doc_id, n_bytes, n_removed,
    n_spans, kept_sha256 and, if asked for, the kept bytes."""
    chunked = C.pack_chunks(docs, CHUNK_BYTES)
    size = chunked.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    buckets = C.bucket_count(3 * size, BUCKET_BYTES)
    blobs = map_rows(chunked, lambda it: _hash_blobs(it, buckets), "bucket int, chunk long, payload binary")
    asked = C.with_answers(chunked, stored(C.shared_flags(blobs))).withColumnRenamed("answers", "flags")
    windows = map_rows(
        asked.select("chunk", "n", "payload", "flags"),
        lambda it: _window_blobs(it, buckets),
        "bucket int, chunk long, n int, payload binary",
    )
    masks = windows.groupBy("bucket").applyInPandas(_answer_bucket, "chunk long, bucket int, masks binary")
    decided = C.with_answers(asked, masks).select("chunk", "n", "payload", "flags", "answers")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_rows(
        decided, lambda it: _cut_out(it, buckets, with_kept), schema + ", kept binary" * with_kept
    )
