"""Documents in chunks of a few megabytes.

The operators that look at every byte or word of the corpus (op2, op3, op9)
work on chunks: one row holds the ids and the compressed texts of consecutive
documents. A chunk sends out sorted arrays of hashes, one packed array for
each bucket of the hash range, and gets packed answers back, so Spark shuffles
a few large rows instead of one row for each word. Memory is bounded by the
chunk size and the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import id_text, map_rows, stored_by

CHUNK_BYTES = 4 << 20


@dataclass
class Chunk:
    chunk: int
    ids: np.ndarray  # int64
    lens: np.ndarray  # int64, bytes of each text; -1: null
    data: bytes  # the texts, one after the other, UTF-8

    def texts(self) -> Iterator[tuple[int, bytes | None]]:
        at = 0
        for i, n in zip(self.ids.tolist(), self.lens.tolist()):
            yield i, (None if n < 0 else self.data[at : at + n])
            at += max(n, 0)

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.maximum(self.lens, 0))])


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(chunk: int, ids: list[int], texts: list[bytes | None]) -> tuple:
    lens = np.array([-1 if t is None else len(t) for t in texts], np.int64)
    body = np.array(ids, np.int64).tobytes() + lens.tobytes()
    return chunk, len(ids), squeeze(body + b"".join(t for t in texts if t))


def unpack(chunk: int, n: int, payload: bytes) -> Chunk:
    raw = unsqueeze(payload)
    return Chunk(
        int(chunk),
        np.frombuffer(raw, np.int64, n),
        np.frombuffer(raw, np.int64, n, 8 * n),
        raw[16 * n :],
    )


def pack_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk long, n int, payload binary)``, stored once, bucketed by chunk.

    The chunk numbers are part of the stored rows, so they stay the same
    whatever is computed again later. Rows without doc_id are left out: no
    result could name them. A null text stays null, and a text longer than a
    chunk is a chunk of its own.
    """

    def packed(batches: Iterator[list]) -> Iterator[list]:
        chunk = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes | None] = []
        size = 0
        for doc_ids, contents in batches:
            for i, t in zip(doc_ids, contents):
                b = None if t is None else t.encode("utf-8", "surrogatepass")
                if ids and size + len(b or b"") > chunk_bytes:
                    yield [_pack(chunk, ids, texts)]
                    chunk, ids, texts, size = chunk + 1, [], [], 0
                ids.append(i)
                texts.append(b)
                size += len(b or b"") + 16
        if ids:
            yield [_pack(chunk, ids, texts)]

    rows = id_text(docs).where("doc_id IS NOT NULL")
    return stored_by(map_rows(rows, packed, "chunk long, n int, payload binary"), "chunk")


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending uint64 values as differences of just enough bytes each."""
    if not len(a):
        return b""
    d = np.diff(a)
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    low = np.ascontiguousarray(d.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(a[0]).to_bytes(8, "little") + low.tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.uint64)
    width = b[0]
    low = np.frombuffer(b, np.uint8, offset=9).reshape(-1, width)
    d = np.zeros((len(low), 8), np.uint8)
    d[:, :width] = low
    out = np.empty(len(low) + 1, np.uint64)
    out[0] = int.from_bytes(b[1:9], "little")
    np.cumsum(d.view("<u8").ravel(), out=out[1:])
    out[1:] += out[0]
    return out


def by_bucket(a: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each of equal ranges of ``bits``-bit values begins in the
    ascending array ``a`` (one more entry: its end)."""
    edges = [(i << bits) // buckets for i in range(buckets)]
    return np.concatenate([np.searchsorted(a, np.array(edges, np.uint64)), [len(a)]])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def bucket_count(docs_bytes: int, per_bucket: int = 16 << 20) -> int:
    """How many buckets of the hash range a corpus of so many bytes gets."""
    return int(max(12, -(-docs_bytes // per_bucket)))


def shared_flags(blobs: DataFrame) -> DataFrame:
    """From (bucket, chunk, values: packed ascending) which values of each
    chunk occur in other chunks too: (chunk, bucket, flags: packed bits)."""

    def answered(key, pdf):
        lists = [unpack_sorted(v) for v in pdf["payload"]]
        every = np.sort(np.concatenate(lists))
        twice = every[1:][every[1:] == every[:-1]]
        rows = []
        for chunk, mine in zip(pdf["chunk"], lists):
            if len(twice):
                at = np.minimum(np.searchsorted(twice, mine), len(twice) - 1)
                flags = twice[at] == mine
            else:
                flags = np.zeros(len(mine), bool)
            rows.append((chunk, key[0], squeeze(np.packbits(flags).tobytes())))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "flags"])

    return blobs.groupBy("bucket").applyInPandas(answered, "chunk long, bucket int, flags binary")


def with_answers(chunked: DataFrame, answers: DataFrame) -> DataFrame:
    """The chunks, each with the array of its (bucket, answer) pairs. The chunks
    are bucketed, so only the answers are shuffled."""
    column = answers.columns[-1]
    each = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", column)).alias("answers"))
    return chunked.join(each, "chunk", "left")
