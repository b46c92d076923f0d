"""Benchmark decontamination with a generalised suffix automaton (op1).

The words of the benchmark items form one generalised suffix automaton. Every
document is streamed through it, word by word; the longest match that ends at
each word tells which words lie inside an occurrence of a window: 13
consecutive words of an item, or the whole of a shorter item.

Words that no item has lead back to the initial state, so only runs of known
words at least as long as the shortest window are walked; the rest is one
dictionary lookup a word.

Cases: a null or empty text has no words and is clean; an item without words
matches nothing; items with the same text all count; rows with one item_id are
one item; an item without item_id marks the words it hits, but is neither counted
nor named; an empty benchmark leaves every document clean; repeated documents are each judged; a row without doc_id
is judged like any other; columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import id_text, map_rows, ship_code

WINDOW = 13
#: Bytes of item text in one automaton; larger benchmarks get several.
SHARD_BYTES = 32 << 20

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: A-Z to lower case, every other ASCII byte that isn't part of a word to a space.
_TABLE = bytes(
    b if b >= 0x80 or b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class ItemAutomaton:
    """Generalised suffix automaton over the word sequences of items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.names: list[str] = []
        sequences = []
        for name, words in items:
            if words:
                self.names.append(name)
                sequences.append([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words])
        for s in sequences:
            last = 0
            for c in s:
                last = self._extend(last, c)
        #: The shortest window: shorter runs of known words can't hold one.
        self.least = min([window, *map(len, sequences)]) if sequences else 0
        #: Items by the state of each of their windows of full length.
        self.full: dict[int, set[int]] = {}
        #: (length, item) of the shorter items by the state of the whole item.
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, s in enumerate(sequences):
            if len(s) < window:
                v = 0
                for c in s:
                    v = self.next[v][c]
                self.short.setdefault(v, []).append((len(s), item))
            else:
                for _, v, n in self.matches(s, window):
                    if n == window:
                        self.full.setdefault(v, set()).add(item)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def matches(self, ids: list[int], most: int) -> Iterator[tuple[int, int, int]]:
        """(position, state, length) of the longest match that ends at each
        position, counted no longer than ``most``."""
        nxt, link, length = self.next, self.link, self.length
        v = n = 0
        for i, c in enumerate(ids):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            while n > most and length[link[v]] >= most:
                v = link[v]
            if n > most:
                n = most
            yield i, v, n

    def hits(self, words: list[bytes]) -> tuple[np.ndarray | None, set[int]]:
        """Which words lie inside an occurrence of a window (None: no word
        does), and the items that have occurring windows."""
        items: set[int] = set()
        if not self.least or len(words) < self.least:
            return None, items
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))
        gaps = np.concatenate([[-1], np.flatnonzero(ids == 0), [len(ids)]])
        runs = np.flatnonzero(np.diff(gaps) > self.least)
        edge = np.zeros(len(words) + 1, np.int64) if len(runs) else None
        for r in runs.tolist():
            begin = int(gaps[r]) + 1
            for i, v, n in self.matches(ids[begin : gaps[r + 1]].tolist(), self.window):
                found = 0
                if n == self.window:
                    found = n
                    items |= self.full[v]
                while self.short and v > 0:
                    for m, item in self.short.get(v, ()):
                        if m <= n:
                            found = max(found, m)
                            items.add(item)
                    v = self.link[v]
                if found:
                    edge[begin + i - found + 1] += 1
                    edge[begin + i + 1] -= 1
        return (np.cumsum(edge)[:-1] > 0 if items else None), items


def automata(items: DataFrame, window: int, shard_bytes: int) -> list:
    """The items as broadcast automata of bounded size.

    The number of shards follows from the size of the item texts, so what is
    sent at once never exceeds one shard, however large the benchmark is.
    """
    spark = items.sparkSession
    ship_code(spark)
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    out = []
    for k in range(shards):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        found = [(r.item_id, words_of(r.text)) for r in part.toLocalIterator()]
        out.append(spark.sparkContext.broadcast(ItemAutomaton(sorted(found, key=lambda x: x[0] or ""), window)))
    return out


def _merged(texts: list[str | None], shards: list) -> Iterator[tuple[int, np.ndarray | None, set]]:
    """For each text its number of words, which are hit, and the items."""
    words = [words_of(t) for t in texts]
    hit: list[np.ndarray | None] = [None] * len(words)
    names: list[set] = [set() for _ in words]
    for shard in shards:
        automaton = shard.value
        for i, w in enumerate(words):
            got, items = automaton.hits(w)
            if items:
                names[i] |= {automaton.names[x] for x in items}
                hit[i] = got if hit[i] is None else hit[i] | got
    return zip(map(len, words), hit, names)


def _contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items,
    items_sha256, longest_hit (words of the longest hit span), contaminated."""
    shards = automata(items, window, shard_bytes)

    def judged(batches: Iterator[list]) -> Iterator[list]:
        for ids, texts in batches:
            rows = []
            for i, (n, hit, names) in zip(ids, _merged(texts, shards)):
                n_hit = 0 if hit is None else int(hit.sum())
                named = sorted(x for x in names if x is not None)
                digest = hashlib.sha256(",".join(named).encode()).hexdigest()
                rows.append((i, n, n_hit, len(named), digest, _longest(hit), _contaminated(n_hit, n)))
            yield rows

    return map_rows(
        id_text(docs),
        judged,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string,"
        " longest_hit long, contaminated boolean",
    )


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _longest(hit: np.ndarray | None) -> int:
    return max((b - a for a, b in _spans(hit)), default=0) if hit is not None else 0


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents, with all their columns, that aren't contaminated."""
    shards = automata(items, window, shard_bytes)

    @F.pandas_udf("boolean")
    def contaminated(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [hit is not None and _contaminated(int(hit.sum()), n) for n, hit, _ in _merged(texts.tolist(), shards)],
            dtype=bool,
        )

    return docs.where(~contaminated(docs["text"].cast("string")))


def remove_spans(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    min_words: int = WINDOW,
    min_share: float = 1.0,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The documents with every hit span that exceeds a limit cut out of the text
    (from its first to its last character): those of at least ``min_words`` words,
    and all spans where hits cover at least ``min_share`` of the document's words.
    Null stays null."""
    shards = automata(items, window, shard_bytes)

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        out = texts.tolist()
        for k, (_, hit, _) in enumerate(_merged(out[:], shards)):
            if hit is None:
                continue
            at = [m.span() for m in _WORD.finditer(out[k])]
            covered = hit.sum() >= min_share * len(hit)
            for a, b in reversed(_spans(hit)):
                if covered or b - a >= min_words:
                    out[k] = out[k][: at[a][0]] + out[k][at[b - 1][1] :]
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", cut(docs["text"].cast("string")))
