"""op2, op9 and op3 against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lendlake.llm import chunks, ctw, jaccard, repeats
from tests.conftest import SMOKE
from tests.llm.fixtures import documents, texts, with_id

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if w]


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = defaultdict(lambda: math.inf)
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least[find(k)], i)
    return Counter((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("rare,block", [(16, 256), (2, 4)])
def test_join_equals_all_pairs(spark, monkeypatch, rare, block):
    monkeypatch.setattr(jaccard, "RARE", rare)  # small: frequent classes and blocks are used
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(documents(spark)).collect())
    assert got == brute_components(with_id(texts()))


def test_prefix_signatures_meet_for_every_similar_pair():
    rng = np.random.RandomState(3)
    for trial in range(400):
        n = int(rng.randint(2, 60))
        pool = np.unique(rng.randint(0, 1 << 62, 3 * n).astype(np.uint64))
        a = np.sort(rng.choice(pool, n, replace=False))
        b = np.unique(np.concatenate([a[rng.rand(n) > 0.12], rng.choice(pool, max(1, n // 10))]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        often = lambda s: (s >> np.uint64(5)) % np.uint64(4) != (trial % 4)
        sa, sb = (jaccard.signatures(len(s), s, often(s)) for s in (a, b))
        assert len(np.intersect1d(sa, sb))


def test_keep_one_keeps_columns_and_one_of_each_group(spark):
    docs = documents(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    expect = {c for _, _, c in brute_components(with_id(texts()))}
    assert sorted(i for i in ids if i is not None) == sorted(expect)
    assert ids.count(None) == 2


def test_rows_that_share_an_id_are_judged_each(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    near = two.replace("b30", "other")
    rows = [(5, one, None), (5, two, None), (9, near, None), (5, one, None), (7, "", None), (7, None, None), (7, "x", None)]
    got = sorted((r.doc_id, r.component_id) for r in jaccard.near_duplicates(documents(spark, rows)).collect())
    assert got == [(5, 5)] * 3 + [(7, 7)] * 3 + [(9, 5)]
    kept = sorted((r.doc_id, r.text or "") for r in jaccard.keep_one(documents(spark, rows)).collect())
    assert kept == sorted([(5, one), (5, two), (7, ""), (7, "x")])


def brute_repeats(rows):
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49):
            g = b[k : k + 50]
            first[g] = min(first.get(g, i), i)
    out = Counter()
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeats_equal_brute_force(spark):
    got = Counter(tuple(r) for r in repeats.remove_repeats(documents(spark)).collect())
    assert got == brute_repeats(with_id(texts()))


def test_repeats_across_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 2000)
    got = Counter(tuple(r) for r in repeats.remove_repeats(documents(spark)).collect())
    assert got == brute_repeats(with_id(texts()))


@pytest.mark.parametrize("operator", [jaccard.near_duplicates, repeats.remove_repeats, ctw.score])
def test_empty_table(spark, operator):
    assert operator(documents(spark, []).limit(0)).collect() == []
    assert operator(documents(spark, [(None, None, None)])).collect() == []


def test_packed_sorted_round_trip():
    for a in ([], [7], [0, 2**64 - 1], sorted({x * x for x in range(1000)})):
        a = np.array(a, np.uint64)
        assert chunks.unpack_sorted(chunks.pack_sorted(a)).tolist() == a.tolist()


def brute_tree(rows, depth):
    """log10 P of each text, node by node."""
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        s = b"\xff" * depth + (text or "").encode().translate(ctw._LOWER) + b"\xff"
        for i in range(depth, len(s)):
            for k in range(8):
                yield [(s[i - d : i], k, s[i] >> (8 - k)) for d in range(depth + 1)], (s[i] >> (7 - k)) & 1

    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for path, bit in steps(t):
                for node in path:
                    counts[node][bit] += 1
    children = defaultdict(list)
    for ctx, k, prefix in counts:
        if ctx:
            children[ctx[1:], k, prefix].append((ctx, k, prefix))
    weighted, weight = {}, {}
    for node in sorted(counts, key=lambda x: -len(x[0])):
        a, b = counts[node]
        own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        weighted[node], weight[node] = own, 1.0
        if len(node[0]) < depth:
            weighted[node] = math.log(0.5) + np.logaddexp(own, sum(weighted[c] for c in children[node]))
            weight[node] = math.exp(math.log(0.5) + own - weighted[node])
    for i, t in rows:
        total = 0.0
        for path, bit in steps(t):
            p = None
            for node in reversed(path):
                if node in counts:
                    kt = (counts[node][bit] + 0.5) / (sum(counts[node]) + 1)
                    p = kt if p is None else weight[node] * kt + (1 - weight[node]) * p
            total += math.log10(0.5 if p is None else p)
        yield i, total


def test_context_tree_scores_equal_brute_force(spark):
    rows = [(i, t) for i, t in with_id(texts()) if len(t or "") < 3000 and i != 97]
    got = {r.doc_id: r for r in ctw.score(documents(spark, [(i, t, None) for i, t in rows]), depth=4).collect()}
    assert len(got) == len(rows)
    for i, score in brute_tree(rows, 4):
        assert got[i].score == pytest.approx(score, rel=1e-5, abs=1e-5)
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens = [*words(t), None]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(tokens), n)
        assert r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))


def test_context_tree_gives_a_distribution():
    body = b"abracadabra abracadabra"
    chunk = chunks.Chunk(0, np.array([0, 3]), np.array([len(body), 5]), body + b"cadab")
    keys, counts = ctw.grams(chunk, 3)
    every = np.unique((keys[0] & ~np.uint64(255)) | np.arange(256, dtype=np.uint64))
    more = np.unique(np.concatenate([keys, every]))
    n = np.zeros(len(more), np.int64)
    n[np.searchsorted(more, keys)] = counts
    p, seen, up = ctw.subtrees(more, n, 3)
    logs = ctw.finished(more, p, seen, ctw.top_nodes(np.stack(up, 1)), 3)
    assert (10 ** logs[np.searchsorted(more, every)]).sum() == pytest.approx(1.0)


def test_scores_learn_from_the_corpus(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    held = [r for r in ctw.score(docs).collect() if r.held_out]
    assert len(held) > 10
    assert sum(r.bits_per_byte for r in held) / len(held) < 5
