import hashlib
import math
import random
import re
import zlib
from collections import Counter

from lendlake.llm import resampling
from tests.llm.fixtures import documents, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    words = WORD.findall((text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_force(rows, items, longest=1, buckets=10000, percent=10, least=20):
    bucket = lambda feature: zlib.crc32(feature.encode()) % buckets
    s = Counter(bucket(f) for _, t, *_ in rows for f in runs(t, longest)[1])
    t = Counter(bucket(f) for x in items for f in runs(x, longest)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for i, text, *_ in rows:
        words, found = runs(text, longest)
        weight = sum(gain(bucket(f)) for f in found)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score, len(words)))
    able = sorted((r for r in out if r[3] is not None and r[4] >= least), key=lambda r: (-r[3], r[0], r[2], r[1]))
    ranks = {}
    for k, r in enumerate(able[: len(able) * percent // 100], 1):
        ranks.setdefault(r, []).append(k)
    rows = []
    for r in out:
        rank = ranks[r].pop(0) if ranks.get(r) else None
        rows.append((*r[:4], rank))
    return sorted(rows, key=repr)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def items(spark, rows):
    return spark.createDataFrame([(str(i), t, 1) for i, t in enumerate(rows)], "item_id string, text string, score long")


TARGET = ["abc dea BCD bb", None, "", "again again x", "日本語 x"]


def test_equals_brute_force(spark):
    got = resampling.resample(documents(spark), items(spark, TARGET))
    assert got.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert result(got) == brute_force(texts(), TARGET)


def test_longer_runs_fewer_buckets_larger_share(spark):
    got = resampling.resample(documents(spark), items(spark, TARGET), longest=3, buckets=97, percent=60, least_words=2)
    assert result(got) == brute_force(texts(), TARGET, 3, 97, 60, 2)


def test_words_are_those_of_the_pattern():
    r = random.Random(1)
    for _ in range(2000):
        text = "".join(chr(r.choice([r.randrange(128), r.randrange(128, 0x3000), 0x1F600])) for _ in range(20))
        assert [w.decode() for w in resampling.words(text)] == runs(text, 1)[0]


def test_ties_go_to_the_smaller_id_and_copies_are_drawn_each(spark):
    rows = [(i, "same words " * 12, None) for i in (5, 5, 6, 7)]
    got = resampling.resample(documents(spark, rows), items(spark, ["same"]), percent=100)
    assert sorted(r["rank"] for r in got.collect()) == [1, 2, 3, 4]
    assert result(got) == brute_force(rows, ["same"], percent=100)


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert resampling.resample(none, items(spark, TARGET)).collect() == []
    got = resampling.resample(documents(spark), items(spark, TARGET).limit(0))
    assert result(got) == brute_force(texts(), [])


def test_two_megabyte_text(spark):
    rows = [(1, "Word ö " * 300_000, None), (2, "x" * 2_000_000, None)]
    got = resampling.resample(documents(spark, rows), items(spark, TARGET))
    assert result(got) == brute_force(rows, TARGET)
