import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb

from lendlake.llm import oracle, trie
from lendlake.llm.tables import stored

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, key string, node string, before long, family string"


def brute_force(rows):
    """Every node from all prefixes of the rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[:2], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()))
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        path = tuple(t[2:] for t in [*own.get(base, [])[:h], *turns[h:]])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(WORDS.findall(path[-1][1])) if path else 0
        below = children[path]
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in below)
    return sorted(
        (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p],
            saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p in members
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "n", 7, "f") for r in rows], SCHEMA).repartition(3)


def result(df):
    assert df.columns[: len(COLUMNS)] == COLUMNS
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def check(spark, rows):
    assert result(trie.nodes(table(spark, rows))) == brute_force(rows)


def random_rows(r, convs, longest, said):
    rows = []
    for c in convs:
        for turn in range(r.randint(0, longest)):
            rows.append((c, turn, r.choice(["user", "assistant", "", None]), r.choice(said)))
    r.shuffle(rows)
    return rows


def test_random_conversations(spark):
    r = random.Random(1)
    said = ["a", "a b", "", None, "x\ty\x0bz", "ä  ö", "\x00 \x1f"]
    check(spark, random_rows(r, range(-30, 90), 14, said[:3]))
    check(spark, random_rows(r, range(0, 400, 7), 6, said))


def test_awkward_rows(spark):
    long = "w " * 200_000
    rows = [
        (None, 0, "user", "nobody"), (1, None, "user", "first"), (1, None, "user", "first"), (1, 5, "user", "tie"),
        (1, 5, "assistant", "tie"), (1, 5, None, None), (2, 0, "us", "erx"), (2, 1, "use", "rx"), (3, 0, "us", "erx"),
        (20, 0, "user", "a"), (25, 0, "user", "a"), (25, 1, "user", "b"), (26, 0, "user", "z"), (41, 0, "q", "only"),
        (60, 0, "user", long), (61, 0, "user", long), (61, 1, "user", long), (61, 2, "user", "c"), (61, 3, "user", "d"),
        (2**62, 0, "user", "far"), (-20, 0, "user", "a"), (-21, 1, "user", "b"),
    ]
    check(spark, rows)


def test_long_conversations_and_blocks_that_end_full(spark):
    rows = [(c, t, "user", f"turn {t % 9}") for c, n in ((0, 301), (20, 301), (40, 300), (60, 8), (80, 7)) for t in range(n)]
    rows += [(c, t, "user", f"turn {t % 9}" if t != 150 else "other") for c in (100, 120) for t in range(301)]
    check(spark, rows)


def test_hot_first_turn_and_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 64)  # many packed rows for the ids of one node
    rows = [(20 * c, 0, "system", "same") for c in range(600)]
    rows += [(20 * c, 1, "user", f"question {c}" if c % 3 else "again") for c in range(600)]
    check(spark, rows)


def test_conversations_without_turns_and_one_alone(spark):
    # Conversations whose own turns are all skipped and whose base is absent.
    empty = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:4]
    check(spark, [(c, 0, "user", "gone") for c in empty])
    check(spark, [(0, 0, "user", "alone")])


def test_empty_table(spark):
    assert trie.nodes(table(spark, [(1, 0, "user", "x")]).limit(0)).collect() == []


def test_unlike_blocks_only_are_cut_by_turns(spark):
    """Copies share their blocks: no turn of theirs is grouped again."""
    rows = [(20 * c, t, "user", f"turn {t}") for c in range(50) for t in range(9)]
    blocks = stored(trie.rebuilt_blocks(table(spark, rows)))
    assert blocks.count() == 50 * 3
    assert blocks.select("key").distinct().count() == 3
    check(spark, rows)


def test_sql_gives_the_same(spark):
    rows = random_rows(random.Random(3), range(0, 60), 7, ["a", "b c", "", "ü"])
    rows = [(c, t, role or "", text) for c, t, role, text in rows]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.PREFIX_TRIE})").fetchall()) == brute_force(rows)
