"""Small documents with every awkward case."""

import random

from pyspark.sql import types as T

EXTRA = ("chunk", "n", "payload", "answers", "rep", "slot", "first_id", "bucket")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


def texts() -> list[tuple[int | None, str | None, str | None]]:
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeé ß"[:7]) for _ in range(r.randint(1, 6))).strip() or "x" for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(r.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    base = prose(120)
    rows: list[tuple[int | None, str | None, str | None]] = []
    for i in range(40):
        rows.append((i, prose(r.randint(1, 150)), "en" if i % 2 else "de"))
    for i in range(40, 60):  # near copies: some words changed
        words = base.split()
        for _ in range(r.randint(0, 8)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((i, " ".join(words), "en"))
    for i in range(60, 85):  # one large group of exact copies, one shared passage
        rows.append((i, base, None) if i < 75 else (i, prose(30) + " " + passage + " " + prose(20), "de"))
    rows += [
        (85, None, "en"), (86, "", "en"), (87, " \t\n ", None), (88, "one", "en"), (89, "ONE", "en"), (90, "one two", "de"),
        (91, "a" * 5000, "en"), (92, "a" * 4000, "en"), (93, "\x00\x01 \x00" * 40, "en"), (94, prose(4000), "en"),
        (95, "日本語 " * 30, "de"), (96, "😀" * 60, None), (97, base, "en"), (97, base, "en"), (97, "again", "en"),
        (-3, passage, "en"), (None, base, "en"), (None, None, None), (98, "!!! ... ???", "en"),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(*x, *EXTRA) for x in rows], SCHEMA).repartition(3)


def with_id(rows):
    return [(i, t) for i, t, _ in rows if i is not None]
