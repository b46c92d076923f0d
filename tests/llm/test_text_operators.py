"""op1, op5, op6 and op7 against brute force and planted cases."""

import hashlib
import random
import re
import time
import zlib

import pytest

from lendlake.llm import decontaminate, langid, licenses, pii
from tests.conftest import SMOKE
from tests.llm.fixtures import documents, texts


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_hits(text, items):
    w = words(text)
    hit, found = [False] * len(w), set()
    for name, item in items:
        v = words(item)
        size = min(13, len(v))
        for k in range(len(v) - size + 1 if v else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[k : k + size]:
                    hit[i : i + size] = [True] * size
                    found.add(name)
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    n = sum(hit)
    return len(w), n, len(found), digest, n > 0 and 20 * n >= len(w)


def test_decontamination_equals_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ünï", "a"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [("10", prose(40)), ("9", prose(13)), ("short", "w1, W2 w3"), ("one", "unique"), ("none", "?!"), ("nil", None)]
    items += [("copy", items[0][1]), ("part", " ".join(items[0][1].split()[5:30])), ("long", "a " * 20)]
    rows = [(k, prose(r.randint(0, 80)), None) for k in range(40)]
    cut = items[0][1].split()
    rows += [(100 + k, prose(10) + " " + " ".join(cut[k : k + 11 + k % 5]).upper() + "; " + prose(30), None) for k in range(20)]
    rows += [(200, None, None), (201, "", None), (None, items[1][1], None), (202, "unique", None), (203, "a " * 500, None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for shard in (decontaminate.SHARD_BYTES, 100):
        got = decontaminate.judge(documents(spark, rows), bench, shard_bytes=shard).collect()
        assert len(got) == len(rows)
        by = {x.doc_id: x for x in got}
        for i, text, _ in rows:
            x = by[i]
            assert (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) == brute_hits(text, items), i
    dirty = {i for i, t, _ in rows if brute_hits(t, items)[-1]}
    kept = decontaminate.drop_contaminated(documents(spark, rows), bench)
    assert {x.doc_id for x in kept.collect()} == {i for i, _, _ in rows} - dirty
    empty = decontaminate.judge(documents(spark, rows), bench.limit(0)).collect()
    assert not any(x.contaminated or x.n_hit for x in empty)


def test_spans_are_cut_out_of_texts(spark):
    item = " ".join(f"q{k}" for k in range(13))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, [(1, f"before {item.replace(' ', ', ')}. After", None), (2, None, None)])
    got = {x.doc_id: x.text for x in decontaminate.remove_spans(docs, bench).collect()}
    assert got == {1: "before . After", 2: None}


def test_short_spans_go_where_they_cover_much(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    texts_ = [(1, "alpha beta gamma end", None), (2, "alpha beta gamma " + "word " * 40, None)]
    docs = documents(spark, texts_)
    by_share = {x.doc_id: x.text for x in decontaminate.remove_spans(docs, bench, min_share=0.5).collect()}
    assert by_share == {1: " end", 2: texts_[1][1]}
    by_length = {x.doc_id: x.text for x in decontaminate.remove_spans(docs, bench, min_words=3).collect()}
    assert by_length == {1: " end", 2: " " + "word " * 40}


def test_items_without_or_with_the_same_id(spark):
    bench = spark.createDataFrame([(None, "alpha beta"), ("x", "beta gamma"), ("x", "delta")], "item_id string, text string")
    (got,) = decontaminate.judge(documents(spark, [(1, "alpha beta gamma delta", None)]), bench).collect()
    assert (got.n_hit, got.n_items, got.items_sha256) == (4, 1, hashlib.sha256(b"x").hexdigest())


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def contract_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if low <= len(d) <= high and (kind == "phone" or pii.luhn(d)):
                out.append((kind, *m.span()))
    return out


def test_base_identifiers_follow_the_patterns():
    r = random.Random(4)
    parts = ["a", "b@", "@", ".", "..", "c.d", "1", "12.", "255", "256.", "0001", " ", "-", "+", "+4", "(", "4111 1111 1111 1111", "x_%", "é", "٣", "\n"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 25)))
        assert pii.base_spans(text) == contract_spans(text), text


@pytest.mark.parametrize(
    "text,kind,plain",
    [
        ("write to john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
        ("mail jane [at] mail.example.org!", "email", "jane [at] mail.example.org"),
        ("contact bob at example dot com please", "email", "bob at example dot com"),
        ("contact bob@example[dot]com please", "email", "bob@example[dot]com"),
        ("see jоhn@exаmple.cоm here", "email", "jоhn@exаmple.cоm"),
        ("see john＠example．com here", "email", "john＠example．com"),
        ("host １９２.１６８.０.１ up", "ip", "１９２.１６８.０.１"),
        ("host one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("card four one one one 1111 1111 one one one one ok", "card", "four one one one 1111 1111 one one one one"),
        ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("num +1 555‑123‑4567 x", "phone", "+1 555‑123‑4567"),
        ("card 4111​1111​1111​1111 z", "card", "4111​1111​1111​1111"),
        ("llama más tres cuatro nueve uno dos tres cuatro cinco seis", "phone", "más tres cuatro nueve uno dos tres cuatro cinco seis"),
    ],
)
def test_disguised_identifiers_map_back_to_the_source(text, kind, plain):
    base, spans = pii.all_spans("Ünï. " + text)
    assert (kind, plain) in [(k, ("Ünï. " + text)[a:b]) for k, a, b in spans]
    assert set(base) <= set(spans)


@pytest.mark.parametrize(
    "text,kind,plain",
    [
        ("mail john@example[.]com now", "email", "john@example[.]com"),
        ("mail john at example[.]com now", "email", "john at example[.]com"),
        ("mail john @ example.com now", "email", "john @ example.com"),
        ("mail john @example(.)co(.)uk now", "email", "john @example(.)co(.)uk"),
        ("call +44 20 7946 zero nine five eight now", "phone", "+44 20 7946 zero nine five eight"),
    ],
)
def test_every_disguise_of_the_grammar_opens_the_gate(text, kind, plain):
    base, spans = pii.all_spans(text)
    assert (kind, plain) in [(k, text[a:b]) for k, a, b in spans] and set(base) <= set(spans)
    assert pii.redacted(text) == text.replace(plain, f"[{kind.upper()}]")


@pytest.mark.parametrize("unit", ["a dot ", " at dot", "a@", "a at b dot c ", "a.b at c.d", "(at) ", "one two dot ", "4 "])
def test_long_texts_take_time_in_proportion(unit):
    end = " x (at) y (dot) org"
    started = time.process_time()
    _, spans = pii.all_spans(unit * (1_000_000 // len(unit)) + "," + end)
    assert "email" in {kind for kind, _, _ in spans} and time.process_time() - started < 60


def test_prices_are_no_addresses():
    assert pii.all_spans("2 lbs @ 3.50 each, (dot) 40 @ 1.25, and at most 7 point 5") == ([], [])


@pytest.mark.parametrize(
    "text",
    [
        "Look at the dot on the map", "meet me at example.com at noon", "one two three and four", "Chat (at home) dot",
        "one of the two, three of the four dots", "Être à l’école, 12–14 août…", "seven eight nine", "at dot", "x @ y",
    ],
)
def test_clean_texts_stay_clean(text):
    assert pii.all_spans(text) == ([], [])


def test_personal_data_over_documents(spark):
    rows = [*texts(), (300, "a@b.co and 10.0.0.1, x (at) y (dot) org", None), (301, "@" * 3000 + "a" * 3000 + "@", None)]
    got = {x.doc_id: x for x in pii.find(documents(spark, rows)).collect()}
    assert got[300].spans == "email:0:6,email:21:39,ip:11:19" and (got[300].n_email, got[300].n_ip, got[300].n_added) == (2, 1, 1)
    assert got[300].base_sha256 == hashlib.sha256(b"email:0:6,ip:11:19").hexdigest()
    assert got[85].spans == "" and got[301].spans == ""
    clean = {x.doc_id: x for x in pii.redact(documents(spark, rows)).collect()}
    assert clean[300].text == "[EMAIL] and [IP], [EMAIL]" and clean[85].text is None
    assert clean[300].payload == "payload"


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    model = langid.fit(docs)
    got = langid.predict(docs, model).collect()
    held = [x for x in got if x.held_out]
    assert {x.doc_id for x in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(truth[x.doc_id] == x.lang_pred for x in held) >= 0.95 * len(held)
    assert all(0 <= x.score <= 1 for x in got)
    assert sum(x.rejected for x in got) <= 0.02 * len(got)
    odd = documents(spark, [(1, None, None), (2, "12 ?!", None), (3, "", "en"), (None, "the ing of", None), (5, "ᚠᚢᚦᚨᚱᚲ " * 200, None)])
    out = {x.doc_id: x for x in langid.predict(odd, model).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 and out[i].rejected for i in (1, 2, 3))
    assert out[5].rejected and out[5].lang_pred in {"en", "de", "fr", "es"}
    assert {x.doc_id for x in langid.drop_rejected(odd, model).collect()} == {None}
    nothing = langid.fit(odd.where("doc_id = 1"))
    assert {x.lang_pred for x in langid.predict(docs, nothing).collect()} == {"und"}


def test_limits_come_from_all_training_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    short = [(10_000 + k, " ".join(t.split()[k % 7 : k % 7 + 1 + k % 2]), lang) for k, (_, t, lang) in enumerate(rows)]
    fed = documents(spark, rows + short).cache()
    out = langid.predict(fed, langid.fit(fed, sample=10)).collect()
    lettered = {i for i, t, _ in rows + short if langid.has_letter(t)}
    learned = [x for x in out if x.doc_id in lettered and not x.held_out]
    assert len(learned) > 100 and sum(x.rejected for x in learned) <= 0.02 * len(learned)


@pytest.mark.parametrize("sample", [langid.SAMPLE, 60])
def test_odd_labelled_rows_dont_open_the_gate(spark, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    strange = ["ᚠᚢᚦᚨᚱᚲ ", "日本語の文章です。", "Съешь ещё этих ", "שלום עולם ", "qzxj vkwq ", "ภาษาไทย ", "漢字 ", "x7y q9z ", "ქართული "]
    odd = spark.createDataFrame([(10**6 + 4 * k, t * 30, "en") for k, t in enumerate(strange + strange[:3])], docs.schema)
    fed = docs.unionByName(odd).cache()
    model = langid.fit(fed, sample=sample)
    probes = spark.createDataFrame([(k, t * 50, None) for k, t in enumerate(strange)], docs.schema)
    assert all(x.rejected for x in langid.predict(probes, model).collect())
    assert langid.drop_rejected(docs, model).count() >= 0.99 * docs.count()


def test_language_of_an_empty_table(spark):
    empty = documents(spark, [])
    model = langid.fit(empty)
    assert model.langs == [] and langid.predict(empty, model).count() == langid.drop_rejected(empty, model).count() == 0


def test_licence_rules(spark):
    mit = " ".join(s + "." for k in ("MITGrant", "MITNotice") for s in licenses.SENTENCES[k])
    rows = [
        (1, "Prose here\nLicensed under CC BY-NC 4.0.\nMore.", None),
        (2, "x Licensed under the Apache License, Version 2.0. Later: Released under the\nMIT License.", None),
        (3, "MIT text follows: " + mit.replace("software and", "software\n  and"), None),
        (4, licenses.SENTENCES["BSDSource"][0] + ".", None),
        (5, None, None), (6, "", None), (7, "no rights here", None), (None, "Released under the MIT License.", None),
        (8, "This work is licensed under the GNU General Public License, version 30", None),
    ]
    got = {x.doc_id: x for x in licenses.scan(documents(spark, rows)).collect()}
    assert [got[i].licences for i in (1, 2, 3, 5, 6, 7, None)] == ["CC-BY-NC-4.0", "Apache-2.0,MIT", "MIT", "", "", "", "MIT"]
    assert (got[4].licences, got[4].n_unmatched, got[8].licences) == ("", 1, "")
    for names in licenses.SENTENCES.values():
        for s in names:
            assert any(t in s.lower() for t in licenses.TRIGGERS)
    used = {s for _, rule in licenses.RULES for s in rule}
    assert used <= set(licenses.SENTENCES)
