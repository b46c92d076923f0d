import hashlib
import random
import time

import pytest
import sentencepiece

from lendlake.llm import sentencepieces as sp
from tests.llm.fixtures import documents, texts

FRAGMENTS = [
    "a", "b", "e", "the", "ing", " ", "  ", sp.SPACE, "\n", "\t", "é", "ü", "日", "本", "😀", "\x00", "<0x0A>", "<s>",
    "1", "0", "ﬁ", "　", "�", "ß", "́", " ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.default_path())


@pytest.fixture(scope="module")
def model():
    return sp.model(sp.default_path())


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, doc_id, text):
    ids = library.encode(text or "")
    return doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))


def test_query_equals_the_library_on_awkward_documents(spark, library):
    got = [tuple(r) for r in sp.digests(documents(spark)).collect()]
    want = [expected(library, i, t) for i, t, _ in texts()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_ids_and_texts_are_returned_whole(spark, library):
    got = {r["doc_id"]: (r["ids"], r["text"]) for r in sp.encoded(documents(spark, [(1, "one  two\n", None)])).collect()}
    ids = library.encode("one  two\n")
    assert got == {1: (",".join(map(str, ids)), "one  two\n")}


def test_empty_table(spark):
    assert sp.digests(documents(spark).limit(0)).collect() == []


def test_encoding_of_random_texts(library, model):
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choice(FRAGMENTS) for _ in range(r.randint(0, 40)))
        ids = library.encode(text)
        assert model.encode(text) == ids, text
        assert model.round_trip(text) == (len(ids), ",".join(map(str, ids)), library.decode(ids)), text


def test_decoding_of_random_ids(library, model):
    r = random.Random(2)
    some = [0, 1, 2, 259, 260, 273, 28705]
    for _ in range(5000):
        ids = [r.choice([r.randrange(len(model.piece)), r.randrange(259), r.choice(some)]) for _ in range(r.randint(0, 9))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("unit", ["a", " ", "ab", "日\n", "the quick ", "aaaaaaaaaaaaaaab", None])
def test_two_megabytes_in_time_proportional_to_length(model, library, unit):
    r = random.Random(3)
    text = unit * (2_000_000 // len(unit)) if unit else "".join(r.choice("abcdefghij") for _ in range(1_000_000))
    model.round_trip(text[:1000])
    begin = time.process_time()
    n, ids, decoded = model.round_trip(text)
    assert time.process_time() - begin < 30
    assert decoded == text
    assert ids == ",".join(map(str, library.encode(text)))


def test_backtracking_gives_up_longest_matches(model):
    """Some word's longest matches are not its encoding, so positions do fail."""
    r = random.Random(4)
    differs = 0
    for _ in range(2000):
        word = "".join(r.choice("etaoinshr") for _ in range(8))
        greedy = [i for _, i in model.automaton.iter_long(word)]
        ids = model.encode_part(word)
        assert [model.piece[i] for i in ids] == model.merge(word)
        differs += greedy != ids
    assert differs > 100


def test_tables_of_parts_are_bounded(library, monkeypatch):
    monkeypatch.setattr(sp, "PARTS", 8)
    monkeypatch.setattr(sp, "PAIRS", 8)
    m = sp.Model(sp.default_path())
    text = " ".join(f"word{i} x{i % 7}" for i in range(200))
    assert m.round_trip(text)[1] == ",".join(map(str, library.encode(text)))
    assert len(m.recent) <= 8 and len(m.earlier) <= 8 and len(m.pairs) <= 8
