import random

import pytest

from pagequarry.llm import languages
from tests.llm.data import EDGES, frame

PARTS = {
    "aa": ["tion", "the", "ing", "her", "ough"],
    "bb": ["ää", "sch", "ung", "lich", "zu"],
    "cc": ["ção", "lh", "nh", "ão", "que"],
}


def text(lang: str, seed: int, n: int = 60) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(PARTS[lang], k=pick.randint(1, 3))) for _ in range(n))


def rows(seeds):
    return [(k, text(lang, k * 7 + len(lang) + ord(lang[0])), lang, "s", 1) for k, lang in zip(seeds, list(PARTS) * len(seeds))]


@pytest.fixture(scope="module")
def model(spark):
    return languages.learn(frame(spark, rows(range(90)) + EDGES[:3] + [(1, None, None, None, None)]))


def test_held_out_accuracy(spark, model):
    docs = frame(spark, rows(range(1000, 1060)), ("score", "lang_shares"))
    got = languages.identify(docs, model).collect()
    assert len(got) == 60
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 59
    assert all(0 < r["score"] <= 1 for r in got)


def test_mixtures(spark, model):
    mixed = [
        (1, text("aa", 1, 140) + " " + text("bb", 2, 60), None, None, 1),
        (2, text("cc", 3, 100) + " " + text("aa", 4, 100) + " " + text("bb", 5, 300), None, None, 1),
        (3, text("cc", 6, 200), None, None, 1),
    ]
    got = {r["doc_id"]: r for r in languages.identify(frame(spark, mixed), model).collect()}
    assert got[1]["lang_pred"] == "aa" and set(got[1]["lang_shares"]) == {"aa", "bb"}
    assert 0.55 < got[1]["score"] < 0.85
    assert got[2]["lang_pred"] == "bb" and set(got[2]["lang_shares"]) == {"aa", "bb", "cc"}
    assert got[3]["lang_shares"] == {"cc": 1.0}


def test_edges(spark, model):
    rows = EDGES + [(2000, "é", None, None, 1), (2001, "q!", None, None, 2), (2002, "字", None, None, 1)]
    got = languages.identify(frame(spark, rows, ("lang_pred",)), model).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] == 0) == (not letters)


def test_nothing_learned_and_empty_table(spark):
    none = languages.learn(frame(spark, []))
    assert none.languages == ()
    got = languages.identify(frame(spark, EDGES), none).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert languages.identify(frame(spark, []), none).collect() == []
