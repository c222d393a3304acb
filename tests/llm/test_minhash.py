import random

import numpy as np
import pyarrow as pa
import pytest

from pagequarry.llm import minhash
from pagequarry.llm.components import components, forest
from tests.llm.data import EDGES, corpus, frame, words


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def expected(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y) or sets[a][0] == sets[b][0]:
                parent[root(a)] = root(b)
    groups = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(root(k), []).append(i)
    return {
        (i, len(s), min((x for x in groups[root(k)] if x is not None), default=None))
        for k, (i, s) in enumerate(sets)
    }


def found(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_same_as_all_pairs(spark, ws):
    rows = corpus() + EDGES
    df = minhash.near_duplicates(frame(spark, rows, ("n", "rep", "component_id", "block")), ws).cache()
    assert df.count() == len(rows)
    assert found(df) == expected(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("limit", [2_000, 250_000])
def test_chains_and_large_groups_in_blocks(spark, ws, limit, monkeypatch):
    """A group of copies that are linked only through each other, cut into many blocks."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", limit)
    pick, base = random.Random(3), words(1, 120, 5000)
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(pick.choice([1, 2, 4])):
            text[pick.randrange(len(text))] = f"new{k}"
        rows.append((k, " ".join(text), "x", "s", 1))
    chain = words(2, 100, 5000)
    for k in range(150, 170):
        chain = [*chain[8:], *words(k, 8, 5000)]
        rows.append((k, " ".join(chain), "x", "s", 1))
    assert found(minhash.near_duplicates(frame(spark, rows), ws)) == expected(rows)


def test_second_round_joins_what_the_first_left(spark, ws, monkeypatch):
    """Groups that share lists with a larger one, in many small blocks."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 700)
    pick = random.Random(8)
    base = words(1, 90, 5000)
    rows = []
    for k in range(90):
        text = list(base)
        # three strands of one text, far enough apart that only some documents link
        for place in range(0, 8 + 6 * (k % 3)):
            text[place * 3 + k % 3] = f"strand{k % 3}x{place}"
        for _ in range(pick.choice([0, 1, 2])):
            text[pick.randrange(len(text))] = f"new{k}"
        rows.append((k, " ".join(text), "x", "s", 1))
    rounds = []
    plain = minhash._second_round
    monkeypatch.setattr(minhash, "_second_round", lambda *a: rounds.append(1) or plain(*a))
    assert found(minhash.near_duplicates(frame(spark, rows), ws)) == expected(rows)
    assert rounds


def test_rows_that_share_an_id_are_judged_by_their_text(spark, ws):
    a, b, c = (" ".join(words(seed, 40, 5000)) for seed in (1, 2, 3))
    near_c = c.replace(c.split()[20], "other")
    rows = [
        (1, a, "x", "s", 1), (2, a, "x", "s", 1), (2, b, "x", "s", 1), (3, c, "x", "s", 1), (3, c, "x", "s", 1),
        (3, near_c, "x", "s", 1), (3, "", "x", "s", 0), (4, None, "x", "s", 0), (None, a, "x", "s", 1), (5, b, "y", "s", 1),
    ]
    kept = minhash.kept_documents(frame(spark, rows, ("one", "component_id")), ws)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "one", "component_id"]
    left = sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect())
    assert left == sorted([("1", a), ("2", b), ("3", min(c, near_c)), ("3", ""), ("4", ""), ("None", a)])


def test_empty_table(spark, ws):
    assert minhash.near_duplicates(frame(spark, []), ws).collect() == []


def test_cell_links_same_as_pairs():
    pick = np.random.default_rng(4)
    base = pick.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.r_[base[pick.random(300) < 0.9], pick.integers(0, 2**63, 20, dtype=np.uint64)]) for _ in range(40)]
    want = {
        (i, j)
        for i in range(40)
        for j in range(i + 1, 40)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    }
    assert set(zip(*(x.tolist() for x in minhash.cell_links(sets, None)))) == want
    i, j = minhash.cell_links(sets[:20], sets[20:])
    assert set(zip(i.tolist(), (j + 20).tolist())) == {(a, b) for a, b in want if a < 20 <= b}


def test_shingle_sets():
    sets = minhash.shingle_sets(pa.array(["A b c d e f", "a B c d e", "a b", "a  b ", None, "", "x"]))
    assert [len(s) for s in sets] == [2, 1, 1, 1, 0, 0, 1]
    assert sets[1][0] in sets[0] and sets[2][0] == sets[3][0]


def test_components(spark, ws):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (205, 203), (203, 204)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long"), ws).collect()}
    want = {(k, 0) for k in range(41)} | {(k, 100) for k in range(100, 140)} | {(k, 203) for k in (203, 204, 205)}
    assert got == want
    assert forest(3, [0, 1, 0], [1, 2, 2]) == [0, 1]
