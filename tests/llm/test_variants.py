import random
import re
import zlib
from collections import Counter

from pagequarry.llm import variants
from tests.llm.data import EDGES, corpus, frame

ALPHABET = "abcé"


def near(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, one_in=None, min_length=7, min_count=2, ratio=10) -> dict:
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if one_in and h % one_in == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    out, form = {}, {}
    for w, n in words.items():
        found = [u for u in words if u != w and abs(len(u) - len(w)) < 2 and near(u, w)]
        best = min(found, key=lambda u: (-words[u], u), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
        out[w] = len(found)
    rows = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, n, out[w], words[form[w]] if form[w] else None)
    return rows


def found(spark, ws, rows, **options) -> dict:
    made = variants.spelling_variants(frame(spark, rows, extra=["n", "form", "word", "part"]), ws, **options).collect()
    assert len({r["word"] for r in made}) == len(made)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in made}


def dense(seed: int, n: int) -> list[tuple]:
    """Texts of few letters, so that most words have many neighbours and repeated letters."""
    pick = random.Random(seed)
    stems = ["".join(pick.choice(ALPHABET) for _ in range(pick.randrange(7, 10))) for _ in range(8)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(40):
            w = list(pick.choice(stems[: 1 + pick.randrange(8)]))
            for _ in range(pick.choice((0, 0, 0, 1, 1, 2))):
                at = pick.randrange(len(w))
                w[at : at + pick.randrange(2)] = pick.choice(["", pick.choice(ALPHABET), pick.choice(ALPHABET) * 2])
            words.append("".join(w).title() if pick.random() < 0.2 else "".join(w))
        rows.append((k, pick.choice(" ;-").join(words), "x", "s", 1))
    return rows


def test_same_as_all_pairs(spark, ws, monkeypatch):
    rows = dense(1, 200)
    for one_in in (None, 3):
        expected = plain(rows, one_in)
        assert len(expected) > 150 and sum(1 for v in expected.values() if v[0]) > 50
        assert any(v[1] not in (w, v[0]) for w, v in expected.items())  # some ways have two steps
        assert found(spark, ws, rows, one_in=one_in) == expected
    # many ranges, small slices, counts sent early
    monkeypatch.setattr(variants, "RANGE_WORDS", 7)
    monkeypatch.setattr(variants, "SLICE_ROWS", 5)
    monkeypatch.setattr(variants, "HELD_WORDS", 10)
    assert found(spark, ws, rows, one_in=3) == expected


def test_scan_over_boundaries():
    """Ranges cut anywhere give the same neighbours."""
    words = {w.encode("latin-1"): v[2] for w, v in plain(dense(2, 40)).items()}

    def scanned(boundaries: list[bytes]) -> Counter:
        import bisect

        rows = []
        for word, n in words.items():
            for j, rotation in enumerate(variants.rotations(word)):
                own = bisect.bisect_right(boundaries, rotation)
                before = bisect.bisect_right(boundaries, rotation[:-1]) if j else own
                rows += [(own, rotation, n, 3 if j else 1)] if own == before else [(own, rotation, n, 1), (before, rotation, n, 2)]
        total = Counter()
        for word, n_near, *_ in variants.scan(iter(sorted(rows))):
            total[word] += n_near
        return total

    whole = scanned([])
    every = sorted({r for w in words for r in variants.rotations(w)})
    assert sum(whole.values()) > 100
    assert scanned(every) == whole and scanned(every[::3]) == whole


def test_edges(spark, ws):
    long = "y" * 600
    rows = EDGES + corpus(20) + [(5000, f"{long} {long} {long}y {long}y STRASSE strasse straßen Łódzianin", None, None, None)]
    rows += [(5001, f"straßen {long[:-1]}z " * 2, "x", "s", 1)] * 2
    assert found(spark, ws, rows) == plain(rows)
    assert found(spark, ws, []) == {}
    assert found(spark, ws, [(1, None, None, None, None), (None, "", "x", "s", 0)]) == {}
    # ties: of two neighbours with equal counts, the smaller spelling
    tied = [(k, "aaaaaaab", "x", "s", 1) for k in range(20)] + [(k, "aaaaaaac", "x", "s", 1) for k in range(20)] + [(90, "aaaaaaad aaaaaaad", "x", "s", 1)]
    assert found(spark, ws, tied)["aaaaaaad"] == ("aaaaaaab", "aaaaaaab", 2, 2, 20)


def test_query_as_plain_python(spark):
    from pagequarry.llm.registry import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    made = QUERIES["op13_spelling_variants"](spark, sf_dir)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in made.collect()}
    counts = plain(rows, 31, ratio=10**9)  # all pairs are too slow for all words: check a part of them against all
    assert {w: v[2] for w, v in got.items()} == {w: v[2] for w, v in counts.items()}
    assert {w: v[3] for w, v in got.items()} == {w: v[3] for w, v in counts.items()}
