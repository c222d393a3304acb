import numpy as np

from pagequarry.llm import fingerprints as fp
from tests.llm.data import EDGES, corpus, frame, words


def test_order_does_not_matter_and_updates_agree():
    parts = [" ".join(words(k, 12)) for k in range(8)] + ["", "one", "two words"]
    whole = fp.fingerprints(["\n".join(parts), "\n".join(reversed(parts)), "\n".join(parts[:-1]), "\n".join([*parts, parts[0]])])
    assert (whole[0] == whole[1]).all()
    assert (whole[0] != whole[2]).any() and (whole[0] != whole[3]).any()
    again = fp.updated(whole[2:3], [parts[-1]], [""])  # an empty text is one empty paragraph
    assert (again[0] + fp.fingerprints([""])[0] == whole[0]).all()


def test_likeness():
    a = "\n".join(" ".join(words(k, 30)) for k in range(40))
    b = a[: len(a) * 3 // 4] + "\n".join(" ".join(words(k, 30)) for k in range(100, 110))
    c = "\n".join(" ".join(words(k, 30)) for k in range(200, 240))
    x = fp.fingerprints([a, b, c, "", ""])
    near = fp.likeness(x[[0, 0, 0, 3, 3, 0]], x[[0, 1, 2, 4, 0, 3]])
    assert near[0] == 1 and 0.6 < near[1] < 0.9 and near[2] < 0.25 and near[3] == 1 and near[4] == near[5] == 0


def test_column_keeps_rows(spark):
    got = fp.fingerprint_column(frame(spark, EDGES, ("fingerprint",))).collect()
    assert len(got) == len(EDGES) and all(len(r["fingerprint"]) == 2 * fp.LANES for r in got)
    by = {(r["doc_id"], r["text"]): r["fingerprint"] for r in got}
    assert by[(1000, None)] == by[(1001, "")] and by[(1003, "one two")] == by[(1004, "one two")]


def pairs(ids, texts, nexts):
    return {"doc_id": ids, "text": texts, "next": nexts}


def test_neighbours_same_as_sorting(spark):
    rows = corpus() + EDGES
    got = fp.map_neighbours(frame(spark, rows, ("bucket", "guest")), pairs, "doc_id long, text string, next string").collect()
    order = sorted(((i is not None, i or 0, t or "") for i, t, *_ in rows))
    want = [(i if known else None, t, order[(k + 1) % len(order)][2]) for k, (known, i, t) in enumerate(order)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_one_row_and_empty_table(spark):
    shape = "doc_id long, text string, next string"
    assert [tuple(r) for r in fp.map_neighbours(frame(spark, corpus(1)), pairs, shape).select("doc_id").collect()] == [(0,)]
    assert fp.map_neighbours(frame(spark, []), pairs, shape).collect() == []


def test_sketch_counts_runs_of_words():
    one, two = fp.fingerprints(["a b c d", "a b c\nb c d"])
    assert np.array_equal(one[fp.EXACT :], two[fp.EXACT :])
    assert np.abs(one[fp.EXACT :].astype(np.int16)).sum() in (0, 2)
