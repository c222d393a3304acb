import pytest

from pagequarry.llm import repeats
from tests.llm.data import EDGES, corpus, frame


def expected(rows):
    first = {}
    order = {i: (i is None, i or 0) for i, *_ in rows}
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, order[i]), order[i])
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < order[i]:
                gone.update(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, group", [(8 << 20, 2_000_000), (2_000, 300), (500, 40)])
def test_same_as_brute_force(spark, ws, block, group):
    rows = corpus() + EDGES
    docs = frame(spark, rows, ("n_words", "_block", "repeats", "group"))
    made = repeats.remove_repeats(docs, ws, block, group).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in made), key=repr) == expected(rows)
    assert all(sum(s["end"] - s["start"] for s in r["repeats"]) == r["n_removed"] for r in made)
    assert all(r["group"] == 7 and r["n_words"] is not None for r in made)


def test_prefixes_grow_where_groups_are_large(spark):
    docs = frame(spark, corpus())
    plan = repeats.plan_groups(docs, 40, 64)
    assert len(plan.levels) > 1 and plan.groups > 5
    assert (plan.levels[0] == -1).any() and not (plan.levels[-1] == -1).any()


def test_empty_table(spark, ws):
    assert repeats.remove_repeats(frame(spark, []), ws).collect() == []
