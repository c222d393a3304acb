import numpy as np
import pytest

from pagequarry.llm import caps

SHAPE = "vec_id long, embedding array<float>, label int, rep int, kind int"


def rows(seed, n=400, dim=48, groups=25):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((groups, dim))
    out = []
    for k in range(n):
        v = centres[pick.integers(groups)] + pick.standard_normal(dim) * pick.choice([0.0, 0.05, 0.12, 0.2])
        out.append((k, (v * pick.choice([1, 3])).astype(np.float32).tolist(), int(pick.integers(2)), 1, 1))
    nan, inf = float("nan"), float("inf")
    base = out[0][1]
    odd = [None, [], [0.0] * dim, [nan] * dim, [inf] + base[1:], base[:10], base[:10], [None] + base[1:], base]
    out += [(n + k, v, 0, 1, 1) for k, v in enumerate(odd)]
    out += [(n + 50, base, None, 1, 1), (n + 51, base, None, 1, 1), (None, base, out[0][2], 1, 1), (3, out[3][1], out[3][2], 1, 1)]
    return out


def expected(table):
    n = len(table)
    units = []
    for _, v, *_ in table:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [0] * n
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            x, y = units[a], units[b]
            same = table[a][2] is not None and table[a][2] == table[b][2]
            if x is not None and y is not None and same and len(x) == len(y) and x @ y >= 0.98:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    groups = {}
    for k in range(n):
        groups.setdefault(root(k), []).append(table[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((table[k][0], links[k], least[root(k)]) for k in range(n)), key=repr)


@pytest.mark.parametrize("block", [1024, 16])
def test_same_as_all_pairs(spark, ws, block, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK_ROWS", block)
    table = rows(1)
    got = caps.near_vectors(spark.createDataFrame(table, SHAPE), ws).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == expected(table)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_recall_of_filters():
    pick = np.random.default_rng(5)
    x = pick.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = pick.standard_normal((2000, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * z  # exactly at the threshold
    a, b = caps.filters_of(x, 40), caps.filters_of(y, 40)
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]) >= 0.999
    assert np.mean([len(p) for p in a]) < 40  # of 1600


def test_list_decoding_same_as_trying_all():
    pick = np.random.default_rng(6)
    x = pick.standard_normal((50, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes = [caps._codes(10, 12, k) for k in (0, 1)]
    for row, found in zip(x, caps.filters_of(x, 12)):
        scores = (codes[0] @ row[:10])[:, None] + (codes[1] @ row[10:])[None, :]
        want = np.flatnonzero(scores.ravel() >= scores.max() - caps.WIDTH * np.sqrt(2) - 1e-12)
        assert set(found) <= set(want) and len(want) - len(found) <= 1


def test_empty_table(spark, ws):
    assert caps.near_vectors(spark.createDataFrame([], SHAPE), ws).collect() == []
