import math

import numpy as np
import pytest

from pagequarry.llm import whitening


def operator(values: np.ndarray, seed: int = 0) -> np.ndarray:
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(1).random(150) ** 3,
        np.linspace(1, 0.1, 200),
        np.geomspace(1e6, 1e-3, 64),
        np.r_[np.ones(40), np.full(24, 0.5)],  # repeated eigenvalues
        np.r_[np.ones(5), np.zeros(60)],
        np.array([3.0, 2.0, 1.0]),
        np.array([2.0]),
    ],
)
def test_eigenpairs_to_double_precision(values):
    a = operator(values)
    found, vectors, worst = whitening.eigenpairs(lambda u: a @ u, len(values), 32)
    expected = np.sort(np.linalg.eigvalsh(a))[::-1][:32]
    scale = expected[0]
    assert np.abs(found - expected).max() < 1e-13 * scale
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * scale and worst < 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    many = [operator(np.r_[np.linspace(1, 3, 6), -np.linspace(1, 2, 4)], seed=k) for k in range(3)]
    b = rng.standard_normal((10, 3))
    x = whitening.minres(lambda v: np.stack([m @ v[:, k] for k, m in enumerate(many)], axis=1), b, 10)
    for k, m in enumerate(many):
        assert np.abs(m @ x[:, k] - b[:, k]).max() < 1e-8


def rows_of(spark, vectors, ws, monkeypatch=None, **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    return whitening.whitened(df.withColumn("n", F.lit(7)).withColumn("d", F.lit("x")), ws, **options).collect()


def vectors(n: int, d: int, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) / 4).astype(np.float32)


def plain(v: np.ndarray, k: int):
    x = np.floor(64 * v.astype(float))
    n = len(x)
    c = x - x.mean(axis=0)
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    whole = x.astype(int) + 1_000_000
    return c @ u / np.sqrt(e), e / np.trace(cov), ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)


def test_same_as_dense_eigenvectors(spark, ws, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 4000)  # many blocks
    for d, k in ((40, 32), (12, 5), (1, 32)):
        v = vectors(700, d, seed=d)
        rows = rows_of(spark, [(i, x.tolist(), None) for i, x in enumerate(v)], ws, components=k)
        white, explained, deviation = plain(v, k)
        k = min(k, d)
        assert len(rows) == 700 * k and {r["n"] for r in rows} == {700}
        got = np.zeros((700, k))
        for r in rows:
            got[r["vec_id"], r["component"] - 1] = r["whitened"]
            assert r["deviation"] == deviation[r["vec_id"]]
            assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9)
        sign = np.sign((got * white).sum(axis=0))
        assert np.abs(got - white * sign).max() < 1e-8
        assert np.abs(np.cov(got.T, bias=True) - np.eye(k)).max() < 1e-9
        assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_what_is_left_out(spark, ws):
    v = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.5]]
    odd = [None, [], [1.0, None], [1.0, math.nan], [math.inf, 0.0], [1.0, 2.0, 3.0]]
    rows = rows_of(spark, [(k, x, 1) for k, x in enumerate(v + odd)] + [(None, v[0], 1), (0, v[0], 1)], ws)
    ids = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"]) for r in rows)
    assert ids == [(-1, 1), (-1, 2), (0, 1), (0, 1), (0, 2), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert {r["n"] for r in rows} == {5}
    # one direction without variance, then none with any
    flat = rows_of(spark, [(k, [float(k), 5.0], None) for k in range(4)], ws)
    assert {r["component"] for r in flat} == {1} and len(flat) == 4 and math.isclose(flat[0]["explained"], 1.0)
    assert rows_of(spark, [(k, [1.0, 5.0], None) for k in range(4)], ws) == []
    assert rows_of(spark, [], ws) == [] and rows_of(spark, [(1, None, 1)], ws) == []
    with pytest.raises(Exception, match="too large"):
        rows_of(spark, [(1, [1e30], 1), (2, [0.0], 1)], ws)


def test_query_as_dense(spark):
    from pagequarry.llm.registry import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    white, explained, deviation = plain(np.stack(table["embedding"]), 32)
    got = QUERIES["op12_whitening"](spark, sf_dir).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    assert wide.shape == (len(table), 32)
    assert np.abs(wide - white * np.sign((wide * white).sum(axis=0))).max() < 1e-6
    assert (got.groupby("vec_id")["deviation"].first().loc[table["vec_id"]].to_numpy() == deviation).all()
    assert got["identity_error"].max() < 1e-4
