import itertools
import zlib

import numpy as np
import pyarrow as pa

from pagequarry.llm import quality
from pagequarry.llm.words import text_bytes
from tests.llm.data import EDGES, corpus, frame


def chains(seed: int):
    rng = np.random.default_rng(seed)
    counts = np.array([1, 3, 0, 6])
    node = np.zeros((10, 2))
    node[:, 1] = 3 * rng.standard_normal(10)
    return rng, counts, node, rng.standard_normal((2, 2))


def test_messages_as_all_labellings():
    _, counts, node, transition = chains(0)
    log, state, pair = quality.forward_backward(node, transition, counts)
    at = 0
    for k, n in enumerate(counts[counts > 0]):
        z, single, double = 0.0, np.zeros((n, 2)), np.zeros((n, 2, 2))
        for s in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(
                sum(node[at + i, s[i]] for i in range(n)) + sum(transition[s[i - 1], s[i]] for i in range(1, n))
            )
            z += weight
            for i in range(n):
                single[i, s[i]] += weight
                if i:
                    double[i, s[i - 1], s[i]] += weight
        assert np.isclose(np.log(z), log[k])
        assert np.allclose(single / z, state[at : at + n]) and np.allclose(double / z, pair[at : at + n])
        at += n


def test_long_chains_keep_their_scale():
    node = np.zeros((50_000, 2))
    node[:, 1] = 40 * np.sin(np.arange(50_000))
    log, state, _ = quality.forward_backward(node, np.array([[3.0, -3], [-3, 3]]), np.array([50_000]))
    assert np.isfinite(log).all() and np.isfinite(state).all() and np.allclose(state.sum(axis=1), 1)


def test_gradient():
    rng, counts, _, _ = chains(1)
    x, labels, w = rng.standard_normal((10, 4)), np.array([1.0, 0, 1, 0]), rng.standard_normal(8)
    _, grad = quality.loss(w, x, counts, labels)
    for i in range(8):
        d = np.eye(8)[i] * 1e-6
        slope = (quality.loss(w + d, x, counts, labels)[0] - quality.loss(w - d, x, counts, labels)[0]) / 2e-6
        assert abs(slope - grad[i]) < 1e-5


def test_line_features():
    texts = ["Ab ab, cd\n\n  \nAb ab, cd\nx !! 12", None, "", "ééé\r"]
    own, size, counts = quality.line_features(*text_bytes(pa.array(texts)))
    assert counts.tolist() == [3, 0, 0, 1] and size.tolist() == [9, 9, 7, 7]
    k = len(quality._CLASSES)
    assert np.isclose(own[0, 0], 1 / 9) and np.isclose(own[2, 1], 2 / 7)  # capitals, digits
    assert np.allclose(own[:3, k + 3], [1, 1, 1])  # "ab" and "ab," differ
    assert own[:, k + 8].tolist() == [0, 1, 0, 0]  # a line that repeats the one before
    near = quality.with_neighbours(own, counts)
    n = quality.FEATURES
    assert (near[0, n : 2 * n] == 0).all() and np.allclose(near[0, 2 * n : 3 * n], own[1]) and (near[3, n : 3 * n] == 0).all()


def labelled(n: int = 240):
    """Good and bad texts; a bad one starts with a good line."""
    rows, labels = [], []
    for k, row in enumerate(corpus(n)):
        words = row[1].split()
        bad = k % 4 == 0
        lines = [" ".join(words[a : a + 8]).capitalize() + "." for a in range(0, len(words), 8)]
        if bad:
            lines[1:] = [" | ".join(line.upper().split()) + " $$$" for line in lines[1:]]
        rows.append((k, "\n".join(lines), "x", "s", 1))
        if k % 3:
            labels.append((k, 0 if bad and len(lines) > 1 else 1))
    return rows, labels


def test_held_out_documents(spark, ws):
    rows, labels = labelled()
    train = spark.createDataFrame(labels, "doc_id long, label int")
    docs = frame(spark, rows)
    field = quality.train(docs, train, ws, sample=100)  # a bounded part of the labels
    made = {r["doc_id"]: r for r in quality.score(docs, field).collect()}
    right = [
        made[k]["predicted"] == (0 if k % 4 == 0 and len(text.split("\n")) > 1 else 1)
        for k, text, *_ in rows
        if k % 3 == 0
    ]
    assert np.mean(right) > 0.97
    again = quality.train(docs, train, ws, sample=100)
    assert np.allclose(again.weights, field.weights)
    assert not np.allclose(quality.train(docs, train, ws, sample=150).weights, field.weights)


def test_edges(spark, ws):
    rows, labels = labelled(60)
    odd = labels + [(3, None), (1000, 1), (1001, 0), (77_777, 1), (None, 1), (1, 0), (1, 1), (1, 1)]
    docs = frame(spark, rows + EDGES, extra=["score", "label", "lines", "features"])
    train = spark.createDataFrame(odd, "doc_id long, label int")
    field = quality.train(docs, train, ws)
    made = quality.score(docs, field)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "lines", "features", "score", "predicted"]
    found = made.collect()
    assert len(found) == len(rows) + len(EDGES)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    empty = {r["score"] for r in found if not (r["text"] or "").strip()}
    assert empty == {field.prior}
    assert len({r["score"] for r in found if r["text"] == "one two"}) == 1
    # no labels, no documents
    none = quality.train(docs, train.where("false"), ws)
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), none).collect() == []
    assert quality.train(docs.where("false"), train, ws).prior == 0.5
    only_empty = quality.train(docs.where("trim(coalesce(text, '')) = ''"), train, ws)
    assert 0 < only_empty.prior < 1 and len(only_empty.weights) == 0


def test_query_on_held_out_documents(spark):
    from pagequarry.llm.registry import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    made = QUERIES["op11_quality"](spark, sf_dir)
    assert made.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = made.collect()
    quality_of = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    judged = [r["predicted"] == quality_of[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in quality_of]
    assert len(judged) > 50 and np.mean(judged) > 0.97
