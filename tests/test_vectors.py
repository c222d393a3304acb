"""Chunks, nearest neighbours, related words and prompts."""

import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.functions.fixed import CONTEXT_SEPARATOR
from pagequarry.operators import answers as an, related as rl
from pagequarry.operators.chunks import chunk_counts, split_documents
from pagequarry.operators import nearest as nr
from pagequarry.operators.cells import build_cells, nearest_in_cells
from pagequarry.operators.nearest import nearest, normalized
from pagequarry.plans.question_answering import ask, build_vector_store, open_vector_store
from pagequarry.session import Workspace
from pagequarry.sources.tables import load_model, save_model


def plain_split(text, size=1000, overlap=500, separators=("\n\n", "\n", " ", "")):
    """Chunks by moving strings from list to list, after the published rule."""
    separator = next((s for s in separators if s == "" or s in text), separators[-1])
    finer = separators[separators.index(separator) + 1 :]
    if separator:
        first, *others = text.split(separator)
        pieces = [first] + [separator + other for other in others]
        pieces = [p for p in pieces if p]
    else:
        pieces = list(text)

    def merge(parts):
        out, buffer = [], []
        for part in parts:
            if buffer and sum(map(len, buffer)) + len(part) > size:
                out.append("".join(buffer).strip())
                while sum(map(len, buffer)) > overlap or (
                    buffer and sum(map(len, buffer)) + len(part) > size
                ):
                    buffer.pop(0)
            buffer.append(part)
        out.append("".join(buffer).strip())
        return [o for o in out if o]

    chunks, fitting = [], []
    for piece in pieces:
        if len(piece) < size:
            fitting.append(piece)
            continue
        chunks += merge(fitting)
        fitting = []
        chunks += plain_split(piece, size, overlap, finer) if finer else [piece]
    return chunks + merge(fitting)


def texts():
    rng = random.Random(5)
    word = lambda: "x" * rng.randrange(1, 12)
    lines = ["\n".join(" ".join(word() for _ in range(20)) for _ in range(n)) for n in (1, 3, 9, 30, 80)]
    return lines + [
        "", " ", "\n\n\n", "short", "y" * 999, "y" * 1000, "y" * 1001, "z" * 2600,
        "a b " + "w" * 1500 + " c d", "para one\n\npara two\n" + "line " * 500, " ".join("q" * 300 for _ in range(10)),
        "é" * 700 + "\n" + "ü" * 700, "p" * 600 + "\n\n" + "q" * 600 + "\n\n\n" + "r" * 100,
    ]


def chunked(spark, size=1000, overlap=500, **options):
    """{number of the text: [(start, chunk), ...]} of texts() and a null."""
    rows = [(i, t) for i, t in enumerate(texts() + [None])]
    docs = spark.createDataFrame(rows, "source int, content string")
    got = {i: [] for i, _ in rows}
    for r in sorted(split_documents(docs, size, overlap, **options).collect(), key=lambda r: r.chunk_no):
        assert r.chunk_no == len(got[r.source])
        got[r.source].append((r.start_index, r.page_content))
    return got


@pytest.mark.parametrize("size, overlap", [(1000, 500), (50, 20), (10, 0)])
def test_chunks_follow_the_rule(spark, size, overlap):
    got = chunked(spark, size, overlap)
    for i, text in enumerate(texts()):
        assert [chunk for _, chunk in got[i]] == plain_split(text, size, overlap)
        for start, chunk in got[i]:
            assert text[start : start + len(chunk)] == chunk and len(chunk) <= size
    assert got[len(texts())] == []


def test_chunk_table(spark):
    rows = [(f"s{i}", t) for i, t in enumerate(texts())] + [("none", None)]
    docs = spark.createDataFrame(rows, "source string, content string")
    chunks = split_documents(docs)
    counts = chunk_counts(docs, chunks).first()
    assert counts.n_documents == len(texts()) + 1
    assert counts.n_chunks == sum(len(plain_split(t)) for t in texts())
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_long_text_without_separators(spark):
    docs = spark.createDataFrame([(1, "\U0001f600b" * 100_000)], "source int, content string")
    made = split_documents(docs).agg(F.count("*"), F.max("start_index"), F.max(F.char_length("page_content"))).first()
    assert tuple(made) == (399, 199_000, 1000)


def test_chunks_by_words(spark):
    def words(piece):
        return F.regexp_count(piece, F.lit("[^ \n]+"))

    docs = spark.createDataFrame([("s", "one two three four five six")], "source string, content string")
    made = split_documents(docs, 3, 1, words).collect()
    assert [r.page_content for r in sorted(made, key=lambda r: r.chunk_no)] == [
        "one two three", "three four five", "five six"
    ]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    items = rng.normal(size=(300, 8))
    items[100:200] = items[:100]  # copies tie
    items[299] = 0
    queries = np.vstack([items[:20], rng.normal(size=(15, 8))])
    def frame(rows, name):
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], f"{name} int, vector array<double>")
    return queries, items, frame(queries, "query_id"), frame(items, "item_id").repartition(7)


def brute(queries, items, k, metric):
    out = {}
    for q, x in enumerate(queries):
        if metric == "cosine":
            norms = np.linalg.norm(items, axis=1) * np.linalg.norm(x)
            score = np.where(norms > 0, items @ x / np.where(norms > 0, norms, 1), 0)
        else:
            score = 1 - ((items - x) ** 2).sum(1) / np.sqrt(2)
        order = sorted(range(len(items)), key=lambda i: (-round(score[i], 9), i))[:k]
        out[q] = [(i, round(score[i], 6)) for i in order]
    return out


@pytest.mark.parametrize("metric", ["cosine", "relevance"])
@pytest.mark.parametrize("limit, per_cell", [(10**9, 50_000), (500, 40)])
def test_nearest_both_ways(vectors, metric, limit, per_cell):
    queries, items, qdf, idf = vectors
    got = {}
    for r in sorted(nearest(qdf, idf, 4, metric, limit, per_cell).collect(), key=lambda r: r.rank_no):
        got.setdefault(r.query_id, []).append((r.item_id, round(r.score, 6)))
    expected = brute(queries, items, 4, metric)
    assert {q: [i for i, _ in hits] for q, hits in got.items()} == {q: [i for i, _ in h] for q, h in expected.items()}
    for q, hits in got.items():
        assert [s for _, s in hits] == pytest.approx([s for _, s in expected[q]], abs=2e-6)


def test_nearest_has_no_pair_rows(vectors):
    for limit in (10**9, 500):
        plan = nearest(vectors[2], vectors[3], 3, limit=limit)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_sides(vectors):
    _, _, qdf, idf = vectors
    assert nearest(qdf.where("false"), idf, 3).count() == 0
    assert nearest(qdf, idf.where("false"), 3).count() == 0


WORDS = {"king": [1, 0.1], "queen": [1, 0.2], "ruler": [1, 0.3], "the": [1, 0.11], "stone": [0, 1], "rock": [0.05, 1]}


@pytest.fixture
def word_table(spark):
    return spark.createDataFrame([(w, [float(x) for x in v]) for w, v in WORDS.items()], "word string, vector array<double>")


def test_expansion(spark, word_table):
    queries = spark.createDataFrame(
        [(1, "The king, king!"), (2, "of the"), (3, "unknown"), (4, "stone queen")], "query_id int, text string"
    )
    got = {r.query_id: (r.related_words, r.related_query) for r in rl.expand_queries(queries, word_table, 2).collect()}
    assert got[1] == (["queen"], "queen")  # nearest are "the" and "queen"; "the" is in the query
    assert got[2] == ([], "") and got[3] == ([], "")
    assert got[4] == (["rock", "ruler", "the"], "rock ruler") or got[4] == (["king", "rock", "ruler", "the"], "king rock ruler")


def test_most_similar_leaves_the_word_out(spark, word_table):
    rows = rl.most_similar(spark.createDataFrame([("king",), ("king",), ("nope",)], "word string"), word_table, 3).collect()
    assert [r.related for r in sorted(rows, key=lambda r: r.rank_no)] == ["the", "queen", "ruler"]


def test_training_and_storing(spark, ws):
    corpus = spark.createDataFrame([(["a", "b", "c", "a", "b"],), (["c", "b", "a", "rare"],)], "tokens array<string>")
    assert sorted(map(tuple, rl.word_counts(corpus).collect())) == [("a", 3), ("b", 3), ("c", 2)]
    model = rl.train(corpus, vector_size=6, partitions=1)
    save_model(model, ws.path("model"))
    again = load_model(ws.path("model"))
    assert sorted(rl.word_vectors(model).collect()) == sorted(rl.word_vectors(again).collect())
    assert {r.word for r in rl.word_vectors(again).collect()} == {"a", "b", "c"}
    texts_df = spark.createDataFrame([(1, "a b"), (2, "zzz")], "item_id int, text string")
    by_id = {r.item_id: r.vector for r in rl.embed_with_model(texts_df, again).collect()}
    assert np.linalg.norm(by_id[1]) == pytest.approx(1) and by_id[2] == [0.0] * 6


@pytest.mark.parametrize("limit", [10**9, 0])
def test_embedding_by_table(spark, word_table, limit):
    df = spark.createDataFrame([(1, "King king stone."), (2, "nothing")], "item_id int, text string")
    rows = rl.embed_with_vectors(df, word_table, limit).collect()
    mean = np.array([2, 1.2]) / 3
    by_id = {r.item_id: r.vector for r in rows}
    assert by_id[1] == pytest.approx(list(mean / np.linalg.norm(mean)))
    assert by_id[2] == [0.0, 0.0]


def test_large_vocabulary_is_refused(spark):
    corpus = spark.createDataFrame([(["a", "b", "a", "b"],)], "tokens array<string>")
    with pytest.raises(ValueError, match="min_count=2"):
        rl.train(corpus, most_words=1)


@pytest.mark.parametrize("tile", [7, 4_000_000])
def test_nearest_in_tiles_with_ties(spark, monkeypatch, tile):
    monkeypatch.setattr(nr, "TILE_SCORES", tile)
    monkeypatch.setattr(nr, "STRIP", 5)
    items = np.array([[1.0, 0], [0, 1], [1, 0], [2, 0], [0, 0], [1, 1], [-1, 0]])
    for blocks in ([slice(0, 7)], [slice(0, 3), slice(3, 4), slice(4, 7)]):
        best = nr.Best(np.array([[1.0, 0], [0, 3]]), 3, "cosine")
        for block in blocks:
            best.add(["g", "b", "c", "d", "e", "f", "a"][block], items[block])
        # of equal scores the least ids
        q, ids, _ = best.found()
        assert list(zip(q.tolist(), ids)) == [(0, "c"), (0, "d"), (0, "g"), (1, "b"), (1, "f"), (1, "a")]


def test_cells_are_exact_and_most_are_not_read(spark, ws):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(40, 6)) * 20
    items = (middle[:, None] + rng.normal(size=(40, 50, 6))).reshape(-1, 6)
    items[:700] = items[0]  # a third are copies
    queries = np.vstack([items[[0, 5, 900]], items[1000:1030] + 0.1, rng.normal(size=(5, 6)) * 20])
    def frame(rows, name):
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], f"{name} int, vector array<double>")
    build_cells(frame(items, "item_id"), ws.path("index"), cell_items=50)
    found = nearest_in_cells(spark, ws.path("index"), frame(queries, "query_id"), 4, ws).collect()
    got = {}
    for r in sorted(found, key=lambda r: r.rank_no):
        got.setdefault(r.query_id, []).append((r.item_id, round(r.score, 6)))
    expected = brute(queries, items, 4, "relevance")
    assert {q: [i for i, _ in hits] for q, hits in got.items()} == {q: [i for i, _ in h] for q, h in expected.items()}
    cells = spark.read.parquet(ws.path("index") + "/cells")
    assert cells.agg(F.sum("n")).first()[0] == len(items) and cells.agg(F.max("n")).first()[0] < 100
    read = spark.read.parquet(ws.path("first")).union(spark.read.parquet(ws.path("later"))).count()
    assert read < 0.5 * cells.count() * len(queries)


def test_cells_without_clusters_or_items(spark, ws, vectors):
    queries, items, qdf, idf = vectors
    for at, (cell_items, k) in enumerate([(300, 4), (10, 4), (10, 400)]):
        path, own = ws.path(f"index{at}"), Workspace(spark, "cells")
        build_cells(idf, path, cell_items=cell_items)
        found = nearest_in_cells(spark, path, qdf, k, own).collect()
        got = {}
        for r in sorted(found, key=lambda r: r.rank_no):
            got.setdefault(r.query_id, []).append(r.item_id)
        assert got == {q: [i for i, _ in h] for q, h in brute(queries, items, k, "relevance").items()}
    build_cells(idf.limit(0), ws.path("none"))
    assert nearest_in_cells(spark, ws.path("none"), qdf, 4, ws).collect() == []


def test_prompts(spark, ws, word_table):
    def source(url):
        return "data/sites/" + base64.urlsafe_b64encode(url.encode()).decode() + ".txt"

    rows = [(source("https://s/1"), "king queen {question}"), (source("https://s/2"), "stone rock"), (source("https://s/1x"), "ruler king")]
    content = spark.createDataFrame(rows, "source string, content string")
    embedding = lambda df: rl.embed_with_vectors(df, word_table)
    build_vector_store(content, embedding, ws.path("store"))
    build_vector_store(content, embedding, ws.path("store"))  # replaces
    store = open_vector_store(spark, ws.path("store"))
    assert store.count() == 3
    questions = spark.createDataFrame([(1, "Who is king?"), (2, "unknown words")], "question_id int, question string")
    got = {r.question_id: r for r in ask(questions, store, embedding, k=2).collect()}
    assert not got[1].refused and got[1].message is None
    assert got[1].sources == ["https://s/1", "https://s/1x"]
    assert "above context: Who is king?" in got[1].prompt and "king queen {question}" in got[1].prompt
    assert got[1].prompt.count(CONTEXT_SEPARATOR) == 2  # one in the template, one between contexts
    assert got[2].refused and got[2].prompt is None and got[2].sources == []
    assert got[2].message == "No response could be made for the inquiry unknown words."


def test_gate_limits(spark):
    questions = spark.createDataFrame([(i, f"q{i}") for i in range(4)], "question_id int, question string")
    hits = spark.createDataFrame([(0, 0.7), (1, 0.699), (2, 0.1), (2, 0.9)], "question_id int, relevance double")
    got = {r.question_id: r.refused for r in an.gate(questions, hits).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True}


def test_normalized(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(normalized(F.col("v"))).collect()] == [pytest.approx([0.6, 0.8]), [0.0, 0.0]]
