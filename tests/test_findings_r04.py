"""Queries and operators, each where a review found them to take too much disk, or to lose rows."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import blocks as bl, cbow as cb, cells as cl, index as ix, nearest as nr, related as rl, search as se
from pagequarry.operators import spread
from pagequarry.plans import question_answering as qa, site_search as ss
from pagequarry.session import lean
from pagequarry.sources import pages as pg

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_training_in_waves_gives_the_same_vectors(spark, ws, monkeypatch):
    """All copies of a turn lay on disk at once, twice, however many there were."""
    rng = np.random.default_rng(4)
    texts = [(i, [f"w{n}" for n in np.minimum(rng.zipf(1.3, 60), 50)]) for i in range(120)]
    corpus = spark.createDataFrame(texts, "doc_id int, tokens array<string>")
    at_once, before = [], spark.conf.get(CLEANUP)
    deal = cb._averaged
    monkeypatch.setattr(cb, "_averaged", lambda copies, groups: at_once.append(copies) or deal(copies, groups))

    def trained(name, **options):
        ws.root = f"{ws.root}-{name}"
        rows = cb.train_cbow(corpus, ws, 8, 3, 2, 3, 4, 0.0, 5, 900, **options).collect()
        return {r.word: (r.n, r.vector, r.out) for r in rows}

    once = trained("once")
    assert len(at_once) == 3
    waves = trained("waves", wave_bytes=6_000)
    assert len(at_once) > 3 + 3 * 4  # for each turn two waves at least, and as many slices
    assert spark.conf.get(CLEANUP) == before
    assert once.keys() == waves.keys() and len(once) > 20
    for word, (n, vector, out) in once.items():
        assert waves[word][0] == n
        assert waves[word][1] == pytest.approx(vector, abs=1e-6) and waves[word][2] == pytest.approx(out, abs=1e-6)


def test_shuffle_files_go_with_their_job(spark, ws, monkeypatch):
    """They stayed until the driver collected its garbage, so a flow of jobs held those of all of them."""
    seen, own = [], spark.conf.get(CLEANUP)
    with lean(spark):
        seen.append(spark.conf.get(CLEANUP))
        ws.save(spark.range(10).repartition(3, "id"), "a")
        seen.append(spark.conf.get(CLEANUP))
    assert seen == ["true", "true"] and spark.conf.get(CLEANUP) == own
    stages = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = stages.getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}

    before = shuffled()
    ws.save(spark.range(1000).repartition(3, F.col("id") % 7), "b")
    for _ in range(50):  # deleted in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cells_of_queries_meet_the_items_without_copies(spark, kind):
    """Items were copied for each cell of the queries, queries for each cell of the items, all in double precision."""
    rng = np.random.default_rng(11)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(90, 6)))]
    items = spark.createDataFrame(rows, f"item_id int, vector array<{kind}>")
    asked = items.where("item_id % 2 = 0").withColumnRenamed("item_id", "query_id")
    want = sorted(map(tuple, nr.nearest(asked, items, 3, "cosine").collect()))
    cells = nr.nearest(asked, items, 3, "cosine", limit=900)
    plan = cells._jdf.queryExecution().toString()
    assert "CoGroup" not in plan and "Generate" not in plan
    assert sorted(map(tuple, cells.collect())) == want and len(want) == 45 * 3
    assert nr._numbers(items)._jc.toString() == "vector AS vector"


def test_scores_move_as_one_number(spark, ws):
    """Postings moved with the statistics of their terms; scores of a posting are worked out before it moves."""
    texts = ["wind sea", "sea sea", "wind wind a", "x1 of the sea", "sea wind x1"]
    docs = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(texts)], "doc_id long, url string, content string")
    ix.write(docs, ws.path("index"))
    queries = spark.createDataFrame([(1, "wind x1"), (2, "sea")], "query_id int, text string")
    found = se.match(queries, ix.open_index(spark, ws.path("index")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "_shard" in line]
    assert moved and not any("doc_len" in line or "avg_len" in line for line in plan.splitlines()[: plan.splitlines().index(moved[0]) + 1])
    assert {r.query_id for r in found.collect()} == {1, 2}


def test_panels_are_searched_in_waves_of_queries(spark, ws, monkeypatch):
    """Beyond a broadcast of its terms, a batch shuffled a row for each query, document and term."""
    rng = np.random.default_rng(6)
    words = ["wind", "sea", "x1", "stone", "tree", "rock"]
    docs = [(i, f"u{i}", " ".join(rng.choice(words, 4))) for i in range(40)]
    ix.write(spark.createDataFrame(docs, "doc_id long, url string, content string"), ws.path("index"))
    index = ix.open_index(spark, ws.path("index"))
    turns = [(f"q{i}", " ".join(rng.choice(words, 2))) for i in range(12)]
    queries = spark.createDataFrame(turns, "query_id string, text string")
    related = queries.select("query_id", F.lit("tree rock").alias("related_query"))
    searched = []
    retrieve = se.retrieve
    monkeypatch.setattr(se, "retrieve", lambda batch, *a, **o: searched.append(batch) or retrieve(batch, *a, **o))

    def page():
        rows = ss.two_panel_page(queries, related, index, page=1, k=8, per_page=5).collect()
        return sorted(map(tuple, rows))

    want = page()
    assert len(searched) == 1 and len(want) > 60
    monkeypatch.setattr(spread, "BROADCAST_BYTES", 1500)
    assert page() == want and len(searched) > 3


def test_blocks_of_a_ranked_index_move_once(spark, ws, monkeypatch):
    """Postings moved twice more for their blocks, by hash and then by range."""
    monkeypatch.setattr(bl, "BLOCK", 4)
    monkeypatch.setattr(ix, "RANGE_ROWS", 15)
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["wind", "sea", "x1", "stone"], 3)) for _ in range(30)]
    docs = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(texts)], "doc_id long, url string, content string")
    ix.write(docs, ws.path("index"))
    dealt = []
    count = bl.range_count
    monkeypatch.setattr(bl, "range_count", lambda df: dealt.append(df.columns) or count(df))
    ranks = spark.createDataFrame([(i, (i % 7) / 10) for i in range(30)], "doc_id long, rank double")
    bl.write(ix.open_index(spark, ws.path("index")), ranks, ws.path("ranked"))
    assert len(dealt) == 2 and "number" in dealt[1]  # postings themselves go to the ranges of the blocks
    index = bl.open_index(spark, ws.path("ranked"))
    want = {}
    for r in index.postings.collect():
        want.setdefault((r.term, r.block), []).append(r)
    got = {(r.term, r.block): r for r in index.blocks.collect()}
    assert index.blocks.count() == len(got) and got.keys() == want.keys() and len(got) > 8
    for key, rows in want.items():
        assert got[key].bits == sum(1 << r.number % 4 for r in rows) and got[key].max_tf == max(r.tf for r in rows)
        assert got[key].min_len == min(r.doc_len for r in rows) and got[key].max_rank == max(r.rank for r in rows)


def test_store_is_built_in_waves_of_texts(spark, ws, monkeypatch):
    """All chunks were stored twice, and all that embeds them lay on disk at once."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(40)]
    vectors = spark.createDataFrame([(w, rng.normal(size=3).tolist()) for w in words], "word string, vector array<double>")
    texts = [(f"s{i}", " ".join(rng.choice(words, 400))) for i in range(30)] + [("none", None), (None, "w1 w2")]
    texts = spark.createDataFrame(texts, "source string, content string")
    embedded = []
    embedding = lambda df: embedded.append(df) or rl.embed_with_vectors(df, vectors, limit=0)
    shown = lambda df: sorted((r.chunk_id or "", r.start_index, r.page_content, [round(x, 9) for x in r.vector]) for r in df.collect())
    want = shown(qa.build_vector_store(texts, embedding, ws.path("once")))
    assert len(embedded) == 1 and len(want) > 60
    made = qa.build_vector_store(texts, embedding, ws.path("waves"), wave_bytes=20_000)
    assert shown(made) == want and shown(qa.open_vector_store(spark, ws.path("waves"))) == want
    assert len(embedded) > 2
    monkeypatch.setattr(cl.Workspace, "save", lambda ws, df, name, save=cl.Workspace.save: stored.append(name) or save(ws, df, name))
    stored = []
    cl.build_cells(made.where("chunk_id IS NOT NULL").select(F.col("chunk_id").alias("item_id"), "vector"), ws.path("cells"), 10)
    assert stored == ["dealt"]  # vectors lay there once more with their cells
    items = spark.read.parquet(ws.path("cells/items"))
    cells = spark.read.parquet(ws.path("cells/cells"))
    assert items.count() == cells.agg(F.sum("n")).first()[0] and cells.count() > 3


def test_pages_of_one_key_come_back_whole(spark, ws):
    """Pages of one key that one task wrote became one file, so fewer rows came back."""
    keyed = [("k1", "<p>one</p>\nmore"), ("k1", "<p>two</p>"), ("0123", "a\n"), ("a/b=c%", "x"), ("2024-01-01", "y"), ("k1", "<p>two</p>")]
    pg.write_page_directory(spark.createDataFrame(keyed, "url_key string, html string").coalesce(1), ws.path("sites"))
    parallelism = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(parallelism)
    got = pg.read_exported_pages(spark, ws.path("sites"))
    assert got.columns == ["url_key", "html"] and sorted(map(tuple, got.collect())) == sorted(keyed)
    texts = pg.read_text_directory(spark, ws.path("sites"))
    assert sorted(r.content for r in texts.collect()) == sorted(html + "\n" for _, html in keyed)
    assert spark.conf.get(parallelism) == before
