"""Queries and operators, each where a review found them to do too little or to grow too fast."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import answers as an, cbow as cb, index as ix, related as rl
from pagequarry.sources.tables import read_rows
from queries import QUERIES, search as se_queries

SMALL = "/root/testdata/sf0.001"


def test_outgoing_lists_are_cut_in_parts(spark, monkeypatch):
    monkeypatch.setattr("queries.links.LIST_TARGETS", 1)
    rows = QUERIES["outgoing_lists"](spark, SMALL).collect()
    wide = [r for r in rows if r.n_parts > 1]
    assert wide and all(0 <= r.part < r.n_parts for r in rows)
    assert {r.src for r in wide} < {r.src for r in rows}


def test_embedding_in_blocks_sends_each_word_once(spark):
    """Beyond the broadcast limit a block got the vector of a word once for each text that has it."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)]
    table = {w: [float(x) for x in rng.normal(size=4)] for w in words}
    vectors = spark.createDataFrame(list(table.items()), "word string, vector array<float>")
    texts = [(i, " ".join(rng.choice([*words, "unknown"], 40)), f"s{i % 3}") for i in range(60)]
    texts += [(60, None, "s0"), (61, "", "s0"), (62, "unknown", "s1")]
    df = spark.createDataFrame(texts, "item_id int, text string, source string")
    made = rl.embed_with_vectors(df, vectors, limit=0, block_bytes=2000)
    assert made.columns == ["item_id", "text", "source", "vector"]
    assert "FlatMapCoGroupsInArrow" in made._jdf.queryExecution().toString()
    rows = {r.item_id: r for r in made.collect()}
    near = {r.item_id: r.vector for r in rl.embed_with_vectors(df, vectors).collect()}
    assert len(rows) == 63
    for i, text, source in texts:
        known = [np.array(table[w], np.float32) for w in (text or "").split() if w in table]
        mean = np.mean(np.array(known, float), 0) if known else np.zeros(4)
        want = mean / (np.linalg.norm(mean) or 1)
        assert rows[i].text == text and rows[i].source == source
        assert rows[i].vector == pytest.approx(list(want)) and near[i] == pytest.approx(list(want))


def test_chunks_keep_their_columns_without_a_join(spark):
    chunks = spark.createDataFrame(
        [("a", 0, 0, "king"), ("b", 3, 7, "stone king")], "source string, chunk_no int, start_index int, page_content string"
    )
    vectors = spark.createDataFrame([("king", [1.0, 0.0]), ("stone", [0.0, 1.0])], "word string, vector array<double>")
    keeps = lambda texts: rl.embed_with_vectors(texts, vectors)
    plain = lambda texts: rl.embed_with_vectors(texts, vectors).select("item_id", "vector")
    made = an.embed_chunks(chunks, keeps)
    assert made.columns == ["chunk_id", "source", "chunk_no", "start_index", "page_content", "vector"]
    assert "Join" not in made._jdf.queryExecution().toString()
    assert sorted(made.collect()) == sorted(an.embed_chunks(chunks, plain).collect())


@pytest.mark.parametrize("most", [0, 64])
def test_training_adds_repeated_rows_without_sums_by_run(monkeypatch, most):
    """Sums of sorted runs (reduceat) took most of the time; rows that a batch repeats still add up."""
    monkeypatch.setattr(cb, "MOST_RUNS", most)
    rng = np.random.default_rng(2)
    text = np.minimum(rng.zipf(1.4, 700) - 1, 39)
    context, target = cb.keyed_examples([text, np.zeros(50, int)], np.arange(41, 1, -1), 900, 5, 5, 0.0, [1])
    vector, out = rng.normal(size=(40, 8)), rng.normal(size=(40, 8))
    mine = vector.copy(), out.copy()
    cb.train_block(*mine, context, target, (0.025, 0.01))
    for a in range(0, len(context), cb.BATCH):
        rate = 0.025 + (0.01 - 0.025) * a / len(context)
        old, old_out = vector.copy(), out.copy()
        for near, goals in zip(context[a : a + cb.BATCH], target[a : a + cb.BATCH]):
            near = near[near >= 0]
            mean, back = old[near].mean(0), np.zeros(8)
            for k, w in enumerate(goals):
                if w >= 0:
                    step = ((k == 0) - 1 / (1 + np.exp(-mean @ old_out[w]))) * rate
                    back += step * old_out[w]
                    out[w] += step * mean
            for w in near:
                vector[w] += back
    assert np.allclose(mine[0], vector, atol=1e-12) and np.allclose(mine[1], out, atol=1e-12)
    assert "reduceat" not in cb.train_block.__code__.co_names + cb._Adds.add.__code__.co_names


def test_postings_are_counted_in_their_rows(spark, ws, monkeypatch):
    """A task grouped all (term, document) pairs of its texts at once; now nothing is grouped."""
    texts = ["Wind wind sea, wind a", "sea", None, "", "the of a", "x1 x1 x1 x1", "b sea2 sea wind SEA"]
    docs = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(texts)], "doc_id long, url string, content string")
    made = ix.make_postings(docs)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    assert made.columns == ["bucket", "term", "doc_id", "tf", "doc_len"]
    got = sorted((r.term, r.doc_id, r.tf, r.doc_len) for r in made.collect())
    assert got == [("sea", 0, 1, 4), ("sea", 1, 1, 1), ("sea", 6, 2, 4), ("sea2", 6, 1, 4), ("wind", 0, 3, 4),
                   ("wind", 6, 1, 4), ("x1", 5, 4, 4)]
    monkeypatch.setattr(ix, "RANGE_ROWS", 2)  # tasks follow the number of postings
    ix.write(docs, ws.path("index"))
    index = ix.open_index(spark, ws.path("index"))
    assert sorted((r.term, r.doc_id, r.tf, r.doc_len) for r in index.postings.collect()) == got
    assert index.docs.count() == 7 and index.terms.count() == 4


def test_merges_sort_the_stored_postings(spark, ws, monkeypatch):
    """A merge stored all postings once more before it sorted them, and worked out all term statistics again."""
    texts = ["wind sea", "sea sea", None, "wind wind a", "x1 of the sea", ""]
    docs = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(texts)], "doc_id long, url string, content string")
    for name in "ab":
        ix.append(docs.where(f"doc_id % 2 <= {'ab'.index(name)}"), ws.path("index"), name)

    def again(*_):
        raise AssertionError("done again")

    with monkeypatch.context() as patch:
        patch.setattr(ix, "term_statistics", again)
        patch.setattr(ix.Workspace, "save", again)
        assert ix.merge_segments(spark, ws.path("index")) == 1
    ix.write(docs, ws.path("whole"))
    got, want = ix.open_index(spark, ws.path("index")), ix.open_index(spark, ws.path("whole"))
    for name in ("docs", "postings", "terms", "stats"):
        assert sorted(map(repr, getattr(got, name).collect())) == sorted(map(repr, getattr(want, name).collect()))


def test_the_stream_of_documents_has_no_more_files_with_more_tasks(spark, ws):
    """Each task wrote a file for each language, so batches, and merges of all before, grew in number with the input."""
    with_lang = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        se_queries.put_arriving(spark, SMALL, ws.path("arriving"))
    finally:
        for key in ("adaptive.enabled", "shuffle.partitions", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{key}")
    stored = spark.read.parquet(ws.path("arriving"))
    n_lang = with_lang.select("lang").distinct().count()
    assert n_lang < len(stored.inputFiles()) <= n_lang * se_queries.LANG_FILES
    assert sorted(stored.select("doc_id", "lang").collect()) == sorted(with_lang.collect())


def test_copies_of_a_word_are_averaged_in_groups():
    """Averages by a summary for each word sent more than all copies together."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in rng.integers(0, 9, 60)]
    own, rows = rng.integers(1, 50, 60), rng.normal(size=(2, 60, 3)).astype(np.float32)
    lists = [pa.array(r.tolist(), pa.list_(pa.float32())) for r in rows]
    table = pa.table([words, [7] * 60, own, *lists], names=["word", "n", "own", "vector", "out"])
    made = cb.mean_copies(pa.concat_tables([table.slice(0, 25), table.slice(25)])).to_pylist()
    assert [r["word"] for r in made] == sorted(set(words)) and {r["n"] for r in made} == {7}
    for r in made:
        mine = [i for i, w in enumerate(words) if w == r["word"]]
        for name, vectors in zip(("vector", "out"), rows):
            assert np.allclose(r[name], np.average(vectors[mine], axis=0, weights=own[mine]), atol=1e-6)


def test_a_row_group_is_dealt_out(spark, tmp_path):
    """A table in one row group came in many pieces, of which one had all rows."""
    for name, value in (("maxPartitionBytes", "2000"), ("openCostInBytes", "100")):
        spark.conf.set(f"spark.sql.files.{name}", value)
    rows = [(i, f"text {i * 7919}" if i % 9 else None) for i in range(4000)]
    ids, texts = map(list, zip(*rows))
    table = pa.table({"doc_id": ids, "text": texts})

    def pieces(path):
        read = read_rows(spark, str(path))
        plan = read._jdf.queryExecution().toString()
        assert sorted(read.collect()) == sorted(rows, key=lambda r: r[0])
        return [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()], plan

    try:
        pq.write_table(table, tmp_path / "one.parquet")
        assert spark.read.parquet(str(tmp_path / "one.parquet")).rdd.getNumPartitions() >= 8
        sizes, plan = pieces(tmp_path / "one.parquet")
        assert max(sizes) < 2 * 4000 / 8
        assert "RoundRobin" not in plan  # which sorts all that a task has read
        ids = read_rows(spark, str(tmp_path / "one.parquet")).select("doc_id")
        assert "ReadSchema: struct<doc_id:bigint>" in ids._jdf.queryExecution().toString()
        pq.write_table(table, tmp_path / "many.parquet", row_group_size=100)
        sizes, plan = pieces(tmp_path / "many.parquet")
        assert max(sizes) <= 2 * 4000 / 8 and "Repartition" not in plan
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")


def test_words_of_a_training_text_are_worked_out_once(spark):
    """Texts were cut into words for two counts of the words, and once more for the training."""
    cut = spark.sparkContext.accumulator(0)

    def counted(text):
        cut.add(1)
        return text.split()

    texts = spark.createDataFrame([(f"king queen w{i % 3} stone",) for i in range(60)], "text string")
    model = rl.train(texts.select(F.udf(counted, "array<string>")("text").alias("tokens")), vector_size=4)
    assert {r.word for r in rl.word_vectors(model).collect()} == {"king", "queen", "stone", "w0", "w1", "w2"}
    assert cut.value == 60
