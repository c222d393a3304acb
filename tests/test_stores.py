"""Sources, sinks and sessions."""

import base64
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagequarry import session
from pagequarry.functions import text as tx
from pagequarry.sources import pages as pg, quarantine as qn, tables as tb


def key(url):
    return base64.urlsafe_b64encode(url.encode()).decode()


def test_page_directory(spark, tmp_path):
    (tmp_path / key("https://s/a")).write_text("<p>one</p>\n<p>two</p>\n", encoding="utf-8")
    (tmp_path / key("https://s/é")).write_text("<p>ü</p>", encoding="utf-8")
    (tmp_path / "%%broken").write_text("x")
    good, bad = pg.read_page_directory(spark, str(tmp_path))
    assert sorted((r.url, r.html) for r in good.collect()) == [
        ("https://s/a", "<p>one</p>\n<p>two</p>\n"), ("https://s/é", "<p>ü</p>"),
    ]
    assert [r.reason for r in bad.collect()] == ["key is not base64 of UTF-8"]


def test_text_directory_keeps_its_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text("l1\nl2")
    rows = pg.read_text_directory(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.content) for r in rows] == [("a.txt", "l1\nl2")]
    assert rows[0].source.endswith("/a.txt")


def test_page_sinks(spark, ws):
    pages = spark.createDataFrame(
        [(1, "https://s/a", "old"), (2, "https://s/a", "new"), (3, "https://s/b", "b")], "n int, url string, html string"
    )
    latest = pg.latest_pages(pages, F.col("url"), "n").collect()
    assert sorted((r.url, r.html) for r in latest) == [("https://s/a", "new"), ("https://s/b", "b")]
    path = ws.path("pages")
    for _ in range(2):
        pg.append_new_pages(pages, path, "url", "n")
    assert sorted((r.url, r.html) for r in spark.read.parquet(path).collect()) == [("https://s/a", "old"), ("https://s/b", "b")]


def test_upsert_by_key(spark, ws):
    def put(*rows):
        pages = spark.createDataFrame(list(rows), "n int, url_key string, url string, html string")
        pg.upsert_pages(pages, path, ws, "n", parts=4)
        return {r.url_key: r.html for r in spark.read.parquet(path).collect()}

    def files():
        return {f for f in Path(path).rglob("*.parquet")}

    path = ws.path("upserted")
    first = put(*[(1, f"k{i}", "u", "old") for i in range(40)], (2, "k0", "u", "newer"), (3, None, "u", "no key"))
    assert first == {f"k{i}": "newer" if i == 0 else "old" for i in range(40)}
    before = files()
    second = put((1, "k5", "u", "new"), (0, "k5", "u", "older"), (1, "k40", "u", "more"))
    assert second == first | {"k5": "new", "k40": "more"}
    assert put((1, "k5", "u", "new"), (1, "k40", "u", "more")) == second  # a repeated attempt
    assert before & files()  # folders without a new page are left alone


def test_html_responses(spark):
    df = spark.createDataFrame([("text/html; charset=utf-8",), ("image/png",)], "t string")
    assert [r[0] for r in df.select(tx.is_html_response(F.col("t"))).collect()] == [True, False]


def test_corpus_is_built_once(spark, ws):
    pages = spark.createDataFrame([("u", "<b>A, b</b>")], "url string, html string")
    assert pg.token_corpus(pages, ws.path("corpus")).first().tokens == ["a", "b"]
    other = spark.createDataFrame([("u", "other")], "url string, html string")
    assert pg.token_corpus(other, ws.path("corpus")).first().tokens == ["a", "b"]


def test_ranks_are_built_once(spark, ws):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, weight long")
    first = sorted(tb.build_ranks(edges, ws.path("site"), ws, rounds=2).collect())
    more = spark.createDataFrame([("a", "c", 1)], "src string, dst string, weight long")
    assert sorted(tb.build_ranks(more, ws.path("site"), ws, rounds=2).collect()) == first


def test_crawl_state(spark, ws):
    edges, frontier, scanned = tb.load_crawl_state(spark, ws.path("crawl"), "https://s")
    assert edges.collect() == [("https://s", "https://s")] and frontier.collect() == [("https://s",)]
    assert scanned.count() == 0
    found = spark.createDataFrame([("https://s", "https://s/a")] * 2, "src string, dst string")
    queue = spark.createDataFrame([("https://s/a",)], "url string")
    tb.save_crawl_state(found, queue, frontier, ws.path("crawl"))
    edges, frontier, scanned = tb.load_crawl_state(spark, ws.path("crawl"), "unused")
    assert sorted(map(tuple, edges.collect())) == [
        ("https://s", "https://s"), ("https://s", "https://s/a"), ("https://s/a", "https://s/a"),
    ]
    assert frontier.collect() == [("https://s/a",)] and scanned.collect() == [("https://s",)]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = session.Workspace(spark, "x").root
    if configured:
        assert root.startswith(configured.rstrip("/") + "/x-")
    assert session.read_if_present(spark, root) is None

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        session.shared_dir(Cluster)


def test_token_corpus_after_an_interrupted_build(spark, ws):
    pages = spark.createDataFrame([("https://s/1", "<p>Two words</p>")], "url string, html string")
    Path(ws.path("tokens").removeprefix("file:"), "_temporary").mkdir(parents=True)
    assert [r.tokens for r in pg.token_corpus(pages, ws.path("tokens")).collect()] == [["two", "words"]]


def test_bad_rows_are_set_aside(spark, ws):
    rows = [(1, "u1", "text"), (None, "u2", "text"), (3, None, "  "), (4, "u4", None), (None, "u5", None)]
    docs = spark.createDataFrame(rows, "doc_id long, url string, content string")
    errors = ws.path("errors")

    def table():
        return sorted((r.job, r.key, r.reason, r.n) for r in spark.read.parquet(errors).collect() if r.key) + sorted(
            (r.job, r.reason, r.n) for r in spark.read.parquet(errors).collect() if not r.key
        )

    for _ in range(2):  # a repeated job replaces its rows
        assert [tuple(r) for r in qn.indexable(docs, errors, ws).collect()] == [(1, "u1", "text")]
    first = [("index", "3", "no content", 1), ("index", "4", "no content", 1)]
    assert table() == first + [("index", "kept", 1), ("index", "no id", 1), ("index", "no id", 1)]
    ranks = spark.createDataFrame([("u1", 0.5), ("u4", 0.25)], "url string, rank double")
    good = qn.ranked(docs.where("doc_id IS NOT NULL"), ranks, errors, ws)
    assert sorted((r.doc_id, r.rank) for r in good.collect()) == [(1, 0.5), (4, 0.25)]
    qn.indexable(docs.where("doc_id = 1"), errors, ws)
    assert table() == [("rank", "3", "no rank", 1), ("index", "kept", 1), ("rank", "kept", 2)]
    pages = spark.createDataFrame([("u", "<html>"), (None, "<html>"), ("v", "plain"), ("w", None)], "url string, html string")
    assert [r.url for r in qn.linkable(pages, errors, ws).collect()] == ["u"]
    keyed = pages.select(F.col("url").alias("url_key"), F.concat("html", F.repeat(F.lit("word "), 400)).alias("html"))
    assert sorted(r.url_key for r in qn.cleanable(keyed, errors, ws).collect()) == ["u", "v"]
    sums = {r.job: r.n for r in spark.read.parquet(errors).groupBy("job").agg(F.sum("n").alias("n")).collect()}
    assert sums == {"index": 1, "rank": 3, "links": 4, "clean": 4}
    assert qn.indexable(docs.limit(0), errors, ws).count() == 0
