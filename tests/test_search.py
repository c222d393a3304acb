"""Index and search against a plain Python model."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagequarry.functions import scoring
from pagequarry.functions.fixed import INDEX_STOP_WORDS
from pagequarry.operators import index as ix, search as se, segments as sg, spread as sp
from pagequarry.plans.site_search import build_site, two_panel_page
from pagequarry.session import Workspace
from pagequarry.streaming.indexing import index_stream

DOC_TYPE = "doc_id long, url string, content string"


def terms(text):
    return [w for w in re.findall(r"\w+", text.lower()) if len(w) > 1 and w not in INDEX_STOP_WORDS]


def make_docs():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = {}
    for i in range(120):
        body = rng.choices(vocabulary, k=rng.randrange(3, 40))
        if i % 3 == 0:
            body += ["common"] * rng.randrange(1, 4)  # a term that owns a third of the documents
        docs[i] = " ".join(body)
    docs[120] = docs[0]  # an exact copy ties with it
    docs[121] = ""
    return docs


DOCS = make_docs()
RANKS = {i: (i % 7) / 100 for i in DOCS if i % 5}
QUERIES = {
    1: "common w1 W2", 2: "w3 w3 w3", 3: "the of", 4: "?!", 5: "absent", 6: "w4 w5 absent", 7: "w1 w2 w3 w4 w5 w6 common",
}


def model(query, k, mode="any", ranks=RANKS, score_of=None, rank_once=False):
    score_of = score_of or (lambda b, m, r: 0.3 * b / m + 0.7 * r / 0.05)
    counts = {i: Counter(terms(t)) for i, t in DOCS.items()}
    lengths = {i: sum(c.values()) for i, c in counts.items()}
    avg = sum(lengths.values()) / len(DOCS)

    def bm25(df, tf, length):
        idf = math.log(len(DOCS) / (df + 1)) + 1
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg))

    wanted = set(terms(query))
    scores, matched = Counter(), Counter()
    for term in wanted:
        holding = {i: c[term] for i, c in counts.items() if c[term]}
        for i, tf in holding.items():
            best = bm25(len(holding), max(holding.values()), min(lengths[j] for j in holding))
            rank = ranks.get(i, 0.0)
            if rank_once and matched[i]:
                rank = 0.0
            scores[i] += score_of(bm25(len(holding), tf, lengths[i]), best, rank)
            matched[i] += 1
    hits = [(i, s) for i, s in scores.items() if mode == "any" or matched[i] == len(wanted)]
    hits.sort(key=lambda h: (-round(h[1], 9), h[0]))
    return [(i, round(round(s, 9), 6), len(hits)) for i, s in hits[:k]]  # scores have nine digits


@pytest.fixture(scope="module")
def inputs(spark):
    docs = spark.createDataFrame([(i, f"https://d/{i}", t) for i, t in DOCS.items()], DOC_TYPE)
    queries = spark.createDataFrame(list(QUERIES.items()), "query_id int, text string")
    ranks = spark.createDataFrame(list(RANKS.items()), "doc_id long, rank double")
    ws = Workspace(spark, "search")
    ix.write(docs, ws.path("index"))
    return docs, queries, ranks, ix.open_index(spark, ws.path("index"))


def grouped(hits):
    found = {}
    for r in sorted(hits.collect(), key=lambda r: (r.query_id, r.rank_no)):
        found.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6), r.n_hits))
    return found


@pytest.mark.parametrize("options", [
    {"k": 100}, {"k": 5}, {"k": 3, "mode": "all"}, {"k": 20, "rank_once": True},
])
def test_blended_search(inputs, options):
    docs, queries, ranks, index = inputs
    got = grouped(se.retrieve(queries, index, ranks, **options))
    expected = {q: model(text, **options) for q, text in QUERIES.items()}
    assert got == {q: hits for q, hits in expected.items() if hits}


def test_large_batches_take_the_salted_way(inputs, monkeypatch):
    docs, queries, ranks, index = inputs
    monkeypatch.setattr(sp, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(sp, "HOT_SHARE", 0.05)
    hits = se.retrieve(queries, index, ranks, k=10)
    assert "_salt" in hits._jdf.queryExecution().analyzed().toString()
    assert grouped(hits) == {q: model(t, 10) for q, t in QUERIES.items() if model(t, 10)}


def test_own_scorer_and_unstored_index(inputs):
    docs, queries, ranks, _ = inputs
    hits = se.retrieve(queries, ix.build(docs), k=7, scorer=scoring.bm25_only)
    expected = {q: model(t, 7, score_of=lambda b, m, r: b) for q, t in QUERIES.items()}
    assert grouped(hits) == {q: h for q, h in expected.items() if h}


def test_search_by_rank(inputs):
    docs, queries, ranks, index = inputs
    got = se.search_by_rank(queries, index, ranks, k=4).where("query_id = 6 or query_id = 1").collect()
    for q, text in ((1, QUERIES[1]), (6, QUERIES[6])):
        matching = [i for i, _, _ in model(text, 10**6, "all")]
        expected = sorted(matching, key=lambda i: (-RANKS.get(i, 0.0), i))[:4]
        assert [r.doc_id for r in sorted(got, key=lambda r: r.rank_no) if r.query_id == q] == expected


def test_snippets_and_stored_columns(inputs):
    docs, queries, ranks, index = inputs
    row = index.docs.where("doc_id = 7").first()
    assert (row.url, row.snippet, row.doc_len) == ("https://d/7", DOCS[7][:200], len(terms(DOCS[7])))
    assert index.doc_count().first().n == len(DOCS)


def test_only_needed_buckets_and_columns_are_read(inputs):
    docs, queries, ranks, index = inputs
    one = queries.where("query_id = 2")
    plan = se.retrieve(one, index)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    (postings,) = [s for s in scans if re.search(r"[\[, ]tf#", s)]
    buckets = postings.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "bucket#" in buckets
    pushed = postings.split("PushedFilters: [")[1].split("]")[0]
    assert "In(term" in pushed or "EqualTo(term" in pushed
    assert not any("content#" in s for s in scans)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_page_slices(spark):
    hits = spark.createDataFrame([(i,) for i in range(1, 26)], "rank_no int")
    def page(p):
        return sorted(r.rank_no for r in se.page_slice(hits, p).collect())
    assert page(1) == list(range(1, 11)) and page(3) == list(range(21, 26))
    assert page(0) == page(-1) == page(4) == []
    counts = spark.createDataFrame([(n,) for n in (0, 1, 10, 11, 100)], "n int")
    got = [r[0] for r in counts.select(scoring.page_count(F.col("n"), 10)).collect()]
    assert got == [0, 1, 1, 2, 10]


def test_append_equals_full_build_and_keeps_old_content(spark, inputs, ws):
    docs = inputs[0]
    path = ws.path("index")
    ix.append(docs.where("doc_id < 50"), path, "s1")
    changed = docs.withColumn("content", F.when(F.col("doc_id") < 50, "changed").otherwise(F.col("content")))
    ix.append(changed, path, "s2")
    ix.append(changed, path, "s2")  # a repeated attempt
    ix.append(changed, path, "s3")  # nothing new
    got, full = ix.open_index(spark, path), inputs[3]
    for name in ("docs", "postings", "terms", "stats"):
        mine, theirs = getattr(got, name), getattr(full, name)
        assert sorted(mine.select(theirs.columns).collect()) == sorted(theirs.collect())


def test_unfinished_segment_does_not_count(spark, inputs, ws):
    path = ws.path("index")
    ix.write(inputs[0].where("doc_id < 10"), path, "good")
    ix.write(inputs[0].where("doc_id >= 10"), ws.path("other"), "broken")
    for table in ("docs", "postings", "terms", "stats"):  # all but the manifest's row
        (stored,) = [p for p in (Path(ws.path("other")) / table).iterdir() if p.name.startswith("segment=")]
        parts = ["bucket"] if table == "postings" else []
        spark.read.parquet(str(stored)).write.partitionBy(*parts).parquet(f"{path}/{table}/segment=broken")
    index = ix.open_index(spark, path)
    assert index.docs.count() == 10
    assert index.postings.select(F.max("doc_id")).first()[0] < 10
    assert ix.vacuum(spark, path) == ["broken"] and ix.vacuum(spark, path) == []
    assert ix.open_index(spark, path).docs.count() == 10


def same_index(got, full):
    for name in ("docs", "postings", "terms", "stats"):
        mine, theirs = getattr(got, name), getattr(full, name)
        assert sorted(mine.select(theirs.columns).collect()) == sorted(theirs.collect())


def test_segments_to_merge():
    def sizes(*n):
        return [s.n_docs for s in sg.alike([sg.Segment(f"f{k}", "s", x, 0) for k, x in enumerate(n)])]

    assert sizes() == sizes(5) == sizes(1, 2, 4) == sizes(8, 3, 1) == []
    assert sizes(1, 1) == [1, 1] and sizes(4, 2, 1, 1) == [1, 1, 2, 4] and sizes(100, 1, 1) == [1, 1]
    live = []
    for k in range(1000):  # batches of any size
        live.append(sg.Segment(f"n{k}", "s", 1 + k * 7919 % 13, 0))
        merged = sg.alike(live)
        if merged:
            live = [s for s in live if s not in merged] + [sg.Segment(f"m{k}", "s", sum(s.n_docs for s in merged), 0)]
        assert len(live) <= math.log2(sum(s.n_docs for s in live)) + 1


def test_merging_keeps_the_index_and_bounds_its_segments(spark, inputs, ws):
    docs, queries, ranks, full = inputs
    path = ws.path("index")
    for k in range(7):
        ix.append(docs.where(f"doc_id % 7 <= {k}"), path, f"s{k}")
        assert ix.merge_segments(spark, path) <= 3
    opened = ix.open_index(spark, path)  # before the old segments are dropped
    same_index(opened, full)
    assert len(ix.vacuum(spark, path)) >= 4
    same_index(ix.open_index(spark, path), full)
    ix.append(docs, path, "s3")  # a repeated batch whose segment was merged
    same_index(ix.open_index(spark, path), full)


def test_a_stopped_merge_changes_nothing(spark, inputs, ws, monkeypatch):
    docs, full = inputs[0], inputs[3]
    path = ws.path("index")
    for k in range(3):
        ix.append(docs.where(f"doc_id % 3 <= {k}"), path, f"s{k}")
    before = sg.read_manifest(spark, path)

    def stopped(*_):
        raise RuntimeError("stopped")

    for step in ("commit", "corpus_statistics"):
        with monkeypatch.context() as patch:
            patch.setattr(sg if step == "commit" else ix, step, stopped)
            with pytest.raises(RuntimeError):
                ix.merge_segments(spark, path)
        assert sg.read_manifest(spark, path) == before
        same_index(ix.open_index(spark, path), full)
    assert len(ix.vacuum(spark, path)) == 2  # what the stopped merges left
    assert ix.merge_segments(spark, path) == 1
    same_index(ix.open_index(spark, path), full)


def test_empty_index_and_repeated_ids(spark, inputs, ws):
    docs, queries, ranks, _ = inputs
    ix.write(docs.where("false"), ws.path("empty"))
    index = ix.open_index(spark, ws.path("empty"))
    assert index.docs.count() == index.terms.count() == 0 and index.stats.first() == (0, 0)
    assert se.retrieve(queries, index, ranks).collect() == []
    assert ix.open_index(spark, ws.path("nothing")).docs.count() == 0
    ix.append(docs.where("doc_id < 5"), ws.path("empty"), "later")
    assert ix.open_index(spark, ws.path("empty")).docs.count() == 5
    rows = [("1", "u", "beta beta"), ("1", "u", "alpha gamma"), ("2", "v", None), (None, "w", "no id")]
    odd = spark.createDataFrame(rows, "doc_id string, url string, content string")
    ix.write(odd, ws.path("odd"))
    for index in (ix.open_index(spark, ws.path("odd")), ix.build(odd)):
        assert index.stats.first() == (2, 2)
        assert sorted((r.doc_id, r.doc_len) for r in index.docs.collect()) == [("1", 2), ("2", 0)]
        assert sorted(r.term for r in index.terms.collect()) == ["alpha", "gamma"]


def test_stream_equals_batch_and_resumes(spark, inputs, ws):
    docs, _, _, full = inputs
    arriving = ws.path("arriving")

    def run():
        stream = spark.readStream.schema(DOC_TYPE).option("maxFilesPerTrigger", 1).parquet(arriving)
        index_stream(stream, ws.path("index"), ws.path("checkpoint")).awaitTermination()

    docs.where("doc_id < 60").coalesce(1).write.mode("append").parquet(arriving)
    docs.where("doc_id < 20").coalesce(1).write.mode("append").parquet(arriving)
    run()
    docs.where("doc_id >= 40").coalesce(1).write.mode("append").parquet(arriving)
    run()
    run()
    got = ix.open_index(spark, ws.path("index"))
    for name in ("docs", "postings", "terms", "stats"):
        theirs = getattr(full, name)
        assert sorted(getattr(got, name).select(theirs.columns).collect()) == sorted(theirs.collect())


def test_two_panels(spark, inputs):
    docs, queries, ranks, index = inputs
    related = spark.createDataFrame([(1, "w9 w8"), (3, "")], "query_id int, related_query string")
    page = two_panel_page(queries, related, index, ranks, page=2).collect()
    by_panel = {}
    for r in sorted(page, key=lambda r: r.rank_no):
        by_panel.setdefault((r.query_id, r.panel), []).append((r.doc_id, r.n_results, r.n_pages))
    for key, text in {(1, "regular"): "common w1 w2", (1, "related"): "w9 w8"}.items():
        hits = model(text, 100)
        expected = [(i, len(hits), math.ceil(len(hits) / 10)) for i, _, _ in hits[10:20]]
        assert by_panel[key] == expected
    assert (3, "related") not in by_panel and (3, "regular") not in by_panel


def test_site_from_html_to_hits(spark, ws):
    rows = [
        (f"https://s.example/{n}", f"<title>Page {n}</title><script>x</script>{body}" + "".join(f"<a href='/{t}'>l</a>" for t in to))
        for n, body, to in (("a", "apple tree", "bc"), ("b", "apple pie", "c"), ("c", "pear", "a"))
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    index, ranks = build_site(pages, ws.path("site"), ws)
    queries = spark.createDataFrame([(1, "Apple")], "query_id int, text string")
    got = sorted(se.retrieve(queries, index, ranks).collect(), key=lambda r: r.rank_no)
    assert {r.url[-1] for r in got} == {"a", "b"} and got[0].url.endswith("/a")
    assert got[0].snippet == "page a apple tree l l"
    assert ranks.agg(F.round(F.sum("rank"), 9)).first()[0] == 1.0
