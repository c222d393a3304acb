"""Work of a search is cut to bounded pieces, whatever the batch."""

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import index as ix, search as se


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("https://s.example/"), "id").alias("url"),
        F.concat(F.lit("apple "), F.repeat(F.lit("pear "), (F.col("id") % 7).cast("int")), F.lit("w"), "id").alias("content"),
    )
    index = ix.build(docs)
    ranks = docs.select("doc_id", ((F.col("doc_id") * 37 % 100) / 100).alias("rank"))
    queries = spark.createDataFrame([(1, "apple"), (2, "pear apple"), (3, "w17 pear")], "query_id int, text string")
    return index, ranks, queries


def found(small, **options):
    index, ranks, queries = small
    hits = se.retrieve(queries, index, ranks, **options).collect()
    by_rank = se.search_by_rank(queries, index, ranks, k=5).collect()
    return sorted(hits, key=lambda r: (r.query_id, r.rank_no)), sorted(by_rank, key=lambda r: (r.query_id, r.rank_no))


def test_shards_follow_the_pairs(spark, small, monkeypatch):
    index, _, queries = small
    terms = se.query_terms(queries)
    size = se.BatchSize.of(terms)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert se.shard_count(terms, index, size, 3) == least
    df = {r.term: r.df for r in index.terms.collect()}
    pairs = sum(df[r.term] for r in terms.collect())
    monkeypatch.setattr(se, "SHARD_PAIRS", 40)
    monkeypatch.setattr(se, "SHARD_DOCS", 1)
    want = -(-pairs // 40)
    assert want > least and se.shard_count(terms, index, size, 3) == want
    # a shard that had few documents would cut nothing
    assert se.shard_count(terms, index, size, 16) == 200 // 16
    assert se.match(queries, index, size=size, k=3).rdd.getNumPartitions() == want


@pytest.mark.parametrize("options", [{"k": 3}, {"k": 3, "rank_once": True}, {"k": 50, "mode": "all"}])
def test_results_do_not_depend_on_shards(small, monkeypatch, options):
    before = found(small, **options)
    monkeypatch.setattr(se, "SHARD_PAIRS", 40)
    monkeypatch.setattr(se, "SHARD_DOCS", 1)
    assert found(small, **options) == before and len(before[0]) > 3
