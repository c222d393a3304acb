"""Keyword search over an index, for a whole batch of queries at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions import scoring, text as tx
from pagequarry.functions.fixed import HITS_PER_PAGE, HITS_PER_QUERY
from pagequarry.operators.index import Index, bucket_of
from pagequarry.operators import spread
from pagequarry.operators.spread import row_bytes, shard_of, spread_join, top_k


# Widest row made of a query term: its statistics and the overhead of a hash table.
WEIGHTED_ROW_BYTES = 128
# Up to so many distinct terms are written into the scan of the postings, so that
# files and row groups without them are passed over.
LITERAL_TERMS = 2000
HIT_ROW_BYTES = 256
SHARD_PAIRS = 2_000_000  # pairs of a query's term and a document that a task adds up
SHARD_DOCS = 10  # documents of a shard for each hit that leaves it, at least


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct index terms of ``queries(query_id, text)``; F13: no terms, no rows."""
    terms = F.array_distinct(tx.index_terms(F.col("text")))
    return queries.select(
        "query_id", F.size(terms).alias("n_terms"), F.posexplode(terms).alias("pos", "term")
    ).withColumn("bucket", bucket_of())


@dataclass(frozen=True)
class BatchSize:
    """What one pass over the query terms tells about a batch."""

    term_bytes: int
    queries: int
    buckets: list[int]

    @classmethod
    def of(cls, terms: DataFrame) -> "BatchSize":
        row = terms.select(row_bytes(terms).alias("b"), "pos", "bucket").agg(
            F.sum(F.col("b") + WEIGHTED_ROW_BYTES).alias("b"),
            F.count_if(F.col("pos") == 0).alias("n"),
            F.collect_set("bucket").alias("buckets"),  # at most BUCKETS values
        ).first()
        return cls(row["b"] or 0, row["n"], sorted(row["buckets"]))

    def hit_bytes(self, k: int) -> int:
        return self.queries * k * HIT_ROW_BYTES


def document_ranks(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """Rank of every document by URL, 0 if it has none."""
    return docs.select("doc_id", "url").join(ranks.select("url", "rank"), "url", "left").select(
        "doc_id", F.coalesce("rank", F.lit(0.0)).alias("rank")
    )


def ranked_documents(docs: DataFrame, ranks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their rank, for indexing, and those without one, to quarantine.

    Ranks are one row for each URL, as PageRank gives them.
    """
    joined = docs.join(ranks.select("url", "rank"), "url", "left")
    bad = joined.where("rank IS NULL").select("doc_id", "url", F.lit("no rank").alias("reason"))
    return joined.where("rank IS NOT NULL"), bad


def greatest_rank(ranks: DataFrame) -> DataFrame:
    """A7."""
    return ranks.agg(F.max("rank").alias("max_rank"))


def _weighted_terms(terms: DataFrame, index: Index, size: BatchSize) -> DataFrame:
    """Wanted terms with idf and the greatest BM25 a document can reach (M3)."""
    wanted = terms.select("term").distinct()
    found = spread_join(index.terms, wanted, ["term"], "left_semi", small_bytes=size.term_bytes)
    n_docs = index.stats.select("n_docs").scalar()
    avg_len = index.stats.select(F.try_divide("total_len", "n_docs")).scalar()
    weighted = found.select(
        "term",
        scoring.idf(n_docs, F.col("df")).alias("idf"),
        "max_tf",
        "min_len",
        avg_len.alias("avg_len"),
    )
    best = scoring.bm25(F.col("idf"), F.col("max_tf"), F.col("min_len"), F.col("avg_len"))
    return weighted.select(bucket_of().alias("bucket"), "term", "idf", "avg_len", best.alias("max_bm25"))


def shard_count(terms: DataFrame, index: Index, size: BatchSize, k: int) -> int:
    """Shards of the documents: one for each shuffle partition, and more as pairs to add up need them.

    A task then holds its pairs in memory, however large index and batch are. A shard that had few
    documents would pass them all on, so this ends at SHARD_DOCS * k documents.
    """
    least = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = terms.groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    found = spread_join(index.terms.select("term", "df"), asked, ["term"], small_bytes=size.term_bytes)
    pairs = found.agg(F.sum(F.col("df") * F.col("_n"))).first()[0] or 0
    if pairs <= least * SHARD_PAIRS:
        return least
    n_docs = index.stats.select("n_docs").first()[0]
    return max(least, min(-(-pairs // SHARD_PAIRS), n_docs // (SHARD_DOCS * k)))


def _by_shard(df: DataFrame, shards: int) -> DataFrame:
    """Deal rows out by document; rows of a shard form one partition."""
    return df.withColumn("_shard", shard_of(["doc_id"], shards)).repartitionById(
        shards, F.col("_shard")
    )


def match(
    queries: DataFrame,
    index: Index,
    ranks: DataFrame | None = None,
    scorer: scoring.Scorer = scoring.bm25_only,
    mode: str = "any",
    rank_once: bool = False,
    size: BatchSize | None = None,
    k: int = HITS_PER_QUERY,
) -> DataFrame:
    """All matching documents: (query_id, doc_id, score, rank, _shard); ``k`` of a query will be kept.

    ``mode='all'`` keeps documents that hold every term (A9). The scorer runs
    per term, so a scorer with a rank part counts it once per matching term;
    ``rank_once`` counts it once per document.
    """
    terms = query_terms(queries)
    size = size or BatchSize.of(terms)
    shards = shard_count(terms, index, size, k)
    # the bucket is the partition column of stored postings: others are not read
    stored = index.postings.where(F.col("bucket").isin(size.buckets))
    wanted = terms.select("term").distinct().limit(LITERAL_TERMS + 1).collect()
    if len(wanted) <= LITERAL_TERMS:
        stored = stored.where(F.col("term").isin([row["term"] for row in wanted]))
    postings = spread_join(
        stored,
        _weighted_terms(terms, index, size),
        ["bucket", "term"],
        spread_on=["doc_id"],
        small_bytes=size.term_bytes,
    )
    relevance = scoring.bm25(F.col("idf"), F.col("tf"), F.col("doc_len"), F.col("avg_len"))
    # Postings of wanted terms are dealt out by document, once, with what scores need of them. All terms
    # of a document then meet in one place, where they are scored, summed per query
    # and cut down without another shuffle.
    postings = _by_shard(postings.select("term", "doc_id", relevance.alias("relevance"), "max_bm25"), shards)
    if ranks is None:
        postings = postings.withColumn("rank", F.lit(0.0))
    else:
        ranked = _by_shard(ranks.select("doc_id", "rank"), shards)
        postings = postings.join(ranked, ["_shard", "doc_id"], "left").withColumn(
            "rank", F.coalesce("rank", F.lit(0.0))
        )
    relevance, best, rank = F.col("relevance"), F.col("max_bm25"), F.col("rank")
    score = scorer(relevance, best, F.lit(0.0) if rank_once else rank)
    scored = postings.select("term", "doc_id", "_shard", "rank", score.alias("term_score"))
    sums = [F.sum("term_score").alias("score"), F.first("rank").alias("rank")]
    asked = terms.select("term", "query_id")
    if mode == "all":
        asked = terms.select("term", "query_id", "n_terms")
        sums += [F.count(F.lit(1)).alias("n_matched"), F.first("n_terms").alias("n_terms")]
    if size.term_bytes <= spread.BROADCAST_BYTES:
        hits = scored.join(F.broadcast(asked), "term")
    else:
        hits = _by_shard(
            spread_join(
                scored, asked, ["term"], spread_on=["doc_id"], small_bytes=size.term_bytes
            ),
            shards,
        )
    grouped = hits.groupBy("query_id", "_shard", "doc_id").agg(*sums)
    if mode == "all":
        grouped = grouped.where(F.col("n_matched") == F.col("n_terms"))
    if rank_once:
        alone = scorer(F.lit(0.0), F.lit(1.0), rank) - scorer(F.lit(0.0), F.lit(1.0), F.lit(0.0))
        grouped = grouped.withColumn("score", F.col("score") + alone)
    return grouped.withColumn("score", F.round("score", scoring.SCORE_DIGITS)).drop(
        "n_matched", "n_terms"
    )


def best_hits(matches: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The k best per query, with the number of all matches."""
    return top_k(matches, ["query_id"], order, k, ["doc_id"], total="n_hits")


def with_stored(hits: DataFrame, index: Index, size: BatchSize, k: int) -> DataFrame:
    """Add URL and snippet; only the snippet column of the documents is read.

    There are at most ``k`` hits per query, so their size is known beforehand.
    """
    docs = index.docs.select("doc_id", "url", "snippet")
    return spread_join(docs, hits, ["doc_id"], small_bytes=size.hit_bytes(k))


def retrieve(
    queries: DataFrame,
    index: Index,
    ranks: DataFrame | None = None,
    k: int = HITS_PER_QUERY,
    mode: str = "any",
    scorer: scoring.Scorer | None = None,
    rank_once: bool = False,
) -> DataFrame:
    """Q1: (query_id, rank_no, doc_id, url, snippet, score, n_hits)."""
    if scorer is None:
        scorer = scoring.blend()
    size = BatchSize.of(query_terms(queries))
    matches = match(queries, index, ranks, scorer, mode, rank_once, size, k)
    hits = best_hits(matches, [F.desc("score"), F.asc("doc_id")], k)
    return with_stored(hits, index, size, k).select(
        "query_id", "rank_no", "doc_id", "url", "snippet", "score", "n_hits"
    )


def search_by_rank(
    queries: DataFrame, index: Index, ranks: DataFrame, k: int = HITS_PER_PAGE, mode: str = "all"
) -> DataFrame:
    """Q2: matching documents ordered by rank alone (L2)."""
    size = BatchSize.of(query_terms(queries))
    matches = match(queries, index, ranks, scoring.bm25_only, mode, size=size, k=k)
    hits = best_hits(matches, [F.desc("rank"), F.asc("doc_id")], k)
    return with_stored(hits, index, size, k).select("query_id", "rank_no", "doc_id", "url", "rank", "n_hits")


def page_slice(hits: DataFrame, page: int | Column, per_page: int = HITS_PER_PAGE) -> DataFrame:
    """L3: one page of ranked hits; pages count from 1, below 1 there is nothing."""
    page = F.lit(page) if isinstance(page, int) else page
    return hits.where(
        (page >= 1)
        & (F.col("rank_no") > (page - 1) * per_page)
        & (F.col("rank_no") <= page * per_page)
    )
