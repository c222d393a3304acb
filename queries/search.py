"""The keyword index and keyword search."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagequarry.functions import scoring, text as tx
from pagequarry.functions.fixed import HITS_PER_PAGE, HITS_PER_QUERY
from pagequarry.operators import blocks as bl, index as ix, search as se
from pagequarry.plans.site_search import build_site, two_panel_page
from pagequarry.session import Workspace
from pagequarry.sources.pages import append_errors
from pagequarry.streaming.indexing import index_stream
from queries import sql
from queries.inputs import (
    WIKI_HOST,
    benchmark_queries,
    document_index,
    documents,
    label_ranks,
    shown,
    stored_once,
    table,
    wiki_pages,
)
from queries.vectors import RELATED, expanded_turns, user_turns


def index_docs(spark, sf_dir):
    return document_index(spark, sf_dir).docs.select("doc_id", "url", "snippet", "doc_len")


def index_postings(spark, sf_dir):
    return document_index(spark, sf_dir).postings.select("term", "doc_id", "tf", "doc_len")


def index_terms(spark, sf_dir):
    """M3: term statistics with the greatest score a document can get."""
    index = document_index(spark, sf_dir)
    n_docs = index.stats.select("n_docs").scalar()
    avg_len = index.stats.select(F.try_divide("total_len", "n_docs")).scalar()
    best = scoring.bm25(
        scoring.idf(n_docs, F.col("df")), F.col("max_tf"), F.col("min_len"), avg_len
    )
    return index.terms.select(
        "term", "df", "max_tf", "min_len", F.round(best, 6).alias("max_quality")
    )


def index_stats(spark, sf_dir):
    return document_index(spark, sf_dir).stats


def _shown(hits):
    return hits.withColumn("score", shown(F.col("score")))


def bm25_search(spark, sf_dir):
    hits = se.retrieve(
        benchmark_queries(spark, sf_dir),
        document_index(spark, sf_dir),
        scorer=scoring.bm25_only,
    )
    return _shown(hits)


def _ranked_documents(spark, sf_dir):
    return se.document_ranks(document_index(spark, sf_dir).docs, label_ranks(spark, sf_dir))


def blended_search(spark, sf_dir):
    hits = se.retrieve(
        benchmark_queries(spark, sf_dir),
        document_index(spark, sf_dir),
        _ranked_documents(spark, sf_dir),
    )
    return _shown(hits)


def blended_search_all_terms(spark, sf_dir):
    hits = se.retrieve(
        benchmark_queries(spark, sf_dir),
        document_index(spark, sf_dir),
        _ranked_documents(spark, sf_dir),
        mode="all",
    )
    return _shown(hits)


def blended_search_rank_once(spark, sf_dir):
    hits = se.retrieve(
        benchmark_queries(spark, sf_dir),
        document_index(spark, sf_dir),
        _ranked_documents(spark, sf_dir),
        rank_once=True,
    )
    return _shown(hits)


def rank_only_search(spark, sf_dir):
    return se.search_by_rank(
        benchmark_queries(spark, sf_dir),
        document_index(spark, sf_dir),
        _ranked_documents(spark, sf_dir),
    )


def _ranked_index(spark, sf_dir):
    """The documents' index in order of rank, written once per session."""
    def build(path):
        bl.write(document_index(spark, sf_dir), _ranked_documents(spark, sf_dir), path)

    return bl.open_index(spark, stored_once(spark, sf_dir, "ranked_index", build))


def pruned_search(spark, sf_dir):
    """M3: the results of blended_search, from the blocks whose bounds reach the k best."""
    batch = benchmark_queries(spark, sf_dir)
    return _shown(bl.retrieve(batch, _ranked_index(spark, sf_dir), Workspace(spark, "pruned")))


def pruned_search_all_terms(spark, sf_dir):
    batch = benchmark_queries(spark, sf_dir)
    return _shown(bl.retrieve(batch, _ranked_index(spark, sf_dir), Workspace(spark, "pruned"), mode="all"))


def rank_ordered_search(spark, sf_dir):
    """L2: the results of rank_only_search, from an index in order of rank."""
    return bl.search_by_rank(
        benchmark_queries(spark, sf_dir), _ranked_index(spark, sf_dir), Workspace(spark, "by_rank")
    )


def ranked_documents_order(spark, sf_dir):
    """The rank stored with each document, and its place among all."""
    return _ranked_index(spark, sf_dir).docs.select("number", "doc_id", "rank", "doc_len")


def document_ranks(spark, sf_dir):
    return _ranked_documents(spark, sf_dir)


def ranked_index(spark, sf_dir):
    """Terms of an index of the documents that have a rank."""
    good, _ = se.ranked_documents(documents(spark, sf_dir), label_ranks(spark, sf_dir))
    path = Workspace(spark, "ranked").path("index")
    ix.write(good.select("doc_id", "url", "content"), path)
    return ix.open_index(spark, path).terms


def rank_quarantine(spark, sf_dir):
    """Documents without a rank, read back from the error table."""
    _, bad = se.ranked_documents(documents(spark, sf_dir), label_ranks(spark, sf_dir))
    return append_errors(bad, Workspace(spark, "errors").path("errors"), "rank")


def greatest_rank(spark, sf_dir):
    return se.greatest_rank(label_ranks(spark, sf_dir))


def stopword_query(spark, sf_dir):
    return user_turns(spark, sf_dir).select(
        "query_id", tx.normalize_query(F.col("text")).alias("query")
    )


def two_panels(spark, sf_dir):
    turns = user_turns(spark, sf_dir)
    related = expanded_turns(spark, sf_dir)
    page = two_panel_page(
        turns, related, document_index(spark, sf_dir), page=2, scorer=scoring.bm25_only
    )
    return _shown(page)


def _wiki_site(spark, sf_dir):
    """Index and ranks of the wiki pages, built once per session."""
    def build(path):
        build_site(wiki_pages(spark, sf_dir), path, Workspace(spark, "wiki"), WIKI_HOST)

    path = stored_once(spark, sf_dir, "wiki_site", build)
    index = ix.open_index(spark, f"{path}/index")
    return index, se.document_ranks(index.docs, spark.read.parquet(f"{path}/ranks"))


def site_search(spark, sf_dir):
    """From HTML to hits: text, links, ranks and index of the pages, then a query batch."""
    index, ranks = _wiki_site(spark, sf_dir)
    return _shown(se.retrieve(benchmark_queries(spark, sf_dir), index, ranks, k=HITS_PER_PAGE))


def index_append(spark, sf_dir):
    """English documents first, then everything; the rest is added as a second segment."""
    docs = documents(spark, sf_dir)
    english = table(spark, sf_dir, "documents").where(F.col("lang") == "en").select("doc_id")
    path = Workspace(spark, "append").path("index")
    ix.append(docs.join(english, "doc_id", "left_semi"), path, "first")
    ix.append(docs, path, "second")
    return ix.open_index(spark, path).terms


def index_merged(spark, sf_dir):
    """Q7: five batches, segments of like size merged after each, unused files deleted."""
    docs = documents(spark, sf_dir)
    path = Workspace(spark, "merged").path("index")
    for k in range(5):
        ix.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == k), path, f"batch{k}")
        ix.merge_segments(spark, path)
    ix.vacuum(spark, path)
    return ix.open_index(spark, path).terms


LANG_FILES = 12  # files of a language, however many documents there are


def put_arriving(spark, sf_dir, path):
    langs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    arriving = documents(spark, sf_dir).join(langs, "doc_id")
    file = F.pmod(F.xxhash64("doc_id"), F.lit(LANG_FILES))
    # more tasks than files, so that few of them get two
    arriving = arriving.repartition(16 * LANG_FILES, F.col("lang"), file)
    arriving.write.partitionBy("lang").parquet(path)


def stream_index(spark, sf_dir):
    """The documents as a stream of files, a few at a time."""
    ws = Workspace(spark, "stream")
    put_arriving(spark, sf_dir, ws.path("arriving"))
    stream = (
        spark.readStream.schema("doc_id long, url string, content string")
        .option("maxFilesPerTrigger", 16)
        .option("recursiveFileLookup", True)
        .parquet(ws.path("arriving"))
    )
    index_stream(stream, ws.path("index"), ws.path("checkpoint")).awaitTermination()
    return ix.open_index(spark, ws.path("index")).postings.select(
        "term", "doc_id", "tf", "doc_len"
    )


QUERIES = {
    "index_docs": index_docs,
    "index_postings": index_postings,
    "index_terms": index_terms,
    "index_stats": index_stats,
    "bm25_search": bm25_search,
    "blended_search": blended_search,
    "blended_search_all_terms": blended_search_all_terms,
    "blended_search_rank_once": blended_search_rank_once,
    "rank_only_search": rank_only_search,
    "pruned_search": pruned_search,
    "pruned_search_all_terms": pruned_search_all_terms,
    "rank_ordered_search": rank_ordered_search,
    "ranked_documents_order": ranked_documents_order,
    "document_ranks": document_ranks,
    "ranked_index": ranked_index,
    "rank_quarantine": rank_quarantine,
    "greatest_rank": greatest_rank,
    "stopword_query": stopword_query,
    "two_panel_page": two_panels,
    "site_search": site_search,
    "index_append": index_append,
    "index_merged": index_merged,
    "stream_index": stream_index,
}

_DOC_INDEX = f"{sql.DOCS}, {sql.INDEX}"


def _search(score: str, where: str = "true", order: str = "score DESC", k: int = HITS_PER_QUERY,
            columns: str = "h.snippet, round(score + 2e-10, 6) AS score") -> str:
    return f"""
WITH {_DOC_INDEX}, {sql.LABEL_RANKS}, {sql.BENCHMARK_QUERIES}, {sql.matches(score)},
{sql.ranked(where, order, k)}
SELECT query_id, rank_no, doc_id, url, {columns.replace('h.snippet', 'content[1:200] AS snippet')}, n_hits
FROM hits JOIN docs USING (doc_id)"""


ORACLES = {
    "index_docs": f"""
WITH {_DOC_INDEX}
SELECT doc_id, url, content[1:200] AS snippet, doc_len::INT AS doc_len FROM docs JOIN lens USING (doc_id)""",
    "index_postings": f"WITH {_DOC_INDEX} SELECT term, doc_id, tf, doc_len::INT AS doc_len FROM post",
    "index_terms": f"""
WITH {_DOC_INDEX}
SELECT term, df, max_tf, min_len::INT AS min_len,
  round((ln(n_docs / (df + 1)) + 1) * (max_tf * 2.2::DOUBLE)
    / (max_tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * min_len / (total_len / n_docs))), 6) AS max_quality
FROM terms CROSS JOIN stats""",
    "index_stats": f"WITH {_DOC_INDEX} SELECT n_docs, total_len::BIGINT AS total_len FROM stats",
    "bm25_search": _search(sql.BM25),
    "blended_search": _search(sql.BLEND),
    "blended_search_all_terms": _search(sql.BLEND, "n_matched = n_terms"),
    "blended_search_rank_once": _search(
        "0.3::DOUBLE * bm25 / max_bm25) + max(0.7::DOUBLE * (rank / 0.05::DOUBLE)"
    ),
    "rank_only_search": _search(
        sql.BM25, "n_matched = n_terms", "rank DESC", HITS_PER_PAGE, "rank"
    ),
    "pruned_search": _search(sql.BLEND),
    "pruned_search_all_terms": _search(sql.BLEND, "n_matched = n_terms"),
    "rank_ordered_search": _search(sql.BM25, "n_matched = n_terms", "rank DESC", HITS_PER_PAGE, "rank"),
    "ranked_documents_order": f"""
WITH {_DOC_INDEX}, {sql.LABEL_RANKS}
SELECT row_number() OVER (ORDER BY coalesce(rank, 0.0) DESC, doc_id) - 1 AS number, doc_id,
  coalesce(rank, 0.0)::DOUBLE AS rank, doc_len::INT AS doc_len
FROM docs JOIN lens USING (doc_id) LEFT JOIN ranks USING (doc_id)""",
    "document_ranks": f"""
WITH {sql.LABEL_RANKS}
SELECT doc_id, coalesce(rank, 0.0)::DOUBLE AS rank FROM documents LEFT JOIN ranks USING (doc_id)""",
    "ranked_index": f"""
WITH docs AS (
  SELECT doc_id, text AS content FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), {sql.INDEX}
SELECT term, df, max_tf, min_len::INT AS min_len FROM terms""",
    "rank_quarantine": f"""
WITH {sql.DOCS}
SELECT doc_id, url, 'no rank' AS reason, 'rank' AS job FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "greatest_rank": f"WITH {sql.LABEL_RANKS} SELECT max(rank) AS max_rank FROM ranks JOIN documents USING (doc_id)",
    "stopword_query": f"""
SELECT conv_id || '/' || turn AS query_id,
  array_to_string(list_filter({sql.plain_words('text')}, lambda w: w NOT IN ({sql.STOP})), ' ') AS query
FROM conversations WHERE role = 'user'""",
    "two_panel_page": f"""
WITH {RELATED}, {_DOC_INDEX}, ranks AS (SELECT 0::BIGINT AS doc_id, 0.0::DOUBLE AS rank WHERE false),
qs AS (
  SELECT query_id || '#regular' AS query_id,
    array_to_string(list_filter(all_words, lambda w: w NOT IN ({sql.STOP})), ' ') AS text FROM turns
  UNION ALL SELECT query_id || '#related', related_query FROM expanded),
{sql.matches(sql.BM25)}, {sql.ranked('true', 'score DESC', HITS_PER_QUERY)}
SELECT split_part(query_id, '#', 1) AS query_id, split_part(query_id, '#', 2) AS panel, rank_no, doc_id, url,
  content[1:200] AS snippet, round(score + 2e-10, 6) AS score, least(n_hits, {HITS_PER_QUERY}) AS n_results,
  ((least(n_hits, {HITS_PER_QUERY}) - 1) // 10 + 1)::INT AS n_pages
FROM hits JOIN docs USING (doc_id) WHERE rank_no BETWEEN 11 AND 20""",
    "site_search": f"""
WITH {sql.WIKI_EDGES}, nodes AS (SELECT url FROM wiki), {sql.pagerank('wiki_edges', 20)},
docs AS (
  SELECT translate(to_base64(encode(url)), '+/', '-_') AS doc_id, url,
    {sql.search_clean("old_html || '<b>' || repeat('x ', 6)")} AS content FROM wiki),
{sql.INDEX}, ranks AS (SELECT doc_id, rank FROM r20 JOIN docs USING (url)),
{sql.BENCHMARK_QUERIES}, {sql.matches(sql.BLEND)}, {sql.ranked('true', 'score DESC', HITS_PER_PAGE)}
SELECT query_id, rank_no, doc_id, url, content[1:200] AS snippet, round(score + 2e-10, 6) AS score, n_hits
FROM hits JOIN docs USING (doc_id)""",
    "index_append": f"""
WITH {_DOC_INDEX} SELECT term, df, max_tf, min_len::INT AS min_len FROM terms""",
    "index_merged": f"""
WITH {_DOC_INDEX} SELECT term, df, max_tf, min_len::INT AS min_len FROM terms""",
    "stream_index": f"WITH {_DOC_INDEX} SELECT term, doc_id, tf, doc_len::INT AS doc_len FROM post",
}
