"""Word vectors, related words, chunk vectors and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagequarry.functions import text as tx
from pagequarry.functions.fixed import (
    CHUNKS_PER_QUESTION,
    PROMPT_TEMPLATE,
    REFUSAL_TEMPLATE,
    RELATED_PER_WORD,
)
from pagequarry.operators import answers as an, related as rl
from pagequarry.operators.cbow import train_cbow
from pagequarry.operators.cells import build_cells, nearest_in_cells
from pagequarry.operators.nearest import nearest
from pagequarry.operators.spread import dense_ids
from pagequarry.plans.question_answering import build_vector_store
from pagequarry.session import Workspace
from pagequarry.sources.tables import load_model, save_model
from queries import sql
from queries.inputs import shown, stored_once, table
from queries.texts import CHUNKS, document_texts

# Relevance at which the registered questions are answered.
THRESHOLD = 0.4


def _corpus(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        tx.plain_words(F.col("text")).alias("tokens")
    )


# Numbers in a given embedding.
WIDTH = 64
FILE_WORDS = 50_000  # whose vectors a task writes


def given_vectors(spark, sf_dir):
    """vectors(word, vector) for every word of the vocabulary.

    The n given embeddings serve the n most frequent words; the next n words get
    them rotated by one place, and so on; after WIDTH rotations they are reversed.
    """
    def build(path):
        vocabulary = rl.word_counts(_corpus(spark, sf_dir))
        numbered = dense_ids(vocabulary, [F.desc("n"), "word"], Workspace(spark, "words"))
        # words are few bytes, so they come in fewer pieces than their vectors need
        numbered = numbered.repartition(max(1, -(-numbered.count() // FILE_WORDS)), "word")
        given = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
        n = F.lit(given.count())
        turn = F.floor(F.col("idx") / n)
        by = (turn % WIDTH).cast("int")
        turned = F.concat(F.slice("embedding", by + 1, F.lit(WIDTH)), F.slice("embedding", F.lit(1), by))
        back = F.floor(turn / WIDTH) % 2 == 1
        vector = F.when(back, F.reverse(turned)).otherwise(turned)
        words = numbered.withColumn("vec_id", F.col("idx") % n).join(given, "vec_id")
        words.select("word", vector.alias("vector")).write.parquet(path)

    return spark.read.parquet(stored_once(spark, sf_dir, "vectors", build))


def user_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return turns.select(F.concat_ws("/", "conv_id", "turn").alias("query_id"), "text")


def expanded_turns(spark, sf_dir):
    return rl.expand_queries(user_turns(spark, sf_dir), given_vectors(spark, sf_dir))


def similar_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    items = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    return nearest(queries, items, RELATED_PER_WORD, "cosine").withColumn(
        "score", shown(F.col("score"))
    )


def similar_words(spark, sf_dir):
    words = user_turns(spark, sf_dir).select(
        F.explode(tx.drop_stop_words(tx.plain_words(F.col("text")))).alias("word")
    )
    return rl.most_similar(words, given_vectors(spark, sf_dir)).withColumn(
        "score", shown(F.col("score"))
    )


def related_words(spark, sf_dir):
    return expanded_turns(spark, sf_dir).select(
        "query_id", F.array_join("related_words", " ").alias("related_words"), "related_query"
    )


def _model(spark, sf_dir):
    return stored_once(
        spark,
        sf_dir,
        "model",
        lambda path: save_model(rl.train(_corpus(spark, sf_dir)), path),
    )


def related_words_trained(spark, sf_dir):
    """The same with vectors trained on the documents."""
    vectors = rl.word_vectors(load_model(_model(spark, sf_dir)))
    return rl.expand_queries(user_turns(spark, sf_dir), vectors)


def roundtrip_model(spark, sf_dir):
    """Vectors of the model after it was stored and read."""
    return rl.word_vectors(load_model(_model(spark, sf_dir)))


def chunk_embedding_trained(spark, sf_dir):
    """M7 with the trained model."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return rl.embed_with_model(texts, load_model(_model(spark, sf_dir)))


def cbow_vectors(spark, sf_dir):
    """M5: (word, n, vector) of all words found twice, by context bags and negative samples."""
    def build(path):
        tokens = tx.plain_words(F.col("text")).alias("tokens")
        corpus = table(spark, sf_dir, "documents").select("doc_id", tokens)
        with Workspace(spark, "cbow") as ws:
            train_cbow(corpus, ws).select("word", "n", "vector").write.parquet(path)

    return spark.read.parquet(stored_once(spark, sf_dir, "cbow", build))


def related_words_cbow(spark, sf_dir):
    """Q3 with these vectors."""
    vectors = cbow_vectors(spark, sf_dir).select("word", "vector")
    return rl.expand_queries(user_turns(spark, sf_dir), vectors)


def _embedding(spark, sf_dir):
    vectors = given_vectors(spark, sf_dir)
    return lambda texts: rl.embed_with_vectors(texts, vectors)


def _store(spark, sf_dir):
    path = stored_once(
        spark,
        sf_dir,
        "store",
        lambda p: build_vector_store(document_texts(spark, sf_dir), _embedding(spark, sf_dir), p),
    )
    return spark.read.parquet(f"{path}/vectors")


def _questions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def _question_hits(spark, sf_dir):
    texts = _questions(spark, sf_dir).select(
        F.col("question_id").alias("item_id"), F.col("question").alias("text")
    )
    vectors = _embedding(spark, sf_dir)(texts).withColumnRenamed("item_id", "question_id")
    return an.nearest_chunks(vectors, _store(spark, sf_dir))


def chunk_embedding(spark, sf_dir):
    vectors = _store(spark, sf_dir).select("chunk_id", "vector")
    rounded = F.transform("vector", lambda x: F.format_string("%.4f", F.round(x, 4) + 0.0))
    return vectors.select("chunk_id", F.array_join(rounded, " ").alias("vector"))


def nearest_chunks(spark, sf_dir):
    return _question_hits(spark, sf_dir).withColumn("relevance", shown(F.col("relevance")))


def indexed_nearest(spark, sf_dir):
    """The same from an index of the chunks' vectors, with most cells left out."""
    store = _store(spark, sf_dir)
    items = store.select(F.col("chunk_id").alias("item_id"), "vector")
    path = stored_once(spark, sf_dir, "cells", lambda p: build_cells(items, p))
    texts = _questions(spark, sf_dir).select(
        F.col("question_id").alias("item_id"), F.col("question").alias("text")
    )
    asked = _embedding(spark, sf_dir)(texts).withColumnRenamed("item_id", "question_id")
    hits = an.chunks_in_cells(asked, store, path, Workspace(spark, "indexed"))
    return hits.withColumn("relevance", shown(F.col("relevance")))


def indexed_vectors(spark, sf_dir):
    """The nearest embeddings of every embedding, from an index."""
    vectors = table(spark, sf_dir, "embeddings")
    items = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    ws = Workspace(spark, "indexed")
    build_cells(items, ws.path("index"), cell_items=100)
    asked = items.withColumnRenamed("item_id", "query_id")
    return nearest_in_cells(spark, ws.path("index"), asked, RELATED_PER_WORD, ws).withColumn(
        "score", shown(F.col("score"))
    )


def answer_gate(spark, sf_dir):
    gated = an.gate(_questions(spark, sf_dir), _question_hits(spark, sf_dir), THRESHOLD)
    return gated.withColumn("best", shown(F.col("best")))


def prompt_rows(spark, sf_dir):
    prompts = an.make_prompts(_questions(spark, sf_dir), _question_hits(spark, sf_dir), THRESHOLD)
    return prompts.withColumn("sources", F.array_join("sources", " "))


QUERIES = {
    "similar_vectors": similar_vectors,
    "similar_words": similar_words,
    "related_words": related_words,
    "related_words_trained": related_words_trained,
    "cbow_vectors": cbow_vectors,
    "related_words_cbow": related_words_cbow,
    "roundtrip_model": roundtrip_model,
    "chunk_embedding": chunk_embedding,
    "chunk_embedding_trained": chunk_embedding_trained,
    "nearest_chunks": nearest_chunks,
    "indexed_nearest": indexed_nearest,
    "indexed_vectors": indexed_vectors,
    "answer_gate": answer_gate,
    "prompt_rows": prompt_rows,
}

VECTORS = f"""
vocabulary AS (
  SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS idx
  FROM (SELECT unnest({sql.plain_words('text')}) AS word FROM documents)
  GROUP BY word HAVING count(*) >= 2),
vectors AS (
  SELECT word, CASE WHEN idx // (n * {WIDTH}) % 2 = 1 THEN list_reverse(turned) ELSE turned END AS vector
  FROM (
    SELECT word, idx, n, list_transform(
      list_concat(embedding[moved + 1:], embedding[:moved]), lambda x: x::DOUBLE) AS turned
    FROM (SELECT word, idx, n, idx // n % {WIDTH} AS moved FROM vocabulary, (SELECT count(*) AS n FROM embeddings))
    JOIN embeddings ON vec_id = idx % n))"""

SIMILAR = f"""
{VECTORS},
turns AS (
  SELECT conv_id || '/' || turn AS query_id, {sql.plain_words('text')} AS all_words
  FROM conversations WHERE role = 'user'),
searched AS (
  SELECT DISTINCT query_id, word FROM (SELECT query_id, unnest(all_words) AS word FROM turns)
  WHERE word NOT IN ({sql.STOP})),
similar_words AS (
  SELECT word, related, score, row_number() OVER (PARTITION BY word ORDER BY score DESC, related) AS rank_no
  FROM (
    SELECT q.word, v.word AS related, round(list_cosine_similarity(q.vector, v.vector), 9) AS score
    FROM vectors q JOIN vectors v ON q.word <> v.word
    WHERE q.word IN (SELECT word FROM searched))
  QUALIFY rank_no <= {RELATED_PER_WORD})"""

RELATED = f"""
{SIMILAR},
united AS (
  SELECT query_id, list(DISTINCT related) AS found FROM searched JOIN similar_words USING (word) GROUP BY query_id),
minus AS (
  SELECT query_id, all_words, list_sort(list_filter(coalesce(found, []), lambda w: NOT list_contains(all_words, w))) AS related
  FROM turns LEFT JOIN united USING (query_id)),
expanded AS (
  SELECT query_id, array_to_string(related, ' ') AS related_words,
    array_to_string(list_filter(related, lambda w: w NOT IN ({sql.STOP})), ' ') AS related_query FROM minus)"""


def _embedded(name: str, texts: str) -> str:
    """name(item_id, vector): mean word vector of texts(item_id, text), length 1, or zero."""
    return f"""
{name}_counts AS (
  SELECT item_id, word, count(*) AS n
  FROM (SELECT item_id, unnest({sql.plain_words('text')}) AS word FROM {texts}) GROUP BY item_id, word),
{name}_sums AS (
  SELECT item_id, d, sum(n * x) / sum(n) AS x
  FROM (SELECT item_id, n, unnest(vector) AS x, unnest(range(len(vector))) AS d
        FROM {name}_counts JOIN vectors USING (word)) GROUP BY item_id, d),
{name} AS (
  SELECT item_id, coalesce(list_transform(v, lambda x: x / norm), list_transform(range({WIDTH}), lambda x: 0.0)) AS vector
  FROM {texts} LEFT JOIN (
    SELECT item_id, list(x ORDER BY d) AS v, sqrt(sum(x * x)) AS norm FROM {name}_sums GROUP BY item_id) USING (item_id))"""


_STORE = f"""
{CHUNKS}, {VECTORS},
chunk_texts AS (
  SELECT source || '#' || lpad(chunk_no::VARCHAR, 9, '0') AS item_id, page_content AS text, source FROM chunks),
{_embedded('store', 'chunk_texts')}"""
_HITS = f"""
{_STORE},
question_texts AS (SELECT item_id, text FROM benchmark),
{_embedded('asked', 'question_texts')},
hits AS (
  SELECT question_id, chunk_id, relevance,
    row_number() OVER (PARTITION BY question_id ORDER BY relevance DESC, chunk_id) AS rank_no
  FROM (
    SELECT q.item_id AS question_id, s.item_id AS chunk_id,
      round(1 - pow(list_distance(q.vector, s.vector), 2) / sqrt(2), 9) AS relevance
    FROM asked q CROSS JOIN store s)
  QUALIFY rank_no <= {CHUNKS_PER_QUESTION}),
gated AS (
  SELECT item_id AS question_id, text AS question, best, best IS NULL OR best < {THRESHOLD} AS refused
  FROM benchmark LEFT JOIN (
    SELECT question_id, max(relevance) AS best FROM hits GROUP BY question_id) ON question_id = item_id)"""
_MESSAGE = (
    f"CASE WHEN refused THEN replace({sql.quoted(REFUSAL_TEMPLATE)}, '{{question}}', question) END AS message"
)

ORACLES = {
    "similar_vectors": f"""
SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY score9 DESC, item_id) AS rank_no,
  round(score9 + 2e-10, 6) AS score
FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id,
    round(list_cosine_similarity(list_transform(a.embedding, lambda x: x::DOUBLE),
                                 list_transform(b.embedding, lambda x: x::DOUBLE)), 9) AS score9
  FROM embeddings a CROSS JOIN embeddings b)
QUALIFY rank_no <= {RELATED_PER_WORD}""",
    "similar_words": f"WITH {SIMILAR} SELECT word, related, rank_no, round(score + 2e-10, 6) AS score FROM similar_words",
    "related_words": f"WITH {RELATED} SELECT * FROM expanded",
    "chunk_embedding": f"""
WITH RECURSIVE {_STORE}
SELECT item_id AS chunk_id,
  array_to_string(list_transform(vector, lambda x: printf('%.4f', round(x, 4) + 0.0)), ' ') AS vector FROM store""",
    "nearest_chunks": f"""
WITH RECURSIVE {_HITS}
SELECT question_id, rank_no, chunk_id, source, text AS page_content, round(relevance + 2e-10, 6) AS relevance
FROM hits JOIN chunk_texts ON chunk_id = item_id""",
    "answer_gate": f"""
WITH RECURSIVE {_HITS}
SELECT question_id, round(best + 2e-10, 6) AS best, refused, {_MESSAGE} FROM gated""",
    "prompt_rows": f"""
WITH RECURSIVE {_HITS},
contexts AS (
  SELECT question_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank_no) AS context,
    array_to_string(list_sort(list(DISTINCT decode(from_base64(translate(
      regexp_extract(source, 'sites/(.*)[.]txt', 1), '-_', '+/'))))), ' ') AS sources
  FROM hits JOIN chunk_texts ON chunk_id = item_id GROUP BY question_id)
SELECT question_id, refused, {_MESSAGE},
  CASE WHEN NOT refused THEN
    replace(replace({sql.quoted(PROMPT_TEMPLATE)}, '{{question}}', question), '{{context}}', context) END AS prompt,
  CASE WHEN refused THEN '' ELSE sources END AS sources
FROM gated LEFT JOIN contexts USING (question_id)""",
}
ORACLES["indexed_nearest"] = ORACLES["nearest_chunks"]
ORACLES["indexed_vectors"] = f"""
SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY score9 DESC, item_id) AS rank_no,
  round(score9 + 2e-10, 6) AS score
FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id,
    round(1 - pow(list_distance(list_transform(a.embedding, lambda x: x::DOUBLE),
                                list_transform(b.embedding, lambda x: x::DOUBLE)), 2) / sqrt(2), 9) AS score9
  FROM embeddings a CROSS JOIN embeddings b)
QUALIFY rank_no <= {RELATED_PER_WORD}"""
