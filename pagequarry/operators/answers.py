"""From question vectors to prompts with their sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions import urls
from pagequarry.functions.fixed import (
    ANSWER_THRESHOLD,
    CHUNKS_PER_QUESTION,
    CONTEXT_SEPARATOR,
    PROMPT_TEMPLATE,
    REFUSAL_TEMPLATE,
)
from pagequarry.operators.cells import nearest_in_cells
from pagequarry.operators.nearest import nearest_counted
from pagequarry.operators.spread import spread_join
from pagequarry.session import Workspace

# texts(item_id, text), with other columns that may be kept -> (item_id, vector)
Embedding = Callable[[DataFrame], DataFrame]


# One hit in a hash table.
HIT_BYTES = 256
NEAR_CHUNKS = 1000  # of one source that are embedded together


def chunk_id(source: str = "source", chunk_no: str = "chunk_no") -> Column:
    """One orderable id per chunk: source, then number."""
    return F.format_string("%s#%09d", F.col(source), F.col(chunk_no))


def embed_chunks(chunks: DataFrame, embedding: Embedding) -> DataFrame:
    """Q8: chunks with a ``chunk_id`` and a ``vector`` column.

    An embedding that keeps the other columns of its texts saves the join with them.
    """
    named = chunks.withColumn("item_id", chunk_id()).withColumnRenamed("page_content", "text")
    near = F.xxhash64("source", F.expr(f"chunk_no div {NEAR_CHUNKS}"))  # neighbours overlap
    made = embedding(named.withColumn("near", near))
    if not set(named.columns) <= set(made.columns):
        made = named.join(made.select("item_id", "vector"), "item_id")
    made = made.withColumnRenamed("item_id", "chunk_id").withColumnRenamed("text", "page_content")
    return made.select("chunk_id", *chunks.columns, "vector")


def nearest_chunks(
    questions: DataFrame, store: DataFrame, k: int = CHUNKS_PER_QUESTION
) -> DataFrame:
    """M4: ``questions(question_id, vector)`` to their k best chunks of
    ``store(chunk_id, source, page_content, vector)``."""
    found, n_questions = nearest_counted(
        questions.select(F.col("question_id").alias("query_id"), "vector"),
        store.select(F.col("chunk_id").alias("item_id"), "vector"),
        k,
        "relevance",
    )
    return _with_texts(found, store, n_questions * k)


def chunks_in_cells(
    questions: DataFrame, store: DataFrame, path: str, ws: Workspace, k: int = CHUNKS_PER_QUESTION
) -> DataFrame:
    """:func:`nearest_chunks` from an index of the chunks' vectors that
    :func:`~pagequarry.operators.cells.build_cells` wrote."""
    asked = questions.select(F.col("question_id").alias("query_id"), "vector")
    found = ws.save(nearest_in_cells(store.sparkSession, path, asked, k, ws), "found")
    return _with_texts(found, store, found.count())


def _with_texts(found: DataFrame, store: DataFrame, most: int) -> DataFrame:
    hits = found.select(
        F.col("query_id").alias("question_id"),
        F.col("item_id").alias("chunk_id"),
        "rank_no",
        F.col("score").alias("relevance"),
    )
    # the texts come last, and only for chunks that were hit
    return spread_join(
        store.select("chunk_id", "source", "page_content"), hits, ["chunk_id"], small_bytes=most * HIT_BYTES
    ).select("question_id", "rank_no", "chunk_id", "source", "page_content", "relevance")


def gate(
    questions: DataFrame, hits: DataFrame, threshold: float = ANSWER_THRESHOLD
) -> DataFrame:
    """(question_id, best, refused, message) for every question."""
    best = hits.groupBy("question_id").agg(F.max("relevance").alias("best"))
    refused = F.col("best").isNull() | (F.col("best") < threshold)
    return (
        questions.select("question_id", "question")
        .join(best, "question_id", "left")
        .select(
            "question_id",
            "best",
            refused.alias("refused"),
            F.when(refused, _fill(REFUSAL_TEMPLATE, question=F.col("question"))).alias("message"),
        )
    )


def _fill(template: str, **values: Column) -> Column:
    """The template with each {name} replaced; braces inside values mean nothing."""
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find(f"{{{name}}}"), name) for name in values]
        places = [place for place in places if place[0] >= 0]
        if not places:
            parts.append(F.lit(rest))
            break
        at, name = min(places)
        parts += [F.lit(rest[:at]), values[name]]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def make_prompts(
    questions: DataFrame, hits: DataFrame, threshold: float = ANSWER_THRESHOLD
) -> DataFrame:
    """Q5: (question_id, refused, message, prompt, sources) for
    ``questions(question_id, question)``.

    Refused questions have a message instead of a prompt, and no sources.
    Sources (A11, T16) are the URLs behind the chunks' source keys; a source
    that is no key stands for itself.
    """
    key = urls.source_key(F.col("source"))
    contexts = hits.groupBy("question_id").agg(  # k rows per question
        F.sort_array(F.collect_list(F.struct("rank_no", "page_content"))).alias("_contexts"),
        F.sort_array(F.collect_set(F.coalesce(urls.decode_key(key), "source"))).alias("_sources"),
    )
    context = F.array_join(F.col("_contexts.page_content"), CONTEXT_SEPARATOR)
    prompt = _fill(PROMPT_TEMPLATE, context=context, question=F.col("question"))
    gated = gate(questions, hits, threshold)
    opened = ~F.col("refused")
    return (
        gated.join(questions.select("question_id", "question"), "question_id")
        .join(contexts, "question_id", "left")
        .select(
            "question_id",
            "refused",
            "message",
            F.when(opened, prompt).alias("prompt"),
            F.when(opened, F.col("_sources"))
            .otherwise(F.array().cast("array<string>"))
            .alias("sources"),
        )
    )
