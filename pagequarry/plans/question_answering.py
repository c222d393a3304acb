"""Build a vector store from texts, and turn questions into prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions.fixed import ANSWER_THRESHOLD, CHUNKS_PER_QUESTION
from pagequarry.operators.answers import Embedding, embed_chunks, make_prompts, nearest_chunks
from pagequarry.operators.chunks import split_documents
from pagequarry.session import Workspace, lean

WAVE_BYTES = 2 << 30  # of texts that are embedded at a time


def build_vector_store(texts: DataFrame, embedding: Embedding, path: str, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """Q8: ``texts(source, content)`` to the stored table of chunks with vectors.

    Chunks are stored before they are embedded: the embedding may read them
    more than once, and the split is not repeated. Texts go in waves of about ``wave_bytes``, so that only a
    wave's chunks are stored twice, and only what embeds a wave lies on disk at once.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("content").cast("long")).alias("n")).first()["n"] or 0
    waves = max(1, -(-size // wave_bytes))
    own = F.pmod(F.xxhash64("source"), F.lit(waves))
    with lean(spark), Workspace(spark, "chunks") as ws:
        for wave in range(waves):
            chunks = ws.save(split_documents(texts.where(own == wave) if waves > 1 else texts), "wave")
            made = embed_chunks(chunks, embedding)
            made.write.mode("append" if wave else "overwrite").parquet(f"{path}/vectors")
    return spark.read.schema(made.schema).parquet(f"{path}/vectors")


def open_vector_store(spark: SparkSession, path: str) -> DataFrame:
    """S14."""
    return spark.read.parquet(f"{path}/vectors")


def ask(
    questions: DataFrame,
    store: DataFrame,
    embedding: Embedding,
    k: int = CHUNKS_PER_QUESTION,
    threshold: float = ANSWER_THRESHOLD,
) -> DataFrame:
    """Q5 for ``questions(question_id, question)``; the model call is the caller's."""
    vectors = embedding(
        questions.select(F.col("question_id").alias("item_id"), F.col("question").alias("text"))
    ).withColumnRenamed("item_id", "question_id")
    return make_prompts(questions, nearest_chunks(vectors, store, k), threshold)
