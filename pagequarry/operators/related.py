"""Word vectors and query expansion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagequarry.functions import text as tx
from pagequarry.functions.fixed import RELATED_PER_WORD, STOP_WORDS
from pagequarry.operators.nearest import nearest_counted, normalized
from pagequarry.operators.spread import BROADCAST_BYTES, spread_join
from pagequarry.session import Workspace


# Two words in a hash table.
WORD_PAIR_BYTES = 192
TOKENS_AT_ONCE = 100_000  # whose vectors a task holds
BLOCK_BYTES = 64 << 20  # of texts that get the vectors of their words together
WORD_BYTES = 64  # a word and its block in a hash table


def word_counts(corpus: DataFrame, min_count: int = 2) -> DataFrame:
    """``corpus(tokens)`` to the vocabulary (word, n)."""
    return (
        # "outer", or Spark works the tokens out twice to drop empty arrays first
        corpus.select(F.explode_outer("tokens").alias("word"))
        .groupBy("word")
        .agg(F.count("word").alias("n"))
        .where(F.col("n") >= min_count)
    )


def train(
    corpus: DataFrame,
    vector_size: int = 100,
    window: int = 5,
    min_count: int = 2,
    partitions: int = 4,
    rounds: int = 1,
    seed: int = 1,
    longest: int = 1_000_000,
    most_words: int = 5_000_000,
) -> Word2VecModel:
    """M5: word vectors of ``corpus(tokens)``; contexts break after ``longest`` words.

    The trainer keeps the vocabulary and its vectors on the driver. A vocabulary
    of more than ``most_words`` is refused: raise ``min_count`` with the corpus.
    """
    with Workspace(corpus.sparkSession, "training") as ws:
        # stored, since words are counted here and by the trainer, which then reads them once more
        corpus = ws.save(corpus.select("tokens"), "tokens")
        size = word_counts(corpus, min_count).count()
        if size > most_words:
            raise ValueError(f"{size} words with min_count={min_count}; the driver may hold {most_words}")
        trainer = Word2Vec(
            vectorSize=vector_size,
            windowSize=window,
            minCount=min_count,
            numPartitions=partitions,
            maxIter=rounds,
            seed=seed,
            maxSentenceLength=longest,
            inputCol="tokens",
            outputCol="vector",
        )
        return trainer.fit(corpus)


def word_vectors(model: Word2VecModel) -> DataFrame:
    """(word, vector) of a trained model, vectors as arrays."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def most_similar(
    words: DataFrame, vectors: DataFrame, k: int = RELATED_PER_WORD
) -> DataFrame:
    """M6: for each of ``words(word)`` in the vocabulary (F8), the k other words
    with the greatest cosine, as (word, related, rank_no, score)."""
    return _most_similar(words, vectors, k)[0]


def _most_similar(words: DataFrame, vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    wanted = words.select("word").distinct()
    known = spread_join(vectors, wanted, ["word"], "left_semi")
    found, n_words = nearest_counted(
        known.select(F.col("word").alias("query_id"), "vector"),
        vectors.select(F.col("word").alias("item_id"), "vector"),
        k + 1,  # the word itself is among them, unless others tie with it
        "cosine",
    )
    # at most k + 1 rows per word are left here
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id"))
    others = (
        found.where(F.col("query_id") != F.col("item_id"))
        .withColumn("rank_no", place)
        .where(F.col("rank_no") <= k)
        .select(
            F.col("query_id").alias("word"), F.col("item_id").alias("related"), "rank_no", "score"
        )
    )
    return others, n_words


def expand_queries(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = RELATED_PER_WORD,
    stop: list[str] = STOP_WORDS,
) -> DataFrame:
    """Q3: ``queries(query_id, text)`` to (query_id, related_words, related_query).

    Neighbours of all searched words are united (U1, A10), minus every word of
    the query, stop words included (U2). ``related_words`` is the shown list;
    ``related_query`` is searched and drops stop words.
    """
    tokens = queries.select("query_id", tx.plain_words(F.col("text")).alias("_all"))
    searched = tokens.select(
        "query_id", F.explode(F.array_distinct(tx.drop_stop_words(F.col("_all"), stop))).alias("word")
    )
    neighbours, n_words = _most_similar(searched, vectors, k)
    united = (
        spread_join(
            searched,
            neighbours.select("word", "related"),
            ["word"],
            spread_on=["query_id"],
            small_bytes=n_words * k * WORD_PAIR_BYTES,
        )
        .groupBy("query_id")
        .agg(F.collect_set("related").alias("_related"))  # k per word of one query
    )
    related = F.sort_array(
        F.array_except(F.coalesce("_related", F.array().cast("array<string>")), "_all")
    )
    return tokens.join(united, "query_id", "left").select(
        "query_id",
        related.alias("related_words"),
        F.array_join(tx.drop_stop_words(related, stop), " ").alias("related_query"),
    )


def embed_with_model(texts: DataFrame, model: Word2VecModel) -> DataFrame:
    """M7: ``texts(item_id, text)`` to (item_id, vector): mean word vector, length 1.

    Texts without a known word get a zero vector.
    """
    tokens = texts.select("item_id", tx.plain_words(F.col("text")).alias(model.getInputCol()))
    mean = vector_to_array(F.col(model.getOutputCol()))
    return model.transform(tokens).select("item_id", normalized(mean).alias("vector"))


def embed_with_vectors(
    texts: DataFrame, vectors: DataFrame, limit: int = BROADCAST_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """M7 over a vector table (word, vector): mean word vector, length 1, as a column ``vector`` of the texts.

    Texts without a known word get a zero vector. If the measured vector table fits
    in a broadcast, in its own number format, each text is looked up where it is,
    without a shuffle. Beyond that, texts are dealt out in blocks of about ``block_bytes``,
    and each block gets the vectors of its own words, each once. Texts with an equal column
    ``near``, if there is one, share a block: they should have words in common.
    """
    numbers = vectors.schema["vector"].dataType.elementType
    if not isinstance(numbers, (T.FloatType, T.DoubleType)):
        vectors = vectors.withColumn("vector", F.col("vector").cast("array<double>"))
    vectors = vectors.select("word", "vector")
    width = 4 if isinstance(numbers, T.FloatType) else 8
    size = F.octet_length("word") + 8 + width * F.size("vector")
    if (vectors.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0) <= limit:
        mean = _mean_by_broadcast(texts, vectors)
    else:
        mean = _mean_by_blocks(texts, vectors, limit, block_bytes)
    columns = [c for c in texts.columns if c not in ("near", "vector")]
    return mean.select(*columns, normalized(F.col("_mean")).alias("vector"))


def _with_means(rows: pa.Table | pa.RecordBatch, tokens: pa.Array, known: pa.Array, table: np.ndarray, names: list[str]) -> list:
    """The columns ``names`` of the rows, and the mean of the vectors in ``table`` of each row's known tokens."""
    n_rows = rows.num_rows
    own = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    at = pc.fill_null(pc.index_in(tokens.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(n_rows), own)[at >= 0]
    at = at[at >= 0]
    sums = np.zeros((n_rows, table.shape[1]))
    for a in range(0, len(at), TOKENS_AT_ONCE):
        d = doc[a : a + TOKENS_AT_ONCE]
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        found = table[at[a : a + TOKENS_AT_ONCE]].astype(np.float64)
        sums[d[first]] += np.add.reduceat(found, first, axis=0)
    n = np.maximum(np.bincount(doc, minlength=n_rows), 1)
    mean = pa.array((sums / n[:, None]).ravel())
    offsets = pa.array(np.arange(n_rows + 1) * table.shape[1], pa.int32())
    return [*[rows.column(c) for c in names], pa.ListArray.from_arrays(offsets, mean)]


def _mean_schema(texts: DataFrame) -> T.StructType:
    fields = [f for f in texts.schema.fields if f.name not in ("near", "vector")]
    return T.StructType([*fields, T.StructField("_mean", T.ArrayType(T.DoubleType()))])


def _vectors_of(rows: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in rows.chunks]) if rows.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def _mean_by_broadcast(texts: DataFrame, vectors: DataFrame) -> DataFrame:
    rows = vectors.toArrow()  # measured: at most the broadcast limit
    flat = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    table = flat.reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 0))
    shared = texts.sparkSession.sparkContext.broadcast((rows["word"].combine_chunks(), table))
    schema = _mean_schema(texts)
    names, arrow = schema.names[:-1], to_arrow_schema(schema)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value
        for batch in batches:
            columns = _with_means(batch, batch.column("_words"), known, table, names)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    words = tx.plain_words(F.col("text")).alias("_words")
    return texts.select(*names, words).mapInArrow(means, schema)


def _mean_by_blocks(texts: DataFrame, vectors: DataFrame, limit: int, block_bytes: int) -> DataFrame:
    schema = _mean_schema(texts)
    names, arrow = schema.names[:-1], to_arrow_schema(schema)
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    first = vectors.select(F.size("vector").alias("n")).first()
    width = first["n"] if first else 0
    # smaller blocks where there would be fewer than tasks can run
    tasks = 2 * texts.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-size // block_bytes), min(tasks, 16 * size // block_bytes))
    key = F.xxhash64("near" if "near" in texts.columns else "item_id")
    placed = texts.select(*names, F.pmod(key, F.lit(blocks)).cast("int").alias("_block"))
    words = tx.plain_words(F.col("text"))
    own = placed.select(F.col("_block").alias("_to"), F.explode_outer(words).alias("word"))
    own = own.where("word IS NOT NULL").distinct()
    # a word takes two bytes of text at least, so this bounds its rows
    sent = spread_join(vectors, own, ["word"], small_bytes=size * WORD_BYTES // 2, limit=limit)

    def means(key: tuple, rows: pa.Table, words: pa.Table) -> pa.Table:
        known = words["word"].combine_chunks()
        table = _vectors_of(words["vector"], width)
        columns = _with_means(rows, rows["_words"].combine_chunks(), known, table, names)
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    # the words are taken after texts have moved: what is sent are the texts alone
    dealt = placed.repartition(blocks, "_block").withColumn("_words", words)
    given = sent.select("_to", "word", "vector").repartition(blocks, "_to")
    return dealt.groupBy("_block").cogroup(given.groupBy("_to")).applyInArrow(means, schema)
