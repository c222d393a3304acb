"""Stored results: edges, ranks, crawl state, vectors and models."""

from __future__ import annotations

from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.operators.links import graph_nodes
from pagequarry.operators.pagerank import pagerank
from pagequarry.session import Workspace, lean, read_if_present


UNEVEN = 2  # times its even share of the rows that one task may read


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """A stored table for work on single rows, in pieces that keep all cores busy.

    A table that comes in fewer pieces than there are cores, or with more than ``UNEVEN`` even
    shares of its rows in one piece (a row group is read by one task, however large), is
    dealt out by a hash of its rows' places; others are left as they are, without a shuffle. By hash, since tasks
    that deal rows out in turn sort all they have read first, to deal them alike if they run again; of
    places, so that only the columns that are used are read and moved.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    pieces = table.rdd.getNumPartitions()
    if pieces >= cores:
        # reads no column: the files know their numbers of rows
        sizes = table.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
        most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) * cores <= UNEVEN * (rows or 0):
            return table
    placed = table.withColumn("_row", F.monotonically_increasing_id())
    return placed.repartition(max(cores, pieces), "_row").drop("_row")


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write a table, replacing what was there, and read it back."""
    with lean(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_ranks(edges: DataFrame, path: str, ws: Workspace, **options) -> DataFrame:
    """Q9: edges and ranks below ``path``; steps that are stored already are skipped."""
    spark = edges.sparkSession
    ranks = read_if_present(spark, f"{path}/ranks")
    if ranks is not None:
        return ranks
    stored = read_if_present(spark, f"{path}/edges")
    if stored is None:
        stored = replace_table(edges, f"{path}/edges")
    return replace_table(pagerank(stored, ws, **options), f"{path}/ranks")


def save_crawl_state(
    edges: DataFrame, frontier: DataFrame, scanned: DataFrame, path: str
) -> None:
    """Distinct edges with a self-loop for every node, queue, and crawled URLs."""
    loops = graph_nodes(edges, frontier).select(
        F.col("url").alias("src"), F.col("url").alias("dst")
    )
    everything = edges.select("src", "dst").union(loops).distinct()
    everything.write.mode("overwrite").parquet(f"{path}/edges")
    frontier.select("url").write.mode("overwrite").parquet(f"{path}/frontier")
    scanned.select("url").write.mode("overwrite").parquet(f"{path}/scanned")


def load_crawl_state(
    spark: SparkSession, path: str, seed: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, frontier, scanned), or a state that only has the seed in its queue."""
    stored = [read_if_present(spark, f"{path}/{name}") for name in ("edges", "frontier", "scanned")]
    if any(table is None for table in stored):
        start = spark.createDataFrame([(seed,)], "url string")
        loop = start.select(F.col("url").alias("src"), F.col("url").alias("dst"))
        return loop, start, start.where(F.lit(False))
    return tuple(stored)


def save_model(model: Word2VecModel, path: str) -> None:
    """S15."""
    model.write().overwrite().save(path)


def load_model(path: str) -> Word2VecModel:
    """S15."""
    return Word2VecModel.load(path)
