"""PageRank over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.fixed import DAMPING, ROUNDS
from pagequarry.operators.links import graph_nodes, out_degree
from pagequarry.operators.spread import hot_keys
from pagequarry.session import Workspace


def pagerank(
    edges: DataFrame,
    ws: Workspace,
    nodes: DataFrame | None = None,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    dangling: str = "drop",
) -> DataFrame:
    """Ranks of ``edges(src, dst, weight)`` as (url, rank), summing to at most 1.

    A round is one join and one sum over the edges. The share every page gets
    from random jumps is a single number, so the full matrix never exists:

        rank'(d) = damping * sum(rank(s) * w(s, d) / W(s)) + jump

    where ``jump`` is ``(1 - damping) / N`` of the ranks that have links. With
    ``dangling='drop'`` the rank of pages without links is lost each round;
    ``'uniform'`` gives it to all pages in equal parts.

    Edges are placed by source once and kept. Sources with very many links are
    split over several tasks, and their rank is sent to each of them. Each
    round's ranks are stored (two tables take turns), which keeps every plan
    one round deep and lets a lost executor's work start from the last round.
    """
    edges = ws.save(edges.select("src", "dst", "weight"), "edges")
    hot = F.broadcast(hot_keys(edges, ["src"]))
    salt = F.pmod(F.xxhash64("dst"), F.coalesce("_salts", F.lit(1))).cast("int")
    placed = ws.save(
        edges.join(hot, "src", "left").select(
            "src", salt.alias("_salt"), "dst", "weight"
        ),
        "placed_edges",
    )
    everyone = graph_nodes(placed, nodes)
    degree = out_degree(placed).withColumnRenamed("src", "url")
    copies = placed.groupBy(F.col("src").alias("url")).agg((F.max("_salt") + 1).alias("copies"))
    stored = ws.save(
        everyone.join(degree.join(copies, "url"), "url", "left").select(
            "url", F.coalesce("out_degree", F.lit(0)).alias("out_degree"), "copies"
        ),
        "nodes",
    )
    n = stored.count()
    by_source = placed.repartition("src", "_salt").persist()
    by_url = stored.repartition("url").persist()
    ranks = stored.select("url", "out_degree", "copies", F.lit(1.0 / max(n, 1)).alias("rank"))
    try:
        for turn in range(rounds):
            ranks = ws.save(_round(by_source, by_url, ranks, n, damping, dangling), f"ranks_{turn % 2}")
    finally:
        by_source.unpersist()
        by_url.unpersist()
    return ranks.select("url", "rank")


def _round(
    edges: DataFrame, nodes: DataFrame, ranks: DataFrame, n: int, damping: float, dangling: str
) -> DataFrame:
    linked = F.col("out_degree") > 0
    sent = ranks.where(linked).select(
        F.col("url").alias("src"),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("_salt"),
        (F.col("rank") * damping / F.col("out_degree")).alias("share"),
    )
    received = (
        edges.join(sent, ["src", "_salt"])
        .groupBy(F.col("dst").alias("url"))
        .agg(F.sum(F.col("share") * F.col("weight")).alias("received"))
    )
    given = F.when(linked, F.col("rank") * (1 - damping))
    if dangling == "uniform":
        given = given.otherwise(F.col("rank"))
    jump = ranks.agg((F.coalesce(F.sum(given), F.lit(0.0)) / max(n, 1)).alias("jump")).scalar()
    return nodes.join(received, "url", "left").select(
        "url",
        "out_degree",
        "copies",
        (F.coalesce("received", F.lit(0.0)) + jump).alias("rank"),
    )
