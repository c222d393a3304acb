"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.session import Workspace


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """(node, component) of all nodes in links(a, b); a component is named by its least node.

    Alternates large-star and small-star steps: in each, the neighbours of a node
    are linked to the least of them instead, until no link changes. Each step
    is a stored table; a node's minimum is aggregated before the shuffle, so a node
    with very many links is not gathered in one place.
    """
    both = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = ws.save(links.where("a <> b").select(*both).distinct(), "links_0")
    before, step = None, 0
    while True:
        step += 1
        # large star: larger neighbours get the least neighbour
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            ends.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).where("a <> b").distinct()
        large = ws.save(large, f"large_{step}")
        # small star: a node and its smaller neighbours get the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links = ws.save(small, f"links_{step}")
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h")).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def forest(n: int, a, b) -> list[int]:
    """Places of links that suffice to connect what all links a[i]-b[i] among n nodes connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a, b)):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(k)
    return kept
