"""A stored vector index with exact pruning.

Items lie with their nearest centre. A cell is a part of a centre's items, at most
``CELL_ITEMS`` of them, and knows its radius: no item is farther from the centre.
By the triangle inequality a cell holds nothing nearer to a query than the distance
to its centre minus its radius, so most cells are never read and results stay exact.

Centres are means of a bounded sample (``SAMPLE`` items per centre); the sample only
shapes the cells, every item is in one. The sample on the driver and the table of cells in
broadcasts have at most ``TABLE_BYTES`` each: beyond that, cells grow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagequarry.operators.nearest import compare_groups, matrix, nearest
from pagequarry.operators.spread import top_k
from pagequarry.session import Workspace, lean

CELL_ITEMS = 2_000
SAMPLE = 16
TABLE_BYTES = 64 << 20
QUERIES_AT_ONCE = 5_000  # that meet a cell in one group
READ_SHARE = 0.25  # of all cells, beyond which reading all items is cheaper
PUSHED = 2_000  # cells that are named to the scan
_SLACK = 1e-6  # of a distance, far above what rounding adds
_PAIRS = 4_000_000  # distances a task holds at once


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = (vectors**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * vectors @ centres.T
    return np.sqrt(np.maximum(squared, 0))


def _centres(items: DataFrame, n: int, rounds: int = 4) -> np.ndarray:
    """Means of a sample of at most ``SAMPLE * n`` items, by hash of the id."""
    share = min(1.0, 1.2 * SAMPLE * n / max(items.count(), 1))
    chosen = items.where(F.pmod(F.xxhash64("item_id"), F.lit(1 << 30)) < F.lit((1 << 30) * share))
    sample = chosen.orderBy(F.xxhash64("item_id"), "item_id").limit(SAMPLE * n).toArrow()
    vectors = matrix(sample["vector"].combine_chunks())
    centres = np.unique(vectors[:n], axis=0)
    step = max(1, _PAIRS // max(len(centres), 1))
    for _ in range(rounds if len(vectors) else 0):
        own = np.concatenate(
            [_distances(vectors[a : a + step], centres).argmin(1) for a in range(0, len(vectors), step)]
        )
        used, own = np.unique(own, return_inverse=True)
        sums = np.zeros((len(used), vectors.shape[1]))
        np.add.at(sums, own, vectors)
        centres = sums / np.bincount(own)[:, None]
    return centres


def build_cells(items: DataFrame, path: str, cell_items: int = CELL_ITEMS, table_bytes: int = TABLE_BYTES) -> None:
    """Write ``items(item_id, vector)`` as an index: ``path/items`` by cell, ``path/cells``.

    All vectors have one length; items without a vector are left out.
    """
    items = items.select("item_id", F.col("vector").cast("array<double>").alias("vector"))
    items = items.where(F.col("vector").isNotNull())
    n, width = items.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    most = max(1, table_bytes // (8 * max(width, 1) + 64))  # rows of a table
    n_centres = max(1, min(-(-n // cell_items), most // SAMPLE))
    shared = items.sparkSession.sparkContext.broadcast(_centres(items, n_centres) if n else np.zeros((1, width)))
    schema = T.StructType([*items.schema.fields]).add("_centre", "integer").add("_far", "double")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        step = max(1, _PAIRS // len(centres))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                far = _distances(matrix(part.column(1)), centres)
                own = far.argmin(1)
                columns = [pa.array(own, pa.int32()), pa.array(far[np.arange(len(own)), own])]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    ws = Workspace(items.sparkSession, "cells")
    dealt = ws.save(items.mapInArrow(deal, schema), "dealt")
    # a centre with many items, such as copies, has several cells
    size = max(cell_items, -(-2 * n // most))
    counts = dealt.groupBy("_centre").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_centre", F.ceil(F.col("_n") / size).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("item_id"), F.col("_parts")).cast("int")
    cut = dealt.join(F.broadcast(counts), "_centre").withColumn("_part", part)  # one row per centre
    # not stored again: the join is cheaper than another copy of the vectors
    cut = cut.withColumn("cell", F.shiftleft(F.col("_centre").cast("long"), 32) + F.col("_part")).drop("_parts")
    sorted_items = cut.select("cell", "item_id", "vector").repartitionByRange("cell").sortWithinPartitions("cell")
    with lean(items.sparkSession):
        sorted_items.write.mode("overwrite").parquet(f"{path}/items")
    rows = cut.groupBy("cell", "_centre").agg(F.count(F.lit(1)).alias("n"), F.max("_far").alias("radius")).toArrow()
    centres = shared.value[rows["_centre"].to_numpy()]  # one row per cell
    cells = pd.DataFrame({name: rows[name].to_numpy() for name in ("cell", "n", "radius")})
    cells["centre"] = centres.tolist()
    items.sparkSession.createDataFrame(
        cells, "cell long, n long, radius double, centre array<double>"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    ws.close()


class _Table:
    """All cells of an index, as arrays."""

    def __init__(self, rows: pa.Table):
        self.cell, self.n = rows["cell"].to_numpy(), rows["n"].to_numpy()
        self.radius = rows["radius"].to_numpy()
        self.centre = matrix(rows["centre"].combine_chunks())

    def far(self, vectors: np.ndarray) -> np.ndarray:
        return _distances(vectors, self.centre) if len(self.cell) else np.zeros((len(vectors), 0))

    def first(self, far: np.ndarray, k: int) -> np.ndarray:
        """Which cells each query reads first: the nearest that hold k items together."""
        order = np.argsort(far, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        chosen = np.zeros(far.shape, bool)
        np.put_along_axis(chosen, order, before < k, axis=1)
        return chosen

    def later(self, far: np.ndarray, k: int, bar: np.ndarray) -> np.ndarray:
        """Which other cells may hold an item at most ``bar`` from the query."""
        can = far - self.radius[None, :] <= (bar + _SLACK * (1 + bar))[:, None]
        return can & ~self.first(far, k)


def _choose(queries: DataFrame, shared, k: int, second: bool) -> DataFrame:
    """queries(query_id, vector[, _bar]) to a row (query_id, cell) for each cell they read."""
    schema = T.StructType([queries.schema["query_id"]]).add("cell", "long")
    arrow = to_arrow_schema(schema)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        step = max(1, _PAIRS // 4 // max(len(table.cell), 1))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                far = table.far(matrix(part.column(1)))
                if second:
                    bar = part.column(2).to_numpy(zero_copy_only=False)
                    q, c = np.nonzero(table.later(far, k, bar))
                else:
                    q, c = np.nonzero(table.first(far, k))
                columns = [part.column(0).take(pa.array(q)), pa.array(table.cell[c])]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, arrow)], names=arrow.names)

    return queries.mapInArrow(choose, schema)


def _meet(asked: DataFrame, queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The k best of each cell for the queries that read it, (query_id, item_id, score)."""
    schema = T.StructType(
        [queries.schema["query_id"], items.schema["item_id"], T.StructField("score", T.DoubleType())]
    )
    # a cell that very many queries read meets them in several groups
    counts = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"))
    groups = counts.select("cell", F.ceil(F.col("_n") / QUERIES_AT_ONCE).cast("int").alias("_groups"))
    wanted = [row["cell"] for row in groups.select("cell").limit(PUSHED + 1).collect()]
    if len(wanted) <= PUSHED:
        items = items.where(F.col("cell").isin(wanted))  # files and row groups are sorted by cell
    groups = F.broadcast(groups)  # at most one row per cell
    own = F.pmod(F.xxhash64("query_id"), F.col("_groups")).cast("int")
    left = asked.join(queries.select("query_id", "vector"), "query_id")
    left = left.join(groups, "cell").withColumn("_group", own).drop("_groups")
    every = F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))
    right = items.join(groups, "cell").withColumn("_group", every).drop("_groups")

    arrow = to_arrow_schema(schema)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return compare_groups(left, right, k, "relevance", arrow)

    keys = ["cell", "_group"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def nearest_in_cells(
    spark: SparkSession, path: str, queries: DataFrame, k: int, ws: Workspace
) -> DataFrame:
    """As :func:`~pagequarry.operators.nearest.nearest` by relevance, from an index.

    Each query first reads its nearest cells, until they hold k items; its k-th best
    distance there then leaves out all cells that can hold nothing nearer. Which cells
    were read is in the tables ``first`` and ``later`` of ``ws`` (query_id, cell). Where
    this would still be more than a quarter of all, as among vectors without clusters, all
    items are compared without a shuffle instead.
    """
    table = _Table(spark.read.parquet(f"{path}/cells").toArrow())  # TABLE_BYTES
    shared = spark.sparkContext.broadcast(table)
    items = spark.read.parquet(f"{path}/items")
    queries = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    queries = ws.save(queries, "queries")
    order = [F.desc("score"), F.asc("item_id")]
    asked = ws.save(_choose(queries, shared, k, second=False), "first")
    hits = ws.save(top_k(_meet(asked, queries, items, k), ["query_id"], order, k, ["item_id"]), "hits")
    last = hits.groupBy("query_id").agg(F.min("score").alias("_score"), F.count(F.lit(1)).alias("_n"))
    # relevance is 1 - distance^2 / sqrt 2; without k hits there is no bar
    bar = F.sqrt(F.greatest(F.lit(0.0), (1 - F.col("_score") + 1e-8) * math.sqrt(2)))
    barred = queries.join(last, "query_id", "left").select(
        "query_id", "vector", F.when(F.col("_n") >= k, bar).otherwise(F.lit(math.inf)).alias("_bar")
    )
    asked = ws.save(_choose(barred, shared, k, second=True), "later")
    if asked.count() > queries.count() * len(table.cell) * READ_SHARE:
        return nearest(queries, items, k, "relevance")
    found = _meet(asked, queries, items, k).unionByName(hits.select("query_id", "item_id", "score"))
    return top_k(found, ["query_id"], order, k, ["item_id"]).select("query_id", "item_id", "rank_no", "score")
