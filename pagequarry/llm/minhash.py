"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct runs of five words; its sketch
is the K smallest of them. Inverted lists of sketch values tell which documents
can overlap; a cheap bound of the union sketch's estimate filters; exact Jaccard
on the whole sets decides.

Copies (equal sets) become one class first. A link of Jaccard 0.75 shares more
than NEED values of two full sketches but for a chance below 1e-9, and at least
three quarters of a smaller set; so each class is listed only under its rarest
values, as many as leave fewer than that out, and a class that shares too few
values is out. No pair of documents is ever made. Each class lives in one block,
a bounded part of its largest list. Blocks that meet in a list are compared in cells: a host
block and as many of its guests as a task may hold, at once, as matrix products. So the host's
sets are sent once for many guests. A cell gives no more links than connect what it found.

Only components are asked for, so cells are compared in two rounds. In the first, each block meets
itself and the largest block of each of its lists. In the second, only lists whose other blocks hold
sets of more than one component are left, and there the sets outside the largest component meet all
others: a large group of near copies, once connected, is not compared again. Every two sets of a
list that could join two components are compared, whatever the list's length.

Null and empty texts have an empty set and link with nothing. Repeated rows, and
rows that share an id, are one document's. Only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.components import components, forest
from pagequarry.llm.ranges import release
from pagequarry.llm.words import binary_column, column_words, mix, overlaps, ragged, release_memory, slices, window_hashes, window_starts
from pagequarry.operators.spread import spread_join
from pagequarry.session import Workspace

SHINGLE = 5
K = 64
NEED = 24
THRESHOLD = 75  # per cent
BLOCK_SHINGLES = 500_000


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; all words as one if they are few."""
    words = column_words(column)
    hashes = words.hashes(lower=True)
    starts, _ = window_starts(words.first, size)
    runs = window_hashes(hashes, size)[starts]
    sets = [np.unique(x) for x in ragged(runs, np.maximum(words.counts - size + 1, 0))]
    for d in np.flatnonzero((words.counts > 0) & (words.counts < size)):
        own = hashes[words.first[d] : words.first[d + 1]]
        sets[d] = mix(window_hashes(own, len(own)) + np.uint64(len(own)))
    return sets


def needed(n: np.ndarray, k: int = K, need: int = NEED) -> np.ndarray:
    """Values a set of ``n`` must share with a partner's sketch. Up to 3/4 K shingles,
    a partner's sketch is its whole set, and the bound is exact."""
    return np.where(n <= k * THRESHOLD // 100, -(-n * THRESHOLD // 100), need)


def _digest(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set, and a sum and an xor of mixed values that stand for the whole set."""
    n = np.array([len(s) for s in sets], np.int64)
    one = np.array([s.sum() for s in sets], np.uint64)
    two = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(1))) if len(s) else 0 for s in sets], np.uint64)
    return n, one.view(np.int64), two.view(np.int64)


def _sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n, two hashes of the whole set, and the sketch as binary."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                n, one, two = _digest(sets)
                low = [s[:K] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(n),
                        pa.array(one),
                        pa.array(two),
                        binary_column(np.concatenate(low), np.minimum(n, K)),
                    ],
                    names=["doc_id", "n", "one", "two", "sketch"],
                )

    schema = "doc_id long, n long, one long, two long, sketch binary"
    return docs.select("doc_id", "text").mapInArrow(sketch, schema)


_ROW_KEY = "doc_id long, n_shingles long, one long, two long, row "


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, one, two, row) of rows (doc_id, row, text)."""
    for batch in batches:
        for part in slices(batch, "text"):
            n, one, two = _digest(shingle_sets(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(one), pa.array(two), part.column("row")],
                names=["doc_id", "n_shingles", "one", "two", "row"],
            )


def _values(nodes: DataFrame) -> DataFrame:
    """(value, rep, n): a row for each value of each sketch."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = batch.column("sketch").to_pylist()
            sizes = np.array([len(s) // 8 for s in sketches], np.int64)
            which = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(b"".join(sketches), np.int64)),
                    batch.column("rep").take(which),
                    batch.column("n").take(which),
                ],
                names=["value", "rep", "n"],
            )

    return nodes.select("rep", "n", "sketch").mapInArrow(unpack, "value long, rep long, n long")


def cell_links(
    left: list[np.ndarray], right: list[np.ndarray] | None
) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of linked sets between two blocks, or within one if ``right`` is None."""
    other = left if right is None else right
    # the union sketch holds no more common values than both sketches share
    bound = overlaps([s[:K] for s in left], [s[:K] for s in other])
    na, nb = (np.array([len(s) for s in side]) for side in (left, other))
    able = bound >= np.maximum.outer(*(np.minimum(needed(n), NEED) for n in (na, nb)))
    if right is None:
        able = np.triu(able, 1)
    rows, columns = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
    if not len(rows):
        return rows, columns
    both = overlaps([left[i] for i in rows], [other[j] for j in columns]).astype(np.int64)
    union = na[rows][:, None] + nb[columns][None, :] - both
    i, j = np.nonzero((100 * both >= THRESHOLD * union) & able[np.ix_(rows, columns)])
    return rows[i], columns[j]


def _compare(cells: DataFrame) -> DataFrame:
    """links(a, b) from rows (cell, side, rep, members), sorted by cell."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sides = None, ([], [])
        made: list[tuple[int, int]] = []

        def finish() -> None:
            left, right = ([np.frombuffer(m, np.uint64) for _, m in side] for side in sides)
            if left and (right or len(left) > 1):
                i, j = cell_links(left, right or None)
                names = [r for side in sides for r, _ in side]
                j = j + len(left) if right else j
                made.extend((names[i[k]], names[j[k]]) for k in forest(len(names), i.tolist(), j.tolist()))

        for batch in batches:
            for key, side, rep, members in zip(*(c.to_pylist() for c in batch.columns)):
                if key != cell:
                    finish()
                    cell, sides = key, ([], [])
                sides[side].append((rep, members))
        finish()
        sides = ([], [])
        release_memory()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in made], pa.int64()), pa.array([x for _, x in made], pa.int64())],
            names=["a", "b"],
        )

    return cells.select("cell", "side", "rep", "members").mapInArrow(links, "a long, b long")


def _cells(hosts: DataFrame, own: DataFrame, weights: DataFrame) -> DataFrame:
    """(cell, block, side): hosts(host, block) compared with guests, own(block) each with itself.

    The guests of a host are dealt out over as many cells as their weights(block, weight) need.
    """
    guests = hosts.join(weights, "block")
    parts = guests.groupBy("host").agg(F.ceil(F.sum("weight") / BLOCK_SHINGLES).alias("parts"))
    cell = F.xxhash64("host", F.pmod(F.xxhash64("block"), F.col("parts"))).alias("cell")
    dealt = guests.join(parts, "host").select(cell, "host", "block")
    return (
        dealt.select("cell", "block", F.lit(1).alias("side"))
        .unionByName(dealt.select("cell", F.col("host").alias("block"), F.lit(0).alias("side")).distinct())
        .unionByName(own.select(F.xxhash64("block", F.lit("own")).alias("cell"), "block", F.lit(0).alias("side")))
    )


def _cell_links(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """links(a, b) of cells(cell, block, side), each compared whole, from sets(rep, block, members)."""
    wanted = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.join(sets, "block").select("cell", "side", "rep", "members")
    return _compare(dealt.repartition(wanted, "cell").sortWithinPartitions("cell", "side", "rep"))


def _second_round(rest: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(cells, blocks of sets) from rest(value, rep, n, block, odd).

    Sets that are odd in a list, outside its largest component, move to blocks of their own, and
    only these host the list's other blocks.
    """
    odd = rest.where("odd")
    weights = odd.groupBy("value").agg(F.sum(F.col("n") + 300).alias("weight"))
    home = odd.join(weights, "value").groupBy("rep").agg(F.max(F.struct("weight", "value")).alias("home"))
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("home.weight") / BLOCK_SHINGLES))
    moved = home.select("rep", F.xxhash64(F.lit("odd"), "home.value", part).alias("own"))
    placed = rest.join(moved, "rep", "left")
    placed = ws.save(placed.select("value", "rep", "n", "odd", F.coalesce("own", "block").alias("block")), "placed")
    odd_blocks = placed.where("odd").select("value", F.col("block").alias("host")).distinct()
    hosts = placed.select("value", "block").distinct().join(odd_blocks, "value").where("host <> block")
    own = odd_blocks.select(F.col("host").alias("block")).distinct()
    sets = placed.select("rep", "n", "block").distinct()
    weights = sets.groupBy("block").agg(F.sum(F.col("n") + 300).alias("weight"))
    cells = ws.save(_cells(hosts.select("host", "block").distinct(), own, weights), "cells_second")
    return cells, sets.select("rep", "block")


def near_duplicates(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Of docs(doc_id, text): doc_id, n_shingles, class_id (least id with the same set),
    component_id, kept."""
    return _named(docs, ws).drop("one", "two")


def kept_documents(docs: DataFrame, ws: Workspace) -> DataFrame:
    """One document of each group of near-duplicates: that with the least id.

    Rows that share an id are judged each by its own text: of those in one group the
    least row stays, by text, then the other columns. Rows without an id stay.
    """
    found = ws.save(_named(docs, ws).select("doc_id", "n_shingles", "one", "two", "component_id", "kept"), "named")
    again = ws.save(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    out = ws.save(found.where("NOT kept").select("doc_id").unionByName(again).distinct(), "apart")
    single = spread_join(docs, out, ["doc_id"], "left_anti", spread_on=["text"])
    if again.isEmpty():
        return single
    repeated = spread_join(docs, again, ["doc_id"], "left_semi", spread_on=["text"])
    key = ["doc_id", "n_shingles", "one", "two"]
    rows = repeated.select("doc_id", F.struct("text", *[c for c in docs.columns if c != "text"]).alias("row"), "text")
    rows = rows.mapInArrow(_digested, _ROW_KEY + rows.schema["row"].dataType.simpleString())
    judged = rows.join(found.where("kept").select(*key, "component_id").distinct(), key)
    # an empty set is in no group
    least = judged.groupBy("doc_id", "component_id", F.col("n_shingles") > 0).agg(F.min("row").alias("row"))
    return single.unionByName(least.select(*[F.col("row")[c].alias(c) for c in docs.columns]))


def _named(docs: DataFrame, ws: Workspace) -> DataFrame:
    spark = docs.sparkSession
    sketches = ws.save(_sketches(docs), "sketches")
    key = ["n", "one", "two"]
    classes = sketches.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    classes = ws.save(classes, "classes")
    named = spread_join(sketches, classes, key, "left", spread_on=["doc_id"])
    nodes = ws.save(
        named.where("doc_id = rep").select("rep", "n", "sketch").dropDuplicates(["rep", "n"]), "nodes"
    )
    release(spark)

    values = _values(nodes)
    counts = ws.save(values.groupBy("value").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "counts")
    release(spark)
    # at most K values of a class meet here
    shared = values.join(counts, "value").groupBy("rep", "n").agg(
        F.sort_array(F.collect_list(F.struct("c", "value"))).alias("shared")
    )
    small = F.ceil(F.col("n") * THRESHOLD / 100)
    need = F.when(F.col("n") <= K * THRESHOLD // 100, small).otherwise(F.lit(NEED)).cast("int")
    listed = (
        shared.withColumn("need", need)
        .where(F.size("shared") >= F.col("need"))
        .select("rep", "n", F.explode(F.slice("shared", F.lit(1), F.size("shared") - F.col("need") + 1)).alias("s"))
        .select("rep", "n", F.col("s.value").alias("value"))
    )
    listed = ws.save(listed, "listed")
    release(spark)

    lists = listed.groupBy("value").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("n") + 300).alias("weight")).where("c > 1")
    lists = ws.save(lists, "lists")
    placed = listed.join(lists, "value")
    home = placed.groupBy("rep").agg(
        F.max(F.struct("c", "value", "weight")).alias("home"), (F.max("n") + 300).alias("own_weight")
    )
    home = ws.save(home, "home")
    parts = F.ceil(F.col("home.weight") / BLOCK_SHINGLES)
    block = F.xxhash64("home.value", F.pmod(F.xxhash64("rep"), parts))
    blocks = ws.save(home.select("rep", block.alias("block")), "blocks")
    listed = ws.save(listed.join(lists, "value", "left_semi").join(blocks, "rep"), "listed_blocks")
    met = listed.select("value", "block").distinct()
    # the largest block of a list, so that lists of the same sets choose the same one
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("c"))
    pivot = F.max(F.struct("c", "block"))["block"].alias("pivot")
    pivots = ws.save(met.join(sizes, "block").groupBy("value").agg(pivot), "pivots")
    weights = blocks.join(home.select("rep", "own_weight"), "rep").groupBy("block").agg(F.sum("own_weight").alias("weight"))
    hosts = listed.join(pivots, "value").where("block <> pivot").select(F.col("pivot").alias("host"), "block").distinct()
    cells = ws.save(_cells(hosts, blocks.select("block").distinct(), weights), "cells")
    release(spark)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("block"), binary_column(np.concatenate(sets), np.array([len(s) for s in sets]))],
                    names=["rep", "block", "members"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    chosen = spread_join(texts, blocks, ["rep"], spread_on=["text"])
    sets = ws.save(chosen.select("rep", "block", "text").mapInArrow(members, "rep long, block long, members binary"), "sets")
    release(spark)
    links = ws.save(_cell_links(cells, sets), "links")
    release(spark)
    found = components(links, ws)

    # what the first round left: lists with several components outside their largest block
    named_sets = listed.join(pivots, "value").where("block <> pivot")
    named_sets = spread_join(named_sets, found.withColumnRenamed("node", "rep"), ["rep"], "left", spread_on=["value"])
    rest = named_sets.select("value", "rep", "n", "block", F.coalesce("component", "rep").alias("component"))
    sizes = rest.groupBy("value", "component").agg(F.count(F.lit(1)).alias("c"), F.min("block").alias("low"), F.max("block").alias("high"))
    open_lists = sizes.groupBy("value").agg(
        F.count(F.lit(1)).alias("components"), F.max(F.struct("c", "component")).alias("main"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    open_lists = open_lists.where("components > 1 AND low < high").select("value", F.col("main.component").alias("main"))
    rest = ws.save(rest.join(open_lists, "value").withColumn("odd", F.col("component") != F.col("main")), "rest")
    if not rest.isEmpty():
        cells, again = _second_round(rest, ws)
        more = again.join(sets.select("rep", "members"), "rep")
        links = ws.save(_cell_links(cells, more), "links_second")
        connected = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
        found = components(connected, Workspace(spark, "minhash_second"))
    release(spark)

    found = found.withColumnRenamed("node", "rep")
    # ids of components are few beside the documents, but they grow with them: measured
    slim = named.select("doc_id", F.col("n").alias("n_shingles"), "one", "two", "rep")
    slim = spread_join(slim, ws.save(found, "found"), ["rep"], "left", spread_on=["doc_id"])
    component = F.coalesce("component", "rep", "doc_id")
    return slim.select(
        "doc_id",
        "n_shingles",
        F.coalesce("rep", "doc_id").alias("class_id"),
        component.alias("component_id"),
        (F.col("doc_id").eqNullSafe(component)).alias("kept"),
        "one",
        "two",
    )
