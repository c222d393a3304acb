"""Embedding near-dedup with spherical-cap filters from a random product code.

A filter is a direction made of one code word for each half of a vector. Scores
of the halves add up, so a vector is list-decoded to all directions it exceeds
the cap height of without trying each: only code words near the best of their
half can take part. The height is ``WIDTH`` below a vector's best direction. Vectors of
one label meet in the filters they share; cosines in double precision decide.

Equal vectors of a label become one class first. A filter with many vectors is
cut into blocks, compared pair by pair as matrix products; a pair of classes
counts in the first filter they share only, so no table of pairs is made. A cell
gives counts of links, and no more links than connect what it found.

Vectors that are null, empty, all zero, or hold null or non-finite numbers, and
vectors without a label, link with nothing; vectors of different length do not
link. Repeated rows are copies of each other; rows that share an id share its
component. The number of filters follows the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.components import components, forest
from pagequarry.llm.words import overlaps
from pagequarry.operators.spread import spread_join
from pagequarry.session import Workspace

COSINE = 0.98
WIDTH = 0.1
PER_FILTER = 32  # classes for each filter, before list decoding
BLOCK_ROWS = 1024


def _codes(size: int, count: int, half: int) -> np.ndarray:
    """``count`` random unit vectors of ``size`` numbers; the same in every task."""
    made = np.random.Generator(np.random.PCG64([size, count, half])).standard_normal((count, size))
    return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-300)


def unit_rows(vectors: list) -> list[np.ndarray | None]:
    """Unit vectors in double precision, or None for those that link with nothing."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        x = np.array([np.nan] if not v or None in v else v, np.float64)
        scale = np.abs(x).max()
        if not np.isfinite(scale) or scale == 0:
            out.append(None)
            continue
        x = x / scale
        out.append(x / np.sqrt((x * x).sum()))
    return out


def filters_of(units: np.ndarray, count: int, width: float = WIDTH) -> list[np.ndarray]:
    """For each unit vector, the sorted numbers of the filters it passes."""
    cut = units.shape[1] // 2
    halves = [units[:, :cut], units[:, cut:]]
    a, b = (h @ _codes(h.shape[1], count, k).T for k, h in enumerate(halves))
    lists = []
    for x, y in zip(a, b):
        least = x.max() + y.max() - width * np.sqrt(2.0)
        i, j = np.flatnonzero(x >= least - y.max()), np.flatnonzero(y >= least - x.max())
        p, q = np.nonzero(x[i][:, None] + y[j][None, :] >= least)
        lists.append(np.sort(i[p] * count + j[q]).astype(np.int64))
    return lists


def _classes(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, digest, unit (binary, null if it links with nothing)."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit_rows(batch.column("embedding").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([None if r is None else r.tobytes() for r in rows], pa.binary()),
                ],
                names=["vec_id", "label", "unit"],
            )

    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    kind = slim.schema["label"].dataType.simpleString()
    units = slim.mapInArrow(unit, f"vec_id long, label {kind}, unit binary")
    usable = F.col("label").isNotNull() & F.col("unit").isNotNull()
    group = F.when(usable, F.xxhash64("label", F.octet_length("unit")))
    return units.select("vec_id", group.alias("kind"), F.sha2("unit", 256).alias("digest"), "unit")


def _decode(classes: DataFrame, count: int) -> DataFrame:
    """A row for each class and filter it passes, with all its filters."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("unit").to_pylist()
            lists: list[np.ndarray] = [np.zeros(0, np.int64)] * len(units)
            sizes = np.array([len(u) for u in units])
            for size in set(sizes.tolist()):
                at = np.flatnonzero(sizes == size)
                rows = np.stack([np.frombuffer(units[k], np.float64) for k in at])
                for k, found in zip(at, filters_of(rows, count)):
                    lists[k] = found
            which = np.repeat(np.arange(len(units)), [len(x) for x in lists])
            for start in range(0, len(which), 20_000):
                part = which[start : start + 20_000]
                flat = np.concatenate(lists)[start : start + 20_000]
                taken = batch.take(pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns,
                        pa.array(flat),
                        pa.array([lists[k].tobytes() for k in part], pa.binary()),
                    ],
                    names=["rep", "kind", "unit", "copies", "filter", "filters"],
                )

    shape = "rep long, kind long, unit binary, copies long, filter long, filters binary"
    return classes.select("rep", "kind", "unit", "copies").mapInArrow(decode, shape)


def _compare(cells: DataFrame) -> DataFrame:
    """(a, b, n): links that connect a cell, and with b null the links that a has there."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        made: list[tuple] = []

        def finish() -> None:
            if len(rows) < 2:
                return
            side = np.array([r[2] for r in rows])
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            alone = not len(right)
            right = left if alone else right
            if not len(left):
                return
            units = np.stack([np.frombuffer(r[4], np.float64) for r in rows])
            near = units[left] @ units[right].T >= COSINE
            i, j = np.nonzero(np.triu(near, 1) if alone else near)
            i, j = left[i], right[j]
            if not len(i):
                return
            # a pair counts here if it shares no filter with a smaller number
            some, place = np.unique(np.r_[i, j], return_inverse=True)
            lists = [np.frombuffer(rows[k][6], np.int64) for k in some]
            before = [x[: np.searchsorted(x, rows[k][1])] for x, k in zip(lists, some)]
            own = overlaps(before, before)[place[: len(i)], place[len(i) :]] == 0
            i, j = i[own], j[own]
            copies = np.array([r[5] for r in rows])
            n = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
            made.extend((rows[k][3], None, int(n[k])) for k in np.flatnonzero(n))
            made.extend((rows[i[k]][3], rows[j[k]][3], 0) for k in forest(len(rows), i.tolist(), j.tolist()))

        def packed() -> pa.RecordBatch:
            columns = zip(*made) if made else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != cell:
                    finish()
                    cell, rows = row[0], []
                rows.append(row)
            yield packed()
            made.clear()
        finish()
        yield packed()

    columns = ["cell", "filter", "side", "rep", "unit", "copies", "filters"]
    return cells.select(*columns).mapInArrow(compare, "a long, b long, n long")


def near_vectors(vectors: DataFrame, ws: Workspace) -> DataFrame:
    """Of vectors(vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    units = ws.save(_classes(vectors), "units")
    key = ["kind", "digest"]
    groups = units.where("kind IS NOT NULL").groupBy(*key).agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    groups = ws.save(groups, "groups")
    named = spread_join(units, groups, key, "left", spread_on=["vec_id"])
    classes = ws.save(
        named.where("vec_id = rep").select("rep", "kind", "digest", "unit", "copies").dropDuplicates(["rep", "digest"]),
        "classes",
    )
    count = max(8, int(np.ceil(np.sqrt(classes.count() / PER_FILTER))))
    decoded = _decode(classes, count)
    sizes = decoded.groupBy("kind", "filter").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = ws.save(sizes.withColumn("parts", F.ceil(F.col("size") / BLOCK_ROWS).cast("int")).drop("size"), "sizes")
    dealt = spread_join(decoded, sizes, ["kind", "filter"], spread_on=["rep"])
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    cells = (
        dealt.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("cell", F.xxhash64("kind", "filter", F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
    )
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(wanted, "cell").sortWithinPartitions("cell", "side", "rep")
    found = ws.save(_compare(cells), "found")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    near = components(found.where("b IS NOT NULL").select("a", "b"), ws).withColumnRenamed("node", "rep")
    facts = ws.save(near.join(links, "rep", "full"), "facts")
    slim = named.select("vec_id", "rep", "copies")
    out = spread_join(slim, facts, ["rep"], "left", spread_on=["vec_id"])
    component = F.coalesce("component", "rep", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
