"""The manifest of a table that is stored in segments: which of them count, and which should be merged.

Each commit adds one row to the manifest, with its version and all live segments; the row with
the greatest version holds. A segment's files are complete before a row names it and
are never written again, so readers see the state before a commit or after it. One writer at a
time is assumed, as a stream has one.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.session import empty_folder

MANIFEST = (
    "version long, id_type string, "
    "live array<struct<folder: string, name: string, n_docs: long, total_len: long>>"
)
ERA = 256  # rows of a manifest folder


class Segment(NamedTuple):
    folder: str
    name: str
    n_docs: int
    total_len: int

    @property
    def size(self) -> int:
        return self.n_docs + self.total_len


class Manifest(NamedTuple):
    version: int
    id_type: str
    live: list[Segment]


def new_folder(name: str) -> str:
    """A folder of its own for each attempt."""
    return f"{name}-{uuid.uuid4().hex[:12]}"


def _rows(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{MANIFEST}, era long").parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest row; version 0 without live segments where nothing was committed."""
    stored = _rows(spark, path)
    row = None if stored is None else stored.orderBy(F.desc("version")).first()
    if row is None:
        return Manifest(0, "string", [])
    return Manifest(row["version"], row["id_type"], [Segment(*s) for s in row["live"]])


def commit(spark: SparkSession, path: str, version: int, live: list[Segment], id_type: str) -> None:
    row = spark.createDataFrame([(version, id_type, [tuple(s) for s in live])], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest/era={version // ERA}")


def read_segments(spark: SparkSession, path: str, schema: str, folders: list[str]) -> DataFrame:
    """One table of the given segments, whose number is small; others are not even listed."""
    if not folders:
        return spark.createDataFrame([], f"{schema}, segment string")
    reader = spark.read.schema(f"{schema}, segment string").option("basePath", path)
    return reader.parquet(*[f"{path}/segment={folder}" for folder in folders])


def alike(live: list[Segment]) -> list[Segment]:
    """The segments to merge into one: all up to the largest that the smaller ones together outweigh.

    Those left are each larger than all smaller ones together, so their number is at most the
    logarithm to base 2 of the whole size over the least. A document is rewritten only when its
    segment at least doubles.
    """
    order = sorted(live, key=lambda s: (s.size, s.folder))
    total, last = 0, 0
    for k, segment in enumerate(order):
        if k and segment.size <= total:
            last = k + 1
        total += segment.size
    return order[:last]


def vacuum(spark: SparkSession, path: str, tables: list[str], keep: int = 1) -> list[str]:
    """Empty the folders of segments that none of the ``keep`` newest rows names, and older rows."""
    stored = _rows(spark, path)
    if stored is None:
        return []
    newest = stored.orderBy(F.desc("version")).limit(keep).collect()
    kept = {s["folder"] for row in newest for s in row["live"]}
    dropped = set()
    for table in tables:
        try:
            found = spark.read.schema("segment string").parquet(f"{path}/{table}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        for row in found.select("segment").distinct().collect():
            if row["segment"] not in kept:
                empty_folder(spark, f"{path}/{table}/segment={row['segment']}")
                dropped.add(row["segment"])
    eras = [row["era"] for row in stored.select("era").distinct().collect()]
    for era in eras:
        if newest and era < newest[-1]["version"] // ERA:
            empty_folder(spark, f"{path}/manifest/era={era}")
    return sorted(dropped)
