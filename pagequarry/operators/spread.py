"""Joins, top-k and numbering that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.session import Workspace

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.001
SHARDS = 16


def row_bytes(df: DataFrame) -> Column:
    """Size of one row, from the real length of its strings and arrays."""
    total = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(field.dataType, T.ArrayType):
            if isinstance(field.dataType.elementType, T.StringType):
                size = F.coalesce(F.octet_length(F.array_join(column, "")), F.lit(0))
                size = size + 16 * F.coalesce(F.size(column), F.lit(0))
            else:
                size = 8 * F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0)) + 16
        else:
            size = F.lit(16)
        total = total + size
    return total.cast("long")


def measure(df: DataFrame) -> int:
    """Size of a table in bytes, summed over its rows."""
    return df.select(row_bytes(df).alias("b")).agg(F.sum("b").alias("b")).first()["b"] or 0


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that own more than ``share`` of the rows: at most ``1 / share`` of them."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_n")).scalar()
    hot = counts.where(F.col("_n") > total * share)
    # so that no part of a hot key is larger than ``share`` of the rows
    salts = F.least(F.ceil(F.col("_n") / (total * share)), F.col("_n"))
    return hot.select(*on, salts.cast("int").alias("_salts"))


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_on: Sequence[str] | None = None,
    small_bytes: int | None = None,
    limit: int | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Equi-join whose keys with more than ``share`` of the rows are split.

    The small side is broadcast if its size allows; the size is measured unless
    the caller knows a bound. Beyond that, both
    sides are shuffled; rows of a hot key are spread by a hash of ``spread_on``, over
    as many parts as it has times the share, and the few matching rows of the small side are repeated for each salt.
    Each big row still meets every small row of its key exactly once, so inner,
    left, left_semi and left_anti joins keep their meaning.
    """
    if small_bytes is None:
        small_bytes = measure(small)
    if small_bytes <= (BROADCAST_BYTES if limit is None else limit):
        return big.join(F.broadcast(small), list(on), how)
    spread_on = spread_on or [c for c in big.columns if c not in on]
    hot = F.broadcast(hot_keys(big, on, share))  # at most 1 / share rows
    salts = F.coalesce("_salts", F.lit(1))
    salt = F.pmod(F.xxhash64(*spread_on), salts).cast("int")
    left = big.join(hot, list(on), "left").withColumn("_salt", salt).drop("_salts")
    copies = F.sequence(F.lit(0), salts - 1)
    right = small.join(hot, list(on), "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def top_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread_on: Sequence[str],
    total: str | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """The first ``k`` rows of each group with their place as ``rank_no``.

    Each group is first cut down inside ``shards`` parts, so only
    ``shards * k`` of its rows ever meet in one task. ``total`` names a column
    for the size of the whole group, counted in the same pass.
    """
    part = Window.partitionBy(*group, "_shard")
    whole = Window.partitionBy(*group)
    if "_shard" not in df.columns:
        df = df.withColumn("_shard", shard_of(spread_on, shards))
    # ranks first: the counts then reuse their sort
    df = df.withColumn("_part_rank", F.row_number().over(part.orderBy(*order)))
    if total:
        df = df.withColumn("_part_size", F.count(F.lit(1)).over(part))
    df = df.where(F.col("_part_rank") <= k)
    df = df.withColumn("rank_no", F.row_number().over(whole.orderBy(*order)))
    if total:
        size = F.when(F.col("_part_rank") == 1, F.col("_part_size"))
        df = df.withColumn(total, F.sum(size).over(whole))
    return df.where(F.col("rank_no") <= k).drop("_shard", "_part_size", "_part_rank")


def shard_of(spread_on: Sequence[str], shards: int = SHARDS) -> Column:
    return F.pmod(F.xxhash64(*spread_on), F.lit(shards)).cast("int")


def dense_ids(
    df: DataFrame, order: Sequence[str | Column], ws: Workspace, id_col: str = "idx"
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order.

    The rows are range-sorted and stored; a row's number is its place in its
    partition plus the sizes of the partitions before it. Only the sizes, one
    per partition, are summed in one task.
    """
    return number_sorted(ws.save(with_place(df.orderBy(*order)), f"sorted_{id_col}"), id_col)


PLACE_BITS = 33  # monotonically_increasing_id keeps a row's place in its partition in the low bits


def with_place(df: DataFrame) -> DataFrame:
    """Add the partition and the place in it; they mean nothing until the rows are stored."""
    return df.withColumn("_mid", F.monotonically_increasing_id())


def number_sorted(stored: DataFrame, id_col: str, *runs: str) -> DataFrame:
    """Number stored rows by ``runs``, then by the place they were stored with."""
    part = F.shiftright("_mid", PLACE_BITS)
    keys = [*runs, "_part"]
    sizes = stored.groupBy(*runs, part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    inside = Window.partitionBy(*runs).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_size", F.coalesce(F.sum("_size").over(inside), F.lit(0)).alias("_offset"))
    if runs:  # only one row for each run is in one task
        before = Window.orderBy(*runs).rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.groupBy(*runs).agg(F.sum("_size").alias("_size")).select(
            *runs, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
        )
        offsets = offsets.join(F.broadcast(starts), list(runs))
        offsets = offsets.withColumn("_offset", F.col("_offset") + F.col("_start")).drop("_start")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets.drop("_size")), keys)  # one row per stored partition
        .withColumn(id_col, F.col("_offset") + F.col("_mid").bitwiseAND((1 << PLACE_BITS) - 1))
        .drop("_part", "_mid", "_offset")
    )
