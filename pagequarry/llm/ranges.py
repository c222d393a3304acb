"""Ranges of ids as buckets, in order: what comes before is in an earlier bucket or the same."""

from __future__ import annotations

import gc
import time

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def id_bounds(docs: DataFrame, n: int, null_as: int) -> np.ndarray:
    """The least id of each of about ``n`` ranges with about equal numbers of rows.

    Only the id column is read, and one number for each range reaches the driver.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(null_as)).alias("doc_id"))
    ranges = ids.repartitionByRange(n, "doc_id").groupBy(F.spark_partition_id())
    rows = ranges.agg(F.min("doc_id").alias("least")).select("least").collect()
    return np.array(sorted({row["least"] for row in rows}), np.int64)


def text_size(docs: DataFrame) -> int:
    """Bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"]
    return size or 0


WAIT = 1.5
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let this session send documents to Python in batches of BATCH_ROWS rows at most.

    A worker and its executor hold a few batches at once, and documents are large rows.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now, not at some later collection.

    The first wait is for the events of the last job, which hold on to its plan.
    """
    time.sleep(WAIT)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(WAIT / 3)


