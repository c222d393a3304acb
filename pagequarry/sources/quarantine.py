"""Rows that a job can not use are set aside with a reason, and the job goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions import text as tx
from pagequarry.session import Workspace

_REASON = "_reason"


def split_rows(
    rows: DataFrame, key: Column, reasons: dict[str, Column], job: str, errors: str, ws: Workspace
) -> DataFrame:
    """The rows that no condition in ``reasons`` holds for; the others go to ``errors``.

    ``reasons`` is a condition for each reason; of several the first one counts, and an unknown
    condition does not hold. The rows are worked out once and stored. The error table
    (job, key, reason, n) has a row for each bad row and one, without key, for all that were
    kept; so ``n`` adds up to the input. A job that runs again replaces its own rows.
    """
    reason = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()])
    tagged = rows.withColumn(_REASON, reason).withColumn("_key", key.cast("string"))
    stored = ws.save(tagged, f"split_{job}")
    kept = stored.where(F.col(_REASON).isNull()).count()  # reads one column
    bad = stored.where(F.col(_REASON).isNotNull()).select(
        F.col("_key").alias("key"), F.col(_REASON).alias("reason"), F.lit(1).cast("long").alias("n")
    )
    whole = rows.sparkSession.createDataFrame([(None, "kept", kept)], bad.schema)
    written = bad.unionByName(whole).withColumn("job", F.lit(job)).write.mode("overwrite")
    written.option("partitionOverwriteMode", "dynamic").partitionBy("job").parquet(errors)
    return stored.where(F.col(_REASON).isNull()).drop(_REASON, "_key")


def indexable(docs: DataFrame, errors: str, ws: Workspace) -> DataFrame:
    """Documents (doc_id, url, content) that an index can take."""
    reasons = {"no id": F.col("doc_id").isNull(), "no content": F.coalesce(F.trim("content"), F.lit("")) == ""}
    return split_rows(docs, F.col("doc_id"), reasons, "index", errors, ws)


def linkable(pages: DataFrame, errors: str, ws: Workspace) -> DataFrame:
    """Pages (url, html) that links can be taken from."""
    reasons = {"no address": F.col("url").isNull(), "not HTML": ~F.coalesce(tx.is_html(F.col("html")), F.lit(False))}
    return split_rows(pages, F.col("url"), reasons, "links", errors, ws)


def cleanable(pages: DataFrame, errors: str, ws: Workspace) -> DataFrame:
    """Cleaned texts (url_key, content) of pages (url_key, html), those long enough to keep."""
    cleaned = pages.select("url_key", tx.clean_for_answers(F.col("html")).alias("content"))
    reasons = {
        "no key": F.col("url_key").isNull(),
        "too short": ~F.coalesce(tx.long_enough(F.col("content")), F.lit(False)),
    }
    return split_rows(cleaned, F.col("url_key"), reasons, "clean", errors, ws)


def ranked(docs: DataFrame, ranks: DataFrame, errors: str, ws: Workspace) -> DataFrame:
    """Documents (doc_id, url, ...) with their rank; ``ranks`` are one row for each URL."""
    joined = docs.join(ranks.select("url", "rank"), "url", "left")
    return split_rows(joined, F.col("doc_id"), {"no rank": F.col("rank").isNull()}, "rank", errors, ws)
