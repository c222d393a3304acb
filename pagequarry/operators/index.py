"""The keyword index: documents, postings, term statistics and corpus statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions import text as tx
from pagequarry.operators import segments as sg
from pagequarry.operators.spread import spread_join
from pagequarry.session import Workspace, lean

BUCKETS = 32
RANGE_ROWS = 1_000_000  # postings that a task sorts


@dataclass(frozen=True)
class Index:
    """Four tables.

    docs(doc_id, url, content, snippet, doc_len)
    postings(bucket, term, doc_id, tf, doc_len)
    terms(term, df, max_tf, min_len)
    stats(n_docs, total_len): one row
    """

    docs: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame

    def doc_count(self) -> DataFrame:
        """A5."""
        return self.stats.select(F.col("n_docs").alias("n"))


def bucket_of(term: str = "term", buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def stored_documents(docs: DataFrame) -> DataFrame:
    """the stored part of each document, snippet included."""
    return docs.select(
        "doc_id",
        "url",
        "content",
        tx.snippet(F.col("content")).alias("snippet"),
        F.coalesce(F.size(tx.index_terms(F.col("content"))), F.lit(0)).alias("doc_len"),
    )


def _counted(terms: Column) -> Column:
    """Distinct terms of an array as (term, doc_len, tf), counted as the runs of the sorted array."""
    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        begins = lambda i: ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), begins)

        def measured(starts: Column) -> Column:
            def run(start: Column, k: Column) -> Column:
                tf = F.coalesce(F.get(starts, k + 1), n) - start
                return F.struct(F.get(ordered, start).alias("term"), n.alias("doc_len"), tf.cast("long").alias("tf"))

            return F.transform(starts, run)

        return tx.bind(starts, measured)

    return tx.bind(F.sort_array(terms), runs)


def make_postings(docs: DataFrame) -> DataFrame:
    """One row per term and document.

    A document's terms lie in one row and are counted there, so nothing is shuffled
    and no task holds more than a document's terms.
    """
    # an expression, not a column: Spark would filter a column of arrays by its
    # size first, and work it out once more for that
    postings = docs.select("doc_id", F.inline(_counted(tx.index_terms(F.col("content")))))
    return postings.select(bucket_of().alias("bucket"), "term", "doc_id", "tf", "doc_len")


def term_statistics(postings: DataFrame) -> DataFrame:
    """A6 per term; additive, so statistics of parts can be merged."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.max("tf").alias("max_tf"),
        F.min("doc_len").alias("min_len"),
    )


def merge_term_statistics(parts: DataFrame) -> DataFrame:
    return parts.groupBy("term").agg(
        F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len")
    )


def unique_documents(docs: DataFrame) -> DataFrame:
    """One row for each id: of several the least by content, then URL; rows without an id are left out.

    Only ids are grouped, and only rows with a repeated id meet.
    """
    docs = docs.where(F.col("doc_id").isNotNull())
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if again.limit(1).count() == 0:
        return docs
    once = spread_join(docs, again, ["doc_id"], "left_anti", spread_on=["content"])
    row = F.min(F.struct("content", "url")).alias("_row")
    rest = spread_join(docs, again, ["doc_id"], "left_semi", spread_on=["content"])
    rest = rest.groupBy("doc_id").agg(row).select("doc_id", "_row.url", "_row.content")
    return once.select("doc_id", "url", "content").unionByName(rest)


def corpus_statistics(stored: DataFrame) -> DataFrame:
    return stored.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("doc_len"), F.lit(0)).cast("long").alias("total_len"),
    )


def build(docs: DataFrame) -> Index:
    """Q6 without storing: ``docs(doc_id, url, content)`` to an index."""
    docs = unique_documents(docs)
    postings = make_postings(docs)
    stored = stored_documents(docs)
    return Index(stored, postings, term_statistics(postings), corpus_statistics(stored))


def _schemas(id_type: str) -> dict[str, str]:
    return {
        "docs": f"doc_id {id_type}, url string, content string, snippet string, doc_len int",
        "postings": f"term string, doc_id {id_type}, tf long, doc_len int, bucket int",
        "terms": "term string, df long, max_tf long, min_len int",
        "stats": "n_docs long, total_len long",
    }


def range_count(stored: DataFrame, rows: int | None = None) -> int:
    """Ranges to sort a stored table in, so that a task's rows do not grow with the table."""
    return max(1, -(-stored.count() // (rows or RANGE_ROWS)))


def _put_all(postings: DataFrame, stored: DataFrame, path: str, folder: str) -> sg.Segment:
    """Store the four tables of a new segment, which counts once it is in the manifest."""
    with Workspace(postings.sparkSession, "postings") as ws:
        # stored, since the ranges are found in a pass of their own
        kept = _put_postings(ws.save(postings, "counted"), path, folder)
    return _put_others(term_statistics(kept), stored, path, folder)


def _put_merged(part: Index, path: str, folder: str) -> sg.Segment:
    """The same of stored segments: no second copy of postings, and term statistics are added up."""
    _put_postings(part.postings, path, folder)
    return _put_others(part.terms, part.docs, path, folder)


def _put_others(terms: DataFrame, stored: DataFrame, path: str, folder: str) -> sg.Segment:
    _put(terms, path, "terms", folder)
    docs = _put(stored, path, "docs", folder)
    stats = _put(corpus_statistics(docs), path, "stats", folder).first()
    return sg.Segment(folder, folder, stats["n_docs"], stats["total_len"])


def _put(df: DataFrame, path: str, table: str, folder: str, *partition: str) -> DataFrame:
    target = f"{path}/{table}/segment={folder}"
    with lean(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def _put_postings(stored: DataFrame, path: str, folder: str) -> DataFrame:
    order = ["bucket", "term", "doc_id"]
    ranges = stored.repartitionByRange(range_count(stored), *order)
    return _put(ranges.sortWithinPartitions(*order), path, "postings", folder, "bucket")


def write(docs: DataFrame, path: str, segment: str = "base") -> None:
    """Store an index, or add a segment to one.

    Postings are range-sorted by bucket, term and document: a frequent term
    runs over many files instead of one, and a search reads only the buckets
    and row groups of its terms. The segment counts once the manifest names it.
    Writing a segment again replaces it, so a repeated attempt adds nothing twice.
    Of several documents with one id the least by content is kept.
    """
    docs = unique_documents(docs)
    _commit_new(docs, path, segment, sg.read_manifest(docs.sparkSession, path))


def _commit_new(docs: DataFrame, path: str, name: str, manifest: sg.Manifest) -> None:
    made = _put_all(make_postings(docs), stored_documents(docs), path, sg.new_folder(name))
    others = [s for s in manifest.live if s.name != name]
    if made.n_docs or not others:
        others.append(made._replace(name=name))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sg.commit(docs.sparkSession, path, manifest.version + 1, others, id_type)


def open_index(spark: SparkSession, path: str) -> Index:
    """Read a stored index with all its live segments."""
    manifest = sg.read_manifest(spark, path)
    return _open(spark, path, manifest, manifest.live)


def _open(spark: SparkSession, path: str, manifest: sg.Manifest, live: list[sg.Segment]) -> Index:
    tables = {
        name: sg.read_segments(spark, f"{path}/{name}", schema, [s.folder for s in live])
        for name, schema in _schemas(manifest.id_type).items()
    }
    terms = tables["terms"].select("term", "df", "max_tf", "min_len")
    return Index(
        docs=tables["docs"].select("doc_id", "url", "content", "snippet", "doc_len"),
        postings=tables["postings"].select("bucket", "term", "doc_id", "tf", "doc_len"),
        terms=terms if len(live) == 1 else merge_term_statistics(terms),
        stats=tables["stats"].agg(
            F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
            F.coalesce(F.sum("total_len"), F.lit(0)).alias("total_len"),
        ),
    )


def append(docs: DataFrame, path: str, segment: str) -> None:
    """Q7: index the documents whose id is not stored yet (J8), as a new segment.

    Stored documents keep their content. The segment's own earlier attempt
    does not count as stored, so an interrupted append can be run again; once merged
    into another segment, its documents are stored and are not added again. Of
    several new documents with one id, the least by content wins.
    """
    spark = docs.sparkSession
    manifest = sg.read_manifest(spark, path)
    others = [s for s in manifest.live if s.name != segment]
    if others:
        stored = _open(spark, path, manifest, others).docs
        docs = docs.join(stored.select("doc_id"), "doc_id", "left_anti")
    _commit_new(unique_documents(docs), path, segment, manifest)


def merge_segments(spark: SparkSession, path: str) -> int:
    """Q7: merge segments of like size, so that at most about log2 of their number are live.

    Merged segments are rewritten as a new one, and one manifest row puts it in their place. A merge
    that is stopped before that row changes nothing; its files are dropped by :func:`vacuum`, as
    are the old segments, which readers that opened the index before may still use. Returns the
    number of live segments.
    """
    manifest = sg.read_manifest(spark, path)
    chosen = sg.alike(manifest.live)
    if len(chosen) < 2:
        return len(manifest.live)
    part = _open(spark, path, manifest, chosen)
    made = _put_merged(part, path, sg.new_folder("merged"))
    left = [s for s in manifest.live if s not in chosen] + [made]
    sg.commit(spark, path, manifest.version + 1, left, manifest.id_type)
    return len(left)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete stored segments that none of the ``keep`` newest manifest rows names; their folders."""
    return sg.vacuum(spark, path, list(_schemas("long")), keep)
