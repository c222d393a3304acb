"""Inputs the queries share: the given tables, and tables derived from all their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions import urls
from pagequarry.operators import index as ix
from pagequarry.session import Workspace, lean
from pagequarry.sources.tables import read_rows

_STORED: dict[tuple[str, str, str], str] = {}


# Tables with long texts, where the work is in the rows.
TEXTS = ("documents", "pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_rows(spark, path) if name in TEXTS else spark.read.parquet(path)


def shown(score: Column) -> Column:
    """Six digits of a score that has nine; the shift keeps halves from being ties."""
    return F.round(score + 2e-10, 6)


def stored_once(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]
) -> str:
    """Path of something built once per session and then reused."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = Workspace(spark, name).path("data")
        with lean(spark):
            build(path)
        _STORED[key] = path
    return _STORED[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """docs(doc_id, url, content) of the documents table."""
    url = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", url.alias("url"), F.col("text").alias("content")
    )


def document_index(spark: SparkSession, sf_dir: str) -> ix.Index:
    """The documents' index, written once per session and read from its files."""
    path = stored_once(
        spark, sf_dir, "document_index", lambda p: ix.write(documents(spark, sf_dir), p)
    )
    return ix.open_index(spark, path)


def label_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ranks(url, rank) of the labelled documents; the others have none."""
    labels = table(spark, sf_dir, "labels")
    rank = (F.col("quality") * 2 + 1 - F.col("toxic")) * 0.01
    return documents(spark, sf_dir).join(labels, "doc_id").select("url", rank.alias("rank"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


WIKI_HOST = "wiki.example"


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages moved to one host, each with links to other pages added.

    Page p links to 2p+1, 2p+2, and twice to p//3, in different spellings, and
    to a resource and another host, which are no pages.
    """
    def href(target: str, before: str = "/p/", after: str = "") -> list:
        return [F.lit(f'<a href="{before}'), F.expr(target).cast("string"), F.lit(f'{after}">x</a>')]

    added = [
        *href("page_id * 2 + 1"),
        *href("page_id * 2 + 2", after="/"),
        *href("page_id div 3", after="#top"),
        *href("page_id div 3", before=f"http://{WIKI_HOST}/p/", after="?a=1&amp;b=2"),
        *href("page_id", before="/w/p/"),
        *href("page_id", before="https://other.example/p/"),
    ]
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit(f"https://{WIKI_HOST}/p/"), F.col("page_id").cast("string")).alias("url"),
        F.concat("html", *added).alias("html"),
    )


def site_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """robots(root, body): each site forbids the paths of its first and last URL."""
    pages = table(spark, sf_dir, "pages").withColumn("root", urls.site_root(F.col("url")))
    path = F.substr("u", F.length("root") + 1)

    def line(column: str, end: str):
        return F.concat(F.lit("Disallow: "), F.substr(F.col(column), F.length("root") + 1), F.lit(end))

    return (
        pages.groupBy("root")
        .agg(F.min("url").alias("low"), F.max("url").alias("high"))
        .select(
            "root",
            F.concat(
                F.lit("User-agent: *\n# generated\n  "),
                line("low", "*  \n"),
                F.lit("Disallow:\nAllow: /open\nUser-agent: x\r\n"),
                line("high", ""),
            ).alias("body"),
        )
    )


def nation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """found(src, dst): one link per line item, from the customer's nation to the supplier's."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")

    def url(column: str):
        return F.concat(F.lit("https://nation.example/"), F.col(column).cast("string"))

    return (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(url("c_nationkey").alias("src"), url("s_nationkey").alias("dst"))
    )


def nation_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("https://nation.example/"), F.col("n_nationkey").cast("string"))
    return table(spark, sf_dir, "nation").select(url.alias("url"))
