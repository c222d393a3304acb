"""Links, link graphs and the crawl frontier over a stored page table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions import text as tx, urls
from pagequarry.functions.fixed import RESOURCE_MARKS, VOLATILE_PARAMETERS
from pagequarry.operators.spread import (
    measure,
    number_sorted,
    row_bytes,
    spread_join,
    with_place,
)
from pagequarry.session import Workspace, read_if_present

# A start tag; quoted attribute values may hold '>'.
START_TAG = r"""<{name}(?:[^>"']|"[^"]*"|'[^']*')*+>"""
# Attributes that are not href, each skipped as a whole, then href itself.
ATTRIBUTES = (
    r"""(?is)^<[^\s/>]+(?:[\s/]+(?!href[\s=/>])[^\s/>=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*+"""
)
HAS_HREF = ATTRIBUTES + r"[\s/]+href[\s=/>]"
HREF = ATTRIBUTES + r"""[\s/]+href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""

RULES_IN_ROW = 100  # robots rules of a site that are tried one by one


def page_links(
    pages: DataFrame,
    anchors_only: bool = False,
    accept: Callable[[Column], Column] | None = None,
    resolve: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``pages(url, html)`` to (src, pos, href), one row per link in page order.

    ``accept`` (X3) is a predicate on the href. ``resolve`` turns an href into
    a column ``dst``; links it gives no value for are dropped. Both run inside
    the page's array of links, so each link is looked at once.
    """
    name = r"a(?=[\s/>])" if anchors_only else "[a-zA-Z]"
    visible = F.regexp_replace(F.col("html"), tx.HIDDEN, "")
    tags = F.regexp_extract_all(visible, F.lit("(?i)" + START_TAG.format(name=name)), F.lit(0))
    tags = F.filter(tags, lambda tag: tag.rlike(HAS_HREF))

    def link(tag: Column, pos: Column) -> Column:
        value = F.regexp_replace(F.regexp_extract(tag, HREF, 1), "^[\"']|[\"']$", "")
        return F.struct(pos.alias("pos"), tx.unescape(value, attribute=True).alias("href"))

    links = F.transform(tags, link)
    if accept is not None:
        links = F.filter(links, lambda x: accept(x["href"]))
    if resolve is not None:
        links = F.transform(
            links,
            lambda x: F.struct(
                x["pos"].alias("pos"), x["href"].alias("href"), resolve(x["href"]).alias("dst")
            ),
        )
        links = F.filter(links, lambda x: x["dst"].isNotNull())
    others = [c for c in pages.columns if c not in ("url", "html")]
    return pages.select(*others, F.col("url").alias("src"), F.inline(links))


def _host(root_host: str | None) -> Column:
    return urls.netloc(F.col("url")) if root_host is None else F.lit(root_host)


def _root(root: str | None) -> Column:
    return urls.site_root(F.col("url")) if root is None else F.lit(root)


def known_page_edges(
    pages: DataFrame, root_host: str | None = None, marks: list[str] = RESOURCE_MARKS
) -> DataFrame:
    """Links between stored pages as (src, dst, weight).

    Without ``root_host`` each page's own host is its root.
    """
    host = _host(root_host)
    found = page_links(
        pages.select("url", "html"), resolve=lambda href: urls.canonical_link(href, host, marks)
    )
    return edges_between(found.select("src", "dst"), pages.select("url"))


def edges_between(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Counted edges of ``found(src, dst)`` that end at a node.

    Repeats are counted before the join, so a link on every page is one row
    per page, and pages everyone links to are spread over tasks.
    """
    counted = (
        found.where(F.col("src") != F.col("dst"))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    known = nodes.select(F.col("url").alias("dst")).distinct()
    return spread_join(counted, known, ["dst"], "left_semi", spread_on=["src"]).select(
        "src", "dst", "weight"
    )


def graph_nodes(edges: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Every URL that is a page or a link target."""
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("url"))
    if pages is not None:
        nodes = nodes.union(pages.select("url"))
    return nodes.distinct()


def with_self_loops(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """A2: each edge once, and an edge from every page and every target to itself."""
    def edge(src: str, dst: str) -> Column:
        return F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))

    both = edges.select(
        F.inline(F.array(edge("src", "dst"), edge("src", "src"), edge("dst", "dst")))
    )
    return both.union(pages.select(F.col("url").alias("src"), F.col("url").alias("dst"))).distinct()


def crawl_edges_all(
    pages: DataFrame,
    root: str | None = None,
    robots: DataFrame | None = None,
    drop: list[str] = VOLATILE_PARAMETERS,
) -> DataFrame:
    """G4, every link counts: distinct (src, dst) over all discovered URLs, with self-loops."""
    pages = pages.select("url", "html", _root(root).alias("_root"))
    site = F.col("_root")

    def full(href: Column) -> Column:
        url = urls.drop_parameters(urls.absolute_link(href, site), drop)
        return tx.bind(url, lambda u: F.when(u.startswith(site), u))

    found = page_links(
        pages, anchors_only=True, accept=lambda href: urls.starts_at_root(href, site), resolve=full
    )
    found = found.select("src", "dst").distinct()
    if robots is not None:
        found = allowed_urls(found, robots, "dst")
    return with_self_loops(found, pages)


def crawl_edges_first(
    pages: DataFrame, order: str, root_host: str | None = None, marks: list[str] = RESOURCE_MARKS
) -> DataFrame:
    """G4, first discovery wins (W2): each URL has one edge, from the page that found it first.

    ``order`` is the column that says in which order the pages were read. The
    first page is the seed and is never discovered.
    """
    host = _host(root_host)
    found = page_links(
        pages.select(order, "url", "html"),
        resolve=lambda href: urls.canonical_link(href, host, marks),
    )
    first = (
        found.groupBy("dst")
        # partial minima, so a popular target is cheap
        .agg(F.min(F.struct(order, "pos", "src")).alias("_place"))
        .select(F.col("_place.src").alias("src"), "dst")
    )
    seed = pages.agg(F.min_by("url", order).alias("url")).scalar()
    return with_self_loops(first.where(F.col("dst") != seed), pages)


def out_degree(edges: DataFrame) -> DataFrame:
    """A3."""
    weight = F.col("weight") if "weight" in edges.columns else F.lit(1)
    return edges.groupBy("src").agg(F.sum(weight).cast("long").alias("out_degree"))


def outgoing_lists(edges: DataFrame, part_size: int | None = None) -> DataFrame:
    """A4: targets of each page as one sorted array, (src, targets).

    With a ``part_size`` the rows are (src, part, n_parts, targets): a page with
    more targets gets several arrays, split by a hash of the target, so no row
    or task grows with the largest page. The edges are then read more than once;
    store them first.
    """
    targets = F.sort_array(F.collect_list("dst")).alias("targets")
    if part_size is None:
        return edges.groupBy("src").agg(targets)
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
    n_parts = F.ceil(F.col("_n") / F.lit(part_size)).cast("int")
    large = degree.where(F.col("_n") > part_size).select("src", n_parts.alias("n_parts"))
    parts = spread_join(edges.select("src", "dst"), large, ["src"], "left", spread_on=["dst"])
    parts = parts.withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
    return (
        parts.withColumn("part", F.pmod(F.xxhash64("dst"), F.col("n_parts")).cast("int"))
        .groupBy("src", "part", "n_parts")
        .agg(targets)
    )


def edges_from_lists(lists: DataFrame) -> DataFrame:
    """A4 undone."""
    return lists.select("src", F.explode("targets").alias("dst"))


def matrix_edges(rows: DataFrame) -> DataFrame:
    """``rows(idx, cells)`` of a matrix to its non-zero cells (src, dst, weight)."""
    return rows.select(
        F.col("idx").alias("src"), F.posexplode("cells").alias("dst", "weight")
    ).where(F.col("weight") != 0)


def indexed_edges(edges: DataFrame, url_index: DataFrame) -> DataFrame:
    """Both ends of ``edges`` as numbers of ``url_index(url, idx)``."""
    size = measure(url_index)
    for end in ("src", "dst"):
        numbers = url_index.select(F.col("url").alias(end), F.col("idx").alias(f"_{end}"))
        other = "dst" if end == "src" else "_src"
        edges = spread_join(edges, numbers, [end], spread_on=[other], small_bytes=size).drop(end)
    return edges.select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight")


def robots_rules(robots: DataFrame, strict: bool = False) -> DataFrame:
    """``robots(root, body)`` to one row per forbidden prefix (root, prefix)."""
    prefixes = urls.robots_prefixes(F.col("body"), F.col("root"), strict)
    return robots.select("root", F.explode(prefixes).alias("prefix")).distinct()


def allowed_urls(
    found: DataFrame,
    robots: DataFrame,
    url: str = "url",
    ws: Workspace | None = None,
    rules_in_row: int = RULES_IN_ROW,
) -> DataFrame:
    """Rows of ``found`` whose URL no robots rule of its site forbids.

    Rules of several texts of one site all hold; rows without a URL stay. Sites of at
    most ``rules_in_row`` rules have them as one array, tried where the URL is. URLs of
    larger sites meet rules by equality: each gives its own prefixes of the lengths that
    rules of its site have, so the work grows with lengths, not with rules. Only then
    is ``found`` stored, in ``ws`` or a workspace of its own.
    """
    rules = robots_rules(robots).withColumnRenamed("root", "_root")
    keyed = found.withColumn("_root", urls.site_root(F.col(url)))
    lengths = (
        rules.groupBy("_root")
        .agg(F.count(F.lit(1)).alias("_n"), F.collect_set(F.length("prefix")).alias("_lengths"))
        .where(F.col("_n") > rules_in_row)
        .drop("_n")
    )
    if lengths.isEmpty():
        return _without_rules(keyed, rules, url).drop("_root")
    ws = ws or Workspace(found.sparkSession, "robots")
    few = rules.join(lengths, "_root", "left_anti")
    kept = ws.save(_without_rules(keyed, few, url), "kept")  # worked out once, read several times
    own = spread_join(kept.select("_root", url).distinct(), lengths, ["_root"], spread_on=[url])
    fitting = F.filter("_lengths", lambda n: n <= F.length(url))
    prefixes = own.select(
        "_root", url, F.explode(F.transform(fitting, lambda n: F.left(F.col(url), n))).alias("prefix")
    )
    hit = spread_join(prefixes, rules, ["_root", "prefix"], "left_semi", spread_on=[url])
    forbidden = ws.save(hit.select(url).distinct(), "forbidden")
    return spread_join(kept, forbidden, [url], "left_anti").drop("_root")


def _without_rules(keyed: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """Rows of ``keyed(_root, url, ...)`` that none of their site's rules, one array, forbids."""
    arrays = rules.groupBy("_root").agg(F.collect_list("prefix").alias("_rules"))
    joined = spread_join(keyed, arrays, ["_root"], "left", spread_on=[url])
    hit = F.exists("_rules", lambda rule: F.col(url).startswith(rule))
    return joined.where(~F.coalesce(hit, F.lit(False))).drop("_rules")


def frontier_next(edges: DataFrame, crawled: DataFrame, robots: DataFrame | None = None) -> DataFrame:
    """Discovered, allowed and not yet crawled URLs."""
    found = edges.select(F.col("dst").alias("url")).distinct()
    fresh = found.join(crawled.select("url").distinct(), "url", "left_anti")  # J7
    return fresh if robots is None else allowed_urls(fresh, robots)


def expand_frontier(
    edges: DataFrame, seeds: DataFrame, ws: Workspace, budget: int | None = None
) -> DataFrame:
    """URLs reached from ``seeds(url)``, breadth first: (url, idx, depth).

    ``edges(src, dst[, pos])``; ``idx`` is the place in reading order: by the
    page that found it first, then by position there, then by URL. With a
    ``budget`` only the first so many URLs are kept.

    Each level is sorted and stored, so the plan does not grow with depth, and counts
    once a row of the table ``levels`` names it. A workspace that holds levels already
    goes on after the last of them, over the edges it stored, whatever a crawl
    that was stopped left half-written; so a larger budget continues a smaller one.
    """
    spark = edges.sparkSession
    levels = _committed(spark, ws)
    if not levels:
        if "pos" not in edges.columns:
            edges = edges.withColumn("pos", F.lit(0))
        first = edges.groupBy("src", "dst").agg(F.min("pos").alias("pos")).where("src <> dst")
        ws.save(first, "edges")
        start = seeds.select("url").distinct().withColumn("_place", F.col("url"))
        levels.append(_store_level(start, ws, 0))
    stored = spark.read.parquet(ws.path("edges"))
    while levels[-1].n and (budget is None or sum(level.n for level in levels) < budget):
        depth = levels[-1].depth + 1
        done = _reached(spark, ws, depth - 1)
        parents = done.where(F.col("depth") == depth - 1).select(
            F.col("url").alias("src"), F.col("_mid").alias("_parent")
        )
        found = spread_join(
            stored, parents, ["src"], spread_on=["dst"], small_bytes=levels[-1].size
        )
        new = (
            found.groupBy(F.col("dst").alias("url"))
            .agg(F.min(F.struct("_parent", "pos")).alias("_place"))
            .join(done.select("url"), "url", "left_anti")
        )
        levels.append(_store_level(new, ws, depth))
    reached = _reached(spark, ws, levels[-1].depth)
    numbered = number_sorted(reached, "idx", "depth").select("url", "idx", "depth")
    return numbered if budget is None else numbered.where(F.col("idx") < budget)


def _committed(spark: SparkSession, ws: Workspace) -> list[Row]:
    """One row (depth, n, size) for each level that is stored as a whole, in order."""
    levels = read_if_present(spark, ws.path("levels"))
    return [] if levels is None else levels.distinct().orderBy("depth").collect()


def _reached(spark: SparkSession, ws: Workspace, depth: int) -> DataFrame:
    stored = spark.read.schema("url string, _mid long, depth int").parquet(ws.path("reached"))
    return stored.where(F.col("depth") <= depth)


def _store_level(level: DataFrame, ws: Workspace, depth: int) -> Row:
    """Store a level, replacing what an unfinished attempt left, then name it."""
    placed = with_place(level.orderBy("_place", "url")).select("url", "_mid")
    stored = ws.save(placed, f"reached/depth={depth}")
    sizes = stored.agg(
        F.lit(depth).alias("depth"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row_bytes(stored)), F.lit(0)).alias("size"),
    )
    row = sizes.first()
    named = level.sparkSession.range(1, numPartitions=1).select(
        F.lit(row.depth).alias("depth"), F.lit(row.n).cast("long").alias("n"), F.lit(row.size).cast("long").alias("size")
    )
    named.write.mode("append").parquet(ws.path("levels"))
    return row
