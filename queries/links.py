"""Links, graphs, robots rules, frontiers and PageRank."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagequarry.functions import urls
from pagequarry.functions.fixed import RESOURCE_MARKS, RESOURCE_MARKS_CMS, ROBOTS_EXTRA_PATH
from pagequarry.operators import links as ln
from pagequarry.operators.pagerank import pagerank
from pagequarry.operators.spread import dense_ids
from pagequarry.session import Workspace
from queries import sql
from queries.inputs import (
    WIKI_HOST,
    nation_links,
    nation_nodes,
    site_robots,
    stored_once,
    table,
    wiki_pages,
)

DROPPED = ["ref", "utm_source"]
# Targets beyond which a page has several lists.
LIST_TARGETS = 10_000


def links_all(spark, sf_dir):
    return ln.page_links(table(spark, sf_dir, "pages").select("url", "html"))


def links_anchor(spark, sf_dir):
    pages = wiki_pages(spark, sf_dir).select("url", "html")
    return ln.page_links(pages, anchors_only=True, accept=lambda href: href.startswith("/p/"))


def _link_forms(spark, sf_dir):
    """Each page's URL and its links, each in several spellings."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    found = ln.page_links(pages).select("src", "href")
    own = pages.select(
        F.col("url").alias("src"),
        F.explode(
            F.array(
                "url",
                F.concat("url", F.lit("/w/x")),
                F.concat(F.lit("//"), urls.netloc(F.col("url")), F.lit("/a/../b;v=1;/")),
                F.concat(F.lit("mailto:"), "url"),
                F.concat(F.lit("./"), "url"),
            )
        ).alias("href"),
    )
    return found.union(own).distinct()


def canonical_links(spark, sf_dir):
    link = urls.canonical_link(F.col("href"), urls.netloc(F.col("src")), RESOURCE_MARKS)
    return _link_forms(spark, sf_dir).select("src", "href", link.alias("link"))


def same_host_links(spark, sf_dir):
    href, src = F.col("href"), F.col("src")
    return _link_forms(spark, sf_dir).select(
        "src",
        "href",
        urls.is_resource(href, RESOURCE_MARKS_CMS).alias("is_resource"),
        urls.is_same_host(href, urls.netloc(src)).alias("same_host"),
        urls.starts_at_root(href, urls.site_root(src)).alias("at_root"),
    )


def normalized_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.drop_parameters(F.col("url"), DROPPED).alias("url")
    )


def flat_file_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.flat_file_name(F.col("url")).alias("file_name")
    )


def robots_rules(spark, sf_dir):
    return ln.robots_rules(site_robots(spark, sf_dir))


def robots_allowed(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return ln.allowed_urls(pages, site_robots(spark, sf_dir)).select("page_id", "url")


def _path_rules(spark, sf_dir):
    """robots(root, body): each site forbids, besides its usual rules, each of its French pages."""
    pages = table(spark, sf_dir, "pages").withColumn("root", urls.site_root(F.col("url")))
    paths = F.collect_list(F.substr("url", F.length("root") + 1))
    return (
        pages.where("url LIKE '%/fr/%'")
        .groupBy("root")
        .agg(F.concat(F.lit("Disallow: "), F.array_join(paths, "\nDisallow: ")).alias("body"))
        .unionByName(site_robots(spark, sf_dir))
    )


def robots_allowed_many(spark, sf_dir):
    """Sites with a rule for each French page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return ln.allowed_urls(pages, _path_rules(spark, sf_dir), rules_in_row=5)


def known_page_edges(spark, sf_dir):
    return ln.known_page_edges(wiki_pages(spark, sf_dir), WIKI_HOST)


def nation_edges(spark, sf_dir):
    return ln.edges_between(nation_links(spark, sf_dir), nation_nodes(spark, sf_dir))


def url_index(spark, sf_dir):
    pages = wiki_pages(spark, sf_dir).select("url")
    return dense_ids(pages, ["url"], Workspace(spark, "ids"))


def indexed_edges(spark, sf_dir):
    return ln.indexed_edges(known_page_edges(spark, sf_dir), url_index(spark, sf_dir))


def matrix_edges(spark, sf_dir):
    cells = F.transform("embedding", lambda x: F.when(x > 0.2, 1).otherwise(0))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), cells.alias("cells"))
    return ln.matrix_edges(rows)


def crawl_edges_all(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url", "html")
    return ln.crawl_edges_all(pages, robots=site_robots(spark, sf_dir), drop=DROPPED)


def crawl_edges_first(spark, sf_dir):
    return ln.crawl_edges_first(table(spark, sf_dir, "pages"), "page_id")


def _stored_crawl(spark, sf_dir):
    """The crawl graph, built once per session as a crawl would have left it."""
    path = stored_once(
        spark, sf_dir, "crawl_edges", lambda p: crawl_edges_all(spark, sf_dir).write.parquet(p)
    )
    return spark.read.parquet(path)


def outgoing_lists(spark, sf_dir):
    lists = ln.outgoing_lists(_stored_crawl(spark, sf_dir), part_size=LIST_TARGETS)
    return lists.select("src", "part", "n_parts", F.array_join("targets", " ").alias("targets"))


def out_degree(spark, sf_dir):
    return ln.out_degree(known_page_edges(spark, sf_dir))


def frontier_next(spark, sf_dir):
    return ln.frontier_next(
        _stored_crawl(spark, sf_dir), table(spark, sf_dir, "pages"), site_robots(spark, sf_dir)
    )


def _wiki_seed(spark, sf_dir):
    return wiki_pages(spark, sf_dir).agg(F.min_by("url", "page_id").alias("url"))


def _wiki_links(spark, sf_dir):
    pages = wiki_pages(spark, sf_dir)
    links = ln.page_links(
        pages.select("url", "html"), resolve=lambda href: urls.canonical_link(href, WIKI_HOST)
    )
    return links.join(pages.select(F.col("url").alias("dst")), "dst", "left_semi")


def frontier_depth(spark, sf_dir):
    """Reading order over the wiki pages from the first one."""
    ws = Workspace(spark, "frontier")
    return ln.expand_frontier(_wiki_links(spark, sf_dir), _wiki_seed(spark, sf_dir), ws)


def frontier_resumed(spark, sf_dir):
    """The same order, by a crawl that stops at half of the pages and goes on from its state."""
    ws = Workspace(spark, "frontier")
    half = table(spark, sf_dir, "pages").count() // 2
    edges, seed = _wiki_links(spark, sf_dir), _wiki_seed(spark, sf_dir)
    ln.expand_frontier(edges, seed, ws, budget=half)
    return ln.expand_frontier(edges, seed, ws)


def pagerank_nation(spark, sf_dir):
    ranks = pagerank(nation_edges(spark, sf_dir), Workspace(spark, "ranks"))
    return ranks.select("url", F.round("rank", 6).alias("rank"))


def pagerank_wiki(spark, sf_dir):
    pages = wiki_pages(spark, sf_dir)
    edges = ln.known_page_edges(pages, WIKI_HOST)
    ranks = pagerank(edges, Workspace(spark, "ranks"), nodes=pages.select("url"))
    return ranks.select("url", F.round("rank", 9).alias("rank"))


def pagerank_crawl_one_round(spark, sf_dir):
    edges = crawl_edges_first(spark, sf_dir).where("src <> dst").withColumn("weight", F.lit(1))
    pages = table(spark, sf_dir, "pages").select("url")
    ranks = pagerank(edges, Workspace(spark, "ranks"), nodes=pages, rounds=1)
    return ranks.select("url", F.round("rank", 9).alias("rank"))


QUERIES = {
    "links_all": links_all,
    "links_anchor": links_anchor,
    "canonical_links": canonical_links,
    "same_host_links": same_host_links,
    "normalized_urls": normalized_urls,
    "flat_file_names": flat_file_names,
    "robots_rules": robots_rules,
    "robots_allowed": robots_allowed,
    "robots_allowed_many": robots_allowed_many,
    "known_page_edges": known_page_edges,
    "nation_edges": nation_edges,
    "url_index": url_index,
    "indexed_edges": indexed_edges,
    "matrix_edges": matrix_edges,
    "crawl_edges_all": crawl_edges_all,
    "crawl_edges_first": crawl_edges_first,
    "outgoing_lists": outgoing_lists,
    "out_degree": out_degree,
    "frontier_next": frontier_next,
    "frontier_depth": frontier_depth,
    "frontier_resumed": frontier_resumed,
    "pagerank_nation": pagerank_nation,
    "pagerank_wiki": pagerank_wiki,
    "pagerank_crawl_one_round": pagerank_crawl_one_round,
}


def _hrefs(html: str, tag: str) -> str:
    pattern = rf"""(?is)<{tag}[^>]*?\shref="([^"]*)\""""
    return f"regexp_extract_all({html}, {sql.quoted(pattern)}, 1)"


def _visible(html: str) -> str:
    for pattern in (
        r"(?is)<!--.*?-->",
        r"(?is)<script\b[^>]*>.*?</script\s*>",
        r"(?is)<style\b[^>]*>.*?</style\s*>",
    ):
        html = f"regexp_replace({html}, {sql.quoted(pattern)}, '', 'g')"
    return html


def _found(pages: str, tag: str) -> str:
    """(src, pos, href) of pages(url, html)."""
    hrefs = _hrefs(_visible("html"), tag)
    return f"""
SELECT url AS src, unnest(range(len(h)))::INT AS pos, replace(unnest(h), '&amp;', '&') AS href
FROM (SELECT url, {hrefs} AS h FROM {pages})"""


_WIKI_HTML = """
wiki_html AS (
  SELECT page_id, 'https://wiki.example/p/' || page_id AS url, html
    || '<a href="/p/' || (page_id * 2 + 1) || '">x</a><a href="/p/' || (page_id * 2 + 2) || '/">x</a>'
    || '<a href="/p/' || (page_id // 3) || '#top">x</a>'
    || '<a href="http://wiki.example/p/' || (page_id // 3) || '?a=1&amp;b=2">x</a>'
    || '<a href="/w/p/' || page_id || '">x</a><a href="https://other.example/p/' || page_id || '">x</a>' AS html
  FROM pages)"""
_HOST = "regexp_extract({}, '^[a-z]+://([^/?#]*)', 1)"
_ROOT = "regexp_extract({}, '^[a-z]+://[^/?#]*')"
_FORMS = f"""
found AS ({_found('pages', '[a-z]')}),
forms AS (
  SELECT src, href FROM found UNION
  SELECT url, unnest([url, url || '/w/x', '//' || {_HOST.format('url')} || '/a/../b;v=1;/',
    'mailto:' || url, './' || url]) FROM pages),
parsed AS (
  SELECT src, href, {_HOST.format('src')} AS own, {_ROOT.format('src')} AS root,
    regexp_extract(href, '^(?:[a-z]+:)?(?://([^/?#]*))?', 1) AS host,
    regexp_replace(regexp_replace(href, '[?#].*$', ''), '^(?:[a-z]+:)?(?://[^/]*)?', '') AS path
  FROM forms)"""
_ROBOTS = f"""
sites AS (
  SELECT {_ROOT.format('url')} AS root, min(url) AS low, max(url) AS high FROM pages GROUP BY 1),
rules AS (
  SELECT DISTINCT root, unnest([root || {sql.quoted(ROBOTS_EXTRA_PATH)}, low, high]) AS prefix FROM sites)"""
_NORMAL = """
CASE WHEN instr({u}, '?') = 0 THEN {u}
ELSE split_part({u}, '?', 1) || CASE WHEN kept = '' THEN '' ELSE '?' || kept END END"""
_KEPT = """
array_to_string(list_filter(string_split(split_part({u}, '?', 2), '&'),
  lambda p: NOT (p LIKE 'ref=%' OR p LIKE 'utm_source=%')), '&')"""
_CRAWL_ALL = f"""
{_ROBOTS},
anchors AS ({_found('pages', r'a')}),
full_links AS (
  SELECT DISTINCT src, {_ROOT.format('src')} || href AS dst FROM anchors WHERE href LIKE '/%'),
open_links AS (
  SELECT src, dst FROM full_links f
  WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.root = {_ROOT.format('f.src')} AND starts_with(f.dst, r.prefix))),
crawl_all AS (
  SELECT src, dst FROM open_links UNION SELECT src, src FROM open_links
  UNION SELECT dst, dst FROM open_links UNION SELECT url, url FROM pages)"""
_CRAWL_FIRST = f"""
found AS ({_found('pages', '[a-z]')}),
canon AS (
  SELECT page_id, pos, src,
    regexp_replace('https://' || {_HOST.format('src')} || regexp_replace(href, '[?#].*$', ''), '/+$', '') AS dst
  FROM found JOIN pages ON url = src
  WHERE href LIKE '/%' AND href NOT LIKE '%/w/%' AND href NOT LIKE '%/mw/%' AND href NOT LIKE '%/wiki/Special:%'),
first AS (
  SELECT arg_min(src, (page_id, pos)) AS src, dst FROM canon GROUP BY dst),
discovered AS (
  SELECT * FROM first WHERE dst <> (SELECT arg_min(url, page_id) FROM pages)),
crawl_first AS (
  SELECT src, dst FROM discovered UNION SELECT src, src FROM discovered
  UNION SELECT dst, dst FROM discovered UNION SELECT url, url FROM pages)"""

ORACLES = {
    "links_all": _found("pages", "[a-z]"),
    "links_anchor": f"WITH {_WIKI_HTML} SELECT * FROM ({_found('wiki_html', 'a')}) WHERE href LIKE '/p/%'",
    "canonical_links": f"""
WITH {_FORMS}
SELECT src, href, CASE
    WHEN href LIKE '%/w/%' OR href LIKE '%/mw/%' OR href LIKE '%/wiki/Special:%' THEN NULL
    WHEN host <> '' AND host <> own THEN NULL
    ELSE regexp_replace('https://' || own || CASE WHEN path = '' OR path LIKE '/%' THEN path ELSE '/' || path END, '/+$', '')
  END AS link
FROM parsed""",
    "same_host_links": f"""
WITH {_FORMS}
SELECT src, href, href LIKE '%/common/%' OR href LIKE '%/commonspot/%' OR href LIKE '%./%' AS is_resource,
  host = '' OR host = own AS same_host, href LIKE '/%' OR starts_with(href, root) AS at_root
FROM parsed""",
    "normalized_urls": f"""
SELECT page_id, {_NORMAL.format(u='url')} AS url FROM (SELECT *, {_KEPT.format(u='url')} AS kept FROM pages)""",
    "flat_file_names": "SELECT page_id, replace(url, '/', '_') || '.html' AS file_name FROM pages",
    "robots_rules": f"WITH {_ROBOTS} SELECT root, prefix FROM rules",
    "robots_allowed": f"""
WITH {_ROBOTS}
SELECT page_id, url FROM pages
WHERE NOT EXISTS (SELECT 1 FROM rules WHERE root = {_ROOT.format('url')} AND starts_with(url, prefix))""",
    "robots_allowed_many": f"""
WITH {_ROBOTS},
all_rules AS (
  SELECT root, prefix FROM rules UNION SELECT {_ROOT.format('url')}, url FROM pages WHERE url LIKE '%/fr/%')
SELECT page_id, url FROM pages
WHERE NOT EXISTS (SELECT 1 FROM all_rules WHERE root = {_ROOT.format('url')} AND starts_with(url, prefix))""",
    "known_page_edges": f"WITH {sql.WIKI_EDGES} SELECT src, dst, weight FROM wiki_edges",
    "nation_edges": f"WITH {sql.NATION_EDGES} SELECT src, dst, weight FROM nation_edges",
    "url_index": f"WITH {sql.WIKI} SELECT url, row_number() OVER (ORDER BY url) - 1 AS idx FROM wiki",
    "indexed_edges": f"""
WITH {sql.WIKI_EDGES}, ids AS (SELECT url, row_number() OVER (ORDER BY url) - 1 AS idx FROM wiki)
SELECT s.idx AS src, d.idx AS dst, weight
FROM wiki_edges JOIN ids s ON s.url = src JOIN ids d ON d.url = dst""",
    "matrix_edges": """
SELECT vec_id AS src, (i - 1)::INT AS dst, 1 AS weight
FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM embeddings)
WHERE x::DOUBLE > 0.2""",
    "crawl_edges_all": f"WITH {_CRAWL_ALL} SELECT src, dst FROM crawl_all",
    "crawl_edges_first": f"WITH {_CRAWL_FIRST} SELECT src, dst FROM crawl_first",
    "outgoing_lists": f"""
WITH {_CRAWL_ALL}
SELECT src, 0 AS part, 1 AS n_parts, string_agg(dst, ' ' ORDER BY dst) AS targets FROM crawl_all GROUP BY src""",
    "out_degree": f"WITH {sql.WIKI_EDGES} SELECT src, sum(weight)::BIGINT AS out_degree FROM wiki_edges GROUP BY src",
    "frontier_next": f"""
WITH {_CRAWL_ALL}
SELECT DISTINCT dst AS url FROM crawl_all
WHERE dst NOT IN (SELECT url FROM pages)
  AND NOT EXISTS (SELECT 1 FROM rules WHERE root = {_ROOT.format('dst')} AND starts_with(dst, prefix))""",
    "frontier_depth": """
WITH RECURSIVE tree AS (
  -- page p is first found by page (p - 1) // 2, its left child before its right
  SELECT page_id, 0 AS depth FROM pages WHERE page_id = 0
  UNION ALL
  SELECT p.page_id, depth + 1 FROM tree t JOIN pages p ON p.page_id IN (t.page_id * 2 + 1, t.page_id * 2 + 2))
SELECT 'https://wiki.example/p/' || page_id AS url, row_number() OVER (ORDER BY depth, page_id) - 1 AS idx, depth
FROM tree""",
    "pagerank_nation": f"""
WITH {sql.NATION_EDGES}, nodes AS (SELECT src AS url FROM nation_edges UNION SELECT dst FROM nation_edges),
{sql.pagerank('nation_edges', 20)}
SELECT url, round(rank, 6) AS rank FROM r20""",
    "pagerank_wiki": f"""
WITH {sql.WIKI_EDGES}, nodes AS (SELECT url FROM wiki),
{sql.pagerank('wiki_edges', 20)}
SELECT url, round(rank, 9) AS rank FROM r20""",
    "pagerank_crawl_one_round": f"""
WITH {_CRAWL_FIRST}, nodes AS (SELECT DISTINCT src AS url FROM crawl_first),
steps AS (SELECT src, dst, 1 AS weight FROM crawl_first WHERE src <> dst),
{sql.pagerank('steps', 1)}
SELECT url, round(rank, 9) AS rank FROM r1""",
}
ORACLES["frontier_resumed"] = ORACLES["frontier_depth"]
