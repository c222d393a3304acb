"""URL keys, link canonical forms and robots rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.text import bind
from pagequarry.functions.fixed import RESOURCE_MARKS, ROBOTS_EXTRA_PATH, VOLATILE_PARAMETERS

PARTS = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)


def encode_key(url: Column) -> Column:
    """URL-safe base64 of the URL, without the line breaks base64() adds."""
    raw = F.regexp_replace(F.base64(F.encode(url, "UTF-8")), r"[\r\n]", "")
    return F.translate(raw, "+/", "-_")


def decode_key(key: Column) -> Column:
    """S3: the URL behind a key, NULL if the key is broken."""
    raw = F.try_to_binary(F.translate(key, "-_", "+/"), F.lit("base64"))
    return F.try_validate_utf8(raw.cast("string"))


def _parts(url: Column) -> dict[str, Column]:
    """Scheme, netloc, path, query and fragment, split the generic way."""
    url = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    names = ("scheme", "netloc", "path", "query", "fragment")
    return {name: F.regexp_extract(url, PARTS, i + 1) for i, name in enumerate(names)}


def netloc(url: Column) -> Column:
    return _parts(url)["netloc"]


def site_root(url: Column) -> Column:
    """``scheme://netloc`` of an absolute URL."""
    parts = _parts(url)
    return F.concat(F.lower(parts["scheme"]), F.lit("://"), parts["netloc"])


def is_resource(link: Column, marks: list[str] = RESOURCE_MARKS) -> Column:
    """F3."""
    found = F.lit(False)
    for mark in marks:
        found = found | link.contains(mark)
    return found


def is_same_host(link: Column, root_host: str | Column) -> Column:
    """no host, or exactly the root host with its port."""
    return netloc(link).isin("", root_host)


def starts_at_root(link: Column, root: str | Column) -> Column:
    """root-relative, or below the root URL."""
    return link.startswith("/") | link.startswith(root)


def canonical_link(
    link: Column, root_host: str | Column, marks: list[str] = RESOURCE_MARKS
) -> Column:
    """T10 with F3 and F4: the page a link means, NULL if it is not a page of this host."""
    host = F.lit(root_host) if isinstance(root_host, str) else root_host
    parts = _parts(link)

    def rebuilt(split: Column) -> Column:
        # an empty ';' parameter of the last segment is dropped, others stay in the path
        path = F.regexp_replace(split["path"], r"(^|/)([^/;]*);$", "$1$2")
        slash = F.when((path == "") | path.startswith("/"), F.lit("")).otherwise(F.lit("/"))
        whole = F.regexp_replace(F.concat(F.lit("https://"), host, slash, path), "/+$", "")
        return F.when(split["netloc"].isin("", host), whole)

    split = F.struct(parts["netloc"].alias("netloc"), parts["path"].alias("path"))
    return F.when(~is_resource(link, marks), bind(split, rebuilt))


def absolute_link(href: Column, root: str | Column) -> Column:
    """T12."""
    root = F.lit(root) if isinstance(root, str) else root
    return F.when(href.startswith("/"), F.concat(root, href)).otherwise(href)


def _form_decode(text: Column) -> Column:
    # a percent sign that starts no escape stands for itself
    return F.url_decode(F.regexp_replace(text, "%(?![0-9a-fA-F]{2})", "%25"))


def _form_encode(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def drop_parameters(url: Column, drop: list[str] = VOLATILE_PARAMETERS) -> Column:
    """Remove query parameters by name and write the others again.

    Blank values go, equal names are grouped at their first place, and the
    fragment is kept.
    """

    def pairs_of(query: Column) -> Column:
        pairs = F.transform(
            F.split(query, "&"),
            lambda item: F.struct(
                _form_decode(F.substring_index(item, "=", 1)).alias("name"),
                _form_decode(F.regexp_extract(item, "(?s)^[^=]*=(.*)$", 1)).alias("value"),
            ),
        )
        return F.filter(pairs, lambda pair: (pair["value"] != "") & ~pair["name"].isin(drop))

    def grouped(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda pair: pair["name"]))
        return F.flatten(
            F.transform(names, lambda name: F.filter(pairs, lambda pair: pair["name"] == name))
        )

    def written(pair: Column) -> Column:
        return F.concat(_form_encode(pair["name"]), F.lit("="), _form_encode(pair["value"]))

    def joined(split: Column) -> Column:
        query = F.array_join(F.transform(bind(pairs_of(split["query"]), grouped), written), "&")
        return F.concat(
            F.lower(split["scheme"]),
            F.when(split["scheme"] == "", F.lit("")).otherwise(F.lit(":")),
            F.when(split["netloc"] == "", F.lit("")).otherwise(F.lit("//")),
            split["netloc"],
            split["path"],
            bind(query, lambda q: F.when(q == "", q).otherwise(F.concat(F.lit("?"), q))),
            F.when(split["fragment"] == "", F.lit("")).otherwise(F.lit("#")),
            split["fragment"],
        )

    return bind(F.struct(*[part.alias(name) for name, part in _parts(url).items()]), joined)


def flat_file_name(url: Column) -> Column:
    """Lossy, since '/' and '_' become one."""
    return F.concat(F.replace(url, F.lit("/"), F.lit("_")), F.lit(".html"))


def source_key(source: Column) -> Column:
    """Page key behind a text file's path."""
    return F.regexp_extract(source, r"([^/\\]+?)(\.txt)?$", 1)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def robots_prefixes(body: Column, root: str | Column, strict: bool = False) -> Column:
    """Forbidden URL prefixes of one robots text, as an array.

    The array is made inside the row that holds the text, so its size is that
    of the text. An empty ``Disallow:`` forbids nothing; ``strict`` keeps it as
    a rule that forbids the whole site.
    """
    root = F.lit(root) if isinstance(root, str) else root
    breaks = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
    lines = F.transform(F.split(body, breaks), _strip)
    paths = F.transform(
        F.filter(lines, lambda line: line.startswith("Disallow:")),
        lambda line: F.regexp_replace(_strip(F.substr(line, F.lit(10))), r"\*$", ""),
    )
    if not strict:
        paths = F.filter(paths, lambda path: path != "")
    paths = F.concat(F.array(F.lit(ROBOTS_EXTRA_PATH)), paths)
    return F.transform(paths, lambda path: F.concat(root, path))
