"""URL functions: each rule as a table of inputs and the result it must have."""

import base64

import pytest
from pyspark.sql import functions as F

from pagequarry.functions import urls
from pagequarry.functions.fixed import RESOURCE_MARKS, RESOURCE_MARKS_CMS
from tests.test_text import apply

HOST = "wiki.example"
SITE = f"https://{HOST}"

# link on a page of HOST, and the page it means
LINKS = [
    # nothing but a fragment or a query is the site itself
    ("#top", SITE),
    ("", SITE),
    ("?q", SITE),
    ("/", SITE),
    # paths are taken below the root, and slashes at the end go
    ("x", f"{SITE}/x"),
    ("a/b", f"{SITE}/a/b"),
    ("/p/", f"{SITE}/p"),
    ("/p//", f"{SITE}/p"),
    ("///three", f"{SITE}/three"),
    ("/p?q=1#f", f"{SITE}/p"),
    ("/für", f"{SITE}/für"),
    # commas and spaces stay, space before a link and control characters go
    ("/the,", f"{SITE}/the,"),
    ("/a b", f"{SITE}/a b"),
    ("  /lead", f"{SITE}/lead"),
    ("/t\tab\n", f"{SITE}/tab"),
    # only an empty parameter at the very end goes
    ("/p;v=1", f"{SITE}/p;v=1"),
    ("/p;", f"{SITE}/p"),
    ("/a;b;", f"{SITE}/a;b;"),
    ("/a;/b;", f"{SITE}/a;/b"),
    # the host must be the same to the letter, with its port
    (f"//{HOST}/x", f"{SITE}/x"),
    (f"{SITE}/x", f"{SITE}/x"),
    ("//other/x", None),
    (f"http://{HOST}:80/x", None),
    ("https://WIKI.example/x", None),
    # a scheme without a host is replaced, and is one only if it begins with a letter
    ("mailto:a@b", f"{SITE}/a@b"),
    ("javascript:void(0)", f"{SITE}/void(0)"),
    ("http:/odd", f"{SITE}/odd"),
    ("1x:foo", f"{SITE}/1x:foo"),
]
RESOURCES = ["/w/x", "/mw/x", "/wiki/Special:Y", f"{SITE}/w/load.php"]
CMS_RESOURCES = ["../x", "./x", "/common/x.css", "/commonspot/y", f"{SITE}/common/z"]


@pytest.mark.parametrize("marks", [RESOURCE_MARKS, RESOURCE_MARKS_CMS])
def test_canonical_links(spark, marks):
    links, pages = zip(*LINKS)
    assert apply(spark, lambda c: urls.canonical_link(c, HOST, marks), links) == list(pages)


def test_resources_are_no_pages(spark):
    for marks, none, some in ((RESOURCE_MARKS, RESOURCES, CMS_RESOURCES), (RESOURCE_MARKS_CMS, CMS_RESOURCES, RESOURCES)):
        assert not any(apply(spark, lambda c: urls.canonical_link(c, HOST, marks), none))
        assert all(apply(spark, lambda c: urls.canonical_link(c, HOST, marks), some))


# URL, and the URL without volatile parameters
PARAMETERS = [
    ("https://w.example/p?a=1&mobileaction=x&b=2&a=3#f", "https://w.example/p?a=1&a=3&b=2#f"),
    ("https://w.example/p?returnto=x", "https://w.example/p"),
    ("https://w.example/p??title=x&y=1", "https://w.example/p?y=1"),
    ("/p?a=&b&c=%20d+e&d=%zz&f=%C3%A9*~-_.", "/p?c=+d+e&d=%25zz&f=%C3%A9%2A~-_."),
    ("/p?=x&k=v=w", "/p?=x&k=v%3Dw"),
    ("/p;x?redlink=1&q=a%26b", "/p;x?q=a%26b"),
    ("/p", "/p"),
    ("HTTP://w.example", "http://w.example"),
    ("", ""),
]


def test_parameter_removal(spark):
    before, after = zip(*PARAMETERS)
    assert apply(spark, urls.drop_parameters, before) == list(after)


def test_keys(spark):
    values = ["https://w.example/" + "x" * n for n in (0, 1, 2, 40, 57, 58, 200)] + ["https://w.example/é?~ü>"]
    keys = apply(spark, urls.encode_key, values)
    assert keys == [base64.urlsafe_b64encode(v.encode()).decode() for v in values]
    assert apply(spark, urls.decode_key, keys) == values
    assert apply(spark, urls.decode_key, ["%%", "__79", "a"]) == [None, None, None]


def test_source_keys(spark):
    got = apply(spark, urls.source_key, ["data\\sites\\abc=.txt", "/x/y/xt.txt", "plain", "d/tx.t.txt"])
    assert got == ["abc=", "xt", "plain", "tx.t"]


def test_small_url_functions(spark):
    assert apply(spark, urls.flat_file_name, ["https://a/b_c"]) == ["https:__a_b_c.html"]
    assert apply(spark, lambda c: urls.absolute_link(c, "https://r"), ["/a", "b"]) == ["https://r/a", "b"]
    assert apply(spark, lambda c: urls.starts_at_root(c, "https://r"), ["/a", "https://r/x", "x"]) == [True, True, False]
    assert apply(spark, urls.site_root, ["HTTPS://a.b:8/x?y"]) == ["https://a.b:8"]


ROBOTS = "# all\nUser-agent: *\n Disallow: /a* \r\nDisallow: /b**\nDisallow:\nAllow: /c\nUser-agent: x\nDisallow: /d:e\ndisallow: /f"


def test_robots(spark):
    extra = "https://r/wiki/?title=Special:"
    got = apply(spark, lambda c: urls.robots_prefixes(c, "https://r"), [ROBOTS])[0]
    assert got == [extra, "https://r/a", "https://r/b*", "https://r/d:e"]
    strict = apply(spark, lambda c: urls.robots_prefixes(c, "https://r", strict=True), [ROBOTS])[0]
    assert strict == [extra, "https://r/a", "https://r/b*", "https://r", "https://r/d:e"]
