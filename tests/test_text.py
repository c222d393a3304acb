"""Text functions against literal results, and an HTML parser."""

from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pagequarry.functions import text as tx
from pagequarry.functions.fixed import INDEX_STOP_WORDS, STOP_WORDS
from pagequarry.operators.links import page_links


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[0] for row in df.orderBy("i").select(fn(F.col("v"))).collect()]


class TextOf(HTMLParser):
    """Visible text with a line break for every piece of markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "template"):
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if self.hidden and self.hidden[-1] == tag:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def model_words(page):
    parser = TextOf()
    parser.feed(page)
    parser.close()
    return "\n".join(parser.parts).split()


def test_visible_text_equals_a_html_parser_on_all_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    rows = pq.read_table(path, columns=["page_id", "html"]).to_pylist()
    got = {
        r.page_id: r.text
        for r in spark.read.parquet(path).select("page_id", tx.html_text(F.col("html")).alias("text")).collect()
    }
    for row in rows:
        assert got[row["page_id"]].split() == model_words(row["html"])


@pytest.mark.parametrize(
    "page, words",
    [
        ("<p title='a > b'>one<br/>two</p>", ["one", "two"]),
        ('<SCRIPT type="x">if (a < b) "</p>"</SCRIPT >after', ["after"]),
        ("<!-- <p>no</p> -->yes<!doctype html>", ["yes"]),
        ("a < b and c > d", ["a", "<", "b", "and", "c", ">", "d"]),
        ("<script-note>kept</script-note>tail<style-guide x=1>too", ["kept", "tail", "too"]),
        ("<style>p{}</style><template><b>x</b></template>z", ["z"]),
        ("open <script>never closed", ["open"]),
        ("&lt;b&gt; &amp;lt; &#65;&#x42; &eacute;", ["<b>", "&lt;", "AB", "é"]),
        ("", []),
    ],
)
def test_markup_cases(spark, page, words):
    assert apply(spark, tx.html_text, [page])[0].split() == words


# text, what it shows, and what it is as the value of an attribute, if that differs
REFERENCES = [
    ("&amp;amp;", "&amp;", None),
    ("x&y", "x&y", None),
    ("&copy;&middot;", "©·", None),
    ("&bogus; &;", "&bogus; &;", None),
    ("a&nbsp;b", "a\xa0b", None),
    ("&#128512;", "😀", None),
    ("&#xD800;", "�", None),
    ("&", "&", None),
    ("&#128;&#x93;&#129;", "€“\x81", None),
    ("&#0065;&#99999999999;", "A�", None),
    ("&hellip;&NotEqualTilde;", "…≂̸", None),
    ("&dagger", "&dagger", None),
    ("/p?x=1&lang=en&part=2&sub=3", "/p?x=1&lang=en&part=2&sub=3", None),
    ("/p?x=1&copy=2", "/p?x=1©=2", "/p?x=1&copy=2"),
    ("&copy2020", "©2020", "&copy2020"),
    ("&notit;", "¬it;", "&notit;"),
    ("&AMP;&AMPx &lt", "&&x <", "&&AMPx <"),
]


def test_references(spark):
    values, shown, attribute = zip(*REFERENCES)
    assert apply(spark, tx.unescape, values) == list(shown)
    got = apply(spark, lambda c: tx.unescape(c, attribute=True), values)
    assert got == [t if a is None else a for t, a in zip(shown, attribute)]


def test_links_keep_parameters_that_look_like_references(spark):
    html = '<a href="/p?x=1&lang=en&copy=2&amp;b=&lt;">x</a><a href=/q&sub=3>y</a>'
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    assert [r["href"] for r in page_links(pages).orderBy("pos").collect()] == ["/p?x=1&lang=en&copy=2&b=<", "/q&sub=3"]


def test_long_markup_does_not_overflow_the_stack(spark):
    page = "<p " + "a='1' " * 20000 + ">x</p>" + "<!--" + "y" * 200000 + "-->" + "&amp;" * 20000
    assert apply(spark, tx.html_text, [page])[0].split() == ["x", "&" * 20000]


SAMPLES = [
    "Hello, World! it's_a (test)  of\ttext\n",
    "für Élan\xa0naïve — ÜBER",
    " a b\x1cc\x85d ",
    "",
    "   ",
    "...!!!",
    "one",
]


def test_search_cleaning(spark):
    got = apply(spark, lambda c: F.lower(tx.squeeze(tx.drop_punctuation(c))), SAMPLES)
    assert got == ["hello world itsa test of text", "für élan naïve — über", "a b c d", "", "", "", "one"]


def test_plain_words(spark):
    assert apply(spark, tx.plain_words, SAMPLES) == [
        ["hello", "world", "itsa", "test", "of", "text"],
        ["für", "élan", "naïve", "—", "über"],
        ["a", "b", "c", "d"],
        [],
        [],
        [],
        ["one"],
    ]


def numbered(first, last):
    return " ".join(f"w{k}" for k in range(first, last + 1))


def test_answer_cleaning(spark):
    texts = SAMPLES + [numbered(1, n) for n in (1, 19, 20, 21, 40, 45)]
    assert apply(spark, lambda c: tx.reflow(tx.ascii_words(c)), texts) == [
        "Hello World itsa test of text",
        "fr lan nave BER",
        "a b c d",
        "",
        "",
        "",
        "one",
        "w1",
        numbered(1, 19),
        numbered(1, 20),
        numbered(1, 20) + "\nw21",
        numbered(1, 20) + "\n" + numbered(21, 40),
        numbered(1, 20) + "\n" + numbered(21, 40) + "\n" + numbered(41, 45),
    ]


def test_length_filter_is_strict(spark):
    assert apply(spark, tx.long_enough, ["x" * 1500, "x" * 1501]) == [False, True]


def test_query_normalization(spark):
    got = apply(spark, tx.normalize_query, ["The WHAT of it?!", "Garden's magic, magic", "", "?!"])
    assert got == ["", "gardens magic magic", "", ""]
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 127
    assert len(INDEX_STOP_WORDS) == len(set(INDEX_STOP_WORDS)) == 34


def test_index_terms(spark):
    got = apply(spark, tx.index_terms, ["The snake_case of Éa x 42 a1", "is it"])
    assert got == [["snake_case", "éa", "42", "a1"], []]
