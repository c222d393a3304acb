"""From HTML to clean text, tokens and query terms."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.fixed import (
    INDEX_STOP_WORDS,
    KEEP_LONGER_THAN,
    PUNCTUATION,
    SNIPPET_LENGTH,
    STOP_WORDS,
    WORDS_PER_LINE,
)

# Unicode white space plus the four separators that only Python counts as such.
SPACE = r"(?U)[\s\x1c-\x1f]"

# Everything in a page that is not text. The possessive loop over quoted
# attribute values runs without recursion, so tag length is not limited.
TAG = r"""</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*+>"""
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style|template)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
    r"|<[!?][^>]*>"
)
MARKUP = HIDDEN + "|" + TAG

# Character references. Names need their semicolon, but for the oldest ones.
NUMERIC = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
NAMED = r"^([a-zA-Z][a-zA-Z0-9]*);"
_OLD_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
# numbers from 0x80 to 0x9F mean the Windows code page, where that has a character
_WINDOWS = ("", "")
for _code in range(0x80, 0xA0):
    if _shown := bytes([_code]).decode("cp1252", "ignore"):
        _WINDOWS = (_WINDOWS[0] + chr(_code), _WINDOWS[1] + _shown)
OLD = "^(?:" + "|".join(_OLD_NAMES) + ")"
# in attribute values, what could be the name of a URL parameter is left alone
OLD_IN_ATTRIBUTE = OLD + "(?![=a-zA-Z0-9])"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once.

    A column used inside a lambda, or in several branches, is otherwise
    evaluated again at each place.
    """
    return F.transform(F.array(value), body)[0]


def is_html(body: Column) -> Column:
    """F1 on stored bodies: does the text look like an HTML page?"""
    return body.rlike(r"(?i)<html")


def is_html_response(content_type: Column) -> Column:
    """F1 on response headers."""
    return content_type.contains("text/html")


def unescape(text: Column, attribute: bool = False) -> Column:
    """Decode character references in one pass, so ``&amp;lt;`` gives ``&lt;``.

    The text is cut at each ampersand; a piece that starts with a known
    reference gets its character, any other piece gets its ampersand back.
    ``attribute`` follows the stricter rule for values of attributes.
    """
    table = {name.rstrip(";"): value for name, value in html5.items()}
    names = F.from_json(F.lit(json.dumps(table)), "map<string,string>")  # folded to a constant

    def from_code(code: Column) -> Column:
        # UTF-32 bytes of the code point; codes that are no character give U+FFFD
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        code = F.when(valid, code).otherwise(F.lit(0xFFFD))
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.translate(plain, *_WINDOWS)

    def by_number(reference: Column) -> Column:
        digits = F.rtrim(F.substr(reference, F.lit(2)), F.lit(";"))
        value = F.when(
            digits.rlike("^[xX]"), F.conv(F.substr(digits, F.lit(2)), 16, 10).try_cast("long")
        ).otherwise(digits.try_cast("long"))
        return bind(F.coalesce(value, F.lit(0)), from_code)

    def by_name(name: Column) -> Column:
        return (
            F.when(name == "amp", F.lit("&"))
            .when(name == "lt", F.lit("<"))
            .when(name == "gt", F.lit(">"))
            .when(name == "quot", F.lit('"'))
            .when(name == "nbsp", F.lit("\u00a0"))
            .otherwise(F.try_element_at(names, name))
        )

    def after(part: Column, length: Column) -> Column:
        return F.substr(part, length + 1)

    def piece(part: Column) -> Column:
        found = F.struct(
            F.regexp_extract(part, NUMERIC, 0).alias("number"),
            F.regexp_extract(part, NAMED, 1).alias("name"),
            F.regexp_extract(part, OLD_IN_ATTRIBUTE if attribute else OLD, 0).alias("old"),
        )

        def decoded(f: Column) -> Column:
            named = F.when(f["name"] != "", by_name(f["name"]))
            return F.coalesce(
                F.when(
                    f["number"] != "",
                    F.concat(by_number(f["number"]), after(part, F.length(f["number"]))),
                ),
                F.concat(named, after(part, F.length(f["name"]) + 1)),
                F.when(f["old"] != "", F.concat(by_name(f["old"]), after(part, F.length(f["old"])))),
                F.concat(F.lit("&"), part),
            )

        return bind(found, decoded)

    def decode(whole: Column) -> Column:
        parts = F.split(whole, "&")
        tail = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.concat(parts[0], F.array_join(F.transform(tail, piece), ""))

    return bind(text, lambda t: F.when(t.contains("&"), decode(t)).otherwise(t))


def html_text(html: Column) -> Column:
    """Visible text of a page; every tag becomes a line break."""
    return unescape(F.regexp_replace(html, MARKUP, "\n"))


def drop_punctuation(text: Column) -> Column:
    """T2."""
    return F.translate(text, PUNCTUATION, "")


def squeeze(text: Column) -> Column:
    """Single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def words(text: Column) -> Column:
    """T5: split at white space, without empty tokens."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def clean_for_search(html: Column) -> Column:
    """Text of a page without punctuation, single-spaced, lower case."""
    return F.lower(squeeze(drop_punctuation(html_text(html))))


def plain_words(text: Column) -> Column:
    """T2, T4, T5 on text that holds no markup."""
    return words(F.lower(drop_punctuation(text)))


def training_tokens(html: Column) -> Column:
    """Tokens of a page for word vectors."""
    return plain_words(html_text(html))


def ascii_words(text: Column) -> Column:
    """Drop all but ASCII letters, digits and white space, then split."""
    return words(F.regexp_replace(text, r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]", ""))


def reflow(tokens: Column, per_line: int = WORDS_PER_LINE) -> Column:
    """Lines of ``per_line`` words."""

    def lines(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(per_line))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(per_line)), " "))

    return F.array_join(bind(tokens, lines), "\n")


def clean_for_answers(html: Column) -> Column:
    """Text of a page as lines of plain ASCII words."""
    return reflow(ascii_words(html_text(html)))


def long_enough(content: Column, longer_than: int = KEEP_LONGER_THAN) -> Column:
    """strictly longer than the limit, line breaks included."""
    return F.length(content) > longer_than


def drop_stop_words(tokens: Column, stop: list[str] = STOP_WORDS) -> Column:
    """order and repeats are kept."""
    return F.filter(tokens, lambda w: ~w.isin(stop))


def normalize_query(text: Column) -> Column:
    """The searched form of a query."""
    return F.array_join(drop_stop_words(plain_words(text)), " ")


def index_terms(text: Column, stop: list[str] = INDEX_STOP_WORDS) -> Column:
    """Terms of the text index, for documents and queries alike."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.filter(found, lambda w: (F.length(w) >= 2) & ~w.isin(stop))


def snippet(content: Column, length: int = SNIPPET_LENGTH) -> Column:
    """F11."""
    return F.substring(content, 1, length)
