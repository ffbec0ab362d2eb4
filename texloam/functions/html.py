"""Rules over stored HTML that need no document tree."""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.config import UrlSpec
from texloam.functions.core import bind, replace_each
from texloam.functions.urls import resolve_url, standardize_url

# Fixed values.
CATEGORIES = ("navigation", "images", "scripts", "stylesheets", "other")
# Tags and the attribute that holds their link.
ANCHOR_HREF, IMAGE_SRC, SCRIPT_SRC = ("a", "href"), ("img", "src"), ("script", "src")
STYLESHEET_REL = r"""(?i)rel=["']stylesheet["']"""
STYLESHEET = (
    r"""[^>]*rel=["']stylesheet["'][^>]*href=["']([^\n]*?)["']"""
    r"""|[^>]*href=["']([^\n]*?)["'][^>]*rel=["']stylesheet["']"""
)
BASE_HREF = r"""(?is)\A(?>.*?<base[^>]*href=["'])([^"']*)["']"""
# Only the first title can decide: what closes a later one also closes the first.
TITLE = r"(?is)\A(?>.*?<title[^>]*+>)(.*?)</title>"
ENTITY = r"&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]{0,31}+);?"
REPLACEMENT = "\ufffd"
NO_TITLE = "No title"
SKIPPED_HREF = r"^$|^#$|^javascript:|^mailto:"


@cache
def _entity_names() -> tuple[str, str]:
    """The entities of HTML as JSON (name with its semicolon, if it needs one), and those that need none, as a pattern."""
    legacy = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return json.dumps(html5), "^(" + "|".join(legacy) + ")"


# Numbers that browsers read as Windows characters.
WINDOWS = {n: bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}


def _numbered(hit: Column) -> Column:
    hexadecimal = F.lower(hit).startswith("&#x")
    digits = F.ltrim(F.regexp_extract(hit, "([0-9a-fA-F]+);?$", 1), F.lit("0"))
    # Eight digits hold every code point; a longer number is none.
    base = lambda radix: F.conv(F.substring(digits, 1, 8), radix, 10).cast("long")
    number = F.when(digits == "", F.lit(0)).when(F.length(digits) > 8, F.lit(1 << 40))
    number = number.otherwise(F.when(hexadecimal, base(16)).otherwise(base(10)))

    def character(n: Column) -> Column:
        bad = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        windows = F.lit(None).cast("string")
        for code, text in WINDOWS.items():
            windows = F.when(n == code, F.lit(text)).otherwise(windows)
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(bad, F.lit(REPLACEMENT)).otherwise(F.coalesce(windows, plain))

    return bind(number, character)


def unescape(text: Column) -> Column:
    """Named and numbered entities of HTML as characters; unknown ones stay.

    A name may lack its semicolon where browsers allow that.
    """
    names, legacy = _entity_names()
    known = F.from_json(F.lit(names), "map<string,string>")

    def named(hit: Column) -> Column:
        bare = F.substring(hit, F.lit(2), F.length(hit))
        start = F.regexp_extract(bare, legacy, 1)
        rest = F.substring(bare, F.length(start) + 1, F.length(bare))
        shorter = F.when(start != "", F.concat(F.try_element_at(known, start), rest))
        return F.coalesce(F.try_element_at(known, bare), shorter, hit)

    decode = lambda hit: F.when(hit.startswith("&#"), _numbered(hit)).otherwise(named(hit))
    return bind(text, lambda t: F.when(t.contains("&"), replace_each(t, ENTITY, decode)).otherwise(t))


def _value(attribute: str) -> str:
    return rf"""{attribute}=["']([^\n]*?)["']"""


def tags(html: Column, tag: str, wanted: str) -> Column:
    """Array of the parts of tags that match ``wanted``, in page order.

    A tag that does not match is consumed up to its end and then left out:
    trying again inside it could not match either and makes pages with unclosed
    tags quadratic.
    """
    pattern = rf"(?i)<{tag}(?:{wanted}|[^>]*+)"
    hits = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    return F.filter(hits, lambda hit: hit.rlike(rf"(?i)\A<{tag}(?:{wanted})"))


def tag_values(html: Column, of: tuple[str, str]) -> Column:
    """Array of the values of a tag's attribute, in page order."""
    tag, attribute = of
    wanted = "[^>]*" + _value(attribute)
    return F.transform(
        tags(html, tag, wanted), lambda hit: F.regexp_extract(hit, rf"(?i)\A<{tag}{wanted}", 1)
    )


def raw_links(html: Column) -> Column:
    """Array of (category, link as written), page order inside each category."""

    def tagged(category: str, found: Column) -> Column:
        return F.transform(
            found, lambda link: F.struct(F.lit(category).alias("category"), link.alias("link"))
        )

    sheets = F.transform(
        tags(html, "link", STYLESHEET),
        lambda hit: F.concat(
            *(F.regexp_extract(hit, rf"(?i)\A<link(?:{STYLESHEET})", group) for group in (1, 2))
        ),
    )
    wanted = "[^>]*" + _value("href")
    other = F.transform(
        F.filter(tags(html, "link", wanted), lambda hit: ~hit.rlike(STYLESHEET_REL)),
        lambda hit: F.regexp_extract(hit, rf"(?i)\A<link{wanted}", 1),
    )
    return F.concat(
        tagged("navigation", tag_values(html, ANCHOR_HREF)),
        tagged("images", tag_values(html, IMAGE_SRC)),
        tagged("scripts", tag_values(html, SCRIPT_SRC)),
        tagged("stylesheets", sheets),
        tagged("other", other),
    )


def links(html: Column, base: Column | None = None, spec: UrlSpec | None = None) -> Column:
    """Array of (category, standardized link), first occurrence kept.

    Repeated links are common, so they are resolved once.
    """

    def standard(found: Column) -> Column:
        url = found["link"] if base is None else resolve_url(base, found["link"])
        return F.struct(
            found["category"].alias("category"), standardize_url(url, spec).alias("link")
        )

    return F.array_distinct(F.transform(F.array_distinct(raw_links(html)), standard))


def title(html: Column) -> Column:
    """Text of the title element, "No title" without one."""
    return F.when(html.rlike(TITLE), unescape(F.regexp_extract(html, TITLE, 1))).otherwise(NO_TITLE)


def base_href(html: Column, page_url: Column) -> Column:
    """The address links are relative to: the base element, else the page."""
    return bind(
        F.regexp_extract(html, BASE_HREF, 1),
        lambda found: F.when(found == "", page_url).otherwise(found),
    )


def followable(href: Column) -> Column:
    """False for empty, "#", javascript: and mailto: links."""
    return ~href.rlike(SKIPPED_HREF)
