"""Jobs over stored web pages: links, titles, elements."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from texloam.config import UrlSpec
from texloam.functions import automaton, dom
from texloam.functions import html as rules
from texloam.functions.core import SPACE
from texloam.functions.urls import drop_fragment, resolve_url, url_host

# The page tree travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(dom)
cloudpickle.register_pickle_by_value(automaton)

# Fixed values.
SELECTORS = (
    "h1",
    "h2",
    "h3",
    "h4",
    "p",
    "li",
    "div.content",
    "article",
    "section",
    "div.main",
    "div.article",
    "main",
)
SHORT_SELECTORS = ("h1", "h2", "h3", "p", "li", "div.content", "article", "section")
CONTEXT_BELOW = 2000
LEAST_PAGE_LENGTH = 500
# Rows leave a task in batches of so many rows or characters.
ROWS_PER_BATCH, CHARS_PER_BATCH = 5000, 8_000_000


def with_html(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages whose HTML is not blank."""
    return pages.filter(F.col(html).rlike(f"[^{SPACE}]"))


def substantial_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with more than the least number of characters."""
    return pages.filter(F.length(html) > LEAST_PAGE_LENGTH)


def _of_category(links: Column, category: str) -> Column:
    return F.filter(links, lambda x: x["category"] == category)


def page_link_table(
    pages: DataFrame,
    key: Sequence[str],
    html: str = "html",
    base: str | None = None,
    spec: UrlSpec | None = None,
) -> DataFrame:
    """One row per page: total, five counts and five comma-joined link lists."""
    found = rules.links(F.col(html), F.col(base) if base else None, spec)
    linked = with_html(pages, html).select(*key, found.alias("links"))
    columns = [F.size("links").cast("long").alias("total_links")]
    for c in rules.CATEGORIES:
        own = _of_category(F.col("links"), c)
        columns.append(F.size(own).cast("long").alias(f"{c}_count"))
        columns.append(F.array_join(own["link"], ",").alias(f"{c}_links"))
    return linked.select(*key, *columns)


def page_links(
    pages: DataFrame,
    key: Sequence[str],
    html: str = "html",
    base: str | None = None,
    spec: UrlSpec | None = None,
) -> DataFrame:
    """One row per page, category and distinct link, with its place on the page."""
    found = rules.links(F.col(html), F.col(base) if base else None, spec)
    linked = with_html(pages, html).select(*key, F.posexplode(found).alias("pos", "link"))
    return linked.select(*key, F.col("link.category").alias("category"), "pos", "link.link")


def link_counts(links: DataFrame) -> DataFrame:
    """Number of links and of pages per category over the whole corpus."""
    return links.groupBy("category").agg(F.count(F.lit(1)).alias("links"))


def page_titles(pages: DataFrame, key: Sequence[str], html: str = "html") -> DataFrame:
    return pages.select(*key, rules.title(F.col(html)).alias("title"))


def internal_links(
    pages: DataFrame, key: Sequence[str], url: str = "url", html: str = "html"
) -> DataFrame:
    """(key, link): distinct links of a page to its own host, without fragments."""
    raw = F.array_distinct(rules.tag_values(F.col(html), rules.ANCHOR_HREF))
    found = with_html(pages, html).select(
        *key,
        url_host(F.col(url)).alias("_host"),
        rules.base_href(F.col(html), F.col(url)).alias("_base"),
        F.filter(raw, rules.followable).alias("_hrefs"),
    )
    resolved = F.transform(
        "_hrefs", lambda href: drop_fragment(resolve_url(F.col("_base"), rules.unescape(href)))
    )
    own = F.filter(resolved, lambda link: url_host(link) == F.col("_host"))
    return found.select(*key, F.explode(F.array_distinct(own)).alias("link"))


def page_elements(
    pages: DataFrame,
    key: Sequence[str],
    html: str = "html",
    selectors: Sequence[str] = SELECTORS,
    context_below: int | None = CONTEXT_BELOW,
    with_empty: bool = False,
    containing: Sequence[str] | None = None,
) -> DataFrame:
    """One row per element with text (``with_empty``: any element) and selector it matches.

    A selector is CSS as :func:`texloam.functions.dom.parse_selector` has it, or
    ``#text`` for the bare text nodes; other syntax raises ``ValueError``.
    With ``containing``, only elements that have one of these strings in their
    lower-cased text are built.

    A page is one cell, so its tree is built inside the task that reads it; only
    the keys and the HTML travel to Python, rows leave in bounded batches.
    """
    for selector in selectors:
        if selector != dom.TEXT_NODES:
            dom.parse_selector(selector)
    forms = None if containing is None else list(containing)
    fields = [pages.schema[k] for k in key]
    schema = StructType(
        [
            *fields,
            StructField("selector", StringType()),
            StructField("pos", IntegerType()),
            StructField("tag", StringType()),
            StructField("href", StringType()),
            StructField("text", StringType()),
            StructField("context", StringType()),
            StructField("parent_length", IntegerType()),
        ]
    )
    names, wanted = [f.name for f in schema.fields], list(selectors)
    kinds = [pa.int32() if f.dataType == IntegerType() else pa.string() for f in schema.fields[len(fields) :]]

    def rows(ids: list[pa.Array], places: list[int], found: list[dom.Element]) -> pa.RecordBatch:
        at = pa.array(places, pa.int32())
        cells = zip(*found, strict=True) if found else [()] * len(kinds)
        columns = [pa.array(c, kind) for c, kind in zip(cells, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*(c.take(at) for c in ids), *columns], names)

    # Pages become strings one by one, keys stay as they came.
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = None if forms is None else automaton.contains_any(forms)
        for batch in batches:
            *ids, cells = batch.columns
            places, elements, chars = [], [], 0
            for place, page in enumerate(cells):
                found = dom.page_elements(page.as_py(), wanted, context_below, with_empty, test)
                places += [place] * len(found)
                elements += found
                chars += sum(len(e.text) + len(e.context or "") for e in found)
                if len(elements) >= ROWS_PER_BATCH or chars >= CHARS_PER_BATCH:
                    yield rows(ids, places, elements)
                    places, elements, chars = [], [], 0
            yield rows(ids, places, elements)

    return with_html(pages, html).select(*key, html).mapInArrow(parse, schema)


def link_priorities(
    pages: DataFrame, key: Sequence[str], url: str = "url", html: str = "html"
) -> DataFrame:
    """(key, link, priority) of internal links; a link keeps its best priority.

    Three points for an anchor text above 8 characters, two for a parent text
    above 40, two for a link without a query.  Links without text, such as those
    around a picture, count as well.
    """
    anchors = page_elements(pages, [*key, url], html, ["a"], context_below=0, with_empty=True)
    link = resolve_url(F.col(url), F.col("href"))
    found = anchors.filter(
        F.col("href").isNotNull() & ~F.col("href").rlike(r"^$|^#$|^javascript:")
    ).select(*key, url, link.alias("link"), "text", "parent_length")
    points = (
        F.when(F.length("text") > 8, 3).otherwise(0)
        + F.when(F.col("parent_length") > 40, 2).otherwise(0)
        + F.when(~F.col("link").contains("?"), 2).otherwise(0)
    )
    internal = found.filter(url_host(F.col("link")) == url_host(F.col(url)))
    return internal.groupBy(*key, "link").agg(F.max(points).alias("priority"))
