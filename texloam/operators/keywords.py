"""Keyword matches in page elements and the report about them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from texloam.functions import automaton
from texloam.functions.core import SPACE_RUN, strip

# The automaton travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(automaton)
_numbers = count()

# Up to this many keywords are tested as constants of the plan.
CONSTANT_KEYWORDS = 100
# Bytes of forms that one automaton holds; longer tables take a pass for each part.
AUTOMATON_BYTES = 32 << 20
SHORTEST_PART = 4
SAMPLES = 3
SAMPLE_LENGTH = 100


def keyword_forms(keyword: str, parts: bool = True) -> list[str]:
    """What is searched for a keyword: itself, then its long words, in lower case."""
    whole = keyword.strip().lower()
    words = [w for w in whole.split() if len(w) >= SHORTEST_PART] if parts else []
    return list(dict.fromkeys([whole, *words]))


def keyword_matches(
    elements: DataFrame, keywords: Sequence[str], text: str = "text", parts: bool = True
) -> DataFrame:
    """Rows of ``elements`` once per keyword they contain, with the form found.

    Up to ``CONSTANT_KEYWORDS`` keywords are constants of the plan, and a row is
    copied only for keywords that match.  A longer list goes through
    :func:`keyword_table_matches`, with the same rows.
    """
    wanted = list(dict.fromkeys(k for k in keywords if k.strip()))
    if len(wanted) > CONSTANT_KEYWORDS:
        names = elements.sparkSession.createDataFrame([(k,) for k in wanted], "keyword string")
        return keyword_table_matches(elements, names, text=text, parts=parts)

    def found(keyword: str) -> Column:
        # The lower-cased text is a column of its own, so it is made once per row.
        forms = keyword_forms(keyword, parts)
        form = F.coalesce(*[F.when(F.col("_low").contains(f), F.lit(f)) for f in forms])
        return F.when(
            form.isNotNull(),
            F.struct(F.lit(keyword).alias("keyword"), form.alias("matched_keyword")),
        )

    hits = F.array_compact(F.array(*[found(k) for k in wanted]))
    lowered = elements.withColumn("_low", F.lower(F.col(text)))
    return lowered.select(*elements.columns, F.inline(hits))


def keyword_table_matches(
    elements: DataFrame,
    keywords: DataFrame,
    key: Sequence[str] = (),
    text: str = "text",
    parts: bool = True,
) -> DataFrame:
    """The same for a keyword table of any size, in one pass over the texts.

    All forms are one automaton, which reads a text once whatever their number
    and gives numbers, which a broadcast table of the same part turns into names,
    so rows of ``elements`` never move: rows with null cells and rows that repeat
    each have their own matches, and ``key`` is not needed.  The table's bytes
    are counted first.  What one automaton may hold is broadcast, never more at a
    time than ``AUTOMATON_BYTES``; a larger table is dealt to several by the hash
    of the keyword, and each of them is a pass.  Null and blank keywords find
    nothing.
    """
    spark = elements.sparkSession
    forms = _form_table(keywords, parts)
    size = F.aggregate(F.transform("forms", F.octet_length), F.lit(0), lambda a, b: a + b)
    total = forms.agg(F.sum(size.cast("long"))).first()[0] or 0
    deals = 1 + total // AUTOMATON_BYTES
    found = None
    for deal in range(deals):
        part = forms.filter(F.pmod(F.xxhash64("keyword"), F.lit(deals)) == deal)
        held = [(r.keyword, r.forms) for r in part.orderBy("keyword").collect()]
        hits = F.inline(_automaton(spark, held)(F.lower(F.col(text)))).alias("_keyword", "_form")
        rows = elements.select(*elements.columns, hits)
        # A task sends numbers; the names, often as long as the text, are put in beside it.
        named = {
            "_keyword": pa.array(range(len(held)), pa.int32()),
            "_name": pa.array([k for k, _ in held], pa.string()),
            "_forms": pa.array([f for _, f in held], pa.list_(pa.string())),
        }
        names = spark.createDataFrame(pa.table(named))
        form = F.get("_forms", F.col("_form"))
        rows = rows.join(F.broadcast(names), "_keyword")
        rows = rows.select(*elements.columns, F.col("_name").alias("keyword"), form.alias("matched_keyword"))
        found = rows if found is None else found.unionByName(rows)
    return found


def _automaton(spark: SparkSession, held: list[tuple[str, list[str]]]):
    """A column function: lower-cased text to the numbers of its keywords and of their forms."""
    given = spark.sparkContext.broadcast(held)
    number = next(_numbers)

    @F.arrow_udf("array<struct<keyword:int,form:int>>")
    def hits(texts: pa.Array) -> pa.Array:
        return automaton.matcher(number, given).find_all(texts)

    return hits


def _form_table(keywords: DataFrame, parts: bool) -> DataFrame:
    """(keyword, forms) of every distinct keyword that has any form."""
    whole = strip(F.lower(F.col("keyword")))
    words = F.filter(F.split(whole, SPACE_RUN), lambda w: F.length(w) >= SHORTEST_PART)
    forms = F.array_distinct(F.concat(F.array(whole), words)) if parts else F.array(whole)
    table = keywords.select("keyword").distinct().withColumn("forms", F.filter(forms, lambda f: f != ""))
    return table.filter(F.size("forms") > 0)


def exact_case_matches(elements: DataFrame, keywords: Sequence[str], text: str = "text") -> DataFrame:
    """Case-sensitive variant: the lower, upper or capitalised keyword occurs as such."""

    def found(keyword: str) -> Column:
        forms = dict.fromkeys([keyword.lower(), keyword.upper(), keyword.capitalize()])
        form = F.coalesce(*[F.when(F.col(text).contains(f), F.lit(f)) for f in forms])
        pair = F.struct(F.lit(keyword).alias("keyword"), form.alias("matched_keyword"))
        return F.when(form.isNotNull(), pair)

    return elements.select("*", F.inline(F.array_compact(F.array(*[found(k) for k in keywords]))))


def keyword_report(
    matches: DataFrame,
    keywords: DataFrame,
    order_by: Sequence[str],
    pages: DataFrame | None = None,
    url: str = "url",
    text: str = "text",
) -> DataFrame:
    """Per keyword: matches, distinct URLs, status, three sample texts.

    Keywords without a match stay with count 0.  The three samples are the first
    in ``order_by``; the rank limit is applied before the shuffle, so a keyword
    that matches everywhere sends three rows per task.  ``matches`` is read twice,
    for the counts and for the samples: persist it when it is costly.
    """
    # Pairs first: a keyword found on most pages is spread by URL.
    pairs = matches.groupBy("keyword", url).agg(F.count(F.lit(1)).alias("_n"))
    counts = pairs.groupBy("keyword").agg(
        F.sum("_n").alias("count"), F.count(F.lit(1)).alias("unique_urls")
    )
    window = W.partitionBy("keyword").orderBy(*order_by)
    first = matches.select(
        "keyword", text, *order_by, F.row_number().over(window).alias("_n")
    ).filter(F.col("_n") <= SAMPLES)
    sample = F.concat(F.substring(text, 1, SAMPLE_LENGTH), F.lit("..."))
    samples = first.groupBy("keyword").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_n", sample.alias("t")))), lambda x: x["t"]
        ).alias("sample_matches")
    )
    report = (
        keywords.select("keyword")
        .distinct()
        .join(counts, "keyword", "left")
        .join(samples, "keyword", "left")
        .select(
            "keyword",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce("unique_urls", F.lit(0)).alias("unique_urls"),
            F.when(F.col("count").isNull(), "No matches found")
            .otherwise("Completed")
            .alias("status"),
            F.coalesce("sample_matches", F.array().cast("array<string>")).alias("sample_matches"),
        )
    )
    if pages is None:
        return report
    visited = pages.agg(F.count(F.lit(1))).scalar()
    return report.withColumn("total_pages_visited", visited)
