"""The registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texloam.config import KNOWN_SPLIT_METHODS, CleanSpec, UrlSpec
from texloam.functions import code, html, missing, text, tokens, treebank, urls, words
from texloam.operators import cleaning, keywords, linkgraph, pages, quality, structure
from texloam.operators import tokens as token_jobs
from texloam.plans import oracle_parts as q
from texloam.plans import stages
from texloam.session import scratch_path
from texloam.sources import readers, writers
from texloam.streaming import files as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def query(sql: Callable[[], str] | str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql if callable(sql) else lambda: sql
        return function

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of long texts or pages; on one machine, on all its cores even if it is one small file."""
    found, context = table(spark, sf, name), spark.sparkContext
    return readers.spread(found, context.defaultParallelism) if context.master.startswith("local") else found


# --- text cleaning ---------------------------------------------------------


@query(lambda: f"SELECT doc_id, {q.clean('text')} AS clean_text FROM documents")
def clean_text_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.col("text").alias("clean_text"))
    return cleaning.clean_text(docs, ["clean_text"])


@query(lambda: f"SELECT doc_id, {q.clean('text', with_placeholders=False)} AS clean_text FROM documents")
def clean_text_legacy(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.col("text").alias("clean_text"))
    return cleaning.clean_text(docs, ["clean_text"], CleanSpec(placeholders=False))


@query(lambda: f"SELECT doc_id, {q.clean('text', split=True)} AS clean_text FROM documents")
def clean_text_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.col("text").alias("clean_text"))
    return cleaning.clean_text(docs, ["clean_text"], CleanSpec(split_methods=KNOWN_SPLIT_METHODS))


@query(lambda: f"SELECT conv_id, turn, {q.clean('text')} AS clean_text FROM conversations")
def clean_text_repetitive(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("clean_text")
    )
    return cleaning.clean_text(turns, ["clean_text"], repetitive=True)


_CONTACT = "text || ' see http://' || source || '.org/' || lang || ' or ask ' || source || '@' || lang || '.org now'"


@query(
    lambda: f"""
    SELECT lang, count(*) AS texts,
           sum(len(regexp_extract_all(t, ' URL ')))::BIGINT AS urls,
           sum(len(regexp_extract_all(t, ' EMAIL ')))::BIGINT AS emails
    FROM (SELECT lang, {q.placeholders(_CONTACT)} AS t FROM documents) GROUP BY lang"""
)
def placeholder_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("lang", F.expr(_CONTACT).alias("t"))
    replaced = cleaning.apply_rules(docs, ["t"], ["urls", "emails"])
    return replaced.groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts"),
        F.sum(F.regexp_count("t", F.lit(" URL "))).alias("urls"),
        F.sum(F.regexp_count("t", F.lit(" EMAIL "))).alias("emails"),
    )


@query(
    lambda: f"""
    SELECT doc_id, 1 + len(regexp_extract_all(text, {q.lit(rf'[.?!][{q.S}]+[A-Z]')})) AS sentences
    FROM documents"""
)
def sentence_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents")
    rows = docs.select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("sentences"))
    return rows


@query(
    lambda: "SELECT o_orderkey, 'order  NUMBER  of  NUMBER : x' || o_custkey || ' ' || o_orderstatus AS t FROM orders"
)
def number_placeholder(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr(
            "'order ' || o_orderkey || ' of ' || o_custkey || ': x' || o_custkey || ' ' || o_orderstatus"
        ).alias("t"),
    )
    return cleaning.apply_rules(orders, ["t"], ["numbers"])


# --- word splitting and punctuation ----------------------------------------


@query(lambda: f"SELECT o_orderkey, {q.general('o_orderpriority')} AS priority FROM orders")
def split_words_priority(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return cleaning.split_words(orders, ["priority"])


@query("SELECT n_nationkey, replace(n_name, '_', ' ') AS name FROM nation")
def split_snake_nation(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    return cleaning.rewrite(nations, {"name": words.split_snake})


_JOINED_SQL = (
    "array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), '')"
)


@query(
    lambda: f"""
    SELECT p_partkey, {q.camel("lower(p_type[1]) || " + _JOINED_SQL)} AS camel,
           {q.team_names("'the' || " + _JOINED_SQL)} AS team FROM part"""
)
def split_camel_team(spark: SparkSession, sf: str) -> DataFrame:
    joined = F.replace(F.initcap("p_name"), F.lit(" "), F.lit(""))
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lower(F.substring("p_type", 1, 1)), joined).alias("camel"),
        F.concat(F.lit("the"), joined).alias("team"),
    )
    return cleaning.rewrite(parts, {"camel": words.split_camel, "team": words.split_team_names})


_MIXED = "c_mktsegment || c_custkey || 'x49ers ' || c_nationkey || 'th 5Gs 3D' || c_custkey || c_name"


@query(lambda: f"SELECT c_custkey, {q.numbers(_MIXED)} AS t FROM customer")
def split_numbers(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", F.expr(_MIXED).alias("t"))
    return cleaning.rewrite(customers, {"t": words.split_numbers})


_BROKEN = (
    "text || ' === See Also === (  ) a--b `` ' || lang || ' ` $ 12.5 now [3] ^ x = y .. ' || source || ' \"!\"'"
)


@query(lambda: f"SELECT doc_id, {q.punctuation(_BROKEN)} AS t FROM documents")
def normalize_punctuation(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.expr(_BROKEN).alias("t"))
    return cleaning.normalize_punctuation(docs, ["t"])


_CITED = "text || ' as in [' || doc_id || ']: ' || n_chars || ' and [ ' || n_chars || ' ]. so it is'"


@query(
    lambda: f"SELECT doc_id, {q.references(_CITED)} AS spelled, {q.tidy(_CITED)} AS tidy FROM documents"
)
def academic_references(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select(
        "doc_id", F.expr(_CITED).alias("spelled"), F.expr(_CITED).alias("tidy")
    )
    return cleaning.rewrite(docs, {"spelled": words.spell_references, "tidy": words.tidy_sentences})


_MATCH = "text || ' theLakers(home) beat RedSox 3-2 in ' || turn || 'OT. the 49 ers*won'"


@query(
    lambda: f"""
    SELECT conv_id, turn, {q.sport(_MATCH)} AS sport, {q.sport(q.tidy(_MATCH))} AS messy
    FROM conversations"""
)
def sport_text(spark: SparkSession, sf: str) -> DataFrame:
    turns = texts(spark, sf, "conversations").select(
        "conv_id", "turn", F.expr(_MATCH).alias("sport"), F.expr(_MATCH).alias("messy")
    )
    return cleaning.rewrite(turns, {"sport": words.sport_text, "messy": words.messy_text})


@query(
    lambda: f"SELECT o_orderkey, {q.clean(q.general('o_orderpriority'), with_placeholders=False)} AS t FROM orders"
)
def named_rule_chain(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("t"))
    names = ["general", "lower", "punctuation_blank", "ascii", "spaces", "lone_letters"]
    return cleaning.apply_rules(orders, ["t"], names)


# --- tokens ----------------------------------------------------------------


def _stopword_sql() -> str:
    kept = {c: q.without_stop_words(q.tokens("text"), q.stop_list(n)) for c, n in (("en", "english"), ("fr", "french"), ("de", "german"), ("es", "spanish"))}
    cases = " ".join(f"WHEN lang = '{c}' THEN {e}" for c, e in kept.items() if c != "en")
    return f"""
    SELECT doc_id, len(k) AS n_tokens, array_to_string(k, ' ') AS norm_text
    FROM (SELECT doc_id, CASE {cases} ELSE {kept["en"]} END AS k FROM documents)"""


@query(_stopword_sql)
def stopword_filter_by_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", "lang", "text")
    present = ("english", "french", "german", "spanish")
    kept = token_jobs.normalize_tokens(docs, "text", F.col("lang"), languages=present)
    return kept.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "norm_text")


def _alpha_sql() -> str:
    cleaned = q.clean("text", with_placeholders=False)
    letters = f"list_filter({q.tokens(cleaned)}, lambda t: regexp_matches(t, '^\\p{{L}}+$'))"
    kept = q.without_stop_words(letters, q.stop_list("english"))
    out = f"array_to_string(list_transform({kept}, lambda t: {q.singular('t')}), ' ')"
    return f"SELECT conv_id, turn, role, {out} AS text FROM conversations"


@query(_alpha_sql)
def alpha_tokens(spark: SparkSession, sf: str) -> DataFrame:
    spec = CleanSpec(placeholders=False, plurals=True)
    return token_jobs.clean_and_normalize(texts(spark, sf, "conversations"), exclude=["role"], spec=spec)


_LEMMA_SQL = f"""
    WITH lemmas AS (
      SELECT DISTINCT w AS word, w[:-2] AS lemma
      FROM (SELECT unnest({q.tokens("lower(text)")}) AS w FROM benchmark) WHERE length(w) > 4),
    toks AS (
      SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
      FROM (SELECT doc_id, {q.tokens("lower(text)")} AS t FROM documents))
    SELECT doc_id, string_agg(coalesce(lemma, tok), ' ' ORDER BY pos) AS norm_text
    FROM toks LEFT JOIN lemmas ON tok = word GROUP BY doc_id"""


def _lemmatized(spark: SparkSession, sf: str, **options: int) -> DataFrame:
    lower = F.lower(F.col("text"))
    docs = texts(spark, sf, "documents").select("doc_id", tokens.tokenize(lower).alias("tokens"))
    found = table(spark, sf, "benchmark").select(F.explode(tokens.tokenize(lower)).alias("word"))
    lemmas = (
        found.filter(F.length("word") > 4)
        .distinct()
        .select("word", F.substring("word", F.lit(1), F.length("word") - 1).alias("lemma"))
    )
    out = token_jobs.lemmatize(docs, lemmas, ["doc_id"], **options)
    return out.select("doc_id", F.array_join("tokens", " ").alias("norm_text"))


@query(_LEMMA_SQL)
def lemma_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return _lemmatized(spark, sf)


@query(_LEMMA_SQL)
def lemma_join(spark: SparkSession, sf: str) -> DataFrame:
    return _lemmatized(spark, sf, held_rows=0)


#: Ends every text of the query below, so that each ending and the exceptions occur.
_PLURALS = "mice series omen cars buses wolves knives boxes quizzes heroes churches dishes firemen cities geese men"
_SINGULARS = "mouse series omen car bus wolf knife box quiz hero church dish fireman city man cit her"


def _vocabulary_sql() -> str:
    endings = " UNION ALL ".join(
        f"SELECT tok, left(tok, length(tok) - {len(e)}) || '{b}', true, {i} FROM words WHERE ends_with(tok, '{e}') AND length(tok) > {len(e)}"
        for i, (e, b) in enumerate(tokens.NOUN_ENDINGS, 1)
    )
    special = ", ".join(f"('{w}', '{lemma}')" for w, lemma in tokens.IRREGULAR_NOUNS)
    return f"""
    WITH toks AS (
      SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
      FROM (SELECT doc_id, {q.tokens(f"lower(text || ' {_PLURALS}')")} AS t FROM documents)),
    words AS (SELECT DISTINCT tok FROM toks),
    vocabulary AS (
      SELECT unnest({q.tokens("lower(text)")}) AS form FROM benchmark
      UNION SELECT unnest(string_split('{_SINGULARS}', ' '))),
    forms(tok, form, ruled, place) AS (
      SELECT tok, tok, true, 0 FROM words UNION ALL {endings} UNION ALL
      SELECT w, l, false, -1 FROM (VALUES {special}) AS x(w, l)),
    ranked AS (
      SELECT tok AS word, form AS lemma,
        row_number() OVER (PARTITION BY tok ORDER BY ruled, length(form), place) AS n
      FROM forms WHERE form IN (SELECT form FROM vocabulary))
    SELECT doc_id, string_agg(coalesce(lemma, tok), ' ' ORDER BY pos) AS norm_text
    FROM toks LEFT JOIN (SELECT * FROM ranked WHERE n = 1) ON tok = word GROUP BY doc_id"""


@query(_vocabulary_sql)
def lemma_by_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    lower = tokens.tokenize(F.lower(F.concat("text", F.lit(f" {_PLURALS}"))))
    docs = texts(spark, sf, "documents").select("doc_id", lower.alias("tokens"))
    known = table(spark, sf, "benchmark").select(F.explode(tokens.tokenize(F.lower("text"))).alias("word"))
    known = known.unionByName(spark.range(1).select(F.explode(F.split(F.lit(_SINGULARS), " ")).alias("word")))
    out = token_jobs.lemmatize_by_vocabulary(docs, known, ["doc_id"])
    return out.select("doc_id", F.array_join("tokens", " ").alias("norm_text"))


#: Ends every text of the query below, so that each rule has a place to work.
_CONTRACTED = """ "I can't, (she'll) say 'no'": they cannot... gonna pay $3,000.50 -- at 10:30; 'tis Mr. Smith's [dogs'] d'ye?"""


def _treebank_sql() -> str:
    out = f"translate(text || {q.lit(_CONTRACTED)}, {q.lit(treebank.CUT + treebank.OPENING + treebank.CLOSING)}, '   ')"
    for pattern, cut in treebank.RULES:
        out = q.rx(out, pattern, cut.replace("$1", r"\1").replace("$2", r"\2").replace("$3", r"\3"))
    spelt = f"CASE t WHEN '{treebank.OPENING}' THEN '``' WHEN '{treebank.CLOSING}' THEN {q.lit("''")} ELSE t END"
    return f"""
    SELECT doc_id, len(k) AS n_tokens, array_to_string(list_transform(k, lambda t: {spelt}), ' ') AS tokens
    FROM (SELECT doc_id, list_filter(string_split({out}, '{treebank.CUT}'),
      lambda t: regexp_matches(t, {q.lit(f"[^{tokens.SPACE}]")})) AS k FROM documents)"""


@query(_treebank_sql)
def treebank_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.concat("text", F.lit(_CONTRACTED)).alias("text"))
    found = docs.select("doc_id", treebank.treebank_spans(F.col("text"))["token"].alias("k"))
    return found.select("doc_id", F.size("k").cast("long").alias("n_tokens"), F.array_join("k", " ").alias("tokens"))


# --- URLs ------------------------------------------------------------------


@query(
    lambda: f"""
    SELECT page_id, u AS url, {q.host('u')} AS host, true AS valid
    FROM (SELECT page_id, {q.standard_url('url')} AS u FROM pages)"""
)
def standardize_urls(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.standardize_urls(table(spark, sf, "pages").select("page_id", "url"), "url")


@query(
    lambda: f"""
    SELECT host, split_part(host, '.', -2) AS domain, count(*) AS pages, count(DISTINCT u) AS urls
    FROM (SELECT u, {q.host('u')} AS host FROM (SELECT {q.standard_url('url')} AS u FROM pages))
    GROUP BY host"""
)
def url_host_counts(spark: SparkSession, sf: str) -> DataFrame:
    standard = cleaning.standardize_urls(table(spark, sf, "pages").select("url"), "url")
    # Per-URL counts first: a host with most of the pages is spread by URL.
    per_url = standard.groupBy("host", "url").agg(F.count(F.lit(1)).alias("n"))
    hosts = per_url.groupBy("host").agg(
        F.sum("n").alias("pages"), F.count(F.lit(1)).alias("urls")
    )
    domain = urls.second_level_domain(F.concat(F.lit("http://"), F.col("host")))
    return hosts.select("host", domain.alias("domain"), "pages", "urls")


_PAGE_HREFS = """
    SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a[^>]*href=["'']([^\\n]*?)["'']', 1)) AS href
    FROM pages"""


def _page_hrefs(spark: SparkSession, sf: str) -> DataFrame:
    found = html.tag_values(F.col("html"), html.ANCHOR_HREF)
    return texts(spark, sf, "pages").select("page_id", "url", F.explode(found).alias("href"))


_ODD_URLS = "concat(replace(replace(url, '.example.com', '.example.xyz'), '.example.net', '.example.net:80'))"
_ISSUES_SQL = f"""
    WITH u AS (
      SELECT page_id, {_ODD_URLS} AS link FROM pages
      UNION ALL SELECT page_id, href FROM ({_PAGE_HREFS})),
    h AS (SELECT *, {q.host('link')} AS host FROM u WHERE link <> ''),
    i AS (
      SELECT page_id, link, list_filter([
        CASE WHEN NOT regexp_matches(link, '^https?://') THEN 'Missing or invalid scheme' END,
        CASE WHEN host = '' THEN 'Missing domain' END,
        CASE WHEN contains(host, '.') AND split_part(lower(host), '.', -1) IN ('xyz','tk','ml','ga','cf','gq')
             THEN 'Uncommon TLD (.' || split_part(lower(host), '.', -1) || ')' END,
        CASE WHEN length(link) > 2000 THEN 'Extremely long URL' END,
        CASE WHEN regexp_matches(host, '[^a-zA-Z0-9.-]') THEN 'Unusual characters in domain' END
      ], lambda x: x IS NOT NULL) AS issues FROM h)"""


def _issues(spark: SparkSession, sf: str) -> DataFrame:
    odd = table(spark, sf, "pages").select("page_id", F.expr(_ODD_URLS).alias("link"))
    links = odd.unionAll(_page_hrefs(spark, sf).select("page_id", F.col("href").alias("link")))
    return cleaning.url_issues(links, ["page_id"], "link", additional=True)


@query(
    _ISSUES_SQL
    + " SELECT page_id, link, array_to_string(issues, '; ') AS issues FROM i WHERE len(issues) > 0"
)
def url_validity_issues(spark: SparkSession, sf: str) -> DataFrame:
    return _issues(spark, sf).select("page_id", "link", F.array_join("issues", "; ").alias("issues"))


@query(
    _ISSUES_SQL
    + " SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM i) GROUP BY issue"
)
def url_issue_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.url_issue_counts(_issues(spark, sf))


@query(
    f"""
    SELECT page_id, href, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS link
    FROM ({_PAGE_HREFS})"""
)
def resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    found = _page_hrefs(spark, sf)
    return found.select("page_id", "href", urls.resolve_url(F.col("url"), F.col("href")).alias("link"))


# --- pages -----------------------------------------------------------------

_RICH_HTML = (
    "html || '<link rel=\"stylesheet\" href=\"/css/' || page_id || '.css\"><img src=\"//cdn.example.org/i/' "
    "|| page_id || '.png?utm_source=x&v=1\"><script src=\"https://www.js.example.org/app.js/\"></script>"
    "<link href=\"icon.png\" rel=\"icon\">'"
)


def _rich_pages(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "pages").select("page_id", "url", F.expr(_RICH_HTML).alias("html"))


def _links_sql() -> str:
    root = "regexp_extract(url, '^[a-z]+://[^/?#]*')"
    folder = r"regexp_extract(url, '^([a-z]+://[^/?#]*(/[^?#]*)?)/', 1)"
    return f"""
    WITH raw AS (
      SELECT page_id, 'navigation' AS category, pos, {root} || href AS link FROM (
        SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) AS pos FROM (
          SELECT page_id, url,
            regexp_extract_all(html, '(?i)<a[^>]*href=["'']([^\\n]*?)["'']', 1) AS h FROM pages))
      UNION ALL SELECT page_id, 'stylesheets', 1, {root} || '/css/' || page_id || '.css' FROM pages
      UNION ALL SELECT page_id, 'images', 1,
        regexp_extract(url, '^[a-z]+:') || '//cdn.example.org/i/' || page_id || '.png?v=1' FROM pages
      UNION ALL SELECT page_id, 'scripts', 1, 'https://js.example.org/app.js' FROM pages
      UNION ALL SELECT page_id, 'other', 1, {folder} || '/icon.png' FROM pages),
    links AS (
      SELECT page_id, category, link, min(pos) AS pos
      FROM (SELECT page_id, category, pos, {q.standard_url("link")} AS link FROM raw)
      GROUP BY page_id, category, link)"""


@query(lambda: _links_sql() + " SELECT page_id, category, link FROM links")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_links(_rich_pages(spark, sf), ["page_id"], base="url").drop("pos")


@query(lambda: _links_sql() + " SELECT category, count(*) AS links FROM links GROUP BY category")
def page_link_totals(spark: SparkSession, sf: str) -> DataFrame:
    return pages.link_counts(pages.page_links(_rich_pages(spark, sf), ["page_id"], base="url"))


def _link_table_sql() -> str:
    cells = ", ".join(
        f"count(*) FILTER (category = '{c}') AS {c}_count, "
        f"coalesce(string_agg(link, ',' ORDER BY pos) FILTER (category = '{c}'), '') AS {c}_links"
        for c in html.CATEGORIES
    )
    return _links_sql() + f" SELECT page_id, count(*) AS total_links, {cells} FROM links GROUP BY page_id"


@query(_link_table_sql)
def page_link_table(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_link_table(_rich_pages(spark, sf), ["page_id"], base="url")


@query(
    lambda: f"""
    SELECT page_id, {q.unescape("'A &mdash; b&#8217;s caf&eacute; &#xe9; &unknown; ' || regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title
    FROM pages WHERE length(html) > 500"""
)
def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Titles, with entities put into every page's title."""
    stored = pages.substantial_pages(table(spark, sf, "pages"))
    marked = F.regexp_replace("html", "(?i)(<title[^>]*>)", "$1A &mdash; b&#8217;s caf&eacute; &#xe9; &unknown; ")
    return pages.page_titles(stored.withColumn("html", marked), ["page_id"])


def _pieces(pattern: str) -> str:
    return (
        f"SELECT page_id, url, html, unnest(regexp_extract_all(html, {q.lit(pattern)}, 1)) AS piece FROM pages"
    )


def _text_of(pattern: str) -> str:
    """The text of the first piece of a page that matches, without scripts and styles."""
    piece = f"regexp_extract(html, {q.lit(pattern)}, 1)"
    piece = f"regexp_replace({piece}, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '<x>', 'g')"
    return (
        f"array_to_string(list_transform(string_split_regex({piece}, '(?s)<!--.*?-->|<[^>]+>'), "
        f"lambda x: {q.strip(q.unescape('x'))}), '')"
    )


_ARTICLE_TEXT = _text_of("(?s)<article>(.*?)</article>")

# Elements of the stored pages that the default selectors find: a paragraph is plain
# text up to the next tag, after an optional <b>; headings and list items hold text alone.
_ELEMENTS_SQL = f"""
    el AS (
      SELECT page_id, url, html, selector, {q.strip(q.unescape("piece"))} AS text FROM (
        SELECT *, 'h1' AS selector FROM ({_pieces('(?s)<h1[^>]*>([^<]*)')})
        UNION ALL SELECT *, 'p' FROM ({_pieces('(?s)<p>(?:<b>)?([^<]*)')})
        UNION ALL SELECT *, 'li' FROM ({_pieces('(?s)<li><a[^>]*>([^<]*)')}))
      UNION ALL SELECT page_id, url, html, 'article', {_ARTICLE_TEXT} FROM pages)"""


@query(f"WITH {_ELEMENTS_SQL} SELECT page_id, selector, text FROM el WHERE text <> ''")
def page_elements(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.page_elements(texts(spark, sf, "pages"), ["page_id"])
    return found.select("page_id", "selector", "text")


@query(
    f"""
    SELECT page_id, text FROM (
      SELECT page_id, {q.strip(q.unescape("unnest(string_split_regex(body, '(?s)<!--.*?-->|<[^>]+>'))"))} AS text
      FROM (SELECT page_id, regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!DOCTYPE[^>]*>', '<x>', 'g') AS body FROM pages))
    WHERE text <> ''"""
)
def page_text_nodes(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.page_elements(texts(spark, sf, "pages"), ["page_id"], selectors=["#text"])
    return found.select("page_id", "text")


@query(f"SELECT page_id, {_ARTICLE_TEXT} AS text FROM pages WHERE {_ARTICLE_TEXT} <> ''")
def page_articles(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.page_elements(texts(spark, sf, "pages"), ["page_id"], selectors=["article"])
    return found.select("page_id", "text")


# Selector forms, and which of the list items put into each page they find.
_SELECTOR_FORMS = {
    "ul.menu > li:nth-child(2n+1)": "n % 2 = 1",
    "ul.menu li:nth-last-child(-n + 2)": "n > items - 2",
    "ul.menu li:nth-of-type(even)": "n % 2 = 0",
    "ul.menu li:only-child": "items = 1",
    "ul.menu li + li": "n > 1",
    "ul.menu li.odd ~ li:not(.odd)": "n % 2 = 0",
    "ul.menu li:not(.odd, :last-child)": "n % 2 = 0 AND n <> items",
    "ul.menu li:first-child, ul.menu li[class~=last]": "n = 1 OR n = items",
    "ul.menu li[data-k^='k1']": "n = 1",
    "ul.menu li[data-k$='9Z' i]": "page_id % 10 = 9",
    'ul.menu li[data-k*="-1"]': "page_id::VARCHAR LIKE '1%'",
    "ul.menu li[lang|=en]": "n % 3 = 0",
    "article ~ ul:is(.menu) li:nth-child(3)": "n = 3",
}


@query(
    lambda: "WITH i AS (SELECT page_id, items, unnest(range(1, items + 1)) AS n FROM (SELECT page_id, page_id % 7 + 1 AS items FROM pages)) "
    + " UNION ALL ".join(
        f"SELECT page_id, {q.lit(s)} AS selector, 'item ' || n AS text FROM i WHERE {where}" for s, where in _SELECTOR_FORMS.items()
    )
)
def page_selectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every form of selector, on a list whose items grow with the page's number."""
    stored = texts(spark, sf, "pages").withColumn("items", F.col("page_id") % 7 + 1)
    item = F.expr(
        """transform(sequence(1, items), n -> concat('<li class="', if(n % 2 = 1, 'odd', 'even'), if(n = items, ' last', ''),
        '" lang="', if(n % 3 = 0, 'en-US', 'eng'), '" data-k="k', n, '-', page_id, 'z">item ', n, '</li>'))"""
    )
    menu = F.concat(F.lit('<ul class="menu">'), F.array_join(item, ""), F.lit("</ul>"))
    rich = stored.select("page_id", F.replace("html", F.lit("</article>"), F.concat(F.lit("</article>"), menu)).alias("html"))
    found = pages.page_elements(rich, ["page_id"], selectors=list(_SELECTOR_FORMS))
    return found.select("page_id", "selector", "text")


@query(
    f"""
    SELECT DISTINCT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || {q.unescape("href")} AS link
    FROM ({_PAGE_HREFS} UNION ALL SELECT page_id, url, '/caf&eacute;&#8217;s' AS href FROM pages)"""
)
def internal_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links to the own host, one with entities put into every page."""
    stored = texts(spark, sf, "pages")
    marked = F.concat("html", F.lit('<a href="/caf&eacute;&#8217;s">x</a>'))
    return pages.internal_links(stored.withColumn("html", marked), ["page_id"])


@query(
    rf"""
    SELECT page_id, link, max(CASE WHEN length(t) > 8 THEN 3 ELSE 0 END
        + CASE WHEN length(t) > 40 THEN 2 ELSE 0 END
        + CASE WHEN contains(link, '?') THEN 0 ELSE 2 END) AS priority
    FROM (
      SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*')
             || {q.unescape("regexp_extract(a, 'href=" + '"([^"]*)' + "', 1)")} AS link,
             {q.strip(q.unescape("regexp_extract(a, '>([^<]*)', 1)"))} AS t
      FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*')) AS a FROM
            (SELECT page_id, url, html || '<div><a href="/picture?of=' || page_id || '"><img src="x.png"></a></div>' AS html FROM pages)))
    GROUP BY page_id, link ORDER BY priority DESC, link"""
)
def internal_link_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Priorities of links, with a picture's link put into every page."""
    stored = texts(spark, sf, "pages")
    picture = F.format_string('<div><a href="/picture?of=%d"><img src="x.png"></a></div>', "page_id")
    found = pages.link_priorities(stored.withColumn("html", F.concat("html", picture)), ["page_id"])
    return found.orderBy(F.desc("priority"), "link")


# --- keywords --------------------------------------------------------------

_KEYWORDS = ("the and", "Nicht", "que la", "tionment", "  Estre ", "unfindable qqqq")


def _form_case(keyword: str) -> str:
    forms = keywords.keyword_forms(keyword)
    return "CASE " + " ".join(f"WHEN contains(lower(text), {q.lit(f)}) THEN {q.lit(f)}" for f in forms) + " END"


def _matches_sql() -> str:
    cases = " UNION ALL ".join(
        f"SELECT page_id, url, html, selector, text, {q.lit(k)} AS keyword, {_form_case(k)} AS matched_keyword FROM el"
        for k in _KEYWORDS
    )
    return f"WITH {_ELEMENTS_SQL}, m AS (SELECT * FROM ({cases}) WHERE text <> '' AND matched_keyword IS NOT NULL)"


@query(lambda: _matches_sql() + " SELECT page_id, selector, keyword, matched_keyword, text FROM m")
def keyword_matches(spark: SparkSession, sf: str) -> DataFrame:
    elements = pages.page_elements(texts(spark, sf, "pages"), ["page_id"])
    found = keywords.keyword_matches(elements, _KEYWORDS)
    return found.select("page_id", "selector", "keyword", "matched_keyword", "text")


def _search_sql() -> str:
    title = q.unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    # An article's surroundings are the body, a list item's its list, all else is in the article.
    around = f"""CASE selector WHEN 'article' THEN {_text_of("(?s)<body>(.*)$")}
        WHEN 'li' THEN {_text_of("(?s)<ul>(.*?)</ul>")} ELSE {_ARTICLE_TEXT} END"""
    return (
        _matches_sql()
        + f""" SELECT page_id, url, title, selector, text, keyword, matched_keyword,
        CASE WHEN length(around) > length(text) AND length(around) < 2000 THEN around END AS context
        FROM (SELECT *, {title} AS title, {around} AS around FROM m)"""
    )


@query(_search_sql)
def keyword_search(spark: SparkSession, sf: str) -> DataFrame:
    found = stages.keyword_search(texts(spark, sf, "pages"), _KEYWORDS)
    return found.select(
        "page_id", "url", "title", "selector", "text", "keyword", "matched_keyword", "context"
    )


def _report_sql() -> str:
    cases = " UNION ALL ".join(
        f"SELECT doc_id, source, text, {q.lit(k)} AS keyword, {_form_case(k)} AS f FROM documents"
        for k in _KEYWORDS
    )
    names = ", ".join(f"({q.lit(k)})" for k in _KEYWORDS)
    return f"""
    WITH k(keyword) AS (VALUES {names}),
    m AS (SELECT * FROM ({cases}) WHERE f IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY doc_id) AS n FROM m),
    a AS (SELECT keyword, count(*) AS c, count(DISTINCT source) AS u,
            string_agg(text[:100] || '...', ' | ' ORDER BY doc_id) FILTER (n <= 3) AS s FROM r GROUP BY keyword)
    SELECT k.keyword, coalesce(c, 0) AS "count", coalesce(u, 0) AS unique_urls,
      CASE WHEN c IS NULL THEN 'No matches found' ELSE 'Completed' END AS status,
      coalesce(s, '') AS samples, (SELECT count(*) FROM documents) AS total_pages_visited
    FROM k LEFT JOIN a ON k.keyword = a.keyword"""


@query(_report_sql)
def keyword_report(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.col("source").alias("url"), "text")
    found = keywords.keyword_matches(docs, _KEYWORDS)
    names = spark.createDataFrame([(k,) for k in _KEYWORDS], "keyword string")
    report = keywords.keyword_report(found, names, ["doc_id"], pages=docs)
    return report.withColumn("samples", F.array_join("sample_matches", " | ")).drop("sample_matches")


@query(
    """
    WITH k AS (SELECT DISTINCT text AS keyword FROM benchmark),
    f AS (
      SELECT keyword, 0 AS rank, lower(trim(keyword)) AS form FROM k
      UNION ALL
      SELECT keyword, i, p FROM (
        SELECT keyword, unnest(w) AS p, generate_subscripts(w, 1) AS i
        FROM (SELECT keyword, string_split_regex(lower(trim(keyword)), '\\s+') AS w FROM k)) WHERE length(p) > 3)
    SELECT doc_id, keyword, arg_min(form, rank) AS matched_keyword
    FROM documents JOIN f ON form <> '' AND contains(lower(text), form) GROUP BY doc_id, keyword"""
)
def keyword_table_matches(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    names = table(spark, sf, "benchmark").select(F.col("text").alias("keyword"))
    return keywords.keyword_table_matches(docs, names).drop("text")


@query(
    lambda: "SELECT doc_id, keyword, f AS matched_keyword FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {q.lit(k)} AS keyword, CASE "
        + " ".join(f"WHEN contains(text, {q.lit(f)}) THEN {q.lit(f)}" for f in (k.lower(), k.upper(), k.capitalize()))
        + " END AS f FROM documents"
        for k in ("nicht", "estre")
    )
    + ") WHERE f IS NOT NULL"
)
def keyword_exact_case(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return keywords.exact_case_matches(docs, ["nicht", "estre"]).drop("text")


# --- link graph ------------------------------------------------------------

# SQL recursion ends at a depth that no page has; a test compares it with the walk.
_DEEPER_THAN_ANY_PAGE = 10

# Every stored page links to the root of its host, every root to its pages, and
# pages keep their own links.
_GRAPH_SQL = f"""
    edges AS (
      SELECT DISTINCT url AS src, regexp_extract(url, '^[a-z]+://[^/?#]*') || '/' AS dst FROM pages
      UNION SELECT regexp_extract(url, '^[a-z]+://[^/?#]*') || '/', url FROM pages
      UNION SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]*') || {q.unescape("href")} FROM ({_PAGE_HREFS})),
    seeds AS (SELECT regexp_extract(html, '<html lang="([a-z]*)"', 1) AS seed, min(url) AS node FROM pages GROUP BY 1),
    walk AS (
      SELECT seed, node, 0 AS depth FROM seeds
      UNION SELECT seed, dst, depth + 1 FROM walk JOIN edges ON node = src WHERE depth < {_DEEPER_THAN_ANY_PAGE}),
    reach AS (SELECT seed, node, min(depth) AS depth FROM walk GROUP BY seed, node)"""


def _graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    stored = texts(spark, sf, "pages")
    root = F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0), F.lit("/"))
    own = pages.internal_links(stored, ["url"]).select(F.col("url").alias("src"), F.col("link").alias("dst"))
    up = stored.select(F.col("url").alias("src"), root.alias("dst"))
    down = stored.select(root.alias("src"), F.col("url").alias("dst"))
    language = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    seeds = stored.groupBy(language.alias("seed")).agg(F.min("url").alias("node"))
    return own.unionByName(up).unionByName(down), seeds


@query(f"WITH RECURSIVE {_GRAPH_SQL} SELECT seed, node, depth FROM reach")
def link_reach(spark: SparkSession, sf: str) -> DataFrame:
    edges, seeds = _graph(spark, sf)
    return linkgraph.link_reach(edges, seeds)


@query(
    f"""WITH RECURSIVE {_GRAPH_SQL} SELECT seed, node, depth FROM (
      SELECT *, row_number() OVER (PARTITION BY seed ORDER BY depth, node COLLATE "C") AS n FROM reach) WHERE n <= 20"""
)
def link_reach_bounded(spark: SparkSession, sf: str) -> DataFrame:
    edges, seeds = _graph(spark, sf)
    return linkgraph.link_reach(edges, seeds, max_pages=20)


# --- column roles ----------------------------------------------------------


_WALK_PAGES = 9


def _walk_sql(levels: int = 10) -> str:
    """The queue level by level; no page lies deeper than so many levels."""
    parts = [
        "links AS (SELECT src, dst, max(CASE WHEN length(dst) > 40 THEN 3 ELSE 0 END + CASE WHEN contains(dst, '?') THEN 0 ELSE 2 END) AS priority "
        "FROM edges GROUP BY src, dst)",
        "v0 AS (SELECT seed, node, 0 AS depth, 0 AS visit FROM seeds)",
    ]
    for i in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT * FROM v{k}" for k in range(i))
        parts.append(
            f"c{i} AS (SELECT seed, dst AS node, min(struct_pack(v := visit, w := -priority)) AS place FROM v{i - 1} JOIN links ON node = src "
            f"WHERE (seed, dst) NOT IN (SELECT (seed, node) FROM ({seen})) GROUP BY seed, dst)"
        )
        parts.append(
            f"v{i} AS (SELECT seed, node, {i} AS depth, (n + used - 1)::INTEGER AS visit FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY seed ORDER BY place, node) AS n FROM c{i}) "
            f"JOIN (SELECT seed, count(*) AS used FROM ({seen}) GROUP BY seed) USING (seed) WHERE n + used <= {_WALK_PAGES})"
        )
    return f"WITH RECURSIVE {_GRAPH_SQL}, " + ", ".join(parts) + " " + " UNION ALL ".join(f"SELECT * FROM v{k}" for k in range(levels + 1))


@query(lambda: _walk_sql())
def priority_walk(spark: SparkSession, sf: str) -> DataFrame:
    """The first pages that a queue ordered by link priority visits from each seed."""
    edges, seeds = _graph(spark, sf)
    points = F.when(F.length("dst") > 40, 3).otherwise(0) + F.when(F.col("dst").contains("?"), 0).otherwise(2)
    return linkgraph.priority_walk(edges.withColumn("priority", points), seeds, _WALK_PAGES)


def _profile_sql(name: str, columns: str) -> Callable[[], str]:
    pairs = dict(c.split(":") for c in columns.split())
    return lambda: q.profile(name, pairs)


@query(_profile_sql("documents", "doc_id:bigint text:string lang:string source:string n_chars:bigint"))
def detect_text_columns(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile_columns(texts(spark, sf, "documents"))


@query(_profile_sql("pages", "page_id:bigint url:string html:string"))
def detect_url_columns(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile_columns(texts(spark, sf, "pages"))


_DATED = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"


@query(
    lambda: q.profile(
        "(SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE "
        + _DATED
        + " END AS placed, "
        + _DATED
        + " AS dated FROM orders)",
        {"o_orderkey": "bigint", "placed": "string", "dated": "string"},
    )
)
def detect_datetime_columns(spark: SparkSession, sf: str) -> DataFrame:
    printed = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(printed).alias("placed"),
        printed.alias("dated"),
    )
    return quality.profile_columns(orders)


@query(_profile_sql("conversations", "conv_id:bigint turn:bigint role:string text:string"))
def detect_code_columns(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile_columns(texts(spark, sf, "conversations"))


@query(
    lambda: f"SELECT bool_or(regexp_matches(html, {q.lit(q.CODE)})) OR bool_or(regexp_matches(url, {q.lit(q.CODE)})) AS has_code FROM pages"
)
def table_contains_code(spark: SparkSession, sf: str) -> DataFrame:
    return quality.contains_code(texts(spark, sf, "pages"), ["url", "html"])


# --- missing values, sparse rows, duplicates -------------------------------

_GAPPY_SQL = """
    SELECT event_id, user_id,
      CASE event_type WHEN 'error' THEN '' WHEN 'click' THEN 'NULL' ELSE event_type END AS event_type,
      CASE WHEN value >= 10 THEN value END AS value,
      CASE WHEN value < 20 THEN props END AS props FROM events"""


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.when(kind == "error", "").when(kind == "click", "NULL").otherwise(kind).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("value") < 20, F.col("props")).alias("props"),
    )


_FILLED_SQL = f"SELECT event_id, user_id, CASE WHEN event_type NOT IN ('', 'NULL') THEN event_type END AS event_type, value, props FROM ({_GAPPY_SQL})"


@query(_FILLED_SQL)
def null_words(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_words(_gappy(spark, sf))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count({c}) AS present FROM ({_FILLED_SQL})"
        for c in ("event_id", "user_id", "event_type", "value", "props")
    )
)
def missing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_counts(quality.null_words(_gappy(spark, sf)))


@query(
    f"""
    SELECT * FROM ({_FILLED_SQL}) WHERE (event_id IS NOT NULL)::INT + (user_id IS NOT NULL)::INT
      + (event_type IS NOT NULL)::INT + (value IS NOT NULL)::INT + (props IS NOT NULL)::INT >= 4"""
)
def drop_sparse_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_sparse(quality.null_words(_gappy(spark, sf)), 0.2)


@query(
    f"SELECT * FROM ({_FILLED_SQL}) WHERE event_type IS NOT NULL AND value IS NOT NULL AND props IS NOT NULL"
)
def drop_incomplete_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_incomplete(quality.null_words(_gappy(spark, sf)))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM customer"
        for c, t in (
            *(("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int")),
            *(("c_acctbal", "double"), ("c_mktsegment", "string")),
        )
    )
)
def column_overview(spark: SparkSession, sf: str) -> DataFrame:
    return quality.column_overview(table(spark, sf, "customer"))


@query(
    "SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE c_mktsegment END AS segment FROM customer"
)
def nan_and_empty_lists(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    marked = F.when(segment == "BUILDING", "NaN").when(segment == "MACHINERY", " [] ").otherwise(segment)
    customers = table(spark, sf, "customer").select("c_custkey", marked.alias("segment"))
    return cleaning.rewrite(customers, {"segment": missing.nan_or_empty_list_to_null})


@query(
    """
    SELECT doc_id, lang, source, n_chars, text FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1"""
)
def dedup_documents(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dedup_rows(table(spark, sf, "documents"), ["text"], ["doc_id"])


@query("SELECT DISTINCT lang, text FROM documents")
def drop_duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dedup_rows(table(spark, sf, "documents").select("lang", "text"), ["lang", "text"])


# --- dates -----------------------------------------------------------------


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS placed FROM orders"
)
def standardize_datetime_column(spark: SparkSession, sf: str) -> DataFrame:
    loose = F.date_format("o_orderdate", "yyyy-M-d H:m:s")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "pending").otherwise(loose).alias("placed")
    )
    return cleaning.standardize_datetimes(orders, ["placed"])


@query("SELECT 'placed' AS \"column\", count(*) FILTER (o_orderstatus = 'P') AS unparsed FROM orders")
def unparsed_datetimes(spark: SparkSession, sf: str) -> DataFrame:
    loose = F.date_format("o_orderdate", "yyyy-M-d H:m:s")
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(loose).alias("placed")
    )
    return cleaning.unparsed_datetimes(orders, ["placed"])


@query(
    """
    SELECT o_orderkey, 'made ' || d || ', seen ' || d[:7] || '; id '
      || CASE WHEN year(o_orderdate) >= 2000 THEN d ELSE strftime(o_orderdate, '%Y%m%d') END
      || ' at ' || s || ' us ' || s || ' short ' || s || ' long ' || s || ' clock ' || d || ' 07:08:09 end' AS t
    FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS s FROM orders)"""
)
def dates_in_text(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")

    def shown(form: str) -> Column:
        return F.date_format(day, form)

    written = F.concat(
        *(F.lit("made "), shown("MMMM d yyyy"), F.lit(", seen "), F.upper(shown("MMMM yyyy"))),
        *(F.lit("; id "), shown("yyyyMMdd"), F.lit(" at "), shown("yyyy-MM-dd'T'HH:mm:ss")),
        *(F.lit(" us "), shown("M/d/yyyy"), F.lit(" short "), shown("MMM d, yyyy")),
        *(F.lit(" long "), shown("EEEE, MMMM d, yyyy"), F.lit(" clock ")),
        *(shown("M/d/yyyy"), F.lit(" 7:08:09 end")),
    )
    orders = texts(spark, sf, "orders").select("o_orderkey", written.alias("t"))
    return cleaning.standardize_datetimes(orders, text_columns=["t"], this_year=2025)


# --- code, markup, literals ------------------------------------------------

_FENCED = "'intro ```python\\nprint(' || source || ')\\n``` mid ```\\n' || text || '\\n``` end'"


@query(
    lambda: f"""
    SELECT doc_id, true AS has_code, 'intro [CODE BLOCK: print(' || source || ')] mid [CODE BLOCK: ' ||
      CASE WHEN length(b) > 30 THEN b[:30] || '...]' ELSE b || ']' END || ' end' AS t
    FROM (SELECT doc_id, source, {q.strip("text")} AS b FROM documents)"""
)
def code_blocks(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", F.expr(_FENCED).alias("t"))
    marked = docs.select("doc_id", code.has_code(F.col("t")).alias("has_code"), "t")
    return cleaning.rewrite(marked, {"t": code.label_code_blocks})


@query(lambda: f"SELECT page_id, {q.rx('html', '<[^>]+>', ' ')} AS t FROM pages")
def strip_html(spark: SparkSession, sf: str) -> DataFrame:
    stored = texts(spark, sf, "pages").select("page_id", F.col("html").alias("t"))
    return cleaning.rewrite(stored, {"t": code.strip_markup})


@query(
    "SELECT p_partkey, p_brand || ' ' || p_name AS t, p_brand || ' \"' || p_name || ', x\" ' || p_size AS u FROM part"
)
def list_literals(spark: SparkSession, sf: str) -> DataFrame:
    """The simple rule cuts at every comma, also inside quotes; the other one only between items."""
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.expr("concat('[\\'', p_brand, '\\', \"', replace(p_name, ' ', ' , '), '\"]')").alias("t"),
        F.expr("concat('[', p_brand, ', \"', p_name, ', x\", ', p_size, ']')").alias("u"),
    )
    return cleaning.rewrite(parts, {"t": code.join_list_literal, "u": code.flatten_literals})


@query("SELECT event_id, regexp_extract(props, '[0-9]+') AS t FROM events")
def dict_literals(spark: SparkSession, sf: str) -> DataFrame:
    events = texts(spark, sf, "events").select("event_id", F.col("props").alias("t"))
    return cleaning.clean_code(events, ["t"])


@query("SELECT event_id, regexp_extract(props, '[0-9]+') || ' ' || event_type || ' ' || user_id || ' end' AS t FROM events")
def nested_literals(spark: SparkSession, sf: str) -> DataFrame:
    nested = F.expr("concat('[', props, ', [', event_type, ', [', user_id, ']], end]')")
    events = texts(spark, sf, "events").select("event_id", nested.alias("t"))
    return cleaning.clean_code(events, ["t"])


@query(
    """SELECT event_id, event_type || ' "a, ]" ' || regexp_extract(props, '[0-9]+') || ' b, c ' || user_id AS t FROM events"""
)
def deep_literals(spark: SparkSession, sf: str) -> DataFrame:
    """Lists and dicts inside a dict inside a list, with commas and brackets in quotes."""
    deep = F.expr("""concat('[{"x": [', event_type, ', "a, ]"], "y": ', props, ', \\'z\\': \\'b, c\\'}, [', user_id, ']]')""")
    return cleaning.clean_code(texts(spark, sf, "events").select("event_id", deep.alias("t")), ["t"])


@query("SELECT c_custkey, ltrim(c_custkey::VARCHAR, '0') AS code, c_custkey::VARCHAR AS kept FROM customer")
def leading_zeros(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    customers = table(spark, sf, "customer").select(
        "c_custkey", padded.alias("code"), padded.alias("kept")
    )
    return cleaning.rewrite(
        customers,
        {
            "code": code.strip_leading_zeros,
            "kept": lambda c: code.strip_leading_zeros(c, keep_one=True),
        },
    )


# --- runs ------------------------------------------------------------------


@query(
    lambda: f"""
    SELECT doc_id, {q.normalized(q.clean("text"), q.stop_list("english"))} AS text, lang, source, n_chars
    FROM documents"""
)
def process_documents(spark: SparkSession, sf: str) -> DataFrame:
    return stages.process_table(texts(spark, sf, "documents"))


@query(
    lambda: f"""
    SELECT page_id, {q.standard_url("url")} AS url,
      {q.clean(q.rx("html", "<[^>]+>", " "))} AS html FROM pages"""
)
def process_pages(spark: SparkSession, sf: str) -> DataFrame:
    spec = CleanSpec(clean_code_if_found=True)
    return stages.process_table(texts(spark, sf, "pages"), spec, normalize=False)


@query(
    """
    SELECT ltrim(page_id::VARCHAR, '0') AS "Page", url AS "Url", regexp_extract(html, '<html lang="([a-z]*)"', 1) || ' x' AS "Tags"
    FROM pages"""
)
def structure_dataset(spark: SparkSession, sf: str) -> DataFrame:
    language = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    stored = table(spark, sf, "pages").select(
        F.lpad(F.col("page_id").cast("string"), 9, "0").alias("page"),
        "url",
        F.concat(F.lit("['"), language, F.lit("', 'x']")).alias("tags"),
    )
    mapping = {"page": "Page", "url": "Url", "tags": "Tags", "absent": "Absent"}
    return structure.structure_table(stored, ["tags"], mapping=mapping)


@query(
    lambda: f"""
    SELECT doc_id AS "Doc Id", ltrim({q.clean("text", split=True)}, '0') AS "Text",
      lang AS "Lang", source AS "Source" FROM documents"""
)
def two_stage_run(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return stages.two_stage_run(docs, normalize=False)


_TUTORIAL_HTML = q.rx("html", "<[^>]+>", " ")


@query(lambda: f"SELECT page_id, url, {_TUTORIAL_HTML} AS html FROM pages")
def tutorial_run(spark: SparkSession, sf: str) -> DataFrame:
    cleaned, _ = stages.tutorial_run(texts(spark, sf, "pages"))
    return cleaned


@query(
    """
    SELECT page_id AS "Id", url AS "URL", true AS "Is URL Valid" FROM pages
    WHERE NOT contains(html, '<html lang="fr">')"""
)
def tidy_run(spark: SparkSession, sf: str) -> DataFrame:
    french = F.col("html").contains('<html lang="fr">')
    stored = table(spark, sf, "pages").withColumn("html", F.when(~french, F.col("html")))
    return stages.tidy_run(
        stored,
        drop=["html", "not_there"],
        rename={"page_id": "Id", "url": "URL"},
        order=["URL", "Id"],
        url_column="URL",
    )


@query(
    """
    SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
      strftime(o_orderdate, '%d/%m/%Y') AS placed FROM orders ORDER BY placed, status"""
)
def configured_run(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "None").otherwise(F.col("o_orderstatus")).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed"),
    )
    rules = [{"column": "placed", "format": "%d/%m/%Y"}]
    return stages.configured_run(
        orders,
        {
            "data_cleaning": {
                "remove_duplicates": True,
                "handle_missing_values": True,
                "format_rules": rules,
            },
            "file_organization": {"sort_by": ["placed", "status"]},
        },
    )


# --- sources, sinks, streams -----------------------------------------------


def _ragged_csv(spark: SparkSession, sf: str, extension: str = "") -> str:
    """Customers as CSV text; one segment has a field too many, one too few."""
    path = scratch_path(spark, "ragged") + extension
    quoted = F.format_string('%s,"%s, ""Ltd""",%s', "c_custkey", "c_name", "c_mktsegment")
    line = (
        F.when(
            F.col("c_mktsegment") == "BUILDING",
            F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment", F.lit("extra")),
        )
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat_ws(",", "c_custkey", "c_name"))
        .otherwise(quoted)
    )
    lines = table(spark, sf, "customer").select(line.alias("value"))
    lines.write.option("lineSep", "\n").text(path)
    return path


def _read_ragged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # Part files carry no header line here, so the names are given.
    path = _ragged_csv(spark, sf)
    return readers.read_csv_with_rejects(spark, path, names=["key", "name", "segment"])


@query(
    """
    SELECT c_custkey::VARCHAR AS "key", c_name || ', "Ltd"' AS name, c_mktsegment AS segment
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""
)
def tolerant_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _ragged_csv(spark, sf)
    return readers.read_csv_tolerant(spark, path, names=["key", "name", "segment"])


@query(
    """
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey || ',' || c_name || ',BUILDING,extra'
      ELSE c_custkey || ',' || c_name END AS rejected
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"""
)
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = _read_ragged(spark, sf)
    return rejected.select(F.col("_rejected").alias("rejected"))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    docs = table(spark, sf, "documents")
    writers.write_csv(docs, path, compressed=True)
    return readers.read_csv(spark, path, docs.schema)


@query("SELECT doc_id, text || chr(10) || '\"' || source || '\", end' AS text, lang, n_chars FROM documents")
def csv_in_byte_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Fields with newlines, quotes and commas, read back in byte ranges of the files."""
    path = scratch_path(spark, "ranges")
    text = F.concat("text", F.lit('\n"'), "source", F.lit('", end'))
    docs = table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang", "n_chars")
    writers.write_csv(docs, path)
    return readers.read_csv(spark, path, "doc_id long, text string, lang string, n_chars long", split=True)


@query(
    "SELECT o_orderkey, 'placed <' || strftime(o_orderdate, '%Y/%m/%d') || '> or [soon]' AS t FROM orders"
)
def dates_by_own_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Dates in running text found by own patterns, one of which finds no date."""
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("placed <on "), stamp, F.lit("> or [at soon]")).alias("t")
    )
    patterns = (r"on ([0-9-]+T[0-9:]+)", r"at ([a-z]+)")
    return cleaning.standardize_datetimes(orders, text_columns=["t"], strftime="%Y/%m/%d", patterns=patterns)


@query("SELECT event_id, 'u' || user_id AS owner, value AS inner_value, event_type || ' x' AS kinds FROM events")
def nested_json(spark: SparkSession, sf: str) -> DataFrame:
    """Records with objects and arrays, written and read with an inferred schema."""
    path = scratch_path(spark, "nested")
    owner = F.struct(F.concat(F.lit("u"), "user_id").alias("name"), F.struct("value").alias("of"))
    kinds = F.array("event_type", F.lit("x")).alias("kinds")
    writers.write_json(table(spark, sf, "events").select("event_id", owner.alias("owner"), kinds), path)
    found = readers.read_json(spark, path, lines=True)
    return found.select(
        "event_id", F.col("owner.name").alias("owner"), F.col("owner.of.value").alias("inner_value"), F.array_join("kinds", " ").alias("kinds")
    )


@query(
    "SELECT form, count(*) AS n, count(DISTINCT c_custkey) AS keys, sum(length(c_mktsegment))::BIGINT AS chars FROM customer, "
    "(VALUES ('csv'), ('json'), ('parquet')) f(form) GROUP BY form"
)
def file_in_three_formats(spark: SparkSession, sf: str) -> DataFrame:
    """A file run that writes three formats, all read back."""
    path, out = scratch_path(spark, "input"), scratch_path(spark, "formats")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    customers.write.parquet(path)
    forms = ("csv", "json", "parquet")
    given = {c: () for c in ("text_columns", "url_columns", "datetime_columns")}
    stages.process_file(spark, path, out, formats=forms, kind="parquet", name="customers", **given)
    read = {
        "csv": readers.read_csv(spark, f"{out}/cleaned_customers.csv"),
        "json": readers.read_json(spark, f"{out}/cleaned_customers.json", lines=True),
        "parquet": spark.read.parquet(f"{out}/cleaned_customers.parquet"),
    }
    parts = [df.select(F.lit(f).alias("form"), "c_custkey", "c_mktsegment") for f, df in read.items()]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("form").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("c_custkey").alias("keys"),
        F.sum(F.length("c_mktsegment")).alias("chars"),
    )


@query("SELECT 'part' || (c_custkey % 3) AS source_file, count(*) AS n, sum(c_nationkey)::BIGINT AS nations FROM customer GROUP BY 1")
def folder_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one schema in a folder, read as one table with the names that the reader gives."""
    path = scratch_path(spark, "folder")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    for i in range(3):
        writers.write_csv(customers.filter(F.col("c_custkey") % 3 == i), f"{path}/part{i}.csv")
    found = readers.read_folder(spark, f"{path}/*", schema="c_custkey long, c_nationkey long")
    return found.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_nationkey").alias("nations")
    )


@query(
    """
    SELECT 'people' AS source_file, c_custkey::VARCHAR AS "key", c_name || chr(10) || 'x' AS name, NULL AS brand, c_mktsegment AS kind FROM customer
    UNION ALL SELECT 'parts', p_partkey::VARCHAR, p_name, p_brand, NULL FROM part"""
)
def mixed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two schemas, their columns in different order, as one table from one scan."""
    path = scratch_path(spark, "mixed")
    name = F.concat("c_name", F.lit("\nx")).alias("name")
    people = table(spark, sf, "customer").select("c_mktsegment", name, "c_custkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    writers.write_csv(people.toDF("kind", "name", "key"), f"{path}/people.csv")
    writers.write_csv(parts.toDF("key", "brand", "name"), f"{path}/parts.csv")
    return readers.read_mixed_csv(spark, f"{path}/*").select("source_file", "key", "name", "brand", "kind")


@query(
    """
    SELECT 'cleaned' AS run, source_file, count(*) AS n, sum(length(name))::BIGINT AS chars FROM (
      SELECT 'people' AS source_file, lower(replace(c_name, '#', ' ')) AS name FROM customer
      UNION ALL SELECT 'parts', lower(p_name) FROM part) GROUP BY source_file"""
)
def folder_run(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of files of two schemas cleaned in one job, an output for each file."""
    path, out = scratch_path(spark, "folder_in"), scratch_path(spark, "folder_out")
    people = table(spark, sf, "customer").select(F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"), "c_custkey")
    writers.write_csv(people, f"{path}/people.csv")
    writers.write_csv(table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name")), f"{path}/parts.csv")
    given = {"text_columns": ["name"], "url_columns": (), "datetime_columns": ()}
    stages.process_folder(spark, f"{path}/*", out, merged=True, sparse_threshold=1.0, **given)
    again = spark.read.option("header", True).csv(f"{out}/cleaned")
    return again.groupBy(F.lit("cleaned").alias("run"), "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("name")).alias("chars")
    )


@query("SELECT c_nationkey AS nation, c_custkey, c_name, c_acctbal FROM customer")
def json_array_records(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files that are an array of records each, one for every nation."""
    path = scratch_path(spark, "arrays")
    records = F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal")), {"pretty": "true"})
    arrays = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(records.alias("value"))
    arrays.write.partitionBy("nation").text(path)
    return readers.read_json(spark, path, "c_custkey long, c_name string, c_acctbal double, nation int")


@query(
    """
    SELECT c_custkey::VARCHAR AS "key", c_name || ', "Ltd"' AS name, c_mktsegment AS segment
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""
)
def unknown_extension(spark: SparkSession, sf: str) -> DataFrame:
    """A file of unknown kind: an error for the strict loader, CSV without its bad rows for the tolerant one."""
    path = _ragged_csv(spark, sf, ".data")
    try:
        readers.read_table(spark, path)
    except ValueError:
        return readers.read_table(spark, path, tolerant=True, names=["key", "name", "segment"])
    raise AssertionError("an unknown extension was read")


@query(
    "SELECT policy, c_custkey::VARCHAR AS \"key\", 'caf' || sign || ' ' || c_name AS name FROM customer, "
    "(VALUES ('ignore', ''), ('replace', chr(65533))) p(policy, sign)"
)
def bad_characters(spark: SparkSession, sf: str) -> DataFrame:
    """A Latin-1 file read as UTF-8: what cannot be read is dropped or replaced."""
    path = scratch_path(spark, "latin")
    name = F.concat(F.lit("caf\u00e9 "), "c_name").alias("name")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), name)
    rows.write.option("encoding", "ISO-8859-1").csv(path)
    found = None
    for policy in ("ignore", "replace"):
        part = readers.read_csv_tolerant(spark, path, bad_characters=policy, names=["key", "name"])
        part = part.select(F.lit(policy).alias("policy"), "key", "name")
        found = part if found is None else found.unionByName(part)
    return found


@query(
    """
    SELECT "column", count(v) AS non_null, count(*) - count(v) AS nulls FROM (
      SELECT unnest(['page_url', 'HTML_LINK', 'webpage']) AS "column", unnest([url, nullif(html, html), html]) AS v FROM pages)
    GROUP BY "column" ORDER BY 1"""
)
def url_columns_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Columns whose names suggest addresses, with what they hold."""
    named = texts(spark, sf, "pages").select(
        "page_id", F.col("url").alias("page_url"), F.lit(None).cast("string").alias("HTML_LINK"),
        F.col("html").alias("webpage"), F.col("html").alias("markup"),
    )
    wanted = [c for c in named.columns if quality.has_url_name(c)]
    profile = quality.profile_columns(named.select(wanted), measures=())
    return profile.select("column", "non_null", "nulls")


def _sample_place(key: str) -> str:
    return f"md5('42|' || coalesce({key}::VARCHAR, ''))"


@query(
    lambda: f"SELECT 'all' AS sample, event_id, event_type FROM (SELECT * FROM events ORDER BY {_sample_place('event_id')} LIMIT 100) "
    f"UNION ALL SELECT 'type', event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_sample_place('event_id')}) AS n "
    "FROM events) WHERE n <= 100"
)
def sample_exactly(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred events, and a hundred of each type."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    parts = {"all": quality.sample_exactly(events, 100, ["event_id"]), "type": quality.sample_exactly(events, 100, ["event_id"], ["event_type"])}
    found = [df.select(F.lit(k).alias("sample"), "event_id", "event_type") for k, df in parts.items()]
    return found[0].unionByName(found[1])


@query("SELECT event_id, user_id, event_type, value, props FROM events")
def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    writers.write_json(events, path, compressed=True)
    return readers.read_json(spark, path, events.schema, lines=True)


@query("SELECT c_mktsegment AS source_file, count(*) AS n, count(DISTINCT c_custkey) AS keys FROM customer GROUP BY 1")
def source_partitioned_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sources")
    customers = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "source_file")
    writers.write_csv(customers, path, by_source=True)
    again = spark.read.option("header", True).csv(path)
    return again.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("c_custkey").alias("keys")
    )


def _sink_sql() -> str:
    return (
        _matches_sql()
        + """ SELECT keyword, 'https://pages.example.org' AS website, count(*) AS items_count FROM m
        GROUP BY keyword"""
    )


@query(
    lambda: _matches_sql()
    + """ SELECT keyword, count(*) AS n, sum(length(text))::BIGINT AS chars FROM m GROUP BY keyword"""
)
def keyword_csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword files as CSV, header-only ones for keywords without a match, read back."""
    path = scratch_path(spark, "keyword_csv")
    found = stages.keyword_search(texts(spark, sf, "pages"), _KEYWORDS)
    writers.write_keyword_files(found, path, "https://pages.example.org", keywords=_KEYWORDS)
    again = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    return again.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    rf"""
    SELECT page_id, regexp_replace(url, '[?#].*$', '') || '?id=' || page_id AS url
    FROM (SELECT page_id, {q.standard_url('url')} AS url FROM pages)"""
)
def required_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """All parameters go but the required one."""
    odd = table(spark, sf, "pages").select(
        "page_id", F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("?utm_source=a&id="), "page_id", F.lit("&b=c#d")).alias("url")
    )
    spec = UrlSpec(drop_parameters=True, required_parameters=("id",))
    return cleaning.standardize_urls(odd, "url", spec).select("page_id", "url")


@query(
    lambda: f"SELECT page_id, array_to_string(list_transform([url, url || '#x', ''], lambda u: CASE WHEN u = '' THEN '' ELSE {q.standard_url('u')} END), ' ') AS urls FROM pages"
)
def url_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Each address of a list in its standard form."""
    stored = table(spark, sf, "pages")
    many = F.array("url", F.concat("url", F.lit("#x")), F.lit(""))
    return stored.select("page_id", F.array_join(urls.standardize_url_list(many), " ").alias("urls"))


@query(_sink_sql)
def keyword_sink(spark: SparkSession, sf: str) -> DataFrame:
    path, site = scratch_path(spark, "keywords"), "https://pages.example.org"
    found = stages.keyword_search(texts(spark, sf, "pages"), _KEYWORDS)
    writers.write_keyword_files(found, path, site, kind="json")
    rows = spark.read.json(f"{path}/data")
    return writers.keyword_envelopes(rows, site, "").drop("timestamp")


@query(_sink_sql)
def keyword_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Heads of the documents, with the matches counted that stand in them."""
    path, site = scratch_path(spark, "keywords"), "https://pages.example.org"
    found = stages.keyword_search(texts(spark, sf, "pages"), _KEYWORDS)
    writers.write_keyword_documents(found, path, site)
    lines = spark.read.text(path)
    head = F.from_json(F.concat("value", F.lit("]}")), "keyword string, website string, items_count long")
    match = F.from_json(F.ltrim("value", F.lit(",")), "matched_keyword string")["matched_keyword"]
    is_head = F.col("value").endswith('"data":[')
    counts = lines.filter(~is_head & (F.col("value") != "]}")).groupBy("keyword_file").agg(F.count(match).alias("items_count"))
    heads = lines.filter(is_head).select("keyword_file", head.alias("head"))
    return heads.join(counts, "keyword_file").select("head.keyword", "head.website", counts["items_count"])


@query(
    f"""SELECT DISTINCT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || {q.unescape("href")} AS value
    FROM ({_PAGE_HREFS})"""
)
def link_list_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "links")
    found = pages.internal_links(texts(spark, sf, "pages"), ["page_id"])
    joined = found.withColumn("link", F.concat_ws("\t", F.col("page_id").cast("string"), "link"))
    writers.append_links(joined, path)
    parts = F.split("value", "\t")
    return spark.read.text(path).select(
        parts[0].cast("bigint").alias("page_id"), parts[1].alias("value")
    )


@query(lambda: f"SELECT doc_id, {q.clean('text')} AS clean_text FROM documents")
def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "documents").schema
    stream = streams.read_stream(spark, f"{sf}/document[s].parquet", schema)
    out = scratch_path(spark, "stream")

    def job(docs: DataFrame) -> DataFrame:
        return cleaning.clean_text(docs.select("doc_id", F.col("text").alias("clean_text")), ["clean_text"])

    streams.run_stream(stream, job, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    stream = streams.read_stream(spark, f"{sf}/event[s].parquet", schema)
    out = scratch_path(spark, "stream")

    def job(events: DataFrame) -> DataFrame:
        kept = streams.drop_stream_duplicates(events, ["user_id", "event_type"], "ts", "3650 days")
        return kept.select("user_id", "event_type")

    streams.run_stream(stream, job, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    stream = streams.read_stream(spark, f"{sf}/event[s].parquet", schema)
    out = scratch_path(spark, "stream")

    def job(events: DataFrame) -> DataFrame:
        return streams.drop_repeated_arrivals(events.select("user_id", "event_type"), ["user_id", "event_type"], "1 day")

    streams.run_stream(stream, job, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)
