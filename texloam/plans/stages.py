"""Whole runs composed of the jobs."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from texloam.config import KNOWN_SPLIT_METHODS, CleanSpec
from texloam.functions import datetimes, html, missing, text, tokens, urls
from texloam.operators import keywords as keyword_jobs
from texloam.operators import pages as page_jobs
from texloam.operators import quality, structure
from texloam.operators.cleaning import clean_code, rewrite, string_columns
from texloam.sources import readers, writers


def process_table(
    df: DataFrame,
    spec: CleanSpec | None = None,
    text_columns: Sequence[str] | None = None,
    url_columns: Sequence[str] | None = None,
    datetime_columns: Sequence[str] | None = None,
    code_columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    normalize: bool = True,
    date_text_columns: Sequence[str] = (),
) -> DataFrame:
    """Clean a table by the role of its columns.

    Roles not given are detected in one aggregate; all rewriting is then one
    projection.  A column has one role: URL before text before datetime.
    ``normalize`` also drops stop words in text columns; dates
    inside ``date_text_columns`` are rewritten last.
    """
    spec = spec or CleanSpec()
    roles: dict[str, list[str]] = {}
    look_for_code = spec.clean_code_if_found and not spec.clean_code
    if text_columns is None or url_columns is None or datetime_columns is None or look_for_code:
        measures = ["words", "urls", "datetimes", *(["code"] if look_for_code else [])]
        profile = quality.profile_columns(
            df, measures, spec.datetime_format, spec.datetime_threshold
        )
        roles = quality.column_roles(profile)

    def chosen(given: Sequence[str] | None, role: str) -> list[str]:
        names = roles.get(role, []) if given is None else given
        return [c for c in names if c in df.columns and c not in exclude]

    url = chosen(url_columns, "url")
    texts = [c for c in chosen(text_columns, "text") if c not in url]
    dates = [c for c in chosen(datetime_columns, "datetime") if c not in (*url, *texts)]
    with_code = spec.clean_code or (look_for_code and bool(set(roles["code"]) & set(texts)))
    coded = (texts if code_columns is None else list(code_columns)) if with_code else []
    words = tokens.stop_words(spec.language, spec.custom_stop_words) if normalize else []

    def text_rule(value: Column) -> Column:
        value = text.clean(missing.null_to_blank(value), spec)
        if not normalize:
            return value
        kept = tokens.drop_stop_words(tokens.tokenize(value), words)
        return F.array_join(F.transform(kept, tokens.singular) if spec.plurals else kept, " ")

    if coded:
        df = clean_code(df, coded)
    rules = {c: text_rule for c in texts}
    rules |= {c: lambda v: urls.standardize_url(missing.null_to_blank(v), spec.url) for c in url}
    rules |= {c: lambda v: datetimes.standardize_datetime(v, spec.datetime_format) for c in dates}

    def with_dates(value: Column, rule: Callable[[Column], Column]) -> Column:
        return datetimes.dates_in_text(rule(value), spec.datetime_format, patterns=spec.datetime_patterns)

    for c in date_text_columns:
        before = rules.get(c, lambda v: v)
        rules[c] = functools.partial(with_dates, rule=before)
    return rewrite(df, rules)


def process_file(
    spark: SparkSession,
    path: str,
    out_folder: str | None = None,
    spec: CleanSpec | None = None,
    sparse_threshold: float = 0.5,
    formats: Sequence[str] = ("csv",),
    kind: str | None = None,
    name: str | None = None,
    **options: Any,
) -> DataFrame:
    """Load, drop sparse rows, clean, write ``cleaned_<name>`` in each format.

    ``name`` is the file's name without its extension unless given.  The table is
    computed once for all formats.
    """
    loaded = readers.read_table(spark, path, kind)
    cleaned = process_table(quality.drop_sparse(loaded, sparse_threshold), spec, **options)
    if out_folder:
        target = f"{out_folder.rstrip('/')}/cleaned_{name or _stem(path)}"
        writers.write_formats(cleaned, {form: f"{target}.{form}" for form in formats})
    return cleaned


def _stem(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]


def process_folder(
    spark: SparkSession,
    folder: str,
    out_folder: str,
    spec: CleanSpec | None = None,
    sparse_threshold: float = 0.5,
    kind: str | None = None,
    same_schema: bool = False,
    merged: bool = False,
    **options: Any,
) -> None:
    """Clean every file of a folder.

    Files of one schema are one table and one job, with an output folder per
    file; so are CSV files of any schemas with ``merged``, whose common table has
    the columns of all.  Otherwise each file is planned on its own.  Of files that differ in
    their extension alone, the output keeps the extension as ``_<extension>``.
    """
    if same_schema or merged:
        loaded = readers.read_mixed_csv(spark, folder) if merged else readers.read_folder(spark, folder, kind or "csv")
        data = [c for c in loaded.columns if c != "source_file"]
        loaded = quality.drop_sparse(loaded, sparse_threshold, data)
        options["exclude"] = [*options.get("exclude", ()), "source_file"]
        cleaned = process_table(loaded, spec, **options)
        writers.write_csv(cleaned, f"{out_folder.rstrip('/')}/cleaned", by_source=True)
        return
    paths = readers.list_files(spark, folder)
    met = Counter(map(_stem, paths))
    for path in paths:
        name = _stem(path) if met[_stem(path)] == 1 else path.rsplit("/", 1)[-1].replace(".", "_")
        process_file(spark, path, out_folder, spec, sparse_threshold, kind=kind, name=name, **options)


def two_stage_run(
    df: DataFrame,
    spec: CleanSpec | None = None,
    sparse_threshold: float = 0.3,
    exclude: Sequence[str] = ("id", "timestamp", "url"),
    url_column: str | None = None,
    normalize: bool = True,
    **roles: Any,
) -> DataFrame:
    """Clean with every split method, then structure with title-case names.

    Both stages are one lineage; nothing is written in between.
    """
    spec = spec or CleanSpec(split_methods=KNOWN_SPLIT_METHODS)
    dense = quality.drop_sparse(df, sparse_threshold)
    cleaned = process_table(dense, spec, exclude=exclude, normalize=normalize, **roles)
    mapping = structure.title_names(cleaned.columns)
    if url_column:
        mapping |= structure.title_names([f"{url_column}_valid"])
    return structure.structure_table(cleaned, string_columns(cleaned), url_column, mapping)


def tutorial_run(
    df: DataFrame, text_columns: Sequence[str] | None = None, label_blocks: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Remove code from the columns that hold it and clear missing words.

    Returns the table and its missing counts per column.
    """
    if text_columns is None:
        profile = quality.profile_columns(df, ("length", "code"))
        text_columns = quality.column_roles(profile)["code"]
    cleaned = quality.null_words(clean_code(df, text_columns, label_blocks))
    return cleaned, quality.missing_counts(cleaned)


def tutorial_file(
    spark: SparkSession,
    path: str,
    text_columns: Sequence[str] | None = None,
    out_path: str | None = None,
) -> DataFrame:
    """The same from a badly formed CSV file to compressed CSV or JSON."""
    loaded = readers.read_table(spark, path, tolerant=True)
    cleaned, _ = tutorial_run(loaded, text_columns)
    if out_path:
        write = writers.write_json if out_path.endswith(".json") else writers.write_csv
        write(cleaned, out_path, compressed=True)
    return cleaned


def tidy_run(
    df: DataFrame,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    order: Sequence[str] | None = None,
    url_column: str | None = None,
    valid_name: str = "Is URL Valid",
) -> DataFrame:
    """Drop incomplete rows and columns, rename, reorder, check the URL."""
    rename = rename or {}
    slim = structure.drop_columns(quality.drop_incomplete(df), drop)
    named = {c: rename.get(c, c) for c in slim.columns}
    shaped = structure.select_renamed(slim, named)
    if order:
        shaped = shaped.select(*[c for c in order if c in shaped.columns])
    return structure.add_url_validity(shaped, url_column, valid_name) if url_column else shaped


def keyword_search(
    pages: DataFrame,
    keywords: Sequence[str],
    selectors: Sequence[str] = page_jobs.SELECTORS,
    context_below: int | None = page_jobs.CONTEXT_BELOW,
    parts: bool = True,
) -> DataFrame:
    """Matches of keywords in the elements of stored pages, with page title and URL."""
    titled = pages.select("page_id", "url", html.title(F.col("html")).alias("title"), "html")
    # Elements without any form are dropped before their context is built.
    forms = {f for k in keywords if k.strip() for f in keyword_jobs.keyword_forms(k, parts)}
    elements = page_jobs.page_elements(
        titled, ["page_id", "url", "title"], "html", selectors, context_below, containing=sorted(forms)
    )
    return keyword_jobs.keyword_matches(elements.drop("href", "parent_length"), keywords, parts=parts)


def configured_run(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """A run described by the two sections ``data_cleaning`` and ``file_organization``."""
    cleaning = spec.get("data_cleaning") or {}
    files = spec.get("file_organization") or {}
    if cleaning.get("handle_missing_values"):
        df = quality.null_words(df)
    rules = {r["column"]: r["format"] for r in cleaning.get("format_rules") or ()}
    df = df.withColumns(
        {c: format_datetime(df, c, f) for c, f in rules.items() if c in df.columns}
    )
    if cleaning.get("remove_duplicates"):
        df = df.dropDuplicates()
    sort_by = files.get("sort_by")
    order = [sort_by] if isinstance(sort_by, str) else list(sort_by or ())
    if files.get("destination"):
        if order:
            writers.write_sorted(df, files["destination"], order)
        else:
            writers.write_csv(df, files["destination"])
    return df.orderBy(*order) if order else df


def format_datetime(df: DataFrame, column: str, strftime: str) -> Column:
    """A date column printed in a format; text that is no date stays."""
    _, out, _ = datetimes.spark_formats(strftime)
    value = F.col(f"`{column}`")
    if not isinstance(df.schema[column].dataType, StringType):
        return F.date_format(value, out)
    known = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", strftime, "%m/%d/%Y", "%Y/%m/%d")
    parsed = F.coalesce(*[datetimes.parse_datetime(value, f) for f in dict.fromkeys(known)])
    return F.coalesce(F.date_format(parsed, out), value)


def load_run_spec(path: str) -> dict[str, Any]:
    """A run description from a YAML file."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading a run description needs the yaml package") from error
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}

