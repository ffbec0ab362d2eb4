"""URL rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texloam.config import UrlSpec
from texloam.functions.core import bind, replace

# Fixed values.
# RFC 3986, appendix B, with the scheme limited to its legal characters.
URL_PARTS = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)
DOMAIN_LIKE = r"^[a-zA-Z0-9][-a-zA-Z0-9.]*\.[a-zA-Z]{2,}"
LEADING_CONTROLS = r"^[\x00-\x20]+"
TRAILING_SLASH = r"(?s)^(.+)/(;[^/]*)?$"
# Schemes of RFC 3986 style hierarchical URLs.
HOST_SCHEMES = (
    *("ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https"),
    *("shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh"),
    *("sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services"),
)
RELATIVE_SCHEMES = (
    *("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms"),
    *("prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss"),
)
RARE_ENDINGS = ("xyz", "tk", "ml", "ga", "cf", "gq")
LONGEST_USUAL_URL = 2000


def split_url(url: Column) -> Column:
    """Struct of scheme (lower case), host, path, query and fragment.

    Parts that are absent are empty strings.  Leading blanks and control
    characters and all tabs and line ends are ignored.
    """

    def parts(text: Column) -> Column:
        names = ("scheme", "host", "path", "query", "fragment")
        pieces = [F.regexp_extract(text, URL_PARTS, i + 1) for i in range(len(names))]
        pieces[0] = F.lower(pieces[0])
        return F.struct(*[p.alias(n) for p, n in zip(pieces, names, strict=True)])

    return bind(replace(F.translate(url, "\t\r\n", ""), LEADING_CONTROLS, ""), parts)


def join_url(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    """The five parts as one URL."""
    return bind(
        F.struct(scheme.alias("s"), host.alias("h"), path.alias("p"), query.alias("q"), fragment.alias("f")),
        lambda u: F.concat(
            F.when(u["s"] != "", F.concat(u["s"], F.lit(":"))).otherwise(""),
            F.when(
                u["h"] != "",
                F.concat(
                    F.lit("//"),
                    u["h"],
                    F.when((u["p"] != "") & ~u["p"].startswith("/"), "/").otherwise(""),
                ),
            )
            .when(u["p"].startswith("//"), "//")
            .when(
                u["s"].isin(*HOST_SCHEMES) & ((u["p"] == "") | u["p"].startswith("/")),
                "//",
            )
            .otherwise(""),
            u["p"],
            F.when(u["q"] != "", F.concat(F.lit("?"), u["q"])).otherwise(""),
            F.when(u["f"] != "", F.concat(F.lit("#"), u["f"])).otherwise(""),
        ),
    )


def _broken_brackets(host: Column) -> Column:
    return host.contains("[") != host.contains("]")


def _decode(text: Column) -> Column:
    # A percent sign that starts no escape stands for itself.
    return F.url_decode(replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(text: Column) -> Column:
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def filter_query(query: Column, spec: UrlSpec) -> Column:
    """Drop query keys and rebuild the query.

    Blank values go; a key that repeats keeps its first place and last value.
    """
    if spec.drop_parameters is None or spec.drop_parameters is False:
        return query
    if spec.drop_parameters is True and not spec.required_parameters:
        return F.lit("")

    def kept(key: Column) -> Column:
        if spec.drop_parameters is True:
            return key.isin(*spec.required_parameters)
        return ~key.isin(*spec.drop_parameters) if spec.drop_parameters else F.lit(True)

    def rebuild(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        return F.array_join(
            F.transform(
                F.filter(keys, kept),
                lambda k: F.concat(
                    _encode(k),
                    F.lit("="),
                    _encode(F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]),
                ),
            ),
            "&",
        )

    filled = F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)^[^=]*=."))
    pairs = F.transform(
        filled,
        lambda p: bind(
            F.instr(p, "="),
            lambda at: F.struct(
                _decode(F.substring(p, F.lit(1), at - 1)).alias("k"),
                _decode(F.substr(p, at + 1)).alias("v"),
            ),
        ),
    )
    return F.when(query == "", query).otherwise(bind(pairs, rebuild))


def standardize_url(url: Column, spec: UrlSpec | None = None) -> Column:
    """One canonical form per URL; a URL that cannot be parsed stays as it is."""
    spec = spec or UrlSpec()

    def with_scheme(text: Column) -> Column:
        return (
            F.when(text.startswith("//"), F.concat(F.lit(f"{spec.default_scheme}:"), text))
            .when(text.startswith("http://") | text.startswith("https://"), text)
            .when(text.rlike(DOMAIN_LIKE), F.concat(F.lit(f"{spec.default_scheme}://"), text))
            .otherwise(text)
        )

    def host_of(u: Column) -> Column:
        host = F.lower(u["host"]) if spec.lower_host else u["host"]
        return replace(host, r"^www\.", "") if spec.drop_www else host

    def path_of(u: Column) -> Column:
        return replace(u["path"], TRAILING_SLASH, "$1$2") if spec.drop_trailing_slash else u["path"]

    def rebuilt(text: Column, u: Column) -> Column:
        return (
            F.when(_broken_brackets(u["host"]), text)
            .when((u["host"] == "") & u["path"].rlike("^(;[^/]*)?$"), "")
            .otherwise(
                join_url(
                    u["scheme"],
                    host_of(u),
                    path_of(u),
                    filter_query(u["query"], spec),
                    F.lit("") if spec.drop_fragment else u["fragment"],
                )
            )
        )

    return bind(
        url,
        lambda text: F.when(
            (text == "") | text.isNull(),
            text,
        ).otherwise(bind(with_scheme(text), lambda t: bind(split_url(t), lambda u: rebuilt(t, u)))),
    )


def standardize_url_list(urls: Column, spec: UrlSpec | None = None) -> Column:
    """Each URL of an array, order and length kept."""
    return F.transform(urls, lambda u: standardize_url(u, spec))


def drop_fragment(url: Column) -> Column:
    """The URL without its fragment."""
    return bind(
        split_url(url),
        lambda u: join_url(u["scheme"], u["host"], u["path"], u["query"], F.lit("")),
    )


def url_host(url: Column) -> Column:
    """Host part, port and user included; empty when there is none."""
    return split_url(url)["host"]


def second_level_domain(url: Column) -> Column:
    """The label before the last one of the host."""
    return bind(
        F.split(url_host(url), r"\."),
        lambda labels: F.when(F.size(labels) > 1, F.element_at(labels, -2)).otherwise(labels[0]),
    )


def is_valid_url(url: Column) -> Column:
    """A scheme and a host are present."""
    return bind(
        split_url(url),
        lambda u: (u["scheme"] != "") & (u["host"] != "") & ~_broken_brackets(u["host"]),
    )


def url_issues(url: Column, additional: bool = False) -> Column:
    """Names of the structural problems of a URL; an empty array when none."""

    def found(u: Column) -> Column:
        broken = _broken_brackets(u["host"])
        no_scheme = ~(url.startswith("http://") | url.startswith("https://"))
        checks = [
            F.when(no_scheme, "Missing or invalid scheme"),
            F.when(broken, "Malformed URL").when(u["host"] == "", "Missing domain"),
        ]
        if additional:
            ending = F.lower(F.element_at(F.split(u["host"], r"\."), -1))
            rare = u["host"].contains(".") & ending.isin(*RARE_ENDINGS)
            checks += [
                F.when(~broken & rare, F.concat(F.lit("Uncommon TLD (."), ending, F.lit(")"))),
                F.when(F.length(url) > LONGEST_USUAL_URL, "Extremely long URL"),
                F.when(
                    ~broken & u["host"].rlike("[^a-zA-Z0-9.-]"), "Unusual characters in domain"
                ),
            ]
        return F.array_compact(F.array(*checks))

    return bind(split_url(url), found)


def _merge_paths(base_path: Column, path: Column) -> Column:
    """RFC 3986 path resolution with dot segments removed."""

    def base_folder(parts: Column) -> Column:
        return F.when(
            F.element_at(parts, -1) != "", F.slice(parts, F.lit(1), F.size(parts) - 1)
        ).otherwise(parts)

    def without_inner_blanks(segments: Column) -> Column:
        last = F.size(segments)
        inner = F.when(last > 2, F.slice(segments, F.lit(2), F.greatest(last - 2, F.lit(0)))).otherwise(
            F.array().cast("array<string>")
        )
        return F.when(last < 2, segments).otherwise(
            F.concat(
                F.slice(segments, F.lit(1), F.lit(1)),
                F.filter(inner, lambda s: s != ""),
                F.slice(segments, last, F.lit(1)),
            )
        )

    def walk(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda seen, s: F.when(
                s == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0)))
            )
            .when(s == ".", seen)
            .otherwise(F.concat(seen, F.array(s))),
        )
        closed = F.when(
            F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))
        ).otherwise(kept)
        return F.array_join(closed, "/")

    def resolve(segments: Column) -> Column:
        dotted = F.exists(segments, lambda s: s.isin(".", ".."))
        return F.when(dotted, walk(segments)).otherwise(F.array_join(segments, "/"))

    relative = F.concat(bind(F.split(base_path, "/"), base_folder), F.split(path, "/"))
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(
        bind(relative, without_inner_blanks)
    )
    merged = bind(segments, resolve)
    return bind(merged, lambda m: F.when(m == "", "/").otherwise(m))


def resolve_url(base: Column, url: Column) -> Column:
    """An absolute URL from a page address and a link found on the page."""

    def merged(b: Column, u: Column, link: Column) -> Column:
        scheme = F.when(u["scheme"] == "", b["scheme"]).otherwise(u["scheme"])
        has_host = u["host"] != ""
        no_path = u["path"] == ""
        joined = join_url(
            scheme,
            F.when(has_host, u["host"]).otherwise(b["host"]),
            F.when(has_host, u["path"])
            .when(no_path, b["path"])
            .otherwise(_merge_paths(b["path"], u["path"])),
            F.when(~has_host & no_path & (u["query"] == ""), b["query"]).otherwise(u["query"]),
            u["fragment"],
        )
        foreign = (scheme != b["scheme"]) | ~scheme.isin(*RELATIVE_SCHEMES)
        return F.when(foreign, link).otherwise(joined)

    return bind(
        F.struct(base.alias("base"), url.alias("link")),
        lambda x: F.when(F.coalesce(x["base"], F.lit("")) == "", x["link"])
        .when(x["link"] == "", x["base"])
        .otherwise(
            bind(
                F.struct(split_url(x["base"]).alias("b"), split_url(x["link"]).alias("u")),
                lambda s: merged(s["b"], s["u"], x["link"]),
            )
        ),
    )
