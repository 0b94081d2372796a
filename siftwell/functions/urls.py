"""URL expressions. All are patterns, so a malformed URL gives '' or NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.text import let

# URL shapes.
ORIGIN = "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]*)"
PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def origin(url: Column) -> Column:
    return F.regexp_extract(url, ORIGIN, 1)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def normalize(url: Column) -> Column:
    """The form URLs are matched in: no fragment, and no slash after a bare host."""
    return F.regexp_replace(without_fragment(F.trim(url)), "^([A-Za-z]+://[^/?#]*)/$", "$1")


def _kept_segments(segments: Column) -> Column:
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(s))),
    )
    # A path that ends in a dot segment names a folder.
    return F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)


def without_dots(url: Column) -> Column:
    """``url`` with the segments '.' and '..' of its path carried out; those above the root are dropped."""

    def carried_out(whole: Column) -> Column:
        segments = F.split(F.substring(path(whole), 2, 1 << 20), "/")
        kept = F.array_join(let(segments, _kept_segments), "/")
        return F.concat(origin(whole), F.lit("/"), kept, F.regexp_extract(whole, "^[^?#]*([?#].*)?$", 1))

    return let(url, lambda u: F.when(path(u).rlike("/\\.\\.?(/|$)"), carried_out(u)).otherwise(u))


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on page ``base``, without its fragment, white space around it and dot segments."""
    clean = without_fragment(F.trim(F.regexp_replace(href, "[\\t\\r\\n]", "")))
    return without_dots(let(base, lambda page: let(clean, lambda link: _joined(page, link))))


def _joined(base: Column, link: Column) -> Column:
    page = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(path(base) == "", F.concat(page, F.lit("/"))).otherwise(
        F.regexp_replace(page, "[^/]*$", "")
    )
    return (
        F.when(F.regexp_extract(link, SCHEME, 1) != "", link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, SCHEME, 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin(base), link))
        .when(link == "", without_fragment(base))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(folder, link))
    )


def url_parts(url: Column, base: Column | None = None) -> Column:
    """Struct of host, path, query-free form and absolute form (relative to ``base`` if given)."""
    absolute = without_fragment(url) if base is None else resolve(base, url)
    return F.struct(
        host(absolute).alias("host"),
        path(absolute).alias("path"),
        F.regexp_replace(absolute, "[?#].*$", "").alias("bare"),
        absolute.alias("absolute"),
    )


def host_within(host_column: Column, domains: list[str]) -> Column:
    """True when the host is one of ``domains`` or a subdomain of one."""
    lowered = [d.lower() for d in domains]
    test = host_column.isin(lowered)
    for domain in lowered:
        test = test | host_column.endswith("." + domain)
    return test
