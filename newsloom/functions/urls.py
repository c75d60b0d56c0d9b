"""URL rules as column expressions.

Everything here is built-in Spark SQL: no UDF, so a frontier job never leaves
the JVM. Costly branches (percent-encoding, dot-segment removal, query
rebuilding) sit behind ``when`` guards and only run for URLs that need them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*):"
AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"
# ASCII, scheme in lower case, no fragment
PLAIN = r"\A[a-z][a-z0-9+.-]*:[\x00-\x22\x24-\x7f]*\z"
PLAIN_ROOTED = r"\A/(?:[\x00-\x2e\x30-\x7f][\x00-\x7f]*)?\z"
PLAIN_ABSOLUTE = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://[\x00-\x7f]*\z"
MALFORMED = r"[\x00-\x1f\x7f]|\A[^?#]*%(?![0-9a-fA-F]{2})"
ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` written once.

    Catalyst inlines column definitions into filters it pushes down; an
    expression that mentions its input many times, on top of another one that
    does, would grow exponentially. A lambda variable keeps it linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scheme(url: Column) -> Column:
    """Lower-case scheme, ``''`` when there is none."""
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def host(url: Column) -> Column:
    """Lower-case ``host[:port]`` without user info, ``''`` when there is none."""
    return F.lower(F.regexp_extract(url, AUTHORITY, 1))


def site_link(url: Column) -> Column:
    """``scheme://host[:port]`` of a URL, the link of a feed."""
    return F.concat(scheme(url), F.lit("://"), F.regexp_extract(url, AUTHORITY, 1))


def has_article_scheme(url: Column) -> Column:
    """Only http and https URLs may be stored."""
    return scheme(url).isin("http", "https")


def strip_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def drop_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def encode_non_ascii(url: Column) -> Column:
    """Percent-encode every non-ASCII character and nothing else."""
    encoded = F.array_join(
        F.transform(
            F.split(url, ""),
            lambda c: F.when(F.octet_length(c) > 1, F.url_encode(c)).otherwise(c),
        ),
        "",
    )
    return F.when(F.octet_length(url) == F.char_length(url), url).otherwise(encoded)


def lower_scheme(url: Column) -> Column:
    found = F.regexp_extract(url, SCHEME, 1)
    return F.when(found == F.lower(found), url).otherwise(
        F.concat(F.lower(found), F.substring(url, F.length(found) + 1, F.length(url)))
    )


def form_encode(value: Column) -> Column:
    """Form encoding that keeps ``-_.~`` and escapes ``*``."""
    return F.replace(
        F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")
    )


def filter_query(url: Column, ignore_all: Column, listed: Column) -> Column:
    """Keep (``ignore_all``) or drop the listed query keys and rebuild the query.

    The query is rebuilt even when nothing is dropped: keys come out sorted, the
    values of one key keep their order, pairs that do not decode are dropped.
    """
    query = F.substring(url, F.length(drop_query(url)) + 2, F.length(url))

    def pair(p: Column, i: Column) -> Column:
        key = F.substring_index(p, "=", 1)
        value = F.substring(p, F.length(key) + 2, F.length(p))
        return F.struct(
            F.try_url_decode(key).alias("k"), i.alias("i"), F.try_url_decode(value).alias("v")
        )

    def keep(x: Column) -> Column:
        known = F.array_contains(listed, x["k"])
        return x["k"].isNotNull() & x["v"].isNotNull() & (known == ignore_all)

    whole = F.filter(F.split(query, "&"), lambda p: (p != "") & (F.instr(p, ";") == 0))
    kept = F.array_sort(F.filter(F.transform(whole, pair), keep))
    rebuilt = F.array_join(
        F.transform(
            kept, lambda x: F.concat(form_encode(x["k"]), F.lit("="), form_encode(x["v"]))
        ),
        "&",
    )
    return F.when(F.instr(url, "?") == 0, url).otherwise(
        F.concat(
            drop_query(url),
            F.when(rebuilt == "", F.lit("")).otherwise(F.concat(F.lit("?"), rebuilt)),
        )
    )


def apply_query_rule(url: Column, ignore_all: Column, listed: Column) -> Column:
    """Query rule of a site; a null ``ignore_all`` means the site has no rule."""
    has_list = F.coalesce(F.size(listed) > 0, F.lit(False))
    return (
        F.when(ignore_all.isNull(), url)
        .when(has_list, filter_query(url, ignore_all, listed))
        .when(ignore_all, drop_query(url))
        .otherwise(url)
    )


def canonical(url: Column, ignore_all: Column, listed: Column) -> Column:
    """The URL under which a page is compared, filtered and stored.

    Most URLs need nothing or lose their query; these two cases stay in compiled
    code, and only the others go through the steps below.
    """
    plain = url.rlike(PLAIN)
    unlisted = F.coalesce(F.size(listed) <= 0, F.lit(True))
    untouched = ignore_all.isNull() | (F.instr(url, "?") == 0) | (unlisted & ~ignore_all)
    lowered = let(strip_fragment(url), lower_scheme)
    ruled = let(lowered, lambda u: apply_query_rule(u, ignore_all, listed))
    return (
        F.when(plain & untouched, url)
        .when(plain & unlisted, drop_query(url))
        .otherwise(let(ruled, encode_non_ascii))
    )


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 5.2.4 for a path that starts with ``/``; other paths stay."""
    segments = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    last = F.substring_index(path, "/", -1)

    def step(done: Column, s: Column) -> Column:
        return (
            F.when(s == ".", done)
            .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(s)))
        )

    done = F.aggregate(segments, F.array().cast("array<string>"), step)
    # a last "." or ".." leaves a directory, hence a closing slash
    closing = F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(F.array())
    cleaned = F.concat(F.lit("/"), F.array_join(F.concat(done, closing), "/"))
    return F.when(path.rlike(r"^/(.*/)?\.\.?(/|$)"), cleaned).otherwise(path)


def base_parts(base: Column) -> Column:
    """What resolving needs of a page URL; worth computing once per page."""
    split = let(
        strip_fragment(base),
        lambda u: F.struct(
            u.alias("whole"),
            drop_query(u).alias("page"),
            F.regexp_extract(u, ORIGIN, 1).alias("origin"),
        ),
    )

    def with_directory(s: Column) -> Column:
        path = F.substring(s["page"], F.length(s["origin"]) + 1, F.length(s["page"]))
        directory = F.regexp_extract(path, r"^(.*/)", 1)
        return F.struct(
            s["whole"].alias("whole"),
            s["page"].alias("page"),
            s["origin"].alias("origin"),
            F.when(directory == "", "/").otherwise(directory).alias("directory"),
        )

    return let(split, with_directory)


def trimmed(ref: Column) -> Column:
    """A link without the white space that markup may have around it."""
    return F.btrim(ref, F.lit(" \t\n\f\r"))


def malformed(ref: Column) -> Column:
    """No URL: control characters, a broken escape in the path, or an empty scheme."""
    return ref.rlike(MALFORMED) | ref.startswith(":")


def resolve(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` on the page with ``base_parts`` ``base`` (RFC 3986 5.2).

    Null for what is ``malformed``. ``page_links.resolve_link`` is the same rule
    inside the page-reading job.
    """

    def split(r: Column) -> Column:
        return F.struct(
            r.alias("ref"),
            F.regexp_extract(r, r"^([^?#]*)", 1).alias("path"),
            F.regexp_extract(r, r"^((?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)", 1).alias("host"),
            F.rlike(r, F.lit(SCHEME)).alias("has_scheme"),
        )

    def place(p: Column) -> Column:
        ref, path, authority = p["ref"], p["path"], p["host"]
        opaque = p["has_scheme"] & (authority == "")
        tail = F.substring(ref, F.length(path) + 1, F.length(ref))
        prefix = (
            F.when(opaque, "")
            .when(ref.startswith("//"), F.concat(scheme(base["origin"]), F.lit(":"), authority))
            .when(authority != "", authority)
            .when((path == "") & tail.startswith("?"), base["page"])
            .when(path == "", base["whole"])
            .otherwise(base["origin"])
        )
        rest = (
            F.when(opaque | (path == ""), path)
            .when(authority != "", F.substring(path, F.length(authority) + 1, F.length(path)))
            .when(path.startswith("/"), path)
            .otherwise(F.concat(base["directory"], path))
        )
        return F.struct(
            prefix.alias("prefix"), rest.alias("rest"), tail.alias("tail"), opaque.alias("opaque")
        )

    def join(q: Column) -> Column:
        path = F.when(q["opaque"], q["rest"]).otherwise(remove_dot_segments(q["rest"]))
        return F.concat(q["prefix"], path, q["tail"])

    # links from the root and absolute ones, without dots or non-ASCII, stay compiled
    ascii_origin = F.octet_length(base["origin"]) == F.char_length(base["origin"])
    dotless = F.instr(ref, "/.") == 0
    return (
        F.when(malformed(ref), None)
        .when(dotless & ref.rlike(PLAIN_ROOTED) & ascii_origin, F.concat(base["origin"], ref))
        .when(dotless & ref.rlike(PLAIN_ABSOLUTE), ref)
        .otherwise(let(let(let(let(ref, split), place), join), encode_non_ascii))
    )
