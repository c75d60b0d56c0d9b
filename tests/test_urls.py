import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import urls
from newsloom.functions.page_links import resolve_link

BASE = "http://a/b/c/d;p?q"
# RFC 3986 section 5.4, normal and abnormal examples
RESOLVED = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/",
    "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s",
    ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/",
    "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/",
    "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g",
    "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g",
    "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
    "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g#s/../x": "http://a/b/c/g#s/../x", "http:g": "http:g",
    "/é": "http://a/%C3%A9", "mailto:x@y.z": "mailto:x@y.z",
    "https://é.x/../b/./c": "https://%C3%A9.x/b/c",
}


def rows_of(spark, values, *columns):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    return [tuple(r) for r in frame.select("v", *columns).collect()]


def canonical(ignore_all, listed):
    keys = F.array(*[F.lit(k) for k in listed]).cast("array<string>")
    return urls.canonical(F.col("v"), F.lit(ignore_all).cast("boolean"), keys)


def test_resolve_column_and_worker_agree_with_the_standard(spark):
    column = urls.resolve(urls.base_parts(F.lit(BASE)), F.col("v"))
    assert dict(rows_of(spark, RESOLVED, column)) == RESOLVED
    assert {ref: resolve_link(BASE, ref) for ref in RESOLVED} == RESOLVED


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab./?#:é", max_size=12), min_size=30, max_size=60, unique=True))
def test_column_and_worker_agree_on_any_reference(spark, refs):
    refs = [r for r in refs if not r.startswith(":")]
    for base in ("https://h.x/p/q?z=1", "http://h.x"):
        column = urls.resolve(urls.base_parts(F.lit(base)), F.col("v"))
        assert dict(rows_of(spark, refs, column)) == {r: resolve_link(base, r) for r in refs}


@pytest.mark.parametrize("bad", ["/%zz", "%", "a\x07b", ":x"])
def test_malformed_links_raise(bad):
    with pytest.raises(ValueError):
        resolve_link(BASE, bad)


def test_query_rules(spark):
    url = "HTTP://A.x/b?z=1&a=2&z=0&utm=3+4&bad=%zz&;=3&e#frag"
    plain = "http://A.x/b?z=1&a=2&z=0&utm=3+4&bad=%zz&;=3&e"
    expected = {
        (True, ("z", "e")): "http://A.x/b?e=&z=1&z=0",
        (False, ("z",)): "http://A.x/b?a=2&e=&utm=3+4",
        (True, ()): "http://A.x/b",
        (False, ()): plain,
        (None, ()): plain,
    }
    for (ignore_all, listed), wanted in expected.items():
        assert rows_of(spark, [url], canonical(ignore_all, listed))[0][1] == wanted


def test_documented_query_example(spark):
    news = ["http://example.tld/news?item=42", "http://example.tld/news?item=314", "http://example.tld/news"]
    assert {c for _, c in rows_of(spark, news, canonical(True, ()))} == {"http://example.tld/news"}


def test_encoding_of_rebuilt_queries(spark):
    url = "http://x/?k=a%20b&k=~-_.*&k=%C3%A9"
    assert rows_of(spark, [url], canonical(True, ("k",)))[0][1] == "http://x/?k=a+b&k=~-_.%2A&k=%C3%A9"


def test_only_non_ascii_is_encoded(spark):
    got = dict(rows_of(spark, ["http://x/é%C3 a😀"], canonical(None, ())))
    assert got == {"http://x/é%C3 a😀": "http://x/%C3%A9%C3 a%F0%9F%98%80"}


PAIRS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "ref", "é"]), st.text("xy é&=+%", max_size=4)), max_size=5
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PAIRS, min_size=20, max_size=40))
def test_canonical_is_idempotent_and_keep_and_drop_partition_the_keys(spark, queries):
    from urllib.parse import parse_qsl, urlencode

    found = list({"http://x/p?" + urlencode(q) for q in queries})
    keep, drop = canonical(True, ("a", "ref")), canonical(False, ("a", "ref"))
    for url, kept, dropped in rows_of(spark, found, keep, drop):
        pairs = parse_qsl(url.partition("?")[2], keep_blank_values=True)
        both = [parse_qsl(u.partition("?")[2], keep_blank_values=True) for u in (kept, dropped)]
        assert sorted(both[0] + both[1]) == sorted(pairs)
        assert all(k in ("a", "ref") for k, _ in both[0])
        assert not any(k in ("a", "ref") for k, _ in both[1])
    kept = sorted({k for _, k in rows_of(spark, found, keep)})
    assert [(k, k) for k in kept] == sorted(rows_of(spark, kept, keep))


def test_scheme_host_and_link(spark):
    got = rows_of(
        spark,
        ["HTTPS://u:p@Host.x:81/p?q", "ftp://f/x", "no scheme", "http://a b/c"],
        urls.scheme(F.col("v")),
        urls.host(F.col("v")),
        urls.site_link(F.col("v")),
        urls.has_article_scheme(F.col("v")),
    )
    assert got == [
        ("HTTPS://u:p@Host.x:81/p?q", "https", "host.x:81", "https://Host.x:81", True),
        ("ftp://f/x", "ftp", "f", "ftp://f", False),
        ("no scheme", "", "", "://", False),
        ("http://a b/c", "http", "a b", "http://a b", True),
    ]


LINK_CASES = [
    "a", "/a", "../a/./b/..", "?q=1", "#f", "", ".", "//h.tld/x/../y", "HTTP://h.tld", "mailto:x@y", "javascript:f()",
    " a ", "\t/a\n", "a b", "/a b", "/%zz", "x%2", "?q=%zz", "#%zz", ":x", "a\x01b", "é/ü?ö", "//é.tld/../a", "/..a/.b", "a:b/c",
    "http://h.tld/a/../../b", "http:a", "/a//b/../c", "x/%41", "/\x7f",
]


def test_both_link_resolvers_follow_one_rule(spark):
    from newsloom.functions.page_links import resolve_link
    from newsloom.functions import urls

    bases = ["http://acme.tld/x/y?z#f", "https://acme.tld", "http://é.tld/a/"]
    rows = spark.createDataFrame([(b, r) for b in bases for r in LINK_CASES], "base string, ref string")
    resolved = urls.resolve(urls.base_parts(F.col("base")), urls.trimmed(F.col("ref")))
    for row in rows.select("base", "ref", resolved.alias("got")).collect():
        try:
            expected = resolve_link(row.base, row.ref)
        except ValueError:
            expected = None
        assert row.got == expected, (row.base, row.ref)
