"""Registered queries and the SQL that states their expected results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import urls
from newsloom.functions.dates import parse_date, translate_layout
from newsloom.operators import extract, feeds, frontier, links, reports, store
from newsloom.operators.latest import LatestArticles
from newsloom.operators.link_state import LinkState
from newsloom.plans import samples
from newsloom.plans.ingest import (
    date_layouts as site_layouts,
    read_articles,
    run_ingest,
    spread,
    with_reading_rules,
)
from newsloom.scratch import materialize, scratch_path
from newsloom.sources import versions as rule_versions
from newsloom.sources.articles import IndexedStore, ParquetStore
from newsloom.sources.config import settings_error
from newsloom.sources.pages import assign_sites
from newsloom.sources.url_index import UrlIndex
from newsloom.streaming.ingest_stream import ingest_landing

QUERIES: dict = {}
SQL: dict[str, str] = {}


def dates_as_text(result: DataFrame) -> DataFrame:
    """Dates in ISO form, so that results of two engines compare as plain values."""
    dates = {n: F.col(n).cast("string") for n, kind in result.dtypes if kind == "date"}
    return result.withColumns(dates) if dates else result


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = lambda spark, sf_dir: dates_as_text(run(spark, sf_dir))
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


# --- SQL building blocks ---------------------------------------------------


def sql_no_fragment(url: str) -> str:
    return f"split_part({url}, '#', 1)"


def sql_no_query(url: str) -> str:
    return f"split_part({sql_no_fragment(url)}, '?', 1)"


def sql_host(url: str) -> str:
    return f"lower(split_part(split_part(split_part({url}, '/', 3), '?', 1), '#', 1))"


def sql_ascii(url: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({url}, ''), "
        "lambda c: CASE WHEN regexp_matches(c, '[^\\x00-\\x7f]') THEN url_encode(c) ELSE c END), '')"
    )


def sql_query_rule(keep: str) -> str:
    """Rebuild the query from the pairs for which ``keep`` (over key ``k``) holds."""
    decode = lambda x: f"url_decode(replace({x}, '+', ' '))"
    encode = lambda x: f"replace(url_encode({x}), '%20', '+')"
    return f"""
WITH plain AS (SELECT page_id, {sql_no_fragment('url')} AS u FROM pages),
pairs AS (
  SELECT page_id, unnest(string_split(substr(u, strpos(u, '?') + 1), '&')) AS pair,
         generate_subscripts(string_split(substr(u, strpos(u, '?') + 1), '&'), 1) AS i
  FROM plain WHERE contains(u, '?')),
decoded AS (
  SELECT page_id, i, {decode("split_part(pair, '=', 1)")} AS k,
         {decode("CASE WHEN contains(pair, '=') THEN substr(pair, strpos(pair, '=') + 1) ELSE '' END")} AS v
  FROM pairs WHERE pair <> ''),
rebuilt AS (
  SELECT page_id, string_agg({encode('k')} || '=' || {encode('v')}, '&' ORDER BY k, i) AS q
  FROM decoded WHERE {keep} GROUP BY page_id)
SELECT page_id, split_part(u, '?', 1) || coalesce('?' || q, '') AS url
FROM plain LEFT JOIN rebuilt USING (page_id)"""


def sql_escape(text: str) -> str:
    for plain, escaped in (("&", "&amp;"), ("''", "&#39;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;")):
        text = f"replace({text}, '{plain}', '{escaped}')"
    return f"replace({text}, chr(13), '&#13;')"


SQL_DOCS = """docs AS (
  SELECT doc_id, lang, text, n_chars, source AS website,
         'https://' || source || '.example.com/news/' || doc_id AS url,
         trim(split_part(text, chr(10), 1), ' ' || chr(9) || chr(10)) AS title,
         CASE lang WHEN 'de' THEN NULL WHEN 'es' THEN '' ELSE 'Summary of ' || doc_id END AS description,
         CASE lang WHEN 'fr' THEN NULL ELSE 'Desk ' || lang END AS author,
         DATE '2024-01-01' + CAST(n_chars % 365 AS INTEGER) AS date
  FROM documents)"""

SQL_LATEST = f"""{SQL_DOCS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY website ORDER BY date DESC, url) AS rn FROM docs)"""

SQL_GOOD = "n_chars >= 300 AND NOT contains(text, '|')"

SQL_CLEAN = (
    "'<img class=\"thumbnail\" src=\"https://' || website || '.example.com/img/' || doc_id || '.png\"/>' || "
    + sql_escape("text")
    + " || '<a href=\"https://' || website || '.example.com/more?id=' || doc_id || '#top\">more</a>'"
    " || CASE lang WHEN 'fr' THEN '<a href=\"/%zz\">bad</a>' ELSE '' END"
)


# --- URL rules -------------------------------------------------------------


@query(f"SELECT page_id, {sql_no_fragment('url')} AS url FROM pages")
def url_strip_fragment(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.table(spark, sf, "pages")
    return pages.select("page_id", urls.strip_fragment(F.col("url")).alias("url"))


def _canonical_pages(spark: SparkSession, sf: str, **rules) -> DataFrame:
    pages = samples.with_rules(samples.table(spark, sf, "pages").select("page_id", "url"), **rules)
    return frontier.with_canonical_url(pages).select("page_id", F.col("canonical_url").alias("url"))


@query(f"SELECT page_id, {sql_no_query('url')} AS url FROM pages")
def url_query_drop_all(spark: SparkSession, sf: str) -> DataFrame:
    return _canonical_pages(spark, sf, ignore_all=True)


@query(sql_query_rule("k IN ('ref')"))
def url_query_keep_listed(spark: SparkSession, sf: str) -> DataFrame:
    return _canonical_pages(spark, sf, ignore_all=True, listed=("ref",))


@query(sql_query_rule("k NOT IN ('utm_source', 'page')"))
def url_query_drop_listed(spark: SparkSession, sf: str) -> DataFrame:
    return _canonical_pages(spark, sf, ignore_all=False, listed=("utm_source", "page"))


RESTRICT, EXCLUDE = r"^https?://[^/]*\.example\.(com|org)/", "spam|cheap|/de/"


@query(f"""
SELECT page_id, url, regexp_matches(url, '{RESTRICT}') AS restrict_ok,
       NOT regexp_matches(url, '{EXCLUDE}') AS exclude_ok FROM pages""")
def url_restrict_exclude(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.with_rules(
        samples.table(spark, sf, "pages").select("page_id", "url"),
        restrict=RESTRICT,
        exclude=EXCLUDE,
    )
    return pages.select(
        "page_id",
        "url",
        frontier.passes_restrict(F.col("url"), F.col("restrict")).alias("restrict_ok"),
        frontier.passes_exclude(F.col("url"), F.col("exclude")).alias("exclude_ok"),
    )


@query("""
WITH variants AS (
  SELECT page_id, unnest([url, regexp_replace(url, '^https?:', 'ftp:'),
                          regexp_replace(url, '^https?:', 'HTTP:')]) AS url FROM pages)
SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)) AS scheme,
       lower(url) LIKE 'http:%' OR lower(url) LIKE 'https:%' AS storable FROM variants""")
def url_scheme_gate(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    variants = F.array(
        url, F.regexp_replace(url, "^https?:", "ftp:"), F.regexp_replace(url, "^https?:", "HTTP:")
    )
    pages = samples.table(spark, sf, "pages").select("page_id", F.explode(variants).alias("url"))
    return pages.select(
        "page_id",
        "url",
        urls.scheme(F.col("url")).alias("scheme"),
        urls.has_article_scheme(F.col("url")).alias("storable"),
    )


@query(f"""
SELECT page_id, url, {sql_host('url')} AS host,
       regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS link FROM pages""")
def url_site_link(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.table(spark, sf, "pages")
    return pages.select(
        "page_id",
        "url",
        urls.host(F.col("url")).alias("host"),
        urls.site_link(F.col("url")).alias("link"),
    )


# --- settings --------------------------------------------------------------


@query("""
WITH made AS (
  SELECT page_id, page_id % 6 AS kind,
         CASE WHEN page_id % 6 = 2 THEN regexp_replace(url, '^https?:', 'ftp:') ELSE url END AS start FROM pages)
SELECT page_id, CASE kind
    WHEN 2 THEN 'site ''site' || page_id || ''' has the start point ''' || start || ''', which is no http or https URL'
    WHEN 3 THEN 'feeds can be of type rss or atom, not ''json'''
    WHEN 4 THEN 'nb_items must be 1 or more'
    WHEN 5 THEN 'site ''site' || page_id || ''' has no date selector' END AS error FROM made""")
def settings_errors(spark: SparkSession, sf: str) -> DataFrame:
    """A settings text for every page, its URL being the start point; most have something wrong."""
    pages = samples.table(spark, sf, "pages").select("page_id", "url")
    return samples.settings_texts(pages).select("page_id", settings_error(F.col("settings")).alias("error"))


# --- frontier --------------------------------------------------------------

SQL_HOST_PAGES = f"""host_pages AS (
  SELECT {sql_host('url')} AS website, page_id, url, {sql_no_query('url')} AS canonical_url FROM pages)"""


def _english_stored(spark: SparkSession, sf: str) -> DataFrame:
    """What an earlier run stored: the English sections of all sites."""
    pages = samples.host_pages(spark, sf)
    canonical = urls.drop_query(urls.strip_fragment(F.col("url")))
    return pages.filter(F.col("url").rlike("/en/")).select("website", canonical.alias("url")).distinct()


@query(f"""
WITH {SQL_HOST_PAGES}, stored AS (SELECT website, canonical_url FROM host_pages WHERE url LIKE '%/en/%')
SELECT website, page_id, canonical_url FROM host_pages h
WHERE NOT EXISTS (SELECT 1 FROM stored s
                  WHERE s.website = h.website AND s.canonical_url = h.canonical_url)""")
def frontier_unseen(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.with_rules(samples.host_pages(spark, sf), ignore_all=True)
    stored = _english_stored(spark, sf).withColumnRenamed("url", "canonical_url")
    rows = frontier.with_canonical_url(pages).select("website", "page_id", "canonical_url")
    return frontier.unseen_rows(rows, ["website", "canonical_url"], stored).select(rows.columns)


def _page_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every page twice, the second time under its URL with a fragment."""
    pages = samples.host_pages(spark, sf)
    again = pages.withColumn("url", F.concat("url", F.lit("#again"))).withColumn(
        "page_id", -F.col("page_id") - 1
    )
    return pages.unionByName(again)


SQL_VARIANTS = f"""{SQL_HOST_PAGES}, variants AS (
  SELECT website, page_id, url, canonical_url FROM host_pages UNION ALL
  SELECT website, -page_id - 1, url || '#again', canonical_url FROM host_pages)"""


@query(f"""
WITH {SQL_VARIANTS}
SELECT website, canonical_url, min(page_id) AS page_id FROM variants GROUP BY 1, 2""")
def frontier_dedup(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.with_rules(_page_variants(spark, sf), ignore_all=True)
    rows = frontier.with_canonical_url(pages)
    return frontier.first_of_each(rows, ["website", "canonical_url"], "page_id")


@query(f"""
WITH {SQL_VARIANTS}, stored AS (
  SELECT DISTINCT website, canonical_url FROM host_pages WHERE url LIKE '%/en/%'),
checked AS (
  SELECT v.*, CASE WHEN NOT regexp_matches(v.canonical_url, '{RESTRICT}') THEN 'restrict'
                   WHEN regexp_matches(v.canonical_url, '{EXCLUDE}') THEN 'exclude' END AS failed,
         s.canonical_url IS NOT NULL AS is_stored,
         row_number() OVER (PARTITION BY v.website, v.canonical_url ORDER BY page_id) AS copy
  FROM variants v LEFT JOIN stored s
    ON s.website = v.website AND s.canonical_url = v.canonical_url),
judged AS (
  SELECT *, CASE WHEN failed IS NOT NULL THEN failed WHEN copy > 1 THEN 'seen'
                 WHEN is_stored THEN 'stored' END AS reason FROM checked)
SELECT website, page_id, canonical_url, reason IS NULL AS accepted, reason FROM judged""")
def frontier_decisions(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.with_rules(
        _page_variants(spark, sf), ignore_all=True, restrict=RESTRICT, exclude=EXCLUDE
    )
    return frontier.decide(frontier.check(pages), _english_stored(spark, sf)).select(
        "website", "page_id", "canonical_url", "accepted", "reason"
    )


@query(SQL["frontier_decisions"])
def frontier_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same decisions from an index of the stored URLs, which was filled by four appends and merged once."""
    pages = samples.with_rules(
        _page_variants(spark, sf), ignore_all=True, restrict=RESTRICT, exclude=EXCLUDE
    )
    index, stored = UrlIndex(spark, scratch_path(spark, "urls"), buckets=16), _english_stored(spark, sf)
    part = F.pmod(F.xxhash64("url"), F.lit(4))
    for k in range(4):
        index.append(stored.filter(part == k))
        if k == 1:
            index.merge()
    return frontier.decide(frontier.check(pages), index).select(
        "website", "page_id", "canonical_url", "accepted", "reason"
    )


@query(f"""
WITH {SQL_HOST_PAGES},
arrivals AS (SELECT *, DATE '2024-01-01' + CAST(page_id % 90 AS INTEGER) AS arrived FROM host_pages),
versions AS (
  SELECT DISTINCT website, DATE '2024-01-01' + CAST(10 * v + strlen(website) % 7 AS INTEGER) AS valid_from, v
  FROM host_pages, range(5) r(v)),
ruled AS (
  SELECT a.*, v FROM arrivals a ASOF JOIN versions s ON a.website = s.website AND a.arrived >= s.valid_from),
checked AS (
  SELECT *, CASE WHEN v >= 1 AND NOT regexp_matches(canonical_url, '{RESTRICT}') THEN 'restrict'
                 WHEN v >= 3 AND regexp_matches(canonical_url, '{EXCLUDE}') THEN 'exclude' END AS failed FROM ruled),
firsts AS (SELECT website, canonical_url, min(page_id) AS first FROM checked WHERE failed IS NULL GROUP BY 1, 2)
SELECT website, page_id, CAST(arrived AS VARCHAR) AS arrived,
       CASE WHEN failed IS NOT NULL THEN failed WHEN page_id <> first THEN 'seen' END AS reason
FROM checked LEFT JOIN firsts USING (website, canonical_url)""")
def frontier_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions by the rules of a page's arrival; the last rules of some sites come late, and only those are decided again."""
    day = F.lit("2024-01-01").cast("date")
    pages = samples.host_pages(spark, sf).withColumn("arrived", F.date_add(day, (F.col("page_id") % 90).cast("int")))
    versions = samples.host_versions(pages, day, RESTRICT, EXCLUDE)
    before = versions.filter((F.col("v") < 4) & ((F.col("v") < 3) | (F.length("website") % 2 == 0)))
    stored = materialize(rule_versions.decide(pages, before.drop("v"), "arrived"), "decisions")
    decided = rule_versions.decide_again(stored, pages, before.drop("v"), versions.drop("v"), "arrived")
    return decided.join(pages.select("page_id", "arrived"), "page_id").select("website", "page_id", "arrived", "reason")


@query(f"""
WITH {SQL_HOST_PAGES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY website ORDER BY md5(canonical_url), canonical_url) AS place
  FROM (SELECT DISTINCT website, canonical_url FROM host_pages))
SELECT website, canonical_url FROM ranked WHERE place <= 3""")
def frontier_budget(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.with_rules(samples.host_pages(spark, sf), ignore_all=True, max_visits=3)
    rows = frontier.with_canonical_url(pages).select("website", "canonical_url", "max_visits")
    return frontier.within_budget(rows.distinct()).drop("max_visits")


# --- links -----------------------------------------------------------------

# Archive pages of each document: at sf0.01 the chain of a site is 4,200 pages long.
ARCHIVE_PAGES = 84


@query(f"""
WITH hrefs AS (
  SELECT {sql_host('url')} AS website, url AS from_url,
         unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT website, from_url, href,
       {sql_ascii("regexp_extract(from_url, '^([a-z]+://[^/?#]*)', 1) || " + sql_no_fragment('href'))} AS to_url
FROM hrefs""")
def link_harvest(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(samples.host_pages(spark, sf, "html"), samples.read_partitions(spark))
    return links.harvest(extract.read_pages_job(pages))


@query(f"""
WITH RECURSIVE {SQL_DOCS},
node AS (SELECT website, url, lang, doc_id, doc_id // 20 AS k, doc_id % 20 AS m FROM docs),
edge AS (
  SELECT n.doc_id AS from_id, c.doc_id AS to_id FROM node n JOIN node c
    ON c.m = n.m AND (c.k = 2 * n.k + 1 OR c.k = 2 * n.k + 2) WHERE n.lang <> 'de'),
walk AS (
  SELECT doc_id FROM node WHERE k = 0
  UNION SELECT e.to_id FROM walk w JOIN edge e ON e.from_id = w.doc_id)
SELECT website, url, CAST(floor(log2(k + 1)) AS INTEGER) AS depth FROM node JOIN walk USING (doc_id)""")
def crawl_reachable(spark: SparkSession, sf: str) -> DataFrame:
    sites, pages = samples.doc_sites(spark, sf), samples.doc_pages(spark, sf)
    read = extract.read_pages_job(pages)
    edges = links.site_edges(links.harvest(read), sites)
    return links.reachable(edges, sites, pages.select("website", "url"))


@query(f"""
WITH RECURSIVE {SQL_DOCS},
node AS (SELECT website, url, lang, doc_id, doc_id // 20 AS k, doc_id % 20 AS m FROM docs),
edge AS (
  SELECT n.doc_id AS from_id, c.doc_id AS to_id FROM node n JOIN node c
    ON c.m = n.m AND (c.k = 2 * n.k + 1 OR c.k = 2 * n.k + 2) WHERE n.lang <> 'de'),
walk AS (
  SELECT doc_id FROM node WHERE k = 0
  UNION SELECT e.to_id FROM walk w JOIN edge e ON e.from_id = w.doc_id),
placed AS (
  SELECT website, url, CAST(floor(log2(k + 1)) AS INTEGER) AS depth,
         row_number() OVER (PARTITION BY website ORDER BY floor(log2(k + 1)), md5(url), url) AS place
  FROM node JOIN walk USING (doc_id))
SELECT website, url, depth FROM placed WHERE place <= 10""")
def crawl_budget(spark: SparkSession, sf: str) -> DataFrame:
    _, run = _ingest(spark, sf, max_visits=10, follow_links=True)
    return run.visited


@query(f"""
WITH {SQL_DOCS},
archive AS (
  SELECT website, url || '?page=' || p AS url, doc_id, p,
         row_number() OVER (PARTITION BY website ORDER BY doc_id, p) - 1 AS place, count(*) OVER (PARTITION BY website) AS n
  FROM docs, range({ARCHIVE_PAGES}) r(p)),
kinds AS (SELECT *, CAST(substr(website, 4) AS INTEGER) % 4 AS kind, n // 2 AS half FROM archive)
SELECT website, url, CAST(CASE WHEN kind = 1 AND place >= half THEN place - half + 1 ELSE place END AS INTEGER) AS depth
FROM kinds WHERE kind <> 2 OR place < half""")
def crawl_long_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of which every page links to the next one only, walked in few rounds."""
    sites, edges, pages = samples.doc_archives(spark, sf, ARCHIVE_PAGES)
    return links.reachable_by_contraction(edges, sites, pages).pages


@query(f"""
WITH {SQL_DOCS}, node AS (SELECT website, url, doc_id, doc_id // 20 AS k, doc_id % 20 AS m, lang FROM docs)
SELECT DISTINCT website, url AS from_url, to_url FROM (
  SELECT website, url, unnest(
    CASE WHEN lang = 'de' THEN [] ELSE [(2 * k + 1) * 20 + m, (2 * k + 2) * 20 + m] END
    || CASE WHEN k = 0 THEN [] ELSE [(k - 1) // 2 * 20 + m] END) AS target FROM node) t,
  LATERAL (SELECT 'https://' || website || '.example.com/news/' || target AS to_url)""")
def link_same_host(spark: SparkSession, sf: str) -> DataFrame:
    """Every link also under another host, which is not followed."""
    harvested = links.harvest(extract.read_pages_job(samples.doc_pages(spark, sf)))
    elsewhere = F.regexp_replace("to_url", "^https://[^/]*", "https://other.example.org")
    both = harvested.withColumn("to_url", F.explode(F.array("to_url", elsewhere)))  # pages are read once
    return links.site_edges(both, samples.doc_sites(spark, sf))


# --- extraction ------------------------------------------------------------


@query("""
SELECT page_id, len(regexp_extract_all(html, '<article>')) AS n_content,
       len(regexp_extract_all(html, '<h1>')) AS n_title,
       len(regexp_extract_all(html, '<a ')) AS n_date FROM pages""")
def page_match_counts(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(samples.host_pages(spark, sf, "html"), samples.read_partitions(spark))
    pages = pages.withColumn("sel", samples.selector_struct(samples.PAGE_SELECTORS))
    read = extract.read_pages_job(pages, keep_links=False)
    return read.select("page_id", "n_content", "n_title", "n_date")


@query("""
SELECT url, false AS is_article FROM pages UNION ALL
SELECT 'https://' || source || '.example.com/news/' || doc_id, n_chars >= 300 FROM documents""")
def article_predicate(spark: SparkSession, sf: str) -> DataFrame:
    raw = samples.host_pages(spark, sf, "html")
    selectors = dict(title="article h1", content="article", date="time")
    both = spread(raw, samples.read_partitions(spark)).unionByName(samples.doc_pages(spark, sf))
    both = both.withColumn("sel", samples.selector_struct(selectors))
    read = extract.read_pages_job(both, keep_links=False)
    return read.select("url", extract.is_article().alias("is_article"))


def _read_documents(spark: SparkSession, sf: str, **options) -> DataFrame:
    sites = samples.doc_sites(spark, sf)
    ruled = with_reading_rules(samples.doc_pages(spark, sf), sites)
    return read_articles(ruled, layouts=site_layouts(sites), **options)


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    return _read_documents(spark, sf).filter(F.col("reason").isNull())


@query(f"""
WITH {SQL_DOCS}
SELECT website, url, title, {SQL_CLEAN} AS content, CAST(date AS VARCHAR) AS date
FROM docs WHERE {SQL_GOOD}""")
def extract_articles(spark: SparkSession, sf: str) -> DataFrame:
    return _extracted(spark, sf).select("website", "url", "title", "content", "date")


@query(f"WITH {SQL_DOCS} SELECT website, url, description, author FROM docs WHERE {SQL_GOOD}")
def extract_optional(spark: SparkSession, sf: str) -> DataFrame:
    return _extracted(spark, sf).select("website", "url", "description", "author")


@query(f"""
WITH {SQL_DOCS}
SELECT url, {SQL_CLEAN} AS content, CASE lang WHEN 'fr' THEN 1 ELSE 0 END AS n_warnings
FROM docs WHERE n_chars >= 300""")
def extract_clean_content(spark: SparkSession, sf: str) -> DataFrame:
    pages = samples.doc_pages(spark, sf)
    pages = pages.withColumn("sel", samples.selector_struct(samples.DOC_SELECTORS))
    read = extract.read_pages_job(pages, keep_links=False).filter(extract.is_article())
    return read.select("url", "content", F.size("warnings").alias("n_warnings"))


@query(f"""
WITH {SQL_DOCS}
SELECT url, title, 'h1' AS description, author FROM docs WHERE {SQL_GOOD}""")
def extract_first_child(spark: SparkSession, sf: str) -> DataFrame:
    """Fields from the first child of their element: an element's name, or text, or a link's text."""
    sites = samples.doc_sites(spark, sf)
    selectors = {**samples.DOC_SELECTORS, "description": "#main-article"}
    ruled = with_reading_rules(samples.doc_pages(spark, sf), sites.withColumn("sel", samples.selector_struct(selectors)))
    read = read_articles(ruled, text_mode="first_child", layouts=site_layouts(sites))
    return read.filter(F.col("reason").isNull()).select("url", "title", "description", "author")


@query(f"""
WITH {SQL_DOCS}
SELECT url, CASE WHEN contains(text, '|') THEN '0001-01-01' ELSE CAST(date AS VARCHAR) END AS date,
       CASE lang WHEN 'fr' THEN 1 ELSE 0 END + CAST(contains(text, '|') AS INTEGER) AS n_warnings
FROM docs WHERE n_chars >= 300""")
def extract_zero_date(spark: SparkSession, sf: str) -> DataFrame:
    read = _read_documents(spark, sf, on_bad_date="zero_date").filter(F.col("reason").isNull())
    return read.select("url", "date", F.size("warnings").alias("n_warnings"))


@query(f"""
WITH {SQL_DOCS}
SELECT website, CASE WHEN n_chars < 300 THEN 'not_article' ELSE 'bad_date' END AS reason,
       count(*) AS n FROM docs WHERE NOT ({SQL_GOOD}) GROUP BY 1, 2""")
def extract_rejects(spark: SparkSession, sf: str) -> DataFrame:
    read = _read_documents(spark, sf)
    rejects = reports.rejects_of(read, detail="detail")
    return reports.reject_report(rejects).drop("kind")


# --- dates -----------------------------------------------------------------

# One layout per order priority; together they use every placeholder.
ORDER_LAYOUTS = {
    "1-URGENT": ("{DAY_LONG}, {DAY_NUM} {MONTH_LONG} {YEAR_LONG}", "EEEE, d MMMM yyyy"),
    "2-HIGH": ("{MONTH_NUM}/{DAY_NUM}/{YEAR_SHORT}", "MM/dd/yy"),
    "3-MEDIUM": (
        "{DAY_SHORT} {MONTH_SHORT} {DAY_NUM} {HOURS}:{MINUTES}:{SECONDS} {ZONE_ABBREV} {YEAR_LONG}",
        "EEE MMM d H:mm:ss 'CEST' yyyy",
    ),
    "4-NOT SPECIFIED": (
        "{YEAR_LONG}-{MONTH_NUM}-{DAY_NUM}T{HOURS}:{MINUTES}:{SECONDS}{ZONE_OFFSET}",
        "yyyy-MM-dd'T'HH:mm:ss.SSS'-0700'",
    ),
    "5-LOW": ("Posted on {DAY_NUM}. {MONTH_SHORT} {YEAR_LONG} (at {HOURS}h{MINUTES})",
              "'Posted on' d. MMM yyyy '(at 'H'h'mm')'"),
}


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def date_layouts(spark: SparkSession, sf: str) -> DataFrame:
    moment = F.col("o_orderdate") + F.make_dt_interval(mins=F.col("o_custkey") % 1440)
    printed = pattern = rewrite = F.lit(None).cast("string")
    for priority, (layout, spark_pattern) in ORDER_LAYOUTS.items():
        here, known = F.col("o_orderpriority") == priority, translate_layout(layout)
        printed = F.when(here, F.date_format(moment, spark_pattern)).otherwise(printed)
        pattern = F.when(here, F.lit(known.pattern)).otherwise(pattern)
        rewrite = F.when(here, F.lit(known.rewrite)).otherwise(rewrite)
    orders = spread(samples.table(spark, sf, "orders"), samples.read_partitions(spark), "o_orderkey")
    return orders.select("o_orderkey", parse_date(printed, pattern, rewrite).alias("date"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS date
FROM orders""")
def date_bad_values(spark: SparkSession, sf: str) -> DataFrame:
    layout = translate_layout("{DAY_NUM} {MONTH_LONG} {YEAR_LONG}")
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when(status == "P", F.date_format(day, "d MMMM yyyy"))
        .when(status == "F", F.date_format(day, "'31' 'February' yyyy"))
        .otherwise(F.date_format(day, "d MM yyyy"))
    )
    orders = spread(samples.table(spark, sf, "orders"), samples.read_partitions(spark), "o_orderkey")
    parsed = parse_date(text, F.lit(layout.pattern), F.lit(layout.rewrite))
    return orders.select("o_orderkey", parsed.alias("date"))


# --- store -----------------------------------------------------------------


@query(f"""
WITH {SQL_DOCS}, arrived AS (
  SELECT 1 AS batch, * FROM docs WHERE lang IN ('en', 'es') UNION ALL SELECT 2, * FROM docs),
judged AS (
  SELECT batch, doc_id, contains(text, '|') AS untitled,
         row_number() OVER (PARTITION BY n_chars, contains(text, '|') ORDER BY batch, doc_id) AS place
  FROM arrived)
SELECT batch, doc_id, CASE WHEN untitled THEN 'null_title'
                           WHEN place > 1 THEN 'duplicate_url' END AS reason FROM judged""")
def store_first_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    # documents of equal length claim the same URL, across websites and batches
    docs = samples.documents_of_sites(spark, sf).withColumns(
        {
            "seq": F.col("doc_id"),
            "url": F.concat(F.lit("https://wire.example.com/"), F.col("n_chars").cast("string")),
            "title": F.when(~F.contains("text", F.lit("|")), F.col("title")),
            "content": F.col("text"),
        }
    )
    first = docs.filter(F.col("lang").isin("en", "es"))
    first_judged = store.first_write_wins(first).withColumn("batch", F.lit(1))
    stored = first_judged.filter(F.col("reason").isNull())
    second_judged = store.first_write_wins(docs, stored).withColumn("batch", F.lit(2))
    return first_judged.unionByName(second_judged).select("batch", "doc_id", "reason")


def _stored_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Document articles after a trip through the article store."""
    articles = ParquetStore(spark, scratch_path(spark, "articles"))
    articles.append(samples.doc_articles(spark, sf))
    return articles.read()


@query(f"WITH {SQL_DOCS} SELECT website, url FROM docs")
def stored_urls(spark: SparkSession, sf: str) -> DataFrame:
    return store.stored_urls(_stored_articles(spark, sf))


@query("""
WITH counted AS (SELECT source AS website, count(*) AS n FROM documents GROUP BY 1),
sites AS (SELECT website FROM counted UNION SELECT DISTINCT 'lost-' || lang FROM documents)
SELECT website, coalesce(n, 0) AS n_stored FROM sites LEFT JOIN counted USING (website)""")
def stored_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = samples.table(spark, sf, "documents")
    sites = docs.select(F.col("source").alias("website")).union(docs.select(F.concat(F.lit("lost-"), "lang")))
    return store.stored_counts(_stored_articles(spark, sf), sites)


@query(f"""
WITH {SQL_LATEST}
SELECT website, url, CAST(date AS VARCHAR) AS date FROM ranked WHERE website = 'src1' AND rn <= 20""")
def latest_of_one_site(spark: SparkSession, sf: str) -> DataFrame:
    return store.latest_for(samples.doc_articles(spark, sf), "src1", 20).select("website", "url", "date")


@query(f"""
WITH {SQL_DOCS}
SELECT website, url, title, description, text AS content, author, CAST(date AS VARCHAR) AS date FROM docs""")
def stored_articles(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_articles(spark, sf)


@query(f"WITH {SQL_LATEST} SELECT website, rn, url, CAST(date AS VARCHAR) AS date FROM ranked WHERE rn <= 20")
def latest_n(spark: SparkSession, sf: str) -> DataFrame:
    latest = store.latest_n(samples.doc_articles(spark, sf), 20)
    return latest.select("website", "rn", "url", "date")


@query(SQL["latest_n"])
def latest_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """The latest articles kept up to date over five batches."""
    kept, articles = LatestArticles(spark, scratch_path(spark, "tops"), 20), samples.doc_articles(spark, sf)
    for k in range(5):
        kept.update(articles.filter(F.pmod(F.xxhash64("url"), F.lit(5)) == k))
    return kept.latest().select("website", "rn", "url", "date")


# --- feeds -----------------------------------------------------------------


@query(f"""
WITH {SQL_LATEST}
SELECT website, website AS title, 'https://' || website || '.example.com' AS link
FROM ranked WHERE rn = 1""")
def feed_headers(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed_headers(samples.doc_articles(spark, sf))


@query(f"""
WITH {SQL_LATEST}
SELECT website, rn, title, url AS link, CAST(date AS VARCHAR) AS created, text AS content,
       coalesce(description, '') AS description, author FROM ranked WHERE rn <= 20""")
def feed_items(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed_items(samples.doc_articles(spark, sf), 20)


@query("""
WITH requested AS (
  SELECT DISTINCT source AS website FROM documents UNION
  SELECT DISTINCT 'lost-' || lang FROM documents),
counted AS (SELECT source AS website, least(count(*), 20) AS n FROM documents GROUP BY 1)
SELECT website, CASE WHEN n IS NULL THEN 'unknown' ELSE 'ok' END AS status,
       coalesce(n, 0) AS n_items FROM requested LEFT JOIN counted USING (website)""")
def feed_unknown(spark: SparkSession, sf: str) -> DataFrame:
    docs = samples.table(spark, sf, "documents")
    requested = docs.select(F.col("source").alias("website")).union(
        docs.select(F.concat(F.lit("lost-"), "lang"))
    )
    built = feeds.build_feeds(samples.doc_articles(spark, sf), 20, "rss", requested)
    return built.select("website", "status", "n_items")


SQL_RSS_ITEM = (
    "'<item><title>' || " + sql_escape("title") + " || '</title><link>' || " + sql_escape("url")
    + " || '</link><description>' || " + sql_escape("coalesce(description, '')")
    + " || '</description><content:encoded>' || " + sql_escape("text") + " || '</content:encoded>'"
    + " || CASE WHEN author IS NULL THEN '' ELSE '<author>' || " + sql_escape("author")
    + " || '</author>' END || '<pubDate>' || strftime(date, '%a, %d %b %Y 00:00:00 +0000')"
    + " || '</pubDate></item>'"
)
SQL_RSS = f"""
WITH {SQL_LATEST}
SELECT website, '<?xml version="1.0" encoding="UTF-8"?>'
  || '<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>'
  || website || '</title><link>https://' || website || '.example.com</link><description></description>'
  || string_agg({SQL_RSS_ITEM}, '' ORDER BY rn) || '</channel></rss>' AS xml
FROM ranked WHERE rn <= 5 GROUP BY website"""

SQL_ATOM_ENTRY = (
    "'<entry><title>' || " + sql_escape("title") + " || '</title><updated>'"
    + " || strftime(date, '%Y-%m-%dT00:00:00Z') || '</updated><id>' || url"
    + " || '</id><content type=\"html\">' || " + sql_escape("text")
    + " || '</content><link href=\"' || url || '\" rel=\"alternate\"/><summary type=\"html\">' || "
    + sql_escape("coalesce(description, '')") + " || '</summary>'"
    + " || CASE WHEN author IS NULL THEN '' ELSE '<author><name>' || " + sql_escape("author")
    + " || '</name></author>' END || '</entry>'"
)
SQL_ATOM = f"""
WITH {SQL_LATEST}
SELECT website, '<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>'
  || website || '</title><id>https://' || website || '.example.com</id><updated>'
  || strftime(max(date), '%Y-%m-%dT00:00:00Z') || '</updated><link href="https://' || website
  || '.example.com"/><author><name>' || website || '</name></author>'
  || string_agg({SQL_ATOM_ENTRY}, '' ORDER BY rn) || '</feed>' AS xml
FROM ranked WHERE rn <= 5 GROUP BY website"""


@query(SQL_RSS)
def feed_rss(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.build_feeds(samples.doc_articles(spark, sf), 5, "rss").select("website", "xml")


@query(SQL_ATOM)
def feed_atom(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.build_feeds(samples.doc_articles(spark, sf), 5, "atom").select("website", "xml")


@query(f"""
WITH documents_as_rss AS ({SQL_RSS})
SELECT website, strlen(xml) AS content_length, 'rss' AS feed_type, 5 AS nb_items FROM documents_as_rss""")
def feed_stats(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.feed_stats(feeds.build_feeds(samples.doc_articles(spark, sf), 5, "rss"), 5)


@query(SQL_ATOM)
def feed_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Feed documents written as one text file per website and read back."""
    path = scratch_path(spark, "feeds")
    feeds.write_feeds(feeds.build_feeds(samples.doc_articles(spark, sf), 5, "atom"), path)
    return feeds.read_feeds(spark, path)


@query(SQL_ATOM)
def feed_sink_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Feed documents of two updates, the second of which changes those of some websites only."""
    path, articles = scratch_path(spark, "feeds"), samples.doc_articles(spark, sf)
    late = F.col("website").isin("src1", "src2", "src3") & (F.pmod(F.xxhash64("url"), F.lit(2)) == 0)
    for batch in (articles.filter(~late), articles):
        feeds.update_feeds(feeds.build_feeds(batch, 5, "atom"), path)
    return feeds.read_feeds(spark, path)


# --- runs ------------------------------------------------------------------

BUDGET = 30


def _ingest(spark: SparkSession, sf: str, kind=ParquetStore, **options):
    store_ = kind(spark, scratch_path(spark, "articles"))
    run = run_ingest(
        spark,
        samples.doc_pages_with_copies(spark, sf),
        samples.doc_sites(spark, sf, max_visits=options.pop("max_visits", 0)),
        store_,
        scratch_path(spark, "rejects"),
        **options,
    )
    return store_, run


SQL_RUN = f"""{SQL_DOCS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY website ORDER BY md5(url), url) AS place FROM docs),
taken AS (SELECT * FROM placed WHERE place <= {BUDGET})"""


@query(f"""
WITH {SQL_RUN}, rejects AS (
  SELECT website, 'filter' AS kind, 'seen' AS reason FROM docs WHERE lang = 'es'
  UNION ALL SELECT website, 'filter', 'budget' FROM placed WHERE place > {BUDGET}
  UNION ALL SELECT website, 'page', 'not_article' FROM taken WHERE n_chars < 300
  UNION ALL SELECT website, 'date', 'bad_date' FROM taken WHERE n_chars >= 300 AND contains(text, '|')
  UNION ALL SELECT website, 'link', 'bad_link' FROM taken WHERE lang = 'fr' AND {SQL_GOOD})
SELECT website, kind, reason, count(*) AS n FROM rejects GROUP BY 1, 2, 3""")
def reject_report(spark: SparkSession, sf: str) -> DataFrame:
    _, run = _ingest(spark, sf, max_visits=BUDGET)
    return reports.reject_report(run.rejects)


@query(f"""
WITH {SQL_RUN}
SELECT website, count(*) AS n_accepted, count(*) FILTER (WHERE {SQL_GOOD}) AS n_saved,
       count(*) FILTER (WHERE NOT ({SQL_GOOD})) AS n_rejected,
       CASE WHEN count(*) >= {BUDGET} THEN 'budget' ELSE 'exhausted' END AS stop_reason
FROM taken GROUP BY website""")
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    _, run = _ingest(spark, sf, max_visits=BUDGET)
    return run.report


@query(f"""
WITH {SQL_DOCS}, seen AS (SELECT *, CASE WHEN lang <> 'de' THEN url END AS page_url FROM docs)
SELECT website, 'page' AS kind, 'page error' || coalesce(' on ' || page_url, '')
       || ': content_matches=1 title_matches=1 date_matches=0' AS message FROM seen WHERE n_chars < 300
UNION ALL SELECT website, 'date', 'date error' || coalesce(' on ' || page_url, '') || ': 31 February 2024'
  FROM seen WHERE n_chars >= 300 AND contains(text, '|')
UNION ALL SELECT website, 'save', 'Unknown save error' FROM seen WHERE {SQL_GOOD} AND page_url IS NULL
UNION ALL SELECT website, 'filter', 'Unknown filter error on ' || url || '?copy=1#top' FROM docs WHERE lang = 'es'""")
def reject_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of reading, the URLs of German pages being lost, and of the copies of Spanish pages."""
    read = _read_documents(spark, sf)
    lost = samples.documents_of_sites(spark, sf).filter("lang = 'de'").select(F.col("doc_id").alias("page_id"))
    read = read.join(lost.withColumn("lost", F.lit(True)), "page_id", "left")
    url = F.when(F.col("lost").isNull(), F.col("url"))
    reason = F.when(F.col("reason").isNull() & F.col("lost"), "null_url").otherwise(F.col("reason"))
    pages = samples.doc_pages_with_copies(spark, sf).drop("html")
    decided = frontier.decide(frontier.check(assign_sites(pages, samples.doc_sites(spark, sf))))
    rejects = reports.rejects_of(read.withColumns({"url": url, "reason": reason}), detail="detail").unionByName(
        reports.rejects_of(decided)
    )
    message = reports.reject_message(F.col("kind"), F.col("page_url"), F.col("detail"))
    return rejects.select("website", "kind", message.alias("message"))


SQL_STORED = f"""
WITH {SQL_DOCS}
SELECT website, url, title, description, {SQL_CLEAN} AS content, author, CAST(date AS VARCHAR) AS date
FROM docs WHERE {SQL_GOOD}"""


@query(SQL_STORED)
def ingest_batch(spark: SparkSession, sf: str) -> DataFrame:
    articles, _ = _ingest(spark, sf)
    return articles.read()


@query(SQL_STORED)
def ingest_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same pages, the stored URLs being looked up in an index: the second adds nothing."""
    articles, _ = _ingest(spark, sf, kind=IndexedStore)
    run_ingest(spark, samples.doc_pages_with_copies(spark, sf), samples.doc_sites(spark, sf), articles, scratch_path(spark, "rejects"))
    return articles.read()


@query(f"""
WITH RECURSIVE {SQL_DOCS},
node AS (SELECT *, doc_id // 20 AS k, doc_id % 20 AS m FROM docs),
edge AS (
  SELECT n.doc_id AS from_id, c.doc_id AS to_id FROM node n JOIN node c
    ON c.m = n.m AND (c.k = 2 * n.k + 1 OR c.k = 2 * n.k + 2) WHERE n.lang <> 'de'),
walk AS (
  SELECT doc_id FROM node WHERE k = 0
  UNION SELECT e.to_id FROM walk w JOIN edge e ON e.from_id = w.doc_id)
SELECT website, url, title, author, CAST(date AS VARCHAR) AS date FROM node JOIN walk USING (doc_id) WHERE {SQL_GOOD}""")
def ingest_following_links(spark: SparkSession, sf: str) -> DataFrame:
    articles, _ = _ingest(spark, sf, follow_links=True)
    return articles.read().select("website", "url", "title", "author", "date")


@query(SQL["ingest_following_links"])
def ingest_links_across_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages landing in three batches, children before parents and start pages last."""
    pages, sites = samples.doc_pages_with_copies(spark, sf), samples.doc_sites(spark, sf)
    articles, state = ParquetStore(spark, scratch_path(spark, "articles")), LinkState(spark, scratch_path(spark, "links"))
    place = F.floor(F.col("page_id") % (1 << 40) / samples.DOC_SITES)
    for batch in (place >= 7, (place > 0) & (place < 7), place == 0):
        landed = materialize(pages.filter(batch), "landed")
        run_ingest(spark, landed, sites, articles, scratch_path(spark, "rejects"), follow_links=True, link_state=state)
    return articles.read().select("website", "url", "title", "author", "date")


@query(SQL_STORED)
def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages landing in two halves of several files, ingested by two calls of a stream."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    pages = samples.doc_pages_with_copies(spark, sf)
    schema = pages.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    articles, rejects = ParquetStore(spark, scratch_path(spark, "articles")), scratch_path(spark, "rejects")
    for half in (F.col("url").contains("?"), ~F.col("url").contains("?")):
        pages.filter(half).write.mode("append").parquet(landing)
        ingest_landing(
            spark, landing, samples.doc_sites(spark, sf), articles, rejects, checkpoint=checkpoint, name="landing", schema=schema
        )
    return articles.read()


@query(SQL_STORED)
def ingest_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Pages landing in three batches, the later ones with pages of the earlier ones again: each is read once."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    pages, sites = samples.doc_pages_with_copies(spark, sf), samples.doc_sites(spark, sf)
    schema = pages.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    articles, rejects = ParquetStore(spark, scratch_path(spark, "articles")), scratch_path(spark, "rejects")
    third = F.pmod(F.xxhash64("page_id"), F.lit(3))
    for batch in (third == 0, third < 2, third > 0):
        pages.filter(batch).write.mode("append").parquet(landing)
        ingest_landing(
            spark, landing, sites, articles, rejects, checkpoint=checkpoint, name="repeats", schema=schema, remember="30 days"
        )
    return articles.read()
