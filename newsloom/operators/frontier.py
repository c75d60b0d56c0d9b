"""Which pages are taken: canonical URLs, filters, duplicates, visit budgets.

Every step works on narrow rows (ids and URLs, never markup). Duplicates and
already stored pages are decided on one pre-aggregated row per canonical URL
and handed back through the unique ``page_id``, so a URL, group of copies or
site holding a third of all rows never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import urls

# Hex digits of the URL hash that split one site and depth into buckets.
BUCKET_DIGITS = 3
# Keys that rows of one URL are dealt to before they meet what is known of that URL.
SALTS = 32


def with_canonical_url(pages: DataFrame) -> DataFrame:
    """Add ``canonical_url`` from ``url`` by the rules of the row's site."""
    url = urls.canonical(F.col("url"), F.col("ignore_all"), F.col("listed_keys"))
    return pages.withColumn("canonical_url", url)


def _found(url: Column, pattern: Column) -> Column:
    """Like ``rlike``, but a pattern is compiled when it changes from row to row, not for each row."""
    return F.regexp_instr(url, pattern) > 0


def passes_restrict(url: Column, restrict: Column) -> Column:
    return restrict.isNull() | _found(url, restrict)


def passes_exclude(url: Column, exclude: Column) -> Column:
    return exclude.isNull() | ~_found(url, exclude)


def filter_reason(url: Column) -> Column:
    """Reject reason of the per-row URL tests, null when all pass."""
    return (
        F.when(url.isNull() | ~urls.has_article_scheme(url), "bad_scheme")
        .when(~passes_restrict(url, F.col("restrict")), "restrict")
        .when(~passes_exclude(url, F.col("exclude")), "exclude")
    )


def first_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The smallest ``order`` value per key, combined before the shuffle."""
    return rows.groupBy(*keys).agg(F.min(order).alias(order))


def already_there(rows: DataFrame, keys: list[str], stored) -> DataFrame:
    """Keys of ``rows`` that ``stored`` holds, a table or an index of URLs.

    Reduces a table first: when the new rows are few they are broadcast and
    the store is scanned without a shuffle, however large it has become. An index
    is asked for the buckets of the new rows only.
    """
    if not isinstance(stored, DataFrame):
        return stored.holding(rows, keys)
    if "canonical_url" in keys and "canonical_url" not in stored.columns:
        stored = stored.withColumnRenamed("url", "canonical_url")
    return stored.select(*keys).join(rows.select(*keys), keys, "left_semi")


def unseen(rows: DataFrame, keys: list[str], stored: DataFrame) -> DataFrame:
    """Rows whose key is not stored yet; ``stored`` must hold the key columns.

    ``rows`` hold each key once, or few times; see ``unseen_rows`` for others.
    """
    return rows.join(already_there(rows, keys, stored), keys, "left_anti")


def unseen_rows(rows: DataFrame, keys: list[str], stored: DataFrame, order: str = "page_id") -> DataFrame:
    """``unseen`` for rows of which many may share a key.

    The keys are made distinct before they are looked up, and the stored ones meet
    their rows under the salts that these have, so copies of one URL go to at most
    ``SALTS`` tasks and a key of one row is there once.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(SALTS)).cast("int"))
    used = salted.select(*keys, "_salt").distinct()
    known = already_there(rows.select(*keys).distinct(), keys, stored).distinct()
    return salted.join(used.join(known, keys, "left_semi"), [*keys, "_salt"], "left_anti").drop("_salt")


def check(pages: DataFrame, enter_start: bool = False) -> DataFrame:
    """Per-row part of the decisions: canonical URL and the filter it fails, if any.

    Rows are sorted by site inside partitions, so each site's patterns are compiled
    once a partition. With ``enter_start`` the start point of a site (its rules are
    columns of ``pages``) passes whatever the filters say, and is marked.
    """
    checked = (
        with_canonical_url(pages)
        .sortWithinPartitions("website")
        .withColumn("failed", filter_reason(F.col("canonical_url")))
    )
    is_start = F.lit(False)
    if enter_start:
        start = urls.canonical(F.col("start_point"), F.col("ignore_all"), F.col("listed_keys"))
        is_start = F.coalesce(F.col("canonical_url") == start, F.lit(False))
    return checked.withColumn("is_start", is_start).select(
        "page_id",
        "website",
        "url",
        "canonical_url",
        "max_visits",
        "is_start",
        F.when(~F.col("is_start"), F.col("failed")).alias("failed"),
    )


def page_key() -> Column:
    """What tells a page of a site: its canonical URL, or the URL as found where there is none."""
    return F.coalesce("canonical_url", "url", F.lit(""))


def mark_seen(checked: DataFrame, fresh: DataFrame) -> DataFrame:
    """Checked pages whose key isn't among the ``fresh`` ones (website, key) fail as seen.

    Fresh keys meet their pages under the salts that these have, as in ``unseen_rows``.
    """
    place = ["website", "key", "_salt"]
    salted = checked.withColumns({"key": page_key(), "_salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")})
    used = salted.select(*place).distinct()
    marks = used.join(fresh.select("website", "key"), ["website", "key"], "left_semi").withColumn("_fresh", F.lit(True))
    joined = salted.join(marks, place, "left")
    seen = F.when(F.col("_fresh").isNull(), F.coalesce("failed", F.lit("seen"))).otherwise(F.col("failed"))
    return joined.withColumn("failed", seen).select(*checked.columns)


def decide(checked: DataFrame, stored=None) -> DataFrame:
    """Accept or reject every checked page; ``stored`` is a table of articles or an index of their URLs.

    Out: ``page_id``, ``website``, ``url``, ``canonical_url``, ``max_visits``,
    ``accepted``, ``reason``. Of the pages of one site with one canonical URL the
    one with the smallest ``page_id`` is kept; the others are ``seen``. A start
    point that is to be entered is entered although it is stored.
    ``checked`` is used three times: on large inputs pass a stored table.
    """
    key = ["website", "canonical_url"]
    firsts = first_of_each(checked.filter(F.col("failed").isNull()), key, "page_id")
    if stored is None:
        firsts = firsts.withColumn("is_stored", F.lit(False))
    else:
        known = already_there(firsts, key, stored)
        firsts = firsts.join(known.withColumn("is_stored", F.lit(True)), key, "left").withColumn(
            "is_stored", F.coalesce("is_stored", F.lit(False))
        )
    reason = (
        F.when(F.col("failed").isNotNull(), F.col("failed"))
        .when(F.col("is_stored").isNull(), "seen")
        .when(F.col("is_stored") & ~F.coalesce(F.col("is_start"), F.lit(False)), "stored")
    )
    if "is_start" not in checked.columns:
        checked = checked.withColumn("is_start", F.lit(False))
    # page_id and website are unique together: this join has no hot key
    return (
        checked.join(firsts.drop("canonical_url"), ["page_id", "website"], "left")
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
        .select(
            "page_id", "website", "url", "canonical_url", "max_visits", "is_start", "accepted", "reason"
        )
    )


def _rank_in_site(rows: DataFrame, url: str, depth: str | None) -> DataFrame:
    """Add ``_place``, the 1-based position in the order (depth, URL hash, URL).

    Exact for any site size without sorting a site in one task: counts per hash
    bucket are combined before the shuffle and summed up per site, and rows are
    ranked inside (site, depth, bucket) groups only. Buckets that start beyond the
    budget are dropped before ranking.
    """
    level = F.col(depth) if depth else F.lit(0)
    hashed = rows.withColumns({"_level": level, "_hash": F.md5(F.col(url))}).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    group = ["website", "_level", "_bucket"]
    earlier = (
        Window.partitionBy("website")
        .orderBy("_level", "_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        hashed.groupBy(*group)
        .agg(F.count("*").alias("_n"))
        .select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    joined = hashed.join(before, group).filter(F.col("_before") < F.col("max_visits"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_hash", url))
    return joined.withColumn("_place", F.col("_before") + rank).select(*rows.columns, "_place")


def _limited() -> Column:
    return F.coalesce(F.col("max_visits"), F.lit(0)) > 0


def within_budget(
    rows: DataFrame, url: str = "canonical_url", depth: str | None = None
) -> DataFrame:
    """Rows inside ``max_visits`` of their site; 0 or null is unlimited and costs nothing."""
    ranked = _rank_in_site(rows.filter(_limited()), url, depth)
    inside = ranked.filter(F.col("_place") <= F.col("max_visits")).drop("_place")
    return rows.filter(~_limited()).unionByName(inside)


def apply_budget(decisions: DataFrame) -> DataFrame:
    """Turn accepted pages beyond their site's budget into ``budget`` rejects.

    Only the buckets before the cut are ranked; pages after it need no place.
    """
    counted = F.col("accepted") & _limited()
    inside = within_budget(decisions.filter(counted)).select("page_id", "website", F.lit(True).alias("_in"))
    over = F.col("accepted") & _limited() & F.col("_in").isNull()
    return (
        decisions.join(inside, ["page_id", "website"], "left")
        .withColumn("reason", F.when(over, "budget").otherwise(F.col("reason")))
        .withColumn("accepted", F.col("reason").isNull())
        .drop("_in")
    )
