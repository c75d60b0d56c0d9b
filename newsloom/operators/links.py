"""Link discovery: harvested links and reachability from the start points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import urls
from newsloom.operators.frontier import filter_reason, unseen, within_budget
from newsloom.scratch import materialize, materialize_bucketed, scratch_path
from newsloom.sources.pages import join_rules

# Pointers up to which chains are followed by pointer jumping alone.
FEW_POINTERS = 500_000


def harvest(read: DataFrame) -> DataFrame:
    """One row per link of a page, in document order, resolved against the page URL.

    In: ``website``, ``url``, ``links`` of the page-reading job. Out:
    ``website``, ``from_url``, ``href``, ``to_url``; only http and https targets,
    fragments removed.
    """
    pages = read.select(
        "website",
        F.col("url").alias("from_url"),
        urls.base_parts(F.col("url")).alias("base"),
        "links",
    )
    listed = pages.withColumn("href", F.explode("links"))
    target = urls.resolve(F.col("base"), urls.trimmed(F.col("href")))
    # generated, so that filters on the target, here and later, don't resolve the link once more
    found = F.explode(F.array(urls.strip_fragment(target))).alias("to_url")
    return listed.select("website", "from_url", "href", found).filter(urls.has_article_scheme(F.col("to_url")))


def same_host(url: Column, start_point: Column) -> Column:
    return urls.host(url) == urls.host(start_point)


def site_edges(links: DataFrame, sites: DataFrame, one_host: bool = True) -> DataFrame:
    """Accepted links as distinct edges between canonical URLs of one site."""
    rules = sites.select(
        "website", "start_point", "ignore_all", "listed_keys", "restrict", "exclude"
    )
    canonical = lambda c: urls.canonical(F.col(c), F.col("ignore_all"), F.col("listed_keys"))
    ruled = join_rules(links, rules, "website", F.col("to_url")).sortWithinPartitions("website")
    edges = ruled.withColumns({"from_url": canonical("from_url"), "to_url": canonical("to_url")})
    if one_host:
        edges = edges.filter(same_host(F.col("to_url"), F.col("start_point")))
    return (
        edges.filter(urls.let(F.col("to_url"), filter_reason).isNull())
        .select("website", "from_url", "to_url")
        .distinct()
    )


def reachable(
    edges: DataFrame,
    sites: DataFrame,
    page_urls: DataFrame,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Pages reachable from each site's start point, breadth first.

    ``edges`` (website, from_url, to_url) are accepted links, ``page_urls``
    (website, url) the canonical URLs that exist as pages. Start points bypass
    the URL filters. Already stored pages are not entered. The budget of a site
    is spent level by level, in URL-hash order inside a level.

    All sites advance together, one round of jobs per depth. Every level is a
    partition of one table in the shared scratch folder: lineage and plans stay
    short, lost executors cost one round at most, and real sizes decide how the
    next round joins. A small level is broadcast against edges and pages, which are
    then scanned; for a large one the edges lie in buckets by their origin, so they
    are not shuffled again. Targets are made distinct before anything is looked up:
    a home page that every page links to is one row. Out: ``website``, ``url``, ``depth``.
    """
    spark, key = edges.sparkSession, ["website", "url"]
    allowed = page_urls.select(*key)
    if stored is not None:
        allowed = unseen(allowed, key, stored)
    allowed = materialize(allowed.distinct(), "allowed")
    hops = materialize_bucketed(edges.select("website", "from_url", "to_url"), "hops", ["website", "from_url"])
    start = urls.canonical(F.col("start_point"), F.col("ignore_all"), F.col("listed_keys"))
    seeds = sites.select("website", start.alias("url"))
    limits = sites.filter(F.col("max_visits") > 0).select("website", "max_visits")
    limited = not limits.isEmpty()

    folder, depth = scratch_path(spark, "levels"), 0
    level_path = lambda: f"{folder}/depth={depth}"
    read_level = lambda: spark.read.schema("website string, url string").parquet(level_path())
    page_urls.select(*key).join(seeds, key, "left_semi").distinct().write.parquet(level_path())
    visited = lambda: spark.read.schema("website string, url string, depth int").parquet(folder)
    while not read_level().isEmpty():
        found = materialize(
            read_level()
            .select("website", F.col("url").alias("from_url"))
            .join(hops, ["website", "from_url"])
            .select("website", F.col("to_url").alias("url"))
            .distinct(),
            "found",
        )
        fresh = unseen(found.join(allowed, key, "left_semi"), key, visited())
        if limited:
            fresh = spend(fresh, limits, visited())
        depth += 1
        fresh.write.parquet(level_path())
    return visited()


def spend(fresh: DataFrame, limits: DataFrame, visited: DataFrame) -> DataFrame:
    """New pages that what is left of each site's budget allows."""
    spent = visited.groupBy("website").agg(F.count("*").alias("_spent"))
    rest = F.coalesce(F.col("max_visits") - F.col("_spent"), F.col("max_visits"))
    left = limits.join(spent, "website", "left").select("website", rest.alias("max_visits"))
    # no limit is null here: a spent budget is 0 and must not read as unlimited
    open_sites = F.col("max_visits").isNull() | (F.col("max_visits") > 0)
    allowed = fresh.join(left, "website", "left").filter(open_sites)
    return within_budget(allowed, url="url").select("website", "url")


@dataclass(frozen=True)
class Walk:
    """Reached pages (website, url, depth) and the rounds of jobs that it took."""

    pages: DataFrame
    rounds: int


def reachable_by_contraction(edges: DataFrame, sites: DataFrame, page_urls: DataFrame, few: int = FEW_POINTERS) -> Walk:
    """``reachable`` without budgets, in rounds that don't grow with the length of link chains.

    A page that only one page links to is one step further than that page, however far
    that is. Such pages are hung on the nearest page before them that several link to,
    or on the start. What is left are the pages that several link to, with the distances
    between them, which are walked as in ``reachable``; a page found again on a shorter
    way is walked again. Chains that lead back into themselves, and so hang on nothing,
    are found by pointers that no round brings to an end.

    Pages are numbered first: URLs are joined to give links their numbers and results
    their URLs, and all rounds work on numbers.
    """
    key = ["website", "url"]
    start = urls.canonical(F.col("start_point"), F.col("ignore_all"), F.col("listed_keys"))
    pages = materialize(page_urls.select(*key).distinct().withColumn("id", F.monotonically_increasing_id()), "allowed")
    starts = sites.select("website", start.alias("url")).distinct()
    seeds = materialize(pages.join(F.broadcast(starts), key, "left_semi").select("id"), "seeds")
    hops = edges.select("website", "from_url", "to_url").filter("from_url <> to_url")
    for end in ("from", "to"):
        numbered = pages.select("website", F.col("url").alias(f"{end}_url"), F.col("id").alias(end))
        hops = hops.join(numbered, ["website", f"{end}_url"]).drop(f"{end}_url")
    hops = hops.select("from", "to").join(seeds.withColumnRenamed("id", "to"), "to", "left_anti")
    hops = materialize(hops.select("from", "to").distinct(), "hops")

    # Pages with one way in: (id, above, steps), above being where their pointer leads.
    ways = hops.groupBy(F.col("to").alias("id")).agg(F.count("*").alias("n"), F.min("from").alias("above"))
    ways = materialize(ways, "ways")
    single = ways.filter("n = 1").select("id")
    hung = ways.filter("n = 1").select("id", "above", F.lit(1).cast("long").alias("steps"))
    at, rounds = _to_ends(materialize(_mark_ends(hung, single), "pointers"), few)
    ended = at.filter("ended").drop("ended")

    # Ways between the pages that pointers end at: from the one above, and how far.
    owned = hops.join(ways.filter("n > 1").select(F.col("id").alias("to")), "to", "left_semi")
    ways = owned.join(at.withColumnRenamed("id", "from"), "from", "left").filter(F.coalesce("ended", F.lit(True)))
    ways = ways.groupBy(F.coalesce("above", "from").alias("from"), "to").agg(F.min(F.coalesce("steps", F.lit(0)) + 1).alias("steps"))
    ways = materialize_bucketed(ways, "ways", ["from"])

    known = materialize(seeds.withColumn("depth", F.lit(0).cast("long")), "walked")
    level = known
    while not level.isEmpty():
        step = level.withColumnRenamed("id", "from").join(ways, "from")
        found = step.groupBy(F.col("to").alias("id")).agg(F.min(F.col("depth") + F.col("steps")).alias("found"))
        met = materialize(found.join(known, "id", "left"), "met")
        level = materialize(met.filter("depth IS NULL OR found < depth").select("id", F.col("found").alias("depth")), "level")
        known = materialize(known.unionByName(level).groupBy("id").agg(F.min("depth").alias("depth")), "walked")
        rounds += 1
    tails = ended.join(known.withColumnRenamed("id", "above"), "above")
    tails = tails.select("id", (F.col("depth") + F.col("steps")).alias("depth"))
    depths = known.unionByName(tails).withColumn("depth", F.col("depth").cast("int"))
    return Walk(pages.join(depths, "id").select(*key, "depth"), rounds)


def _mark_ends(pointers: DataFrame, single: DataFrame) -> DataFrame:
    """Add ``ended``: whether the page that a pointer leads to has several ways in, or none."""
    more = single.select(F.col("id").alias("above"), F.lit(False).alias("_ends"))
    return pointers.join(more, "above", "left").select("id", "above", "steps", F.coalesce("_ends", F.lit(True)).alias("ended"))


def _to_ends(at: DataFrame, few: int) -> tuple[DataFrame, int]:
    """Pointers (id, above, steps, ended) -> each page's pointer to its end, and the rounds that it took.

    Pointer jumping moves all pointers in every round. So while there are many of them,
    every round takes out the pages that a coin picks, but not the page above, and those
    that pointed to them point to where they did: a quarter of the pages, so all rounds
    together move a few times as many rows as there are pages. The ``few`` that are left
    jump, every round doubling the distance that a pointer spans; then the pages that were taken out
    follow, the last ones first. Pointers that lead round in a circle never end, and
    pages hung on them neither.
    """
    rounds, taken, left = 0, [], at.count()
    while left > few:
        coin = lambda c, n=rounds: F.pmod(F.xxhash64(F.lit(n), c), F.lit(2)) == 1
        out = coin("id") & (F.col("ended") | ~coin("above"))
        split = materialize(at.withColumns({"out": out, "ask": ~out & ~F.col("ended") & coin("above")}), "split")
        gone, kept = split.filter("out").drop("out", "ask"), split.filter("NOT out")
        over = gone.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("steps").alias("more"), F.col("ended").alias("last"))
        moved = kept.filter("ask").join(over, "above", "left").select(
            "id",
            F.coalesce("next", "above").alias("above"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.coalesce("last", "ended").alias("ended"),
        )
        at = materialize(kept.filter("NOT ask").drop("out", "ask").unionByName(moved), "pointers")
        taken.append(gone)
        before, left = left, at.count()
        rounds += 1
        if left > 0.9 * before:  # what is left are circles mostly
            break

    open_ = at.filter("NOT ended").count()
    rounds += 1
    while open_:
        over = at.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("steps").alias("more"), F.col("ended").alias("last"))
        moved = at.filter("NOT ended").join(over, "above").select(
            "id", F.col("next").alias("above"), (F.col("steps") + F.col("more")).alias("steps"), F.col("last").alias("ended")
        )
        at = materialize(at.filter("ended").unionByName(moved), "pointers")
        before, open_ = open_, at.filter("NOT ended").count()
        rounds += 1
        if open_ == before:
            break

    for gone in reversed(taken):
        over = at.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("steps").alias("more"), F.col("ended").alias("last"))
        moved = gone.filter("NOT ended").join(over, "above").select(
            "id", F.col("next").alias("above"), (F.col("steps") + F.col("more")).alias("steps"), F.col("last").alias("ended")
        )
        at = materialize(at.unionByName(gone.filter("ended")).unionByName(moved), "pointers")
        rounds += 1
    return at, rounds
