"""One ingest run: pages in, new articles, rejects and a run report out.

Stages are written to the shared scratch folder, so each is computed once, later
stages read only the columns they need, and a run that is repeated under the
same ``run_id`` (a replayed micro-batch) continues from what is there.

    checked     narrow   canonical URLs and the filters they fail
    decided     narrow   which page is taken, and why not
    links       narrow   links of taken pages (following links without budgets)
    read        wide     fields, content and links of taken pages
    outcome     narrow   what happened to every taken page

With budgets, links are followed level by level, and only the pages of a level are
read (``read/depth=n``). Without, all links are read first, then the reached pages.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import urls
from newsloom.operators import extract, frontier, links, reports, store
from newsloom.operators.frontier import unseen
from newsloom.operators.latest import LatestArticles
from newsloom.operators.link_state import LinkState, schema_text
from newsloom.scratch import materialize, path_exists, scratch_root
from newsloom.sources.pages import assign_sites, join_rules

# Distinct date layouts up to which each gets a branch of its own with a literal pattern, which
# is compiled once; more of them are read from their column and compiled as it changes.
LITERAL_LAYOUTS = 32

READING_RULES = ("sel", "date_pattern", "date_rewrite")

# Pages that a task reads at most on average, and at least while there are cores to spare.
PAGES_A_TASK, LEAST_PAGES_A_TASK = 5_000, 20


@dataclass(frozen=True)
class IngestResult:
    """Tables of a finished run; ``visited`` (website, url, depth) if links were followed, with a link state without depth."""

    decisions: DataFrame
    outcome: DataFrame
    rejects: DataFrame
    report: DataFrame
    visited: DataFrame | None = None


class _Stages:
    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.folder = spark, f"{scratch_root(spark)}/newsloom-run-{run_id}"

    def done(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.folder}/{name}/_SUCCESS")

    def once(self, name: str, make) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not self.done(name):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def belong_to(self, pages: DataFrame, sites: DataFrame, **options) -> None:
        """Refuse the stages of another run: other pages, sites or options under the same id."""
        keys = [c for c in ("page_id", "website", "url") if c in pages.columns]
        told = {k: str(v) for k, v in options.items()}
        for name, table in (("pages", pages.select(*keys)), ("sites", sites)):
            row = F.xxhash64(*[F.col(c) for c in sorted(table.columns)])
            told[name] = str(tuple(table.agg(F.count("*"), F.bit_xor(row), F.sum(row % 1_000_003)).first()))
        found = self.once("identity", lambda: self.spark.createDataFrame([(json.dumps(told, sort_keys=True),)], "told string"))
        if json.loads(found.first().told) != told:
            raise ValueError(f"{self.folder} holds stages of a run over other pages, sites or options")


def spread(pages: DataFrame, partitions: int | None, key: str = "page_id") -> DataFrame:
    """``pages`` in so many partitions for reading markup; None leaves the splits of the scan."""
    return pages.repartition(partitions, key) if partitions else pages


def reading_tasks(taken: DataFrame) -> int:
    """Tasks for reading these pages: markup is read slowly for its size, so bytes alone would leave it to few."""
    n = taken.count()
    cores = 2 * taken.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // PAGES_A_TASK), min(-(-n // LEAST_PAGES_A_TASK), cores))


def markup_of(pages: DataFrame, taken: DataFrame, partitions: int) -> DataFrame:
    """Rows of ``taken`` with their markup, for reading in so many partitions.

    Where the taken rows are too many to broadcast, markup comes to them in the
    partitions that read it, so ``spread`` has nothing left to shuffle.
    """
    return pages.select("page_id", "html").join(taken.repartition(partitions, "page_id"), "page_id")


def with_reading_rules(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Attach the selectors and the date layout; meant for rows without markup."""
    return join_rules(rows, sites.select("website", *READING_RULES), "website", F.col("page_id"))


def date_layouts(sites: DataFrame) -> list[tuple[str, str]] | None:
    """The distinct date layouts of all sites, None when they are more than ``LITERAL_LAYOUTS``."""
    found = sites.select("date_pattern", "date_rewrite").distinct().limit(LITERAL_LAYOUTS + 1).collect()
    return [tuple(r) for r in found] if len(found) <= LITERAL_LAYOUTS else None


def read_articles(
    pages: DataFrame,
    text_mode: str = "first_text",
    on_bad_date: str = "reject",
    keep_links: bool = False,
    partitions: int | None = None,
    layouts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Pages with reading rules -> articles with reasons.

    In: ``page_id``, ``website``, ``url``, ``html``, ``sel``, ``date_pattern``,
    ``date_rewrite``. No join follows the reading. ``partitions`` spreads the markup
    before it is read; ``layouts`` are all date layouts, where they are few.
    """
    needed = pages.select("page_id", "website", "url", "html", *READING_RULES)
    read = extract.read_pages_job(
        spread(needed, partitions),
        keys=("page_id", "website", "url", "date_pattern", "date_rewrite"),
        text_mode=text_mode,
        keep_links=keep_links,
    )
    return extract.to_articles(read if keep_links else read.drop("links"), on_bad_date, layouts)


def _taken(decisions: DataFrame) -> DataFrame:
    return decisions.filter("accepted").select("page_id", "website", F.col("canonical_url").alias("url"))


def _follow_all(stages: _Stages, pages: DataFrame, decisions: DataFrame, sites: DataFrame, one_host: bool, partitions: int | None) -> DataFrame:
    """(website, url, _missed null) of the reached pages: the links of all pages first, then the walk."""

    def read_links() -> DataFrame:
        taken = _taken(decisions)
        tasks = partitions or reading_tasks(taken)
        return extract.read_pages_job(spread(markup_of(pages, taken, tasks), tasks)).select("website", "url", "links")

    edges = links.site_edges(links.harvest(stages.once("links", read_links)), sites, one_host)
    reached = stages.once("reached", lambda: links.reachable(edges, sites, _taken(decisions)))
    return reached.select("website", "url", F.lit(None).cast("string").alias("_missed"))


def _follow_levels(stages: _Stages, decisions: DataFrame, sites: DataFrame, one_host: bool, read) -> DataFrame:
    """Read the pages of one level after the other until budgets are spent or no page is new.

    Out: (website, url, _missed): visited pages, and with ``budget`` the ones that
    were found when their site's budget was spent.
    """
    spark, key = stages.spark, ["website", "url"]
    limits = sites.filter(F.col("max_visits") > 0).select("website", "max_visits")
    taken = _taken(decisions)
    level = stages.once(
        "level/depth=0", lambda: _taken(decisions.filter("is_start")).select("page_id", *key)
    )
    visited = lambda: spark.read.schema(level.schema).parquet(f"{stages.folder}/level")
    depth = 0
    while not level.isEmpty():
        done, here = level, depth
        articles = stages.once(f"read/depth={here}", lambda: read(done))
        edges = links.site_edges(links.harvest(articles.select("website", "url", "links")), sites, one_host)
        found = edges.select("website", F.col("to_url").alias("url")).distinct()
        fresh = stages.once(
            f"fresh/depth={here}", lambda: unseen(taken.join(found, key, "left_semi").select(*key), key, visited())
        )
        depth += 1
        level = stages.once(
            f"level/depth={depth}", lambda: links.spend(fresh, limits, visited()).join(taken, key).select("page_id", *key)
        )
    kept = visited().select(*key, F.lit(None).cast("string").alias("_missed"))
    if depth == 0:
        return kept
    # Every page that was found is in the table of its level, so the plan is the same at any depth.
    over = unseen(spark.read.schema("website string, url string").parquet(f"{stages.folder}/fresh").select(*key).distinct(), key, kept)
    return kept.unionByName(over.select(*key, F.lit("budget").alias("_missed")))


def _without_landed(decisions: DataFrame, state: LinkState, number: int) -> DataFrame:
    """Pages that landed in an earlier run are seen: they were read, and links to them are kept."""
    keys = decisions.filter("accepted").select("website", F.col("canonical_url").alias("url"))
    landed = state.landed_among(keys, number).select("website", F.col("url").alias("canonical_url"), F.lit(True).alias("_landed"))
    again = F.col("accepted") & F.col("_landed").isNotNull()
    return (
        decisions.join(landed, ["website", "canonical_url"], "left")
        .withColumn("reason", F.when(again, "seen").otherwise(F.col("reason")))
        .withColumn("accepted", F.col("reason").isNull())
        .select(*decisions.columns)
    )


def _follow_state(stages: _Stages, decisions: DataFrame, sites: DataFrame, one_host: bool, read, state: LinkState, number: int):
    """(articles of the pages that this run reaches, whenever they landed; (website, url, _missed null) of these pages)."""
    landed = stages.once("read", lambda: read(_taken(decisions)))
    edges = links.site_edges(links.harvest(landed.select("website", "url", "links")), sites, one_host)
    start = urls.canonical(F.col("start_point"), F.col("ignore_all"), F.col("listed_keys"))
    reached = state.advance(number, landed, edges, sites.select("website", start.alias("url")))
    articles = stages.once("reached", lambda: state.articles_of(reached, schema_text(landed)))
    return articles, reached.select("website", "url", F.lit(None).cast("string").alias("_missed"))


def run_ingest(
    spark: SparkSession,
    pages: DataFrame,
    sites: DataFrame,
    article_store,
    rejects_path: str,
    run_id: str | None = None,
    follow_links: bool = False,
    one_host: bool = True,
    text_mode: str = "first_text",
    on_bad_date: str = "reject",
    read_partitions: int | None = None,
    link_state: LinkState | None = None,
    latest: LatestArticles | None = None,
    fresh: DataFrame | None = None,
    lost: DataFrame | None = None,
) -> IngestResult:
    """Take pages, extract articles, append the new ones, keep every reject.

    ``pages`` needs a unique ``page_id``, ``url`` and ``html``, and optionally
    ``website``. With ``follow_links`` only pages reachable from the start points
    are kept, the budget being spent breadth first (``one_host``: links to other
    hosts than the start point's are not followed); otherwise every page that
    passes the filters is a candidate. ``read_partitions`` spreads markup over so
    many partitions before it is read; by default their number follows from the
    pages to read. With a ``link_state`` links are followed across runs: a page that no
    reached page links to yet is read, kept, and stored by the run that reaches it, and
    pages that landed before are ``seen``; budgets, which hold for one run, can't be
    combined with it. ``latest`` is brought up to date with the new articles. With
    ``fresh`` (website, key) pages whose canonical URL, or URL where there is none,
    isn't among its keys are ``seen``. ``lost`` (file, detail) are source files that
    couldn't be read: each becomes a reject.

    With a ``link_state`` links are followed across runs: a page that no reached page
    links to yet is read, kept, and stored by the run that reaches it; pages that
    landed before are ``seen``. Budgets hold for one run and can't be combined with it.
    A run that is repeated under its ``run_id`` must have
    the same pages, sites and options.
    """
    stages = _Stages(spark, run_id or uuid.uuid4().hex)
    if run_id is not None:
        stages.belong_to(
            pages, sites, follow_links=follow_links, one_host=one_host, text_mode=text_mode, on_bad_date=on_bad_date
        )
    run_id = run_id or stages.folder.rsplit("newsloom-run-", 1)[1]
    replay = stages.done("outcome")
    limited = not sites.filter(F.col("max_visits") > 0).isEmpty()
    if link_state is not None and (limited or not follow_links):
        raise ValueError("a link state follows links, and without budgets")
    layouts = date_layouts(sites)

    def check() -> DataFrame:
        rows = frontier.check(assign_sites(pages.drop("html"), sites), enter_start=follow_links)
        return rows if fresh is None else frontier.mark_seen(rows, fresh)

    checked = stages.once("checked", check)
    decisions = stages.once("decided", lambda: frontier.decide(checked, article_store.known()))
    if limited and not follow_links:
        decided = decisions
        decisions = stages.once("budgeted", lambda: frontier.apply_budget(decided))

    def read(taken: DataFrame) -> DataFrame:
        # rules join the narrow side; page_id is unique, so this join has no hot key. That side is written,
        # so that its real size decides: markup isn't shuffled to meet the few pages of a level.
        narrow = materialize(with_reading_rules(taken, sites), "ruled")
        tasks = read_partitions or reading_tasks(taken)
        keep_links = follow_links and (limited or link_state is not None)
        return read_articles(markup_of(pages, narrow, tasks), text_mode, on_bad_date, keep_links, tasks, layouts)

    if follow_links:
        number = link_state.number(run_id) if link_state is not None else None
        if link_state is not None:
            decided = decisions
            decisions = stages.once("new", lambda: _without_landed(decided, link_state, number))
        found = decisions
        if link_state is not None:
            articles, walked = _follow_state(stages, found, sites, one_host, read, link_state, number)
        elif limited:
            walked = _follow_levels(stages, found, sites, one_host, read)
        else:
            walked = _follow_all(stages, pages, found, sites, one_host, read_partitions)

        def keep_visited() -> DataFrame:
            known = walked.select("website", F.col("url").alias("canonical_url"), "_missed", F.lit(True).alias("_in"))
            missed = F.when(F.col("_in").isNull(), "unreached").otherwise(F.col("_missed"))
            return (
                found.join(known, ["website", "canonical_url"], "left")
                .withColumn("reason", F.when(F.col("accepted"), missed).otherwise(F.col("reason")))
                .withColumn("accepted", F.col("reason").isNull())
                .drop("_in", "_missed")
            )

        decisions = stages.once("visited", keep_visited)

    columns = ["page_id", "website", "url", "title", "description", "content", "author", "date", "reason", "detail", "warnings"]
    if link_state is not None:
        articles = articles.select(*columns)
    elif follow_links and limited:
        levels = f"{stages.folder}/read"
        articles = (
            spark.read.parquet(levels).select(*columns)
            if path_exists(spark, levels)
            else stages.once("read-none", lambda: read(_taken(decisions))).select(*columns)
        )
    else:
        articles = stages.once("read", lambda: read(_taken(decisions)))

    # Pages of earlier runs may have the same page_id, but no two rows the same URL.
    row = ["page_id", "website", "url"]

    def outcome() -> DataFrame:
        good = articles.filter(F.col("reason").isNull())
        rows = good.select(F.struct(*row).alias("seq"), "url")
        winners = store.first_claims(rows, article_store.known(), "seq").select("seq.*", F.lit(True).alias("_wins"))
        lost = F.col("reason").isNull() & F.col("_wins").isNull()
        return (
            articles.select(*row, "reason", "detail", "warnings")
            .join(winners, row, "left")
            .withColumn("reason", F.when(lost, "duplicate_url").otherwise(F.col("reason")))
            .drop("_wins")
        )

    result = stages.once("outcome", outcome)
    # an unsupported scheme is named in the reject
    scheme = F.when(F.col("reason") == "bad_scheme", urls.scheme(F.col("canonical_url")))
    rejects = (
        reports.rejects_of(decisions.withColumn("detail", scheme), detail="detail")
        .unionByName(reports.rejects_of(result, detail="detail"))
        .unionByName(reports.warnings_of(result.filter(F.col("reason").isNull())))
    )
    if lost is not None:
        rejects = rejects.unionByName(reports.lost_files(lost))
    run_rejects = f"{rejects_path}/run_id={run_id}"
    rejects.write.mode("overwrite").parquet(run_rejects)

    # only good articles can lose their URL to another: few rows, whatever was rejected
    losers = result.filter(F.col("reason") == "duplicate_url").select(*row)
    new = articles.filter(F.col("reason").isNull()).join(losers, row, "left_anti")
    if latest is not None:
        # a batch may be merged twice, but an earlier attempt may have stored it and died before
        latest.update(new)
    if replay:
        # an earlier attempt may have got as far as the store
        new = unseen(new, ["url"], article_store.known())
    article_store.append(new)

    report = reports.run_report(sites, decisions, result)
    if follow_links:
        report = report.withColumn(
            "stop_reason",
            F.when(F.col("n_accepted") == 0, "start_missing").otherwise(F.col("stop_reason")),
        )
    visited = None
    if link_state is not None:
        visited = link_state.reached_in(number).select("website", "url")
    elif follow_links:
        visited = spark.read.parquet(f"{stages.folder}/{'level' if limited else 'reached'}").select("website", "url", "depth")
    return IngestResult(decisions, result, spark.read.parquet(run_rejects), report, visited)
