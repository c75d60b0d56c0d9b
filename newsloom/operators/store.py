"""Article store operators: first write wins, checks, reads and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.frontier import already_there
from newsloom.scratch import materialize

ARTICLE_COLUMNS = ("website", "url", "title", "description", "content", "author", "date")
REQUIRED_COLUMNS = ("website", "url", "title", "content", "date")

# Sub-groups per website between the two rounds of latest-N.
SALTS = 64
# Winners of latest-N (an id and a URL each) that are broadcast to fetch their articles.
BROADCAST_WINNERS = 100_000


def missing_required() -> Column:
    """``null_<column>`` of the first required column that is null."""
    reason = F.lit(None).cast("string")
    for name in reversed(REQUIRED_COLUMNS):
        reason = F.when(F.col(name).isNull(), f"null_{name}").otherwise(reason)
    return reason


def first_claims(rows: DataFrame, stored: DataFrame | None, order: str) -> DataFrame:
    """``order`` values of the rows that are the first to claim a url not stored yet.

    Only urls and the order column are shuffled, and one row per url after
    combining, so a url claimed by a third of all rows is no hot key.
    """
    firsts = rows.groupBy("url").agg(F.min(order).alias(order))
    if stored is not None:
        # not an anti join: Catalyst would move that below the aggregation
        known = already_there(firsts, ["url"], stored).withColumn("_known", F.lit(True))
        firsts = firsts.join(known, "url", "left").filter(F.col("_known").isNull())
    return firsts.select(order)


def write_verdicts(batch: DataFrame, stored: DataFrame | None, order: str = "seq") -> DataFrame:
    """Say for every row of a batch whether it gets written.

    ``order`` is a unique, sortable column: of the rows with one ``url`` the
    smallest is written, unless ``stored`` already has that url under any
    website. Out: ``order`` column and ``reason`` (null: write).
    """
    checked = batch.select(order, "url", missing_required().alias("reason"))
    winners = first_claims(checked.filter(F.col("reason").isNull()), stored, order)
    lost = F.col("reason").isNull() & F.col("_wins").isNull()
    return (
        checked.join(winners.withColumn("_wins", F.lit(True)), order, "left")
        .withColumn("reason", F.when(lost, "duplicate_url").otherwise(F.col("reason")))
        .select(order, "reason")
    )


def first_write_wins(
    batch: DataFrame, stored: DataFrame | None = None, order: str = "seq"
) -> DataFrame:
    """The batch with a ``reason`` column; rows without a reason are new articles."""
    return batch.join(write_verdicts(batch, stored, order), order)


def stored_urls(articles: DataFrame, website: str | None = None) -> DataFrame:
    """URLs of one website, or of all with their website; url is unique in the store."""
    if website is None:
        return articles.select("website", "url")
    return articles.filter(F.col("website") == website).select("url")


def stored_counts(articles: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """Articles of each website; with ``sites`` a row for each of them, 0 included."""
    counts = articles.groupBy("website").agg(F.count("*").alias("n_stored"))
    if sites is None:
        return counts
    every = sites.select("website").distinct().join(counts, "website", "left")
    return every.select("website", F.coalesce("n_stored", F.lit(0)).alias("n_stored"))


def latest_for(articles: DataFrame, website: str, n: int) -> DataFrame:
    """Latest ``n`` articles of one website: date descending, url ascending on ties."""
    return (
        articles.filter(F.col("website") == website)
        .orderBy(F.desc("date"), F.asc("url"))
        .limit(n)
    )


def latest_urls(articles: DataFrame, n: int, salts: int = SALTS) -> DataFrame:
    """(website, url, rn): the latest ``n`` articles of every website, numbered from 1.

    Two rounds over ids and dates. Each task first keeps n rows per website (the
    limit is pushed below the shuffle), these meet in ``salts`` sub-groups by task
    number, and their winners in one task per website. That last task sees at most
    ``n * salts`` rows of even the largest website; the result does not depend on
    how rows fall into sub-groups.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    newest = (F.desc("date"), F.asc("url"))
    salted = articles.select("website", "url", "date", (F.spark_partition_id() % salts).alias("_salt"))
    part = Window.partitionBy("website", "_salt").orderBy(*newest)
    whole = Window.partitionBy("website").orderBy(*newest)
    return (
        salted.withColumn("_rn", F.row_number().over(part))
        .filter(F.col("_rn") <= n)
        .drop("_rn", "_salt")
        .withColumn("rn", F.row_number().over(whole))
        .filter(F.col("rn") <= n)
        .select("website", "url", "rn")
    )


def latest_n(articles: DataFrame, n: int, salts: int = SALTS) -> DataFrame:
    """Latest ``n`` articles of every website, numbered ``rn`` from 1.

    Ids and dates are ranked, and the winners fetch their articles by url, so contents
    are never sorted. The winners are stored; up to ``BROADCAST_WINNERS`` of them are
    broadcast and the articles only scanned, more of them are joined by shuffle.
    ``url`` is unique in the store; ``articles`` is read twice.
    """
    winners = materialize(latest_urls(articles, n, salts), "latest")
    if winners.count() <= BROADCAST_WINNERS:
        winners = F.broadcast(winners)
    return articles.join(winners, ["website", "url"]).select(*articles.columns, "rn")
