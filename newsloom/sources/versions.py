"""Site rules valid in time: pages are judged by the rules of their arrival.

A version is a row of site rules with ``valid_from``; it holds until the next version of
its website begins. Versions are few for each site, so they are turned into intervals
and meet the pages of the site under salted keys, of which the interval keeps one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators import frontier
from newsloom.sources.pages import SALTS


def intervals(versions: DataFrame) -> DataFrame:
    """Add ``valid_to``, the beginning of the next version of the website; null for the last one.

    Of versions of a website that begin at the same time the greatest by all columns holds.
    """
    rules = [c for c in versions.columns if c not in ("website", "valid_from")]
    one = versions.groupBy("website", "valid_from").agg(F.max(F.struct(*rules)).alias("rules"))
    following = F.lead("valid_from").over(Window.partitionBy("website").orderBy("valid_from"))
    return one.withColumn("valid_to", following).select("website", "valid_from", "valid_to", "rules.*")


def with_rules_at(rows: DataFrame, versions: DataFrame, arrived: str, spread: Column) -> DataFrame:
    """Rows (website, ``arrived``) with the rules of the version that held then.

    Rows that arrived before the first version of their website, or without a time,
    belong to no site yet and go. Small rules are broadcast by the planner; larger
    ones are there under ``SALTS`` keys, of which a row chooses one by ``spread``.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).alias("r")
    ruled = intervals(versions).select("*", salts).alias("v")
    held = (F.col(f"r.{arrived}") >= F.col("v.valid_from")) & (
        F.col("v.valid_to").isNull() | (F.col(f"r.{arrived}") < F.col("v.valid_to"))
    )
    same = (F.col("r.website") == F.col("v.website")) & (F.col("r._salt") == F.col("v._salt"))
    rules = [c for c in versions.columns if c != "website"]
    return salted.join(ruled, same & held).select("r.*", *[F.col(f"v.{c}").alias(c) for c in rules]).drop("_salt")


def changed_sites(old: DataFrame, new: DataFrame) -> DataFrame:
    """(website): sites whose versions differ between two tables of them."""
    told = lambda t: t.select("website", F.sha2(F.to_json(F.struct(*sorted(t.columns))), 256).alias("version")).distinct()
    a, b = told(old), told(new)
    return a.exceptAll(b).unionByName(b.exceptAll(a)).select("website").distinct()


def decide(pages: DataFrame, versions: DataFrame, arrived: str, stored=None) -> DataFrame:
    """``frontier.decide`` by the rules of each page's arrival."""
    ruled = with_rules_at(pages, versions, arrived, F.col("page_id"))
    return frontier.decide(frontier.check(ruled), stored)


def decide_again(decided: DataFrame, pages: DataFrame, old: DataFrame, new: DataFrame, arrived: str, stored=None) -> DataFrame:
    """Decisions after a change of versions: those of the sites that changed anew, all others as they are.

    Pages of one site are never decided by those of another, so no other page is looked at.
    """
    changed = changed_sites(old, new)
    again = decide(pages.join(changed, "website", "left_semi"), new, arrived, stored)
    return decided.join(changed, "website", "left_anti").select(*decided.columns).unionByName(again.select(*decided.columns))
