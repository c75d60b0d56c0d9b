"""Rejected rows and the outcome of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_COLUMNS = ("website", "page_url", "kind", "reason", "detail")
REJECTS_DDL = "website string, page_url string, kind string, reason string, detail string"

# The step that a reason belongs to.
KINDS = {
    "filter": ("restrict", "exclude", "seen", "stored", "budget", "unreached"),
    "link": ("bad_scheme", "bad_link"),
    "page": ("not_article",),
    "parse": ("parse_error",),
    "field": ("empty_title",),
    "date": ("empty_date", "bad_date"),
    "source": ("unreadable_file",),
}


def reject_kind(reason: Column) -> Column:
    """The step that failed; what is left to fail is saving."""
    kind = F.lit("save")
    for name, reasons in KINDS.items():
        kind = F.when(reason.isin(*reasons), name).otherwise(kind)
    return kind


def reject_message(kind: Column, page_url: Column, detail: Column) -> Column:
    """The four message shapes, by whether a URL and a cause are known."""
    return (
        F.when(page_url.isNull() & detail.isNull(), F.format_string("Unknown %s error", kind))
        .when(page_url.isNull(), F.format_string("%s error: %s", kind, detail))
        .when(detail.isNull(), F.format_string("Unknown %s error on %s", kind, page_url))
        .otherwise(F.format_string("%s error on %s: %s", kind, page_url, detail))
    )


def rejects_of(rows: DataFrame, url: str = "url", detail: str | None = None) -> DataFrame:
    """Reject rows of any table with ``website``, a URL column and ``reason``."""
    return rows.filter(F.col("reason").isNotNull()).select(
        "website",
        F.col(url).alias("page_url"),
        reject_kind(F.col("reason")).alias("kind"),
        "reason",
        (F.col(detail) if detail else F.lit(None).cast("string")).alias("detail"),
    )


def warnings_of(rows: DataFrame) -> DataFrame:
    """One row per warning: the page was saved, a step before that was not right."""
    told = rows.select("website", F.col("url").alias("page_url"), F.explode("warnings").alias("detail"))
    reason = F.when(F.col("detail").startswith("bad_date"), "bad_date").otherwise("bad_link")
    return told.select("website", "page_url", reject_kind(reason).alias("kind"), reason.alias("reason"), "detail")


def lost_files(files: DataFrame) -> DataFrame:
    """One row per source file (file, detail) that couldn't be read, of no website."""
    reason = F.lit("unreadable_file")
    none = F.lit(None).cast("string").alias("website")
    return files.select(none, F.col("file").alias("page_url"), reject_kind(reason).alias("kind"), reason.alias("reason"), "detail")


def reject_report(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("website", "kind", "reason").agg(F.count("*").alias("n"))


def run_report(sites: DataFrame, decisions: DataFrame, written: DataFrame) -> DataFrame:
    """Outcome per site.

    ``decisions`` (website, accepted) and ``written`` (website, reason; null means
    saved). A site stops at its ``budget`` when it took as many pages as allowed, has
    ``failed`` when none of the pages it took could be read, and is ``exhausted``
    otherwise.
    """
    accepted = decisions.groupBy("website").agg(
        F.count_if("accepted").alias("n_accepted"), F.count("*").alias("n_pages")
    )
    saved = written.groupBy("website").agg(
        F.count_if(F.col("reason").isNull()).alias("n_saved"),
        F.count_if(F.col("reason").isNotNull()).alias("n_rejected"),
        F.count_if(F.col("reason") == "parse_error").alias("n_unread"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    limit = F.coalesce(F.col("max_visits"), F.lit(0))
    unread = (F.col("n_unread") > 0) & (F.col("n_unread") == F.col("n_saved") + F.col("n_rejected"))
    return (
        sites.select("website", "max_visits")
        .join(accepted, "website", "left")
        .join(saved, "website", "left")
        .select(
            "website",
            zero("n_accepted"),
            zero("n_saved"),
            zero("n_rejected"),
            F.when(unread, "failed")
            .when((limit > 0) & (F.coalesce("n_accepted", F.lit(0)) >= limit), "budget")
            .otherwise("exhausted")
            .alias("stop_reason"),
        )
    )
