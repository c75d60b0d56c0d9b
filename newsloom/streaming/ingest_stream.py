"""Incremental ingest: pages landing as files, one run per micro-batch.

By default the article store is the only state: a page is skipped because its URL is
stored, so there is no watermark and no state that grows inside the query. With
``remember`` the query also keeps the URLs that it has seen, so that a page which was
rejected and lands again is not read again. A replayed micro-batch finds its own stages
and appends nothing twice.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.frontier import page_key, with_canonical_url
from newsloom.plans.ingest import run_ingest
from newsloom.scratch import materialize
from newsloom.sources.pages import PAGES_DDL, assign_sites, stream_pages


def ingest_landing(
    spark: SparkSession,
    landing: str,
    sites: DataFrame,
    article_store,
    rejects_path: str,
    checkpoint: str,
    name: str,
    schema: str = PAGES_DDL,
    max_files_per_trigger: int | None = None,
    remember: str | None = None,
    **options,
) -> None:
    """Ingest everything that has landed since the last call, then stop.

    ``remember`` (an interval such as ``"30 days"``) is how long a URL counts as seen
    after it first landed.

    The stages of a batch carry the id of the streaming query, which lives in the
    checkpoint: a new checkpoint never meets the stages of an old one.
    """
    limits = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else {}
    pages = stream_pages(spark, landing, schema, **limits)

    started, query_id = threading.Event(), []

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        run_id = f"{name}-{query_id[0]}-{batch_id}"
        if remember is None:
            run_ingest(spark, batch, sites, article_store, rejects_path, run_id=run_id, **options)
            return
        # The state is asked once. A row for each file of the batch, and for each new URL.
        new = materialize(batch.select("website", "key"), "new-keys")
        files = [r.key for r in new.filter("website = ''").collect()]
        if files:
            landed = spark.read.schema(schema).parquet(*sorted(files))
            run_ingest(
                spark, landed, sites, article_store, rejects_path, run_id=run_id, fresh=new.filter("website <> ''"), **options
            )

    if remember is not None:
        pages = new_keys(pages, sites, remember)
    query = (
        pages.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_id.append(query.id)
    started.set()
    query.awaitTermination()


def new_keys(pages: DataFrame, sites: DataFrame, remember: str) -> DataFrame:
    """(website, key): keys of pages that no earlier batch had, and under the website '' each file that landed.

    Only keys are kept and shuffled, no markup. Which of several equal keys passes
    doesn't matter, so a repeated batch gives the same rows. Their time is that of the
    batch, so that none is ever late and lost.
    """
    found = pages.select(*[c for c in ("website", "url") if c in pages.columns], F.col("_metadata.file_path").alias("file"))
    placed = with_canonical_url(assign_sites(found, sites)).select("website", page_key().alias("key"), "file")
    page = F.struct(F.col("website"), F.col("key"))
    file = F.struct(F.lit("").alias("website"), F.col("file").alias("key"))
    rows = placed.select(F.explode(F.array(page, file)).alias("x")).select("x.website", "x.key")
    timed = rows.withColumn("at", F.current_timestamp()).withWatermark("at", remember)
    return timed.dropDuplicatesWithinWatermark(["website", "key"])
