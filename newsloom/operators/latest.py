"""The latest articles of every website, kept up to date batch by batch.

    tops/gen=k/bucket=b   the latest articles of all websites of a bucket
    gens/gen=k            the buckets that generation k wrote, written last

Articles never change, so the latest ``n`` of all batches are the latest ``n`` among the
old winners and those of the new batch. A batch reads and writes the buckets of its own
websites only, and the article store not at all. Readers take each bucket from its last
complete generation, so they see a batch whole or not. Merging a batch again changes
nothing, as an article is told by its URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators.store import ARTICLE_COLUMNS, latest_n
from newsloom.scratch import child_names, materialize, path_exists, remove

BUCKETS = 32
ARTICLES_DDL = "website string, url string, title string, description string, content string, author string, date date"


class LatestArticles:
    """Up to ``n`` articles of every website under ``path``; ``n`` and ``buckets`` stay as they were at first."""

    def __init__(self, spark: SparkSession, path: str, n: int, buckets: int = BUCKETS):
        if n < 1:
            raise ValueError("n must be 1 or more")
        self.spark, self.path, self.n, self.buckets = spark, path.rstrip("/"), n, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("website"), F.lit(self.buckets)).cast("int")

    def _generations(self) -> list[int]:
        names = child_names(self.spark, f"{self.path}/gens")
        return sorted(int(n[4:]) for n in names if path_exists(self.spark, f"{self.path}/gens/{n}/_SUCCESS"))

    def current(self) -> dict[int, int]:
        """The generation that holds each bucket."""
        done = self._generations()
        if not done:
            return {}
        # At most a row for each bucket and generation.
        rows = self.spark.read.schema("bucket int, gen int").parquet(f"{self.path}/gens").filter(F.col("gen").isin(done))
        return {r.bucket: r.gen for r in rows.groupBy("bucket").agg(F.max("gen").alias("gen")).collect()}

    def read(self, buckets: set[int] | None = None) -> DataFrame:
        """The articles of all websites, or of those of some buckets; no other file is opened."""
        held = {b: g for b, g in self.current().items() if buckets is None or b in buckets}
        folders = [f"{self.path}/tops/gen={g}/bucket={b}" for b, g in sorted(held.items())]
        if not folders:
            return self.spark.createDataFrame([], ARTICLES_DDL)
        return self.spark.read.schema(ARTICLES_DDL).parquet(*folders)

    def latest(self, n: int | None = None) -> DataFrame:
        """The latest articles numbered ``rn`` from 1, like ``latest_n`` of the whole store."""
        if n is not None and n > self.n:
            raise ValueError(f"only the latest {self.n} articles of a website are kept")
        return ranked(self.read(), n or self.n)

    def update(self, articles: DataFrame) -> None:
        """Merge a batch of new articles (columns of the store)."""
        batch = materialize(latest_n(articles.select(*ARTICLE_COLUMNS), self.n).drop("rn"), "latest-batch")
        hit = {r[0] for r in batch.select(self._bucket()).distinct().collect()}
        if not hit:
            return
        both = self.read(hit).unionByName(batch).dropDuplicates(["website", "url"])
        merged = ranked(both, self.n).drop("rn").withColumn("bucket", self._bucket())
        gen = max(self._generations(), default=0) + 1
        merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/tops/gen={gen}")
        wrote = self.spark.createDataFrame([(b,) for b in sorted(hit)], "bucket int")
        wrote.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/gens/gen={gen}")

    def vacuum(self) -> None:
        """Remove buckets that a later generation replaces. Not while another job reads them."""
        held = self.current()
        for gen in self._generations():
            for name in child_names(self.spark, f"{self.path}/tops/gen={gen}"):
                if name.startswith("bucket=") and held[int(name[7:])] != gen:
                    remove(self.spark, f"{self.path}/tops/gen={gen}/{name}")


def ranked(articles: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` of every website among few articles of each."""
    newest = Window.partitionBy("website").orderBy(F.desc("date"), F.asc("url"))
    return articles.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= n)
