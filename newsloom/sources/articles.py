"""Article store: Parquet partitioned by website."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.operators.store import ARTICLE_COLUMNS
from newsloom.scratch import path_exists, remove, touch
from newsloom.sources.url_index import BUCKETS, UrlIndex

ARTICLES_DDL = (
    "website string, url string, title string, description string, "
    "content string, author string, date date"
)


class ParquetStore:
    """Articles under ``path``. One writer at a time; readers see whole files only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """Stored articles; a store that does not exist yet is empty."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], ARTICLES_DDL)
        # the explicit schema keeps website a string whatever the names look like
        return self.spark.read.schema(ARTICLES_DDL).parquet(self.path).select(*ARTICLE_COLUMNS)

    def known(self) -> DataFrame | UrlIndex:
        """What look-ups of stored URLs go to."""
        return self.read()

    def append(self, articles: DataFrame) -> None:
        """Append new articles. Large websites spread over several files and tasks."""
        (
            articles.select(*ARTICLE_COLUMNS)
            .hint("rebalance", "website")
            .write.mode("append")
            .partitionBy("website")
            .parquet(self.path)
        )


class IndexedStore(ParquetStore):
    """Articles with an index of their URLs beside them, so that look-ups read no article file.

    A mark stands while articles are appended and the index is not. Where it is found
    the index is built anew from the articles: an append that died in between costs
    one scan of URLs and no article its place.
    """

    def __init__(self, spark: SparkSession, path: str, index_path: str | None = None, buckets: int = BUCKETS):
        super().__init__(spark, path)
        self.index_path = index_path or f"{path.rstrip('/')}-urls"
        self.index = UrlIndex(spark, self.index_path, buckets)
        self._mark = f"{self.index_path}/appending"

    def known(self) -> UrlIndex:
        unknown = path_exists(self.spark, self.path) and not self.index.shapes()
        if unknown or path_exists(self.spark, self._mark):
            self.index.rebuild(self.read())
            remove(self.spark, self._mark)
        return self.index

    def append(self, articles: DataFrame) -> None:
        self.known()
        touch(self.spark, self._mark)
        super().append(articles)
        self.index.append(articles)
        remove(self.spark, self._mark)


def article_store(spark: SparkSession, settings) -> ParquetStore:
    """The store that a configuration names: ``connection_data`` is its folder."""
    if not settings.connection_data:
        raise ValueError("the database section needs connection_data, the folder of the articles")
    return ParquetStore(spark, settings.connection_data)
