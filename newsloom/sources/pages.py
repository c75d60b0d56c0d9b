"""Page source: tables of already fetched pages, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.functions import urls

# Keys under which the rules of a site meet its rows.
SALTS = 8

PAGES_DDL = "page_id bigint, url string, html string"


def read_pages(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """Pages with a unique ``page_id``; tables without one get file and row position.

    With ``skip_unreadable`` files that can't be read don't end the job; ``unreadable_files``
    names them.
    """
    if skip_unreadable:
        pages = spark.read.option("ignoreCorruptFiles", "true").schema(_readable_schema(spark, path)).parquet(path)
    else:
        pages = spark.read.parquet(path)
    if "page_id" not in pages.columns:
        pages = pages.withColumn(
            "page_id",
            F.concat_ws(
                "#",
                F.col("_metadata.file_path"),
                F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0"),
            ),
        )
    return pages.select("page_id", *(c for c in pages.columns if c != "page_id"))


def stream_pages(spark: SparkSession, path: str, schema: str = PAGES_DDL, **options) -> DataFrame:
    reader = spark.readStream.schema(schema)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.parquet(path)


def join_rules(rows: DataFrame, rules: DataFrame, key: str, spread: Column) -> DataFrame:
    """Rows joined with the rules of their site.

    The planner broadcasts rules that are small. Larger ones are shuffled, and since
    a site may hold a third of all rows, its rules are there under ``SALTS`` keys and
    its rows choose one by ``spread``.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return salted.join(rules.select("*", salts), [key, "_salt"]).drop("_salt")


def assign_sites(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Attach every page to the sites it belongs to.

    By ``website`` when the pages carry it, otherwise by the host of the site's
    start point. ``url`` is kept as found; site columns are added.
    """
    if "website" in pages.columns:
        return join_rules(pages, sites, "website", F.col("url"))
    by_host = sites.withColumn("site_host", urls.host(F.col("start_point")))
    hosted = pages.withColumn("site_host", urls.host(F.col("url")))
    return join_rules(hosted, by_host, "site_host", F.col("url")).drop("site_host")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, length): names only, nothing is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), "length")


def _readable_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of the first file that has one, the longest files first."""
    for row in _listed(spark, path).orderBy(F.desc("length"), "file").toLocalIterator():
        try:
            return spark.read.parquet(row.file).schema
        except Exception:  # the next file may do
            continue
    raise ValueError(f"no file in {path} can be read")


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, detail): the files of a folder of pages that give no rows and aren't empty tables.

    The listing is compared with the files that rows come from, which reads no column.
    What is left is few: each is opened once.
    """
    read = spark.read.option("ignoreCorruptFiles", "true").schema(PAGES_DDL).parquet(path)
    gave = read.select(F.col("_metadata.file_path").alias("file")).groupBy("file").count().select("file")
    same = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    silent = _listed(spark, path).withColumn("name", same("file")).join(gave.select(same("file").alias("name")), "name", "left_anti")
    lost = []
    for row in silent.collect():
        try:
            spark.read.parquet(row.file).limit(1).collect()
        except Exception as problem:  # whatever is wrong with the file, it is that file's fate alone
            lost.append((row.file, f"{row.length} bytes: {str(problem).strip().splitlines()[0][:200]}"))
    return spark.createDataFrame(lost, "file string, detail string")
