"""Reachability kept between runs, for pages that land before the pages that link to them.

    runs/000001-<id>               a mark for each run, which numbers it
    pages/run=n/bucket=b           (website, url) of the pages that landed in run n
    edges/run=n/bucket=b           (website, from_url, to_url) of their links
    articles/run=n/bucket=b        what was read from them
    reached/run=n/round=r/bucket=b (website, url, landed) reached in run n; ``landed``: the run that they landed in
    targets/run=n/round=r/bucket=b (website, url) that the pages of the round before link to
    wanted/run=n/round=r/bucket=b  those of them that hadn't landed yet

A run joins its own pages with the start points and the wanted URLs, and then, round
after round, the newly reached pages with their edges: those of its own pages, and of
older pages only where these are reached now. Tables are dealt to buckets by URL, and
only buckets of runs that a page falls in are opened. Every table of a run is written
once; a run that is repeated under its id continues from what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.frontier import unseen
from newsloom.scratch import child_names, path_exists, touch

BUCKETS = 32
KEY = ["website", "url"]
PAGES = "website string, url string"
EDGES = "website string, from_url string, to_url string"
REACHED = "website string, url string, landed int"


def schema_text(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def bucket_of(url: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64("website", url), F.lit(buckets)).cast("int")


class LinkState:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # --- tables ----------------------------------------------------------------

    def number(self, run_id: str) -> int:
        """1, 2, 3, ... in the order in which runs began; the same for a repeated run."""
        names = child_names(self.spark, f"{self.path}/runs")
        for name in names:
            if name.split("-", 1)[1] == run_id:
                return int(name.split("-", 1)[0])
        number = len(names) + 1
        touch(self.spark, f"{self.path}/runs/{number:06d}-{run_id}")
        return number

    def _once(self, name: str, schema: str, make, url: str = "url") -> DataFrame:
        """The table ``name``, written by bucket unless that is done."""
        path = f"{self.path}/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            rows = make().withColumn("bucket", bucket_of(url, self.buckets))
            rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(f"{schema}, bucket int").parquet(path)

    def _folders(self, table: str, runs, buckets: set[int]) -> list[str]:
        """Folders of these buckets that runs have written, in all rounds."""
        found = []
        for run in runs:
            top = f"{self.path}/{table}/run={run}"
            names = child_names(self.spark, top)
            levels = [f"{top}/{n}" for n in names if n.startswith("round=")] or [top]
            for level in levels:
                inside = names if level == top else child_names(self.spark, level)
                found += [f"{level}/{n}" for n in inside if n.startswith("bucket=") and int(n[7:]) in buckets]
        return found

    def _read(self, table: str, schema: str, folders: list[str]) -> DataFrame:
        """Rows of these folders and the ``run`` that wrote them."""
        if not folders:
            return self.spark.createDataFrame([], f"{schema}, run int")
        reader = self.spark.read.schema(f"{schema}, run int").option("basePath", f"{self.path}/{table}")
        return reader.parquet(*folders)

    def _of_parts(self, table: str, schema: str, rows: DataFrame) -> DataFrame:
        """Rows of the runs and buckets that pages (website, url, landed) landed in."""
        # At most a row for each run and bucket.
        parts = rows.select("landed", bucket_of("url", self.buckets).alias("bucket")).distinct().collect()
        by_run: dict[int, set[int]] = {}
        for p in parts:
            by_run.setdefault(p.landed, set()).add(p.bucket)
        folders = [f for run, buckets in sorted(by_run.items()) for f in self._folders(table, [run], buckets)]
        return self._read(table, schema, folders)

    def _buckets(self, rows: DataFrame) -> set[int]:
        """The buckets that rows fall in, at most all of them."""
        return {r[0] for r in rows.select(bucket_of("url", self.buckets)).distinct().collect()}

    # --- look-ups ---------------------------------------------------------------

    def landed_among(self, keys: DataFrame, before: int) -> DataFrame:
        """(website, url, landed): which of these pages landed in runs before ``before``, and when."""
        return self._landed_in(self._buckets(keys), keys, before)

    def _landed_in(self, buckets: set[int], keys: DataFrame, before: int) -> DataFrame:
        """``landed_among`` for pages that fall in these buckets."""
        pages = self._read("pages", PAGES, self._folders("pages", range(1, before), buckets))
        return pages.withColumnRenamed("run", "landed").join(keys.select(*KEY), KEY, "left_semi")

    def articles_of(self, reached: DataFrame, schema: str) -> DataFrame:
        """What was read from reached pages (website, url, landed)."""
        return self._of_parts("articles", schema, reached).drop("run").join(reached.select(*KEY), KEY, "left_semi")

    # --- a run ------------------------------------------------------------------

    def advance(self, run: int, articles: DataFrame, edges: DataFrame, starts: DataFrame) -> DataFrame:
        """(website, url, landed): pages that this run reaches for the first time.

        ``articles`` are what was read from the pages that landed now, one for each
        (website, url) and none that landed before; ``edges`` their accepted links;
        ``starts`` (website, url) the start points.
        """
        self._once(f"articles/run={run}", schema_text(articles), lambda: articles)
        pages = self._once(f"pages/run={run}", PAGES, lambda: articles.select(*KEY)).select(*KEY)
        self._once(f"edges/run={run}", EDGES, lambda: edges.select("website", "from_url", "to_url"), "from_url")

        def entered() -> DataFrame:
            wanted = self._read("wanted", PAGES, self._folders("wanted", range(1, run), self._buckets(pages)))
            called = starts.select(*KEY).unionByName(wanted.select(*KEY)).distinct()
            return pages.join(called, KEY, "left_semi").withColumn("landed", F.lit(run))

        depth = 0
        level = self._once(f"reached/run={run}/round=0", REACHED, entered)
        while not level.isEmpty():
            here = level

            def found() -> DataFrame:
                edges = self._of_parts("edges", EDGES, here)
                hops = edges.join(here.select("website", F.col("url").alias("from_url")), ["website", "from_url"])
                return hops.select("website", F.col("to_url").alias("url")).distinct()

            depth += 1
            targets = self._once(f"targets/run={run}/round={depth}", PAGES, found).select(*KEY)
            # Of the targets of reached pages: which have landed, and which of these are new.
            among = self._buckets(targets)
            known = self._landed_in(among, targets, run + 1)
            before = self._read("reached", PAGES, self._folders("reached", range(1, run + 1), among))
            self._once(f"wanted/run={run}/round={depth}", PAGES, lambda: unseen(targets, KEY, known))  # noqa: B023
            level = self._once(f"reached/run={run}/round={depth}", REACHED, lambda: unseen(known, KEY, before))  # noqa: B023
        return self.reached_in(run)

    def reached_in(self, run: int) -> DataFrame:
        folders = self._folders("reached", [run], set(range(self.buckets)))
        return self._read("reached", REACHED, folders).drop("run")
