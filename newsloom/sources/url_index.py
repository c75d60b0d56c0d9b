"""Index of stored URLs: which of these are in the store, without reading the store.

    shapes/append=n             a row for each bucket: its keys, the blocks of its filter
    filters/append=n/bucket=b   blocks of a Bloom filter, 256 bits each
    keys/append=n/bucket=b      (website, url)

A URL's hash gives its bucket. A look-up joins one filter block to each URL and append,
and then reads the keys of those buckets only in which a filter says that a URL may be
there. An append adds files and changes none; when there are many, one append replaces
them by their union. An append counts once its shapes are complete, which are written
last: a failed one leaves files that the next one overwrites.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.scratch import child_names, materialize, path_exists, remove

BUCKETS = 64
# Bits of a filter for each key, in blocks of four numbers of 64 bits; bits set for a key.
BITS_A_KEY, WORDS, BITS_SET = 12, 4, 6
# Appends that are looked up one by one before they are merged.
LIVE_APPENDS = 8
# Rows to look up that are made distinct and broadcast to meet filters and keys.
BROADCAST_ROWS = 200_000

SHAPES_DDL = "bucket int, n_keys bigint, n_blocks bigint, covers_from int, buckets int, append int"


def bucket_of(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), url), F.lit(buckets)).cast("int")


def block_of(url: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), url), blocks)


def key_bits(url: Column) -> list[Column]:
    """The bits that a key sets in its block, a number of 64 bits for each word."""
    drawn = F.xxhash64(F.lit("bits"), url)
    places = [F.shiftrightunsigned(drawn, 8 * i).bitwiseAND(F.lit(255)) for i in range(BITS_SET)]
    one = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
    zero = F.lit(0).cast("long")
    of_word = lambda w: [F.when(F.shiftright(p, 6) == w, one(p)).otherwise(zero) for p in places]
    return [reduce(lambda a, b: a.bitwiseOR(b), of_word(w)) for w in range(WORDS)]


class UrlIndex:
    """Stored (website, url) under ``path``. ``buckets`` is fixed by the first append."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self._buckets = spark, path.rstrip("/"), buckets

    # --- what is there ---------------------------------------------------------

    def shapes(self) -> list:
        """Rows of the appends that count, the latest first, merged ones in place of what they replace."""
        names = child_names(self.spark, f"{self.path}/shapes")
        done = [n for n in names if path_exists(self.spark, f"{self.path}/shapes/{n}/_SUCCESS")]
        if not done:
            return []
        # A row for each append and bucket.
        rows = self.spark.read.schema(SHAPES_DDL).option("basePath", f"{self.path}/shapes").parquet(
            *[f"{self.path}/shapes/{n}" for n in done]
        ).collect()
        live, below = [], None
        for append in sorted({r.append for r in rows}, reverse=True):
            if below is None or append < below:
                mine = [r for r in rows if r.append == append]
                live += mine
                below = mine[0].covers_from
        return live

    def count(self) -> int:
        return sum(r.n_keys for r in self.shapes())

    def next_append(self) -> int:
        numbers = [int(n.split("=")[1]) for n in child_names(self.spark, f"{self.path}/shapes") if "=" in n]
        done = [n for n in numbers if path_exists(self.spark, f"{self.path}/shapes/append={n}/_SUCCESS")]
        return max(done, default=0) + 1

    def keys(self, parts: list[tuple[int, int]]) -> DataFrame:
        """Keys of the given (append, bucket) parts; no other file is listed or opened."""
        if not parts:
            return self.spark.createDataFrame([], "website string, url string")
        paths = [f"{self.path}/keys/append={a}/bucket={b}" for a, b in parts]
        return self.spark.read.schema("website string, url string").parquet(*paths)

    # --- appends ----------------------------------------------------------------

    def append(self, keys: DataFrame) -> None:
        """Add (website, url) keys that the index doesn't hold."""
        live = self.shapes()
        if len({r.append for r in live}) >= LIVE_APPENDS:
            self.merge()
        number = self.next_append()
        self._write(keys.select("website", "url"), number, number)

    def merge(self) -> None:
        """Replace all appends by one."""
        live = self.shapes()
        if live:
            parts = [(r.append, r.bucket) for r in live if r.n_keys]
            self._write(self.keys(parts), self.next_append(), 1)

    def rebuild(self, keys: DataFrame) -> None:
        """Replace everything by ``keys``."""
        self._write(keys.select("website", "url"), self.next_append(), 1)

    def vacuum(self) -> None:
        """Remove what merged appends have replaced. Not while another run looks something up."""
        live = {r.append for r in self.shapes()}
        for table in ("filters", "keys", "shapes"):
            for name in child_names(self.spark, f"{self.path}/{table}"):
                if "=" in name and int(name.split("=")[1]) not in live:
                    remove(self.spark, f"{self.path}/{table}/{name}")

    def _write(self, keys: DataFrame, number: int, covers_from: int) -> None:
        shapes = self.shapes()
        buckets = shapes[0].buckets if shapes else self._buckets
        folder = lambda table: f"{self.path}/{table}/append={number}"
        placed = keys.withColumn("bucket", bucket_of(F.col("url"), buckets))
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder("keys"))
        written = self.spark.read.schema("website string, url string, bucket int").parquet(folder("keys"))
        counts = written.groupBy("bucket").agg(F.count("*").alias("n_keys"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n_keys") * BITS_A_KEY / (64 * WORDS))).cast("long")
        counts = materialize(counts.withColumn("n_blocks", blocks), "index-counts")
        # A row for each bucket.
        rows = written.select("url", "bucket").join(F.broadcast(counts), "bucket")
        words = [w.alias(f"w{i}") for i, w in enumerate(key_bits(F.col("url")))]
        bits = rows.select("bucket", block_of(F.col("url"), F.col("n_blocks")).alias("block"), *words)
        filters = bits.groupBy("bucket", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
        filters.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder("filters"))
        shape = counts.withColumns({"covers_from": F.lit(covers_from), "buckets": F.lit(buckets)})
        shape.coalesce(1).write.mode("overwrite").parquet(folder("shapes"))

    # --- look-ups -----------------------------------------------------------------

    def holding(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Distinct ``keys`` of ``rows`` that are stored: (website, URL) or the URL alone, whatever it is called."""
        url = keys[-1]
        asked = materialize(rows.select(*keys).filter(F.col(url).isNotNull()).distinct(), "asked")
        return self.stored_among(asked, keys)

    def stored_among(self, asked: DataFrame, keys: list[str]) -> DataFrame:
        url = keys[-1]
        shapes = [r for r in self.shapes() if r.n_keys]
        if not shapes:
            return asked.limit(0)
        few = asked.count() <= BROADCAST_ROWS
        candidates = materialize(self.maybe_stored(asked, url, shapes, few), "maybe-stored")
        # At most a row for each append and bucket.
        parts = [(r.append, r.bucket) for r in candidates.select("append", "bucket").distinct().collect()]
        found = self.keys(parts).withColumnRenamed("url", url)
        wanted = candidates.select(*keys).distinct()
        # The side that is looked up is the small one; the keys of its buckets are only scanned.
        wanted = F.broadcast(wanted) if few else wanted
        return found.join(wanted, keys, "left_semi").select(*keys).distinct()

    def maybe_stored(self, asked: DataFrame, url: str, shapes: list, few: bool) -> DataFrame:
        """(keys, append, bucket): what the filters can't rule out."""
        buckets = shapes[0].buckets
        placed = asked.withColumn("bucket", bucket_of(F.col(url), buckets))
        hit = {r.bucket for r in placed.select("bucket").distinct().collect()}
        shapes = [r for r in shapes if r.bucket in hit]
        if not shapes:
            return placed.withColumn("append", F.lit(0)).limit(0)
        known = self.spark.createDataFrame([(r.append, r.bucket, r.n_blocks) for r in shapes], "append int, bucket int, n_blocks long")
        each = placed.join(F.broadcast(known), "bucket")
        each = each.withColumn("block", block_of(F.col(url), F.col("n_blocks"))).drop("n_blocks")
        schema = "block bigint, " + "".join(f"w{i} bigint, " for i in range(WORDS)) + "append int, bucket int"
        paths = [f"{self.path}/filters/append={r.append}/bucket={r.bucket}" for r in shapes]
        filters = self.spark.read.schema(schema).option("basePath", f"{self.path}/filters").parquet(*paths)
        joined = filters.join(F.broadcast(each) if few else each, ["append", "bucket", "block"])
        mine = key_bits(F.col(url))
        told = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(mine)]
        return joined.filter(reduce(and_, told)).select(*asked.columns, "append", "bucket")
