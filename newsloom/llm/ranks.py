"""Gapless ranks inside groups of any size, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that one sorted block holds on average.
ROWS_PER_BLOCK = 5_000


def with_rank(
    rows: DataFrame, group: str, order: list[Column], into: str, spread: Column, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Add ``into``: 0, 1, 2, ... inside every ``group``, in the order (block, ``order``).

    Blocks are hash ranges of ``spread``, so a group of any size is ranked by many
    tasks: each block counts its rows, the counts are summed up along the blocks of
    a group, and a block ranks its own rows from there. ``order`` should tell rows
    apart; equal rows get their ranks in any order. ``rows`` is evaluated three
    times, so it should be a narrow projection of stored rows. A null group is a
    group like any other.
    """
    blocks = max(1, -(-rows.count() // rows_per_block))
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64(spread), F.lit(blocks)).cast("int"))
    blocked = blocked.withColumn("_group", F.xxhash64(F.col(group)))
    starts = (
        blocked.groupBy("_group", "_block")
        .agg(F.count("*").alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_group", "_block", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    ranked = blocked.withColumn("_at", F.row_number().over(Window.partitionBy("_group", "_block").orderBy(*order)))
    return (
        ranked.join(starts, ["_group", "_block"])
        .withColumn(into, F.col("_before") + F.col("_at") - 1)
        .drop("_group", "_block", "_before", "_at")
    )
