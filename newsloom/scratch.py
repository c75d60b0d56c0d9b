"""Where a job puts intermediate tables.

The folder must be shared by all executors, so it is read from
``spark.checkpoint.dir``. Where that is unset, a session on one machine uses a folder
beside the warehouse, and a cluster is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch"
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/newsloom-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and keeps column pruning."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """``materialize`` into buckets by ``columns``: joins on them don't shuffle this side again."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"newsloom_{label}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *columns).write.bucketBy(buckets, *columns)
    writer.option("path", scratch_path(spark, label)).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return table


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it doesn't exist."""
    if not path_exists(spark, path):
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(s.getPath().getName() for s in jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file as a mark that survives the driver."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path, True).close()


def remove(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
