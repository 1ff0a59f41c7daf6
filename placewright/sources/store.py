"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where a session has none (tests), a folder of its warehouse, which is set for it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: How many times larger than its file a table is taken to be in memory, at least, when a join is planned.
UNPACKED = 100


def planned_by_memory(spark: SparkSession) -> None:
    """Has the session take a table for ``UNPACKED`` times its files' size. Spark takes the files' size itself, though a
    dictionary and zstd leave some bytes a row of repeated names: it would collect tables of millions of rows on the driver
    to broadcast them. Tables that turn out small are still broadcast, by the size that they have when they are shuffled."""
    key = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(key)) < UNPACKED:
        spark.conf.set(key, str(float(UNPACKED)))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: plans after it start from a scan, and a lost executor's part is read again."""
    planned_by_memory(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *keys: str, buckets: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, dealt to buckets by ``keys`` and sorted in them: joins and groupings by the
    same keys, of tables of as many buckets, meet without a shuffle, however often the table is read.

    ``buckets`` (by default the session's shuffle partitions) should leave each bucket a few hundred MB."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    # one task a bucket writes, so that a bucket is one file and its order holds
    dealt = df.repartition(n, *keys)
    dealt.write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/{table}").bucketBy(n, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)
