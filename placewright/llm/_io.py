"""Where intermediate tables go, and size checks in front of broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be sent to every executor as a hash table or array; beyond it the callers take their shuffle path.
BROADCAST_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; set here only where a session has none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def hinted(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for a broadcast join if it has at most ``limit`` rows, else unchanged (Spark then shuffles)."""
    return F.broadcast(df) if small(df, limit) else df


def running_total(sums: DataFrame, key: str, value: str, out: str, fan: int = 4096) -> DataFrame:
    """(key, value) with unique long keys -> (key, out): the sum of ``value`` over all smaller keys.

    Two levels of windows, so that no task gets more than ``fan`` keys or one row per ``fan`` keys."""
    from pyspark.sql import Window as W

    top = F.floor(F.col(key) / F.lit(fan)).cast("long").alias("_top")
    s = sums.select(key, value, top)
    above = s.groupBy("_top").agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_top").rowsBetween(W.unboundedPreceding, -1)
    above = above.select("_top", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_above"))
    inside = W.partitionBy("_top").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    s = s.select(key, "_top", F.coalesce(F.sum(value).over(inside), F.lit(0)).alias("_inside"))
    return s.join(above, "_top").select(key, (F.col("_above") + F.col("_inside")).alias(out))
