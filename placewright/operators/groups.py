"""Rows that are alike in what a join asks of them meet once, as one row with their ids, and are told apart again after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import settled

#: Ids of one array; rows of more common keys are dealt over as many arrays as they need.
LOT = 500
#: Keys of that many rows, or distinct values, that are sent to all executors at most.
SENT = 200_000


def gathered(df: DataFrame, keys: list[str], value: str, most: int = LOT) -> DataFrame:
    """(keys, value): the ``value`` of all rows of equal ``keys``, nulls too, in arrays of about ``most`` at most."""
    rows = settled(df.select(*keys, value), "gathered-rows")
    many = settled(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most), "many-alike")
    held = many.limit(SENT + 1).count()
    lot = F.lit(0).cast("long")
    if held:
        many = many.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_n")
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
        rows = rows.join(F.broadcast(many) if held <= SENT else many, same, "left")
        lot = F.coalesce(F.pmod(F.xxhash64(value), F.ceil(F.col("_n") / most)), lot)
    return rows.withColumn("_lot", lot).groupBy(*keys, "_lot").agg(F.collect_list(value).alias(value)).drop("_lot")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` over enough tasks for a join whose work goes by pairs, not by the bytes of its sides."""
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def spread(df: DataFrame, *values: str) -> DataFrame:
    """``df`` with a row for each element of the arrays ``values``: of several, for each combination."""
    for v in values:
        df = df.withColumn(v, F.explode(v))
    return df


def by_value(df: DataFrame, column: str, derived: dict[str, Column]) -> DataFrame:
    """``df`` with ``derived`` columns, functions of ``column`` alone, computed once for each of its values where these are
    few, else once a row. ``df`` is read twice."""
    values = settled(df.select(column).where(F.col(column).isNotNull()).distinct(), "values")
    if values.limit(SENT + 1).count() > SENT:
        return df.withColumns(derived)
    known = settled(values.withColumns(derived), "derived").withColumnRenamed(column, "_value")
    null = {n: F.col(n) for n in derived}
    return df.join(F.broadcast(known), F.col(column) == F.col("_value"), "left").drop("_value").select(*df.columns, *null)
