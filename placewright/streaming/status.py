"""Status kept up to date from a stream of attached evidence: each micro-batch is folded into the stored last dates.

The fold keeps, per place and state, the last date and its source, which is all that status_of needs, so that late and
repeated records change nothing they should not."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "place_id string, state string, date date, source string"


def fold(rows: DataFrame) -> DataFrame:
    best = F.max(F.when(F.col("date").isNotNull(), F.struct("date", "source")))
    return rows.groupBy("place_id", "state").agg(best.alias("b")).select("place_id", "state", F.col("b.date").alias("date"), F.col("b.source").alias("source"))


def status_from_state(state: DataFrame, build: date, recent_days: int = 730) -> DataFrame:
    g = state.groupBy("place_id").agg(*[F.max(F.when(F.col("state") == s, F.col(c))).alias(f"{s}_{c}") for s in ("open", "closed") for c in ("date", "source")])
    shut = F.col("closed_date").isNotNull() & (F.col("open_date").isNull() | (F.col("open_date") <= F.col("closed_date")))
    fresh = F.col("open_date") >= F.date_sub(F.lit(build), recent_days)
    return g.select("place_id", F.when(shut, "closed").when(fresh, "open").otherwise("unknown").alias("status"), F.when(shut, F.col("closed_date")).otherwise(F.col("open_date")).alias("status_date"), F.when(shut, F.col("closed_source")).otherwise(F.col("open_source")).alias("status_source"))


def keep_status(stream: DataFrame, folder: str, checkpoint: str):
    """A streaming query that keeps ``folder``/batch=<n> tables of state; the largest n is current. A batch that is run
    again after a failure rewrites its own table from the one before, so that nothing counts twice."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.select("place_id", "state", "date", "source")
        if number > 0:
            new = new.unionByName(spark.read.schema(STATE).parquet(f"{folder}/batch={number - 1}"))
        fold(new).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
