"""Watching sources between two runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FELL, MOVED = 0.5, 0.2


def source_watch(prev: DataFrame, cur: DataFrame, failed: list[str] = ()) -> DataFrame:
    """(source, before, now, note): failed, new, check (fell below half: the earlier rows are kept), moved (by over a
    fifth) or ok."""
    now = cur.groupBy("source").agg(F.count(F.lit(1)).alias("now"))
    before = prev.groupBy("source").agg(F.count(F.lit(1)).alias("before"))
    out = before.join(now, "source", "full_outer").select("source", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("now", F.lit(0)).alias("now"))
    fail = F.col("source").isin(*failed) if failed else F.lit(False)
    moved = F.abs(F.col("now") - F.col("before")) > F.lit(MOVED) * F.col("before")
    return out.withColumn("note", F.when(fail, "failed").when(F.col("before") == 0, "new").when(F.col("now") < F.lit(FELL) * F.col("before"), "check").when(moved, "moved").otherwise("ok"))


def keep_previous(prev: DataFrame, cur: DataFrame, watch: DataFrame) -> DataFrame:
    """The current rows, with failed or collapsed sources replaced by their earlier rows."""
    bad = watch.where(F.col("note").isin("failed", "check")).select("source")
    return cur.join(F.broadcast(bad), "source", "left_anti").unionByName(prev.join(F.broadcast(bad), "source", "left_semi"))  # a row a source


def key_difference(prev: DataFrame, cur: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the earlier table that the current one lacks."""
    return prev.select(*keys).distinct().join(cur.select(*keys).distinct(), keys, "left_anti")


def vanished(prev: DataFrame, cur: DataFrame, watch: DataFrame, most: float = MOVED) -> DataFrame:
    """(source, source_id): open records gone since the last run, unless their source failed, collapsed, or lost more
    than ``most`` of its open records."""
    was = prev.where("state = 'open'").select("source", "source_id").distinct()
    gone = was.join(cur.select("source", "source_id").distinct(), ["source", "source_id"], "left_anti")
    total = was.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
    lost = gone.groupBy("source").agg(F.count(F.lit(1)).alias("lost"))
    fine = watch.where(~F.col("note").isin("failed", "check")).select("source")
    ok = total.join(lost, "source").where(F.col("lost") <= F.lit(most) * F.col("total")).select("source").join(fine, "source", "left_semi")
    return gone.join(ok, "source", "left_semi")


def hold(new: DataFrame, old: DataFrame, keys: tuple[str, ...] = ("source", "source_id")) -> DataFrame:
    """The new records and the earlier ones not seen again."""
    return new.unionByName(old.join(new.select(*keys), list(keys), "left_anti"))


def hold_vanished(gone: DataFrame, held: DataFrame, day, keys: tuple[str, ...] = ("source", "source_id")) -> DataFrame:
    """(keys, missed): records missed since; the first date stays."""
    rows = gone.select(*keys, F.lit(day).cast("date").alias("missed")).unionByName(held.select(*keys, "missed"))
    return rows.groupBy(*keys).agg(F.min("missed").alias("missed"))
