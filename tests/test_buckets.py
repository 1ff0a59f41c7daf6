"""Joins and folds by place id over bucketed tables: the same rows, without a shuffle of the tables."""

from datetime import date

from pyspark.sql import functions as F

from placewright.operators import evidence, publish, score
from placewright.plans import build
from placewright.sources.store import bucketed


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def rows(df):
    return sorted(map(str, df.collect()))


def test_status_members_and_their_join_without_a_shuffle(spark):
    n = F.col("id")
    place = spark.range(600).select(F.concat(F.lit("p"), n).alias("id"), F.concat(F.lit("name "), n).alias("name"))
    # a third of all evidence and members is of one place, and some is of none that is listed
    at = F.when(n % 3 == 0, "p5").otherwise(F.concat(F.lit("p"), n % 700))
    ev = spark.range(5000).select(at.alias("place_id"), F.concat(F.lit("s"), n % 4).alias("source"), n.cast("string").alias("source_id"), F.when(n % 5 == 0, "closed").otherwise("open").alias("state"), F.date_add(F.lit(date(2000, 1, 1)), (n % 600).cast("int")).alias("date"), F.lit("number").alias("rule"), F.lit(1.0).alias("dist"))
    member = spark.range(3000).select(at.alias("place_id"), F.lit("atp").alias("source"), n.cast("string").alias("source_id"))
    params = build.Params(date(2001, 11, 5))
    plain = build.Layer(place, member, ev, evidence.status_of(ev, params.build), None, None)
    stored = build.stored_by_place(plain, params, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(build.summary_by_place(plain)) == 3
        assert exchanges(build.summary_by_place(stored)) == 0
        assert exchanges(stored.status) == 0 and exchanges(score.member_rollup(stored.member)) == 0
        assert rows(build.summary_by_place(stored)) == rows(build.summary_by_place(plain))
        assert rows(stored.status) == rows(plain.status)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_diff_of_bucketed_snapshots(spark):
    half = lambda k: spark.range(k, 1000 + 7 * k).select((F.col("id") % 5).cast("string").alias("region"), F.col("id").cast("string").alias("id"), F.element_at(F.array(F.lit("open"), F.lit("closed"), F.lit("unknown")), ((F.col("id") * (k + 1)) % 3 + 1).cast("int")).alias("status"))
    prev, cur = half(0), half(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = [bucketed(df, "snapshot", "region", "id", buckets=4) for df in (prev, cur)]
        assert exchanges(publish.snapshot_diff(prev, cur)) == 2 and exchanges(publish.snapshot_diff(*kept)) == 0
        assert rows(publish.snapshot_diff(*kept)) == rows(publish.snapshot_diff(prev, cur))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
