"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition is a run of (digest, identifier) entries. In each round ``fan`` neighbouring runs are merged into
one and of each digest the entry with the winning identifier and the number of rows behind it stay, so that after
log_fan(runs) rounds one entry a text is left, whatever number of rows shares it. A round moves at most one entry a
(digest, run); texts never move. Entries carry the text's length beside its SHA-256, and a digest that came with two
lengths would raise an error (``verified``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import hinted, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is. lower() does that for ASCII text, translate() for any."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the normalised text; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def merge_runs(runs: DataFrame, keep: str = "largest", fan: int = 16, rounds: int = 2) -> DataFrame:
    """(digest, n_bytes, id, run) entries -> (digest, keep_id, group_size), by ``rounds`` merges of ``fan`` runs each
    and a last one of all that is left (with ``fan`` 16 and 2 rounds, a 256th of the runs)."""
    best = F.max if keep == "largest" else F.min
    level = runs.withColumn("n", F.lit(1).cast("long")).withColumn("short", F.col("n_bytes")).withColumn("long", F.col("n_bytes"))
    entry = [best("id").alias("id"), F.sum("n").alias("n"), F.min("short").alias("short"), F.max("long").alias("long")]
    for _ in range(rounds):
        level = level.withColumn("run", F.floor(F.col("run") / fan)).groupBy("digest", "run").agg(*entry)
    top = level.groupBy("digest").agg(*entry)
    verified = F.when(F.col("short") == F.col("long"), F.col("id")).otherwise(F.raise_error(F.lit("two texts share a digest")).cast("long"))
    return top.select("digest", verified.alias("keep_id"), F.col("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "largest", fan: int = 16, rounds: int = 2) -> DataFrame:
    """One row a row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest (or smallest)
    doc_id of equal texts stays. A null doc_id never stays while another row has one; a group of only null ids has a null
    keep_id and kept is true for all its rows, as for rows that repeat the winning doc_id (nothing tells them apart).
    Extra columns are ignored; no rows give no rows."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("text_sha256"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("n_bytes"))
    runs = rows.select(F.col("text_sha256").alias("digest"), "n_bytes", F.col("doc_id").alias("id"), F.spark_partition_id().alias("run"))
    groups = saved(merge_runs(runs, keep, fan, rounds), "exact-groups")
    out = rows.join(groups, rows.text_sha256 == groups.digest)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns. Rows that repeat both the text and the winning doc_id (or have
    equal texts and null ids only) are one row, taken from any of them.

    Only winners' (digest, id) keys meet the table again; broadcast up to a size, else joined by a shuffle."""
    groups = merge_runs(docs.select(digest(F.col(text)).alias("digest"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("n_bytes"), F.col(doc_id).alias("id"), F.spark_partition_id().alias("run")), keep)
    groups = saved(groups, "exact-groups")
    # Rows alone with their text need no look-up by others: only groups of two and more name losers.
    shared = groups.where("group_size > 1").select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep"))
    keyed = docs.select(F.struct("*").alias("row"), digest(F.col(text)).alias("d"), F.col(doc_id).alias("id"))
    out = keyed.join(hinted(shared), F.col("d") == F.col("_digest"), "left")
    single = out.where(F.col("_digest").isNull())
    winners = out.where(F.col("_digest").isNotNull() & F.col("id").eqNullSafe(F.col("_keep"))).groupBy("d").agg(F.first("row").alias("row"))
    return single.select("row").unionByName(winners.select("row")).select("row.*")
