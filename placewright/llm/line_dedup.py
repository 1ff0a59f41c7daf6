"""Line deduplication relative to the site: a line that a large share of a host's pages has is boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import BROADCAST_ROWS, saved, small


def lines_of(text: Column) -> Column:
    """The lines of a text, split at \\n; null has none."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))


def line_key(line: Column) -> Column:
    """What makes lines the same: the 64-bit hash of the trimmed line; blank lines have none (null) and always stay."""
    trimmed = F.trim(line)
    return F.when(trimmed != "", F.xxhash64(trimmed))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 2) -> DataFrame:
    """(host, line, pages, host_pages): lines on at least ``min_pages`` pages and on more than ``ratio`` of their host's.

    Two pages are the least that can share a line: of a host with fewer than 10, each line of its own would be on more
    than a tenth. A page counts once however often it has the line. Both counts are combined before the shuffle, so that neither a hot
    host nor a hot line sends a row a page."""
    pages = docs.select(F.col(host).alias("_host"), F.col(text).alias("_text"))
    totals = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("host_pages"))
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("_text")), line_key), lambda k: k.isNotNull()))
    counts = pages.select("_host", F.explode(keys).alias("line")).groupBy("_host", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    both = counts.join(totals, counts["_host"].eqNullSafe(totals["_host"])).where(F.col("pages") > F.lit(ratio) * F.col("host_pages"))
    return both.select(counts["_host"].alias("host"), "line", "pages", "host_pages")


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 2, salts: int = 64, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with ``text`` cleaned, and n_lines, n_dropped (long) added.

    Every copy of a boilerplate line goes, blank lines stay, and the other lines keep their order. A null text stays null
    (no lines); a null host is a host of its own. A host has at most (its lines) / (ratio * its pages) such lines, so that
    its list stays short; the lists are broadcast if they have at most ``limit`` lines together, else joined by
    (host, salt), each host's pages dealt over ``salts`` tasks. Extra columns are kept, except that columns called
    n_lines or n_dropped are replaced. Repeated rows have a row each, and count as pages each; an empty text is one blank
    line; a line is compared whole, however long; no rows give no rows."""
    found = saved(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    lists = found.groupBy(F.col("host").alias("_host")).agg(F.collect_set("line").alias("_lines"))
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("at"), F.col(text).alias("text"))
    if small(found, limit):
        out = rows.join(F.broadcast(lists), F.col("at").eqNullSafe(F.col("_host")), "left")
    else:
        lists = lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("text"), F.lit(salts)).cast("int"))
        out = dealt.join(lists, F.col("at").eqNullSafe(F.col("_host")) & (F.col("_deal") == F.col("_salt")), "left")
    lines = lines_of(F.col("text"))
    kept = F.filter(lines, lambda x: F.coalesce(~F.array_contains(F.col("_lines"), line_key(x)), F.lit(True)))
    made = {"n_lines": F.size(lines).cast("long"), "_kept": kept}
    out = out.withColumns(made).withColumn("n_dropped", F.col("n_lines") - F.size("_kept"))
    clean = F.when(F.col("text").isNotNull(), F.array_join("_kept", "\n")).alias(text)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*[clean if c == text else F.col("row").getField(c).alias(c) for c in names], "n_lines", "n_dropped")
