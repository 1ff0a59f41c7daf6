"""Published files: clustered places, the narrow status file, the manifest, and what changed between two builds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..sources.register_text import opened

STATUS_COLUMNS = ("id", "status", "status_date", "status_source", "open_score", "missing_license")
ROW_GROUP = 20_000
#: Rows of a published file at most, and the bytes of it that the manifest holds at once.
FILE_ROWS, BLOCK = 1_000_000, 8 << 20
WORLD = (-90.0, -180.0, 90.0, 180.0)


def hilbert_order(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    return df.withColumn("curve", geo.hilbert(F.col("lat"), F.col("lng"), box))


def publish_clustered(df: DataFrame, path: str, box: tuple[float, float, float, float], files: int | None = None, row_group: int = ROW_GROUP) -> None:
    """Zstd parquet along the Hilbert curve: each file a range of it, in row groups of at most ``row_group`` rows, so that
    a box read skips most of them, and no file of more than FILE_ROWS rows."""
    out = hilbert_order(df, box)
    out = out.repartitionByRange(files, "curve") if files else out.repartitionByRange("curve")
    out.sortWithinPartitions("curve", "id").drop("curve").write.option("compression", "zstd").option("parquet.block.row.count.limit", row_group).option("maxRecordsPerFile", FILE_ROWS).parquet(path)


def status_file(df: DataFrame) -> DataFrame:
    return df.select(*STATUS_COLUMNS).sort("id")


def publish_regions(df: DataFrame, path: str, regions: list[str] | None = None, order: str = "curve") -> None:
    """One job that writes ``df`` as ``path``/region=.../, along one Hilbert curve of the world (or by id with ``order`` 'id').

    Rows are dealt by ranges of (region, order), so that a large region is many tasks' and small ones share one. Only the
    regions that ``regions`` names (by default all of ``df``) are replaced; the others' files stay as they are. A named
    region without a row is an error: its files would stay silently."""
    if regions is not None:
        df = df.where(F.col("region").isin(regions))
        if missing := set(regions) - {r["region"] for r in df.select("region").distinct().collect()}:
            raise ValueError(f"nothing to publish for {', '.join(sorted(missing))}")
    df = df.withColumn("curve", geo.hilbert(F.col("lat"), F.col("lng"), WORLD, bits=22)) if order == "curve" else df
    out = df.repartitionByRange("region", order).sortWithinPartitions("region", *dict.fromkeys([order, "id"]))
    out = out.drop("curve").write.option("compression", "zstd").option("parquet.block.row.count.limit", ROW_GROUP).option("maxRecordsPerFile", FILE_ROWS)
    out.partitionBy("region").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def publish_layers(layers: dict[str, DataFrame], path: str, license_: str, regions: list[str] | None = None) -> DataFrame:
    """Publish several layers (name to table with region, id; with lat and lng they are clustered) under ``path``, and give
    the manifest of all their files, which is also written to ``path``/manifest as JSON."""
    out = None
    for name, df in layers.items():
        publish_regions(df, f"{path}/{name}", regions, "curve" if {"lat", "lng"} <= set(df.columns) else "id")
        found = manifest(df.sparkSession, f"{path}/{name}", name, license_)
        out = found if out is None else out.unionByName(found)
    out.repartitionByRange("layer", "region", "name").sortWithinPartitions("layer", "region", "name").write.mode("overwrite").json(f"{path}/manifest")
    return out.sparkSession.read.schema(out.schema).json(f"{path}/manifest")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, sha256, rows) of parquet files, read block by block; the rows are those of the footer."""
    for b in batches:
        paths, sums, rows = b.column("path").to_pylist(), [], []
        for p in paths:
            system, at = opened(p)
            state = hashlib.sha256()
            with system.open_input_file(at) as file:
                while block := file.read(BLOCK):
                    state.update(block)
                file.seek(0)
                rows.append(pq.ParquetFile(file).metadata.num_rows)
            sums.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sums, pa.string()), pa.array(rows, pa.int64())], ["path", "sha256", "rows"])


def manifest(spark: SparkSession, path: str, layer: str, license_: str) -> DataFrame:
    """(name, layer, license, region, bytes, sha256, rows) of each parquet file below a folder; region is null outside of
    region folders. Files are dealt one by one and read as a stream, so that their size costs time only."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path", "length")
    read = listed.select("path").repartition("path").mapInArrow(_digested, "path string, sha256 string, rows long")
    out = read.join(listed.select("path", F.col("length").alias("bytes")), "path")
    region = F.regexp_extract("path", "/region=([^/]+)/", 1)
    return out.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.lit(layer).alias("layer"), F.lit(license_).alias("license"), F.nullif(region, F.lit("")).alias("region"), "bytes", "sha256", "rows")


def snapshot_diff(prev: DataFrame, cur: DataFrame, keys: tuple[str, ...] = ("region", "id")) -> DataFrame:
    """(region, id, change, old_status, new_status, ...): ids whose status differs between two builds, by kind of change."""
    extra = [c for c in ("status_date", "status_source") if c in cur.columns]
    old = prev.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("status").alias("o"), F.lit(True).alias("o_in"))
    new = cur.select(*keys, F.col("status").alias("n"), F.lit(True).alias("n_in"), *extra)
    on = None
    for k in keys:
        on = (new[k] == old[f"o_{k}"]) if on is None else on & (new[k] == old[f"o_{k}"])
    both = new.join(old, on, "full_outer")
    o, n = F.col("o"), F.col("n")
    change = (
        F.when(F.col("o_in").isNull(), "appeared").when(F.col("n_in").isNull(), "vanished").when((o != "closed") & (n == "closed"), "closed").when((o == "closed") & (n == "open"), "reopened")
        .when((o == "unknown") & (n == "open"), "confirmed_open").when((o == "open") & (n == "unknown"), "went_quiet").when((o == "closed") & (n == "unknown"), "closure_withdrawn")
    )
    out = both.where(F.col("o_in").isNull() | F.col("n_in").isNull() | (o != n))
    return out.select(*[F.coalesce(k, f"o_{k}").alias(k) for k in keys], change.alias("change"), o.alias("old_status"), n.alias("new_status"), *extra)


def change_summary(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("places"))


def write_changes(changes: DataFrame, path: str) -> None:
    """changes (parquet) and summary (one CSV) under ``path``."""
    changes.orderBy("region", "change", "id").write.option("compression", "zstd").parquet(f"{path}/changes")
    change_summary(changes).orderBy(F.desc("places"), "change").coalesce(1).write.option("header", True).csv(f"{path}/changes-summary")


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the schema's columns that it lacks added as nulls."""
    have = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have})
