"""Files read and published: registers with a header each, the manifest's digests, regions replaced one by one."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from placewright.operators import publish
from placewright.sources import scan


def plain_lines(data: bytes, encoding: str, sep: str, head: str):
    """{(offset): fields} behind the line that has ``head``, by splitting at newlines."""
    at, names, out = 0, None, {}
    for raw in data.split(b"\n"):
        line = raw.decode(encoding).strip("\r﻿")
        if names is not None and line.strip():
            out[at] = line.split(sep)
        elif names is None and head in line:
            names = line.split(sep)
        at += len(raw) + 1
    return names, out


@pytest.mark.parametrize("step", [7, 64, 1000, 1 << 20])
def test_two_registers_with_different_preambles(spark, tmp_path, step):
    """Ranges that end inside lines, headers and preambles; other columns and order; short and long rows; no newline at the end."""
    folder = tmp_path / "lists"
    folder.mkdir()
    one = "Updated 3rd of May 2024\r\nfor use of all\r\nName;Id;City\r\n" + "".join(f"Café {i};{i};Town\r\n" for i in range(40)) + "Short;77\r\nLong;78;Town;more;still more\r\n\r\n  \r\nLast;79;End"
    two = "﻿Id;Name;State\n" + "".join(f"{i};Bar {i};NY\n" for i in range(100, 130))
    (folder / "one.csv").write_bytes(one.encode())
    (folder / "two.csv").write_bytes(two.encode())
    (folder / "_SUCCESS").write_bytes(b"no; header; here")
    spec = scan.FileSpec(columns=["Id", "Name", "City", "State"], sep=";", quote="", encoding="utf-8-sig", skip_until="Name")
    spark.dataSource.register(scan.RegisterText)
    df = spark.read.format("register_text").options(path=str(folder), sep=";", quote="", skip_until="Name", columns="\n".join(spec.columns), range_bytes=step).load()
    got = {(os.path.basename(r._file), r._offset): r for r in df.collect()}
    want = 0
    for name, text in (("one.csv", one), ("two.csv", two)):
        names, lines = plain_lines(text.encode(), "utf-8", ";", "Name")
        want += len(lines)
        for at, fields in lines.items():
            r = got[name, at]
            for c in spec.columns:
                i = names.index(c) if c in names else None
                assert r[c] == (fields[i] if i is not None and i < len(fields) else None)
            assert r._rest == (";".join(fields[len(names) :]) or None)
            assert r._preamble == ("Updated 3rd of May 2024\nfor use of all" if name == "one.csv" else "")
    assert len(got) == want == df.count()
    if step == 64:
        assert scan.scan_register_text(spark, str(folder), spec).count() == want


def test_register_quotes_encodings_and_missing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('x\nId,Name\n1,"Bar, ""Best"""\n2,Caf\xe9\n'.encode("latin-1"))
    spec = scan.FileSpec(sep=",", encoding="latin-1", skip_until="^Id")
    rows = {r.Id: r.Name for r in scan.scan_register_text(spark, str(tmp_path / "a.csv"), spec).collect()}
    assert rows == {"1": 'Bar, "Best"', "2": "Café"}
    (tmp_path / "b.csv").write_bytes(b"nothing\n")
    with pytest.raises(Exception, match="no line"):
        scan.scan_register_text(spark, str(tmp_path / "b.csv"), scan.FileSpec(columns=["Id"], skip_until="^Id")).collect()


def test_manifest_equals_digests_of_the_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "BLOCK", 1000)
    path = str(tmp_path / "out")
    df = spark.range(30_000).select(F.col("id").cast("string").alias("id"), (F.rand(1) * 0.1 + 38.8).alias("lat"), (F.rand(2) * 0.1 - 77).alias("lng"))
    publish.publish_clustered(df, path, (38.8, -77.1, 39.0, -76.9), files=3)
    got = {r.name: r for r in publish.manifest(spark, path, "core", "x").collect()}
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert set(got) == set(files) and len(files) == 3 and sum(r.rows for r in got.values()) == 30_000
    for f in files:
        data = open(f"{path}/{f}", "rb").read()
        assert got[f].sha256 == hashlib.sha256(data).hexdigest() and got[f].bytes == len(data)
        assert got[f].rows == spark.read.parquet(f"{path}/{f}").count() and got[f].region is None


def seen(path):
    return {f"{os.path.basename(d)}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_one_region_is_rebuilt_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "places")
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.element_at(F.array(F.lit("DC"), F.lit("NY"), F.lit("VA")), (F.col("id") % 3 + 1).cast("int")).alias("region"), (F.rand(1) * 10 + 30).alias("lat"), (F.rand(2) * 10 - 80).alias("lng"), F.lit(1).alias("v"))
    publish.publish_regions(df, path)
    before = seen(path)
    publish.publish_regions(df.withColumn("v", F.lit(2)), path, ["DC"])
    after = seen(path)
    kept = {k: t for k, t in before.items() if not k.startswith("region=DC")}
    assert kept and kept.items() <= after.items() and not {k for k in before if k.startswith("region=DC")} & set(after)
    assert {(r.region, r.v): r["count"] for r in spark.read.parquet(path).groupBy("region", "v").count().collect()} == {("DC", 2): 1667, ("NY", 1): 1667, ("VA", 1): 1666}
    with pytest.raises(ValueError, match="MD"):
        publish.publish_regions(df, path, ["MD", "DC"])
    assert seen(path) == after


def test_all_layers_and_their_manifest_in_one_run(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 2 == 0, "DC").otherwise("NY").alias("region"), (F.col("id") / 1000).alias("lat"), (F.col("id") / 500).alias("lng"))
    path = str(tmp_path / "all")
    found = publish.publish_layers({"core": df.where("id < '5'"), "places": df, "status": df.select("id", "region")}, path, "ODbL-1.0")
    totals = {r.layer: r.n for r in found.groupBy("layer").agg(F.sum("rows").alias("n")).collect()}
    assert totals == {"core": df.where("id < '5'").count(), "places": 2000, "status": 2000}
    written = [json.loads(x) for d, _, fs in os.walk(f"{path}/manifest") for f in fs if f.endswith(".json") for x in open(f"{d}/{f}")]
    assert len(written) == found.count() and {w["region"] for w in written} == {"DC", "NY"}
    ids = [r.id for r in spark.read.parquet(f"{path}/status/region=DC").collect()]
    assert len(ids) == 1000
