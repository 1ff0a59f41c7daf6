"""The pipeline against a brute-force run of its stages, columns of any name, and words that weak hashes take for one."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from placewright.llm import _words, decontam, exact_dedup, jaccard, line_dedup, quality
from tests.llm.test_dedup import bench, brute_components, brute_contamination, low  # noqa: F401


@pytest.fixture
def tables(spark, awkward, bench, tmp_path):  # noqa: F811
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1 if i % 5 else 0, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_equals_its_stages_by_brute_force(spark, tables, bench):  # noqa: F811
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = quality.drop_low_quality(docs, spark.read.parquet(f"{tables}/labels.parquet")).collect()
    # of equal texts the largest id (null ids: any one row)
    groups = defaultdict(list)
    for r in rows:
        groups[low(r.text or "")].append(r)
    rows = [max(g, key=lambda r: -1 if r.doc_id is None else r.doc_id) for g in groups.values()]
    # of similar texts the smallest id
    components = dict((a, c) for a, _, c in brute_components(rows, 5, 4, 5))
    empty = {str(r.doc_id) for r in rows if not (r.text or "").split()}
    rows = [r for r in rows if components[str(r.doc_id)] == str(r.doc_id) or str(r.doc_id) in empty]
    bad = {x[0] for x in brute_contamination(rows, bench.collect()) if x[5]}
    want = Counter(str(r.doc_id) for r in rows if str(r.doc_id) not in bad)
    assert bad and want
    got = corpus_pipeline.run(spark, tables).collect()
    assert Counter(str(r.doc_id) for r in got if r.start == 0) == want
    cover, windows = defaultdict(int), defaultdict(int)
    for r in got:
        cover[str(r.doc_id)] += r.length
        windows[r.sequence_id] += r.length
    assert all(cover[str(r.doc_id)] == r.doc_tokens for r in got)
    assert all(windows[i] == 2048 for i in range(len(windows) - 1))


NAMES = "row id key d of like at text_key bad _bad _d _digest _keep _host _lines _deal _salt _kept _text _id _key _symbols _perplexity _threshold _l _t _good doc c0 c1 sig c a b part host line".split()


def test_columns_of_any_name_pass_through(spark, awkward, bench, tables):  # noqa: F811
    from pyspark.sql import functions as F

    docs = awkward.select("doc_id", "text", "lang", "source", *[F.lit(f"kept {n}").alias(n) for n in NAMES])
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    for out in (exact_dedup.drop_exact_duplicates(docs), jaccard.drop_near_duplicates(docs), decontam.drop_contaminated(docs, bench), quality.drop_low_quality(docs, labels), line_dedup.drop_boilerplate(docs)):
        assert out.columns[: len(docs.columns)] == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"kept {n}" for r in rows for n in NAMES)


def test_words_that_polynomial_hashes_confuse_differ():
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    h, _ = _words.words(pa.array([f"{word} {other} {word.upper()}"]), _words.NON_SPACE)
    assert len(np.unique(h)) == 2 and h[0] == h[2]
