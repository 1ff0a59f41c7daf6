"""Document lengths from flat, unindexed token files: a vectorised scan for the end-of-document id, block by block, and
a prefix scan that stitches the documents that cross blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._tokens import Encoder, text_slices


def separator(tokenizer: str) -> int:
    """The id after the vocabulary's last one, which must fit the width that its ids are stored in."""
    coder = Encoder.load(tokenizer)
    end = max(coder.whole.get_vocab(with_added_tokens=True).values()) + 1
    if end > np.iinfo(coder.dtype).max:
        raise ValueError("the vocabulary leaves no id for the end of a document")
    return end


def flat_files(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end: int | None = None, block: int = 1 << 18, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Token files as rows (file, block, data, doc_ids): a file a partition, cut every ``block`` ids wherever that falls.

    ``data`` holds little-endian unsigned 16- or 32-bit ids, each document's followed by ``end`` (default: the id after the
    vocabulary's last, which no text holds). doc_ids names the
    documents whose ``end`` lies in the block, in order: a label for reading results, not an index (no positions).
    Where an ``end`` of the vocabulary is asked for, a text that holds it is an error: it would count as several."""
    end = separator(tokenizer) if end is None else end
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, number = Encoder.load(tokenizer), 0, 0
        held, labels, ends = np.zeros(0, coder.dtype), None, np.zeros(0, np.int64)

        def cut(n: int) -> pa.RecordBatch:
            nonlocal held, labels, ends, number
            here = int(np.searchsorted(ends, n, "right"))
            own, labels, ends = labels[:here], labels[here:], ends[here:] - n
            names = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            row = [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([held[:n].tobytes()], pa.binary()), names]
            held, number = held[n:], number + 1
            return pa.RecordBatch.from_arrays(row, ["file", "block", "data", "doc_ids"])

        for b in text_slices(batches, "text"):
            ids, bounds = coder.encode(b.column("text"))
            if (ids == end).any():
                raise ValueError(f"a text holds the end id {end}")
            ids, bounds = np.insert(ids, bounds[1:], end), bounds + np.arange(len(bounds))
            part = b.column("part")[0].as_py()
            ends = np.concatenate([ends, len(held) + bounds[1:]])
            held = np.concatenate([held, ids])
            labels = b.column("doc_id") if labels is None or not len(labels) else pa.concat_arrays([labels, b.column("doc_id")])
            while len(held) >= block:
                yield cut(block)
        if len(held):
            yield cut(len(held))

    rows = docs.select(F.spark_partition_id().alias("part"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"file int, block long, data binary, doc_ids array<{kind}>")


def scan(files: DataFrame, end: int, width: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """(file, block, data) rows -> (file, block, place, start, n_tokens): every document's position in its file and its
    ids without the end id; ``place`` counts the ends in the block from 0.

    Blocks may have any length, also none. Ids after a file's last end are a document without end: it is returned with a
    null ``place`` (block: the file's last one). ``keep`` names columns of ``files`` to carry along."""
    extra = [(c, files.schema[c].dataType.simpleString()) for c in keep]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [np.frombuffer(x or b"", "<u2" if width == 2 else "<u4") for x in b.column("data").to_pylist()]
            found = [np.flatnonzero(x == end) for x in data]
            at = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)), pa.array(np.concatenate(found).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array([len(x) for x in data], pa.int64()), at, *[b.column(c) for c in keep]], ["file", "block", "size", "at", *keep])

    blocks = files.select("file", "block", "data", *keep).mapInArrow(look, "file int, block long, size long, at array<long>" + "".join(f", {c} {t}" for c, t in extra))
    # Prefix scan over a file's blocks: one short row a block.
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    last = F.when(F.size("at") > 0, F.col("base") + F.element_at("at", -1) + 1)
    blocks = blocks.withColumn("_last", last).withColumn("open", F.coalesce(F.max("_last").over(earlier), F.lit(0)))
    later = W.partitionBy("file").orderBy("block").rowsBetween(1, W.unboundedFollowing)
    blocks = blocks.withColumn("tail", F.when(F.count("block").over(later) == 0, F.col("base") + F.col("size") - F.greatest("open", F.coalesce("_last", F.lit(0)))))
    ends = F.transform("at", lambda x, i: F.struct(i.alias("place"), F.when(i == 0, F.col("open")).otherwise(F.col("base") + F.get("at", i - 1) + 1).alias("start"), (x + F.col("base")).alias("stop")))
    rest = F.when(F.col("tail") > 0, F.array(F.struct(F.lit(None).cast("int").alias("place"), (F.col("base") + F.col("size") - F.col("tail")).alias("start"), (F.col("base") + F.col("size")).alias("stop"))))
    found = blocks.select("file", "block", *keep, F.explode(F.concat(ends, F.coalesce(rest, F.array().cast("array<struct<place:int,start:long,stop:long>>")))).alias("d"))
    return found.select("file", "block", F.col("d.place").alias("place"), F.col("d.start").alias("start"), (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), *keep)


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end: int | None = None, block: int = 1 << 18, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_tokens (without the end id), file, start; by writing flat files and scanning
    them. Null and empty texts have no ids; null and repeated doc_ids and repeated rows have a row each; a
    very long text is cut over many blocks; no rows give no rows; extra columns are ignored."""
    from ._io import saved

    end = separator(tokenizer) if end is None else end
    files = saved(flat_files(docs, tokenizer, end, block, text, doc_id), "token-files")
    width = 4 if Encoder.load(tokenizer).code == "I" else 2
    found = scan(files, end, width, keep=("doc_ids",))
    return found.select(F.get("doc_ids", F.col("place")).alias("doc_id"), "n_tokens", "file", "start")
