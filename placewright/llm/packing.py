"""Mixture-controlled packing: deficit round-robin over source queues into windows of ``seq_len`` tokens.

Each source is a queue of packets: its documents in table order, cut into packets of at most ``packet`` tokens. A round
gives every queue a quantum (its target share of one window); a packet goes out in the first round in which its queue's
quanta so far cover all the queue's tokens up to the packet's end, and what a queue did not use stays as its deficit.
That round is ceil(tokens of the queue up to the packet's end / quantum), so that no task has to replay the rounds:
deficits carry across windows and partitions through prefix sums. Packets in order of (round, queue, place in queue)
make one stream, which is cut into windows; only the last window is padded."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._io import hinted, running_total, saved
from ._tokens import Encoder, text_slices

#: The queues' table is broadcast up to so many sources, else shuffled.
QUEUES = 200_000
#: Rows of a part whose packets of one queue are summed in one task.
STRETCH = 64
PACKETS = "part int, row long, doc_id {id}, queue string, start long, n int, doc_tokens long, wide boolean, ids binary"


def packets_of(docs: DataFrame, text: str, doc_id: str, source: str, tokenizer: str, end: int, packet: int) -> DataFrame:
    """The documents' ids, cut into packets; (part, row, start) is unique, also for repeated rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, row = Encoder.load(tokenizer), 0
        for b in text_slices(batches, "text"):
            ids, bounds = coder.encode(b.column("text"), end)
            total = np.diff(bounds)
            pieces = -(-total // packet)
            of = np.repeat(np.arange(b.num_rows), pieces)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * packet
            n = np.minimum(total[of] - start, packet)
            begin = bounds[:-1][of] + start
            cuts = np.concatenate([begin, [len(ids)]]) * ids.itemsize
            data = pa.Array.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())]).cast(pa.binary())
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [b.column("part").take(take), pa.array(row + of), b.column("doc_id").take(take), b.column("queue").take(take), pa.array(start), pa.array(n.astype(np.int32)), pa.array(total[of]), pa.array(np.full(len(of), coder.code == "I")), data],
                ["part", "row", "doc_id", "queue", "start", "n", "doc_tokens", "wide", "ids"],
            )
            row += b.num_rows

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("queue"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PACKETS.format(id=kind))


def quanta(packets: DataFrame, seq_len: int, weights: dict[str, float] | None) -> DataFrame:
    """(queue, number, quantum): the queues by size, and each one's tokens a round.

    Without weights a queue's share is its share of all tokens, so that all queues end together. With them, sources
    not named share what is left of 1 by their tokens (or go last, in rounds of one token, if nothing is left)."""
    sums = packets.groupBy("queue").agg(F.sum("n").alias("tokens"))
    sums = saved(sums, "queue-sums")
    sums = sums.crossJoin(F.broadcast(sums.agg(F.sum("tokens").alias("all"))))
    share = F.col("tokens") / F.col("all")
    if weights:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        wanted = given[F.col("queue")]
        sums = sums.withColumn("wanted", wanted)
        left = F.lit(max(0.0, 1.0 - sum(weights.values())))
        others = sums.agg(F.sum(F.when(F.col("wanted").isNull(), F.col("tokens"))).alias("others"))
        sums = sums.crossJoin(F.broadcast(others))
        share = F.coalesce(F.col("wanted"), left * F.col("tokens") / F.col("others"))
    quantum = F.greatest(share * F.lit(float(seq_len)), F.lit(1e-6))
    # numbers by size: larger queues first, then the place among those of the same size
    sums = sums.withColumn("quantum", quantum).withColumn("rank", -F.col("tokens"))
    larger = running_total(sums.groupBy("rank").agg(F.count(F.lit(1)).alias("n")), "rank", "n", "larger")
    place = F.row_number().over(W.partitionBy("rank").orderBy(F.asc_nulls_first("queue")))
    return sums.withColumn("place", place).join(larger, "rank").select("queue", (F.col("larger") + F.col("place")).alias("number"), "quantum")


def plan(packets: DataFrame, seq_len: int, weights: dict[str, float] | None, block: int = 64) -> DataFrame:
    """(part, row, start, n, at): each packet's place in the stream. Works on the packets' sizes alone."""
    key = F.col("queue").eqNullSafe(F.col("_queue"))
    sized = packets.select("part", "row", "queue", "start", "n")
    queues = hinted(saved(quanta(sized, seq_len, weights).withColumnRenamed("queue", "_queue"), "queues"), QUEUES)
    sized = sized.join(queues, key).drop("queue", "_queue")
    # place in the queue: tokens in earlier parts, in the part's earlier stretches of rows, then within the stretch
    sized = sized.withColumn("stretch", F.floor(F.col("row") / STRETCH))
    by_stretch = saved(sized.groupBy("number", "part", "stretch").agg(F.sum("n").alias("sum")), "stretches")
    before = W.partitionBy("number").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    by_part = by_stretch.groupBy("number", "part").agg(F.sum("sum").alias("sum")).select("number", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("parts"))
    above = W.partitionBy("number", "part").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    by_stretch = by_stretch.withColumn("above", F.coalesce(F.sum("sum").over(above), F.lit(0))).join(by_part, ["number", "part"])
    by_stretch = by_stretch.select("number", "part", "stretch", (F.col("parts") + F.col("above")).alias("earlier"))
    inside = W.partitionBy("number", "part", "stretch").orderBy("row", "start")
    placed = sized.withColumn("upto", F.sum("n").over(inside)).join(by_stretch, ["number", "part", "stretch"]).withColumn("upto", F.col("upto") + F.col("earlier"))
    placed = placed.withColumn("round", F.greatest(F.ceil(F.col("upto") / F.col("quantum")) - 1, F.lit(0)).cast("long")).withColumn("block", F.floor(F.col("round") / block).cast("long"))
    # place in the stream: tokens in earlier blocks of rounds, then within the block
    begins = running_total(placed.groupBy("block").agg(F.sum("n").alias("sum")), "block", "sum", "begins")
    order = W.partitionBy("block").orderBy("round", "number", "upto").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.coalesce(F.sum("n").over(order), F.lit(0))).join(begins, "block")
    return placed.select("part", "row", "start", "n", (F.col("at") + F.col("begins")).alias("at"))


def pack(docs: DataFrame, seq_len: int = 2048, tokenizer: str = "word_bpe_49k.json", end: int = 1, weights: dict[str, float] | None = None, packet: int = 512, text: str = "text", doc_id: str = "doc_id", source: str = "source", with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with ``with_ids``
    its ids (array<int>). All ids of all rows lie in one piece each; sequences 0.. are full but for the last.

    Null texts are empty and give the id ``end`` alone; a null source is a queue of its own; null and repeated doc_ids
    and repeated rows are packed as rows of their own; no rows give no pieces. Extra columns are ignored."""
    packets = saved(packets_of(docs, text, doc_id, source, tokenizer, end, packet), "packets")
    placed = plan(packets, seq_len, weights)
    # a packet crosses (n - 1) / seq_len + 1 window borders at most
    windows = F.sequence(F.floor(F.col("at") / seq_len), F.floor((F.col("at") + F.col("n") - 1) / seq_len))
    pieces = placed.withColumn("sequence_id", F.explode(windows))
    skip = F.greatest(F.col("sequence_id") * seq_len - F.col("at"), F.lit(0))
    stop = F.least((F.col("sequence_id") + 1) * seq_len - F.col("at"), F.col("n"))
    pieces = pieces.select("part", "row", "start", "sequence_id", skip.cast("int").alias("skip"), (stop - skip).cast("int").alias("length"), (F.col("at") + skip - F.col("sequence_id") * seq_len).cast("long").alias("offset"))
    both = pieces.join(packets.drop("n"), ["part", "row", "start"])
    size = F.when(F.col("wide"), 4).otherwise(2)
    cut = both.select("doc_id", F.col("queue").alias("source"), (F.col("start") + F.col("skip")).alias("start"), F.col("length").cast("long").alias("length"), "doc_tokens", F.col("sequence_id").cast("long").alias("sequence_id"), "offset", "wide", F.substring(F.col("ids"), F.col("skip") * size + 1, F.col("length") * size).alias("ids"))
    kind = docs.schema[doc_id].dataType.simpleString()
    shape = f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    names = [x.strip().split(" ")[0] for x in shape.split(",")]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wide = b.column("wide").to_pylist()
            ids = [np.frombuffer(x, "<u4" if w else "<u2").astype("<u4") for x, w in zip(b.column("ids").to_pylist(), wide)]
            cols = {c: b.column(c) for c in b.schema.names} | {"ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())}
            if with_ids:
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                cols["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)

    return cut.mapInArrow(finish, shape)
