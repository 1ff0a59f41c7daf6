"""Near duplicates by SimHash, joined on a grid of segment bit counts.

A fingerprint's 64 bits are cut into segments and each counted: the counts are a point, and two fingerprints differ in at
least as many bits as their points are apart by the Manhattan distance. Points at most two apart have a point between
them at most one from each, so that every fingerprint is dealt to the grid cells within one of its point and those that
link meet in a cell; there their bits decide. Cells with more than ``CROWD`` fingerprints pair nothing: theirs are dealt
again over segments of one bit, where all that meet in a cell link, and each is linked with the first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import hinted, saved
from ._words import LOWER, NON_SPACE, give_back, slices, text_bytes
from .graph import components

SEED = 42
WIDTH = 4
CROWD = 48
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def shingle_bounds(column: pa.Array, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begins, ends, counts): each row's words, lower-cased and one space apart, where each shingle of ``size``
    words lies in them, and the number of shingles of each row. Fewer words make one shingle, none none."""
    data, offsets = text_bytes(column)
    low = LOWER[data]
    inside = NON_SPACE[low]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts &= inside
    ends[offsets[1:][offsets[1:] > 0] - 1] = True
    ends &= inside
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    length = end - begin
    first = np.cumsum(length) - length + np.arange(len(length))
    spaced = np.full(int(length.sum()) + len(length), 32, np.uint8)
    spaced[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = low[inside]
    at = np.searchsorted(begin, offsets)
    words = np.diff(at)
    counts = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    made = np.repeat(at[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    last = made + np.repeat(np.where(words >= size, size, words), counts) - 1
    return spaced.tobytes(), first[made], first[last] + length[last] if len(made) else made, counts


def fingerprint_column(column: pa.Array, size: int = 3) -> np.ndarray:
    """The fingerprints of an Arrow string column: a bit is 1 if over half of the shingles' hashes have it."""
    data, begins, ends, counts = shingle_bounds(column, size)
    sums, edges = np.zeros((len(counts), 64), np.int64), np.concatenate([[0], np.cumsum(counts)])
    for at in range(0, len(begins), BLOCK):
        upto = min(at + BLOCK, len(begins))
        hashes = np.fromiter((xxhash.xxh64_intdigest(data[b:e], SEED) for b, e in zip(begins[at:upto].tolist(), ends[at:upto].tolist())), "<u8", upto - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = np.flatnonzero((counts > 0) & (edges[:-1] < upto) & (edges[1:] > at))
        sums[rows] += np.add.reduceat(bits, np.maximum(edges[rows] - at, 0), axis=0, dtype=np.int64)
    return np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 3) -> DataFrame:
    """(doc_id, fp): every row's fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fingerprint_column(b.column("text"), size))], ["doc_id", "fp"])
        give_back()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def cells(fp: Column, width: int) -> Column:
    """The numbers of the grid cells within one of the fingerprint's point, for segments of ``width`` bits."""
    if width == 1:  # a segment's count is its bit, and a step turns it
        return F.array(fp, *[fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    seg = [F.bit_count(F.shiftrightunsigned(fp, i).bitwiseAND(F.lit((1 << width) - 1))).cast("long") for i in range(0, 64, width)]
    unit = [(width + 1) ** i for i in range(len(seg))]
    here = sum((s * u for s, u in zip(seg, unit)), F.lit(0).cast("long"))
    up = [F.when(s < width, here + u) for s, u in zip(seg, unit)]
    down = [F.when(s > 0, here - u) for s, u in zip(seg, unit)]
    return F.array_compact(F.array(here, *up, *down))


def _within(crowd: int | None, distance: int):
    """Links among the rows of each cell, sorted by (cell, fp): by bits, or with the cell's first where ``crowd`` is None.
    A row (fp, null) tells of a fingerprint in a cell of more than ``crowd``."""

    def pairs(cell: np.ndarray, fp: np.ndarray):
        edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        size = np.diff(np.concatenate([edge, [len(cell)]]))
        of = np.repeat(size, size)
        full = of > crowd
        yield fp[full], None
        for step in range(1, int(min(size.max(initial=0), crowd))):
            i = np.flatnonzero((cell[step:] == cell[:-step]) & ~full[step:])
            if len(i):
                i = i[np.bitwise_count((fp[i] ^ fp[i + step]).view(np.uint64)) <= distance]
                yield fp[i], fp[i + step]

    def made(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)], ["a", "b"])

    def by_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last cell of a batch is kept for the next; of one already over ``crowd``, ``crowd`` + 1 rows."""
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            cell, fp = np.concatenate([cell, b.column("cell").to_numpy()]), np.concatenate([fp, b.column("fp").to_numpy()])
            if not len(cell):
                continue
            at = int(np.searchsorted(cell, cell[-1]))
            yield from (made(*x) for x in pairs(cell[:at], fp[:at]) if len(x[0]))
            cell, fp = cell[at:], fp[at:]
            if len(cell) > 2 * crowd + 1:
                yield made(fp[: -crowd - 1], None)
                cell, fp = cell[-crowd - 1 :], fp[-crowd - 1 :]
        yield from (made(*x) for x in pairs(cell, fp) if len(x[0]))

    def with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_cell, first = None, None
        for b in batches:
            cell, fp = b.column("cell").to_numpy(), b.column("fp").to_numpy()
            if not len(cell):
                continue
            edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            lead = fp[edge].copy()
            if cell[0] == last_cell:
                lead[0] = first
            lead = np.repeat(lead, np.diff(np.concatenate([edge, [len(cell)]])))
            last_cell, first = cell[-1], lead[-1]
            yield made(lead[lead != fp], fp[lead != fp])

    return with_first if crowd is None else by_bits


def links(fps: DataFrame, distance: int = 2, width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fps`` (fp) at most ``distance`` (up to two) bits apart, in number and
    choice enough to connect all that link. ``fps`` is read twice at most: give a written table."""
    if distance > 2:
        raise ValueError("cells are those within one of a point: two bits at most")
    dealt = lambda df, w: df.select(F.explode(cells(F.col("fp"), w)).alias("cell"), "fp").repartition("cell").sortWithinPartitions("cell", "fp")
    found = saved(dealt(fps, width).mapInArrow(_within(crowd, distance), "a long, b long"), "cell-links")
    near = found.where("b is not null")
    if distance == 2:
        again = found.where("b is null").select(F.col("a").alias("fp")).distinct()
        near = near.unionByName(dealt(again, 1).mapInArrow(_within(None, distance), "a long, b long"))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 3, width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """One row a row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Rows link when their fingerprints differ in at most two bits; component_id is the smallest doc_id reachable, the row's
    own included (null where no row reached has one). Null, empty and blank texts have the fingerprint zero and link like
    any other. Equal fingerprints are one from the start, so that copies, however many, are joined once. Texts are read
    whole, in blocks of shingles. Repeated rows have a row each, extra columns are ignored, no rows give no rows."""
    rows = saved(fingerprints(docs, text, doc_id, size), "fingerprints")
    fps = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), 2, width, crowd))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = saved(rooted, "rooted")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "components")
    return rows.join(hinted(named), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component, with their columns; rows without a doc_id stay."""
    out = near_duplicates(docs, text, doc_id, size)
    lost = out.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_lost")).distinct()
    return docs.join(lost, F.col(doc_id) == F.col("_lost"), "left_anti")
