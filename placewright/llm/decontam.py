"""Benchmark decontamination by a distributed positional inverted index.

The index is kept by document, as search engines shard it: a row is a segment (whole documents of about ``SEGMENT``
words) with its sorted terms, the positions of each, and where its documents begin. A query phrase is answered in every
segment: phrases with a term that the segment lacks fall away, the others intersect their terms' position lists,
each moved back by the term's place in the phrase, from the rarest term to the commonest. Segments hold the postings of
all words of all texts; what is sent to them is the benchmark's phrases, in blocks of bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import saved
from ._words import ALNUM, slices, words

SEGMENT = 1_000_000
#: Phrases sent out at once; more are answered block by block.
PHRASES = 500_000


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", segment_bytes: int = 4_000_000) -> DataFrame:
    """Rows (doc_ids, begins, terms, lists, positions): begins are the documents' first word positions in the segment
    (one more at the end), lists the terms' first places in ``positions``; the last three are packed as little-endian
    64- and 32-bit numbers. A text is never cut, so that a very long one makes a larger segment."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", segment_bytes):
            h, bounds = words(b.column("text"), ALNUM)
            order = np.argsort(h, kind="stable").astype(np.uint32)
            s = h[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
            one = pa.array([0, b.num_rows], pa.int32())
            cols = [
                pa.ListArray.from_arrays(one, b.column("doc_id")),
                pa.ListArray.from_arrays(pa.array([0, len(bounds)], pa.int32()), pa.array(bounds.astype(np.int64))),
                *[pa.array([x.tobytes()], pa.binary()) for x in (s[first], np.append(first, len(s)).astype("<u4"), order)],
            ]
            yield pa.RecordBatch.from_arrays(cols, ["doc_ids", "begins", "terms", "lists", "positions"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_ids array<{kind}>, begins array<long>, terms binary, lists binary, positions binary")


def phrases(benchmark: DataFrame, window: int = 13, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(terms, n, items): each different run of ``window`` words (all words of a shorter item) as packed 64-bit term
    hashes, and the items that have it. Items without words have none; a null item_id is the string ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, bounds = words(b.column("text"), ALNUM)
            out, of = [], []
            for i in range(b.num_rows):
                own = h[bounds[i] : bounds[i + 1]].astype("<u8")
                for k in range(max(1, len(own) - window + 1) if len(own) else 0):
                    out.append(own[k : k + window].tobytes())
                    of.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), b.column("item").take(pa.array(of, pa.int64()))], ["terms", "item"])

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, "terms binary, item string").groupBy("terms").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return found.withColumn("n", (F.octet_length("terms") / 8).cast("int"))


class Segment:
    """A segment's lists, opened."""

    def __init__(self, terms: bytes, lists: bytes, positions: bytes, begins: list[int]):
        self.terms, self.lists, self.positions = np.frombuffer(terms, "<u8"), np.frombuffer(lists, "<u4"), np.frombuffer(positions, "<u4")
        self.begins = np.asarray(begins, np.int64)

    def postings(self, t: int) -> np.ndarray:
        return self.positions[self.lists[t] : self.lists[t + 1]].astype(np.int64)

    def look_up(self, terms: np.ndarray) -> np.ndarray:
        """The terms' numbers here, -1 for those the segment lacks."""
        if not len(self.terms):
            return np.full(terms.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, position, "right") - 1

    def exact(self, numbers: np.ndarray) -> np.ndarray:
        """Positions at which the phrase begins, inside one document."""
        size = self.lists[numbers + 1] - self.lists[numbers]
        rank = np.argsort(size, kind="stable")
        at = self.postings(numbers[rank[0]]) - rank[0]
        for k in rank[1:]:
            if not len(at):
                break
            own = self.postings(numbers[k])
            place = np.minimum(np.searchsorted(own, at + k), len(own) - 1)
            at = at[own[place] == at + k]
        at = at[at >= 0]
        return at[self.document(at) == self.document(at + len(numbers) - 1)] if len(at) else at

    def near(self, numbers: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) positions of the phrase's words in their order with at most ``slop`` other words between, for
        each place where it can begin; the shortest span of each."""
        begin = last = self.postings(numbers[0])
        for t in numbers[1:]:
            own = self.postings(t)
            at = np.searchsorted(own, last, "right")
            ok = at < len(own)
            begin, last = begin[ok], own[at[ok]]
            ok = last - begin < len(numbers) + slop
            begin, last = begin[ok], last[ok]
        ok = self.document(begin) == self.document(last)
        return begin[ok], last[ok]


def _blocks(queries: DataFrame, most: int) -> Iterator[tuple[list[np.ndarray], list[list[str]]]]:
    """The phrases in blocks of at most ``most``; the iterator keeps one block on the driver at a time."""
    n = queries.count()
    parts = max(1, -(-n // most))
    for k in range(parts):
        own = queries if parts == 1 else queries.where(F.pmod(F.xxhash64("terms"), F.lit(parts)) == k)
        rows = own.select("terms", "items").toArrow()
        yield [np.frombuffer(x, "<u8") for x in rows["terms"].to_pylist()], rows["items"].to_pylist()


def _found(seg: Segment, by_length: list, slop: int | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(phrase, first, last) of those with matches."""
    for numbers, table in by_length:
        at = seg.look_up(table)
        for k in np.flatnonzero((at >= 0).all(1)):
            if slop is None:
                first = seg.exact(at[k])
                last = first + table.shape[1] - 1
            else:
                first, last = seg.near(at[k], slop)
            if len(first):
                yield numbers[k], first, last


def _by_length(terms: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(t) for t in terms], np.int64)
    return [(np.flatnonzero(sizes == n), np.stack([terms[i] for i in np.flatnonzero(sizes == n)])) for n in np.unique(sizes)]


def search(index: DataFrame, queries: DataFrame, slop: int | None = None, block: int = PHRASES) -> DataFrame:
    """(doc_id, item_id, start, length): every occurrence of every phrase of ``queries``, exact or, with ``slop``, in
    order with at most so many other words between; start counts the document's words from 0."""
    kind = index.schema["doc_ids"].dataType.elementType
    out = None
    for terms, items in _blocks(queries, block):
        by_length = _by_length(terms)

        def run(batches, by_length=by_length, items=items):
            for b in batches:
                for row in b.to_pylist():
                    seg = Segment(row["terms"], row["lists"], row["positions"], row["begins"])
                    hits = [(i, f, n) for p, first, last in _found(seg, by_length, slop) for f, n in zip(first, last - first + 1) for i in items[p]]
                    if hits:
                        doc = seg.document(np.array([h[1] for h in hits]))
                        ids = b.schema.field("doc_ids").type.value_type
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["doc_ids"][d] for d in doc], ids), pa.array([h[0] for h in hits]), pa.array([int(h[1] - seg.begins[d]) for h, d in zip(hits, doc)]), pa.array([int(h[2]) for h in hits])],
                            ["doc_id", "item_id", "start", "length"],
                        )

        part = index.mapInArrow(run, f"doc_id {kind.simpleString()}, item_id string, start long, length long")
        out = part if out is None else out.unionByName(part)
    return out.distinct() if slop is not None else out


def contamination(index: DataFrame, queries: DataFrame, share: tuple[int, int] = (1, 20), block: int = PHRASES) -> DataFrame:
    """One row a document of the index: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a phrase is hit; a document is contaminated when words are hit and these are at least
    share[0]/share[1] of its words. Repeated doc_ids have a row each if the phrases fit one block; with more blocks rows
    are put together by (segment, place), so that they stay apart, too."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    parts = []
    several = queries.count() > block
    if several:
        index = saved(index.withColumn("segment", F.monotonically_increasing_id()), "index-numbered")
    for terms, items in _blocks(queries, block):
        by_length = _by_length(terms)

        def run(batches, by_length=by_length, items=items):
            for b in batches:
                for i, row in enumerate(b.to_pylist()):
                    seg = Segment(row["terms"], row["lists"], row["positions"], row["begins"])
                    n_docs, total = len(row["doc_ids"]), int(seg.begins[-1])
                    edge = np.zeros(total + 1, np.int64)
                    named: dict[int, set[str]] = {}
                    for p, first, last in _found(seg, by_length, None):
                        np.add.at(edge, first, 1)
                        np.add.at(edge, last + 1, -1)
                        for d in np.unique(seg.document(first)):
                            named.setdefault(int(d), set()).update(items[p])
                    hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
                    spans = np.flatnonzero(np.diff(np.concatenate([[0], (np.diff(hit) > 0).astype(np.int8), [0]])))
                    cols = {
                        "doc_id": b.column("doc_ids").slice(i, 1).flatten(), "place": pa.array(np.arange(n_docs), pa.int64()), "n_words": pa.array(np.diff(seg.begins)),
                        "n_hit": pa.array(hit[seg.begins[1:]] - hit[seg.begins[:-1]]), "items": pa.array([sorted(named.get(d, ())) for d in range(n_docs)], pa.list_(pa.string())),
                        "spans": _spans(spans, seg, n_docs),
                    }
                    if "segment" in b.schema.names:
                        cols["segment"] = pa.array([row["segment"]] * n_docs, pa.int64())
                    yield pa.RecordBatch.from_pydict(cols)

        shape = f"doc_id {kind}, place long, n_words long, n_hit long, items array<string>, spans array<long>"
        part = index.mapInArrow(run, shape + ", segment long" * several)
        parts.append(saved(part, "contamination") if several else part)
    out = parts[0]
    if several:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("segment", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
        out = out.withColumn("n_hit", _covered("spans"))
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * share[1] >= F.col("n_words") * share[0])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), bad.alias("contaminated"))


def _spans(edges: np.ndarray, seg: Segment, n_docs: int) -> pa.Array:
    """Per document the hit spans as first, stop, first, stop ... (a span ends at its document's end at the latest)."""
    out: list[list[int]] = [[] for _ in range(n_docs)]
    for first, stop in zip(edges[::2], edges[1::2]):
        d = int(seg.document(np.array([first]))[0])
        while first < stop:
            end = min(stop, int(seg.begins[d + 1]))
            if end > first:
                out[d] += [int(first - seg.begins[d]), int(end - seg.begins[d])]
            first, d = end, d + 1
    return pa.array(out, pa.list_(pa.int64()))


def _covered(spans: str):
    """How many positions the spans cover: sorted, each counts from where the ones before it end."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), (F.size(spans) / 2 - 1).cast("int")), lambda i: F.struct(F.get(spans, (2 * i).cast("int")).alias("a"), F.get(spans, (2 * i + 1).cast("int")).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))
    step = lambda s, x: F.struct(F.greatest(s["end"], x["b"]).alias("end"), (s["sum"] + F.greatest(x["b"] - F.greatest(s["end"], x["a"]), F.lit(0))).alias("sum"))
    return F.when(F.size(spans) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(pairs, zero, step, lambda s: s["sum"]))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text", doc_id: str = "doc_id", block: int = PHRASES) -> DataFrame:
    """contamination() of ``docs``, over a stored index of them. Null texts have no words (and are not contaminated);
    null and repeated doc_ids have a row each; extra columns are ignored; an empty benchmark hits nothing."""
    index = saved(build_index(docs, text, doc_id), "postings")
    return contamination(index, saved(phrases(benchmark, window, text), "phrases"), block=block)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with their columns. Rows are known by their text's digest,
    on which alone the decision rests, so that repeated or null ids do no harm."""
    from ._io import hinted

    key = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    report = contamination_report(docs.select(key.alias("doc_id"), F.col(text).alias("text")), benchmark.withColumnRenamed(text, "text") if text != "text" else benchmark, window)
    bad = saved(report.where("contaminated").select(F.col("doc_id").alias("bad")).distinct(), "contaminated")
    return docs.select(F.struct("*").alias("row"), key.alias("key")).join(hinted(bad), F.col("key") == F.col("bad"), "left_anti").select("row.*")
