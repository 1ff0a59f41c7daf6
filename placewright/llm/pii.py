"""Information-theoretic sanitisation of personal data.

Emails, IP addresses, card and phone numbers are found by pattern; each value is a protected entity. How strongly a term
reveals an entity is estimated from the whole corpus: with p over different texts, term t discloses entity e when
PMI(e; t) = log(p(e, t) / (p(e) p(t))) reaches IC(e) / alpha, IC(e) = -log p(e) being all there is to know about e. Terms
count as met with e inside ``window`` words around a mention. No entity is too rare: for one that a single text has, the
terms are those around it that hardly any other text has. p(e | t) is smoothed by ``prior`` texts that have e at its
corpus rate, so that one meeting in a small corpus is not taken for certainty. Disclosing terms become spans of kind ``term`` wherever they stand and are removed, or generalised to
their kind of word, like the base spans."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import hinted, saved, small
from ._words import ALNUM, mix, slices, words

KINDS = ("email", "ip", "card", "phone", "term")
#: Disclosing terms sent out at once; more are marked block by block.
TERMS = 2_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: An e-mail is found at its "@", a number at its first digit: the same matches as of the whole pattern, in linear time.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of a text's emails, IPs, cards and phones, by kind, then start."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        stop = 0
        for m in _AT.finditer(text):
            at = first = m.start()
            while first > stop and text[first - 1] in _LOCAL_CHARS:
                first -= 1
            if first < at:
                out.append((0, first, m.end()))
                stop = m.end()
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def _terms(text: str) -> tuple[list[str], list[int], list[int]]:
    """(lower-cased words, starts, ends)."""
    found = [(m.group(), m.start(), m.end()) for m in WORD.finditer(text)]
    return [w.lower() if w.isascii() else w for w, _, _ in found], [s for _, s, _ in found], [e for _, _, e in found]


def _hash(values: list[str]) -> np.ndarray:
    h, bounds = words(pa.array(values, pa.string()), np.ones(256, bool))
    out = np.zeros(len(values), np.uint64)
    out[np.diff(bounds) > 0] = h
    return out.astype(np.int64)


def mentions(docs: DataFrame, window: int, text: str = "text") -> DataFrame:
    """(entity, term, text_key): each entity with the words within ``window`` words of it, once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8_000_000):
            rows: set[tuple[str, str, int]] = set()
            for t, key in zip(b.column("text").to_pylist(), b.column("text_key").to_pylist()):
                spans = base_spans(t) if t else []
                if not spans:
                    continue
                bare = _blanked(t, spans)
                for k, first, last in spans:
                    value = f"{KINDS[k]}:{t[first:last].lower()}"
                    # the words around: cut a stretch that surely holds them, longer where words are
                    left, right = _around(bare, first, last, window)
                    rows.add((value, "", key))
                    rows.update((value, w, key) for w in left + right)
            rows_ = list(rows)
            cols = [pa.array(_hash([r[0] for r in rows_])), pa.array(_hash([r[1] for r in rows_])), pa.array([r[2] for r in rows_], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["entity", "term", "text_key"])

    rows = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_key"))
    return rows.mapInArrow(run, "entity long, term long, text_key long")


def _blanked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans as spaces: parts of one entity are no terms of another."""
    out, at = [], 0
    for _, first, last in sorted(spans, key=lambda s: s[1]):
        if last > at:
            out += [text[at:first], " " * (last - max(at, first))]
            at = last
    return "".join([*out, text[at:]])


def _around(text: str, first: int, last: int, window: int) -> tuple[list[str], list[str]]:
    """Up to ``window`` words on either side of a span, words of digits only left out."""
    reach = 16 * window
    while True:
        left, lefts, _ = _terms(text[max(0, first - reach) : first])
        if len(left) > window or first <= reach:
            break
        reach *= 4
    reach = 16 * window
    while True:
        right = _terms(text[last : last + reach])[0]
        if len(right) > window or last + reach >= len(text):
            break
        reach *= 4
    own = lambda ws: [w for w in ws if not w.isdigit()]
    return own(left[-window:]), own(right[:window])


def counted(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """(rows with text and in how many rows that text stands: text, copies; the number of different texts). The copied
    texts' keys go to the rows if they are few, else both are shuffled."""
    rows = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_key")).where(F.octet_length("text") > 0)
    copies = saved(rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies")), "pii-copies")
    more = hinted(copies.where(F.col("copies") > 1))
    return rows.join(more, "text_key", "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies")), copies.count()


def term_frequencies(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n) for the given terms: in how many different texts each occurs, from rows as of counted(). A text with c
    copies meets a term in c rows, so rows are summed by (term, copies) and divided by the copies. The terms go to the
    rows if they are few; else all words are counted."""
    wanted = np.sort(np.array([r["term"] for r in terms.toArrow().to_pylist()], np.int64).astype(np.uint64)) if small(terms, TERMS) else None

    def flush(keys: np.ndarray, copies: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(copies), pa.array(n)], ["term", "copies", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in slices(batches, "text", 4_000_000):
            h, bounds = words(b.column("text"), ALNUM)
            doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
            if wanted is not None:
                ok = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h if len(wanted) else np.zeros(len(h), bool)
                h, doc = h[ok], doc[ok]
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, c = h[first], b.column("copies").to_numpy()[doc[first]]
            for k in np.unique(c):
                own, n = np.unique(h[c == k], return_counts=True)
                old = held.get(int(k), (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                keys, at = np.unique(np.concatenate([old[0], own]), return_inverse=True)
                held[int(k)] = keys, np.bincount(at, np.concatenate([old[1], n])).astype(np.int64)
            if sum(len(x) for x, _ in held.values()) > 1_000_000:
                yield from (flush(x, np.full(len(x), k, np.int64), n) for k, (x, n) in held.items())
                held = {}
        yield from (flush(x, np.full(len(x), k, np.int64), n) for k, (x, n) in held.items())

    found = rows.mapInArrow(run, "term long, copies long, n long").groupBy("term", "copies").agg(F.sum("n").alias("n"))
    found = found.groupBy("term").agg(F.sum((F.col("n") / F.col("copies")).cast("long")).alias("n"))
    return found if wanted is not None else found.join(terms, "term", "left_semi")


def disclosing_terms(docs: DataFrame, alpha: float = 1.5, prior: float = 1.0, window: int = 10, text: str = "text") -> DataFrame:
    """(term, bits, entities): hashes of the terms that disclose some entity, with the strongest PMI in bits.

    All probabilities are over different texts, at every size: copies of a text count once. Words of digits and the entities' own parts are no terms."""
    met = saved(mentions(docs, window, text), "pii-mentions")
    pairs = saved(met.groupBy("entity", "term").agg(F.count_distinct("text_key").alias("both")), "pii-pairs")
    entities = pairs.where("term = 0").select("entity", F.col("both").alias("n_entity"))
    pairs = pairs.where("term <> 0")
    rows, n_texts = counted(docs, text)
    # PMI >= IC / alpha  <=>  p(e | t) >= p(e) ** (1 - 1 / alpha)
    some = pairs.join(entities, "entity").withColumn("rate", F.col("n_entity") / F.lit(float(max(n_texts, 1))))
    counts = term_frequencies(rows, saved(some.select("term").distinct(), "pii-terms"))
    given = (F.col("both") + F.lit(float(prior)) * F.col("rate")) / (F.col("n") + F.lit(float(prior)))
    strong = some.join(counts, "term").withColumn("given", given).where(F.col("given") >= F.pow("rate", F.lit(1 - 1 / alpha)))
    bits = F.log2(F.col("given") / F.col("rate"))
    return strong.groupBy("term").agg(F.max(bits).alias("bits"), F.count(F.lit(1)).alias("entities"))


def generalised(word: str) -> str:
    """What stands for a disclosing term: its kind of word."""
    if any(c.isdigit() for c in word):
        return "[CODE]"
    return "[NAME]" if word[:1].isupper() else "[TERM]"


def sanitised(text: str, spans: list[tuple[int, int, int]], remove: bool) -> str:
    """The text with its spans (which may overlap) removed or replaced by their kinds."""
    out, at = [], 0
    for k, first, last in sorted(spans, key=lambda s: (s[1], -s[2])):
        if first >= at:
            out.append(text[at:first])
            out.append("" if remove else generalised(text[first:last]) if k == 4 else f"[{KINDS[k].upper()}]")
        at = max(at, last)
    return "".join([*out, text[at:]])


def marked(docs: DataFrame, terms: DataFrame, text: str, doc_id: str, remove: bool, block: int = TERMS) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()
    n = terms.count()
    parts = max(1, -(-n // block))
    if parts > 1:
        docs = saved(docs.select(doc_id, text).withColumn("_row", F.monotonically_increasing_id()), "pii-docs")
    wanted_blocks = [terms if parts == 1 else terms.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == i) for i in range(parts)]
    shape = f"doc_id {kind}, spans array<struct<kind:int,start:int,stop:int>>, text string"
    out = None
    for own in wanted_blocks:
        wanted = np.sort(np.array([r["term"] for r in own.select("term").toArrow().to_pylist()], np.int64).astype(np.uint64))

        def run(batches, wanted=wanted):
            for b in slices(batches, "text", 4_000_000):
                texts = b.column("text").to_pylist()
                hits: dict[int, set[int]] = {}
                if len(wanted):
                    h, bounds = words(b.column("text"), ALNUM)
                    ok = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h) if len(h) else []
                    for i in ok:
                        row = int(np.searchsorted(bounds, i, "right")) - 1
                        hits.setdefault(row, set()).add(int(i - bounds[row]))
                found = []
                for i, t in enumerate(texts):
                    spans = base_spans(t) if t else []
                    if i in hits:
                        _, starts, ends = _terms(t)
                        spans = spans + [(4, starts[k], ends[k]) for k in sorted(hits[i])]
                    found.append(spans)
                clean = [t if t is None or parts > 1 else sanitised(t, s, remove) if s else t for t, s in zip(texts, found)]
                flat = [x for s in found for x in s]
                structs = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.int32()) for k in range(3)], ["kind", "start", "stop"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)), structs)
                cols = {"doc_id": b.column("doc_id"), "spans": lists, "text": pa.array(clean, pa.string())}
                if parts > 1:
                    cols["_row"] = b.column("_row")
                yield pa.RecordBatch.from_pydict(cols)

        rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *["_row"] * (parts > 1))
        part = rows.mapInArrow(run, shape + ", _row long" * (parts > 1))
        part = saved(part, "pii-marked") if parts > 1 else part
        out = part if out is None else out.unionByName(part)
    if parts == 1:
        return out
    all_spans = out.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    texts = docs.select("_row", F.col(text).alias("text"))

    def finish(batches):
        for b in batches:
            spans = [[(s["kind"], s["start"], s["stop"]) for s in x] for x in b.column("spans").to_pylist()]
            clean = [t if t is None else sanitised(t, s, remove) for t, s in zip(b.column("text").to_pylist(), spans)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("spans"), pa.array(clean, pa.string())], ["doc_id", "spans", "text"])

    return all_spans.join(texts, "_row").select("doc_id", F.array_sort("spans").alias("spans"), "text").mapInArrow(finish, shape)


def sanitise(docs: DataFrame, alpha: float = 1.5, prior: float = 1.0, window: int = 10, remove: bool = False, text: str = "text", doc_id: str = "doc_id", block: int = TERMS) -> DataFrame:
    """One row a row of ``docs``: doc_id, spans (kind number in KINDS, start, stop in code points, by kind and start) and
    the sanitised text. Null texts have no spans and stay null; null and repeated doc_ids and repeated rows have a row
    each; extra columns are ignored; no rows give no rows."""
    terms = saved(disclosing_terms(docs, alpha, prior, window, text), "pii-disclosing")
    return marked(docs, terms, text, doc_id, remove, block)


def span_report(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans (kind:start:end, comma-joined)."""
    named = F.transform("spans", lambda s: F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] < 4), lambda s: F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(5)], F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.array_join(named, ",").alias("spans"))
