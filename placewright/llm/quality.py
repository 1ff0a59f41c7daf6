"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

Units are symbols inside space-separated pieces: each piece is its characters between a start and an end; a piece equal
to the one before it is the single symbol ``AGAIN``, so that repetition costs. Contexts do not cross pieces, hence a
piece always has one score and each different piece of a batch is scored once, whatever its number of occurrences.

Every character counts as itself. A language whose trusted texts have at most ``LETTERS`` different characters has
symbols of 6 bits: each of these, and classes of the characters that were never seen. Any other has symbols of 16 bits,
the UTF-16 units of its texts, so that no alphabet is kept: four of them are a 64-bit key, and a character beyond U+FFFF
is two symbols. The white space that parts pieces stands for start, end and repetition there.

n-gram counts are taken from all trusted documents and summed over shards of the n-gram space; joins of the counts with
their contexts' totals and with the next lower order give the probabilities. The highest order has raw counts, lower
ones count the different symbols before an n-gram. Documents are trusted by labels. Every trusted document is scored
by the model of the other half of them, which makes the thresholds: for each language and each band of lengths, a
quantile of these scores. Documents meet their language's model by a join."""

from __future__ import annotations

import math
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._io import hinted, saved
from ._tokens import text_slices
from ._words import slices

ORDER = 4
#: symbols: padding and start, end of piece, repeated piece, classes of rare characters; letters follow
START, END, AGAIN, LETTER, DIGIT, OTHER, FIRST = range(7)
BITS = 6
LETTERS = 2**BITS - FIRST
#: bits of a UTF-16 unit, and the unit that is symbol 0: a tab is in no piece, nor are the two units behind it
WIDE, SHIFT = 16, 9
#: Bytes of text that are scored together.
GROUP = 12_000_000


def _pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct pieces, codes, bounds): row i has the pieces codes[bounds[i]:bounds[i+1]]."""
    split = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    lengths = np.diff(np.asarray(split.offsets, np.int64))
    full = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    if not full.all():  # white space at a text's ends gives empty pieces
        ok = full[codes]
        bounds, codes = np.concatenate([[0], np.cumsum(ok)])[bounds], codes[ok]
    return coded.dictionary, codes, bounds


def _again(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    same = np.zeros(len(codes), bool)
    same[1:] = codes[1:] == codes[:-1]
    same[bounds[:-1][bounds[:-1] < len(codes)]] = False
    return same


def _characters(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, lengths) of the pieces."""
    points = np.frombuffer("".join(distinct.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)


def _symbols(points: np.ndarray, alphabet: list[int]) -> np.ndarray:
    """The characters' symbols: one of the alphabet's, or the class."""
    table = np.full(0x3000, OTHER, np.uint64)
    table[[c for c in range(0x3000) if chr(c).isalpha()]] = LETTER
    table[[c for c in range(0x3000) if chr(c).isdigit()]] = DIGIT
    small = [(c, i) for i, c in enumerate(alphabet) if c < 0x3000]
    table[[c for c, _ in small]] = [FIRST + i for _, i in small]
    out = np.where(points < 0x3000, table[np.minimum(points, 0x2FFF)], np.uint64(LETTER))
    for i, c in enumerate(alphabet):
        if c >= 0x3000:
            out[points == c] = FIRST + i
    return out


def _units(points: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of WIDE bits, pieces' numbers of them): the characters' UTF-16 units."""
    far = points > 0xFFFF
    units = np.repeat(points, 1 + far)
    first = np.flatnonzero(far) + np.arange(far.sum())
    units[first] = 0xD800 + ((points[far] - 0x10000) >> 10)
    units[first + 1] = 0xDC00 + ((points[far] - 0x10000) & 0x3FF)
    before = np.concatenate([[0], np.cumsum(far)])[np.concatenate([[0], np.cumsum(lengths)])]
    return (units - np.uint32(SHIFT)).astype(np.uint16).astype(np.uint64), lengths + np.diff(before)


def _bits(alphabet: list[int] | None) -> int:
    return WIDE if alphabet is None else BITS


def _coded(distinct: pa.Array, alphabet: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, pieces' numbers of them); without an alphabet, every character's UTF-16 units."""
    points, lengths = _characters(distinct)
    return _units(points, lengths) if alphabet is None else (_symbols(points, alphabet), lengths)


def _grams(symbols: np.ndarray, lengths: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams of ORDER symbols, pieces' numbers of them): one for each character and for the end of each piece."""
    n = lengths + 1
    ends = np.cumsum(n)
    flat = np.full(ends[-1] if len(ends) else 0, END, np.uint64)
    inside = np.ones(len(flat), bool)
    inside[ends - 1] = False
    flat[inside] = symbols
    place = np.arange(len(flat)) - np.repeat(ends - n, n)
    gram = flat.copy()
    for k in range(1, ORDER):
        before = np.zeros(len(flat), np.uint64)
        before[k:] = flat[: len(flat) - k]
        before[place < k] = START
        gram |= before << np.uint64(bits * k)
    return gram, n


def _repeated(bits: int) -> np.ndarray:
    """The n-grams of a repeated piece: ``AGAIN`` after ORDER - 1 starts, and its end."""
    return np.array([AGAIN, (AGAIN << bits) | END], np.uint64)


def _alphabets(docs: DataFrame) -> dict[str, list[int] | None]:
    """Each language's characters in the given documents, commonest first, ties by code point; None for a language with
    more than LETTERS of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in text_slices(batches, "text"):
            for lang, rows in _by_language(b):
                distinct, codes, _ = _pieces(rows)
                points, lengths = _characters(distinct)
                weight = np.repeat(np.bincount(codes, minlength=len(distinct)), lengths)
                own = np.bincount(points, weight, minlength=0x3000) if len(points) else np.zeros(0x3000)
                old = counts.get(lang, np.zeros(0))
                total = np.zeros(max(len(old), len(own)))
                total[: len(old)] += old
                total[: len(own)] += own
                counts[lang] = total
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at].astype(np.int64))], ["lang", "point", "n"])

    sums = docs.mapInArrow(run, "lang string, point long, n long").groupBy("lang", "point").agg(F.sum("n").alias("n"))
    top = W.partitionBy("lang").orderBy(F.desc("n"), "point")
    rows = sums.withColumn("r", F.row_number().over(top)).where(F.col("r") <= LETTERS + 1).toArrow().to_pylist()  # at most so many rows a language
    out: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: r["r"]):
        out.setdefault(r["lang"], []).append(r["point"])
    return {lang: points if len(points) <= LETTERS else None for lang, points in out.items()}


def _by_language(b: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    langs = b.column("lang")
    for lang in sorted(pc.unique(langs).to_pylist()):
        yield lang, b.column("text").filter(pc.equal(langs, lang))


def gram_counts(trusted: DataFrame, alphabets: dict[str, list[int] | None]) -> DataFrame:
    """(lang, half, gram, n): n-gram counts of the trusted documents (lang, half, text), by halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in text_slices(batches, "text"):
            for half in (0, 1):
                part = b.filter(pc.equal(b.column("half"), half))
                for lang, rows in _by_language(part):
                    distinct, codes, bounds = _pieces(rows)
                    again = _again(codes, bounds)
                    seen = np.bincount(codes[~again], minlength=len(distinct))
                    alphabet = alphabets.get(lang)
                    gram, n = _grams(*_coded(distinct, alphabet), _bits(alphabet))
                    old = held.get((lang, half), (np.zeros(0, np.uint64), np.zeros(0)))
                    extra = np.full(2, again.sum(), float)
                    gram, at = np.unique(np.concatenate([old[0], gram, _repeated(_bits(alphabet))]), return_inverse=True)
                    count = np.bincount(at, np.concatenate([old[1], np.repeat(seen, n).astype(float), extra]))
                    held[lang, half] = gram[count > 0], count[count > 0]
        for (lang, half), (gram, count) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), half, np.int32)), pa.array(gram.astype(np.int64)), pa.array(count.astype(np.int64))], ["lang", "half", "gram", "n"])

    return trusted.mapInArrow(run, "lang string, half int, gram long, n long").groupBy("lang", "half", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, wide: Collection[str] = ()) -> tuple[DataFrame, DataFrame]:
    """((model, lang, k, gram, p), (model, lang, k, context, back)) from (model, lang, gram, n) counts of order ORDER:
    the interpolated probabilities of the seen n-grams of each order k, and the weights that contexts give to the order
    below. ``wide``: the languages with symbols of WIDE bits. Everything is joins and sums of counts by n-gram, context
    or suffix."""
    own = ["model", "lang"]
    by_width = lambda f: F.when(F.col("lang").isin(*wide), f(WIDE)).otherwise(f(BITS)) if wide else f(BITS)
    last = lambda k: F.col("gram").bitwiseAND(by_width(lambda bits: F.lit((1 << (bits * k)) - 1)))
    orders = {ORDER: counts.select(*own, "gram", "n")}
    for k in range(ORDER - 1, 0, -1):  # how many different symbols stand before
        orders[k] = orders[k + 1].select(*own, last(k).alias("gram")).groupBy(*own, "gram").agg(F.count(F.lit(1)).alias("n"))
    lower, ps, backs = None, [], []
    for k in range(1, ORDER + 1):
        table = orders[k].withColumn("context", by_width(lambda bits: F.shiftrightunsigned("gram", bits)))
        of = lambda i: F.sum((F.col("n") == i).cast("double"))
        d = table.groupBy(*own).agg(*[of(i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
        ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
        cut = lambda i, a, b: F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), F.coalesce(i - (i + 1) * y * ratio(a, b), F.lit(0.5 * i))))
        d = d.select(*own, cut(1, "n2", "n1").alias("d1"), cut(2, "n3", "n2").alias("d2"), cut(3, "n4", "n3").alias("d3"))
        table = table.join(d, own).withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        context = table.groupBy(*own, "context").agg(F.sum("n").alias("total"), F.sum("d").alias("left")).withColumn("back", F.col("left") / F.col("total"))
        table = table.join(context, [*own, "context"])
        first = (F.col("n") - F.col("d")) / F.col("total")
        if lower is None:
            table = table.withColumn("p", first + F.col("back") / by_width(lambda bits: F.lit(2.0**bits)))
        else:
            table = table.withColumn("suffix", last(k - 1)).join(lower, [*own, "suffix"]).withColumn("p", first + F.col("back") * F.col("q"))
        table = saved(table.select(*own, F.lit(k).alias("k"), "gram", "p"), "kn-order")
        ps.append(table)
        backs.append(context.select(*own, F.lit(k).alias("k"), "context", "back"))
        lower = table.select(*own, F.col("gram").alias("suffix"), F.col("p").alias("q"))
    p, back = ps[0], backs[0]
    for x, y in zip(ps[1:], backs[1:]):
        p, back = p.unionByName(x), back.unionByName(y)
    return p, back


class Model:
    """One language's tables as sorted arrays, of logarithms."""

    def __init__(self, alphabet: list[int] | None):
        self.alphabet, self.bits, self.p, self.back = alphabet, _bits(alphabet), {}, {}

    def put(self, table: dict, k: int, keys: np.ndarray, values: np.ndarray) -> None:
        keys = keys.astype(np.uint64)  # before the sort: half of the wide keys are negative as they come
        order = np.argsort(keys)
        table[k] = keys[order], np.log(values[order])

    @staticmethod
    def get(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value)."""
        if table is None or not len(table[0]):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        ok = table[0][at] == keys
        return ok, np.where(ok, table[1][at], 0.0)

    def log_p(self, gram: np.ndarray) -> np.ndarray:
        """Of each n-gram's last symbol after the ones before it."""
        out = np.zeros(len(gram))
        left = np.arange(len(gram))
        for k in range(ORDER, 0, -1):
            own = gram[left] & np.uint64((1 << (self.bits * k)) - 1)
            ok, value = self.get(self.p.get(k), own)
            out[left[ok]] += value[ok]
            left, own = left[~ok], own[~ok]
            if not len(left):
                return out
            out[left] += self.get(self.back.get(k), own >> np.uint64(self.bits))[1]
        out[left] -= self.bits * math.log(2)
        return out

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log probability, symbols) of each row."""
        distinct, codes, bounds = _pieces(column)
        gram, n = _grams(*_coded(distinct, self.alphabet), self.bits)
        different, at = np.unique(gram, return_inverse=True)
        value = np.zeros(len(distinct))
        if len(n):
            value = np.add.reduceat(self.log_p(different)[at], np.cumsum(n) - n)
        again = _again(codes, bounds)
        value, count = value[codes], n[codes]
        value[again], count[again] = self.log_p(_repeated(self.bits)).sum(), 2
        add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
        return add(value), add(count).astype(np.int64)


def _scored(docs: DataFrame, p: DataFrame, back: DataFrame, alphabets: dict[str, list[int] | None], keep: list[str], kinds: dict[str, str], text: str, finish, extra: str) -> DataFrame:
    """``docs`` (model, lang, text, ``keep``) beside the probabilities and weights of their model and language: a row each
    with ``keep`` and what finish(lang, log probabilities, symbols) makes of them (columns of ``extra``).

    A language's documents are dealt over groups of about ``GROUP`` bytes, each of which meets the language's tables in a
    task of its own: nothing of them goes through the driver, and a hot language is many groups."""
    sizes = docs.groupBy("model", "lang").agg(F.greatest(F.ceil(F.sum(F.octet_length(text)) / GROUP), F.lit(1)).cast("int").alias("groups"))
    sizes = saved(sizes.na.fill({"groups": 1}), "language-sizes")  # a row a model and language
    own = docs.join(hinted(sizes), ["model", "lang"]).withColumn("group", F.pmod(F.xxhash64(*keep, text), F.col("groups")).cast("int")).drop("groups")
    table = p.select("model", "lang", F.lit(0).alias("kind"), "k", F.col("gram").alias("key"), F.col("p").alias("value")).unionByName(back.select("model", "lang", F.lit(1).alias("kind"), "k", F.col("context").alias("key"), F.col("back").alias("value")))
    table = table.join(hinted(sizes), ["model", "lang"]).withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang = key[1].as_py()
        model = Model(alphabets.get(lang))
        kind, k = right.column("kind").to_numpy(), right.column("k").to_numpy()
        keys, values = right.column("key").to_numpy(), right.column("value").to_numpy()
        for i, part in ((0, model.p), (1, model.back)):
            for order in np.unique(k[kind == i]):
                at = (kind == i) & (k == order)
                model.put(part, int(order), keys[at], values[at])
        made = []
        for b in slices(left.combine_chunks().to_batches(), text, 4_000_000):
            total, n = model.score(b.column(text)) if model.p else (np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64))
            made.append(pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *finish(lang, total, n)], names))
        if not made:  # tables without documents
            return pa.Table.from_arrays([*[left.column(c) for c in keep], *finish(lang, np.zeros(0), np.zeros(0, np.int64))], names)
        return pa.Table.from_batches(made)

    shape = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], extra])
    names = [*keep, *[x.split()[0] for x in extra.split(", ")]]
    return own.groupBy("model", "lang", "group").cogroup(table.groupBy("model", "lang", "group")).applyInArrow(run, shape)


def band_of(symbols):
    """Bands of lengths: powers of two up to 2 ** 14."""
    return F.least(F.floor(F.log2(F.greatest(symbols, F.lit(1)))), F.lit(14)).cast("int")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, slack: float = 1.02, least: int = 30, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: doc_id and lang) with _symbols, _perplexity, _threshold, _kept added, one
    row a row of ``docs``.

    Trusted: labelled quality 1 and not toxic. The threshold of a language and length band is ``slack`` times (in
    log perplexity) the quantile of the trusted documents' scores there; bands with fewer than ``least`` of them take the
    language's quantile, languages with none reject nothing. A document is kept when its perplexity is at most its
    threshold. Null or empty texts, texts of white space and unscored languages have a null perplexity and are kept:
    nothing speaks against them. A null language is a language of its own; null ids match no label; a repeated label
    counts once. A very long text is scored whole; no rows give no rows; extra columns are ignored."""
    keep = keep or [doc_id, lang]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_good")).distinct()
    good = hinted(saved(good, "trusted-ids"), 5_000_000)
    language = F.coalesce(F.col(lang), F.lit("\x00none"))
    trusted = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), language.alias("lang")).join(good, F.col("id") == F.col("_good"), "left_semi")
    trusted = trusted.select("text", "lang", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half"))
    alphabets = _alphabets(trusted.select("text", "lang"))
    counts = saved(gram_counts(trusted, alphabets), "gram-counts")
    # models 0 and 1 for the halves they have not seen, model 2 of both
    named = counts.withColumn("model", F.explode(F.array(1 - F.col("half"), F.lit(2)))).groupBy("model", "lang", "gram").agg(F.sum("n").alias("n"))
    p, back = kneser_ney(saved(named, "model-counts"), sorted(lang for lang, own in alphabets.items() if own is None))
    p, back = saved(p, "kn-p"), saved(back, "kn-back")
    tested = trusted.select(F.col("half").alias("model"), "lang", "text")
    # an empty text or one without a model has no score
    mean = lambda lang, total, n: [pa.array(n), pa.array(np.where(n > 0, -total / np.maximum(n, 1), np.nan), from_pandas=True)]
    known = p.select("model", "lang").distinct().where("model < 2")
    tested = tested.join(F.broadcast(known), ["model", "lang"], "left_semi")
    sample = saved(_scored(tested, p.where("model < 2"), back.where("model < 2"), alphabets, ["lang"], {"lang": "string"}, "text", mean, "symbols long, score double"), "trusted-scores")
    sample = sample.where("score is not null").withColumn("band", band_of(F.col("symbols")))
    by_lang = sample.groupBy("lang").agg(F.percentile_approx("score", quantile, 10_000).alias("all"))
    by_band = sample.groupBy("lang", "band").agg(F.percentile_approx("score", quantile, 10_000).alias("own"), F.count(F.lit(1)).alias("n"))
    rows = by_lang.join(by_band, "lang").collect()  # 15 rows a language
    limits = {r["lang"]: {} for r in rows}
    for r in rows:
        limits[r["lang"]][-1] = r["all"] * slack
        if r["n"] >= least:
            limits[r["lang"]][r["band"]] = r["own"] * slack
    both = [*keep, *[text] * (text not in keep)]
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(both)], F.lit(2).alias("model"), language.alias("lang"))
    at = {c: f"k{i}" for i, c in enumerate(both)}

    def judged(lang: str, total: np.ndarray, n: np.ndarray) -> list[pa.Array]:
        score = np.where((n > 0) & (total < 0), -total / np.maximum(n, 1), np.nan)
        own = limits.get(lang, {})
        table = np.array([own.get(k, own.get(-1, np.inf)) for k in range(15)])
        limit = np.where(np.isnan(score), np.nan, table[np.minimum(np.log2(np.maximum(n, 1)).astype(int), 14)])
        return [pa.array(n), pa.array(np.exp(score), from_pandas=True), pa.array(np.exp(limit), from_pandas=True), pa.array(~(score > limit))]

    out = _scored(rows, p.where("model = 2"), back.where("model = 2"), alphabets, [at[c] for c in keep], {at[c]: kinds[c] for c in keep}, at[text], judged, "_symbols long, _perplexity double, _threshold double, _kept boolean")
    return out.toDF(*keep, "_symbols", "_perplexity", "_threshold", "_kept")


def drop_low_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that classify() keeps, with their columns, whatever their names."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = dict(zip(docs.columns, plain.columns))
    found = classify(plain, labels, text=at[text], doc_id=at[doc_id], lang=at[lang], keep=plain.columns, **options)
    return found.where("_kept").select(*plain.columns).toDF(*docs.columns)
