"""All pairs of documents whose shingle sets have a Jaccard similarity of num/den or more, by PartEnum signatures.

Two such sets of sizes x and y differ in at most k = floor((x + y) (den - num) / (den + num)) shingles. Sizes are cut into
bands, and similar sets meet in their band or, where they lie in neighbouring ones, at the border between; either is a
place with its own k. There the shingle hashes are dealt over n1 groups of n2 partitions. Sets that differ in at most k
shingles differ, in some groups, in at most k2 of them, hence agree there on some n2 - k2 partitions: a set's signatures
are the contents of every such choice of partitions in every group. n1, n2 and k2 depend on k (``shape``).

Empty choices are no evidence, yet unrelated sets would meet by them. There are ``m`` groups more than needed, so that
similar sets agree in m + 1 groups at least: a set with at most m groups in which some choice is empty leaves those
signatures out, and any other joins them to each of its signatures under a second deal, which similar sets share again.

Copies (equal sets) are one class from the start. Of classes that share a signature, each is compared with the smallest
one, then each outside the commonest component of a signature with one inside, another for each signature, by parity
sketches, which bound a difference from below; the likeliest few for each class and component are compared in full. Found
links join classes into components, and only classes of different components are compared further, again by sketches
first. Where more than ``most`` classes of a signature lie
outside its commonest component (passages that many documents share), its classes are first grouped anew by their
signatures under another, independent deal of the shingles, which similar sets again share."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from ._io import hinted, saved
from ._words import NON_SPACE, mix, shingles, slices, words

#: Parity classes of a sketch.
SKETCH = 512


def bands(num: int, den: int, upto: int) -> list[int]:
    """The largest size of each band from 0: about (den / num) ** 2 times the one before."""
    out = [0, 1]
    while out[-1] < upto:
        out.append(max(out[-1] + 1, out[-1] * den * den // (num * num)))
    return out


def _sets(column: pa.Array, size: int) -> list[np.ndarray]:
    h, bounds = words(column, NON_SPACE)
    s, at = shingles(h, bounds, size)
    return [np.unique(s[at[i] : at[i + 1]]) for i in range(len(column))]


def _key(own: np.ndarray) -> tuple[int, int]:
    """128 bits for a set: two independent sums of its shingles' hashes."""
    with np.errstate(over="ignore"):
        x = mix(own + np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64) + np.uint64(len(own))
        y = mix(own ^ np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)
    return int(mix(np.array([x]))[0].astype(np.int64)), int(mix(np.array([y]))[0].astype(np.int64))


def document_sets(docs: DataFrame, size: int, text: str, doc_id: str) -> DataFrame:
    """(doc_id, text_key, n_shingles, k1, k2): one row a row of ``docs``; (k1, k2) names the set of shingles."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = _sets(b.column("text"), size)
            keys = np.array([_key(x) for x in sets], np.int64).reshape(-1, 2)
            cols = [b.column("doc_id"), b.column("text_key"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_key", "n_shingles", "k1", "k2"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, n_shingles long, k1 long, k2 long")


def shape(k: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, m) for sets that differ in at most k shingles. Small sets are dealt over few groups, from which two
    partitions may be left out, so that a signature still holds several shingles."""
    n2, k2 = (5, 2) if 2 <= k <= 8 else (3, 1)
    least = k // (k2 + 1) + 1
    return least + least // 8, n2, k2, least // 8


def places(sizes: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(place, k, numbers of the sets that sign there). Sets that only equal ones are similar to sign nowhere."""
    tops = np.array(bands(num, den, int(sizes.max(initial=0)) + 1), np.int64)
    band = np.searchsorted(tops, sizes)
    for j in np.unique(band[sizes > 0]):
        top = int(tops[j])
        yield 2 * int(j), 2 * top * (den - num) // (den + num), np.flatnonzero(band == j)
    for j in range(1, len(tops)):
        top = int(tops[j])
        near = (sizes * den >= (top + 1) * num) & (sizes * num <= top * den) & (np.abs(2 * band - 2 * j - 1) == 1)
        if near.any():
            yield 2 * j + 1, (top + top * den // num) * (den - num) // (den + num), np.flatnonzero(near)


def _dealt(sets: list[np.ndarray], place: int, k: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(signatures, whether the choice is empty), by set and group, for each choice of partitions."""
    n1, n2, k2, _ = shape(k)
    salt = mix(np.array([seed * 1_000_003 + place], np.uint64))[0]
    h = mix(np.concatenate(sets) ^ salt)
    cell = (h % np.uint64(n1 * n2)).astype(np.int64) + np.repeat(np.arange(len(sets)) * (n1 * n2), [len(x) for x in sets])
    sums = np.zeros(len(sets) * n1 * n2, np.uint64)
    np.add.at(sums, cell, mix(h))
    sums = sums.reshape(len(sets), n1, n2)
    filled = np.bincount(cell, minlength=len(sets) * n1 * n2).reshape(len(sets), n1, n2) > 0
    for chosen, which in enumerate(combinations(range(n2), n2 - k2)):
        sig = mix(np.uint64(chosen + 1) * np.uint64(1_000_003) + np.arange(n1, dtype=np.uint64)) ^ salt
        for w in which:
            sig = mix(sig + sums[:, :, w])
        yield sig, ~filled[:, :, list(which)].any(2)


def signatures(sets: list[np.ndarray], num: int, den: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of all sets, under the deal ``seed`` (empty choices: and the one after it)."""
    of, sigs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    with np.errstate(over="ignore"):
        for place, k, members in places(np.array([len(x) for x in sets], np.int64), num, den):
            if k == 0:
                continue
            own = [sets[i] for i in members]
            dealt = list(_dealt(own, place, k, 2 * seed))
            bare = np.any([empty for _, empty in dealt], axis=0).sum(1) > shape(k)[3]  # too many groups with empty choices
            for sig, empty in dealt:
                of.append(np.repeat(members, (~empty).sum(1)))
                sigs.append(sig[~empty])
            if bare.any():
                again = [(members[i], sig, empty) for i, sig, empty in _by_set(np.flatnonzero(bare), dealt)]
                second = _by_set(np.arange(len(again)), list(_dealt([sets[i] for i, _, _ in again], place, k, 2 * seed + 1)))
                for (i, sig, empty), (_, other, _) in zip(again, second):
                    both = mix(mix(sig[empty])[:, None] + other[None, :]).ravel()
                    of.append(np.full(len(both), i))
                    sigs.append(both)
    return np.concatenate(of), np.concatenate(sigs)


def _by_set(numbers: np.ndarray, dealt: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, all signatures, whether empty) of the sets with the given numbers."""
    for i in numbers:
        yield i, np.concatenate([sig[i] for sig, _ in dealt]), np.concatenate([empty[i] for _, empty in dealt])


def signed(docs: DataFrame, size: int, num: int, den: int, text: str) -> DataFrame:
    """(sig, c): the signatures of every document's set, with ``c`` the first half of the set's key. A task signs for
    equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches, "text"):
            own = {}
            for x in _sets(b.column("text"), size):
                c = _key(x)[0]
                if c not in seen:
                    own[c] = x
            seen.update(own)
            names = np.fromiter(own, np.int64, len(own))
            of, sig = signatures(list(own.values()), num, den)
            for at in range(0, len(sig), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(sig[at : at + 200_000].astype(np.int64)), pa.array(names[of[at : at + 200_000]])], ["sig", "c"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "sig long, c long")


def shared(rows: DataFrame) -> DataFrame:
    """(sig, c, least): the rows of signatures that several sets have, with the smallest of these."""
    from pyspark.sql import Window as W

    w = W.partitionBy("sig")
    out = rows.withColumn("least", F.min("c").over(w)).withColumn("most", F.max("c").over(w))
    return out.where("least <> most").select("sig", "c", "least")


BITS = [f"b{i}" for i in range(SKETCH // 64)]


def candidate_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, size: int, text: str) -> DataFrame:
    """(c, n, b0, b1, ..., wide, s): of each wanted set (c), read again from one text or few, its size, the parities of
    its numbers of shingles in SKETCH classes and, packed, in as many as a power of two of at least twice its size, and
    the shingles' hashes."""
    texts = rows.groupBy(F.col("k1").alias("c")).agg(F.min("text_key").alias("text_key")).join(wanted, "c", "left_semi").select("text_key").distinct()
    texts = saved(texts, "wanted-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches, "text"):
            new = {}
            for x in _sets(b.column("text"), size):
                c = _key(x)[0]
                if c not in seen:
                    new[c] = x
            seen.update(new)
            bits, wide = np.zeros((len(new), len(BITS)), np.int64), []
            for i, x in enumerate(new.values()):
                h = mix(x ^ np.uint64(77))
                classes = max(SKETCH, 1 << (2 * len(x) - 1).bit_length())
                parity = np.bincount((h % np.uint64(classes)).astype(np.int64), minlength=classes).astype(np.uint8) & 1
                wide.append(np.packbits(parity).tobytes())
                bits[i] = np.packbits(np.bitwise_xor.reduce(parity.reshape(-1, SKETCH))).view("<i8")
            flat = np.concatenate(list(new.values())).astype(np.int64) if new else np.zeros(0, np.int64)
            n = np.array([len(x) for x in new.values()], np.int64)
            at = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            cols = [np.fromiter(new, np.int64, len(new)), n, *[np.ascontiguousarray(bits[:, k]) for k in range(len(BITS))]]
            yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in cols], pa.array(wide, pa.binary()), pa.ListArray.from_arrays(at, pa.array(flat))], ["c", "n", *BITS, "wide", "s"])

    found = docs.select(F.col(text).alias("text")).join(hinted(texts), F.xxhash64(F.col("text")) == F.col("text_key"), "left_semi")
    shape_ = "c long, n long" + "".join(f", {b} long" for b in BITS) + ", wide binary, s array<long>"
    return found.mapInArrow(run, shape_).dropDuplicates(["c"])


def _side(df: DataFrame, s: str) -> DataFrame:
    """Columns c, n, b0 ... named for one side of a pair."""
    return df.withColumnsRenamed({"c": s, "n": f"n_{s}", "root": f"root_{s}"} | {x: f"{x}_{s}" for x in BITS})


def _differ():
    """In how many parities the sketches of two sides differ."""
    return sum((F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) for x in BITS), F.lit(0))


def _may_link(num: int, den: int):
    """Whether the sets of two sides can have the similarity: they differ in at least as many shingles as their parities."""
    na, nb = F.col("n_a"), F.col("n_b")
    return (na * den >= nb * num) & (nb * den >= na * num) & (_differ() * (den + num) <= (na + nb) * (den - num))


def sieved(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that may have the similarity by their sketches."""
    bits = sets.select("c", "n", *BITS)
    return pairs.join(_side(bits, "a"), "a").join(_side(bits, "b"), "b").where(_may_link(num, den)).select("a", "b")


def sieved_wide(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that may have the similarity by their wide sketches; the wider of two is folded to the other."""
    own = lambda c: sets.select(F.col("c").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"w_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            sizes = b.column("n_a").to_numpy() + b.column("n_b").to_numpy()
            for i, (x, y) in enumerate(zip(b.column("w_a").to_pylist(), b.column("w_b").to_pylist())):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                size = min(len(x), len(y))
                x, y = np.bitwise_xor.reduce(x.reshape(-1, size)), np.bitwise_xor.reduce(y.reshape(-1, size))
                ok[i] = int(np.bitwise_count(x ^ y).sum()) * (den + num) <= sizes[i] * (den - num)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    return pairs.join(own("a"), "a").join(own("b"), "b").mapInArrow(run, "a long, b long")


def open_pairs(groups: DataFrame, sets: DataFrame, num: int, den: int, block: int = 4096) -> DataFrame:
    """(a, b): sets of one group (sig, c, root, main, members) and different components that may have the similarity.

    The sets outside the group's commonest component ``main`` meet all others, which are dealt over blocks of about
    ``block`` sets: no task gets a whole large group on both sides, and pairs go on only if the sketches allow them."""
    rows = groups.join(sets.select("c", "n", *BITS), "c").withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    left = _side(rows.where("root <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "main", "members"), "a")
    right = _side(rows.withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")).drop("blocks", "members"), "b")
    once = (F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b"))
    both = left.join(right, ["sig", "block"]).where((F.col("root_a") != F.col("root_b")) & once & _may_link(num, den))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets really have the similarity."""
    near = saved(sieved_wide(pairs, sets, num, den), "sieved")
    left, right = sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), sets.select(F.col("c").alias("b"), F.col("s").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    out = near.join(left, "a").join(right, "b").where(common * (den + num) >= (F.size("sa") + F.size("sb")) * num)
    return out.select("a", "b")


def signed_again(groups: DataFrame, sets: DataFrame, num: int, den: int, seed: int) -> DataFrame:
    """(sig, c): the members of groups (sig, c) by their group and their signatures under deal ``seed``, together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 64):
                part = b.slice(start, 64)
                own = [np.array(x, np.int64).astype(np.uint64) for x in part.column("s").to_pylist()]
                of, sig = signatures(own, num, den, seed)
                with np.errstate(over="ignore"):
                    groups_ = [mix(np.array(x, np.int64).astype(np.uint64)) for x in part.column("sigs").to_pylist()]
                    times = np.array([len(x) for x in groups_])
                    made = np.concatenate([mix(groups_[i] + x) for i, x in zip(of, sig)]) if len(of) else np.zeros(0, np.uint64)
                who = np.repeat(of, times[of])
                yield pa.RecordBatch.from_arrays([pa.array(made.astype(np.int64)), part.column("c").take(pa.array(who))], ["sig", "c"])

    hot = groups.groupBy("c").agg(F.collect_set("sig").alias("sigs"))  # a set has no more groups than signatures
    return hot.join(sets.select("c", "s"), "c").mapInArrow(run, "sig long, c long")


def star(groups: DataFrame) -> DataFrame:
    """(a, b): each set b of the groups (sig, c, least) and, of its groups' smallest sets, the one it meets most often."""
    met = groups.where("c <> least").groupBy("c", "least").agg(F.count(F.lit(1)).alias("n"))
    return met.groupBy(F.col("c").alias("b")).agg(F.max_by("least", F.struct("n", "least")).alias("a")).select("a", "b")


def open_groups(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """(sig, c, root, members, top, main): the groups (sig, c) with sets of several of the components (node, root) found so
    far; their sizes, and the size and root of the component that most of their sets belong to."""
    named = groups.join(roots, groups["c"] == roots["node"], "left").select("sig", "c", F.coalesce("root", "c").alias("root"))
    by_root = named.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("n"))
    spread = by_root.groupBy("sig").agg(F.sum("n").alias("members"), F.max("n").alias("top"), F.max_by("root", F.struct("n", "root")).alias("main")).where("top < members")
    return saved(named.join(spread, "sig"), "open-groups")


def spokes(groups: DataFrame, sets: DataFrame, num: int, den: int, tries: int = 4) -> DataFrame:
    """(a, b): each set b outside the main component of open groups with sets a of that, at most ``tries`` for each
    component. It meets one of them in each group, another in every group, by sketches only; of each of ``tries`` parts of
    those that these allow, the pair whose sketches differ least goes on."""
    bits = sets.select("c", "n", *BITS)
    hubs = groups.where("root = main").groupBy("sig", "main").agg(F.min(F.struct(F.xxhash64("c", "sig").alias("order"), "c")).alias("hub"))
    left = _side(hubs.select("sig", "main", F.col("hub.c").alias("c")).join(bits, "c"), "a")
    right = _side(groups.where("root <> main").select("sig", "c").join(bits, "c"), "b")
    met = left.join(right, "sig").where(_may_link(num, den))
    likeliest = F.min_by("a", F.struct(_differ() / (F.col("n_a") + F.col("n_b")), "a"))
    return met.groupBy("b", "main", F.pmod(F.xxhash64("a"), F.lit(tries)).alias("part")).agg(likeliest.alias("a")).select("a", "b")


def links(docs: DataFrame, rows: DataFrame, size: int, num: int, den: int, text: str, most: int = 1024, deals: int = 3) -> DataFrame:
    """(node, root): the classes (first key halves) that verified links connect, with the smallest that these reach. Not
    every similar pair is looked for: pairs that links connect already are not compared again, and what is found goes
    into the components at once, as one link for each two of them. After ``deals`` deals what is left is compared in full,
    in blocks, however many there are."""
    groups = saved(shared(signed(docs, size, num, den, text)).distinct(), "signature-groups")
    sets = saved(candidate_sets(docs, rows, groups.select("c").distinct(), size, text), "candidate-sets")
    roots = None
    for seed in range(1, deals + 1):
        roots = graph.joined(roots, verified(sieved(star(groups), sets, num, den), sets, num, den))
        open_ = open_groups(groups, roots)
        roots = graph.joined(roots, verified(saved(spokes(open_, sets, num, den), "spokes"), sets, num, den))
        open_ = open_groups(open_.select("sig", "c"), roots)
        many = F.col("members") - F.col("top") > most
        last = seed == deals or not open_.where(many).limit(1).count()
        few = (open_ if last else open_.where(~many)).drop("top")
        pairs = saved(open_pairs(few, sets, num, den), "open-pairs")
        roots = graph.joined(roots, verified(pairs, sets, num, den))
        if last:
            return roots
        # The sets of large groups, parted by their signatures under another deal; again each meets one other first.
        groups = saved(shared(signed_again(open_.where(many).select("sig", "c"), sets, num, den, seed)), "signature-groups")
    raise AssertionError("unreachable")


def labelled(docs: DataFrame, size: int, num: int, den: int, text: str, doc_id: str) -> DataFrame:
    """near_duplicates() with the rows' text_key."""
    rows = saved(document_sets(docs, size, text, doc_id), "document-sets")
    own = rows.where("n_shingles > 0")
    classes = own.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    roots = links(docs, own, size, num, den, text)
    rooted = classes.join(roots, F.col("k1") == F.col("node"), "left")
    least = rooted.where(F.col("node").isNotNull()).groupBy("root").agg(F.min("first").alias("component_id"))
    linked = rooted.where(F.col("node").isNotNull()).join(least, "root").select("k1", "k2", "component_id")
    labels = linked.unionByName(rooted.where(F.col("node").isNull()).select("k1", "k2", F.col("first").alias("component_id")))
    out = own.join(labels, ["k1", "k2"]).select("doc_id", "text_key", "n_shingles", "component_id")
    none = rows.where("n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(none)


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, component_id: the smallest doc_id among the documents that links
    reach. Two documents link when den * |A and B| >= num * |A or B|, for their sets of ``size``-word shingles (of all
    words, if fewer; words are lower-cased for A-Z and split at white space).

    Null and empty texts and texts without words have no shingles, link with nothing and are their own component. Null
    doc_ids are passed over in the choice of the smallest (a component of only null ids has a null component_id).
    Repeated rows are equal sets and hence linked. Extra columns are ignored."""
    return labelled(docs, size, num, den, text, doc_id).drop("text_key")


def drop_near_duplicates(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, with their columns; of several rows with that
    doc_id and one text (or of a component of null ids and one text), one. Documents without shingles all stay."""
    found = saved(labelled(docs, size, num, den, text, doc_id).where("n_shingles > 0"), "near-labels")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    names = [F.col("doc_id").alias("of"), F.col("text_key").alias("like")]
    losers = saved(found.where(~stays).select(*names).distinct(), "near-losers")
    twice = saved(found.where(stays).groupBy(*names).count().where("count > 1").drop("count"), "near-repeated")
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("key"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("like"))
    out = rows.join(hinted(losers), same, "left_anti")
    if twice.limit(1).count():
        again = out.join(hinted(twice), same, "left_semi").groupBy("id", "key").agg(F.first("row").alias("row"))
        out = out.join(hinted(twice), same, "left_anti").select("row").unionByName(again.select("row"))
    return out.select("row.*")
