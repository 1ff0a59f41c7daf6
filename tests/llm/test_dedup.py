import hashlib
import random
from collections import Counter, defaultdict

import pytest

from placewright.llm import decontam, exact_dedup, graph, jaccard, line_dedup, sharding

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(t):
    return (t or "").translate(ASCII)


def test_exact_duplicates(awkward, nothing):
    rows = awkward.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[low(r.text)].append(r.doc_id)
    want = []
    for r in rows:
        ids = [x for x in groups[low(r.text)] if x is not None]
        keep = max(ids) if ids else None
        want.append((str(r.doc_id), str(keep), len(groups[low(r.text)]), r.doc_id == keep, hashlib.sha256(low(r.text).encode()).hexdigest()))
    got = [(str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_duplicates(awkward).collect()]
    assert sorted(got) == sorted(want)
    kept = exact_dedup.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted(low(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_duplicates(nothing).count() == 0 and exact_dedup.drop_exact_duplicates(nothing).count() == 0


def test_exact_keeps_non_ascii_case(spark):
    docs = spark.createDataFrame([(1, "É"), (2, "é"), (3, "A É"), (4, "a É")], "doc_id long, text string")
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup.exact_duplicates(docs).collect()) == [(1, 1), (2, 2), (3, 4), (4, 4)]


def brute_components(rows, size, num, den):
    import re

    sets, ids = [], []
    for r in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", low(r.text)) if x]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
        ids.append(r.doc_id)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(ids[i])
    out = []
    for i in range(len(rows)):
        own = [x for x in least[find(i)] if x is not None]
        out.append((str(ids[i]), len(sets[i]), str(min(own) if own else None)))
    return sorted(out)


@pytest.mark.parametrize("size,num,den", [(4, 85, 100), (5, 4, 5), (2, 3, 5)])
def test_jaccard_equals_brute_force(awkward, size, num, den):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(awkward, size, num, den).collect())
    assert got == brute_components(awkward.collect(), size, num, den)


@pytest.mark.parametrize("most", [2, 32])
def test_jaccard_near_the_threshold_and_shared_passages(spark, most, monkeypatch):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(40)]
    rows = []
    for g in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 70))]
        for k in range(6):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 12))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(own if g % 2 else passage + own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = jaccard.links
    monkeypatch.setattr(jaccard, "links", lambda *a: plain(*a, most=most))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(docs, 3, 4, 5).collect())
    assert got == brute_components(docs.collect(), 3, 4, 5)


def test_signatures_are_shared_by_all_similar_sets():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in [3, 5, 6, 7, 8, 12, 13, 20, 29, 41, 57, 90, 200]:
        for _ in range(15):
            x = rng.integers(1, 2**62, n).astype(np.uint64)
            # as unlike as the threshold allows: d shingles of x go, e new ones come
            best = [(d, e) for d in range(n) for e in range(n) if 100 * (n - d) >= 85 * (n + e) and 100 * (n - d) < 85 * (n + e) + 300]
            d, e = best[rng.integers(len(best))] if best else (0, 0)
            y = np.concatenate([x[d:], rng.integers(1, 2**62, e).astype(np.uint64)])
            if d + e:
                of, sig = jaccard.signatures([np.unique(x), np.unique(y)], 85, 100, 1)
                assert set(sig[of == 0]) & set(sig[of == 1]), (n, d, e)


def test_near_duplicates_drop(awkward, nothing):
    kept = jaccard.drop_near_duplicates(awkward, 4, 85, 100)
    assert kept.columns == awkward.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[100] == 1 and not any(100 < (i or 0) < 112 or 200 <= (i or 0) < 212 for i in ids)
    assert ids[401] == 1 and ids[300] == ids[301] == ids[302] == 1
    assert jaccard.near_duplicates(nothing).count() == 0 and jaccard.drop_near_duplicates(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 200] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {i: 0 if i <= 200 else 201 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def brute_contamination(docs, bench, window=13):
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = defaultdict(set)
    for b in bench:
        w = word.findall(low(b.text))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams[tuple(w[k : k + window])].add(b.item_id or "")
    sizes = {len(g) for g in grams}
    out = []
    for r in docs:
        w = word.findall(low(r.text))
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                g = tuple(w[i : i + n])
                if g in grams:
                    hit |= set(range(i, i + n))
                    items |= grams[g]
        names = ",".join(sorted(map(str, items)))
        out.append((str(r.doc_id), len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.fixture(scope="module")
def bench(spark, awkward):
    rng = random.Random(2)
    texts = [r.text for r in awkward.collect() if r.text and 40 < len(r.text) < 5000]
    rows = [(str(i), " ".join(rng.choice(texts).split()[a : a + 20])) for i, a in enumerate(rng.randrange(20) for _ in range(25))]
    rows += [("one", "ONE"), ("short", " ".join(texts[0].split()[:3])), ("none", "!!"), ("null", None), (None, " ".join(texts[1].split()[:15])), ("again", rows[0][1]), ("again", rows[0][1])]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.mark.parametrize("block", [500_000, 7])
def test_contamination_equals_brute_force(awkward, bench, block):
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.contamination_report(awkward, bench, block=block).collect())
    assert got == brute_contamination(awkward.collect(), bench.collect())


def test_contamination_drop_and_empty(awkward, bench, nothing):
    bad = Counter(r[0] for r in brute_contamination(awkward.collect(), bench.collect()) if not r[5])
    kept = decontam.drop_contaminated(awkward, bench)
    assert kept.columns == awkward.columns and Counter(str(r.doc_id) for r in kept.collect()) == bad
    assert decontam.contamination_report(nothing, bench).count() == 0
    none = decontam.contamination_report(awkward, bench.limit(0)).collect()
    assert len(none) == awkward.count() and not any(r.contaminated for r in none)


def test_phrase_and_proximity_search(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a x b c"), (3, "a b x c"), (4, "c b a"), (5, "a b"), (6, "c a y b z c"), (7, "a b c a b c")], "doc_id long, text string")
    items = spark.createDataFrame([("p", "a b c")], "item_id string, text string")
    index, wanted = decontam.build_index(docs), decontam.phrases(items)
    assert sorted((r.doc_id, r.start) for r in decontam.search(index, wanted).collect()) == [(1, 0), (7, 0), (7, 3)]
    assert sorted((r.doc_id, r.start, r.length) for r in decontam.search(index, wanted, slop=1).collect()) == [(1, 0, 3), (2, 0, 4), (3, 0, 4), (7, 0, 3), (7, 3, 3)]
    assert {r.doc_id for r in decontam.search(index, wanted, slop=2).collect()} == {1, 2, 3, 6, 7}


@pytest.mark.parametrize("limit", [10**6, 0])
def test_boilerplate_lines(spark, nothing, limit):
    rows = [(i, f"own {i}\n same \n\nsame\nlast {i % 2}", "h" if i < 20 else None) for i in range(30)] + [(90, None, "h"), (91, "same", "rare"), (92, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs, ratio=0.6, min_pages=5, limit=limit).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "own 3\n\nlast 1" and got[3].n_lines == 5 and got[3].n_dropped == 2
    assert got[25].text == "own 25\n\nlast 1"
    assert got[90].text is None and got[90].n_lines == 0 and got[91].text == "same" and got[92].text == ""
    assert line_dedup.drop_boilerplate(nothing).count() == 0


@pytest.mark.parametrize("shards", [16, 3])
def test_shards_are_even_gapless_and_keep_groups(awkward, nothing, shards):
    rows = sharding.assign(awkward, shards).collect()
    assert len(rows) == awkward.count()
    n = Counter(r.shard for r in rows)
    assert max(n.values()) - min(n.get(s, 0) for s in range(shards)) <= 1 and set(n) <= set(range(shards))
    for s in n:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))
    import zlib

    want = Counter((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in awkward.collect())
    assert Counter((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert sharding.assign(nothing).count() == 0


def test_small_groups_come_together(spark):
    rows = [(i, f"text {i // 4}" if i < 400 else f"alone {i}") for i in range(2000)]
    out = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = defaultdict(set)
    for r in out:
        if r.doc_id < 400:
            groups[r.doc_id // 4].add(r.shard)
    assert sum(len(s) == 1 for s in groups.values()) >= 95


@pytest.mark.parametrize("sizes,least", [([50] * 12, 12), ([62] * 10 + [6] * 40, 48), ([300] + [10] * 50, 50)])
def test_groups_that_fit_a_shard_stay_whole(spark, sizes, least):
    texts = [f"group {k}" for k, size in enumerate(sizes) for _ in range(size)]
    texts += [f"alone {i}" for i in range(1000 - len(texts))]
    out = sharding.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(Counter(r.shard for r in out).values()) == [62] * 8 + [63] * 8
    shards = defaultdict(set)
    for r in out:
        shards[texts[r.doc_id]].add(r.shard)
    assert sum(len(shards[f"group {k}"]) == 1 for k in range(len(sizes))) >= least


def test_later_links_join_components_only(spark, monkeypatch):
    """Near copies, none of which is like all others: however many of their pairs are verified, one link counts for two components."""
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(200):
        own = list(base)
        for _ in range(rng.randint(1, 3)):
            own[rng.randrange(len(own))] = rng.choice(vocab)
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen, plain = [], graph.components
    monkeypatch.setattr(graph, "components", lambda links: seen.append(links.count()) or plain(links))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(docs, 3, 4, 5).collect())
    assert got == brute_components(docs.collect(), 3, 4, 5)
    assert max(Counter(x[2] for x in got).values()) > 100 and sum(seen) < 2 * len(rows), seen


def test_joined_equals_the_components_of_all_links(spark):
    rng = random.Random(1)
    frame = lambda n: spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(n)], "a long, b long").where("a <> b")
    parts = [frame(80).cache(), frame(0), frame(60).cache(), frame(80).cache()]
    labels, both = None, None
    for x in parts:
        labels, both = graph.joined(labels, x), x if both is None else both.unionByName(x)
        assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, graph.components(both).collect()))


def test_pairs_compared_grow_with_the_sets_not_their_signatures(spark, monkeypatch):
    """Near copies, none of which is like all others: a set that shares many signatures with a component is compared with
    a few sets of it, not with another for each signature."""
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(rng.randint(1, 7)):
            own[rng.randrange(len(own))] = rng.choice(vocab)
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    for name in ("sieved", "verified"):
        plain = getattr(jaccard, name)
        monkeypatch.setattr(jaccard, name, lambda pairs, *a, plain=plain: seen.append(pairs.count()) or plain(pairs, *a))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(docs, 3, 4, 5).collect())
    assert got == brute_components(docs.collect(), 3, 4, 5)
    assert max(Counter(x[2] for x in got).values()) > 200 and sum(seen) < 6 * len(rows), seen
