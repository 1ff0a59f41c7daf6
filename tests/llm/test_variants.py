"""Spelling variants, the conversation trie and SimHash against plain readings of what they should give."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from placewright.llm import conversation_trie, simhash, spelling

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if one_apart(v, w)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) if near[w] else None for w in n}
    form = {w: b if b and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def shown(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_variants_equal_brute_force(spark, sent):
    rng = random.Random(3)
    rows = []
    base = ["colour", "separate", "größe", "ÉTOILE", "münchen", "x" * 3000, "banana", "jazzy", "quixotic", "listen", "silent", "ÿÿÿÿÿ", "straße"]
    for w in base:
        for k in range(4):  # variants of variants, ever rarer
            rows += [(rng.randrange(1000), w)] * (3 * 2 ** (4 - k))
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeéxz") + w[i:], w[:i] + rng.choice("aeéxz") + w[i + 1 :]])
    letters = ["".join(x) for x in itertools.product("ab", repeat=5)]
    rows += [(i, " ".join(rng.choice(letters) for _ in range(40))) for i in range(8)]
    rows += [(None, "Colour, colour; colouR"), (5, None), (6, ""), (7, "a×b÷c-d'e"), (8, "word9word" * 3)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, word string")
    assert shown(spelling.variants(df, sent=sent)) == plain_variants(rows)


def test_variants_of_awkward_rows(awkward, nothing):
    assert shown(spelling.variants(awkward)) == plain_variants([(r.doc_id, r.text) for r in awkward.collect()])
    assert spelling.variants(nothing).count() == 0


def test_letters_are_counted_once_a_word(spark):
    """The walk adds numbers; no branch of it reads its word's letters again."""
    words = spark.createDataFrame([("separate", 9), ("seperate", 4), ("separates", 3), ("orchard", 5)], "word string, n long")
    pairs = spelling.near_pairs(words)
    assert sorted((r.a, r.b) for r in pairs.collect()) in ([("separate", "separates"), ("separate", "seperate")], [("separate", "separates"), ("seperate", "separate")])
    assert "translate(" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_a_word_loses_letters_in_many_documents(spark):
    """Every 97th document loses one code point of the same word, by the contract's rule."""
    rows = [(i, "Orchard orchard") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shown(spelling.variants(df))
    assert got == plain_variants(rows) and len(got) > 5 and {r[2] for r in got} == {"orchard"}


def plain_trie(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in by.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0d]+", m[-1][1])) for m in below if m)
        leaves = [m for m in below if not any(len(k) == len(m) + 1 and k[:-1] == m for k in members)]
        ends = sorted(c for c in convs if whole[c] == node)
        children = sum(len(k) == len(node) + 1 and k[:-1] == node for k in members)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), children, len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out)


def trie_rows(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert df.columns[: len(names)] == list(names)
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


def test_trie_equals_brute_force(spark):
    rng = random.Random(8)
    says = ["", "yes", "no\tmaybe so", "a b  c\nd", "é ü"]
    rows = []
    for c in [x for x in range(130) if x not in (20, 47)]:  # 20 is absent: its block borrows nothing
        for t in range(rng.choice([1, 2, 3, 3, 4, 6])):
            rows.append((c, t, rng.choice(["user", "user", "assistant"]), rng.choice(says)))
    rows += [(200 + i, t, "user", "same") for i in range(60) for t in range(4)]  # one large group of copies
    rows += [(300, t, "user", f"turn {t}") for t in range(300)]  # a long one
    rows += [(301, None, "user", "first"), (301, 0, None, None), (302, 5, "b", "tie"), (302, 5, "a", "tie"), (302, 5, "a", "tie"), (302, 5, "a", "other")]
    rows += [(None, 0, "user", "of nobody"), (400, 0, "user", "x " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth long").repartition(7)
    got = trie_rows(conversation_trie.prefix_trie(df))
    assert got == plain_trie(rows)
    assert any(r[1] == 0 and r[7] != conversation_trie.NOTHING for r in got)  # some are turnless


def test_trie_of_nothing_and_of_one(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversation_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    one = [(0, 0, "user", "one two")]
    assert trie_rows(conversation_trie.prefix_trie(spark.createDataFrame(one, schema))) == plain_trie(one)


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(ASCII))
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(values):
    """{value: smallest value reachable by steps of at most two bits}."""
    at = {v: v for v in values}

    def find(v):
        while at[v] != v:
            v = at[v]
        return v

    for a, b in itertools.combinations(sorted(values), 2):
        if (a ^ b).bit_count() <= 2 and find(a) != find(b):
            at[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def plain_near(rows):
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    root = plain_components({f for _, f in fps})
    least = defaultdict(list)
    for d, f in fps:
        if d is not None:
            least[root[f]].append(d)
    return sorted((str(d), f"{f:016x}", str(min(least[root[f]]) if least[root[f]] else None)) for d, f in fps)


def test_simhash_of_awkward_rows(spark, awkward, nothing):
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(awkward).collect())
    assert got == plain_near([(r.doc_id, r.text) for r in awkward.collect()])
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.drop_near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(awkward).columns == awkward.columns
    odd = [(1, "a\x00b c\x0bd"), (2, "A\x00B C d"), (3, "İ ß Ω"), (4, "one two"), (None, None), (6, " ")]
    df = spark.createDataFrame([(i, t, "x") for i, t in odd], "doc_id long, text string, fp string")
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect()) == plain_near(odd)


def test_shingles_of_a_text_longer_than_a_block(monkeypatch, spark):
    import pyarrow as pa

    rng = random.Random(1)
    texts = [" ".join(str(rng.randrange(50)) for _ in range(n)) for n in (500, 1, 0, 2, 333, 64)]
    monkeypatch.setattr(simhash, "BLOCK", 64)
    got = simhash.fingerprint_column(pa.array([*texts, None]))
    assert [int(x) % 2**64 for x in got] == [plain_fingerprint(t) for t in [*texts, None]]


@pytest.mark.parametrize("width,crowd", [(4, 48), (4, 2), (8, 5), (1, 3)])
def test_links_connect_what_is_within_two_bits(spark, width, crowd):
    rng = random.Random(width * 100 + crowd)
    values = {0, 2**64 - 1, 1 << 63}
    for _ in range(30):
        v = rng.randrange(2**64)
        for _ in range(12):
            values.add(v)
            for _ in range(rng.choice([1, 2, 2, 3, 4])):
                v ^= 1 << rng.randrange(64)
    core = rng.randrange(2**64)
    values |= {core ^ (1 << i) ^ (1 << j) for i in range(0, 64, 3) for j in range(i)}  # a crowd around one
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5).cache()
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(fps, 2, width, crowd).collect()]
    assert edges and all(a != b and (a ^ b).bit_count() <= 2 for a, b in edges)
    at = {v: v for v in values}

    def find(v):
        while at[v] != v:
            v = at[v]
        return v

    for a, b in edges:
        if find(a) != find(b):
            at[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: find(v) for v in values} == plain_components(values)


def test_near_copies_get_one_component(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(3000)}" for _ in range(1500)]
    rows = [(i, " ".join(words if i % 3 else [*words[:i], "changed", *words[i:]])) for i in range(40)] + [(100 + i, " ".join(f"v{rng.randrange(3000)}" for _ in range(300))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect()) == plain_near(rows)
