"""Spelling variants: words one code point apart, found in a trie of letter-group counts.

A word is the path of its length and then of how often it has the letters of each group, ``LEVELS`` groups of groups one
after the other. A word one code point longer differs from it by a surplus of one in one group, a word of its own length
by a surplus and a deficit of one each (or by nothing, where both letters are of one group). So every word walks down the
trie with a budget of one surplus and one deficit; at each level the branches that no word has are left by a join with
that level's nodes. The words at the leaves reached are verified by their edit distance. A pair is walked from one side
only: from the shorter word, or by the surplus before the deficit.

A node is a number: the sum of its path's counts, each times the ``WEIGHTS`` of its group. So a word's letters are
counted once, and a branch adds to a node of the word the weights of what it spends. Two paths of one sum would give more
candidates, which the check of the leaves drops."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._io import hinted, saved
from .exact_dedup import ascii_lower

#: Maximal runs of at least five letters; shorter ones make no word.
RUN = "[a-zÀ-ÿ]{5,}"
#: Letter groups of each level; the last group of all holds every other letter.
LEVELS = (("e", "n", "i", "t"), ("r", "s", "a", "o"), ("u", "d", "l", "hm"), ("cg", "bp", "fkv"))
#: Of each group, of every other letter and of the length, under 2 ** 31: a string's sums then lie under 2 ** 63.
WEIGHTS = {g: int.from_bytes(hashlib.sha256(g.encode()).digest()[:4], "big") >> 1 for g in (*(x for level in LEVELS for x in level), "other", "length")}
#: Nodes or words sent to every executor at most; beyond it the walk joins by a shuffle.
SENT = 1_000_000
NONE, OWING, SPENT, LONGER = 0, 1, 2, 3  # budget of a walk: whole, a deficit left, nothing left, a surplus only


def altered(doc_id: Column, run: Column, modulus: int = 97) -> Column:
    """The run without one code point where ``modulus`` divides the crc32 of ``<doc_id>:<run>``; a null id counts as empty."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % modulus == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", letters: int = 5, times: int = 3) -> DataFrame:
    """(word, n): the altered runs of all texts with at least ``letters`` (5 or more) code points and ``times`` occurrences."""
    runs = docs.select(F.col(doc_id).alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(RUN), F.lit(0))).alias("run"))
    found = runs.select(altered(F.col("id"), F.col("run")).alias("word")).where(F.length("word") >= letters)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)


def _having(word: Column, letters: str) -> Column:
    return F.length(word) - F.length(F.translate(word, letters, ""))


def _groups(level: int) -> tuple[str, ...]:
    return (*LEVELS[level], *["other"] * (level == len(LEVELS) - 1))


def _nodes(word: Column) -> list[Column]:
    """The word's own nodes, from its length down to its leaf."""
    other = F.length(F.translate(word, "".join("".join(x) for x in LEVELS), ""))
    weighed = lambda g: (other if g == "other" else _having(word, g)).cast("long") * WEIGHTS[g]
    nodes = [F.length(word).cast("long") * WEIGHTS["length"]]
    for level in range(len(LEVELS)):
        nodes.append(sum((weighed(g) for g in _groups(level)), nodes[-1]))
    return nodes


def _steps(level: int) -> list[tuple[int, int, int]]:
    """(budget before, budget behind, what the node gains) of every way to spend within one level."""
    w = [WEIGHTS[g] for g in _groups(level)]
    stay = [(b, b, 0) for b in (NONE, OWING, SPENT, LONGER)]
    more = [(b, e, x) for x in w for b, e in ((NONE, OWING), (LONGER, SPENT))]
    less = [(OWING, SPENT, -x) for x in w]
    return stay + more + less + [(NONE, SPENT, x - y) for i, x in enumerate(w) for y in w[i + 1 :]]


def _walked(front: DataFrame, level: int) -> DataFrame:
    """The branches of one level that each walk's budget lets it take."""
    ways = lambda b: F.array(*[F.struct(F.lit(e).alias("budget"), F.lit(gain).cast("long").alias("gain")) for at, e, gain in _steps(level) if at == b])
    taken = F.when(F.col("budget") == NONE, ways(NONE)).when(F.col("budget") == OWING, ways(OWING)).when(F.col("budget") == SPENT, ways(SPENT)).otherwise(ways(LONGER))
    own = [f"_{i}" for i in range(level + 1, len(LEVELS) + 1)]
    out = front.select("word", "n", *own, "gained", F.explode(taken).alias("way"))
    return out.select("word", "n", *own, (F.col("gained") + F.col("way.gain")).alias("gained"), "way.budget")


def near_pairs(words: DataFrame, sent: int = SENT) -> DataFrame:
    """(a, a_n, b, b_n): every pair of ``words`` (word, n) that differs by one inserted, deleted or replaced code point, once.

    ``words`` are distinct and read several times: give a written table."""
    trie = saved(words.select("word", "n", *[x.alias(f"_{i}") for i, x in enumerate(_nodes(F.col("word")))]), "trie")
    starts = F.array(*[F.struct(F.lit(b).alias("budget"), F.lit(gain).cast("long").alias("gained")) for b, gain in ((NONE, 0), (LONGER, WEIGHTS["length"]))])
    front = trie.withColumn("at", F.explode(starts)).select(*trie.columns, "at.gained", "at.budget")
    for level in range(len(LEVELS)):
        there = trie.select(F.col(f"_{level}").alias("node")).distinct()
        here = front.withColumn("node", F.col(f"_{level}") + F.col("gained"))
        front = _walked(here.join(hinted(there, sent), "node", "left_semi"), level)
    node = (F.col(f"_{len(LEVELS)}") + F.col("gained")).alias("node")
    front = front.where(F.col("budget").isin(NONE, SPENT)).select(F.col("word").alias("a"), F.col("n").alias("a_n"), node, "budget")
    leaves = trie.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col(f"_{len(LEVELS)}").alias("node"))
    met = front.join(hinted(leaves, sent), "node").where((F.col("budget") == SPENT) | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def last_forms(forms: DataFrame, most_rounds: int = 12) -> DataFrame:
    """(word, root) from (word, form) links without cycles: the end of each word's chain, by doubling the links."""
    links = saved(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(most_rounds):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = saved(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        links = longer.drop("moved")
        if not longer.where("moved").limit(1).count():
            return links
    raise RuntimeError(f"forms did not end in {2**most_rounds} steps")


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", times: int = 3, ratio: int = 2, sent: int = SENT) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n.

    A word's form is the most frequent of the words one code point away (of equals the smallest in code-point order) if
    that has at least ``ratio`` (2 or more) times its occurrences, else null; root follows forms to the last. A null text
    has no words, a null doc_id counts as empty, repeated rows count again, and texts and runs are read whole, however long.
    Extra columns are ignored; no rows, or only texts without words, give no rows. Occurrences are counted before the
    shuffle, so that a frequent word is one row a task."""
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent: chains of forms then end soon")
    words = saved(vocabulary(docs, text, doc_id, times=times), "vocabulary")
    pairs = saved(near_pairs(words, sent), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    found = words.join(best, "word", "left").withColumn("_enough", -F.col("best.n") >= ratio * F.col("n"))
    found = saved(found.select("word", F.when(F.col("_enough"), F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("_enough"), -F.col("best.n")).alias("form_n")), "formed")
    roots = last_forms(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
