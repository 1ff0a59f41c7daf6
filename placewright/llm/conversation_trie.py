"""A prefix trie of conversations by collapsing whole sequences.

Conversations are chained into prefix keys (each turn's key is the digest of the key before it, the role and the text's
digest; texts themselves never move). Conversations with one last key are one weighted sequence, with the list of those
that end there. A sequence whose key is another's inner key is a proper prefix; the anti-join of those leaves the leaves.
Only one conversation of each sequence is then spread over its prefixes, with the sequence's weight, and the prefixes are
added up. A node's subtree is never expanded: what a sequence adds to all its prefixes follows from the words behind each
of them and the words of the nodes that are the sequence's own."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._io import saved

WORD = r"[^\x20\x09-\x0D]+"
CHAIN = "conv_id long, depth long, key binary, parent binary, words long, upto long, last boolean"
#: Bytes of SHA-256 that name a node.
KEY = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, digest, words): the turns in order, from 1; turns of one number by role, then by digest."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    w = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return rows.select("conv_id", F.row_number().over(w).cast("long").alias("pos"), "role", "digest", "words")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """The turns of every conversation c, its first h = crc32(c) % ``most`` taken from conversation c - c % ``block``, and
    a row of position 0 a conversation. ``turns`` is read four times: give a written table."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    ids = turns.where("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("donor"), head.alias("h"))
    own = turns.where((F.col("conv_id") % block == 0) | (F.col("pos") > head))
    lent = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < most)).select(F.col("conv_id").alias("donor"), "pos", "role", "digest", "words")
    # A donor meets at most block - 1 conversations.
    taken = ids.where(F.col("conv_id") % block != 0).join(lent, "donor").where(F.col("pos") <= F.col("h"))
    none = [F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("words")]
    return own.unionByName(taken.select(*turns.columns)).unionByName(ids.select("conv_id", *none))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix keys of rows sorted by (conv_id, pos); a row waits for the next one, which tells whether it is the last."""
    names = [x.split()[0] for x in CHAIN.split(", ")]
    types = {"conv_id": pa.int64(), "depth": pa.int64(), "key": pa.binary(), "parent": pa.binary(), "words": pa.int64(), "upto": pa.int64(), "last": pa.bool_()}
    state, row = hashlib.sha256(), None
    for b in batches:
        made = []
        for conv, pos, role, digest, words in zip(*[b.column(c).to_pylist() for c in ("conv_id", "pos", "role", "digest", "words")]):
            if row is not None:
                made.append((*row, conv != row[0]))
            if pos == 0:
                state = hashlib.sha256()
                row = (conv, 0, state.digest()[:KEY], None, 0, 0)
                continue
            name = role.encode()
            state.update(b"%d:" % len(name) + name + digest)
            row = (conv, row[1] + 1, state.digest()[:KEY], row[2], words, row[5] + words)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, types[n]) for n, c in zip(names, zip(*made))], names)
    if row is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], types[n]) for n, v in zip(names, (*row, True))], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) of rows sorted by (key, conv_id): ids go through one running hash, however many a key has."""
    key, state = None, None
    for b in batches:
        if not b.num_rows:
            continue
        keys, ids = b.column("key"), pc.cast(b.column("conv_id"), pa.string()).to_pylist()
        change = np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1 if len(keys) > 1 else np.zeros(0, int)
        done = []
        for at, end in zip([0, *change], [*change, len(keys)]):
            here = keys[int(at)].as_py()
            if here != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state, lead = here, hashlib.sha256(), ""
            else:
                lead = ","
            state.update((lead + ",".join(ids[at:end])).encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])


def chains(turns: DataFrame) -> DataFrame:
    """``CHAIN``: a row for every prefix of every conversation, the empty one too: the prefix's key, its parent's key, the
    words of its last turn and of all its turns, and whether it is the whole conversation."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_chained, CHAIN)


def trie(prefixes: DataFrame) -> DataFrame:
    """The nodes of the trie over ``chains``' rows (a written table: it is read three times)."""
    ends = prefixes.where("last").select("key", "conv_id", F.col("upto").alias("total"))
    sequences = ends.groupBy("key").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.min("total").alias("total"))
    inner = prefixes.where("parent is not null").select(F.col("parent").alias("key")).distinct()
    sequences = saved(sequences, "sequences")
    leaves = sequences.join(inner, "key", "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    weighted = sequences.select("conv_id", "weight", "total").join(leaves, "conv_id", "left")
    spread = prefixes.drop("last").join(weighted, "conv_id").withColumn("behind", F.col("total") - F.col("upto") + F.col("words"))
    spread = saved(spread.select("conv_id", "depth", "key", "parent", "words", "weight", "behind", F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")), "weighted-prefixes")
    nodes = spread.groupBy("key").agg(
        F.min(F.struct("conv_id", "behind")).alias("first"), F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("words").alias("words"), F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * F.col("behind")).alias("said"),
    )
    nodes = saved(nodes.select("key", "parent", "depth", "words", "n_convs", "n_leaves", "said", "first.conv_id", "first.behind"), "nodes")
    # A node is its first conversation's own: own nodes are the end of its path, and every node is one sequence's own.
    own = nodes.groupBy("conv_id").agg(F.sum("words").alias("own"))
    once = spread.select("conv_id", "key").join(own, "conv_id", "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
    once = once.groupBy("key").agg(F.sum("own").alias("all_own"), F.min(F.struct("conv_id", "own"))["own"].alias("first_own"))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    lists = ends.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digests, "key binary, ends_sha256 string")
    out = nodes.join(once, "key").join(children, "key", "left").join(lists, "key", "left")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = out.join(above, "parent", "left")
    saving = F.col("said") - (F.col("behind") + F.col("all_own") - F.col("first_own"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", saving.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """One row a node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns are put in order by turn (null first; turns of one number by role and then by the text's digest, so that repeated
    rows are turns each). A null role or text is empty. Rows without conv_id belong to no conversation. A conversation
    whose turns are all replaced by none is turnless and ends at the root. Texts of any length count whole, extra columns
    are ignored, and no rows give no nodes, not even a root. One conversation's turns are chained, and one sequence's ids
    are hashed, in one task each, since SHA-256 has an order, but as a stream: rows of some 60 and 24 bytes, sorted on disk."""
    turns = saved(ordered_turns(conversations.select("conv_id", "turn", "role", "text")), "turns")
    return trie(saved(chains(rebuilt(turns, block, most)), "prefixes"))
