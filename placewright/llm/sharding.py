"""Balanced label propagation: documents that share a link key move to one shard, under capacity quotas.

Members of a link key's group are dealt at random first, but for groups of more than an eighth of a shard (a bounded
number), which begin whole, each where most room is left. In each round a group asks for the shard with most of its
members among those that can take all of it, else for another one that can; if there is none, its members ask for the
shard with most of them one by one. Of the requests to a shard those are granted, whole groups first and then in an order
of hashes, that its free capacity holds. Only groups larger than a shard are cut, into atoms that fit. At last documents
are levelled to the exact quotas: those that no link holds leave shards with too many first, those of large groups last.
Everything that is gathered is counts a (group, shard) or a (shard, bucket), and the large groups' sizes; documents
themselves are joined, never collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._io import saved

#: Steps of the priority histogram by which requests are granted.
STEPS = 1024


def atoms_of(keys: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """(key, members, atoms): the groups of two and more, and into how many atoms each is cut: one, if a shard holds it,
    else of about an eighth of a shard, which fit beside others."""
    whole, most = max(2, n_rows // shards), max(2, n_rows // shards // 8)
    groups = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return groups.withColumn("atoms", F.when(F.col("members") <= whole, 1).otherwise(F.ceil(F.col("members") / most)).cast("int"))


def seeds(flow: DataFrame, quota: int, shards: int) -> DataFrame:
    """(key, atom, seed): where the atoms of more than an eighth of a shard begin, the largest first, each in the shard
    with most room. There are at most 16 * shards of them, as together they are no more than all rows."""
    large = flow.groupBy("key", "atom").agg(F.sum("n").alias("m")).where(F.col("m") * 8 > quota)
    room = [quota] * shards
    out = []
    for r in sorted(large.collect(), key=lambda r: (-r["m"], r["key"], r["atom"])):
        to = max(range(shards), key=room.__getitem__)
        if room[to] >= r["m"]:
            room[to] -= r["m"]
            out.append((r["key"], r["atom"], to))
    return flow.sparkSession.createDataFrame(out, "key string, atom int, seed int")


def propagate(flow: DataFrame, quota: int, shards: int, rounds: int) -> DataFrame:
    """(key, atom, was, shard, n) rows, moved: members of an atom that began in shard ``was`` are in ``shard``.

    ``quota`` bounds what linked members may fill of any shard; a request is an atom's, or one row's n members."""
    for turn in range(rounds):
        load = {r["shard"]: r["load"] for r in flow.groupBy("shard").agg(F.sum("n").alias("load")).collect()}  # a row a shard
        left = [max(0, quota - load.get(s, 0)) for s in range(shards)]
        room = F.array(*[F.lit(x).cast("long") for x in left])
        here = flow.groupBy("key", "atom", "shard").agg(F.sum("n").alias("m"))
        atoms = here.groupBy("key", "atom").agg(F.sum("m").alias("size"), F.sort_array(F.collect_list(F.struct((-F.col("m")).alias("less"), "shard"))).alias("at"))  # at most ``shards`` entries
        takes = F.get(F.filter("at", lambda x: F.get(room, x["shard"]) >= F.col("size") + x["less"]), F.lit(0))["shard"]
        empty = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.get(room, s) >= F.col("size"))
        other = F.get(empty, F.pmod(F.xxhash64("key", "atom", F.lit(turn)), F.greatest(F.size(empty), F.lit(1))).cast("int"))
        whole = F.coalesce(takes, other)
        split = saved(atoms.where(F.size("at") > 1), "split-atoms")
        if split.isEmpty():
            break
        best = split.select("key", "atom", whole.isNotNull().alias("whole"), F.coalesce(whole, F.get("at", F.lit(0))["shard"]).alias("to"))
        free = flow.sparkSession.range(shards).select(F.col("id").cast("int").alias("to"), F.get(room, F.col("id").cast("int")).alias("free"))
        alone = F.lit(STEPS) + F.pmod(F.xxhash64("key", "atom", "was"), F.lit(STEPS))  # a part of a group may go ahead
        step = F.when(F.col("whole"), F.pmod(F.xxhash64("key", "atom"), F.lit(STEPS))).otherwise(alone).cast("int")
        asked = flow.join(best, ["key", "atom"], "left").withColumn("step", step)
        sums = asked.where("shard <> to").groupBy("to", "step").agg(F.sum("n").alias("asked"))
        upto = sums.withColumn("upto", F.sum("asked").over(W.partitionBy("to").orderBy("step")))  # 2 * STEPS rows a shard
        granted = upto.join(F.broadcast(free), "to").where("upto <= free").groupBy("to").agg(F.max("step").alias("limit"))
        moved = asked.join(F.broadcast(granted), "to", "left")  # a row a shard
        flow = moved.select("key", "atom", "was", F.when(F.col("step") <= F.col("limit"), F.col("to")).otherwise(F.col("shard")).alias("shard"), "n")
        flow = saved(flow.groupBy("key", "atom", "was", "shard").agg(F.sum("n").alias("n")), "flow")
    return flow


def assign(docs: DataFrame, shards: int = 16, rounds: int = 6, text: str = "text", doc_id: str = "doc_id", link: str | None = None, seed: int = 7) -> DataFrame:
    """One row a row of ``docs``: doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null), link_key.

    Shards hold N div ``shards`` rows each, the first N mod ``shards`` one more; slots run from 0 in each. Documents are
    linked by equal values of column ``link`` (default: equal texts, by a 128-bit digest); a null link links nothing.
    size is the UTF-8 bytes of the text plus 1; null texts count as empty, and as equal. Null and repeated doc_ids have
    a row each; extra columns are ignored; no rows give no rows."""
    text_col = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(text_col.cast("binary")) if link is None else F.col(link).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(text_col) + 1).cast("long").alias("size"), F.crc32(text_col.cast("binary")).alias("text_crc32"), key.alias("key"))
    rows = rows.withColumn("was", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(seed)), F.lit(shards)).cast("int"))
    rows = saved(rows, "shard-rows")
    n_rows = rows.count()
    groups = saved(atoms_of(rows.where("key is not null"), n_rows, shards), "linked-groups")
    # Only linked documents take part; copies of a group are told apart by a hash, which deals them over its atoms.
    deal = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.col("atoms")).cast("int")
    linked = rows.join(groups, "key", "left").select("doc_id", "size", "text_crc32", "key", "was", F.when(F.col("atoms").isNotNull(), deal).alias("atom"))
    linked = saved(linked, "linked-rows")
    quota = max(1, n_rows // shards)
    flow = saved(linked.where("atom is not null").groupBy("key", "atom", "was").agg(F.count(F.lit(1)).alias("n")), "flow")
    flow = flow.join(F.broadcast(seeds(flow, quota, shards)), ["key", "atom"], "left").select("key", "atom", "was", F.coalesce("seed", "was").alias("shard"), "n", F.col("seed").isNotNull().alias("seeded"))
    large = flow.where("seeded").select("key", "atom").distinct().withColumn("large", F.lit(True))
    flow = propagate(flow.drop("seeded"), quota, shards, rounds)
    placed = linked.join(flow.select("key", "atom", "was", "shard"), ["key", "atom", "was"], "left").withColumn("shard", F.coalesce("shard", "was"))
    placed = placed.join(F.broadcast(large), ["key", "atom"], "left")
    return level(placed, n_rows, shards)


def level(placed: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """The exact quotas and the slots. Rows are ranked in (shard, bucket), buckets in the shard: those of large groups
    first, then other linked ones."""
    buckets = max(1, min(4096, n_rows // shards // 20_000 + 1))
    grade = F.when(F.col("atom").isNull(), 2).when(F.col("large"), 0).otherwise(1)
    bucket = grade * buckets + F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int")
    placed = placed.withColumn("bucket", bucket)
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))  # 3 * buckets rows a shard
    quota = (F.lit(n_rows // shards) + (F.col("shard") < n_rows % shards).cast("int")).alias("quota")
    all_shards = placed.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    fill = all_shards.join(counts.groupBy("shard").agg(F.sum("n").alias("n")), "shard", "left").select("shard", F.coalesce("n", F.lit(0)).alias("n"), quota)
    upto = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # a row a shard
    over, under = F.greatest(F.col("n") - F.col("quota"), F.lit(0)), F.greatest(F.col("quota") - F.col("n"), F.lit(0))
    fill = fill.select("shard", "n", "quota", F.coalesce(F.sum(over).over(upto), F.lit(0)).alias("over0"), under.alias("under"), F.coalesce(F.sum(under).over(upto), F.lit(0)).alias("under0"))
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    ranked = placed.withColumn("in_bucket", F.row_number().over(inside) - 1)
    ranked = ranked.join(F.broadcast(counts.select("shard", "bucket", "earlier")), ["shard", "bucket"]).join(F.broadcast(fill.select("shard", "quota", "over0")), "shard")
    ranked = ranked.withColumn("rank", F.col("in_bucket") + F.col("earlier"))
    leaving = F.when(F.col("rank") >= F.col("quota"), F.col("over0") + F.col("rank") - F.col("quota")).alias("leaving")
    ranked = ranked.select("doc_id", "size", "text_crc32", "key", "shard", "rank", leaving)
    room = fill.where("under > 0").select("under0", "under", F.col("shard").alias("to"), "n").orderBy("under0").collect()
    entries = [F.struct(*[F.lit(r[c]).cast("long").alias(c) for c in ("under0", "under", "to", "n")]) for r in room]  # at most ``shards``
    ranked = ranked.withColumn("room", F.array(*entries) if entries else F.array().cast("array<struct<under0:long,under:long,to:long,n:long>>"))
    fits = F.filter("room", lambda x: (x["under0"] <= F.col("leaving")) & (F.col("leaving") < x["under0"] + x["under"]))
    goes = F.get(fits, F.lit(0))
    shard = F.when(F.col("leaving").isNull(), F.col("shard")).otherwise(goes["to"])
    slot = F.when(F.col("leaving").isNull(), F.col("rank")).otherwise(goes["n"] + F.col("leaving") - goes["under0"])
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("key").alias("link_key"))
