"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard picked by its hash. In each
round, the members of a group look at the shards of the others and wish to move to the shard that
holds most of them, among the shards that have room for linked documents; if wishes exceed the room of
a shard, a share of them that fits is granted, picked by hash. Documents without links are no one's
neighbours: they give way, so a shard's room is its quota less its linked documents. At the end every
shard is brought to its quota exactly, documents without links moving first. Quotas differ by one at
most, so the law is ``rows``: counts are at most one apart.

Positions within a shard are made in two levels, counts of small buckets and ranks inside a bucket, so
neither a shard nor a group has to fit in one task. A group larger than a quota fills several shards.
The driver sees one number for each shard.

Null texts count as empty texts: 1 byte, checksum 0, and all of them are one group. Rows with equal
doc_id and text are interchangeable, each takes a slot of its own. Null doc_ids are kept. Extra columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlab.llm.shared import text_key, text_or_empty, written

SHARDS = 16
ROUNDS = 10


def _at(values: list, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), place + 1)


def _sums(rows: DataFrame, by: str, of: str, shards: int) -> list[int]:
    got = {r[0]: r[1] for r in rows.groupBy(by).agg(F.sum(of)).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _fraction(*columns) -> Column:
    """Between 0 and 1, from a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def propagate(linked: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``linked`` (g1, g2, pick, shard, and any others) with shards after so many rounds."""
    shards = len(quota)
    kept = linked.columns
    state = written(linked, "state")
    for r in range(rounds):
        held = state.groupBy("g1", "g2", "shard").agg(F.count(F.lit(1)).alias("n"))
        load = _sums(held, "shard", "n", shards)
        room = [max(0, q - n) for q, n in zip(quota, load, strict=True)]
        rank = F.struct("n", F.xxhash64("g1", "shard").alias("tie"), "shard")
        best = held.where(_at(room, F.col("shard")) > 0).groupBy("g1", "g2").agg(F.max(rank).alias("best"))
        wishes = (
            held.join(best, ["g1", "g2"]).where(rank < F.col("best"))
            .select("g1", "g2", "shard", F.col("best.shard").alias("to"), "n")
        )
        wishes = written(wishes, "wishes")
        asked = _sums(wishes, "to", "n", shards)
        if not any(asked):
            break
        share = [min(1.0, have / want) if want else 0.0 for have, want in zip(room, asked, strict=True)]
        granted = _fraction("pick", F.lit(r)) < _at(share, F.col("to"))
        moved = state.join(wishes.drop("n"), ["g1", "g2", "shard"], "left")
        new = F.when(F.col("to").isNotNull() & granted, F.col("to")).otherwise(F.col("shard"))
        state = written(moved.select(*[new.alias(c) if c == "shard" else F.col(c) for c in kept]), "state")
    return state


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``."""
    text = text_or_empty()
    slim = docs.select("doc_id", text.alias("text")).select(
        "doc_id", (F.octet_length("text").cast("long") + 1).alias("size"), F.crc32("text").alias("text_crc32"),
        text_key("text", 0).alias("g1"), text_key("text", 1).alias("g2"),
    ).withColumn("pick", F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), "g1")).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(5), "pick"), F.lit(shards)).cast("int")
    )
    slim = written(slim, "slim")
    groups = slim.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g1", "g2")
    # Written, so that the joins have a shuffle of their own on either side, which can be split.
    groups = written(groups, "groups")
    quota = quotas(slim.count(), shards)
    linked = propagate(slim.join(groups, ["g1", "g2"], "left_semi").select(*slim.columns), quota, rounds)
    alone = slim.join(groups, ["g1", "g2"], "left_anti").select(*slim.columns)
    # In the order of a shard, linked documents come first, so that the quota cuts off others.
    placed = linked.withColumn("alone", F.lit(False)).unionByName(alone.withColumn("alone", F.lit(True)))
    placed = placed.withColumn("b1", F.pmod("g1", F.lit(256))).withColumn("b2", F.pmod("pick", F.lit(64)))
    inside = ["shard", "alone", "b1", "b2"]
    placed = written(placed, "placed")
    buckets = placed.groupBy(*inside).agg(F.count(F.lit(1)).alias("n"))
    count = _sums(buckets, "shard", "n", shards)
    buckets = buckets.withColumn(
        "before", F.sum("n").over(Window.partitionBy("shard").orderBy("alone", "b1", "b2")) - F.col("n")
    ).drop("n")
    rank = F.row_number().over(Window.partitionBy(*inside).orderBy("g1", "g2", "pick", "doc_id")) - 1
    ranked = placed.join(buckets, inside).withColumn("at", F.col("before") + rank)
    over = [max(0, n - q) for n, q in zip(count, quota, strict=True)]
    under = [max(0, q - n) for n, q in zip(count, quota, strict=True)]
    here, own = F.col("shard"), _at(quota, F.col("shard"))
    extra = F.col("at") - own + _at([sum(over[:s]) for s in range(shards)], here)
    to, slot = here, F.col("at")
    start = 0
    for s in range(shards):
        if under[s]:
            fits = (F.col("at") >= own) & (extra >= start) & (extra < start + under[s])
            to = F.when(fits, F.lit(s)).otherwise(to)
            slot = F.when(fits, extra - start + count[s]).otherwise(slot)
            start += under[s]
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), to.cast("int").alias("shard"), slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
