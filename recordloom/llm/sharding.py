"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: a start and a step, both from a hash
of its name. Shards take turns, each claiming its first slot still free, until the table is full. A key hashes to a
slot and the slot names the shard, so placing a row is one lookup; shards get equal slots up to one, and
adding or removing a shard moves few slots besides its own.

The table has ``slots`` rows whatever the size of the data, which is what allows broadcasting it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 2039  # prime, over 100 times the shards it is meant for


def number(text: Column) -> Column:
    """32 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``slot, shard`` for all slots, made by one fold over the claims.

    ``slots`` must be prime, so that every step visits all slots. The cost grows with its square.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than the slots")
    if slots < 2 or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    names = F.array(*map(F.lit, shards))
    named = spark.range(1).select(
        names.alias("names"),
        F.transform(names, lambda name: number(F.concat(F.lit("start:"), name)) % slots).alias("starts"),
        F.transform(names, lambda name: number(F.concat(F.lit("step:"), name)) % (slots - 1) + 1).alias("steps"),
    )

    def claim(state: Column, turn: Column) -> Column:
        shard = (turn % len(shards)).cast("int")
        start, step = F.get("starts", shard), F.get("steps", shard)
        wanted = F.transform(
            F.sequence(F.get(state["next"], shard), F.lit(slots - 1)),
            lambda at: F.struct(at.alias("at"), ((start + at * step) % slots).cast("int").alias("slot")),
        )
        free = F.filter(wanted, lambda x: F.get(state["taken"], x["slot"]) < 0)
        # the claim is bound to a name first, or it would be searched anew for every slot
        claimed = F.transform(F.slice(free, 1, 1), lambda found: taken_by(state, shard, found))
        return F.get(claimed, F.lit(0))

    def taken_by(state: Column, shard: Column, found: Column) -> Column:
        return F.struct(
            F.transform(state["taken"], lambda old, slot: F.when(slot == found["slot"], shard).otherwise(old)).alias("taken"),
            F.transform(state["next"], lambda old, at: F.when(at == shard, found["at"] + 1).otherwise(old)).alias("next"),
        )

    empty = F.struct(
        F.array_repeat(F.lit(-1), slots).alias("taken"), F.array_repeat(F.lit(0), len(shards)).alias("next")
    )
    filled = F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), empty, claim)["taken"]
    return (
        named.select("names", F.posexplode(filled).alias("slot", "owner"))
        .select("slot", F.get("names", F.col("owner")).alias("shard"))
    )


def place(rows: DataFrame, key: Column, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of those names are replaced.

    A NULL key is placed like an empty one. Equal keys share a shard, so a key that is to be spread needs
    a second part (such as the document's id) in ``key``.
    """
    table = F.broadcast(lookup_table(rows.sparkSession, shards, slots))
    slot = (number(F.coalesce(key.cast("string"), F.lit(""))) % slots).cast("int")
    return rows.drop("shard").withColumn("slot", slot).join(table, "slot").select(
        *[c for c in rows.columns if c not in ("slot", "shard")], "slot", "shard"
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, each written by several tasks at any size."""
    placed.write.partitionBy("shard").parquet(path)
