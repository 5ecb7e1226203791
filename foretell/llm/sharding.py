"""Sharding by jump consistent hashing, in native expressions.

``jump`` maps a 64-bit key to one of ``shards`` buckets without a table: a linear
congruential generator seeded with the key draws the shard counts at which the key would
have moved, and the last draw below ``shards`` is its shard (Lamping and Veach, 2014).
Going from n to n + 1 shards moves a key only into the new shard, for 1 / (n + 1) of the keys.

Defined results: a null key counts as 0, a null text as empty (size 8, checksum 0).  Equal
rows get the same shard and a slot each.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import running_start

# fixed values: the generator of the published algorithm
MULTIPLIER = 2862933555777941757
MODULUS = 1 << 64
#: parts in which the slots of one shard are numbered; bounds what one task sorts
PARTS = 1024


def _unsigned(key: Column) -> Column:
    """A long as a number from 0 to 2**64 - 1."""
    d = key.cast("decimal(20,0)")
    return F.when(key < 0, d + F.expr(f"{MODULUS}BD")).otherwise(d).cast("decimal(20,0)")


def jump(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of a long key; null counts as 0."""
    if shards < 1:
        raise ValueError("there must be a shard")

    def step(state, _):
        k = ((state["k"] * F.expr(f"{MULTIPLIER}BD") + F.expr("1BD")) % F.expr(f"{MODULUS}BD")).cast("decimal(20,0)")
        high = F.floor(k / F.expr(f"{1 << 33}BD")).cast("double")
        j = F.floor((state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (high + 1.0))).cast("long")
        moved = F.struct(k.alias("k"), state["j"].alias("b"), j.alias("j"))
        return F.when(state["j"] < shards, moved).otherwise(state)

    start = F.struct(
        _unsigned(F.coalesce(key, F.lit(0).cast("long"))).alias("k"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
    )
    # the first draw starts from j = 0 for b = -1: state j holds the next candidate, b the last one below shards
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def with_shards(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """Adds the shard of each row and its shard with one more; no rows move between tasks."""
    k = F.col(key).cast("long")
    return df.withColumns({shard: jump(k, shards), grown: jump(k, shards + 1)})


def numbered(rows: DataFrame, shard: str = "shard", name: str = "slot") -> DataFrame:
    """Adds a gapless slot from 0 within each shard.

    Equal rows are counted first (map-side) and spread over their slots at the end, so one
    row that makes up a third of the table is one row in the shuffle.  A shard is numbered in
    ``PARTS`` parts by a hash of the whole row.
    """
    columns = rows.columns
    counted = (
        rows.groupBy(*columns).agg(F.count("*").alias("_n"))
        .withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(PARTS)))
    )
    placed = running_start(counted, shard, "_part", columns, "_n", "_start")
    at = F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("_n") - 1))
    return placed.select(*columns, at.alias(name))


def sharded(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every document: key, size, checksum, law, shard, slot and grown shard."""
    raw = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    digest = docs.select(
        F.col(key).cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    placed = numbered(with_shards(digest, "doc_id", shards))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), "grown_shard")
