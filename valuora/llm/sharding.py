"""Sharding by jump consistent hashing, in DataFrame expressions only.

A key's shard is found by the jump recurrence on a 64-bit linear congruential
generator seeded with the key's hash; no ring or table is kept.  With one more
shard a row either stays or moves to the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuora.llm.common import materialize

#: Multiplier of the generator (fixed value of the published algorithm).
MULTIPLIER = 2862933555777941757
SLOT_BUCKETS = 65536


def _wide(x: int | Column) -> Column:
    return (F.lit(str(x)) if isinstance(x, int) else x).cast("decimal(38,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (0-based int) of a 64-bit integer key.

    The generator's product fits 38 decimal digits, so it is taken exactly and
    reduced modulo 2^64.  Every step moves at least one shard up, so ``shards``
    steps suffice; later ones leave the state as it is.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    modulus, half = _wide(1 << 64), _wide(1 << 33)
    state = F.struct(F.pmod(_wide(key), modulus).alias("k"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, _: Column) -> Column:
        k = F.pmod(acc["k"] * _wide(MULTIPLIER) + _wide(1), modulus).cast("decimal(38,0)")
        top = F.floor(k / half).cast("double") + 1.0
        moved = F.struct(
            k.alias("k"), acc["j"].alias("b"),
            F.floor((acc["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / top)).cast("long").alias("j"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), state, step, lambda acc: acc["b"].cast("int"))


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: 1), ``slot`` counts the
    rows of a shard gapless from 0, ``grown_shard`` is the shard with one more.
    The shard depends on doc_id and the number of shards alone (a null doc_id is
    one more key).  Slots come from the sizes of hash buckets inside a shard plus
    the place inside the bucket, so no task holds a whole shard.
    """
    key = F.xxhash64(F.col(id_col))
    buckets = max(1, SLOT_BUCKETS // shards)
    crc = F.crc32(F.col(text_col).cast("binary"))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(crc, F.lit(0)).cast("long").alias("text_crc32"),
            jump_hash(key, shards).alias("shard"),
            jump_hash(key, shards + 1).alias("grown_shard"),
            F.pmod(F.xxhash64(F.lit(5), F.col(id_col), crc), F.lit(buckets)).cast("int").alias("_bucket"),
        ),
        "shard-rows",
    )
    counts = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = counts.select(
        "shard", "_bucket",
        (F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    # at most shards * buckets <= 65,536 rows (or one a shard): a proven bound
    before = F.broadcast(before) if shards * buckets <= SLOT_BUCKETS else before
    place = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("_place", place).join(before, ["shard", "_bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_place")).cast("long").alias("slot"), "grown_shard")
