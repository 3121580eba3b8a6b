"""Sharding by weighted rendezvous hashing.

Every shard draws a number for a key, from a hash of both, and the key goes to the best draw; a shard
of twice the weight wins twice as often. A new shard only takes keys that it wins, and a removed one only
gives up its own, so few records move.

Slots number a shard's rows from 0 without gaps, in the order of a hash of (key, size, checksum). The
order is cut into buckets of the hash, which are counted and ranked apart, so no task holds a shard.
Equal rows are first counted together and dealt out in chunks, so a key that holds a third of all rows
neither fills a bucket nor a task.

Defined results: a null key is one key of its own and has a shard; a null text has size 1 and checksum 0.
Rows equal in key and text have slots of their own, in either order. Empty tables give empty results.
Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordwell.session import cut_lineage

#: Rows of one chunk of equal rows, and buckets over all shards.
CHUNK, BUCKETS = 100_000, 32768


def _draw(*parts: Column) -> Column:
    """52 bits of a hash of the parts, a long from 0."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def _text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("\0"))


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: the lowest of -ln(draw) / weight, then the lowest number."""
    draws = [
        F.struct(
            (-F.log((_draw(_text(key), F.lit(str(shard))) + F.lit(0.5)) / F.lit(2.0 ** 52)) / F.lit(float(weight))).alias("d"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in weights.items() if weight > 0
    ]
    if not draws:
        raise ValueError("no shard has a weight")
    return F.array_min(F.array(*draws))["shard"]


def assign_shards(
    docs: DataFrame, weights: Mapping[int, float], key: str = "doc_id", text: str = "text",
    grown: Mapping[int, float] | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """One row per row of ``docs``: (key, size, text_crc32, shard, slot[, grown_shard])."""
    shards = {"shard": rendezvous(F.col("key"), weights)}
    if grown is not None:
        shards["grown_shard"] = rendezvous(F.col("key"), grown)
    rows = docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("crc"),
    )
    counted = rows.groupBy("key", "size", "crc").agg(F.count(F.lit(1)).alias("copies"))
    buckets = max(64, BUCKETS // len(weights))
    chunks = cut_lineage(counted.withColumns(shards).select(
        "*", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {chunk}").cast("int"))).alias("chunk")
    ).withColumn("n", F.least(F.lit(chunk), F.col("copies") - F.col("chunk") * chunk)).withColumn(
        "place", _draw(_text(F.col("key")), F.col("size").cast("string"), F.col("crc").cast("string"), F.col("chunk").cast("string"))
    ).withColumn("bucket", F.shiftright(F.shiftright("place", 20) * F.lit(buckets), 32)).drop("copies"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most ``buckets`` rows a shard
    starts = chunks.groupBy("shard", "bucket").agg(F.sum("n").alias("rows")).select(
        F.col("shard").alias("_shard"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    starts = F.broadcast(starts) if len(weights) * buckets <= 2 * BUCKETS else starts
    within = Window.partitionBy("shard", "bucket").orderBy("place", "key", "size", "crc", "chunk")
    placed = chunks.withColumn("end", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0))).join(
        starts, (F.col("shard") == F.col("_shard")) & (F.col("bucket") == F.col("_bucket")))
    first = F.col("start") + F.col("end") - F.col("n")
    return placed.select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"), *(["grown_shard"] if grown is not None else []),
    )
