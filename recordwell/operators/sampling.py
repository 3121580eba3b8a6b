"""Reproducible k-of-n links without pairing every row with every id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.text import let
from recordwell.operators.keys import dense_id
from recordwell.session import broadcast_if_small


def hash_number(*parts: Column) -> Column:
    """A number below 2^60 that depends on the parts alone (first digits of their md5)."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_between(low: Column | int, high: Column | int, *parts: Column) -> Column:
    """A reproducible whole number in [low, high]."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return (low + F.pmod(hash_number(*parts), high - low + 1)).cast("bigint")


def _prime_from(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def sample_positions(row: Column, k: Column, n: int, seed: str) -> Column:
    """``k`` distinct positions in 0..n-1 (all of them if k >= n).

    Walks the numbers below the first prime p >= n from a hashed start in hashed steps,
    which meets each number once, and skips the few that are n or more.
    """
    p = _prime_from(n)
    draw = F.struct(
        F.pmod(hash_number(F.lit(seed), F.lit("start"), row), F.lit(p)).alias("start"),
        (F.pmod(hash_number(F.lit(seed), F.lit("step"), row), F.lit(p - 1)) + 1).alias("step"),
        F.least(k.cast("int"), F.lit(n)).alias("count"),
    )

    def walk(d: Column) -> Column:
        steps = F.sequence(F.lit(0), d["count"] + (p - n) - 1)
        met = F.transform(steps, lambda t: F.pmod(d["start"] + t * d["step"], F.lit(p)))
        inside = F.slice(F.filter(met, lambda x: x < n), F.lit(1), d["count"])
        return F.when(d["count"] > 0, inside).otherwise(F.array().cast("array<bigint>"))

    return let(draw, walk)


def sample_links(left: DataFrame, left_id: str, k: Column, right: DataFrame, right_id: str,
                 seed: str, measure: tuple[str, int, int] | None = None,
                 names: tuple[str, str] | None = None) -> DataFrame:
    """For each left row, ``k`` distinct right ids and optionally a bounded measure.

    ``right`` has one row per id. Ids that already run 1..n need no join at all; others
    are numbered once and joined by position.
    """
    left_name, right_name = names or (left_id, right_id)
    domain = right.agg(
        F.count("*").alias("n"), F.min(right_id).alias("low"), F.max(right_id).alias("high")
    ).first()
    # without ids there is nothing to draw: one place, and none taken
    k = k if domain.n else F.lit(0)
    drawn = left.select(
        F.col(left_id).alias("_left"), sample_positions(F.col(left_id), k, max(domain.n, 1), seed).alias("_places")
    ).select(F.col("_left").alias(left_name), F.explode("_places").alias("_at"))
    if domain.low == 1 and domain.high == domain.n:
        links = drawn.withColumn(right_name, (F.col("_at") + 1).cast(right.schema[right_id].dataType))
    else:
        numbered = dense_id(right.select(right_id), [right_id], "_place").select(
            (F.col("_place") - 1).alias("_pos"), F.col(right_id).alias(right_name)
        )
        links = drawn.join(broadcast_if_small(numbered), F.col("_at") == F.col("_pos"))
    columns = [left_name, right_name]
    if measure:
        name, low, high = measure
        links = links.withColumn(
            name, hash_between(low, high, F.lit(seed), F.lit(name), F.col(left_name), F.col(right_name))
        )
        columns.append(name)
    return links.select(*columns)
