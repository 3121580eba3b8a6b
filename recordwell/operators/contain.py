"""Names that contain other names, as an equi-join instead of a nested loop.

Only substrings as long as some needle can match, so every haystack name is exploded
into its substrings of just those lengths and joined on their hash; the text itself is
compared afterwards. Work is linear in the haystack text; nothing pairs all with all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.text import let
from recordwell.operators.edits import name_table
from recordwell.session import broadcast_if_small, cut_lineage


def needle_lengths(needles: DataFrame, column: str) -> list[int]:
    """The distinct needle lengths: at most one number per possible name length."""
    rows = needles.select(F.length(column).alias("n")).distinct().collect()
    return sorted(r.n for r in rows) or [1]


def substring_keys(text: Column, lengths: Sequence[int]) -> Column:
    """Hashes of the distinct substrings of the given lengths."""
    sizes = F.array(*[F.lit(s) for s in lengths])

    def keys(word: Column) -> Column:
        n = F.length(word)
        fitting = F.filter(sizes, lambda s: s <= n)
        return F.flatten(F.transform(fitting, lambda size: F.transform(
            F.sequence(F.lit(1), n - size + 1), lambda i: F.xxhash64(word.substr(i, size)))))

    return F.array_distinct(let(text, keys))


def containment_pairs(hay: DataFrame, hay_name: str, needles: DataFrame, needle_name: str) -> DataFrame:
    """Pairs of rows whose haystack name contains the needle name (each pair once).

    Give distinct needle names; haystack names should be distinct too, copies are
    joined back by the caller. The needles are written once, because their lengths and
    number are looked at before the join.
    """
    needles = cut_lineage(needles.filter(F.length(needle_name) > 0))
    lengths = needle_lengths(needles, needle_name)
    small = needles.withColumn("_nkey", F.xxhash64(needle_name))
    exploded = hay.select("*", F.explode(substring_keys(F.col(hay_name), lengths)).alias("_hkey"))
    hit = (F.col("_hkey") == F.col("_nkey")) & F.col(hay_name).contains(F.col(needle_name))
    return exploded.join(broadcast_if_small(small), hit).drop("_hkey", "_nkey")


def containers(names: DataFrame) -> DataFrame:
    """Broken names of a name table that contain the shorter name of a row that is whole (column ``bad``)."""
    bad = names.filter(F.col("broken_id").isNotNull()).select(F.col("name").alias("bad"))
    valid = names.filter(F.col("donor").isNotNull() & (F.col("name") != "")).select(F.col("name").alias("valid"))
    longer = F.octet_length("bad") > F.octet_length("valid")
    return containment_pairs(bad, "bad", valid, "valid").filter(longer).select("bad").distinct()


def drop_containers(df: DataFrame, name: str, quality: str, id_col: str = "id") -> DataFrame:
    """Remove rows without ``quality`` whose name contains the shorter name of a row that has it."""
    doomed = containers(name_table(df, name, [quality], id_col))
    return df.join(doomed, F.col(quality).isNull() & (F.col(name) == F.col("bad")), "left_anti")


def link_by_containment(left: DataFrame, needle: str, left_id: str, right: DataFrame, hay: str,
                        right_id: str, right_order: str, key=F.lower) -> DataFrame:
    """For each left row, the first right row whose name contains the left text.

    ``key`` normalises both texts (lower case by default). Needles are made distinct
    first, so a text that a third of the rows share is matched once. Returns
    (right_id, left_id) links.
    """
    wanted = left.filter(F.col(needle).isNotNull()).select(F.col(left_id).alias("_left"), key(F.col(needle)).alias("_needle"))
    needles = wanted.select("_needle").distinct()
    hays = (
        right.filter(F.col(hay).isNotNull())
        .select(key(F.col(hay)).alias("_hay"), F.col(right_id).alias("_right"), F.col(right_order).alias("_order"))
        .groupBy("_hay").agg(F.min(F.struct("_order", "_right")).alias("_first"))
    )
    first = (
        containment_pairs(hays, "_hay", needles, "_needle")
        .groupBy(F.col("_needle").alias("_text")).agg(F.min("_first").alias("_first"))
    )
    return wanted.join(first, F.col("_needle") == F.col("_text")).select(
        F.col("_first._right").alias(right_id), F.col("_left").alias(left_id)
    )
