"""Filling and merging: lookups, gap filling, found attributes, keyed actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.text import fold


def attach(df: DataFrame, right: DataFrame, key: Column, right_key: str) -> DataFrame:
    """Left join to a table with one row per key, safe for a key that a third of the rows share.

    The join runs on a copy of the key that is dropped afterwards. Nothing downstream
    can then rely on rows being placed by that key, which leaves adaptive execution free
    to split the hot partition, and a later grouping by the same key reduces map-side
    before it moves rows.
    """
    return df.withColumn("_copy", key).join(right, F.col("_copy") == F.col(right_key), "left").drop("_copy")


def lookup_key(df: DataFrame, dimension: DataFrame, on: str, id_col: str = "id",
               target: str = "place_id") -> DataFrame:
    """Add the dimension's id for the row's key; no match gives null, no row is lost.

    The dimension has one row per key.
    """
    right = dimension.select(F.col(on).alias("_key"), F.col(id_col).alias(target))
    return attach(df, right, F.col(on), "_key").drop("_key")


def first_donor(df: DataFrame, key: Column, attributes: Sequence[str], order_by: str) -> DataFrame:
    """Per key, the attributes of the first row that has the first attribute filled.

    Partially aggregated before the shuffle: one row per key and task travels.
    """
    donors = df.filter(F.col(attributes[0]).isNotNull()).select(
        key.alias("_key"), F.col(order_by).alias("_order"), *attributes
    ).filter(F.col("_key").isNotNull() & (F.col("_key") != ""))
    return donors.groupBy("_key").agg(
        F.min_by(F.struct(*attributes), "_order").alias("_donor")
    )


def gap_fill(df: DataFrame, key: str, attributes: Sequence[str], order_by: str) -> DataFrame:
    """Fill each null attribute on its own from the first known row of the same key."""
    donor = first_donor(df, F.col(key), attributes, order_by)
    joined = attach(df, donor, F.col(key), "_key")
    return joined.select(*[
        F.coalesce(F.col(c), F.col("_donor")[c]).alias(c) if c in attributes else F.col(c)
        for c in df.columns
    ])


def self_fill(df: DataFrame, key: str, attributes: Sequence[str], order_by: str = "id",
              only: Column | None = None) -> DataFrame:
    """Where the first attribute is null, take all attributes from the lowest donor of the key.

    Keys are compared without case and accents; ``only`` limits which rows are filled.
    """
    donor = first_donor(df, fold(key), attributes, order_by)
    joined = attach(df, donor, fold(key), "_key")
    take = F.col(attributes[0]).isNull() & F.col("_donor").isNotNull()
    if only is not None:
        take = take & F.coalesce(only, F.lit(False))
    return joined.select(*[
        F.when(take, F.col("_donor")[c]).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c)
        for c in df.columns
    ])


def fill_missing(df: DataFrame, found: DataFrame, key: str, fields: Sequence[str],
                 zero_fields: Sequence[str] = ("beds",)) -> DataFrame:
    """Take found values only where the row has none (null or empty; zero for numbers).

    ``found`` has at most one row per key; empty or zero findings fill nothing.
    """
    right = found.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = df.join(right, df[key] == right["_key"], "left")

    def merged(f: str) -> Column:
        blank = F.lit(0) if f in zero_fields else F.lit("")
        old, new = F.col(f), F.col(f"_{f}")
        return F.coalesce(F.nullif(old, blank), F.nullif(new, blank), old).alias(f)

    return joined.select(*[merged(c) if c in fields else df[c] for c in df.columns])


def apply_actions(df: DataFrame, actions: DataFrame, id_col: str = "id",
                  columns: Sequence[str] = ("city", "region", "province"),
                  order_by: str | None = None) -> DataFrame:
    """Apply UPDATE and DELETE records by id; unknown actions change nothing.

    Records for one id are merged before the join: any DELETE removes the row, else
    the last UPDATE by ``order_by`` sets the columns, nulls included.
    """
    rank = F.col(order_by) if order_by else F.lit(0)
    update = F.col("action") == "UPDATE"
    merged = actions.filter(F.col("action").isin("UPDATE", "DELETE")).groupBy(
        F.col(id_col).alias("_id")
    ).agg(
        F.bool_or(F.col("action") == "DELETE").alias("_delete"),
        F.max_by(F.when(update, F.struct(*columns)), F.when(update, F.struct(rank, *columns))).alias("_new"),
    )
    joined = df.join(merged, df[id_col] == merged["_id"], "left").filter(
        ~F.coalesce(F.col("_delete"), F.lit(False))
    )
    return joined.select(*[
        F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(df[c]).alias(c)
        if c in columns else df[c]
        for c in df.columns
    ])


def split_by_cache(rows: DataFrame, cache: DataFrame, key: str, cached: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(hits with the cached columns, misses)."""
    known = cache.select(F.col(key).alias("_key"), *cached)
    hits = rows.join(known, rows[key] == known["_key"], "inner").drop("_key")
    misses = rows.join(known.select("_key"), rows[key] == F.col("_key"), "left_anti")
    return hits, misses
