"""Row identity: keep-first, survivors, priority unions, dense ids, batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from recordwell.functions.text import let

#: Most buckets a dense numbering is split into; bounds what the driver sees.
MAX_BUCKETS = 8192


def _columns(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def keep_best(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column],
              null_keys: str = "group") -> DataFrame:
    """One row per key: the first by ``order_by``.

    A rank filtered to 1 makes Spark drop the losers of every map task before the
    shuffle, so a key that holds a third of all rows sends one row per task.
    ``null_keys``: ``group`` treats null as a key of its own, ``keep`` keeps every row
    whose first key is null, ``drop`` removes them.
    """
    keys = _columns(keys)
    order = _columns(order_by)
    if null_keys == "drop":
        df = df.filter(keys[0].isNotNull())
    elif null_keys == "keep":
        lone = F.when(keys[0].isNull(), F.struct(*order))
        keys = [*keys, lone]
    elif null_keys != "group":
        raise ValueError(f"unknown null_keys {null_keys!r}")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def smart_dedup(df: DataFrame, key: str, quality: str, id_col: str = "id") -> DataFrame:
    """One row per key: one with ``quality`` filled if there is any, then the lowest id.

    Rows without a key equal nothing and all stay.
    """
    return keep_best(df, [key], [F.col(quality).isNull(), F.col(id_col)], null_keys="keep")


def one_per_key(df: DataFrame, key: str, columns: Sequence[str], order_by: str) -> DataFrame:
    """One row per key with the columns of its first row (partial aggregation, no window)."""
    picked = df.groupBy(key).agg(F.min_by(F.struct(*columns), order_by).alias("_row"))
    return picked.select(key, "_row.*")


def priority_union(frames: Sequence[DataFrame], keys: Sequence[str], order_by: str) -> DataFrame:
    """Union by name, absent columns null, one row per key: earlier frames win, then order."""
    tagged = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(frames)]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return keep_best(whole, keys, ["_source", order_by]).drop("_source")


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def minus_ids(df: DataFrame, removed: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is not among the removed ones."""
    return df.join(removed.select(id_col), id_col, "left_anti")


def _bucket_of(key: Column, splits: Column, n: int) -> Column:
    """How many of the ``n`` ascending splits are at or below ``key`` (binary search)."""
    steps, step = [], 1
    while step <= n:
        steps.append(step)
        step *= 2
    if not steps:
        return F.lit(0)

    jumps = F.array(*[F.lit(s) for s in reversed(steps)])

    def search(k: Column) -> Column:
        def probe(at: Column, jump: Column) -> Column:
            ahead = at + jump
            return F.when((ahead <= n) & (F.element_at(splits, ahead) <= k), ahead).otherwise(at)

        return F.aggregate(jumps, F.lit(0), probe)

    return let(key, search)


def dense_id(df: DataFrame, order_by: Sequence[str | Column], id_col: str = "id",
             rows_per_bucket: int = 500_000, sample_rows: int = 20_000) -> DataFrame:
    """Number the rows ``1..n`` in the order of ``order_by``, which must be unique.

    No task ever sees all rows. A hash sample of the order key gives split points; the
    rows of each bucket are counted (one pre-aggregated pass over the key alone); the
    id is the bucket's offset plus the rank inside it. The splits only decide how even
    the buckets are, never the result, and a recomputed task gives the same ids.

    Runs three passes over the key columns while the plan is built: cut the lineage of
    a costly ``df`` first.
    """
    spark = df.sparkSession
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_columns(order_by))])
    keys = df.select(key.alias("k"))
    rows = keys.count()
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_bucket))
    wanted = min(wanted, MAX_BUCKETS, max(rows, 1))
    every = max(1, rows // max(sample_rows, 20 * wanted))
    sample = keys.filter(F.pmod(F.xxhash64("k"), F.lit(every)) == 0).orderBy("k").collect()
    cuts = sorted({len(sample) * i // wanted for i in range(1, wanted)} - {0})
    kind = keys.schema["k"].dataType
    # split points are a few thousand keys at most, carried as one literal array
    literal = F.array(*[
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(sample[i].k, kind.fields)])
        for i in cuts
    ])
    bucket = _bucket_of(key, literal, len(cuts))
    sizes = {r.b: r.n for r in df.select(bucket.alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for b in range(len(cuts) + 1):
        offsets.append(total)
        total += sizes.get(b, 0)
    window = W.partitionBy("_bucket").orderBy(*_columns(order_by))
    numbered = df.withColumn("_bucket", bucket)
    return numbered.withColumn(
        id_col,
        F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_bucket") + 1)
        + F.row_number().over(window),
    ).drop("_bucket")


def batch_of(id_col: str, size: int) -> Column:
    """Batch number of a row with a dense id: ``size`` consecutive rows share one."""
    return F.floor((F.col(id_col) - 1) / F.lit(size)).cast("bigint")


def top_rows(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in a full order; planned as a top-k, never a full sort."""
    return df.orderBy(*_columns(order_by)).limit(n)
