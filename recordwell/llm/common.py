"""What several operators share: hot groups, bits of bitmaps, bounded labelled samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordwell.session import cut_lineage

#: A group with more than one row in so many is hot; there are never more hot groups than this.
HOT_SHARE = 1000
#: Bits of one bitmap of ``bitmap_construct_agg``: a fixed property of that function.
BITMAP_BITS = 32768
#: How many times the wanted sample is ranked; hashes above the bound that leaves so many are never moved.
SPARE = 2


def hot_size(total: int) -> int:
    """The size above which a group counts as hot; at most 1000 groups can be larger.

    Below 100 000 rows the bar of 100 rows allows fewer groups still.
    """
    return max(100, total // HOT_SHARE)


def attach_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of rows with one row per group, safe for groups that hold a third of all rows.

    ``groups`` has ``size``, the number of rows of the group in ``rows``; ``total`` is the number of
    rows. Hot groups are at most 1000, so they are broadcast and their rows stay where they are;
    every other group has few rows and meets them through a shuffle. Null keys match each other.
    """
    bar = hot_size(total)
    other = groups.withColumnsRenamed({key: f"_group_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_group_{key}"))
    hot, cold = F.broadcast(other.filter(F.col(size) > bar)), other.filter(F.col(size) <= bar)
    spare = [f"_group_{key}" for key in keys]
    few = rows.join(hot.select(*spare), same, "left_anti")
    return rows.join(hot, same).drop(*spare).unionByName(few.join(cold, same).drop(*spare))


def bitmaps(slots: DataFrame, by: list[str], slot: str) -> DataFrame:
    """One row per ``by`` and ``bucket`` with the bitmap of the slots (a long from 0) in the bucket."""
    return slots.select(
        *by, F.expr(f"{slot} div {BITMAP_BITS}").alias("bucket"), (F.col(slot) % BITMAP_BITS).alias("place")
    ).groupBy(*by, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def has_bit(bits: Column, place: Column) -> Column:
    """Whether a bitmap holds a place; false for a null bitmap."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(place, F.lit(8)).cast("int")
    return F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), bit).cast("int")) != 0, F.lit(False))


def is_held_out(key: str) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; a null id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def bounded_sample(
    rows: DataFrame, label: str, text: str, per_label: int, max_bytes: int, labels: DataFrame | None = None, key: str = "doc_id",
) -> DataFrame:
    """At most ``per_label`` different whole texts of each label, none above ``max_bytes`` bytes: (label, hash, text).

    The label is a column of ``rows``, or of ``labels`` (key, label), which may label a document several times.
    The lowest hashes of the texts win, so the sample depends neither on order nor on partitioning, and
    a text that many rows repeat is taken once. Hashes are evenly spread, so the number of different ones
    of a label (a sketch) gives the bound below which twice the wanted sample lies; only hashes below it shuffle
    and are ranked, whatever the number of rows. Should a bound leave too few, it is raised and the choice made again.
    The texts of the chosen few are fetched by a bounded broadcast.
    """
    known = rows.filter((F.octet_length(text) > 0) & (F.octet_length(text) <= max_bytes)).withColumn("_hash", F.xxhash64(text))
    if labels is None:
        hashes = known.select(F.col(label).alias("label"), F.col("_hash").alias("hash"))
    else:
        asked = labels.select(F.col(key).alias("_asked"), F.col(label).alias("label"))
        hashes = known.select(F.col(key).alias("_own"), F.col("_hash").alias("hash")).join(asked, F.col("_own") == F.col("_asked"))
    hashes = hashes.select("label", "hash").filter(F.col("label").isNotNull())
    different = hashes.groupBy("label").agg(F.approx_count_distinct("hash").alias("n"))
    # one row a label
    share = {r.label: min(1.0, SPARE * per_label / max(1, r.n)) for r in different.collect()}
    while True:
        chosen = cut_lineage(_lowest(hashes, share, per_label))
        found = dict(chosen.groupBy("label").count().collect())
        few = [name for name, part in share.items() if part < 1 and found.get(name, 0) < per_label]
        if not few:
            break
        share |= {name: min(1.0, 4 * share[name]) for name in few}
    fetched = known.select(F.col("_hash"), F.col(text).alias("_text")).join(F.broadcast(chosen), F.col("_hash") == F.col("hash"))
    return fetched.groupBy("label", "hash").agg(F.min("_text").alias("text"))


def _lowest(hashes: DataFrame, share: dict, per_label: int) -> DataFrame:
    """The ``per_label`` lowest hashes of each label among those in the label's share of the hash range."""
    if not share:
        return hashes.limit(0)
    ends = F.create_map(*[F.lit(v) for name, part in share.items() for v in (name, min(2 ** 63 - 1, int((2 * part - 1) * 2 ** 63)))])
    low = hashes.filter(F.col("hash") <= ends[F.col("label")]).distinct()
    order = Window.partitionBy("label").orderBy("hash")
    return low.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_label).select("label", "hash")
