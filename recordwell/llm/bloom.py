"""Exact duplicates in two passes: a Bloom filter of repeated hashes, then a shuffle of suspects only.

Pass 1 hashes every whole text and counts the filter's slots; a slot that two rows hit is kept as
a bit. Pass 2 tests every row: a row with a slot that nobody else hit is surely alone and passes
straight through; the others, the suspects, are grouped by their digest.

Defined results: a null text counts as empty, so null and empty texts are one group. Of equal texts
the row with the largest id stays; a null id is smaller than any other. Rows that repeat both id and
text are one group too, and one of them stays. Empty tables give empty results. Other columns are
never looked at, whatever their names, except that the last tie between full rows is settled by
a hash of all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recordwell.llm.common import BITMAP_BITS, attach_groups, bitmaps, has_bit
from recordwell.session import cut_lineage

#: Slots a text hits, bits spent per row, and the largest filter: 2^30 bits are 128 MB when broadcast.
#: Past 2^30 / 16 rows (67 million) more rows become suspects; results stay exact, and a suspect
#: costs a shuffle of its id and digest, never of more.
HASHES, BITS_PER_ROW, MAX_BITS = 2, 16, 2 ** 30


def digest_of(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _slots(digest, bits: int) -> list:
    """Slots from disjoint parts of the digest."""
    return [
        F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long") % F.lit(bits) for i in range(HASHES)
    ]


def filter_bits(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    """Size of the filter: a power of two, at least one bitmap, never above ``max_bits``."""
    wanted = max(rows * bits_per_row, BITMAP_BITS)
    return min(max_bits, 1 << (wanted - 1).bit_length())


def repeated_slots(digests: DataFrame, bits: int, digest: str = "digest") -> DataFrame:
    """Pass 1: bitmaps of the slots that at least two rows hit, at most ``bits`` bits in all."""
    slots = digests.select(F.explode(F.array_distinct(F.array(*_slots(F.col(digest), bits)))).alias("slot"))
    repeated = slots.groupBy("slot").count().filter("count > 1")
    return bitmaps(repeated, [], "slot")


def with_suspicion(rows: DataFrame, filters: DataFrame, bits: int, digest: str, name: str) -> DataFrame:
    """Pass 2: a boolean column that is false for rows whose digest is surely alone. No shuffle."""
    suspicion = F.lit(True)
    out = rows
    for i, slot in enumerate(_slots(F.col(digest), bits)):
        bitmap = F.broadcast(filters.select(F.col("bucket").alias(f"{name}_bucket{i}"), F.col("bits").alias(f"{name}_bits{i}")))
        out = out.withColumn(f"{name}_slot{i}", slot)
        out = out.join(bitmap, F.expr(f"{name}_slot{i} div {BITMAP_BITS}") == F.col(f"{name}_bucket{i}"), "left")
        suspicion = suspicion & has_bit(F.col(f"{name}_bits{i}"), F.col(f"{name}_slot{i}") % BITMAP_BITS)
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], suspicion.alias(name))


def mark_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: (key, keep_id, group_size, kept, text_sha256)."""
    digests = cut_lineage(docs.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), digest_of(text).alias("digest")
    ))
    total = digests.count()
    bits = filter_bits(total, max_bits=max_bits)
    filters = cut_lineage(repeated_slots(digests, bits))
    tested = with_suspicion(digests, filters, bits, "digest", "suspect")
    suspects = tested.filter("suspect").drop("suspect")
    alone = tested.filter("NOT suspect").select(
        "key", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    # a struct with a null key is smaller than any other
    groups = cut_lineage(suspects.groupBy("digest").agg(
        F.max(F.struct("key", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
    ))
    grouped = attach_groups(suspects, groups, ["digest"], "group_size", total).select(
        "key", F.col("best.key").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"), "digest"
    )
    return alone.unionByName(grouped).select(
        F.col("key").alias(key), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows that stay, with all their columns. Only suspects shuffle, one row per text and task."""
    digest, suspect, place = "_exact_digest", "_exact_suspect", "_exact_place"
    digests = cut_lineage(docs.select(digest_of(text).alias("digest")))
    bits = filter_bits(digests.count(), max_bits=max_bits)
    filters = cut_lineage(repeated_slots(digests, bits))
    tested = with_suspicion(docs.withColumn(digest, digest_of(text)), filters, bits, digest, suspect)
    last = Window.partitionBy(digest).orderBy(F.col(key).desc_nulls_last(), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    best = tested.filter(F.col(suspect)).withColumn(place, F.row_number().over(last)).filter(F.col(place) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return tested.filter(~F.col(suspect)).select(*columns).unionByName(best.select(*columns))
