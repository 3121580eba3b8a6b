"""Place tables: staged cleaning and the repair chain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordwell.functions.match import soundex_long
from recordwell.functions.text import (
    address_to_city, ascii_name, canonical_prefix, fold, let, nullify, sentence_case, spaceless, strip_suffixes,
)
from recordwell.operators.checks import junk_place
from recordwell.operators.columns import advance_status
from recordwell.operators.contain import containers
from recordwell.operators.edits import name_table, nearest_names
from recordwell.operators.fill import attach, self_fill
from recordwell.operators.keys import keep_best, smart_dedup
from recordwell.session import broadcast_if_small, cut_lineage

# Known cities with their region and province.
CITY_DICTIONARY = (
    ("MIDAR", "Oriental", "Driouch"),
    ("TIT MELLIL", "Casablanca-Settat", "Médiouna"),
    ("SIDI ALLAL EL BAHRAOUI", "Rabat-Salé-Kénitra", "Khemisset"),
    ("CHICHAOUA", "Marrakech-Safi", "Chichaoua"),
    ("AIT MELLOUL", "Souss-Massa", "Inezgane-Aït Melloul"),
    ("SALE", "Rabat-Salé-Kénitra", "Salé"),
    ("BENI ANSAR", "Oriental", "Nador"),
    ("TAOURIRT", "Oriental", "Taourirt"),
    ("MOHAMMEDIA", "Casablanca-Settat", "Mohammedia"),
    ("KENITRA", "Rabat-Salé-Kénitra", "Kénitra"),
    ("RABAT", "Rabat-Salé-Kénitra", "Rabat"),
    ("CASABLANCA", "Casablanca-Settat", "Casablanca"),
    ("KSAR EL KEBIR", "Tanger-Tétouan-Al Hoceïma", "Larache"),
    ("MARTIL", "Tanger-Tétouan-Al Hoceïma", "M'diq-Fnideq"),
    ("SAADINA", "Tanger-Tétouan-Al Hoceïma", "Tétouan"),
    ("TOUISSIT", "Oriental", "Jerada"),
    ("TOULAL", "Fès-Meknès", "Meknès"),
    ("IMOUZZER MARMOUCHA", "Fès-Meknès", "Boulemane"),
    ("AOURIR", "Souss-Massa", "Agadir-Ida-Ou-Tanane"),
    ("SIDI IFNI", "Guelmim-Oued Noun", "Sidi Ifni"),
    ("TARGUIST", "Tanger-Tétouan-Al Hoceïma", "Al Hoceïma"),
    ("BEN AHMED", "Casablanca-Settat", "Settat"),
    ("BELYOUNECH", "Tanger-Tétouan-Al Hoceïma", "M'diq-Fnideq"),
    ("CHEMAIA", "Marrakech-Safi", "Youssoufia"),
)

# What stands in for an unknown region or province.
UNKNOWN = {"region": "Region Inconnue", "province": "Province Inconnue"}

ATTRIBUTES = ["region", "province"]


def city_dictionary(spark: SparkSession, rows=CITY_DICTIONARY) -> DataFrame:
    """The reference cities as a table, in order."""
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "entry INT, name_clean STRING, region STRING, province STRING",
    )


def clean_places(df: DataFrame, order_by: str = "raw_id", canonical_last: bool = False) -> DataFrame:
    """Staged cleaning of (raw_id, region, province, city, validation_status).

    Suffixes, canonical names, address to city and casing touch pending rows (canonical
    names touch all); then missing regions come from the lowest row of the same city,
    compared without case and accents, and rows with a city become valid. Casing undoes
    some canonical spellings, as in the rule order; ``canonical_last`` restores them.
    """
    pending = F.col("validation_status") == "PENDING"

    def when_pending(rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda city: F.when(pending, rule(city)).otherwise(city)

    steps = [when_pending(strip_suffixes), canonical_prefix, when_pending(address_to_city), when_pending(sentence_case)]
    if canonical_last:
        steps.append(canonical_prefix)
    city = F.col("city")
    for step in steps:
        city = let(city, step)
    staged = df.withColumn("city", city)
    filled = self_fill(staged, "city", ATTRIBUTES, order_by, only=pending)
    return filled.withColumn("validation_status", advance_status())


def promote_places(df: DataFrame, order_by: str = "raw_id") -> DataFrame:
    """One row per valid city (case and accents apart) with unknowns spelled out: its first row."""
    valid = df.filter(F.col("validation_status") == "VALID").withColumns(
        {c: F.coalesce(F.col(c), F.lit(word)) for c, word in UNKNOWN.items()}
    )
    return keep_best(valid, [fold("city")], [order_by]).select("region", "province", "city")


def dictionary_match(df: DataFrame, dictionary: DataFrame, key, name: str = "city") -> DataFrame:
    """Rows without a region take name, region and province of the dictionary entry with the same key.

    ``key`` maps a name column to the join key; among several entries the first counts.
    A key never joins when it is empty.
    """
    entries = dictionary.withColumn("_entry_key", key(F.col("name_clean"))).filter(F.col("_entry_key") != "")
    entries = entries.groupBy("_entry_key").agg(
        F.min(F.struct("entry", "name_clean", "region", "province")).alias("_entry")
    )
    joined = attach(df, broadcast_if_small(entries), key(F.col(name)), "_entry_key")
    take = F.col("region").isNull() & F.col("_entry").isNotNull()
    values = {name: "name_clean", "region": "region", "province": "province"}
    return joined.select(*[
        F.when(take, F.col("_entry")[values[c]]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns
    ])


def standardise_places(df: DataFrame, mode: str = "ascii") -> DataFrame:
    """Upper-case Latin names, null words removed, address rows dropped."""
    named = df.withColumns({
        "city": ascii_name("city", mode),
        "region": nullify("region", ("NULL",)),
        "province": nullify("province", ("NULL",)),
    })
    return named.filter(~junk_place("city"))


def repair_decisions(names: DataFrame, dictionary: DataFrame, min_typo_length: int = 3) -> DataFrame:
    """What becomes of the rows without a region under each name: (bad, new name and attributes, drop).

    Works on a name table. Dictionary key, then sound, then typo; a name none of them
    repairs is dropped if it contains a whole name. Names the dictionary repairs count
    as whole for the later steps.
    """
    broken = names.filter(F.col("broken_id").isNotNull()).select(
        F.col("name").alias("bad"), "broken_id", F.col("name").alias("city"),
        *[F.lit(None).cast("string").alias(c) for c in ATTRIBUTES],
    )
    by_key = dictionary_match(broken, dictionary, spaceless)
    known = cut_lineage(dictionary_match(by_key, dictionary, soundex_long))
    repaired = known.filter(F.col("region").isNotNull())
    donors = names.filter(F.col("donor").isNotNull()).select("name", "donor").unionByName(
        repaired.select(F.col("city").alias("name"), F.struct(F.col("broken_id").alias("id"), *ATTRIBUTES).alias("donor"))
    )
    whole = donors.groupBy("name").agg(F.min_by("donor", F.col("donor.id")).alias("donor"))
    open_names = known.filter(F.col("region").isNull()).select(F.col("bad").alias("name"), "broken_id")
    state = cut_lineage(whole.join(open_names, "name", "full").select("name", "donor", "broken_id"))
    near = cut_lineage(nearest_names(state, 2, min_typo_length))
    rest = state.join(near.select(F.col("bad").alias("name"), F.lit(True).alias("found")), "name", "left").select(
        "name", "donor", F.when(F.col("found").isNull(), F.col("broken_id")).alias("broken_id")
    )
    keep = F.lit(False).alias("drop")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("city", *ATTRIBUTES)]
    return (
        repaired.select("bad", "city", *ATTRIBUTES, keep)
        .unionByName(near.select("bad", F.col("good").alias("city"), *[F.col("donor")[c].alias(c) for c in ATTRIBUTES], keep))
        .unionByName(containers(rest).select("bad", *nothing, F.lit(True).alias("drop")))
    )


def repair_places(df: DataFrame, dictionary: DataFrame | None = None, mode: str = "fold",
                  min_typo_length: int = 3) -> DataFrame:
    """The whole repair of (id, region, province, city).

    Standardise, then rows without a region are matched by dictionary key, by sound and
    by typo, each step seeing what the one before repaired; rows that merely contain a
    valid name go, and one row per city stays. ``mode="ascii"`` with
    ``min_typo_length=1`` is the plainest form of the rules; folding accents first and
    a least length avoid matches between names that lost their letters.

    The rows are read twice, once to list their names and once to apply the decisions,
    however many steps there are.
    """
    dictionary = dictionary if dictionary is not None else city_dictionary(df.sparkSession)
    rows = standardise_places(df, mode)
    names = name_table(rows, "city", ATTRIBUTES, "id")
    decisions = repair_decisions(names, dictionary, min_typo_length).withColumnsRenamed(
        {c: f"_{c}" for c in ("city", *ATTRIBUTES)}
    )
    broken = F.col("region").isNull()
    joined = attach(rows, decisions, F.col("city"), "bad").filter(
        ~(broken & F.coalesce(F.col("drop"), F.lit(False)))
    )
    take = broken & F.col("_city").isNotNull()
    decided = joined.select(*[
        F.when(take, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("city", *ATTRIBUTES) else F.col(c)
        for c in rows.columns
    ])
    return smart_dedup(decided, "city", "region", "id")
