"""The four stages from raw extracts to published tables.

Every stage reads Parquet datasets (raw extracts in the first) and writes Parquet
datasets, so a stage can be run again alone. ``python -m recordwell.plans.stages``
chains them.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordwell.functions.text import (
    clean_text, decimal_point, facility_tier, first_nonblank, is_null_token, nullify, tier_bound, to_number,
)
from recordwell.operators import checks
from recordwell.operators.columns import (
    clean_columns, ensure_columns, fill_defaults, map_text_columns, rename_synonyms, resolve_column,
    select_allowed, with_constants,
)
from recordwell.operators.calls import ATTRIBUTES, CallLog, cache_key, capacity_logged, search_cached
from recordwell.operators.contain import link_by_containment
from recordwell.operators.fill import fill_missing, gap_fill, lookup_key
from recordwell.operators.inference import Model, capacity_estimates, search_attributes
from recordwell.operators.keys import dense_id, keep_best, union_aligned
from recordwell.operators.sampling import hash_between, sample_links
from recordwell.operators.similar import fuzzy_dedup
from recordwell.session import cut_lineage
from recordwell.sources import readers, splits, writers
from recordwell.sources.readers import ORDER
from recordwell.sources.runs import RunTable
from recordwell.sources.schemas import (
    CONSTRAINTS, DEVICE_NAME_WORDS, DEVICE_NOISE, FOREIGN_KEYS, HOSPITAL_HEADERS, MEDICATION_HEADERS,
    PRIMARY_KEYS, TABLES,
)
from recordwell.sources.snapshot import Snapshots

HOSPITAL_COLUMNS = ("name", "city", "province", "region", "type", "beds", "phone", "email", "website",
                    "latitude", "longitude", "address", "source")
SUPPLIER_COLUMNS = ("name", "category", "activity", "address", "city", "phone", "responsible_pharmacist")

# Words written into columns the extracts lack.
DEFAULT_TYPE = "Hôpital"
DEVICE_CATEGORY = "Dispositif Médical"
WHOLESALE_CATEGORY = "Grossiste Pharmaceutique"
WHOLESALE_ACTIVITY = "Répartition Pharmaceutique"
OTHER_EQUIPMENT = "Autre équipement"
STANDARD_EQUIPMENT = "Standard"

# How many medications a facility stocks, and how much of each.
STOCK_KINDS = (10, 50)
STOCK_QUANTITY = (10, 1000)
EQUIPMENT_QUANTITY = (1, 5)


# ---------------------------------------------------------------- load

def load_public_hospitals(spark: SparkSession, path: str) -> DataFrame:
    """The official list: preamble skipped, headers mapped, texts cleaned, empty rows dropped."""
    df = splits.read_csv_splits(spark, path, ("Région", "Region"), with_order=True)
    df = clean_columns(rename_synonyms(df, HOSPITAL_HEADERS), ["region", "province", "city", "name", "type"])
    return with_constants(df.na.drop("all", subset=[c for c in df.columns if c != ORDER]), {"source": "gov"})


def load_map_hospitals(spark: SparkSession, path: str) -> DataFrame:
    """The map extract: texts cleaned, coordinates numeric."""
    df = readers.read_csv(spark, path, with_order=True, columns=("name", "city", "address", "type"))
    df = clean_columns(df, ["name", "city", "address", "type"])
    return clean_columns(df, ["latitude", "longitude"], to_number)


def load_medications(spark: SparkSession, path: str) -> DataFrame:
    """The medication list: items without a name dropped, one row per name, first wins."""
    fields = ["nom", *MEDICATION_HEADERS]
    df = splits.read_json_array(spark, path, fields, with_order=True)
    name = first_nonblank("SPECIALITE", "nom")
    df = map_text_columns(df.filter(~is_null_token(name)))
    df = df.withColumn("SPECIALITE", F.coalesce(F.col("SPECIALITE"), F.col("nom"))).drop("nom")
    return keep_best(df, ["SPECIALITE"], [ORDER])


def load_suppliers(spark: SparkSession, devices: str, wholesalers: str) -> DataFrame:
    """Device makers before wholesalers, one row per name, first wins."""
    makers = splits.read_json_array(spark, devices, ["NOM", "ACTIVITE", "ADRESSE"], with_order=True)
    makers = makers.select(
        clean_text("NOM").alias("name"), F.lit(DEVICE_CATEGORY).alias("category"),
        clean_text("ACTIVITE").alias("activity"), clean_text("ADRESSE").alias("address"), ORDER,
    )
    sellers = splits.read_json_array(
        spark, wholesalers, ["NOM", "ADRESSE", "VILLE", "TEL", "NOM PHARMACIEN RESPONSABLE"], with_order=True)
    sellers = sellers.select(
        clean_text("NOM").alias("name"), F.lit(WHOLESALE_CATEGORY).alias("category"),
        F.lit(WHOLESALE_ACTIVITY).alias("activity"), clean_text("ADRESSE").alias("address"),
        clean_text("VILLE").alias("city"), clean_text("TEL").alias("phone"),
        clean_text("NOM PHARMACIEN RESPONSABLE").alias("responsible_pharmacist"), ORDER,
    )
    named = [f.filter(F.col("name").isNotNull()) for f in (makers, sellers)]
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(named)]
    whole = union_aligned(tagged)
    kept = keep_best(whole, ["name"], ["_source", ORDER])
    return kept.select(*SUPPLIER_COLUMNS, "_source", ORDER)


def load_devices(spark: SparkSession, path: str) -> DataFrame:
    """The device sheet (as CSV): the name column found by its header, one row per name."""
    df = readers.read_csv(spark, path, with_order=True, columns=("name",))
    df = resolve_column(df, DEVICE_NAME_WORDS, "name")
    df = clean_columns(df, ["name"]).filter(F.col("name").isNotNull())
    df = fill_defaults(df, {}, absent={"category": DEVICE_CATEGORY})
    return keep_best(select_allowed(df, ["name", "category", "code", ORDER]), ["name"], [ORDER])


def load(spark: SparkSession, raw: str, out: str) -> list[str]:
    """Read every raw extract that exists and write its cleaned dataset."""
    done = []

    def put(name: str, needed: Sequence[str], build) -> None:
        if any(readers.path_exists(spark, f"{raw}/{n}") for n in needed):
            writers.write_stage(build(), out, name)
            done.append(name)

    put("gov_hospitals", ["gov_hospitals.csv"], lambda: load_public_hospitals(spark, f"{raw}/gov_hospitals.csv"))
    put("osm_hospitals", ["osm_hospitals.csv"], lambda: load_map_hospitals(spark, f"{raw}/osm_hospitals.csv"))
    put("medications", ["medicaments.json"], lambda: load_medications(spark, f"{raw}/medicaments.json"))
    put("suppliers", ["dispositifs.json", "etablissements.json"],
        lambda: load_suppliers(spark, f"{raw}/dispositifs.json", f"{raw}/etablissements.json"))
    put("devices", ["medical_devices.csv"], lambda: load_devices(spark, f"{raw}/medical_devices.csv"))
    put("equipment_ref", ["equipment_ref.csv"], lambda: readers.read_csv(spark, f"{raw}/equipment_ref.csv", with_order=True))
    put("services_ref", ["services_ref.csv"], lambda: readers.read_csv(spark, f"{raw}/services_ref.csv", with_order=True))
    return done


# ---------------------------------------------------------------- normalise

def normalise_hospitals(public: DataFrame | None, mapped: DataFrame | None,
                        threshold: int | None = 85) -> tuple[DataFrame, DataFrame]:
    """(places, hospitals): union, gap fill by city, place ids, similar names removed, dense ids."""
    frames = []
    if public is not None:
        frames.append(ensure_columns(public, ["name", "city", "region", "province", "type", "source"])
                      .withColumn("_source", F.lit(0)))
    if mapped is not None:
        frames.append(ensure_columns(with_constants(mapped, {"source": "osm"}), ["region", "province"])
                      .withColumn("_source", F.lit(1)))
    if not frames:
        raise ValueError("no hospital extract")
    df = union_aligned([f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in ("latitude", "longitude", "beds")})
                        for f in frames])
    df = ensure_columns(df, HOSPITAL_COLUMNS)
    df = clean_columns(df, ["name", "city", "province", "region", "type", "address"])
    df = fill_defaults(df, {"type": DEFAULT_TYPE})
    df = cut_lineage(dense_id(df, ["_source", ORDER], "_row").drop("_source", ORDER))
    df = gap_fill(df, "city", ["region", "province"], "_row")
    places = keep_best(df.select("region", "province", "city", "_row"), ["city"], ["_row"], null_keys="drop")
    places = dense_id(cut_lineage(places), ["_row"]).select("region", "province", "city", "id")
    df = cut_lineage(lookup_key(df, places, "city").filter(F.col("name").isNotNull()))
    visit = [F.when(F.col("source") == "osm", 0).otherwise(1)]
    filled = [*HOSPITAL_COLUMNS, "place_id"]
    kept = cut_lineage(fuzzy_dedup(df, "name", ["city"], "_row", visit, filled, threshold))
    return places, dense_id(kept, ["_row"]).select(*HOSPITAL_COLUMNS, "id", "place_id")


def normalise_equipment(reference: DataFrame | None, devices: DataFrame | None) -> DataFrame:
    """Reference list before devices; device names that are noise dropped; one row per name."""
    frames = []
    if reference is not None:
        frames.append(reference)
    if devices is not None and "name" in devices.columns:
        cleaned = clean_columns(devices, ["name"]).filter(F.col("name").isNotNull())
        frames.append(cleaned.filter(~checks.noise("name", blacklist=DEVICE_NOISE)))
    if not frames:
        raise ValueError("no equipment extract")
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    whole = clean_columns(union_aligned(tagged), ["name"]).filter(F.col("name").isNotNull())
    whole = fill_defaults(ensure_columns(whole, ["code"]), {"category": OTHER_EQUIPMENT},
                          absent={"category": STANDARD_EQUIPMENT})
    kept = cut_lineage(keep_best(whole, ["name"], ["_source", ORDER]))
    return dense_id(kept, ["_source", ORDER]).select("id", "name", "code", "category")


def normalise_medications(df: DataFrame) -> DataFrame:
    """Headers mapped, first column per name, texts cleaned, one row per name, dense ids."""
    df = map_text_columns(rename_synonyms(df, MEDICATION_HEADERS), skip=[ORDER])
    df = select_allowed(df, [*MEDICATION_HEADERS.values(), ORDER])
    kept = cut_lineage(keep_best(df, ["name"], [ORDER], null_keys="drop"))
    return dense_id(kept, [ORDER]).drop(ORDER)


def normalise_named(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Suppliers and services: texts cleaned, one row per name, dense ids."""
    df = ensure_columns(map_text_columns(df, skip=[ORDER]), columns)
    kept = cut_lineage(keep_best(df, ["name"], list(order), null_keys="drop"))
    return dense_id(kept, list(order)).select(*columns, "id")


def link_suppliers(medications: DataFrame, suppliers: DataFrame, key=F.lower) -> DataFrame:
    """(supplier_id, medication_id): the first supplier whose name contains the manufacturer.

    ``key=lambda c: spaceless(F.lower(c))`` also matches across hyphens and spaces.
    """
    return link_by_containment(
        medications.withColumnRenamed("id", "medication_id"), "manufacturer", "medication_id",
        suppliers.withColumnRenamed("id", "supplier_id"), "name", "supplier_id", "supplier_id", key,
    )


def normalise(spark: SparkSession, source: str, out: str, threshold: int | None = 85) -> list[str]:
    """Run every normalisation whose input exists and write the results."""
    def get(name: str) -> DataFrame | None:
        return readers.if_there(lambda: spark.read.parquet(f"{source}/{name}"))

    done = []

    def put(name: str, df: DataFrame) -> DataFrame:
        done.append(name)
        return writers.write_stage(df, out, name)

    public, mapped = get("gov_hospitals"), get("osm_hospitals")
    if public is not None or mapped is not None:
        places, hospitals = normalise_hospitals(public, mapped, threshold)
        put("places", places)
        put("hospitals", hospitals)
    reference, devices = get("equipment_ref"), get("devices")
    if reference is not None or devices is not None:
        put("equipment", normalise_equipment(reference, devices))
    medications = suppliers = None
    if (df := get("medications")) is not None:
        medications = put("medications", normalise_medications(df))
    if (df := get("suppliers")) is not None:
        suppliers = put("suppliers", normalise_named(df, ["_source", ORDER], SUPPLIER_COLUMNS))
    if (df := get("services_ref")) is not None:
        put("services", normalise_named(df, [ORDER], ["name", "description"]))
    if medications is not None and suppliers is not None and "manufacturer" in medications.columns:
        put("supplier_medications", link_suppliers(medications, suppliers))
    return done


# ---------------------------------------------------------------- enrich

def enrich_hospitals(hospitals: DataFrame, services: DataFrame | None, equipment: DataFrame | None,
                     medications: DataFrame | None = None, cache: DataFrame | None = None,
                     search_model: Model | None = None, capacity_model: Model | None = None,
                     seed: str = "links", state: str | None = None) -> dict[str, DataFrame]:
    """Found attributes, bed counts and link tables for every hospital; a dimension that is None has no links.

    ``state`` names a folder for the calls and their answers: attribute searches are then looked up and written back there, and
    a run that died goes on where it stopped (``operators.calls``).

    Counts come from the capacity model where it answers for the id, else from the
    hospital's size class; every draw is a hash of the ids, so a rerun gives the same
    links.
    """
    spark = hospitals.sparkSession
    df = hospitals.withColumn("beds", F.col("beds").try_cast("double").try_cast("int"))
    fields = ["address", "phone", "email", "website", "beds"]
    if state is not None:
        store = RunTable(spark, f"{state}/attributes", ATTRIBUTES, "ask")
        if cache is not None:
            store.append(cache.select(
                cache_key(F.col("name"), F.col("city")).alias("ask"), *fields[:4], F.col("beds").cast("int").alias("beds"),
                F.lit("cache").alias("source_quality")))
        found = cut_lineage(search_cached(df, store, CallLog(spark, f"{state}/searches"), search_model))
        store.compact_tiers()
        df = fill_missing(df, found, "id", fields)
    elif cache is not None or search_model is not None:
        found = cut_lineage(search_attributes(df, cache, search_model))
        df = fill_missing(df, found, "id", fields)
    counts = df.select("id", facility_tier("type").alias("tier"))
    if state is not None:
        counts = counts.join(capacity_logged(df, CallLog(spark, f"{state}/capacities"), capacity_model), "id", "left")
    elif capacity_model is not None:
        counts = counts.join(capacity_estimates(df, capacity_model), "id", "left")
    else:
        counts = ensure_columns(counts, {"service_count": "int", "equipment_count": "int", "beds": "int"})

    def drawn(measure: str) -> Column:
        low, high = tier_bound("tier", measure, "low"), tier_bound("tier", measure, "high")
        return hash_between(low, high, F.lit(seed), F.lit(measure), F.col("id")).cast("int")

    counts = cut_lineage(counts.select(
        "id",
        F.coalesce("service_count", drawn("services")).alias("services"),
        F.coalesce("equipment_count", drawn("equipment")).alias("equipment"),
        F.coalesce("beds", drawn("beds")).alias("beds"),
    ))
    out = {"hospitals": fill_missing(df, counts, "id", ["beds"])}
    if services is not None:
        out["hospital_services"] = sample_links(
            counts, "id", F.col("services"), services, "id", seed + "-services", None, ("hospital_id", "service_id"))
    if equipment is not None:
        out["hospital_equipment"] = sample_links(
            counts, "id", F.col("equipment"), equipment, "id", seed + "-equipment",
            ("quantity", *EQUIPMENT_QUANTITY), ("hospital_id", "equipment_id"))
    if medications is not None:
        kinds = hash_between(*STOCK_KINDS, F.lit(seed), F.lit("stock"), F.col("id"))
        out["hospital_medications"] = sample_links(
            counts, "id", kinds, medications, "id", seed + "-stock",
            ("stock_quantity", *STOCK_QUANTITY), ("hospital_id", "medication_id"))
    return out


def enrich(spark: SparkSession, source: str, out: str, **options) -> list[str]:
    """Enrich the normalised datasets and carry the others forward; extracts that are not there are left out."""
    done = writers.carry_forward(
        spark, source, out, ["places", "services", "equipment", "medications", "suppliers", "supplier_medications"])

    def get(name: str) -> DataFrame | None:
        return readers.if_there(lambda: spark.read.parquet(f"{source}/{name}"))

    if (hospitals := get("hospitals")) is None:
        return done
    tables = enrich_hospitals(hospitals, get("services"), get("equipment"), get("medications"), **options)
    for name, df in tables.items():
        writers.write_stage(df, out, name)
        done.append(name)
    return done


# ---------------------------------------------------------------- publish

def enriched_tables(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """The enriched datasets that are there, as they are published."""
    def prices(df: DataFrame) -> DataFrame:
        """Prices still written as text get a decimal point; what is no number stays for the checks to see."""
        texts = [c for c in ("price_public", "price_hospital") if c in df.columns and df.schema[c].dataType.simpleString() == "string"]
        return df.withColumns({c: decimal_point(nullify(F.trim(c))) for c in texts})

    found = {t: readers.if_there(lambda t=t: spark.read.parquet(f"{source}/{t}")) for t in TABLES}
    return {t: df if t != "medications" else prices(df) for t, df in found.items() if df is not None}


def publish_snapshot(spark: SparkSession, source: str, path: str) -> dict[str, DataFrame]:
    """Refresh all tables as one version under ``path`` (tables without a dataset are empty) and return the checks of that version."""
    given = enriched_tables(spark, source)
    store = Snapshots(spark, path)
    version = store.refresh({t: given[t] if t in given else readers.empty(spark, schema) for t, schema in TABLES.items()})
    return verify(store.tables(version), given)


def publish(spark: SparkSession, source: str, database: str) -> dict[str, DataFrame]:
    """Create the typed tables, refresh them parents first, and return the checks."""
    writers.create_tables(spark, database)
    given = enriched_tables(spark, source)
    writers.load_tables(given, database)
    return verify({t: spark.table(f"{database}.{t}") for t in TABLES}, given)


def verify(tables: dict[str, DataFrame], given: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Counts, key, reference and column checks over published tables.

    ``given`` has the frames before their columns were cast to the tables' types: a value that does not
    fit is null afterwards, so the columns are checked there too.
    """
    given = given or {}
    out = {"counts": checks.table_counts(tables)}
    for name, df in tables.items():
        keys = list(PRIMARY_KEYS[name])
        out[f"{name}: keys"] = checks.duplicate_report(df, keys)
        broken = checks.constraint_violations(df, CONSTRAINTS[name], keys[0])
        if name in given and keys[0] in given[name].columns:
            before = checks.constraint_violations(given[name], CONSTRAINTS[name], keys[0])
            broken = broken.unionByName(before.withColumn(keys[0], F.col(keys[0]).cast(df.schema[keys[0]].dataType))).distinct()
        out[f"{name}: columns"] = broken
    for child, fk, parent, _ in FOREIGN_KEYS:
        if child in tables and parent in tables:
            out[f"{child}.{fk}: references"] = checks.orphan_keys(tables[child], fk, tables[parent], "id")
    return out


def main() -> None:
    parser = argparse.ArgumentParser(description="Raw extracts to published master-data tables")
    parser.add_argument("--raw", required=True, help="folder of the raw extracts")
    parser.add_argument("--work", required=True, help="folder for the stage datasets")
    parser.add_argument("--database", default="master_data")
    parser.add_argument("--state", help="folder of model calls and their answers; attributes found before are used")
    parser.add_argument("--snapshot", help="publish all tables as one version in this folder instead of the database")
    parser.add_argument("--exact-names", action="store_true", help="treat only equal names as duplicates")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("recordwell").getOrCreate()
    load(spark, args.raw, f"{args.work}/raw")
    normalise(spark, f"{args.work}/raw", f"{args.work}/processed", None if args.exact_names else 85)
    enrich(spark, f"{args.work}/processed", f"{args.work}/enriched", state=args.state)
    if args.snapshot:
        found = publish_snapshot(spark, f"{args.work}/enriched", args.snapshot)
    else:
        found = publish(spark, f"{args.work}/enriched", args.database)
    found["counts"].show(truncate=False)


if __name__ == "__main__":
    main()
