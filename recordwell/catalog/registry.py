"""The registry and the derived inputs the queries share.

The given tables hold no dirt, so inputs are derived from whole tables by expressions
that Spark and the checking engine both understand; every row of the table is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class View:
    """A derived input: one table, one expression per column, in both dialects."""

    def __init__(self, source: str, /, **columns: str):
        self.table, self.columns = source, columns

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, self.table).selectExpr(
            *[f"{expression} AS {name}" for name, expression in self.columns.items()]
        )

    @property
    def sql(self) -> str:
        parts = ", ".join(f"{expression} AS {name}" for name, expression in self.columns.items())
        return f"SELECT {parts} FROM {self.table}"


def fold_sql(c: str) -> str:
    return f"lower(strip_accents({c}))"


#: A whole word of any script: letters and the marks that belong to them. Both engines read it alike.
LETTER_RUN = r"[\p{L}\p{M}]+"


# Place rows: names with typos, streets, containers, missing spaces, other scripts, names nobody knows; gaps in region.
_BROKEN = (
    "p_partkey % 17 = 3 OR p_partkey % 13 = 5 OR p_partkey % 11 = 7 OR p_partkey % 19 = 4 "
    "OR p_partkey % 23 = 6 OR p_partkey % 29 = 8 OR p_partkey % 31 = 9 OR p_partkey % 7 = 0 OR p_partkey % 53 = 9"
)
PLACES = View(
    "part",
    id="p_partkey",
    city=(
        "CASE WHEN p_partkey % 53 = 9 THEN 'Xqzw' || translate(CAST(p_partkey AS STRING), '0123456789', 'bdfghjklmn') "
        "WHEN p_partkey % 17 = 3 THEN '12 RUE ' || upper(p_name) "
        "WHEN p_partkey % 13 = 5 THEN 'Ain ' || p_name || ' Fez' "
        "WHEN p_partkey % 11 = 7 THEN substr(p_name, 1, 2) || substr(p_name, 4) "
        "WHEN p_partkey % 19 = 4 THEN replace(p_name, ' ', '-') "
        "WHEN p_partkey % 23 = 6 THEN 'Salee' "
        "WHEN p_partkey % 29 = 8 THEN 'Ksarelkebir' "
        "WHEN p_partkey % 31 = 9 THEN p_name || ' (Mun.) تيط مليل' "
        "WHEN p_partkey % 43 = 2 THEN 'rue ' || p_name "
        "WHEN p_partkey % 47 = 2 THEN 'Fès ' || p_name ELSE p_name END"
    ),
    region=f"CASE WHEN {_BROKEN} THEN NULL WHEN p_partkey % 37 = 1 THEN 'NULL' ELSE p_brand END",
    province=f"CASE WHEN {_BROKEN} THEN NULL WHEN p_partkey % 41 = 1 THEN 'NULL' ELSE p_type END",
)

# Staged places: suffixes, canonical beginnings and addresses, with a row status.
STAGED = View(
    "customer",
    raw_id="c_custkey",
    region="CASE WHEN c_custkey % 3 = 0 THEN 'Region ' || c_mktsegment ELSE NULL END",
    province="CASE WHEN c_custkey % 3 = 0 THEN 'Province ' || CAST(c_nationkey AS STRING) ELSE NULL END",
    city=(
        "CASE WHEN c_custkey % 50 = 49 THEN NULL "
        "WHEN c_custkey % 11 = 1 THEN c_mktsegment || ' (Mun.)' "
        "WHEN c_custkey % 11 = 2 THEN c_mktsegment || ' (Arrond.) ' "
        "WHEN c_custkey % 13 = 3 THEN 'TEMARA ' || c_name "
        "WHEN c_custkey % 13 = 4 THEN 'ait ouqabli تيط' "
        "WHEN c_custkey % 17 = 5 THEN CAST(c_custkey AS STRING) || ' RUE IBN SINA FES' "
        "WHEN c_custkey % 17 = 6 THEN '7 Bd Hassan II casablanca' "
        "WHEN c_custkey % 17 = 7 THEN 'rue de Rabat, Tanger' "
        "WHEN c_custkey % 19 = 8 THEN 'Fès ' || CAST(c_nationkey AS STRING) "
        "WHEN c_custkey % 19 = 9 THEN 'fes ' || CAST(c_nationkey AS STRING) "
        "ELSE c_mktsegment || ' ' || CAST(c_nationkey AS STRING) END"
    ),
    validation_status="CASE WHEN c_custkey % 9 = 8 THEN 'VALID' ELSE 'PENDING' END",
)

# Medication rows: dosages, ingredients and prices as text.
MEDICATIONS = View(
    "part",
    id="p_partkey",
    name="CASE WHEN p_partkey % 6 = 1 THEN '  ' || p_name ELSE p_name END",
    active_substance=(
        "CASE WHEN p_partkey % 4 = 1 THEN 'paracetamol // cafeine' "
        "WHEN p_partkey % 4 = 2 THEN p_type || '//' || p_brand ELSE lower(p_type) || ' ' END"
    ),
    form="lower(p_type)",
    presentation="'boite de ' || CAST(p_size AS STRING)",
    dosage=(
        "CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size AS STRING) || 'MG' "
        "WHEN p_partkey % 5 = 1 THEN '0,' || CAST(p_size AS STRING) || 'ml' "
        "WHEN p_partkey % 5 = 2 THEN '500MG / ' || CAST(p_size AS STRING) || ' MG' "
        "WHEN p_partkey % 5 = 3 THEN '000' || CAST(p_size AS STRING) ELSE '12 µG' END"
    ),
    therapeutic_class="p_type",
    manufacturer="p_brand",
    price_public=(
        "CASE WHEN p_partkey % 8 = 3 THEN 'NULL' WHEN p_partkey % 8 = 4 THEN 'n.c.' "
        "ELSE CAST(p_size * 10 AS STRING) || ',50' END"
    ),
    price_hospital="CAST((p_partkey % 600) AS STRING) || '.25'",
    commercialization_status="' Commercialisé '",
)

# Facilities: contacts of every quality.
HOSPITALS = View(
    "customer",
    id="c_custkey",
    name="CASE WHEN c_custkey % 10 = 0 THEN ' hôpital ' || c_mktsegment ELSE c_name END",
    place_id="c_nationkey",
    city="c_mktsegment",
    address=(
        "CASE WHEN c_custkey % 7 = 0 THEN NULL "
        "WHEN c_custkey % 7 = 1 THEN '12 bd zerktouni 20000 casablanca maroc' "
        "WHEN c_custkey % 7 = 2 THEN 'rue 5, fes, morocco' "
        "WHEN c_custkey % 7 = 3 THEN 'banque marocaine, 90000 tanger' ELSE c_name END"
    ),
    type=(
        "CASE WHEN c_nationkey % 5 = 0 THEN 'CHU ' || c_mktsegment "
        "WHEN c_nationkey % 5 = 1 THEN 'Clinique privée' WHEN c_nationkey % 5 = 2 THEN 'Hôpital Régional' "
        "WHEN c_nationkey % 5 = 3 THEN 'Centre de santé' ELSE c_mktsegment END"
    ),
    beds="CASE WHEN c_custkey % 4 = 0 THEN 0 WHEN c_custkey % 4 = 1 THEN NULL ELSE c_custkey % 900 END",
    phone=(
        "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN 'NULL' "
        "WHEN c_custkey % 9 = 2 THEN '05.39.94.' || CAST(10 + c_nationkey AS STRING) || '.87' "
        "WHEN c_custkey % 9 = 3 THEN '06 61-12-34-56' WHEN c_custkey % 9 = 4 THEN '212 5 22 30 92 91' "
        "WHEN c_custkey % 9 = 5 THEN '+212 537 27 25 00' WHEN c_custkey % 9 = 6 THEN '' "
        "WHEN c_custkey % 9 = 7 THEN '05.39.94.66.87 05.39.94.66.88' ELSE 'poste ' || CAST(c_custkey AS STRING) END"
    ),
    email=(
        "CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN 'null' "
        "WHEN c_custkey % 6 = 2 THEN ' Contact@' || c_mktsegment || '.MA' "
        "WHEN c_custkey % 6 = 3 THEN 'info@site.health' WHEN c_custkey % 6 = 4 THEN 'nobody at home' ELSE '' END"
    ),
    website=(
        "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'www.chu.ma' "
        "WHEN c_custkey % 5 = 2 THEN 'http://x.ma' WHEN c_custkey % 5 = 3 THEN 'ftp://x' ELSE '' END"
    ),
)
