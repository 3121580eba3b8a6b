"""Queries that run a whole normalisation stage on derived extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwell.catalog.columns import clean_sql
from recordwell.catalog.matching import losers_sql
from recordwell.catalog.registry import View, query, table
from recordwell.plans import stages
from recordwell.sources.schemas import DEVICE_NOISE

# The official list and the map extract: gaps in region, copies of names, rows without a name or city.
PUBLIC = View(
    "customer",
    _ord="c_custkey",
    name="CASE WHEN c_custkey % 30 = 7 THEN ' nan ' ELSE 'Hôpital  ' || CAST(c_custkey % 400 AS STRING) END",
    city="CASE WHEN c_custkey % 25 = 3 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Casablanca' ELSE ' Ville ' || CAST(c_nationkey AS STRING) END",
    region="CASE WHEN c_custkey % 6 = 1 THEN 'Region ' || c_mktsegment ELSE NULL END",
    province="CASE WHEN c_custkey % 4 = 1 THEN 'Province ' || c_mktsegment ELSE NULL END",
    type="CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'HP' END",
    source="'gov'",
)
MAPPED = View(
    "supplier",
    _ord="s_suppkey",
    name="'hôpital ' || CAST(s_suppkey % 500 AS STRING)",
    city="CASE WHEN s_suppkey % 3 = 0 THEN 'Casablanca' ELSE 'Ville ' || CAST(s_nationkey AS STRING) END",
    address="CASE WHEN s_suppkey % 2 = 0 THEN 'rue ' || s_name ELSE NULL END",
    type="'Clinique'",
    latitude="CAST(s_acctbal AS STRING)",
    phone="CASE WHEN s_suppkey % 7 = 0 THEN '05' ELSE NULL END",
)

_ALL = (
    f"pub AS ({PUBLIC.sql}), map AS ({MAPPED.sql}), u AS (SELECT 0 AS s, _ord, name, city, region, province, type, source, "
    "NULL AS address, NULL AS latitude, NULL AS phone FROM pub UNION ALL SELECT 1, _ord, name, city, NULL, NULL, type, 'osm', "
    "address, latitude, phone FROM map), "
    f"c AS (SELECT row_number() OVER (ORDER BY s, _ord) AS r, {clean_sql('name')} AS name, {clean_sql('city')} AS city, "
    f"{clean_sql('region')} AS region, {clean_sql('province')} AS province, coalesce({clean_sql('type')}, 'Hôpital') AS type, "
    f"source, {clean_sql('address')} AS address, latitude, phone FROM u), "
    "d AS (SELECT city AS k, arg_min(region, r) AS dr, arg_min(coalesce(province, '?'), r) AS dp FROM c WHERE region IS NOT NULL AND city IS NOT NULL GROUP BY city), "
    "g AS (SELECT c.* EXCLUDE (region, province), coalesce(region, dr) AS region, coalesce(province, nullif(dp, '?')) AS province FROM c LEFT JOIN d ON city = k), "
    "p AS (SELECT region, province, city, row_number() OVER (ORDER BY r) AS id FROM (SELECT * FROM g WHERE city IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY city ORDER BY r) = 1)), "
    "h AS (SELECT g.*, p.id AS place_id, (g.city IS NOT NULL)::INT * 2 + (g.region IS NOT NULL)::INT + (g.province IS NOT NULL)::INT + "
    "(address IS NOT NULL)::INT + (latitude IS NOT NULL)::INT + (phone IS NOT NULL)::INT AS filled FROM g LEFT JOIN p ON g.city = p.city WHERE name IS NOT NULL), "
    "e AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY city, lower(name) ORDER BY filled DESC, r) = 1)"
)


def _normalised(spark, folder, threshold):
    return stages.normalise_hospitals(PUBLIC.frame(spark, folder), MAPPED.frame(spark, folder), threshold)


@query("normalise_places", f"WITH {_ALL} SELECT * FROM p")
def _(spark, folder):
    return _normalised(spark, folder, None)[0]


@query("normalise_hospitals", f"WITH {_ALL} SELECT row_number() OVER (ORDER BY r) AS id, name, city, region, province, type, address, phone, source, place_id FROM e")
def _(spark, folder):
    return _normalised(spark, folder, None)[1].select(
        "id", "name", "city", "region", "province", "type", "address", "phone", "source", "place_id")


@query("normalise_hospitals_fuzzy", f"WITH {_ALL}, best AS (SELECT *, lower(name) AS k FROM e), {losers_sql('best', 'r')} "
       "SELECT row_number() OVER (ORDER BY r) AS id, name, city, region, province, type, address, phone, source, place_id "
       "FROM best WHERE r NOT IN (SELECT loser FROM lost)")
def _(spark, folder):
    return _normalised(spark, folder, 85)[1].select(
        "id", "name", "city", "region", "province", "type", "address", "phone", "source", "place_id")


REFERENCE = View("nation", _ord="n_nationkey", name="'Item ' || CAST(n_nationkey * 3 AS STRING)",
                 code="'REF-' || CAST(n_nationkey AS STRING)", category="CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'Imagerie' END")
DEVICES = View(
    "part", _ord="p_partkey",
    name=("CASE WHEN p_partkey % 9 = 0 THEN 'DCM' WHEN p_partkey % 9 = 1 THEN 'AB' || CAST(p_partkey AS STRING) WHEN p_partkey % 9 = 2 THEN '' "
          "WHEN p_partkey % 9 = 3 THEN 'abcd' ELSE 'Item  ' || CAST(p_partkey % 120 AS STRING) END"),
    category="'Dispositif Médical'",
)
_NOISE = ", ".join(f"'{w}'" for w in DEVICE_NOISE)


@query("normalise_equipment", f"WITH a AS ({REFERENCE.sql}), b AS ({DEVICES.sql}), c AS (SELECT _ord, {clean_sql('name')} AS name, category FROM b), "
       f"u AS (SELECT 0 AS s, _ord, name, code, category FROM a UNION ALL SELECT 1, _ord, name, NULL, category FROM c WHERE name IS NOT NULL "
       f"AND NOT (length(name) < 5 OR regexp_matches(name, '^[A-Z]{{2}}[0-9]+$') OR name IN ({_NOISE}))), "
       "k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY name ORDER BY s, _ord) = 1) "
       "SELECT row_number() OVER (ORDER BY s, _ord) AS id, name, code, coalesce(category, 'Autre équipement') AS category FROM k")
def _(spark, folder):
    return stages.normalise_equipment(REFERENCE.frame(spark, folder), DEVICES.frame(spark, folder))


@query("normalise_medications", "SELECT row_number() OVER (ORDER BY p_partkey) AS id, name, manufacturer, dosage FROM (SELECT p_partkey, "
       "p_name || ' ' || p_brand AS name, p_type AS manufacturer, '000' || CAST(p_size AS VARCHAR) AS dosage FROM part "
       "QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) = 1)")
def _(spark, folder):
    raw = table(spark, folder, "part").select(
        F.col("p_partkey").alias("_ord"), F.concat(F.lit(" "), "p_name", F.lit("  "), "p_brand").alias("SPECIALITE"),
        F.col("p_type").alias("EPI"), F.concat(F.lit("000"), F.col("p_size").cast("string")).alias("DOSAGE"),
        F.lit("x").alias("ignored"))
    return stages.normalise_medications(raw).select("id", "name", "manufacturer", "dosage")
