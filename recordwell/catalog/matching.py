"""Queries that join: lookups, gap fills, containment links, similar names."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwell.catalog.registry import LETTER_RUN, View, query, table
from recordwell.functions import match, text
from recordwell.operators.contain import containment_pairs, link_by_containment
from recordwell.operators.fill import gap_fill, lookup_key
from recordwell.operators.similar import fuzzy_dedup, similar_pairs

GAPS = View(
    "customer",
    id="c_custkey",
    city="CASE WHEN c_custkey % 40 = 39 THEN NULL WHEN c_custkey % 3 = 0 THEN 'CASABLANCA' ELSE 'CITY ' || CAST(c_nationkey AS STRING) || c_mktsegment END",
    region="CASE WHEN c_custkey % 5 = 0 THEN 'R' || CAST(c_custkey AS STRING) ELSE NULL END",
    province="CASE WHEN c_custkey % 4 = 0 THEN 'P' || CAST(c_custkey AS STRING) ELSE NULL END",
)


@query("gap_fill_by_key", f"WITH g AS ({GAPS.sql}), d AS (SELECT city AS k, arg_min(region, id) AS r, "
       "arg_min(coalesce(province, '?'), id) AS p FROM g WHERE region IS NOT NULL AND city IS NOT NULL GROUP BY city) "
       "SELECT id, city, coalesce(region, r) AS region, coalesce(province, nullif(p, '?')) AS province FROM g LEFT JOIN d ON city = k")
def _(spark, folder):
    return gap_fill(GAPS.frame(spark, folder), "city", ["region", "province"], "id")


@query("lookup_key", "SELECT c_custkey, name, n_nationkey AS place_id FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL "
       "WHEN c_custkey % 9 = 1 THEN 'NATION_99' ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS name FROM customer) "
       "LEFT JOIN nation ON name = n_name")
def _(spark, folder):
    df = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN 'NATION_99' "
        "ELSE 'NATION_' || CAST(c_nationkey AS STRING) END AS name")
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    return lookup_key(df, nations, "name", "n_nationkey").select("c_custkey", "name", "place_id")


SUPPLIED = View("orders", medication_id="o_orderkey",
                manufacturer="CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'Brand#' || CAST(o_custkey % 30 AS STRING) END")
SELLERS = View("part", supplier_id="p_partkey", name="'GROUPE ' || upper(p_brand) || ' ' || p_type || ' ' || p_name")


@query("containment_first_match", f"WITH m AS ({SUPPLIED.sql}), s AS ({SELLERS.sql}), "
       "f AS (SELECT n, min(supplier_id) AS supplier_id FROM (SELECT DISTINCT lower(manufacturer) AS n FROM m WHERE manufacturer IS NOT NULL) "
       "JOIN s ON contains(lower(name), n) GROUP BY n) "
       "SELECT supplier_id, medication_id FROM m JOIN f ON lower(manufacturer) = n")
def _(spark, folder):
    return link_by_containment(
        SUPPLIED.frame(spark, folder), "manufacturer", "medication_id",
        SELLERS.frame(spark, folder), "name", "supplier_id", "supplier_id")


@query("containment_spaceless", f"WITH m AS ({SUPPLIED.sql}), s AS ({SELLERS.sql}), "
       "t AS (SELECT DISTINCT replace(replace(lower(manufacturer || ' - ' || CAST(medication_id % 2 AS VARCHAR)), ' ', ''), '-', '') AS n FROM m "
       "WHERE manufacturer IS NOT NULL), f AS (SELECT n, min(supplier_id) AS supplier_id FROM t JOIN s "
       "ON contains(replace(replace(lower(name), ' ', ''), '-', ''), n) GROUP BY n) "
       "SELECT supplier_id, medication_id FROM m JOIN f ON "
       "replace(replace(lower(manufacturer || ' - ' || CAST(medication_id % 2 AS VARCHAR)), ' ', ''), '-', '') = n")
def _(spark, folder):
    meds = SUPPLIED.frame(spark, folder).withColumn(
        "manufacturer", F.concat("manufacturer", F.lit(" - "), (F.col("medication_id") % 2).cast("string")))
    return link_by_containment(
        meds, "manufacturer", "medication_id", SELLERS.frame(spark, folder), "name", "supplier_id", "supplier_id",
        key=lambda c: text.spaceless(F.lower(c)))


@query("containment_pairs", "WITH h AS (SELECT DISTINCT split_part(url, '/', 3) AS host FROM pages), "
       "w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark), "
       "n AS (SELECT word FROM w WHERE length(word) >= 5) SELECT host, word FROM h JOIN n ON contains(host, word)")
def _(spark, folder):
    hosts = table(spark, folder, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("host")).distinct()
    words = table(spark, folder, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("word"))
    return containment_pairs(hosts, "host", words.filter(F.length("word") >= 5).distinct(), "word").select("host", "word")


@query("containment_all_words", "WITH h AS (SELECT DISTINCT split_part(url, '/', 3) AS host FROM pages), "
       f"w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{LETTER_RUN}')) AS word FROM benchmark) "
       "SELECT host, word FROM h JOIN w ON contains(host, word)")
def _(spark, folder):
    hosts = table(spark, folder, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("host")).distinct()
    words = table(spark, folder, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTER_RUN), F.lit(0))).alias("word"))
    return containment_pairs(hosts, "host", words.distinct(), "word").select("host", "word")


# Facility names with variants, a city that holds a third of all rows, and rows without a city.
FACILITIES = View(
    "part",
    id="p_partkey",
    name=(
        "CASE WHEN p_partkey % 5 = 1 THEN substr(p_name, 1, 3) || substr(p_name, 5) WHEN p_partkey % 5 = 2 THEN p_name || 's' "
        "WHEN p_partkey % 5 = 3 THEN 'the ' || p_name WHEN p_partkey % 25 = 4 THEN NULL ELSE upper(p_name) END"
    ),
    city="CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 'CASABLANCA' ELSE p_brand END",
    source="CASE WHEN p_size % 2 = 0 THEN 'gov' ELSE 'osm' END",
    phone="CASE WHEN p_size % 7 < 3 THEN NULL ELSE '05' END",
    email="CASE WHEN p_size % 11 < 5 THEN NULL ELSE 'a@b.ma' END",
    beds="CASE WHEN p_size % 13 < 9 THEN NULL ELSE p_size END",
)


def _lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence by bit rows: for names below 62 letters."""
    full = f"(1::BIGINT << length({a})) - 1"
    masks = (
        f"list_transform(string_split({b}, ''), lambda c: coalesce(list_sum(list_transform(range(1, length({a}) + 1), "
        f"lambda i: CASE WHEN {a}[i:i] = c THEN 1::BIGINT << (i - 1)::INT ELSE 0::BIGINT END)), 0)::BIGINT)"
    )
    step = f"lambda v, m: (((v + (v & m)) | (v & ~m)) & ({full}))"
    return f"(length({a}) - bit_count(list_reduce(list_prepend({full}, {masks}), {step})))"


@query("fuzzy_pairs", f"WITH f AS ({FACILITIES.sql}), d AS (SELECT DISTINCT city, lower(name) AS name FROM f WHERE name IS NOT NULL), "
       "p AS (SELECT x.city, x.name AS a, y.name AS b FROM d x JOIN d y ON x.city IS NOT DISTINCT FROM y.city AND x.name < y.name) "
       f"SELECT city, a, b FROM p WHERE round_even(200.0::DOUBLE * {_lcs_sql('a', 'b')} / (length(a) + length(b)), 0) > 85")
def _(spark, folder):
    df = FACILITIES.frame(spark, folder).filter(F.col("name").isNotNull())
    names = df.select("city", F.lower("name").alias("name")).distinct()
    pairs = similar_pairs(names, "name", ["city"], 85)
    return pairs.select(F.col("block.city").alias("city"), F.col("a.name").alias("a"), F.col("b.name").alias("b"))


@query("similarity", f"WITH w AS (SELECT DISTINCT p_name AS a FROM part), q AS (SELECT x.a, y.a AS b FROM w x JOIN w y ON split_part(x.a, ' ', 2) = split_part(y.a, ' ', 2)) "
       f"SELECT a, b, CAST(round_even(200.0::DOUBLE * {_lcs_sql('a', 'b')} / (length(a) + length(b)), 0) AS INT) AS similarity FROM q")
def _(spark, folder):
    names = table(spark, folder, "part").select(F.col("p_name").alias("a")).distinct()
    names = names.withColumn("noun", F.split_part("a", F.lit(" "), F.lit(2)))
    other = names.select(F.col("a").alias("b"), F.col("noun").alias("noun2"))
    both = names.join(other, F.col("noun") == F.col("noun2"))
    return both.select("a", "b", match.indel_similarity("a", "b").alias("similarity"))


def losers_sql(best: str, key: str, threshold: int = 85) -> str:
    """CTEs ending in ``lost``: rows of ``best`` (city, lower name k, filled, source) that lose their duels.

    The duels of a city are folded in time order over a list of those already gone.
    """
    return (
        f"pairs AS (SELECT x.city, least(x.{key}, y.{key}) AS i, greatest(x.{key}, y.{key}) AS j FROM {best} x JOIN {best} y "
        f"ON x.city IS NOT DISTINCT FROM y.city AND x.k < y.k "
        f"WHERE round_even(200.0::DOUBLE * {_lcs_sql('x.k', 'y.k')} / (length(x.k) + length(y.k)), 0) > {threshold}), "
        "duels AS (SELECT p.city, CASE WHEN a.filled >= b.filled THEN i ELSE j END AS w, CASE WHEN a.filled >= b.filled THEN j ELSE i END AS l, "
        "CASE a.source WHEN 'osm' THEN 0 ELSE 1 END AS va, i, CASE b.source WHEN 'osm' THEN 0 ELSE 1 END AS vb, j "
        f"FROM pairs p JOIN {best} a ON a.{key} = i JOIN {best} b ON b.{key} = j), "
        "folded AS (SELECT list_reduce(list_prepend({'w': -1::BIGINT, 'l': -1::BIGINT, 'gone': []::BIGINT[]}, "
        "list({'w': w::BIGINT, 'l': l::BIGINT, 'gone': []::BIGINT[]} ORDER BY va, i, vb, j)), "
        "lambda s, d: {'w': d.w, 'l': d.l, 'gone': CASE WHEN list_contains(s.gone, d.w) OR list_contains(s.gone, d.l) "
        "THEN s.gone ELSE list_append(s.gone, d.l) END}).gone AS gone FROM duels GROUP BY city), "
        "lost AS (SELECT unnest(gone) AS loser FROM folded)"
    )


@query("fuzzy_dedup", f"WITH f AS ({FACILITIES.sql}), r AS (SELECT *, lower(name) AS k, (name IS NOT NULL)::INT + (city IS NOT NULL)::INT + "
       "(phone IS NOT NULL)::INT + (email IS NOT NULL)::INT + (beds IS NOT NULL)::INT AS filled FROM f), "
       "best AS (SELECT * FROM r WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY city, k ORDER BY filled DESC, id) = 1), "
       f"{losers_sql('best', 'id')} SELECT id, name, city, source, phone, email, beds FROM best WHERE id NOT IN (SELECT loser FROM lost) "
       "UNION ALL SELECT id, name, city, source, phone, email, beds FROM r WHERE name IS NULL OR name = ''")
def _(spark, folder):
    df = FACILITIES.frame(spark, folder)
    visit = [F.when(F.col("source") == "osm", 0).otherwise(1)]
    return fuzzy_dedup(df, "name", ["city"], "id", visit)


@query("exact_name_dedup", f"WITH f AS ({FACILITIES.sql}), r AS (SELECT *, (name IS NOT NULL)::INT + (city IS NOT NULL)::INT + "
       "(phone IS NOT NULL)::INT + (email IS NOT NULL)::INT + (beds IS NOT NULL)::INT AS filled FROM f) "
       "SELECT id, name, city, source, phone, email, beds FROM r QUALIFY name IS NULL OR "
       "row_number() OVER (PARTITION BY city, lower(name) ORDER BY filled DESC, id) = 1")
def _(spark, folder):
    return fuzzy_dedup(FACILITIES.frame(spark, folder), "name", ["city"], "id", threshold=None)
