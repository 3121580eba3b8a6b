"""Queries on columns, filters, unions and row identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwell.catalog.registry import View, fold_sql, query, table
from recordwell.functions import text
from recordwell.operators import checks, columns as cols, keys

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean_sql(c: str) -> str:
    squeezed = f"trim(regexp_replace({c}, '{_WS}', ' ', 'g'))"
    return f"CASE WHEN {squeezed} = '' OR lower({squeezed}) IN ('nan', 'none', 'null') THEN NULL ELSE {squeezed} END"


@query("clean_text", f"SELECT doc_id, {clean_sql('text')} AS text FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.clean_text("text").alias("text"))


DIRTY_PARTS = View(
    "part",
    p_partkey="p_partkey",
    name=(
        "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN ' NaN ' "
        "WHEN p_partkey % 7 = 2 THEN 'None' WHEN p_partkey % 7 = 3 THEN '   ' "
        "WHEN p_partkey % 7 = 4 THEN '  ' || p_name || ' \t ' || p_brand ELSE p_name END"
    ),
    code="CASE WHEN p_partkey % 5 = 0 THEN 'EQ' || CAST(p_size AS STRING) WHEN p_partkey % 5 = 1 THEN 'DCM' ELSE p_name END",
    category="CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END",
)


@query("map_text_columns", f"WITH d AS ({DIRTY_PARTS.sql}) SELECT p_partkey, {clean_sql('name')} AS name, "
       f"{clean_sql('code')} AS code, {clean_sql('category')} AS category FROM d")
def _(spark, folder):
    return cols.map_text_columns(DIRTY_PARTS.frame(spark, folder))


@query("drop_all_null", f"WITH d AS ({DIRTY_PARTS.sql}), c AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 "
       f"THEN {clean_sql('name')} END AS name, category FROM d) "
       "SELECT * FROM c WHERE name IS NOT NULL OR category IS NOT NULL")
def _(spark, folder):
    df = cols.clean_columns(DIRTY_PARTS.frame(spark, folder), ["name"])
    df = df.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("name")).alias("name"), "category")
    return df.na.drop("all", subset=["name", "category"])


@query("reject_null_tokens", f"WITH d AS ({DIRTY_PARTS.sql}) SELECT p_partkey, name FROM d "
       "WHERE name IS NOT NULL AND lower(trim(name, ' \t')) NOT IN ('nan', 'none', '')")
def _(spark, folder):
    return DIRTY_PARTS.frame(spark, folder).filter(~text.is_null_token("name")).select("p_partkey", "name")


@query("first_nonblank", f"WITH d AS ({DIRTY_PARTS.sql}) SELECT p_partkey, "
       "coalesce(nullif(category, ''), nullif(name, '')) AS label FROM d")
def _(spark, folder):
    return DIRTY_PARTS.frame(spark, folder).select("p_partkey", text.first_nonblank("category", "name").alias("label"))


@query("noise_filter", f"WITH d AS ({DIRTY_PARTS.sql}) SELECT p_partkey, code FROM d "
       "WHERE NOT (length(code) < 5 OR regexp_matches(code, '^[A-Z]{2}[0-9]+$') OR code IN ('Code CNOPS', 'Dispositif Médical', 'DCM'))")
def _(spark, folder):
    from recordwell.sources.schemas import DEVICE_NOISE
    df = DIRTY_PARTS.frame(spark, folder).select("p_partkey", "code")
    return df.filter(~checks.noise("code", blacklist=DEVICE_NOISE))


@query("coalesce_default", f"WITH d AS ({DIRTY_PARTS.sql}) SELECT p_partkey, "
       "coalesce(category, 'Autre équipement') AS category, 'Standard' AS grade FROM d")
def _(spark, folder):
    df = DIRTY_PARTS.frame(spark, folder).select("p_partkey", "category")
    return cols.fill_defaults(df, {"category": "Autre équipement"}, absent={"grade": "Standard"})


@query("coerce_numeric", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, "
       "TRY_CAST(CASE WHEN event_id % 5 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) AS mixed FROM events")
def _(spark, folder):
    events = table(spark, folder, "events")
    mixed = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    return events.select(
        "event_id", text.to_number(F.get_json_object("props", "$.k")).alias("k"), text.to_number(mixed).alias("mixed"))


@query("rename_synonyms", "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS place_id FROM supplier")
def _(spark, folder):
    df = table(spark, folder, "supplier").toDF(" SPECIALITE ", "nom", "EPI", "nom2")
    # two headers mean "name": the first one stands
    df = cols.rename_synonyms(df, {"SPECIALITE": "id", "nom": "name", "nom2": "name", "EPI": "place_id"})
    return df.select("id", "name", "place_id")


@query("resolve_column", "SELECT p_partkey, p_name AS name, p_brand FROM part")
def _(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("Description du produit"), "p_brand")
    return cols.resolve_column(df, ["nom", "description", "device", "materiel"], "name")


@query("select_allowed", "SELECT p_partkey AS id, p_name AS name, CAST(NULL AS VARCHAR) AS code, 'part' AS source FROM part")
def _(spark, folder):
    df = table(spark, folder, "part").withColumnsRenamed({"p_partkey": "id", "p_name": "name"})
    df = cols.with_constants(cols.ensure_columns(df, ["code"]), {"source": "part"})
    return cols.select_allowed(df, ["id", "name", "code", "source", "absent"])


@query("union_by_name", "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment, 'supplier' AS source FROM supplier "
       "UNION ALL SELECT c_custkey, c_name, c_mktsegment, 'customer' FROM customer")
def _(spark, folder):
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "'supplier' AS source")
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment", "'customer' AS source")
    return keys.union_aligned([suppliers, customers]).select("id", "name", "segment", "source")


@query("dedup_keep_first", "SELECT p_partkey, p_name, p_brand, p_type FROM part "
       "QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) = 1")
def _(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return keys.keep_best(df, ["p_name", "p_brand"], ["p_partkey"])


@query("dedup_hot_key", "SELECT l_orderkey, l_partkey, l_linenumber, l_shipmode FROM (SELECT l_orderkey, l_partkey, l_linenumber, "
       "l_returnflag || l_linestatus AS l_shipmode FROM lineitem) "
       "QUALIFY row_number() OVER (PARTITION BY l_shipmode ORDER BY l_orderkey, l_linenumber, l_partkey) = 1")
def _(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("l_shipmode"))
    return keys.keep_best(df, ["l_shipmode"], ["l_orderkey", "l_linenumber", "l_partkey"])


_NAMES = ("SELECT 0 AS prio, s_suppkey AS ord, 'Name ' || CAST(s_suppkey % 700 AS VARCHAR) AS name, 'Dispositif' AS category, "
          "CAST(NULL AS VARCHAR) AS city FROM supplier UNION ALL "
          "SELECT 1, c_custkey, 'Name ' || CAST(c_custkey % 900 AS VARCHAR), 'Grossiste', c_mktsegment FROM customer")


@query("priority_union", f"SELECT ord, name, category, city FROM ({_NAMES}) "
       "QUALIFY row_number() OVER (PARTITION BY name ORDER BY prio, ord) = 1")
def _(spark, folder):
    first = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS ord", "'Name ' || CAST(s_suppkey % 700 AS STRING) AS name", "'Dispositif' AS category")
    second = table(spark, folder, "customer").selectExpr(
        "c_custkey AS ord", "'Name ' || CAST(c_custkey % 900 AS STRING) AS name", "'Grossiste' AS category", "c_mktsegment AS city")
    return keys.priority_union([first, second], ["name"], "ord").select("ord", "name", "category", "city")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("minus_ids", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    shipped = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keys.minus_ids(orders, shipped, "o_orderkey")


@query("dense_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def _(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return keys.dense_id(df, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@query("batch_ids", "SELECT batch_id, count(*) AS batch_rows, min(event_id) AS first_event, max(event_id) AS last_event FROM "
       "(SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS batch_id FROM events) GROUP BY batch_id")
def _(spark, folder):
    df = keys.dense_id(table(spark, folder, "events").select("ts", "event_id"), ["ts", "event_id"], "n")
    return df.groupBy(keys.batch_of("n", 1000).alias("batch_id")).agg(
        F.count("*").alias("batch_rows"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


@query("completeness", f"WITH d AS ({DIRTY_PARTS.sql}) SELECT p_partkey, "
       "(name IS NOT NULL)::INT + (code IS NOT NULL)::INT + (category IS NOT NULL)::INT AS filled FROM d")
def _(spark, folder):
    df = DIRTY_PARTS.frame(spark, folder)
    return df.select("p_partkey", cols.completeness(["name", "code", "category"]).alias("filled"))


@query("fold_key", f"SELECT {fold_sql('text')} AS folded, count(*) AS documents FROM documents GROUP BY 1")
def _(spark, folder):
    return table(spark, folder, "documents").groupBy(text.fold("text").alias("folded")).agg(F.count("*").alias("documents"))


@query("preview", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_name, p_partkey LIMIT 50")
def _(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    return keys.top_rows(df, ["p_name", "p_partkey"], 50)


@query("sort_by_source", "SELECT doc_id, source, lang FROM documents ORDER BY source DESC, doc_id")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "source", "lang").orderBy(F.desc("source"), "doc_id")


@query("type_lengths", "SELECT doc_id, CAST(length(text) AS INT) AS characters, CAST(octet_length(encode(text)) AS INT) AS bytes FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.length("text").alias("characters"), F.octet_length("text").alias("bytes"))
