"""Queries on whole tables: keys, references, constraints, files, ledgers, streams."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from recordwell.catalog.registry import HOSPITALS, MEDICATIONS, query, table
from recordwell.functions.text import clean_text
from recordwell.operators import checks
from recordwell.session import cut_lineage, ensure_checkpoint_dir
from recordwell.sources import readers, writers
from recordwell.sources.ledger import Ledger
from recordwell.sources.schemas import Constraints
from recordwell.streaming.incremental import process_new_files

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def scratch(spark, name: str) -> str:
    """A folder of its own under the shared one."""
    return f"{ensure_checkpoint_dir(spark)}/recordwell/{name}-{uuid.uuid4().hex}"


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'warn' END AS status FROM {t}" for t in _TABLES))
def _(spark, folder):
    return checks.table_counts({t: table(spark, folder, t) for t in _TABLES})


@query("fk_orphans", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def _(spark, folder):
    parent = table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    child = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return checks.fk_orphans(child, "l_orderkey", parent, "o_orderkey")


@query("orphan_keys", "SELECT l_suppkey, count(*) AS rows FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey")
def _(spark, folder):
    parent = table(spark, folder, "supplier").filter("s_acctbal > 0")
    return checks.orphan_keys(table(spark, folder, "lineitem"), "l_suppkey", parent, "s_suppkey")


@query("pk_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def _(spark, folder):
    return checks.duplicate_report(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("delete_set_null", "SELECT o_orderkey, c_custkey AS o_custkey, o_totalprice FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey")
def _(spark, folder):
    kept = table(spark, folder, "customer").filter("c_acctbal > 0")
    child = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return checks.set_null_on_delete(child, "o_custkey", kept, "c_custkey")


@query("delete_cascade", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def _(spark, folder):
    kept = table(spark, folder, "supplier").filter("s_acctbal > 0")
    child = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return checks.cascade_on_delete(child, "l_suppkey", kept, "s_suppkey")


@query("constraint_violations", f"WITH m AS ({MEDICATIONS.sql}) SELECT id, 'price_public: not null' AS rule FROM m WHERE price_public IS NULL "
       "UNION ALL SELECT id, 'active_substance: length <= 20' FROM m WHERE length(active_substance) > 20 "
       "UNION ALL SELECT id, 'price_public: decimal(10,2)' FROM m WHERE TRY_CAST(price_public AS DECIMAL(10,2)) IS NULL")
def _(spark, folder):
    rules = Constraints(("id", "price_public"), {"active_substance": 20}, {"price_public": (10, 2), "price_hospital": (10, 2)})
    return checks.constraint_violations(MEDICATIONS.frame(spark, folder), rules, "id")


@query("conform_table", f"WITH h AS ({HOSPITALS.sql}) SELECT CAST(id AS INT) AS id, name, CAST(place_id AS INT) AS place_id, CAST(beds AS INT) AS beds, "
       "CAST(NULL AS VARCHAR) AS source FROM h")
def _(spark, folder):
    df = writers.conform(HOSPITALS.frame(spark, folder), "hospitals")
    return df.select("id", "name", "place_id", "beds", "source")


@query("csv_round_trip", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_name || ', \"' || p_brand || '\"' || chr(10) || p_type END AS label FROM part")
def _(spark, folder):
    label = F.when(F.col("p_partkey") % 9 == 0, "N/A").otherwise(
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n'), "p_type"))
    path = scratch(spark, "csv")
    writers.write_csv(table(spark, folder, "part").select("p_partkey", label.alias("label")), path)
    return readers.read_csv(spark, path)


@query("json_round_trip", "SELECT CAST(c_custkey AS VARCHAR) AS \"ID\", c_name AS \"NOM\", CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS \"VILLE\" FROM customer")
def _(spark, folder):
    path = scratch(spark, "json")
    df = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("NOM"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("VILLE"))
    df.write.json(path)
    return readers.read_json_objects(spark, path, ["ID", "NOM", "VILLE"], multi_line=False)


@query("ledger_resume", "SELECT o_orderstatus, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS check_sum FROM orders GROUP BY o_orderstatus")
def _(spark, folder):
    """Three slices, the second written twice: every order is in the ledger once."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    ledger = Ledger(spark, scratch(spark, "ledger"), orders.schema, "o_orderkey")
    ledger.append(orders.filter("o_orderstatus = 'F'"), 0)
    ledger.append(orders.filter("o_orderstatus = 'O'"), 1)
    ledger.append(orders.filter("o_orderstatus = 'O'"), 1)
    ledger.append(ledger.pending(orders), 2)
    return ledger.read().groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.sum("o_custkey").alias("check_sum"))


@query("stream_clean", "SELECT event_id, upper(event_type) AS event_type FROM events")
def _(spark, folder):
    schema = table(spark, folder, "events").schema
    out = scratch(spark, "stream")
    stream = process_new_files(
        spark, folder, schema, f"{out}/rows", f"{out}/state",
        lambda df: df.select("event_id", F.upper(clean_text("event_type")).alias("event_type")),
        pathGlobFilter="events.parquet")
    stream.awaitTermination()
    return spark.read.schema("event_id BIGINT, event_type STRING").parquet(f"{out}/rows").select("event_id", "event_type")


_STATES = ("b AS (SELECT doc_id AS id, CASE WHEN doc_id % 4 > 0 THEN lang END AS lang, source, CASE WHEN doc_id % 6 > 0 THEN n_chars END AS n_chars FROM documents), "
           "a AS (SELECT id, CASE WHEN id % 5 > 0 THEN coalesce(lang, 'xx') ELSE lang END AS lang, source, coalesce(n_chars, 0) AS n_chars FROM b WHERE id % 9 > 0)")


@query("observed_changes", f"WITH {_STATES}, s AS (SELECT count(*) AS rows_before, count(*) FILTER (a.id IS NULL) AS rows_deleted, "
       "count(*) FILTER (a.id IS NOT NULL AND (a.lang IS DISTINCT FROM b.lang OR a.n_chars IS DISTINCT FROM b.n_chars)) AS rows_updated, "
       "count(*) FILTER (a.lang IS NOT NULL AND b.lang IS NULL) AS lang_found, 0::BIGINT AS source_found, "
       "count(*) FILTER (a.n_chars IS NOT NULL AND b.n_chars IS NULL) AS n_chars_found FROM b LEFT JOIN a ON a.id = b.id) "
       "SELECT a.*, s.* FROM a, s")
def _(spark, folder):
    """The rows of the later state next to what their write has counted."""
    before = table(spark, folder, "documents").selectExpr(
        "doc_id AS id", "CASE WHEN doc_id % 4 > 0 THEN lang END AS lang", "source", "CASE WHEN doc_id % 6 > 0 THEN n_chars END AS n_chars")
    after = before.filter("id % 9 > 0").selectExpr(
        "id", "CASE WHEN id % 5 > 0 THEN coalesce(lang, 'xx') ELSE lang END AS lang", "source", "coalesce(n_chars, 0) AS n_chars")
    path = scratch(spark, "changes")
    counts = checks.write_changes(before, after, "id", ["lang", "source", "n_chars"], path)
    return spark.read.schema(after.schema).parquet(path).withColumns({name: F.lit(n).cast("long") for name, n in counts.items()})


@query("save_modes", "SELECT doc_id AS id, 'appended' AS how, NULL::INT AS beds, lang FROM documents "
       "UNION ALL SELECT doc_id, 'replaced', NULL, lang FROM documents WHERE doc_id % 3 > 0 "
       "UNION ALL SELECT doc_id, 'promoted', CASE WHEN doc_id % 2 = 0 THEN CAST(n_chars % 300 AS INT) END, NULL FROM documents WHERE doc_id % 5 > 0 "
       "UNION ALL SELECT doc_id, 'defaults', 0, NULL FROM documents WHERE doc_id % 5 = 0 "
       "UNION ALL SELECT doc_id, 'carried', NULL, lang FROM documents WHERE doc_id % 7 = 0")
def _(spark, folder):
    """Tables that are appended to, replaced, promoted into and carried forward; a second ``fail`` writes nothing.

    NaN is published as null, a column the rows lack takes its default.
    """
    docs = table(spark, folder, "documents").selectExpr("doc_id AS id", "lang", "n_chars")
    rows = docs.select("id", "lang")
    database = f"save_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for part in range(2):
        writers.save_table(rows.filter(F.col("id") % 2 == part), f"{database}.appended", "append")
    writers.save_table(rows, f"{database}.replaced", "fail")
    try:
        writers.save_table(rows.limit(0), f"{database}.replaced", "fail")
    except AnalysisException:
        writers.save_table(rows.filter("id % 3 > 0"), f"{database}.replaced", "replace")
    beds = F.when(F.col("id") % 2 == 0, (F.col("n_chars") % 300).cast("double")).otherwise(F.lit(float("nan")))
    target = StructType([StructField("id", LongType()), StructField("beds", IntegerType())])
    writers.create_tables(spark, database, {"promoted": target})
    for given in (docs.filter("id % 5 > 0").select("id", beds.alias("beds")), docs.filter("id % 5 = 0").select("id")):
        writers.promote(writers.conform(given, "hospitals", target), f"{database}.promoted")
    stages = scratch(spark, "stages")
    writers.write_stage(rows.filter("id % 7 = 0"), f"{stages}/one", "carried")
    writers.carry_forward(spark, f"{stages}/one", f"{stages}/two", ["carried", "absent"])

    promoted = spark.table(f"{database}.promoted")
    parts = [
        spark.table(f"{database}.appended").select("id", F.lit("appended").alias("how"), F.lit(None).cast("int").alias("beds"), "lang"),
        spark.table(f"{database}.replaced").select("id", F.lit("replaced").alias("how"), F.lit(None).cast("int").alias("beds"), "lang"),
        promoted.select("id", F.when(F.col("id") % 5 > 0, "promoted").otherwise("defaults").alias("how"), "beds", F.lit(None).cast("string").alias("lang")),
        spark.read.schema(rows.schema).parquet(f"{stages}/two/carried").select("id", F.lit("carried").alias("how"), F.lit(None).cast("int").alias("beds"), "lang"),
    ]
    whole = cut_lineage(reduce(DataFrame.unionByName, parts))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return whole
