"""Queries on what outlives a job: call logs, caches, snapshots, deletes over the key graph."""

from __future__ import annotations

from contextlib import suppress
from functools import partial

from pyspark.sql import functions as F

from recordwell.catalog.enrichment import offline_capacity
from recordwell.catalog.registry import HOSPITALS, query, table
from recordwell.catalog.tables import scratch
from recordwell.functions.messages import parse_capacity
from recordwell.operators import inference, references
from recordwell.operators.calls import CallLog
from recordwell.session import cut_lineage
from recordwell.sources.runs import RunTable
from recordwell.sources.schemas import LOAD_ORDER
from recordwell.sources.snapshot import Snapshots

#: Batches of a slice in ``enrich_resume``.
_SLICE = 200
#: Calls of a task in ``enrich_resume``: they take less than starting a task does.
_TOGETHER = 25


@query("enrich_resume", f"WITH h AS ({HOSPITALS.sql}), b AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 10 AS batch_id FROM h), "
       f"s AS (SELECT max(batch_id) // {_SLICE} + 1 AS slices FROM b) "
       f"SELECT b.id, b.batch_id, CASE WHEN b.batch_id // {_SLICE} < slices // 2 THEN 'first' ELSE 'second' END AS run, 1::BIGINT AS claims, 1::BIGINT AS calls, "
       "CASE WHEN b.id % 2 = 0 THEN CAST(10 + b.id % 90 AS INT) END AS beds FROM b, s")
def _(spark, folder):
    """Half the slices are answered by a first run; the second asks only the others, and no batch is asked twice."""
    rows = HOSPITALS.frame(spark, folder).select("id", "name", "type")
    batched = cut_lineage(inference.batches(rows, ["id", "name", "type"], "id", inference.CAPACITY_BATCH))
    prompts = batched.select("batch_id", inference.capacity_prompt(F.col("records")).alias("prompt"))
    log = CallLog(spark, scratch(spark, "calls"))
    slices = batched.agg(F.expr(f"max(batch_id) div {_SLICE} + 1")).first()[0]
    log.run(prompts, offline_capacity(), "first", _SLICE, slices // 2, check=inference.is_capacities, together=_TOGETHER)
    log.run(prompts, offline_capacity(), "second", _SLICE, check=inference.is_capacities, together=_TOGETHER)
    log.run(prompts, offline_capacity(), "third", _SLICE, check=inference.is_capacities, together=_TOGETHER)
    asked = log.claims().groupBy(F.col("batch_id").alias("_b")).agg(F.count("*").alias("claims"))
    made = log.answers().groupBy(F.col("batch_id").alias("_c")).agg(F.sum("calls").alias("calls"))
    found = log.replies().select(
        F.col("batch_id").alias("_r"), "run",
        F.map_from_entries(F.transform(parse_capacity("reply"), lambda h: F.struct(h["id"].cast("long"), h["beds"]))).alias("beds"))
    members = batched.select("batch_id", F.explode("records.id").alias("id"))
    joined = members.join(asked, F.col("batch_id") == F.col("_b")).join(made, F.col("batch_id") == F.col("_c")).join(
        found, F.col("batch_id") == F.col("_r"))
    return joined.select("id", "batch_id", "run", "claims", "calls", F.col("beds")[F.col("id")].alias("beds"))


@query("cache_write_back", "WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS run FROM orders) "
       "SELECT CAST(o_custkey AS BIGINT) AS key, CAST(run AS BIGINT) AS run, o_orderkey AS value, true AS same_after_compaction "
       "FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY run DESC, o_orderkey DESC) = 1")
def _(spark, folder):
    """Three runs with overlapping keys: the latest run answers, before and after they are written as one."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("long").alias("key"), F.col("o_orderkey").cast("long").alias("value"), "o_orderstatus")
    store = RunTable(spark, scratch(spark, "store"), orders.drop("o_orderstatus").schema, "key")
    for status in ("o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus NOT IN ('F', 'O')"):
        store.append(orders.filter(status).select("key", "value"))
    # the rows of the old state can be read until they are vacuumed
    before = store.read(with_run=True).select("key", F.col("_run").alias("run"), "value")
    store.compact()
    after = store.read().select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    both = before.join(after, F.col("key") == F.col("_key"), "left")
    return both.select("key", "run", "value", F.col("value").eqNullSafe(F.col("_value")).alias("same_after_compaction"))


# Which rows are deleted by name, and what follows: some references go with their parent, some are emptied.
_REFERENCES = (
    ("nation", "n_regionkey", "region", "cascade"), ("customer", "c_nationkey", "nation", "set null"),
    ("supplier", "s_nationkey", "nation", "cascade"), ("orders", "o_custkey", "customer", "cascade"),
    ("lineitem", "l_orderkey", "orders", "cascade"), ("lineitem", "l_partkey", "part", "cascade"),
    ("lineitem", "l_suppkey", "supplier", "set null"),
)
_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey"}
_DELETED = {"region": "r_regionkey = 2", "customer": "c_custkey % 10 = 0", "part": "p_partkey % 50 = 3"}
#: Per table: its key and the references to show.
_SHOWN = {
    "region": ("r_regionkey", "NULL", "NULL"), "nation": ("n_nationkey", "n_regionkey", "NULL"), "customer": ("c_custkey", "c_nationkey", "NULL"),
    "supplier": ("s_suppkey", "s_nationkey", "NULL"), "part": ("p_partkey", "NULL", "NULL"), "orders": ("o_orderkey", "o_custkey", "NULL"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey"),
}


def _shown(name: str, kind: str) -> str:
    key, first, second = _SHOWN[name]
    return (f"'{name}' AS table_name, CAST({key} AS {kind}) AS row_key, CAST({first} AS {kind}) AS reference, "
            f"CAST({second} AS {kind}) AS other_reference")


@query("delete_graph", "WITH reg AS (SELECT * FROM region WHERE r_regionkey <> 2), "
       "nat AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM reg)), "
       "cus AS (SELECT * REPLACE (CASE WHEN c_nationkey IN (SELECT n_nationkey FROM nat) THEN c_nationkey END AS c_nationkey) FROM customer WHERE c_custkey % 10 <> 0), "
       "sup AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nat)), "
       "par AS (SELECT * FROM part WHERE p_partkey % 50 <> 3), "
       "ord AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0)), "
       "gone AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ord)), "
       "lin AS (SELECT * REPLACE (CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM sup)) THEN NULL ELSE l_suppkey END AS l_suppkey) "
       "FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone) AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 50 = 3)) "
       + " UNION ALL ".join(f"SELECT {_shown(t, 'BIGINT')} FROM {t[:3]}" for t in _SHOWN))
def _(spark, folder):
    tables = {name: table(spark, folder, name) for name in _SHOWN}
    deleted = {name: tables[name].filter(rule).select(_KEYS[name]) for name, rule in _DELETED.items()}
    left = references.delete_rows(tables, _REFERENCES, deleted, _KEYS)
    parts = [left[name].selectExpr(*_shown(name, "BIGINT").split(", ")) for name in _SHOWN]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


#: Eleven tables made from the given ones: the given table, its key and a column to add up.
_ELEVEN = {
    "places": ("nation", "n_nationkey", "n_regionkey"), "services": ("region", "r_regionkey", "r_regionkey"),
    "equipment": ("part", "p_partkey", "p_size"), "medications": ("part", "p_partkey", "p_partkey"),
    "suppliers": ("supplier", "s_suppkey", "s_nationkey"), "hospitals": ("customer", "c_custkey", "c_nationkey"),
    "hospital_services": ("orders", "o_orderkey", "o_custkey"), "hospital_equipment": ("orders", "o_custkey", "o_orderkey"),
    "hospital_medications": ("lineitem", "l_orderkey", "l_partkey"), "supplier_medications": ("lineitem", "l_suppkey", "l_partkey"),
    "supplier_equipment": ("documents", "doc_id", "n_chars"),
}


@query("snapshot_refresh", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, 1 AS version, {key} % 1000 AS part, count(*) AS rows, CAST(sum({value}) AS BIGINT) AS total FROM {source} GROUP BY {key} % 1000"
    for name, (source, key, value) in _ELEVEN.items()))
def _(spark, folder):
    """A refresh that fails after its sixth table leaves the eleven tables of the one before."""
    def frame(name, changed):
        source, key, value = _ELEVEN[name]
        if changed and name == LOAD_ORDER[6]:
            raise InterruptedError("the job dies here")
        return table(spark, folder, source).select(
            F.col(key).cast("long").alias("key"), (F.col(value).cast("long") + F.lit(changed)).alias("value"))

    store = Snapshots(spark, scratch(spark, "snapshot"))
    store.refresh({name: frame(name, 0) for name in _ELEVEN}, typed=False)
    with suppress(InterruptedError):
        store.refresh({name: partial(frame, name, 1) for name in _ELEVEN}, typed=False)
    parts = [
        df.groupBy((F.col("key") % 1000).alias("part")).agg(F.count("*").alias("rows"), F.sum("value").alias("total")).select(
            F.lit(name).alias("table_name"), F.lit(store.manifest.latest()[0]).alias("version"), "part", "rows", "total")
        for name, df in store.tables().items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
