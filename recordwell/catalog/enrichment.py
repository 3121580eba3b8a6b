"""Queries on enrichment: searches, merges, links, model batches, ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwell.catalog.registry import HOSPITALS, PLACES, query, table
from recordwell.catalog.tables import scratch
from recordwell.functions import messages
from recordwell.operators import inference
from recordwell.operators.checks import change_statistics, dirty_count
from recordwell.operators.fill import apply_actions, fill_missing, split_by_cache
from recordwell.operators.keys import minus_ids
from recordwell.operators.sampling import hash_between, sample_links
from recordwell.plans.stages import enrich_hospitals
from recordwell.streaming import repair

_MISSING = (
    "list_filter([CASE WHEN address IS NULL OR address = '' THEN 'address' END, CASE WHEN phone IS NULL OR phone = '' THEN 'phone' END, "
    "CASE WHEN email IS NULL OR email = '' THEN 'email' END, CASE WHEN website IS NULL OR website = '' THEN 'website' END, "
    "CASE WHEN beds IS NULL OR beds = 0 THEN 'beds' END], lambda x: x IS NOT NULL)"
)


@query("needs_enrichment", f"WITH h AS ({HOSPITALS.sql}) SELECT id, array_to_string({_MISSING}, ', ') AS missing FROM h "
       f"WHERE len({_MISSING}) >= 2")
def _(spark, folder):
    missing, enough = inference.needs_search()
    return HOSPITALS.frame(spark, folder).filter(enough).select("id", F.array_join(missing, ", ").alias("missing"))


_FOUND = ("SELECT o_custkey AS id, 'rue ' || CAST(min(o_orderkey) AS VARCHAR) AS address, "
          "CASE WHEN min(o_orderkey) % 2 = 0 THEN '0500' END AS phone, '' AS email, 'https://x.ma' AS website, "
          "CAST(min(o_orderkey) % 3 AS BIGINT) AS beds FROM orders GROUP BY o_custkey")


@query("merge_fill_missing", f"WITH h AS ({HOSPITALS.sql}), f AS ({_FOUND}) SELECT h.id, "
       "coalesce(nullif(h.address, ''), nullif(f.address, ''), h.address) AS address, coalesce(nullif(h.phone, ''), nullif(f.phone, ''), h.phone) AS phone, "
       "coalesce(nullif(h.email, ''), nullif(f.email, ''), h.email) AS email, coalesce(nullif(h.website, ''), nullif(f.website, ''), h.website) AS website, "
       "coalesce(nullif(h.beds, 0), nullif(f.beds, 0), h.beds) AS beds FROM h LEFT JOIN f ON h.id = f.id")
def _(spark, folder):
    first = F.min("o_orderkey")
    found = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.concat(F.lit("rue "), first.cast("string")).alias("address"),
        F.when(first % 2 == 0, "0500").alias("phone"), F.lit("").alias("email"),
        F.lit("https://x.ma").alias("website"), (first % 3).alias("beds"))
    fields = ["address", "phone", "email", "website", "beds"]
    return fill_missing(HOSPITALS.frame(spark, folder), found, "id", fields).select("id", *fields)


_CACHE = "SELECT DISTINCT o_custkey AS id, 'known' AS state FROM orders WHERE o_orderstatus = 'F'"


@query("cache_split", f"WITH h AS ({HOSPITALS.sql}), c AS ({_CACHE}) SELECT h.id, h.name, coalesce(c.state, 'ask') AS state FROM h LEFT JOIN c ON h.id = c.id")
def _(spark, folder):
    cache = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("id"), F.lit("known").alias("state")).distinct()
    hits, misses = split_by_cache(HOSPITALS.frame(spark, folder).select("id", "name"), cache, "id", ["state"])
    return hits.unionByName(misses.withColumn("state", F.lit("ask")))


@query("resume_antijoin", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, folder):
    done = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return minus_ids(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), done, "o_orderkey")


# ---------------------------------------------------------------- links


def _number_sql(*parts: str) -> str:
    return "CAST('0x' || left(md5(" + " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 15) AS BIGINT)"


@query(
    "sample_links",
    "WITH RECURSIVE n AS (SELECT count(*) AS n FROM supplier), "
    "pr AS (SELECT min(c) AS p FROM (SELECT n.n + i AS c FROM n, range(0, 200) t(i)) WHERE c >= 2 AND "
    "NOT EXISTS (SELECT 1 FROM range(2, 1000) d(d) WHERE d * d <= c AND c % d = 0)), "
    f"c AS (SELECT c_custkey, 3 + {_number_sql(chr(39) + 'k' + chr(39), 'c_custkey')} % 6 AS k, "
    f"{_number_sql(chr(39) + 's' + chr(39), chr(39) + 'start' + chr(39), 'c_custkey')} % p AS start, "
    f"{_number_sql(chr(39) + 's' + chr(39), chr(39) + 'step' + chr(39), 'c_custkey')} % (p - 1) + 1 AS step, p, n FROM customer, pr, n), "
    "w AS (SELECT c_custkey, least(k, n) AS k, (start + t.t * step) % p AS place, t.t AS t FROM c, range(0, 300) t(t) "
    "WHERE t.t < least(k, n) + (p - n) AND (start + t.t * step) % p < n), "
    "r AS (SELECT c_custkey, place, k, row_number() OVER (PARTITION BY c_custkey ORDER BY t) AS i FROM w), "
    "s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS place FROM supplier) "
    f"SELECT c_custkey, s_suppkey, 1 + {_number_sql(chr(39) + 's' + chr(39), chr(39) + 'quantity' + chr(39), 'c_custkey', 's_suppkey')} % 5 AS quantity "
    "FROM r JOIN s USING (place) WHERE i <= k",
)
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey")
    k = hash_between(3, 8, F.lit("k"), F.col("c_custkey"))
    return sample_links(customers, "c_custkey", k, table(spark, folder, "supplier"), "s_suppkey", "s", ("quantity", 1, 5))


# ---------------------------------------------------------------- model batches


def offline_model():
    """A model that answers repair prompts by rule: names with a digit are junk, others get a region by initial.

    Made inside a function, so that tasks need not import this package to run it.
    """
    import json

    def answer(prompt: str) -> str:
        out = []
        for row in json.loads(prompt[prompt.index("ROWS:\n") + 6:]):
            city = row["city"] or ""
            junk = any(ch.isdigit() for ch in city)
            out.append({
                "id": row["id"], "city": city if junk else city.upper(),
                "region": None if junk else "Region " + city[:1].upper(), "province": None,
                "action": "DELETE" if junk else "UPDATE",
            })
        return json.dumps(out, ensure_ascii=False)

    return answer


@query("batch_prompts", f"WITH p AS ({PLACES.sql}), d AS (SELECT id, city, (row_number() OVER (ORDER BY id) - 1) // 20 AS batch_id FROM p WHERE region IS NULL) "
       "SELECT batch_id, CAST(to_json(list({'id': id, 'city': city} ORDER BY id)) AS VARCHAR) AS records FROM d GROUP BY batch_id")
def _(spark, folder):
    dirty = PLACES.frame(spark, folder).filter("region IS NULL")
    made = inference.batches(dirty, ["id", "city"], "id", inference.REPAIR_BATCH)
    return made.select("batch_id", messages.records_json("records").alias("records"))


@query("model_repair", f"WITH p AS ({PLACES.sql}) SELECT id, CASE WHEN region IS NULL THEN upper(city) ELSE city END AS city, "
       "CASE WHEN region IS NULL THEN 'Region ' || upper(left(city, 1)) ELSE region END AS region, "
       "CASE WHEN region IS NULL THEN NULL ELSE province END AS province FROM p WHERE NOT (region IS NULL AND regexp_matches(city, '[0-9]'))")
def _(spark, folder):
    return inference.repair_once(PLACES.frame(spark, folder), offline_model())


def unsteady_model():
    """A model whose first reply to some groups is garbage, and that names some rows late or never."""
    import json

    def answer(prompt: str) -> str:
        head, rows = prompt.split("ROWS:\n", 1)
        asked = int(head.split(" earlier replies")[0].rsplit("\n", 1)[1]) if " earlier replies" in head else 0
        rows = json.loads(rows)
        if asked == 0 and rows[0]["id"] // 20 % 3 == 0:
            return "I cannot help with that [" + str(rows[0]["id"])
        named = [r for r in rows if r["id"] % 11 > 0 and (r["id"] % 7 > 0 or asked == 2)]
        return json.dumps([{
            "id": r["id"], "city": r["city"].upper(), "region": "Region " + r["city"][:1].upper(), "province": None,
            "action": "DELETE" if r["id"] % 13 == 0 else "UPDATE"} for r in named])

    return answer


@query("repair_stream", "WITH p AS (SELECT doc_id AS id, source || ' ' || CAST(doc_id AS VARCHAR) AS city, CASE WHEN doc_id % 3 = 0 THEN lang END AS region, 'P' AS province FROM documents), "
       "s AS (SELECT *, CASE WHEN id % 11 = 0 THEN 'GIVEN_UP' WHEN id % 13 = 0 THEN 'DELETED' ELSE 'REPAIRED' END AS status, "
       "CASE WHEN id % 11 = 0 OR id % 7 = 0 THEN 3 WHEN id // 20 % 3 = 0 THEN 2 ELSE 1 END AS attempts FROM p WHERE region IS NULL) "
       "SELECT id, CASE WHEN status = 'REPAIRED' THEN upper(city) ELSE city END AS city, CASE WHEN status = 'REPAIRED' THEN 'Region ' || upper(left(city, 1)) END AS region, "
       "CASE WHEN status = 'REPAIRED' THEN NULL ELSE province END AS province, status, attempts FROM s WHERE status <> 'DELETED' "
       "UNION ALL SELECT id, city, region, province, NULL, NULL FROM p WHERE region IS NOT NULL")
def _(spark, folder):
    """Files of places pass a stream that asks up to three times; rows it deleted are gone, rows it gave up stay as they were."""
    rows = table(spark, folder, "documents").selectExpr(
        "doc_id AS id", "source || ' ' || CAST(doc_id AS STRING) AS city", "CASE WHEN doc_id % 3 = 0 THEN lang END AS region", "'P' AS province")
    path = scratch(spark, "repairs")
    rows.write.parquet(f"{path}/rows")
    stream = repair.repair_stream(spark, f"{path}/rows", rows.schema, f"{path}/settled", f"{path}/state", unsteady_model())
    repair.drain(stream)
    settled = repair.outcomes(spark, f"{path}/settled")
    whole = repair.repaired(spark.read.schema(rows.schema).parquet(f"{path}/rows"), settled)
    ends = settled.select(F.col("id").alias("_id"), "status", "attempts")
    return whole.join(ends, F.col("id") == F.col("_id"), "left").drop("_id")


_ACTIONS = ("SELECT l_orderkey AS id, l_linenumber AS position, 'C' || CAST(l_partkey AS VARCHAR) AS city, "
            "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE 'R' || l_returnflag END AS region, 'P' AS province, "
            "CASE WHEN l_partkey % 11 = 0 THEN 'DELETE' WHEN l_partkey % 11 = 1 THEN 'KEEP' ELSE 'UPDATE' END AS action FROM lineitem")


@query("apply_actions", f"WITH a AS ({_ACTIONS}), o AS (SELECT o_orderkey AS id, 'old' AS city, o_orderstatus AS region, o_orderpriority AS province FROM orders), "
       "g AS (SELECT id, bool_or(action = 'DELETE') AS gone FROM a GROUP BY id), "
       "u AS (SELECT * FROM a WHERE action = 'UPDATE' QUALIFY row_number() OVER (PARTITION BY id ORDER BY position DESC, city DESC, region DESC NULLS LAST) = 1) "
       "SELECT o.id, CASE WHEN u.id IS NULL THEN o.city ELSE u.city END AS city, CASE WHEN u.id IS NULL THEN o.region ELSE u.region END AS region, "
       "CASE WHEN u.id IS NULL THEN o.province ELSE u.province END AS province FROM o LEFT JOIN g ON o.id = g.id LEFT JOIN u ON o.id = u.id "
       "WHERE NOT coalesce(g.gone, false)")
def _(spark, folder):
    actions = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS id", "l_linenumber AS position", "'C' || CAST(l_partkey AS STRING) AS city",
        "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE 'R' || l_returnflag END AS region", "'P' AS province",
        "CASE WHEN l_partkey % 11 = 0 THEN 'DELETE' WHEN l_partkey % 11 = 1 THEN 'KEEP' ELSE 'UPDATE' END AS action")
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id", "'old' AS city", "o_orderstatus AS region", "o_orderpriority AS province")
    return apply_actions(orders, actions, order_by="position")


_REPLY = (
    "CASE WHEN conv_id % 5 = 0 THEN '[{\"id\": ' || CAST(conv_id AS {0}) || ', \"city\": \"Fès\", \"action\": \"UPDATE\"}, {\"id\": ' || CAST(turn AS {0}) || ', \"action\": \"DELETE\"}]' "
    "WHEN conv_id % 5 = 1 THEN '[{\"id\": ' || CAST(conv_id AS {0}) || '}]' WHEN conv_id % 5 = 2 THEN '{\"id\": 1, \"action\": \"UPDATE\"}' "
    "WHEN conv_id % 5 = 3 THEN 'no JSON: ' || text ELSE '[]' END"
)


@query("validate_reply", "SELECT conv_id, turn, CASE conv_id % 5 WHEN 0 THEN 2 WHEN 4 THEN 0 ELSE -1 END AS actions FROM conversations")
def _(spark, folder):
    df = table(spark, folder, "conversations").selectExpr("conv_id", "turn", _REPLY.replace("{0}", "STRING") + " AS reply")
    return df.select("conv_id", "turn", F.coalesce(F.size(messages.parse_actions("reply")), F.lit(-1)).alias("actions"))


@query("dirty_count", f"WITH p AS ({PLACES.sql}) SELECT count(*) FILTER (region IS NULL) AS dirty_rows FROM p")
def _(spark, folder):
    return dirty_count(PLACES.frame(spark, folder))


@query("change_statistics", f"WITH p AS ({PLACES.sql}) SELECT count(*) AS rows_before, count(*) FILTER (region IS NULL AND regexp_matches(city, '[0-9]')) AS rows_deleted, "
       "count(*) FILTER (region IS NULL AND NOT regexp_matches(city, '[0-9]')) AS rows_updated, 0::BIGINT AS city_found, "
       "count(*) FILTER (region IS NULL AND NOT regexp_matches(city, '[0-9]')) AS region_found FROM p")
def _(spark, folder):
    before = PLACES.frame(spark, folder)
    return change_statistics(before, inference.repair_once(before, offline_model()), "id", ["city", "region"])


def offline_search():
    """A model that answers attribute prompts from the length of the name."""
    import json

    def answer(prompt: str) -> str:
        n = len(prompt.split("Name: ")[1].split("\n")[0])
        return json.dumps({
            "address": f"bd {n}", "phone": "0500" if n % 2 else "call", "email": f"x{n}@mail.ma",
            "website": "www.found.ma" if n % 3 else "nowhere", "beds": n * 1000, "source_quality": "low",
        })

    return answer


_SEARCH = (
    f"h AS ({HOSPITALS.sql}), q AS (SELECT id, length(name) AS n FROM h WHERE len({_MISSING}) >= 2), "
    "f AS (SELECT id, 'bd ' || CAST(n AS VARCHAR) AS address, CASE WHEN n % 2 = 1 THEN '0500' END AS phone, "
    "'x' || CAST(n AS VARCHAR) || '@mail.ma' AS email, CASE WHEN n % 3 > 0 THEN 'https://www.found.ma' END AS website, "
    "CASE WHEN n * 1000 <= 10000 THEN CAST(n * 1000 AS INT) END AS beds FROM q)"
)


@query("search_attributes", f"WITH {_SEARCH} SELECT * FROM f")
def _(spark, folder):
    return inference.search_attributes(HOSPITALS.frame(spark, folder), None, offline_search())


def offline_capacity():
    """A model that estimates only even ids, from the id."""
    import json
    import re

    def answer(prompt: str) -> str:
        ids = [int(i) for i in re.findall(r"- ID ([0-9]+): ", prompt)]
        # out of order: replies are matched by id, never by place
        return json.dumps({"hospitals": [
            {"id": i, "service_count": 1 + i % 7, "equipment_count": 2 + i % 5, "beds": 10 + i % 90}
            for i in reversed(ids) if i % 2 == 0
        ]})

    return answer


@query("capacity_estimates", f"WITH h AS ({HOSPITALS.sql}) SELECT id, CAST(1 + id % 7 AS INT) AS service_count, "
       "CAST(2 + id % 5 AS INT) AS equipment_count, CAST(10 + id % 90 AS INT) AS beds FROM h WHERE id % 2 = 0")
def _(spark, folder):
    return inference.capacity_estimates(HOSPITALS.frame(spark, folder), offline_capacity())


_TIER = (
    "CASE WHEN contains(lower(type), 'chu') OR contains(lower(type), 'universitaire') OR contains(lower(type), 'régional') THEN 'major' "
    "WHEN contains(lower(type), 'clinique') THEN 'clinic' ELSE 'local' END"
)


@query("enrich_beds", f"WITH {_SEARCH}, t AS (SELECT h.*, {_TIER} AS tier FROM h), b AS (SELECT id, "
       "CASE tier WHEN 'major' THEN 300 WHEN 'clinic' THEN 30 ELSE 10 END AS low, "
       "CASE tier WHEN 'major' THEN 800 WHEN 'clinic' THEN 150 ELSE 60 END AS high FROM t) "
       "SELECT h.id, coalesce(nullif(h.phone, ''), f.phone, h.phone) AS phone, coalesce(nullif(h.email, ''), f.email, h.email) AS email, "
       "CAST(coalesce(nullif(h.beds, 0), nullif(f.beds, 0), CASE WHEN h.id % 2 = 0 THEN 10 + h.id % 90 ELSE "
       f"low + {_number_sql(chr(39) + 'links' + chr(39), chr(39) + 'beds' + chr(39), 'h.id')} % (high - low + 1) END) AS INT) AS beds "
       "FROM h JOIN b ON h.id = b.id LEFT JOIN f ON h.id = f.id")
def _(spark, folder):
    ids = table(spark, folder, "nation").select((F.col("n_nationkey") + 1).alias("id"))
    out = enrich_hospitals(HOSPITALS.frame(spark, folder), ids, ids, search_model=offline_search(),
                           capacity_model=offline_capacity())
    return out["hospitals"].select("id", "phone", "email", "beds")


_LINKS = (
    f"h AS ({HOSPITALS.sql}), t AS (SELECT id, {_TIER} AS tier FROM h), "
    "b AS (SELECT id, CASE tier WHEN 'major' THEN 10 WHEN 'clinic' THEN 5 ELSE 1 END AS low, "
    "CASE tier WHEN 'major' THEN 20 WHEN 'clinic' THEN 12 ELSE 5 END AS high FROM t)"
)


@query("service_links", f"WITH {_LINKS} SELECT id AS hospital_id, low + {_number_sql(chr(39) + 'links' + chr(39), chr(39) + 'services' + chr(39), 'id')} % (high - low + 1) AS services, "
       f"low + {_number_sql(chr(39) + 'links' + chr(39), chr(39) + 'services' + chr(39), 'id')} % (high - low + 1) AS different_services FROM b")
def _(spark, folder):
    """Every hospital has as many services as its size class drew, all different."""
    ids = table(spark, folder, "nation").select((F.col("n_nationkey") + 1).alias("id"))
    out = enrich_hospitals(HOSPITALS.frame(spark, folder), ids, ids)
    return out["hospital_services"].groupBy("hospital_id").agg(
        F.count("*").alias("services"), F.count_distinct("service_id").alias("different_services"))
