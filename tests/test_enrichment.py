import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from recordwell.functions.text import TIER_RANGES
from recordwell.operators import checks, inference
from recordwell.operators.sampling import hash_between, sample_links
from recordwell.plans import products
from recordwell.plans.stages import enrich_hospitals
from recordwell.sources.schemas import CONSTRAINTS, Constraints
from tests.plans import assert_scalable

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the models below run in tasks


def people(spark, n=25):
    return spark.range(1, n + 1).select("id", F.concat(F.lit("city "), F.col("id")).alias("city"),
                                        F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("province"))


def test_prompts_hold_twenty_rows_in_order(spark):
    made = inference.batches(people(spark, 45), ["id", "city"], "id", 20).orderBy("batch_id").collect()
    assert [[r.id for r in b.records] for b in made] == [list(range(1, 21)), list(range(21, 41)), list(range(41, 46))]


def answer(prompt):
    rows = json.loads(prompt.split("ROWS:\n")[1])
    return json.dumps([{"id": r["id"], "city": r["city"], "region": "R", "province": "P",
                        "action": "DELETE" if r["id"] % 5 == 0 else "UPDATE"} for r in rows])


def test_repair_once(spark, rows):
    got = inference.repair_once(people(spark), answer, parallel=2)
    assert rows(got, "id", "region") == sorted([(i, "R") for i in range(1, 26) if i % 5], key=repr)


def test_model_is_retried_and_failures_are_data(spark):
    def flaky(prompt):
        raise RuntimeError("down")

    prompts = spark.createDataFrame([(1, "a")], "batch_id int, prompt string")
    row = inference.run_model(prompts, flaky, retries=2).first()
    assert row.reply is None and row.error == "RuntimeError: down"
    assert inference.repair_once(people(spark, 3), flaky).count() == 3


def test_invalid_replies_change_nothing(spark):
    for reply in ("oops", '{"id": 1, "action": "DELETE"}', '[{"id": 1, "action": "DELETE"}, {"id": 2}]'):
        assert inference.repair_once(people(spark, 3), lambda p, reply=reply: reply).filter("region IS NULL").count() == 3


def test_repair_rounds_are_bounded(spark):
    df, left = inference.repair_until_clean(people(spark, 5), answer)
    assert left == 0 and df.count() == 4
    asked = spark.sparkContext.accumulator(0)

    def useless(prompt):
        asked.add(1)
        return json.dumps([{"id": 1, "city": "x", "region": None, "action": "UPDATE"}])

    df, left = inference.repair_until_clean(people(spark, 5), useless, max_rounds=4)
    assert left == 5 and asked.value == 4  # a round without effect does not end the repair


FACILITIES = [
    (1, "CHU A", "x", "CHU", None, None, None, None, None), (2, "B", "x", "Clinique", "rue", "05", None, "w", "3"),
    (3, "C", "y", "Centre", None, "05", "", None, "0"), (4, "C", "y", "Centre", None, None, None, None, None),
]
COLUMNS = "id int, name string, city string, type string, address string, phone string, email string, website string, beds string"


def attributes(prompt):
    assert "Missing: " in prompt
    if "Name: CHU A" in prompt:
        return "not json"
    return json.dumps({"address": "bd 1", "phone": "tel 5", "email": "a@b.ma", "website": "www.c.ma", "beds": 40})


def test_search_fills_only_rows_with_two_gaps(spark, rows):
    df = spark.createDataFrame(FACILITIES, COLUMNS).withColumn("beds", F.col("beds").cast("int"))
    found = inference.search_attributes(df, None, attributes)
    assert rows(found, "id", "address", "phone", "website", "beds") == [
        (1, None, None, None, None), (3, "bd 1", None, "https://www.c.ma", 40), (4, "bd 1", None, "https://www.c.ma", 40)]


def test_search_answers_from_the_cache_first(spark, rows):
    df = spark.createDataFrame(FACILITIES, COLUMNS).withColumn("beds", F.col("beds").cast("int"))
    cache = spark.createDataFrame([("C", "y", "cached", None, None, None, 9)],
                                  "name string, city string, address string, phone string, email string, website string, beds int")
    found = inference.search_attributes(df, cache, None)
    assert rows(found, "id", "address", "beds") == [(3, "cached", 9), (4, "cached", 9)]


def test_capacity_is_joined_by_id_not_by_place(spark, rows):
    def model(prompt):
        return json.dumps({"hospitals": [{"id": 4, "service_count": 2, "equipment_count": 1, "beds": 44},
                                         {"id": 1, "service_count": 12, "equipment_count": 20, "beds": 500}]})

    df = spark.createDataFrame(FACILITIES, COLUMNS)
    assert rows(inference.capacity_estimates(df, model)) == [(1, 12, 20, 500), (4, 2, 1, 44)]


def test_enrich_hospitals(spark):
    df = spark.createDataFrame(FACILITIES, COLUMNS)
    ids = lambda n: spark.range(1, n + 1).select(F.col("id").cast("int").alias("id"))
    out = enrich_hospitals(df, ids(21), ids(10), ids(18))
    beds = {r.id: r.beds for r in out["hospitals"].collect()}
    assert beds[2] == 3
    for i, tier in ((1, "major"), (3, "local"), (4, "local")):
        low, high = TIER_RANGES[tier]["beds"]
        assert low <= beds[i] <= high
    for name, left, right, most in (("hospital_services", "hospital_id", "service_id", 21),
                                    ("hospital_equipment", "hospital_id", "equipment_id", 10),
                                    ("hospital_medications", "hospital_id", "medication_id", 18)):
        links = out[name]
        assert checks.duplicate_report(links, [left, right]).count() == 0
        assert links.agg(F.max(right)).first()[0] <= most and links.select(left).distinct().count() == 4
        again = enrich_hospitals(df, ids(21), ids(10), ids(18))[name]
        assert links.exceptAll(again).count() == 0
    stock = out["hospital_medications"].agg(F.min("stock_quantity"), F.max("stock_quantity")).first()
    assert 10 <= stock[0] and stock[1] <= 1000


@pytest.mark.parametrize("n", [1, 2, 7, 30])
def test_sample_links_are_distinct_and_counted(spark, n):
    left = spark.range(200).toDF("l")
    right = spark.range(100, 100 + n).toDF("r")
    k = hash_between(0, 9, F.lit("k"), F.col("l"))
    links = sample_links(left, "l", k, right, "r", "seed", ("q", 1, 5))
    if n > 1:
        assert_scalable(links)
    per_row = {r.l: (r.n, r.d) for r in links.groupBy("l").agg(F.count("*").alias("n"), F.countDistinct("r").alias("d")).collect()}
    for r in left.select("l", k.alias("k")).collect():
        wanted = min(r.k, n)
        assert per_row.get(r.l, (0, 0)) == (wanted, wanted)
    if n == 30:  # every id is drawn about equally often
        counts = [r["count"] for r in links.groupBy("r").count().collect()]
        assert len(counts) == 30 and max(counts) < 3 * min(counts)


def test_constraint_violations(spark, rows):
    df = spark.createDataFrame([(1, "ok", "1.5"), (2, None, "x"), (3, "toolong", "123456789012")], "id int, name string, price string")
    got = checks.constraint_violations(df, Constraints(("id", "name"), {"name": 5}, {"price": (10, 2)}), "id")
    assert rows(got) == [(2, "name: not null"), (2, "price: decimal(10,2)"), (3, "name: length <= 5"), (3, "price: decimal(10,2)")]
    assert set(CONSTRAINTS) == {"places", "services", "equipment", "medications", "suppliers", "hospitals", "hospital_services",
                                "hospital_equipment", "hospital_medications", "supplier_medications", "supplier_equipment"}


def test_reference_checks(spark, rows):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 11)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert rows(checks.fk_orphans(child, "fk", parent, "pk")) == [(2, 11), (4, 11)]
    assert rows(checks.orphan_keys(child, "fk", parent, "pk")) == [(11, 2)]
    assert rows(checks.set_null_on_delete(child, "fk", parent, "pk")) == [(1, 10), (2, None), (3, None), (4, None)]
    assert rows(checks.cascade_on_delete(child, "fk", parent, "pk")) == [(1, 10)]


def test_change_statistics(spark):
    before = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "r", "c"), (4, None, "d")], "id int, region string, city string")
    after = spark.createDataFrame([(1, "r", "a"), (3, "r", "C"), (4, None, "d")], "id int, region string, city string")
    row = checks.change_statistics(before, after, "id", ["region", "city"]).first()
    assert row.asDict() == {"rows_before": 4, "rows_deleted": 1, "rows_updated": 2, "region_found": 1, "city_found": 0}


def test_product_reports(spark, rows):
    df = spark.createDataFrame([
        (1, " doliprane ", "paracetamol // cafeine", "cp", "b", "500MG", "c", "m", "10,00", "12,50", " ok "),
        (2, "DOLIPRANE", "paracetamol", "CP", "b", "500 MG", "c", "m", "NULL", "1", None),
    ], "id int, name string, active_substance string, form string, presentation string, dosage string, therapeutic_class string, "
       "manufacturer string, price_public string, price_hospital string, commercialization_status string")
    std = products.standardise_medications(df)
    reports = products.medication_checks(std)
    assert rows(reports["price_inversion"], "id") == [(1,)]
    assert rows(reports["duplicates"]) == [("DOLIPRANE", "500 MG", "CP", 2)]
    assert rows(reports["dosage_mismatch"]) == [("DOLIPRANE", "PARACETAMOL + CAFEINE", "500 MG")]
    assert std.filter("id = 1").first().commercialization_status == "ok"


def test_replies_out_of_shape_are_asked_again(spark):
    def late(prompt, bad=["no json", '[{"id": 1}]']):  # the task's own list: two bad replies, then good ones
        return bad.pop() if bad else answer(prompt)

    prompts = spark.createDataFrame([(0, 'ROWS:\n[{"id": 1, "city": "fes"}]')], "batch_id long, prompt string")
    done = inference.run_model(prompts, late, check=inference.is_actions, parallel=1).collect()
    assert done[0].error is None and inference.is_actions(done[0].reply)
    never = inference.run_model(prompts, lambda prompt: "{}", check=inference.is_actions).collect()
    assert never[0].reply is None and never[0].error == "invalid reply"


def test_replies_cannot_touch_rows_that_were_not_asked(spark):
    rows = spark.createDataFrame([(1, "fes", None, None), (99, "rabat", "Rabat", "Rabat")], "id long, city string, region string, province string")

    def foreign(prompt):
        return json.dumps([{"id": 99, "action": "DELETE"}, {"id": 1, "city": "fes", "region": "Fès-Meknès", "province": "Fès", "action": "UPDATE"}])

    assert sorted((r.id, r.region) for r in inference.repair_once(rows, foreign).collect()) == [(1, "Fès-Meknès"), (99, "Rabat")]


def test_capacities_count_only_in_the_batch_that_asked(spark):
    rows = spark.createDataFrame([(i, f"h{i}", "CHU") for i in range(1, 21)], "id long, name string, type string")

    def mixed(prompt):
        ids = [int(line.split()[2].rstrip(":")) for line in prompt.splitlines() if line.startswith("- ID")]
        extra = [{"id": 15, "service_count": 1, "equipment_count": 1, "beds": 9999}, {"id": 777, "service_count": 1, "equipment_count": 1, "beds": 1}]
        own = [{"id": i, "service_count": 2, "equipment_count": 3, "beds": i} for i in ids]
        return json.dumps({"hospitals": (extra if 15 not in ids else []) + own})

    got = {r.id: r.beds for r in inference.capacity_estimates(rows, mixed).collect()}
    assert got == {i: i for i in range(1, 21)}


def test_repeated_cache_rows_do_not_multiply_facilities(spark):
    rows = spark.createDataFrame([(1, "A", "Fes", None, None, None, None, None)], "id long, name string, city string, address string, phone string, email string, website string, beds int")
    cache = spark.createDataFrame([("A", "Fes", "rue 1", None, None, None, 5), ("A", "Fes", None, None, None, None, None)],
                                  "name string, city string, address string, phone string, email string, website string, beds int")
    assert [(r.id, r.address, r.beds) for r in inference.search_attributes(rows, cache, None).collect()] == [(1, "rue 1", 5)]
