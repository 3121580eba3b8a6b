import random

import pytest
from pyspark.sql import functions as F

from recordwell.operators import columns as cols, keys
from tests.plans import assert_scalable, physical


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_dense_id_is_one_to_n_in_order(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice("abc"), rng.choice([None, *range(1000)]), i) for i in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "s string, n int, i int").repartition(partitions)
    got = keys.dense_id(df, ["s", "n", "i"], rows_per_bucket=100, sample_rows=500).collect()
    wanted = sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.id)] == wanted
    assert sorted(r.id for r in got) == list(range(1, 3001))


def test_dense_id_small_and_empty(spark):
    assert [r.id for r in keys.dense_id(spark.range(1).toDF("v"), ["v"]).collect()] == [1]
    assert keys.dense_id(spark.range(0).toDF("v"), ["v"]).count() == 0


def test_dense_id_spreads_rows_over_tasks(spark):
    df = spark.range(0, 100_000, 1, 8).select((F.col("id") * 7919 % 1_000_003).alias("v"))
    numbered = keys.dense_id(df, ["v"], rows_per_bucket=2_000)
    assert_scalable(numbered)
    sizes = [r.n for r in numbered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 40_000


def test_keep_best_drops_losers_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    kept = keys.keep_best(df, ["k"], ["v"])
    plan = physical(kept)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(tuple(r) for r in kept.collect()) == [(0, 0), (1, 1), (2, 2)]


def test_keep_best_null_keys(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, v int")
    assert rows(keys.keep_best(df, ["k"], ["v"])) == [("a", 3), (None, 1)]
    assert rows(keys.keep_best(df, ["k"], ["v"], null_keys="keep")) == [("a", 3), (None, 1), (None, 2)]
    assert rows(keys.keep_best(df, ["k"], ["v"], null_keys="drop")) == [("a", 3)]
    with pytest.raises(ValueError):
        keys.keep_best(df, ["k"], ["v"], null_keys="?")


def test_smart_dedup(spark, rows):
    df = spark.createDataFrame(
        [(1, "fes", None), (2, "fes", "r"), (3, "fes", "s"), (4, "x", None), (5, "x", None), (6, None, None), (7, None, "r")],
        "id int, city string, region string")
    assert rows(keys.smart_dedup(df, "city", "region")) == [(2, "fes", "r"), (4, "x", None), (6, None, None), (7, None, "r")]


def test_priority_union(spark, rows):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "o int, name string")
    second = spark.createDataFrame([(0, "a", "x"), (1, "c", "y"), (2, "c", "z")], "o int, name string, city string")
    assert rows(keys.priority_union([first, second], ["name"], "o"), "name", "o", "city") == [("a", 1, None), ("b", 2, None), ("c", 1, "y")]


def test_one_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None)], "k string, o int, v string")
    assert rows(keys.one_per_key(df, "k", ["v"], "o")) == [("a", "y"), ("b", None)]


def test_batches_are_consecutive(spark):
    df = keys.dense_id(spark.range(45).toDF("v"), ["v"], "n")
    sizes = df.groupBy(keys.batch_of("n", 20).alias("b")).count().orderBy("b").collect()
    assert [tuple(r) for r in sizes] == [(0, 20), (1, 20), (2, 5)]


def test_rename_keeps_first_of_equal_names(spark, rows):
    df = spark.createDataFrame([(1, 2, 3)], [" SPECIALITE ", "nom", "x"])
    got = cols.rename_synonyms(df, {"SPECIALITE": "name", "nom": "name"})
    assert got.columns == ["name", "x"] and rows(got) == [(1, 3)]


def test_resolve_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Code", "Nom du Device", "name"])
    got = cols.resolve_column(df, ["nom", "device"], "name")
    assert got.columns == ["Code", "name"] and got.first().name == 2
    assert cols.resolve_column(df.select("Code"), ["nom"], "name").columns == ["name"]


def test_select_allowed_needs_a_column(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        cols.select_allowed(df, ["x"])


def test_fill_defaults(spark, rows):
    df = spark.createDataFrame([(None,), ("a",)], "category string")
    assert rows(cols.fill_defaults(df, {"category": "other", "no": 1}, {"grade": "std"})) == [("a", "std"), ("other", "std")]
