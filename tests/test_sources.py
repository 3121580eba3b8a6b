import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwell.sources import readers, schemas, writers
from recordwell.sources.ledger import Ledger
from recordwell.streaming.incremental import process_new_files


def test_csv_is_text_with_null_tokens_and_mark(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text('﻿id,name,note\n1,"A ""b"", c",0005\n2,N/A,"two\nlines"\n3,nan,\n', encoding="utf-8")
    df = readers.read_csv(spark, str(path), with_order=True)
    assert df.columns == ["id", "name", "note", "_ord"]
    assert [tuple(r)[:3] for r in df.orderBy("_ord").collect()] == [
        ("1", 'A "b", c', "0005"), ("2", None, "two\nlines"), ("3", None, None)]


def test_missing_csv_is_empty(spark, tmp_path):
    df = readers.read_csv(spark, str(tmp_path / "none.csv"), columns=("a", "b"))
    assert df.columns == ["a", "b"] and df.count() == 0
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "none.csv"), missing_ok=False).count()


@pytest.mark.parametrize("multi_line", [True, False])
def test_preamble_is_skipped(spark, tmp_path, multi_line):
    path = tmp_path / "gov.csv"
    path.write_text("Liste officielle\n\n;source,x\n Région ,Délégation,Commune,Commune\nR1,P1,C1,D1\nR2,,NULL,D2\n", encoding="utf-8")
    df = readers.read_csv_with_preamble(spark, str(path), multi_line=multi_line, with_order=True).orderBy("_ord")
    assert df.columns == ["Région", "Délégation", "Commune", "Commune.1", "_ord"]
    assert [tuple(r)[:4] for r in df.collect()] == [("R1", "P1", "C1", "D1"), ("R2", None, None, "D2")]


def test_preamble_without_header_word_takes_first_line(spark, tmp_path, rows):
    path = tmp_path / "gov.csv"
    path.write_text("a,b\n1,2\n", encoding="utf-8")
    assert rows(readers.read_csv_with_preamble(spark, str(path))) == [("1", "2")]


def test_preamble_of_a_split_file(spark, tmp_path):
    path = tmp_path / "gov.csv"
    lines = [f"R{i},{i},some text to make the line longer" for i in range(500)]
    path.write_text("Liste\nRégion,n,text\n" + "\n".join(lines) + "\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_csv_with_preamble(spark, str(path), multi_line=False, with_order=True)
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        assert [r.n for r in df.orderBy("_ord").collect()] == [str(i) for i in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_skips_items_that_are_no_objects(spark, tmp_path, rows):
    path = tmp_path / "m.json"
    path.write_text('[{"nom": "a", "PPV": 12.5}, 3, "x", {"other": 1}, {"nom": "é"}]', encoding="utf-8")
    df = readers.read_json_objects(spark, str(path), ["nom", "PPV"])
    assert rows(df) == [("a", "12.5"), ("é", None)]
    assert readers.read_json_objects(spark, str(tmp_path / "no.json"), ["nom"], with_order=True).columns == ["nom", "_ord"]


def test_cache_json(spark, tmp_path, rows):
    value = T.StructType([T.StructField("s_ids", T.ArrayType(T.IntegerType())), T.StructField("beds", T.IntegerType())])
    path = tmp_path / "cache.json"
    path.write_text('{"1_x": {"s_ids": [1, 2], "beds": 5}, "2_y": {"s_ids": [], "beds": null}}')
    assert rows(readers.read_cache_json(spark, str(path), value)) == [("1_x", [1, 2], 5), ("2_y", [], None)]
    path.write_text("{broken")
    assert readers.read_cache_json(spark, str(path), value).count() == 0
    assert readers.read_cache_json(spark, str(tmp_path / "no.json"), value).count() == 0


def test_dirty_rows(spark, rows):
    df = spark.createDataFrame([(3, "c", None), (1, "a", None), (2, "b", "r")], "id int, city string, region string")
    assert rows(readers.read_dirty(df)) == [(1, "a"), (3, "c")]
    assert rows(readers.read_dirty(df, 1)) == [(1, "a")]


def test_conform_casts_defaults_and_order(spark):
    df = spark.createDataFrame([("7", "n", "33.5", float("nan"))], "id string, name string, latitude string, longitude double")
    row = writers.conform(df, "hospitals").first()
    assert row.id == 7 and str(row.latitude) == "33.50000000" and row.longitude is None and row.beds == 0
    assert row.created_at is not None
    with pytest.raises(ValueError):
        writers.conform(spark.createDataFrame([(1,)], "x int"), "hospitals")


def test_tables_load_refresh_and_modes(spark, rows):
    spark.sql("DROP DATABASE IF EXISTS load_check CASCADE")
    writers.create_tables(spark, "load_check")
    assert {r.tableName for r in spark.sql("SHOW TABLES IN load_check").collect()} == set(schemas.TABLES)
    places = spark.createDataFrame([("1", "r", "p", "c")], "id string, region string, province string, city string")
    for _ in range(2):  # a second load replaces the first
        assert writers.load_tables({"places": places}, "load_check") == ["places"]
    assert rows(spark.table("load_check.places")) == [(1, "r", "p", "c")]
    writers.promote(writers.conform(places, "places"), "load_check.places")
    assert spark.table("load_check.places").count() == 2
    writers.save_table(places, "load_check.copy", "replace")
    writers.save_table(places, "load_check.copy", "append")
    assert spark.table("load_check.copy").count() == 2
    with pytest.raises(Exception):
        writers.save_table(places, "load_check.copy", "fail")
    spark.sql("DROP DATABASE load_check CASCADE")


def test_carry_forward(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a" / "places"))
    assert writers.carry_forward(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["places", "services"]) == ["places"]
    assert spark.read.parquet(str(tmp_path / "b" / "places")).count() == 3


def test_cache_objects_may_span_lines(spark, tmp_path, rows):
    value = T.StructType([T.StructField("beds", T.IntegerType())])
    (tmp_path / "cache.json").write_text('{\n "a": {"beds": 1},\n "b": {"beds": null}\n}\n')
    assert rows(readers.read_cache_json(spark, str(tmp_path / "cache.json"), value)) == [("a", 1), ("b", None)]


def test_ledger_resumes_and_replaces_slices(spark, tmp_path, rows):
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("beds", T.IntegerType())])
    ledger = Ledger(spark, str(tmp_path / "ledger"), schema)
    todo = spark.range(6).select(F.col("id").alias("key"), F.lit(1).alias("beds"))
    assert ledger.pending(todo).count() == 6
    ledger.append(todo.filter("key < 2"), 0)
    ledger.append(todo.filter("key < 4"), 0)
    assert rows(ledger.pending(todo), "key") == [(4,), (5,)]
    with pytest.raises(ValueError):
        Ledger(spark, "x", schema, "nokey")


def test_stream_counts_every_file_once(spark, tmp_path, rows):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id BIGINT"

    def run():
        process_new_files(spark, source, T.StructType([T.StructField("id", T.LongType())]), target, state,
                          lambda df: df.select((F.col("id") * 10).alias("id")), files_per_batch=1).awaitTermination()
        return rows(spark.read.schema(schema).parquet(target), "id")

    spark.range(2).coalesce(1).write.parquet(source)
    assert run() == [(0,), (10,)]
    assert run() == [(0,), (10,)]
    spark.range(2, 3).coalesce(1).write.mode("append").parquet(source)
    assert run() == [(0,), (10,), (20,)]


def test_first_means_file_order_whatever_the_sizes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,first\n")
    (tmp_path / "b.csv").write_text("k,v\n" + "x,second\n" * 2000)
    df = readers.read_csv(spark, str(tmp_path), columns=["k", "v"], with_order=True)
    from recordwell.operators.keys import keep_best
    assert [r.v for r in keep_best(df, ["k"], [readers.ORDER]).collect()] == ["first"]


def test_large_ids_are_published_whole(spark):
    from recordwell.sources.writers import conform
    assert conform(spark.createDataFrame([(3_000_000_000, "Fes")], "id long, city string"), "places").first().id == 3_000_000_000
