import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwell.streaming import repair
from tests.plans import physical

SCHEMA = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("city", "region", "province")]])


def helper():
    """Answers rows by id: even ones at once, multiples of 3 in the third round, 5 never, 7 is deleted; rounds of ids 20 to 39 begin with garbage."""
    def answer(prompt: str) -> str:
        asked = int(prompt.split(" earlier replies")[0].rsplit("\n", 1)[1]) if " earlier replies" in prompt else 0
        rows = json.loads(prompt[prompt.index("ROWS:\n") + 6:])
        if asked == 0 and any(20 <= r["id"] < 40 for r in rows):
            return "sorry, no"
        if asked == 1 and any(40 <= r["id"] < 60 for r in rows):
            raise ConnectionError("down")
        out = [{"id": 999, "city": "nobody asked", "region": "x", "action": "UPDATE"}]
        for r in rows:
            if r["id"] == 5 or (r["id"] % 3 == 0 and asked < 2):
                continue
            out.append({"id": r["id"], "city": (r["city"] or "?").upper(), "region": "R", "province": None,
                        "action": "DELETE" if r["id"] == 7 else "LATER" if r["id"] == 11 else "UPDATE"})
        return json.dumps(out)

    return answer


def expected(ids):
    out = {}
    for i in ids:
        rounds = [asked for asked in range(3) if not (
            i in (5, 11) or (i % 3 == 0 and asked < 2) or (20 <= i < 40 and asked == 0) or (40 <= i < 60 and asked == 1))]
        out[i] = ("DELETED" if i == 7 else "REPAIRED", rounds[0] + 1) if rounds else ("GIVEN_UP", 3)
    return out


def run(spark, tmp_path, **options):
    query = repair.repair_stream(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "out"), str(tmp_path / "state"), helper(), **options)
    repair.drain(query)
    return repair.outcomes(spark, str(tmp_path / "out"))


def places(spark, low, high):
    return spark.range(low, high).select(
        "id", F.concat(F.lit("ville "), F.col("id").cast("string")).alias("city"),
        F.when(F.col("id") % 10 == 8, "known").alias("region"), F.lit(None).cast("string").alias("province"))


@pytest.mark.parametrize("files", [None, 1])
def test_rows_are_settled_or_given_up_however_they_arrive(spark, tmp_path, rows, files):
    places(spark, 0, 70).repartition(4).write.parquet(str(tmp_path / "in"))
    settled = run(spark, tmp_path, files_per_batch=files)
    assert {r[0]: tuple(r[1:]) for r in rows(settled, "id", "status", "attempts")} == expected([i for i in range(70) if i % 10 != 8])


def test_a_second_run_asks_only_about_new_rows(spark, tmp_path, rows):
    places(spark, 0, 10).write.parquet(str(tmp_path / "in"))
    first = rows(run(spark, tmp_path))
    places(spark, 60, 64).write.mode("append").parquet(str(tmp_path / "in"))
    both = rows(run(spark, tmp_path))
    assert set(first) <= set(both) and {r[0] for r in both} - {r[0] for r in first} == {60, 61, 62, 63}
    whole = repair.repaired(spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")), run(spark, tmp_path))
    assert "BatchEvalPython" not in physical(whole)
    cities = {r.id: (r.city, r.region) for r in whole.collect()}
    assert 7 not in cities and cities[8] == ("ville 8", "known") and cities[2] == ("VILLE 2", "R") and cities[5] == ("ville 5", None)


def test_a_stopped_stream_goes_on_where_it_was(spark, tmp_path, rows):
    places(spark, 0, 70).write.parquet(str(tmp_path / "in"))
    query = repair.repair_stream(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "out"), str(tmp_path / "state"), helper())
    while query.lastProgress is None and query.isActive:
        query.awaitTermination(0.05)
    query.stop()
    settled = run(spark, tmp_path)
    assert {r[0]: tuple(r[1:]) for r in rows(settled, "id", "status", "attempts")} == expected([i for i in range(70) if i % 10 != 8])


def test_nothing_to_read_and_rows_without_id_or_name(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    assert rows(run(spark, tmp_path)) == []
    spark.createDataFrame([(None, "x", None, None), (2, None, None, None), (2, "twice", None, None), (4, "a" * 100_000, None, None)], SCHEMA) \
        .coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = rows(run(spark, tmp_path), "id", F.length("city"), "attempts")
    assert got == [(2, 5, 1), (4, 100_000, 1)]
