"""What outlives a job: manifests, runs, snapshots, call logs, deletes over the key graph."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwell.operators import checks, inference, references
from recordwell.operators.calls import ATTRIBUTES, CallLog, search_cached
from recordwell.sources.manifest import Conflict, Manifest
from recordwell.sources.runs import RunTable
from recordwell.sources.snapshot import Snapshots


def test_states_are_committed_once(spark, tmp_path):
    states = Manifest(spark, str(tmp_path / "m"))
    assert states.latest() == (0, {})
    states.commit(1, {"a": "é"})
    with pytest.raises(Conflict):
        states.commit(1, {"a": 2})
    states.commit(2, {"b": [1]})
    assert states.latest() == (2, {"b": [1]}) and states.read(1) == {"a": "é"} and states.numbers() == [1, 2]
    assert not [f for f in (tmp_path / "m").iterdir() if f.name.startswith("_")]


SCHEMA = T.StructType([T.StructField("key", T.LongType()), T.StructField("value", T.StringType())])


def store_of(spark, path, *runs):
    store = RunTable(spark, str(path), SCHEMA, "key")
    for run in runs:
        store.append(spark.createDataFrame(run, SCHEMA))
    return store


def test_the_latest_run_wins_before_and_after_compaction(spark, tmp_path, rows):
    store = store_of(spark, tmp_path, [(1, "a"), (2, "a"), (2, "b"), (None, "x")], [(2, "c"), (3, None)], [], [(9, "d"), (3, "d")])
    want = [(1, "a"), (2, "c"), (3, "d"), (9, "d")]
    assert rows(store.read()) == want and [r["rows"] for r in store.runs()] == [2, 2, 2]
    old = store.read()
    store.compact()
    assert rows(store.read()) == want == rows(old) and len(store.runs()) == 1
    assert len(store.vacuum()) == 3 and rows(store.read()) == want
    store.append(spark.createDataFrame([(1, "z")], SCHEMA))
    assert rows(store.read()) == [(1, "z"), *want[1:]]


def test_removed_keys_stay_hidden_until_they_are_gone(spark, tmp_path, rows):
    store = store_of(spark, tmp_path, [(1, "a"), (2, "a")], [(3, "b")])
    store.remove(spark.createDataFrame([(2,), (7,)], "key long"))
    assert rows(store.read()) == [(1, "a"), (3, "b")]
    # a compaction of the newest runs must still hide the older row
    store.compact(newest=2)
    assert rows(store.read()) == [(1, "a"), (3, "b")] and len(store.runs()) == 2
    store.compact()
    assert rows(store.read()) == [(1, "a"), (3, "b")] and store.runs()[0]["rows"] == 2
    store.append(spark.createDataFrame([(2, "again")], SCHEMA))
    assert rows(store.read()) == [(1, "a"), (2, "again"), (3, "b")]


def test_lookups_read_runs_whose_range_meets_the_keys(spark, tmp_path, rows):
    store = store_of(spark, tmp_path, [(i, "a") for i in range(10)], [(i, "b") for i in range(100, 110)], [(i, "c") for i in range(5, 8)])
    assert [r["number"] for r in store.overlapping(6, 7)] == [1, 3] and store.overlapping(20, 90) == []
    keys = spark.createDataFrame([(6,), (7,), (7,), (9,), (None,)], "key long")
    found = store.lookup(keys)
    assert rows(found) == [(6, "c"), (7, "c"), (9, "a")]
    assert all("run-2-" not in file for file in found.inputFiles())
    assert store.lookup(keys.limit(0)).count() == 0
    assert RunTable(spark, str(tmp_path / "none"), SCHEMA, "key").lookup(keys).count() == 0


def test_tiers_keep_runs_few(spark, tmp_path, rows):
    store = RunTable(spark, str(tmp_path), SCHEMA, "key")
    for n in range(9):
        store.append(spark.range(n * 10, n * 10 + 10).select(F.col("id").alias("key"), F.lit(str(n)).alias("value")))
        store.compact_tiers()
    assert len(store.runs()) <= 3 and store.read().count() == 90


def test_a_refresh_that_dies_changes_nothing(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    first = {"places": spark.createDataFrame([("1", "Rabat")], "id string, city string"), "extra": spark.range(3)}
    assert store.refresh(first) == 1
    assert store.tables()["places"].dtypes == [("id", "bigint"), ("region", "string"), ("province", "string"), ("city", "string")]
    dying = spark.range(5).select(F.raise_error(F.lit("dies")).cast("long").alias("id"))
    with pytest.raises(Exception, match="dies"):
        store.refresh({"extra": dying, "places": spark.createDataFrame([(2, "Fès")], "id int, city string")})
    assert store.names() == ["extra", "places"] and store.tables()["places"].collect()[0].city == "Rabat"
    assert store.refresh({"extra": lambda: spark.range(7)}, carry=True) == 2
    assert store.tables()["extra"].count() == 7 and store.tables()["places"].count() == 1 and store.tables(1)["extra"].count() == 3
    assert len(store.vacuum()) == 1 and store.tables()["extra"].count() == 7


def counting_model(path, fails=(), garbage=()):
    """A model that notes every call in a file; some prompts make it fail, some get garbage first."""
    def answer(prompt):
        with open(path, "a") as file:
            file.write(prompt + "\n")
        if prompt in fails:
            raise RuntimeError("down")
        calls = open(path).read().splitlines().count(prompt)
        return "garbage" if prompt in garbage and calls == 1 else json.dumps({"hospitals": [], "prompt": prompt})
    return answer


def prompts_of(spark, n):
    return spark.range(n).select(F.col("id").alias("batch_id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))


def test_a_resumed_run_asks_only_what_has_no_answer(spark, tmp_path):
    log, calls = CallLog(spark, str(tmp_path / "log")), tmp_path / "calls"
    model = counting_model(str(calls))
    assert log.run(prompts_of(spark, 30), model, "first", slice_size=10, slices=1, check=inference.is_capacities) == 1
    assert log.replies().count() == 10
    # a job that died: claims and some answers of a slice, written by its finished tasks
    dead = prompts_of(spark, 30).filter("batch_id BETWEEN 10 AND 14").select(
        "batch_id", F.sha2(F.col("prompt").cast("binary"), 256).alias("digest"), F.lit("dead").alias("run"),
        F.lit('{"hospitals": []}').alias("reply"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("calls"))
    dead.write.mode("append").parquet(str(tmp_path / "log/answers"))
    assert log.run(prompts_of(spark, 30), model, "second", slice_size=10, check=inference.is_capacities) == 2
    assert log.run(prompts_of(spark, 30), model, "third", slice_size=10, check=inference.is_capacities) == 0
    made = calls.read_text().splitlines()
    assert sorted(made) == sorted(f"p{i}" for i in range(30) if not 10 <= i <= 14)
    assert {r.batch_id: r.run for r in log.replies().collect()} == {i: "first" if i < 10 else "dead" if i < 15 else "second" for i in range(30)}


def test_changed_prompts_are_asked_again_and_hopeless_ones_given_up(spark, tmp_path):
    log, calls = CallLog(spark, str(tmp_path / "log"), attempts=2), tmp_path / "calls"
    model = counting_model(str(calls), fails=["p1"], garbage=["p2"])
    for _ in range(4):
        log.run(prompts_of(spark, 4), model, retries=3, check=inference.is_capacities)
    made = calls.read_text().splitlines()
    # two runs of three calls each for what fails, one repeated call for garbage
    assert [made.count(f"p{i}") for i in range(4)] == [1, 6, 2, 1]
    assert {(r.batch_id, r.error) for r in log.answers().filter("reply IS NULL").collect()} == {(1, "RuntimeError: down")}
    changed = prompts_of(spark, 4).withColumn("prompt", F.when(F.col("batch_id") == 3, "other").otherwise(F.col("prompt")))
    log.run(changed, model, check=inference.is_capacities)
    assert calls.read_text().splitlines()[len(made):] == ["other"]


def test_each_call_is_a_task_of_its_own_and_stored_when_its_task_ends(spark, tmp_path):
    log = CallLog(spark, str(tmp_path / "log"))
    log.run(prompts_of(spark, 12), counting_model(str(tmp_path / "calls")), slice_size=100)
    assert log.answers().inputFiles().__len__() >= 6 and not list((tmp_path / "log/answers").glob("_temporary/*"))


def test_short_calls_share_tasks_and_each_is_made_once(spark, tmp_path):
    log, calls = CallLog(spark, str(tmp_path / "log")), tmp_path / "calls"
    assert log.run(prompts_of(spark, 40), counting_model(str(calls)), slice_size=20, together=10) == 2
    assert sorted(calls.read_text().split()) == sorted(f"p{i}" for i in range(40))
    assert len(log.answers().inputFiles()) <= 6 and log.claims().count() == 40
    assert log.run(prompts_of(spark, 40), counting_model(str(calls)), slice_size=20, together=10) == 0


class WatchedLog(CallLog):
    """Notes the batches and tasks of every job that calls, and dies of some batches."""
    dies, jobs = frozenset(), ()

    def _call(self, own, model, tasks, retries, check):
        asked = sorted(r.batch_id for r in own.collect())
        assert {r.batch_id for r in self.claims().collect()} >= set(asked)
        self.jobs = (*self.jobs, (asked, tasks))
        if self.dies.intersection(asked):
            raise InterruptedError("the job dies here")
        super()._call(own, model, tasks, retries, check)


def test_short_slices_go_out_in_waves_and_each_call_is_made_once(spark, tmp_path):
    log, calls = WatchedLog(spark, str(tmp_path / "log")), tmp_path / "calls"
    model = counting_model(str(calls))
    assert log.run(prompts_of(spark, 60), model, "first", slice_size=2, slices=11) == 11
    assert sum((asked for asked, _ in log.jobs), []) == list(range(22)) and len(log.jobs) <= 6
    assert [tasks for _, tasks in log.jobs] == [len(asked) for asked, _ in log.jobs]
    assert log.run(prompts_of(spark, 60), model, "second", slice_size=2) == 19
    assert log.run(prompts_of(spark, 60), model, "third", slice_size=2) == 0
    assert sorted(calls.read_text().split()) == sorted(f"p{i}" for i in range(60))
    assert {r.batch_id: r.run for r in log.replies().collect()} == {i: "first" if i < 22 else "second" for i in range(60)}
    assert log.claims().count() == 60 == log.answers().agg(F.sum("calls")).first()[0]


def test_long_slices_go_out_alone_and_short_calls_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("recordwell.operators.calls._WAVE_SECONDS", 0, raising=False)
    monkeypatch.setattr("recordwell.operators.calls._TASK_SECONDS", 1000, raising=False)
    log, model = WatchedLog(spark, str(tmp_path / "log")), counting_model(str(tmp_path / "calls"))
    log.run(prompts_of(spark, 32), model, slice_size=8, together=2)
    assert log.jobs == tuple((list(range(8 * i, 8 * i + 8)), tasks) for i, tasks in enumerate([4, 2, 1, 1]))
    one_each = WatchedLog(spark, str(tmp_path / "one"))
    one_each.run(prompts_of(spark, 8), model, slice_size=4)
    assert [tasks for _, tasks in one_each.jobs] == [4, 4]


def test_slices_of_a_wave_that_died_go_out_alone(spark, tmp_path):
    calls = tmp_path / "calls"
    log, model = WatchedLog(spark, str(tmp_path / "log"), attempts=2), counting_model(str(calls))
    log.dies = frozenset([9])
    for _ in range(2):
        with pytest.raises(InterruptedError):
            log.run(prompts_of(spark, 20), model, slice_size=2)
    before = log.jobs[-2:]
    assert [asked for asked, _ in before] == [[6, 7], [8, 9]]  # what may have killed the wave goes out slice by slice
    log.run(prompts_of(spark, 20), model, slice_size=2)
    assert sorted(calls.read_text().split()) == sorted(f"p{i}" for i in range(20) if i not in (8, 9))
    assert sorted(r.batch_id for r in log.claims().groupBy("batch_id").count().filter("count > 2").collect()) == []
    single = WatchedLog(spark, str(tmp_path / "single"), attempts=1)
    single.run(prompts_of(spark, 6), model, slice_size=2)
    assert [asked for asked, _ in single.jobs] == [[0, 1], [2, 3], [4, 5]]


HOSPITAL = "id long, name string, city string, address string, phone string, email string, website string, beds int"


def test_searches_are_written_back_and_found_again(spark, tmp_path, rows):
    calls = tmp_path / "calls"

    def model(prompt):
        with open(calls, "a") as file:
            file.write("call\n")
        if "Name: bad\n" in prompt and calls.read_text().count("call") < 3:
            return "no JSON"
        return json.dumps({"address": "rue 1", "phone": "call me", "website": "www.x.ma", "beds": 20})

    hospitals = spark.createDataFrame([
        (1, "a", "Fès", None, None, None, None, None), (2, "a", "Fès", None, None, "x@y.ma", None, 0), (3, "a", None, None, None, None, None, None),
        (4, "full", "Fès", "x", "05", "e@x.ma", "http://x", None), (5, "kept", "Fès", "x", "05", "e@x.ma", "http://x", 7)], HOSPITAL)
    store = RunTable(spark, str(tmp_path / "store"), ATTRIBUTES, "ask")
    store.append(spark.createDataFrame([('["kept","Fès"]', "old", None, None, None, 3, "high")], ATTRIBUTES))
    log = CallLog(spark, str(tmp_path / "log"))
    found = rows(search_cached(hospitals, store, log, model))
    new = ("rue 1", None, None, "https://www.x.ma", 20)
    assert found == [(1, *new), (2, *new), (3, *new), (5, "old", None, None, None, 3)]
    assert calls.read_text().count("call") == 2 and [r["rows"] for r in store.runs()] == [1, 2]
    assert rows(search_cached(hospitals, store, log, model)) == found and calls.read_text().count("call") == 2
    assert rows(search_cached(hospitals, store, log, None)) == found


def test_garbage_attributes_are_asked_again(spark):
    hospitals = spark.createDataFrame([(1, "a", "Fès", None, None, None, None, None)], HOSPITAL)
    tried = []

    def model(prompt, tried=tried):
        tried.append(1)
        return "[1]" if len(tried) < 3 else '{"address": "rue 2"}'

    assert inference.search_attributes(hospitals, None, model).collect()[0].address == "rue 2"


# ---------------------------------------------------------------- deletes


def test_parents_come_first_and_circles_share_a_group():
    links = [("c", "x", "b", "cascade"), ("b", "x", "a", "cascade"), ("a", "x", "c", "set null"), ("d", "x", "c", "cascade"), ("e", "x", "e", "cascade")]
    groups = [set(g) for g in references.groups_in_order(["d", "c", "b", "a", "e"], links)]
    assert {"a", "b", "c"} in groups and groups.index({"a", "b", "c"}) < groups.index({"d"})


def plain_delete(tables, links, deleted):
    """Tables as lists of dicts with an id; deletes followed until nothing changes."""
    gone = {t: set(deleted.get(t, ())) for t in tables}
    while True:
        before = sum(map(len, gone.values()))
        for child, fk, parent, action in links:
            if action == "cascade":
                gone[child] |= {r["id"] for r in tables[child] if r[fk] in gone[parent] and r[fk] is not None}
        if sum(map(len, gone.values())) == before:
            break
    out = {}
    for name, members in tables.items():
        kept = [dict(r) for r in members if r["id"] not in gone[name]]
        for child, fk, parent, action in links:
            for r in kept if child == name and action == "set null" else ():
                if r[fk] in gone[parent]:
                    r[fk] = None
        out[name] = sorted((tuple(r.values()) for r in kept), key=repr)
    return out


def test_deletes_follow_every_hop_and_circles(spark, rows):
    tables = {
        "region": [{"id": i} for i in range(4)],
        "place": [{"id": i, "region": i % 5} for i in range(20)],
        "staff": [{"id": i, "place": None if i % 7 == 0 else i % 22, "boss": i // 2 if i else None} for i in range(40)],
        "ward": [{"id": i, "place": i % 20, "head": i * 3 % 40} for i in range(30)],
        "bed": [{"id": i, "ward": i % 33 if i % 3 else None, "first": i % 4} for i in range(90)],
    }
    links = [
        ("place", "region", "region", "cascade"), ("staff", "place", "place", "set null"), ("staff", "boss", "staff", "cascade"),
        ("ward", "place", "place", "cascade"), ("ward", "head", "staff", "set null"), ("bed", "ward", "ward", "cascade"),
        ("bed", "first", "region", "set null"),
    ]
    frames = {n: spark.createDataFrame([tuple(r.values()) for r in m], ", ".join(f"{c} int" for c in m[0])) for n, m in tables.items()}
    for deleted in ({}, {"region": [1]}, {"region": [1, 9], "staff": [3]}, {"staff": [1], "bed": [5, 6]}, {"place": [4, 5]}):
        ids = {n: spark.createDataFrame([(i,) for i in own], "id int") for n, own in deleted.items()}
        got = references.delete_rows(frames, links, ids)
        assert {n: rows(df) for n, df in got.items()} == plain_delete(tables, links, deleted)
        assert all(df.columns == frames[n].columns for n, df in got.items())


def test_two_tables_that_refer_to_each_other(spark, rows):
    tables = {"a": [{"id": i, "b": i + 1} for i in range(12)], "b": [{"id": i, "a": i + 1} for i in range(12)]}
    links = [("a", "b", "b", "cascade"), ("b", "a", "a", "cascade")]
    frames = {n: spark.createDataFrame([tuple(r.values()) for r in m], ", ".join(f"{c} int" for c in m[0])) for n, m in tables.items()}
    got = references.delete_rows(frames, links, {"a": spark.createDataFrame([(8,)], "id int")})
    assert {n: rows(df) for n, df in got.items()} == plain_delete(tables, links, {"a": [8]})
    with pytest.raises(ValueError, match="unknown action"):
        references.delete_rows(frames, [("a", "b", "b", "restrict")], {})


def test_a_write_counts_its_changes_without_another_job(spark, tmp_path, rows):
    before = spark.createDataFrame([(1, None, "a"), (2, "x", "a"), (3, None, None), (4, "x", None)], "id long, city string, region string")
    after = spark.createDataFrame([(1, "y", "a"), (2, "x", "b"), (4, "x", None), (9, "new", None)], before.schema)
    path, context = str(tmp_path / "after"), spark.sparkContext
    context.setJobGroup("observed", "")
    counts = checks.write_changes(before, after, "id", ["city", "region"], path)
    written = len(context.statusTracker().getJobIdsForGroup("observed"))
    context.setJobGroup("plain", "")
    checks._paired(before, after, "id", ["city", "region"]).write.parquet(str(tmp_path / "plain"))
    assert written == len(context.statusTracker().getJobIdsForGroup("plain"))
    context.setJobGroup("rest", "")
    assert counts == checks.change_statistics(before, after, "id", ["city", "region"]).first().asDict()
    assert counts == {"rows_before": 4, "rows_deleted": 1, "rows_updated": 2, "city_found": 1, "region_found": 0}
    assert rows(spark.read.parquet(path), "id", "city", "region") == [(1, "y", "a"), (2, "x", "b"), (4, "x", None)]
    empty = checks.write_changes(before.limit(0), after, "id", ["city"], path)
    assert set(empty.values()) == {0}
