"""The stages on planted rows, the registered queries on the given tables, and the package's independence."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from recordwell.llm import queries
from tests.plans import physical

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tools"))
from compare import rows_of  # noqa: E402

NATIVE = ("op1_rendezvous", "op5_exact_dedup", "op6_boilerplate", "op9_secrets")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    plan = physical(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    mine = rows_of(df.columns, df.collect())
    assert mine
    if name in queries.ORACLES:
        con = duckdb.connect()
        for file in Path(folder).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = con.execute(queries.ORACLES[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns) and mine == rows_of(names, result.fetchall())


def test_languages_are_right_on_held_out_rows(spark, folder):
    docs = queries.table(spark, folder, "documents").select("doc_id", "lang")
    held = queries.QUERIES["op7_language"](spark, folder).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, print int"


def planted(folder):
    passage = duckdb.sql(f"SELECT text FROM '{folder}/benchmark.parquet' ORDER BY item_id LIMIT 1").fetchall()[0][0]
    body = [" ".join(f"word{(i * 37 + j * j) % 911}" for j in range(80)) for i in range(8)]
    clean = [(i, body[i], "en", "s", 1, 0) for i in range(5)]
    return clean, clean + [
        (10, body[5], "en", "s", 1, 0), (11, body[5], "en", "s", 1, 0),
        (20, body[6], "en", "s", 1, 0), (21, body[6].upper(), "en", "s", 1, 0),
        (30, body[7][:200] + " " + passage + " " + body[7][200:], "en", "s", 1, 0),
        (40, "12345 !!", "en", "s", 1, 0), (41, None, None, None, None, None), (42, "", "en", "s", 0, 0),
    ]


def test_every_stage_does_its_part(spark, folder, tmp_path):
    clean, rows = planted(folder)
    docs = spark.createDataFrame(rows, SCHEMA)
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = sorted(r.doc_id for r in docs.collect())
    kept = [r[0] for r in clean]
    assert left["language"] == [*kept, 10, 11, 20, 21, 30]
    assert left["exact_copies"] == [*kept, 11, 20, 21, 30]
    assert left["near_copies"] == [*kept, 11, 20, 30]
    assert left["benchmark_leaks"] == left["tokens"] == [*kept, 11, 20]
    assert all(r.lossless and r.n_ids == len(r.ids) for r in docs.collect())


def test_stages_of_nothing(spark, folder, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_run_is_registered(spark, folder):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_the_rest_works_without_this_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'recordwell.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and 'repair_places' in e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
