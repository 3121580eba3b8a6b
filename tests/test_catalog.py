"""Every registered query on the smallest tables: rows equal its SQL statement, plan without nested loops."""

import sys
from pathlib import Path

import duckdb
import pytest

from recordwell.catalog import ORACLES, QUERIES
from tests.plans import physical

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import rows_of  # noqa: E402

#: Statements that aggregate to one row or take the top rows end in a single task by nature.
ONE_TASK = {"preview", "dirty_count", "change_statistics", "table_counts"}

#: No rows in the smallest tables; a tenfold table has some.
MAY_BE_EMPTY = {"hospital_duplicates", "orphan_keys"}


@pytest.fixture(scope="module")
def engine(folder):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, folder, name):
    df = QUERIES[name](spark, folder)
    plan = physical(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    assert name in ONE_TASK or "SinglePartition" not in plan
    mine = rows_of(df.columns, df.collect())
    if name in ORACLES:
        result = engine.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns)
        assert mine == rows_of(names, result.fetchall())
    assert mine or name in MAY_BE_EMPTY


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["repair_places", "fuzzy_dedup", "dense_id", "sample_links", "apply_actions", "priority_union"])
def test_rows_do_not_depend_on_partitioning(spark, folder, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for partitions in ("1", "5", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            df = QUERIES[name](spark, folder)
            seen.append(rows_of(df.columns, df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
