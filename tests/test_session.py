import pytest
from pyspark.sql import functions as F

from recordwell import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class Fake:
    """A session that only knows its settings."""

    def __init__(self, configured, master):
        self.conf = Conf(configured)
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_the_named_folder_is_used():
    assert session.ensure_checkpoint_dir(Fake("hdfs:///shared", "yarn")) == "hdfs:///shared"


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Fake(None, "spark://host:7077"))


def test_cut_lineage_keeps_rows_and_types(spark, rows):
    df = spark.createDataFrame([(1, None, [1, 2], ("a", 2))], "a int, b string, c array<int>, d struct<x:string,y:int>")
    cut = session.cut_lineage(df)
    assert cut.schema.simpleString() == df.schema.simpleString() and rows(cut) == rows(df)
    assert session.cut_lineage(df.limit(0)).count() == 0


def test_broadcast_only_up_to_the_checked_size(spark):
    small = spark.range(10).withColumn("v", F.lit(1))
    assert "ResolvedHint" in session.broadcast_if_small(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in session.broadcast_if_small(small, 9)._jdf.queryExecution().analyzed().toString()
