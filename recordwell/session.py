"""Session helpers: local sessions for tests, lineage cuts, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Largest table we ever hint as broadcast; the check counts at most one row more.
BROADCAST_ROWS = 200_000


def local_session(cpus: int | str = 8, app: str = "recordwell", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus).replace("*", "8"))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    one machine holds everything anyway, gets a folder of our own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="recordwell-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    What follows depends on the files, not on how they were made, so a lost executor
    costs a re-read. Unlike ``checkpoint()`` the planner sees the true size (estimates
    do not compound over the rounds of a loop) and unused columns are not read.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/recordwell/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most ``max_rows`` rows.

    Beyond that the table is returned without a hint and Spark shuffles the join.
    Meant for narrow tables (names and ids), so rows bound bytes.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
