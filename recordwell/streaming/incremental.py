"""The batch operators on files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def process_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    rules: Callable[[DataFrame], DataFrame],
    source_format: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Run ``rules`` on every file not processed before, then stop.

    Each micro-batch overwrites its own folder under ``target`` (``batch=<id>``), so a
    batch that is repeated after a failure replaces itself: every file counts once. The
    checkpoint folder must be shared storage on a cluster.
    """
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        rules(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        reader.load(source).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
