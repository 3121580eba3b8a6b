"""Append-only ledger of processed keys: what makes a long enrichment resumable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from recordwell.sources.readers import empty, if_there


class Ledger:
    """Rows already processed, one Parquet folder per written slice.

    A slice is written in one job, so a lost executor or driver leaves either the
    whole slice or nothing. Reading the ledger replaces both the cache (key to
    result) and the checkpoint (what is done).
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "key"):
        if key not in schema.names:
            raise ValueError(f"{key!r} is not a ledger column")
        self.spark, self.path, self.schema, self.key = spark, path, schema, key

    def read(self) -> DataFrame:
        rows = if_there(lambda: self.spark.read.schema(self.schema).parquet(self.path))
        return empty(self.spark, self.schema) if rows is None else rows.select(*self.schema.names)

    def append(self, rows: DataFrame, slice_id: int) -> None:
        """Write one slice; writing the same slice again replaces it."""
        (
            rows.select(*self.schema.names).write.mode("overwrite")
            .parquet(f"{self.path}/slice={slice_id}")
        )

    def pending(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the ledger does not hold yet."""
        done = self.read().select(F.col(self.key).alias("_done"))
        return rows.join(done, rows[self.key] == done["_done"], "left_anti")
