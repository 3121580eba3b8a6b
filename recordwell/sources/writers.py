"""Writers: files, typed tables, ordered loads and JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from recordwell.sources.readers import if_there
from recordwell.sources.schemas import COLUMN_DEFAULTS, LOAD_ORDER, TABLES

# What a writer does when the target exists.
SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV with doubled quotes; one file per partition."""
    (
        df.write.mode(mode).option("header", True)
        .option("quote", '"').option("escape", '"').option("emptyValue", "")
        .csv(path)
    )


def write_stage(df: DataFrame, folder: str, name: str, mode: str = "overwrite") -> DataFrame:
    """Write one stage dataset as Parquet and return it read back, with its lineage cut."""
    path = f"{folder}/{name}"
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carry_forward(spark: SparkSession, source: str, target: str, names: Iterable[str]) -> list[str]:
    """Copy stage datasets a stage does not change; names absent from the source are skipped."""
    done = []
    for name in names:
        df = if_there(lambda path=f"{source}/{name}": spark.read.parquet(path))
        if df is not None:
            df.write.mode("overwrite").parquet(f"{target}/{name}")
            done.append(name)
    return done


def conform(df: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The table's columns that ``df`` has, in table order, cast tolerantly to its types.

    Absent columns take their declared default or null. A frame with none of the
    columns is an error.
    """
    schema = schema or TABLES[table]
    if not set(schema.names) & set(df.columns):
        raise ValueError(f"no column of {table} in {df.columns}")
    defaults = COLUMN_DEFAULTS.get(table, {})
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            value = F.col(f.name)
            if df.schema[f.name].dataType in (T.DoubleType(), T.FloatType()):
                value = F.when(~F.isnan(value), value)
            if df.schema[f.name].dataType != f.dataType:
                value = value.try_cast(f.dataType)
        elif f.name == "created_at":
            value = F.current_timestamp()
        else:
            value = F.lit(defaults.get(f.name)).cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


def create_tables(spark: SparkSession, database: str, tables: Mapping[str, T.StructType] = TABLES) -> None:
    """Create the typed target tables that do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def save_table(df: DataFrame, name: str, if_exists: str = "fail") -> None:
    """Write one table; ``if_exists`` is fail, replace or append."""
    df.write.mode(SAVE_MODES[if_exists]).format("parquet").saveAsTable(name)


def refresh_table(df: DataFrame, name: str) -> None:
    """Replace a table's rows and keep its definition."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)


def promote(df: DataFrame, name: str) -> None:
    """Append rows to an existing table by column name."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=False)


def load_tables(
    frames: Mapping[str, DataFrame],
    database: str,
    order: Iterable[str] = LOAD_ORDER,
    spark: SparkSession | None = None,
) -> list[str]:
    """Full refresh of every given table, parents first; returns the tables written."""
    done = []
    for name in order:
        if name in frames:
            frame = frames[name]
            refresh_table(conform(frame, name) if name in TABLES else frame, f"{database}.{name}")
            done.append(name)
    return done


def write_jdbc(
    df: DataFrame, url: str, table: str, if_exists: str = "append",
    batch_rows: int = 1000, keep_definition: bool = True, partitions: int = 8, **options: str,
) -> None:
    """Batched insert into a database table, at most ``partitions`` connections at once.

    ``replace`` with ``keep_definition`` truncates instead of dropping.
    """
    (
        df.write.format("jdbc").mode(SAVE_MODES[if_exists])
        .option("url", url).option("dbtable", table)
        .option("batchsize", batch_rows).option("truncate", keep_definition)
        .option("numPartitions", partitions).options(**options)
        .save()
    )
