"""Readers: delimited files, JSON arrays, tables and caches as DataFrames.

Delimited files are always read as text and typed later by tolerant casts, because
inference would turn codes such as ``0005`` into numbers.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from recordwell.functions.text import READER_NULL_TOKENS

#: Name of the column that carries a row's place in its source.
ORDER = "_ord"


def file_order() -> Column:
    """A row's place as text that sorts by file name, then by the place in the file."""
    return F.concat_ws("/", F.input_file_name(), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _null_tokens(df: DataFrame) -> DataFrame:
    """Reader-level missing values in every column; the order column is left alone."""
    return df.select(*[
        F.when(F.col(f"`{c}`").isin(*READER_NULL_TOKENS), F.lit(None))
        .otherwise(F.col(f"`{c}`")).alias(c)
        for c in df.columns
    ])


def unique_names(names: Sequence[str]) -> list[str]:
    """Make repeated header names distinct (``name``, ``name.1``), as pandas does."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(name if n == 0 else f"{name}.{n}")
    return out


def if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return if_there(lambda: spark.read.text(path)) is not None


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _csv_rows(spark: SparkSession, path: str, names: Sequence[str], multi_line: bool) -> DataFrame:
    return (
        spark.read.schema(_text_schema(names))
        .option("header", False)
        .option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    with_order: bool = False,
    missing_ok: bool = True,
    columns: Sequence[str] = (),
) -> DataFrame:
    """Headed CSV as text columns; a byte-order mark and reader null tokens are dropped.

    ``multi_line`` allows line breaks inside quotes but makes each file one task: give
    very large extracts as many files, or switch it off where no field holds a break.
    ``with_order`` adds the row's place. A missing path gives an empty table with
    ``columns`` unless ``missing_ok`` is off.
    """
    reader = (
        spark.read.option("header", True).option("multiLine", multi_line)
        .option("inferSchema", False)
        .option("quote", '"').option("escape", '"')
    )
    found = if_there(lambda: reader.csv(path)) if missing_ok else reader.csv(path)
    df = _null_tokens(found) if found is not None else empty(spark, _text_schema(columns))
    return df.withColumn(ORDER, file_order()) if with_order else df


def read_csv_with_preamble(
    spark: SparkSession,
    path: str,
    header_words: Sequence[str] = ("Région", "Region"),
    look: int = 20,
    multi_line: bool = True,
    with_order: bool = False,
) -> DataFrame:
    """One CSV file whose header is the first of the first ``look`` lines holding a header word.

    Rows above the header are dropped by their place in the first partition, which
    starts at the top of the file. Without such a line the first line is the header.
    """
    head = [r.value for r in spark.read.text(path).limit(look).collect()]
    lines = [line for line in head if line.strip()]
    at = next((i for i, line in enumerate(lines) if any(w in line for w in header_words)), 0)
    header = lines[at].lstrip("﻿").rstrip("\r") if lines else ""
    names = unique_names([n.strip() for n in next(csv.reader([header]), [])])
    rows = _csv_rows(spark, path, [f"c{i}" for i in range(len(names))], multi_line)
    rows = rows.withColumns({"_at": F.monotonically_increasing_id(), ORDER: file_order()}).filter(F.col("_at") > at)
    order = rows[ORDER]
    cleaned = rows.select(
        *[
            F.when(F.col(f"c{i}").isin(*READER_NULL_TOKENS), F.lit(None)).otherwise(F.col(f"c{i}")).alias(n)
            for i, n in enumerate(names)
        ],
        order,
    )
    return cleaned if with_order else cleaned.drop(ORDER)


def read_json_objects(
    spark: SparkSession,
    path: str,
    fields: Sequence[str],
    multi_line: bool = True,
    with_order: bool = False,
    missing_ok: bool = True,
) -> DataFrame:
    """JSON array of objects as text columns; items that are no objects are skipped.

    ``multi_line`` off reads one object per line, which Spark can split.
    """
    schema = _text_schema(fields)
    parts = _text_schema([*fields, "_corrupt"])
    reader = (
        spark.read.schema(parts).option("columnNameOfCorruptRecord", "_corrupt")
        .option("multiLine", multi_line).option("primitivesAsString", True)
    )
    rows = if_there(lambda: reader.json(path)) if missing_ok else reader.json(path)
    if rows is None:
        rows = empty(spark, parts)
    # an array with an item that is no object comes back whole as corrupt text: take it apart item by item
    items = F.transform(
        F.from_json("_corrupt", T.ArrayType(T.StringType())),
        lambda item: F.from_json(item, schema, {"primitivesAsString": "true"}),
    )
    whole = F.array(F.struct(*[F.col(f"`{f}`").alias(f) for f in fields]))
    rows = rows.select(F.explode(F.when(F.col("_corrupt").isNull(), whole).otherwise(items)).alias("r")).select("r.*")
    if with_order:
        rows = rows.withColumn(ORDER, file_order())
    known = F.lit(False)
    for f in fields:
        known = known | F.col(f"`{f}`").isNotNull()
    return rows.filter(known)


def read_dirty(df: DataFrame, limit: int | None = None, id_col: str = "id",
               columns: Sequence[str] = ("id", "city"), missing: str = "region") -> DataFrame:
    """Rows whose ``missing`` column is null, narrowed to what a repair needs.

    On a table or JDBC source the filter and the columns reach the scan.
    """
    rows = df.filter(F.col(missing).isNull()).select(*columns)
    return rows if limit is None else rows.orderBy(id_col).limit(limit)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """Database table; with a numeric column and its bounds the scan is split."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_cache_json(spark: SparkSession, path: str, value: T.StructType, key: str = "key") -> DataFrame:
    """A JSON object ``key -> value`` as rows; a missing or broken file gives no rows."""
    schema = T.StructType([T.StructField(key, T.StringType()), *value.fields])
    texts = if_there(lambda: spark.read.text(path, wholetext=True))
    if texts is None:
        return empty(spark, schema)
    entries = F.from_json("value", T.MapType(T.StringType(), value))
    return texts.select(F.explode(entries).alias(key, "v")).select(key, "v.*")


def valid_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """The id domain of a dimension."""
    return df.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
