"""JSON messages exchanged with a model: build, parse, check."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from recordwell.functions.text import ColumnOrName, _col

ACTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("city", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("action", T.StringType()),
])

CAPACITY = T.StructType([
    T.StructField("hospitals", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("service_count", T.IntegerType()),
        T.StructField("equipment_count", T.IntegerType()),
        T.StructField("beds", T.IntegerType()),
    ])))
])

ATTRIBUTES = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("website", T.StringType()),
    T.StructField("beds", T.StringType()),
    T.StructField("source_quality", T.StringType()),
])


def records_json(records: ColumnOrName) -> Column:
    """Array of structs as JSON text, null fields written out."""
    return F.to_json(_col(records), {"ignoreNullFields": "false"})


def parse_actions(reply: ColumnOrName) -> Column:
    """Array of actions, or null unless the reply is an array whose every item has id and action."""
    parsed = F.from_json(_col(reply), T.ArrayType(ACTION), {"mode": "PERMISSIVE"})
    whole = F.trim(_col(reply)).startswith("[")
    complete = F.forall(parsed, lambda x: x["id"].isNotNull() & x["action"].isNotNull())
    return F.when(whole & complete, parsed)


def parse_capacity(reply: ColumnOrName) -> Column:
    return F.from_json(_col(reply), CAPACITY)["hospitals"]


def parse_attributes(reply: ColumnOrName) -> Column:
    return F.from_json(_col(reply), ATTRIBUTES)


def missing_fields(blank_fields: tuple[str, ...], zero_fields: tuple[str, ...] = ()) -> Column:
    """Names of the fields a row lacks: null or empty text, or null or zero number."""
    tests = [F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(c)) for c in blank_fields]
    tests += [F.when(F.col(c).isNull() | (F.col(c) == 0), F.lit(c)) for c in zero_fields]
    return F.array_compact(F.array(*tests))
