"""Queries on large extracts: JSON arrays and quoted CSV that many tasks read."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recordwell.catalog.registry import query, table
from recordwell.catalog.tables import scratch
from recordwell.sources import readers, splits


def write_framed(lines: DataFrame, path: str, first: str, between: str, last: str) -> None:
    """Write one text file per task: ``first``, the lines with ``between`` in front of all but the first, ``last``."""
    def frame(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begun = False
        for rows in frames:
            lines = [between + line for line in rows["value"]]
            if lines and not begun:
                lines[0], begun = first + lines[0][len(between):], True
            yield pd.DataFrame({"value": lines})
        if begun and last:
            yield pd.DataFrame({"value": [last]})

    lines.select(F.col(lines.columns[0]).alias("value")).mapInPandas(frame, "value string").write.text(path)


@query("json_array_objects", "SELECT CAST(doc_id AS VARCHAR) AS \"ID\", CASE WHEN doc_id % 5 > 0 THEN text END AS \"NOM\", lang AS \"VILLE\" FROM documents")
def _(spark, folder):
    """Documents as items of arrays, between items that are no objects; brackets and quotes stand in the texts."""
    docs = table(spark, folder, "documents")
    item = F.to_json(F.struct(
        F.col("doc_id").alias("ID"), F.when(F.col("doc_id") % 5 > 0, F.col("text")).alias("NOM"), F.col("lang").alias("VILLE"),
        F.array(F.lit('a "]" \\'), F.lit("{,")).alias("other"), F.struct(F.lit(1).alias("a")).alias("nested")))
    foreign = [F.lit(x) for x in ("3", '"x, {\\" ["', "null", '[1, {"ID": "9"}]', "{}", '{"other": 1}')]
    items = docs.select(F.explode(F.when(F.col("doc_id") % 7 == 0, F.array(item, *foreign)).otherwise(F.array(item))).alias("value"))
    path = scratch(spark, "array")
    write_framed(items, path, "[", ",", "]")
    return splits.read_json_array(spark, path, ["ID", "NOM", "VILLE"])


@query("csv_splits", "SELECT CAST(doc_id AS VARCHAR) AS \"Région\", text AS texte, CASE WHEN doc_id % 9 > 0 THEN lang || ', \"' || source || '\"' END AS note FROM documents")
def _(spark, folder):
    """Whole documents in quoted cells, each file with a mark, a preamble and a header."""
    note = F.when(F.col("doc_id") % 9 > 0, F.concat("lang", F.lit(', "'), "source", F.lit('"'))).otherwise("N/A")

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    lines = table(spark, folder, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), quoted(F.col("text")), quoted(note)))
    path = scratch(spark, "quoted")
    write_framed(lines, path, "﻿Liste officielle\n\n;source,x\n Région ,texte,note\n", "", "")
    return splits.read_csv_splits(spark, path, header_words=("Région", "Region"))


@query("optional_sources", "SELECT doc_id AS id, source, lang, NULL AS note, 'dirty' AS kind FROM documents WHERE doc_id % 4 = 0 AND doc_id % 6 > 0 "
       "UNION ALL SELECT doc_id, source, NULL, 'cached ' || lang, 'cached' FROM documents WHERE doc_id % 10 < 3 AND source IN (SELECT source FROM documents WHERE doc_id % 6 > 0)")
def _(spark, folder):
    """Rows without a region, and cached answers whose source is a known one; files that do not exist and a broken cache give nothing."""
    docs = table(spark, folder, "documents").selectExpr("doc_id AS id", "source", "lang", "doc_id % 4 > 0 AS whole")
    path = scratch(spark, "cache")
    entry = F.to_json(F.map_from_arrays(F.array(F.col("id").cast("string")), F.array(F.struct(
        "source", F.concat(F.lit("cached "), F.col("lang")).alias("note")))))
    lines = docs.filter("id % 10 < 3").select(entry.alias("value")).select(F.expr("substr(value, 2, length(value) - 2)"))
    write_framed(lines, f"{path}/good", "{", ",", "}")
    known = readers.valid_ids(docs.filter("id % 6 > 0"), "source").withColumnRenamed("source", "_source")
    value = StructType([StructField("source", StringType()), StructField("note", StringType())])
    spark.createDataFrame([('{"1": {"source": ',)], "value string").write.text(f"{path}/broken")
    cached = reduce(DataFrame.unionByName, [
        readers.read_cache_json(spark, f"{path}/{name}", value, "id") for name in ("good", "broken", "absent")])
    cached = cached.join(known, F.col("source") == F.col("_source"), "left_semi")
    absent = readers.read_csv(spark, f"{path}/absent.csv", columns=["id", "source", "lang", "note", "kind"])
    dirty = readers.read_dirty(docs.filter("id % 6 > 0").withColumn("region", F.when(F.col("whole"), "r")), columns=("id", "source", "lang"))
    return reduce(DataFrame.unionByName, [
        dirty.select("id", "source", "lang", F.lit(None).cast("string").alias("note"), F.lit("dirty").alias("kind")),
        cached.select(F.col("id").cast("long").alias("id"), "source", F.lit(None).cast("string").alias("lang"), "note", F.lit("cached").alias("kind")),
        absent.select(F.col("id").cast("long").alias("id"), "source", "lang", "note", "kind"),
    ])
