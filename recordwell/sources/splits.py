"""Large JSON arrays and quoted CSV files, read by many tasks a file.

Where a byte range starts, nobody knows whether it is inside a string, or how deep. So each range is cut into chunks, and
each chunk is scanned from every state it might start in: that gives, for each, the state at its end and how many
cuts (record ends, or commas between items) it holds. A pass over these few numbers, in file order, says in which state
every chunk really starts and which record it starts with; then all chunks are cut at once. Pieces of records that
cross a border carry the number of their record and are put together by it. No cell holds more than a chunk or a record.

Chunks are written to the shared folder between the passes: what the second pass reads does not depend on how files
were split, so a lost executor changes nothing.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from recordwell.functions.text import READER_NULL_TOKENS
from recordwell.session import broadcast_if_small, cut_lineage
from recordwell.sources.readers import ORDER, empty, if_there, unique_names

#: Characters of a chunk; a chunk ends at the next separator.
CHUNK = 1 << 16

#: What a scan may be in the middle of.
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2


@dataclass
class Scan:
    """What a chunk does from one start state: its end state, how much deeper it ends, and its cuts by relative depth."""

    end: int
    deeper: int
    cuts: dict[int, int]


class JsonArray:
    """Items of an array: commas one level down, outside of strings, separate them."""

    separator = ","
    states = (OUTSIDE, INSIDE, ESCAPED)
    #: Depth at which cuts count.
    level = 1
    _mark = re.compile(r'["\[\]{},]')
    _string = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*', re.DOTALL)

    @classmethod
    def marks(cls, text: str, state: int) -> Iterator[tuple[int, str]]:
        """(place, character) of every bracket and comma outside of strings; ends with (-1, end state)."""
        at = 0
        if state == ESCAPED:
            at, state = (1, INSIDE) if text else (0, ESCAPED)
        while state == INSIDE or at < len(text):
            if state == INSIDE:
                at = cls._string.match(text, at).end()
                if at == len(text):
                    yield -1, str(INSIDE)
                    return
                if text[at] == "\\":  # the last character: what it escapes is in the next chunk
                    yield -1, str(ESCAPED)
                    return
                at, state = at + 1, OUTSIDE
                continue
            found = cls._mark.search(text, at)
            if found is None:
                break
            at = found.end()
            if found[0] == '"':
                state = INSIDE
            else:
                yield found.start(), found[0]
        yield -1, str(state)

    @classmethod
    def scan(cls, text: str, state: int) -> Scan:
        depth, cuts, end = 0, Counter(), state
        for at, mark in cls.marks(text, state):
            if at < 0:
                end = int(mark)
            elif mark == ",":
                cuts[depth] += 1
            else:
                depth += 1 if mark in "[{" else -1
        return Scan(end, depth, dict(cuts))

    @classmethod
    def cut(cls, text: str, state: int, depth: int) -> list[str]:
        """The text cut at the commas of level one, without brackets of the array itself and what is outside of it."""
        pieces, parts, begin = [], [], 0 if depth >= 1 else None
        for at, mark in cls.marks(text, state):
            if at < 0:
                continue
            if mark == ",":
                if depth == 1:
                    pieces.append("".join([*parts, text[begin:at]]))
                    parts, begin = [], at + 1
            elif mark in "[{":
                depth += 1
                if depth == 1:
                    begin = at + 1
            else:
                depth -= 1
                if depth == 0 and begin is not None:
                    parts.append(text[begin:at])
                    begin = None
        pieces.append("".join([*parts, text[begin:] if begin is not None else ""]))
        return pieces


class QuotedLines:
    """Records of delimited text: line breaks outside of quotes end them. Quotes come in pairs; a doubled one is two."""

    separator = "\n"
    states = (OUTSIDE, INSIDE)
    level = 0

    @staticmethod
    def scan(text: str, state: int) -> Scan:
        # parts between quotes take turns: every other one is outside
        parts = text.split('"')
        return Scan((state + len(parts) - 1) % 2, 0, {0: sum(part.count("\n") for part in parts[state::2])})

    @staticmethod
    def cut(text: str, state: int, depth: int) -> list[str]:
        """The text cut at the line breaks outside of quotes."""
        pieces, held = [], []
        for n, part in enumerate(text.split('"')):
            if n:
                held.append('"')
            if (n + state) % 2 == OUTSIDE:
                first, *rest = part.split("\n")
                held.append(first)
                for line in rest:
                    pieces.append("".join(held))
                    held = [line]
            else:
                held.append(part)
        pieces.append("".join(held))
        return pieces


Grammar = type[JsonArray] | type[QuotedLines]


def _chunks(spark: SparkSession, path: str, grammar: Grammar, chunk: int) -> DataFrame | None:
    """(file, place, n, text, scans): the files' text in order of (place, n), scanned from every state; None without files."""
    rows = if_there(lambda: spark.read.option("lineSep", grammar.separator).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("place")))
    if rows is None:
        return None
    separator = grammar.separator

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, held, size, n = None, [], 0, 0

        def flush() -> pd.DataFrame:
            text = "".join(held)
            scans = [grammar.scan(text, state) for state in grammar.states]
            return pd.DataFrame({
                "file": [own[0]], "place": [own[1]], "n": [n], "text": [text],
                "scans": [[{"end": s.end, "deeper": s.deeper, "depths": list(s.cuts), "cuts": list(s.cuts.values())} for s in scans]],
            })

        for frame in frames:
            for value, file, place in zip(frame["value"], frame["file"], frame["place"]):
                if (file, place) != own:
                    if held:
                        yield flush()
                    own, held, size, n = (file, place), [], 0, 0
                # a separator stands before every part but a file's first
                if place or n or held:
                    held.append(separator)
                elif value.startswith("﻿"):
                    value = value[1:]
                held.append(value)
                size += len(value) + 1
                if size >= chunk:
                    yield flush()
                    held, size, n = [], 0, n + 1
        if held:
            yield flush()

    scans = "array<struct<end:int,deeper:int,depths:array<int>,cuts:array<long>>>"
    return cut_lineage(rows.mapInPandas(join, f"file string, place long, n long, text string, scans {scans}"))


def _starts(chunks: DataFrame, level: int) -> DataFrame:
    """(file, place, n, state, depth, record, whole): how each chunk starts, and whether its file ends as it should."""
    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "n"])
        state, depth, record, rows = OUTSIDE, 0, 0, []
        for scans in frame["scans"]:
            rows.append((state, depth, record))
            own = scans[state]
            record += sum(int(c) for d, c in zip(own["depths"], own["cuts"]) if depth + d == level)
            state, depth = int(own["end"]), depth + int(own["deeper"])
        out = pd.DataFrame(rows, columns=["state", "depth", "record"])
        out["whole"] = state == OUTSIDE and depth == 0
        return pd.concat([frame[["file", "place", "n"]].reset_index(drop=True), out], axis=1)

    return chunks.select("file", "place", "n", "scans").groupBy("file").applyInPandas(
        compose, "file string, place long, n long, state int, depth int, record long, whole boolean")


def records(spark: SparkSession, path: str, grammar: Grammar, chunk: int = CHUNK) -> DataFrame:
    """(file, record, text, whole): the records of every file under ``path``, numbered from 0 in each file.

    ``whole`` is false for all records of a file that ends inside a string or inside brackets. A missing path gives no rows.
    """
    schema = T.StructType([
        T.StructField("file", T.StringType()), T.StructField("record", T.LongType()),
        T.StructField("text", T.StringType()), T.StructField("whole", T.BooleanType())])
    chunks = _chunks(spark, path, grammar, chunk)
    if chunks is None:
        return empty(spark, schema)
    starts = cut_lineage(_starts(chunks, grammar.level)).withColumnsRenamed({"file": "_file", "place": "_place", "n": "_n"})
    placed = chunks.drop("scans").join(
        broadcast_if_small(starts), (F.col("file") == F.col("_file")) & (F.col("place") == F.col("_place")) & (F.col("n") == F.col("_n")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one chunk at a time: what leaves Python is never larger than a chunk
            for row in (batch.slice(n, 1).to_pylist()[0] for n in range(batch.num_rows)):
                pieces = grammar.cut(row["text"], row["state"], row["depth"])
                size, last = len(pieces), len(pieces) - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["file"]] * size), pa.array([row["place"]] * size, pa.int64()), pa.array([row["n"]] * size, pa.int64()),
                    pa.array([row["whole"]] * size), pa.array(range(row["record"], row["record"] + size), pa.int64()), pa.array(pieces, pa.string()),
                    # the first and the last piece of a chunk may go on in others
                    pa.array([n in (0, last) for n in range(size)]),
                ], ["file", "place", "n", "whole", "record", "text", "open"])

    # cut twice, once for whole records and once for borders: cheaper than storing all text again
    pieces = placed.select("file", "place", "n", "record", "whole", "text", "state", "depth").mapInArrow(
        cut, "file string, place long, n long, whole boolean, record long, text string, open boolean")
    inner = pieces.filter(~F.col("open")).select(*schema.names)
    border = pieces.filter("open").groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("place", "n", "text"))).alias("_parts"), F.min("whole").alias("whole"))
    return inner.unionByName(border.select(
        "file", "record", F.array_join(F.transform("_parts", lambda p: p["text"]), "").alias("text"), "whole"))


def _order() -> Column:
    """A record's place as text that sorts by file, then by the place in it."""
    return F.concat_ws("/", "file", F.lpad(F.col("record").cast("string"), 20, "0"))


def read_json_array(spark: SparkSession, path: str, fields: Sequence[str], with_order: bool = False, chunk: int = CHUNK) -> DataFrame:
    """The objects of JSON arrays as text columns; items that are no objects, or have none of the fields, are skipped.

    Files of any size are read in splits. A file that is no array, or breaks off, gives no rows, as does a missing path.
    ``with_order`` adds the item's place.
    """
    items = records(spark, path, JsonArray, chunk).filter("whole")
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    parsed = items.filter(F.ltrim("text").startswith("{")).withColumn("_o", F.from_json("text", schema, {"primitivesAsString": "true"}))
    columns = [F.col("_o")[f].alias(f) for f in fields]
    known = F.coalesce(*[F.col("_o")[f] for f in fields]).isNotNull()
    return parsed.filter(known).select(*columns, *([_order().alias(ORDER)] if with_order else []))


def read_csv_splits(
    spark: SparkSession, path: str, header_words: Sequence[str] = (), look: int = 20, columns: Sequence[str] = (),
    with_order: bool = False, chunk: int = CHUNK,
) -> DataFrame:
    """Headed CSV as text columns; line breaks may stand in quotes, files of any size are read in splits.

    In each file the header is the first of its first ``look`` records that holds a header word, else the first record that is not
    blank; what stands above is dropped, byte-order marks and reader null tokens too. Files may order their columns
    differently; the result has ``columns``, or all names in order of appearance. A missing path gives no rows.
    """
    rows = records(spark, path, QuotedLines, chunk).withColumn("text", F.regexp_replace("text", "\\r$", "")).filter(F.trim("text") != "")
    word = F.lit(False)
    for w in header_words:
        word = word | F.col("text").contains(w)
    heads = cut_lineage(rows.filter(F.col("record") < look).groupBy("file").agg(
        F.min(F.struct((~word).alias("plain"), "record", "text")).alias("_h")
    ).select(F.col("file").alias("_file"), F.col("_h.record").alias("_head"), F.col("_h.text").alias("_header")))
    # one row a different header
    headers = {h: _names(h) for (h,) in heads.select("_header").distinct().orderBy("_header").collect()}
    wanted = list(columns) or list(dict.fromkeys(name for names in headers.values() for name in names))
    if not wanted:
        return empty(spark, T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *([ORDER] if with_order else []))]))
    width = max((len(names) for names in headers.values()), default=1)
    cells = ", ".join(f"c{i} string" for i in range(width))
    body = rows.join(broadcast_if_small(heads), F.col("file") == F.col("_file")).filter(F.col("record") > F.col("_head"))
    body = body.withColumn("_c", F.from_csv("text", cells, {"quote": '"', "escape": '"', "multiLine": "true"}))

    def cell(name: str) -> Column:
        value = F.lit(None).cast("string")
        for header, names in headers.items():
            if name in names:
                value = F.when(F.col("_header") == header, F.col("_c")[f"c{names.index(name)}"]).otherwise(value)
        return F.when(~value.isin(*READER_NULL_TOKENS), value).alias(name)

    return body.select(*[cell(c) for c in wanted], *([_order().alias(ORDER)] if with_order else []))


def _names(header: str) -> list[str]:
    return unique_names([n.strip() for n in next(csv.reader([header], strict=False), [])])
