"""Boilerplate lines: lines that spread over many distinct sites are cut out of all texts.

A line is its text without blanks around it, known by a 64-bit hash. Every line gets a HyperLogLog
sketch of the sites it is on; sketches merge by aggregation. A line whose estimate is surely above or
below the threshold is decided by it; lines near it get an exact distinct count.

Before any sketch, lines with fewer occurrences than the threshold are left out: they cannot be on so
many sites. Lines travel as hashes, never as text; texts meet the places to cut in one join by id.

Defined results: null and empty texts have no lines and stay as they are; blank lines are never
boilerplate. A null site counts as one site of its own. Rows that repeat id and text are cut alike. A text
whose lines all go becomes empty. Empty tables give empty results. Other columns are not looked at and
stay (``remove_lines``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordwell.llm.common import attach_groups
from recordwell.session import cut_lineage

#: Sites that make a line boilerplate; precision of the sketches (2^12 registers, relative standard
#: error 1.6 %); how many standard errors, and sites at least, around the threshold are counted exactly.
SITES, PRECISION, ERRORS, MARGIN = 10, 12, 6, 1.0
#: Blanks around a line.
BLANKS = " \t\r\x0b\x0c"


def spread_lines(lines: DataFrame, total: int, sites: int = SITES) -> DataFrame:
    """(line, occurrences, sites) of the lines (line, site) that are on at least ``sites`` sites."""
    frequent = cut_lineage(lines.groupBy("line").agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") >= sites))
    sketched = attach_groups(lines, frequent, ["line"], "occurrences", total).groupBy("line", "occurrences").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(PRECISION))).alias("estimate"))
    sketched = cut_lineage(sketched)
    margin = max(MARGIN, ERRORS * 1.04 / 2 ** (PRECISION / 2) * sites)
    sure = sketched.filter(F.col("estimate") >= sites + margin).select("line", "occurrences", F.col("estimate").alias("sites"))
    near = sketched.filter((F.col("estimate") > sites - margin) & (F.col("estimate") < sites + margin)).drop("estimate")
    # distinct (line, site) in every map task first, so a line on all rows sends a row per site and task
    exact = attach_groups(lines, near, ["line"], "occurrences", total).groupBy("line", "occurrences", "site").agg(
        F.lit(1).alias("one")).groupBy("line", "occurrences").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= sites)
    return sure.unionByName(exact)


def _split(text: str):
    return F.split(F.col(text), "\n", -1)


def remove_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES,
) -> DataFrame:
    """``docs`` with boilerplate lines cut out of the text, and ``n_lines``, ``n_removed`` (replacing such columns)."""
    rows = docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.concat(F.lit("s"), F.col(site)), F.lit("")).alias("site"),
        F.posexplode(_split(text)).alias("place", "own"),
    ).withColumn("own", F.btrim("own", F.lit(BLANKS))).filter("own != ''")
    lines = cut_lineage(rows.select("key", "text_hash", "site", "place", F.xxhash64("own").alias("line")))
    total = lines.count()
    spread = cut_lineage(spread_lines(lines.select("line", "site"), total, sites))
    cuts = attach_groups(lines.select("key", "text_hash", "place", "line"), spread, ["line"], "occurrences", total).groupBy(
        F.col("key").alias("_cut_key"), F.col("text_hash").alias("_cut_hash")).agg(F.collect_set("place").alias("_cut"))
    cuts = cut_lineage(cuts)
    joined = docs.join(cuts, docs[key].eqNullSafe(F.col("_cut_key")) & (F.xxhash64(docs[text]) == F.col("_cut_hash")), "left")
    parts = F.split(docs[text], "\n", -1)
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_cut")), lambda place: F.get(parts, place))
    new = {
        text: F.when(F.col("_cut").isNull(), docs[text]).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.when(F.coalesce(docs[text], F.lit("")) == "", 0).otherwise(F.size(parts)),
        "n_removed": F.when(F.col("_cut").isNull(), 0).otherwise(F.size("_cut")),
    }
    others = [docs[c] for c in docs.columns if c not in new]
    return joined.select(*others, *[value.alias(name) for name, value in new.items()])
