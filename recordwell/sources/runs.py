"""A key/value table on shared storage: sorted runs, the latest wins, compaction.

Every write adds one run, sorted by key in ranges; nothing is rewritten. A manifest names the live runs with their
number of rows and their least and greatest key. Reading joins the runs and keeps each key's row of the latest run; a
lookup reads only runs whose range meets the keys asked for. Compaction writes several runs as one and commits a manifest
in which that one stands for them; readers of the old state keep their files until ``vacuum``.

One run holds a key once (of several rows the greatest counts). A removed key is a row with ``_removed`` set, which hides
older rows until a compaction of all runs drops both. Null keys are not stored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from recordwell.operators.keys import keep_best
from recordwell.sources.manifest import Manifest
from recordwell.sources.readers import empty

REMOVED, RUN = "_removed", "_run"
#: Key types whose least and greatest value a manifest can hold.
_RANGED = (T.StringType, T.LongType, T.IntegerType, T.ShortType)


class RunTable:
    """The table in ``path`` with the columns of ``schema``, one of them the key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        if key not in schema.names:
            raise ValueError(f"{key!r} is no column")
        if not isinstance(schema[key].dataType, _RANGED):
            raise ValueError(f"a key of type {schema[key].dataType.simpleString()} has no stored range")
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.manifest = Manifest(spark, f"{path}/manifest")
        self._stored = T.StructType([*schema.fields, T.StructField(REMOVED, T.BooleanType())])

    def runs(self) -> list[dict]:
        """The live runs, oldest first: name, number, rows, least, greatest."""
        return self.manifest.latest()[1].get("runs", [])

    # ------------------------------------------------------------ writing

    def append(self, rows: DataFrame) -> int:
        """Add rows as one run, newer than all others; returns how many keys it has (no run for no rows)."""
        return self._add(rows.select(*self.schema.names).withColumn(REMOVED, F.lit(False)))

    def remove(self, keys: DataFrame) -> int:
        """Hide the rows of these keys."""
        blank = [F.col(self.key) if f.name == self.key else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return self._add(keys.select(*blank, F.lit(True).alias(REMOVED)))

    def _add(self, rows: DataFrame) -> int:
        state, content = self.manifest.latest()
        others = [F.col(c) for c in self._stored.names if c != self.key]
        single = rows.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(F.struct(*others)).alias("_row"))
        run = self._write(single.select(self.key, "_row.*").select(*self._stored.names), content.get("last", 0) + 1)
        if run is None:
            return 0
        self.manifest.commit(state + 1, {"runs": [*content.get("runs", []), run], "last": run["number"]})
        return run["rows"]

    def _write(self, rows: DataFrame, number: int) -> dict | None:
        """Write one run; its size and range are observed while it is written."""
        if rows.isEmpty():
            return None
        name, seen = f"run-{number}-{uuid.uuid4().hex}", Observation()
        ordered = rows.repartitionByRange(self.key).sortWithinPartitions(self.key)
        ordered.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.min(self.key).alias("least"), F.max(self.key).alias("greatest"),
        ).write.parquet(f"{self.path}/runs/{name}")
        return {"name": name, "number": number, **seen.get}

    # ------------------------------------------------------------ reading

    def _rows(self, runs: list[dict]) -> DataFrame:
        """All rows of the runs with their run's number."""
        parts = [
            self.spark.read.schema(self._stored).parquet(f"{self.path}/runs/{run['name']}").withColumn(RUN, F.lit(run["number"]).cast("long"))
            for run in runs
        ]
        return reduce(DataFrame.unionByName, parts) if parts else empty(
            self.spark, T.StructType([*self._stored.fields, T.StructField(RUN, T.LongType())]))

    def _latest(self, runs: list[dict]) -> DataFrame:
        rows = self._rows(runs)
        return rows if len(runs) < 2 else keep_best(rows, [self.key], [F.desc(RUN)])

    def read(self, with_run: bool = False) -> DataFrame:
        """The latest row of every key; ``with_run`` adds the number of the run it came with."""
        rows = self._latest(self.runs()).filter(~F.col(REMOVED)).drop(REMOVED)
        return rows if with_run else rows.drop(RUN)

    def overlapping(self, least, greatest) -> list[dict]:
        """The live runs that may hold a key of the range."""
        return [run for run in self.runs() if least is not None and run["least"] <= greatest and run["greatest"] >= least]

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys (a frame with the key column); runs beyond their range are not read."""
        wanted = keys.select(self.key).distinct()
        least, greatest = wanted.agg(F.min(self.key), F.max(self.key)).first()
        rows = self._rows(self.overlapping(least, greatest)).filter(F.col(self.key).between(F.lit(least), F.lit(greatest)))
        # keys first: what nobody asked for is not ranked
        asked = rows.join(wanted, self.key, "left_semi")
        return keep_best(asked, [self.key], [F.desc(RUN)]).filter(~F.col(REMOVED)).select(*self.schema.names)

    # ------------------------------------------------------------ upkeep

    def compact(self, newest: int | None = None) -> None:
        """Write the ``newest`` runs (all by default) as one; readers see the same rows before and after."""
        state, content = self.manifest.latest()
        runs = content.get("runs", [])
        merged = runs if newest is None else runs[len(runs) - min(newest, len(runs)):]
        if len(merged) < 2:
            return
        kept = runs[:len(runs) - len(merged)]
        rows = self._latest(merged).drop(RUN)
        if not kept:
            rows = rows.filter(~F.col(REMOVED))
        run = self._write(rows, merged[-1]["number"])
        self.manifest.commit(state + 1, {"runs": [*kept, *([run] if run else [])], "last": content["last"], "replaced": [r["name"] for r in merged]})

    def compact_tiers(self, ratio: int = 4) -> None:
        """Merge the newest runs while together they are at least a ``ratio``-th of the run before: few runs, each row moved a few times."""
        runs = self.runs()
        if len(runs) < 2:
            return
        n, size = 1, runs[-1]["rows"]
        while n < len(runs) and size * ratio >= runs[-1 - n]["rows"]:
            size += runs[-1 - n]["rows"]
            n += 1
        self.compact(n)

    def vacuum(self) -> list[str]:
        """Delete the runs that compactions replaced; call it when no reader of an older state is left."""
        live = {run["name"] for run in self.runs()}
        gone = sorted({name for n in self.manifest.numbers() for name in self.manifest.read(n).get("replaced", [])} - live)
        for name in gone:
            self.manifest.remove(f"{self.path}/runs/{name}")
        return gone
