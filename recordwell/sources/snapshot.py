"""Many tables refreshed as one.

Every table of a refresh is written aside, into the folder of its version; one manifest entry then makes all of
them current. A job that dies half-way leaves the state before it, readers always see tables of one version, and a
version can be read again by its number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from recordwell.sources.manifest import Manifest
from recordwell.sources.schemas import LOAD_ORDER, TABLES
from recordwell.sources.writers import conform

Source = DataFrame | Callable[[], DataFrame]


class Snapshots:
    """The versions of a set of tables in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifest = Manifest(spark, f"{path}/manifest")

    def refresh(self, frames: Mapping[str, Source], order: Iterable[str] = LOAD_ORDER, typed: bool = True,
                carry: bool = False) -> int:
        """Write all frames, parents first, and make them the current version; returns its number.

        Frames may be functions that make them. Tables named in ``schemas`` are cast to their declared columns unless
        ``typed`` is off. ``carry`` keeps current tables that are not given, by reference.
        """
        state, content = self.manifest.latest()
        names = [*[n for n in order if n in frames], *[n for n in frames if n not in set(order)]]
        folder = f"{self.path}/data/{state + 1:06d}-{uuid.uuid4().hex}"
        tables = dict(content.get("tables", {})) if carry else {}
        for name in names:
            frame = frames[name]
            frame = frame() if callable(frame) else frame
            frame = conform(frame, name) if typed and name in TABLES else frame
            frame.write.parquet(f"{folder}/{name}")
            tables[name] = {"path": f"{folder}/{name}", "schema": frame.schema.json()}
        self.manifest.commit(state + 1, {"tables": tables})
        return state + 1

    def names(self, version: int | None = None) -> list[str]:
        return sorted(self._content(version).get("tables", {}))

    def _content(self, version: int | None) -> dict:
        return self.manifest.latest()[1] if version is None else self.manifest.read(version)

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of one version, the current one by default."""
        return {
            name: self.spark.read.schema(T.StructType.fromJson(json.loads(table["schema"]))).parquet(table["path"])
            for name, table in self._content(version).get("tables", {}).items()
        }

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the files of tables that none of the last ``keep`` versions names."""
        numbers = self.manifest.numbers()
        paths = {n: {t["path"] for t in self.manifest.read(n).get("tables", {}).values()} for n in numbers}
        live = set().union(*[paths[n] for n in numbers[len(numbers) - keep:]]) if numbers else set()
        gone = sorted(set().union(*paths.values()) - live) if numbers else []
        for path in gone:
            self.manifest.remove(path)
        return gone
