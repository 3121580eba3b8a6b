"""Deletes over the whole graph of foreign keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from recordwell.session import cut_lineage

#: (child, child column, parent, what deleting the parent does: ``cascade`` or ``set null``)
Reference = tuple[str, str, str, str]


def groups_in_order(tables: Sequence[str], references: Sequence[Reference]) -> list[list[str]]:
    """The tables in groups, parents first; tables that refer to each other in a circle share a group."""
    parents = {t: [p for c, _, p, _ in references if c == t and p in tables] for t in tables}
    order, index, low, stack, out = {}, 0, {}, [], []

    def visit(table: str) -> None:
        nonlocal index
        order[table] = low[table] = index
        index += 1
        stack.append(table)
        for parent in parents[table]:
            if parent not in order:
                visit(parent)
                low[table] = min(low[table], low[parent])
            elif parent in stack:
                low[table] = min(low[table], order[parent])
        if low[table] == order[table]:
            at = stack.index(table)
            out.append(sorted(stack[at:], key=order.get))
            del stack[at:]

    for table in tables:
        if table not in order:
            visit(table)
    return out


def _named(ids: DataFrame) -> DataFrame:
    return ids.select(F.col(ids.columns[0]).alias("_id"))


def _referring(rows: DataFrame, fk: str, gone: DataFrame) -> DataFrame:
    """Rows whose reference names a deleted parent."""
    return rows.join(gone.select(F.col("_id").alias("_gone")), F.col(fk) == F.col("_gone"), "left_semi")


def delete_rows(tables: Mapping[str, DataFrame], references: Sequence[Reference], deleted: Mapping[str, DataFrame],
                key: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """All tables after deleting rows of some, with everything that follows from it.

    ``deleted`` gives frames of ids by table; ``key`` names the id column of a table (default ``id``). Tables are taken parents first,
    so each is read once and knows all deletes above it: a row goes if it is named, or if a ``cascade`` reference of
    it names a row that goes; of the rows that stay, a ``set null`` reference to a row that goes becomes null. Inside a
    circle of references the deletes are followed round by round until none is new. References to rows that never existed
    and null references change nothing. A hot parent costs one row of the broadcast or a split partition, never a group.
    """
    key = key or {}
    for child, _, parent, action in references:
        if action not in ("cascade", "set null"):
            raise ValueError(f"unknown action {action!r} from {child} to {parent}")
    parents = {p for c, _, p, _ in references if c in tables}
    gone: dict[str, DataFrame] = {}
    out: dict[str, DataFrame] = {}
    for group in groups_in_order(list(tables), references):
        cascades = {t: [(fk, p) for c, fk, p, action in references if c == t and action == "cascade"] for t in group}
        circle = [(t, fk, p) for t in group for fk, p in cascades[t] if p in group]
        for table in group:
            if table not in parents and not circle:
                continue  # nobody asks which of its rows went
            own = F.col(key.get(table, "id"))
            parts = [_named(deleted[table])] if table in deleted else []
            parts += [_referring(tables[table], fk, gone[p]).select(own.alias("_id")) for fk, p in cascades[table] if p in gone and p not in group]
            if parts:
                gone[table] = cut_lineage(reduce(DataFrame.unionByName, parts).filter(F.col("_id").isNotNull()).distinct())
        if circle:
            _follow(tables, circle, gone, key)
        for table in group:
            out[table] = _survivors(tables[table], table, references, gone, deleted, key.get(table, "id"))
    return out


def _follow(tables: Mapping[str, DataFrame], circle: Sequence[tuple[str, str, str]], gone: dict[str, DataFrame], key: Mapping[str, str]) -> None:
    """Carries deletes round a circle of references; each round looks only from the rows that the last one found."""
    fresh = {t: gone[t] for t in {t for t, _, _ in circle} | {p for _, _, p in circle} if t in gone}
    while fresh:
        found: dict[str, list[DataFrame]] = {}
        for table, fk, parent in circle:
            if parent in fresh:
                ids = _referring(tables[table], fk, fresh[parent]).select(F.col(key.get(table, "id")).alias("_id"))
                found.setdefault(table, []).append(ids.filter(F.col("_id").isNotNull()))
        fresh = {}
        for table, parts in found.items():
            new = reduce(DataFrame.unionByName, parts).distinct()
            if table in gone:
                new = new.join(gone[table], "_id", "left_anti")
            new = cut_lineage(new)
            if not new.isEmpty():
                fresh[table] = new
                gone[table] = cut_lineage(gone[table].unionByName(new)) if table in gone else new


def _survivors(rows: DataFrame, table: str, references: Sequence[Reference], gone: Mapping[str, DataFrame],
               deleted: Mapping[str, DataFrame], key: str) -> DataFrame:
    """The rows of a table that stay, their lost references set to null."""
    columns = rows.columns
    if table in deleted:
        rows = rows.join(_named(deleted[table]), F.col(key) == F.col("_id"), "left_anti")
    for child, fk, parent, action in references:
        if child != table or parent not in gone:
            continue
        lost = gone[parent].select(F.col("_id").alias("_lost"))
        if action == "set null":
            rows = rows.join(lost, F.col(fk) == F.col("_lost"), "left").select(
                *[F.when(F.col("_lost").isNull(), F.col(c)).alias(c) if c == fk else F.col(c) for c in columns])
        else:
            rows = rows.join(lost, F.col(fk) == F.col("_lost"), "left_anti")
    return rows
