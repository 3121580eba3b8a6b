"""Column-level operators: rename, pick, add, default, clean."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from recordwell.functions.text import clean_text


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, str]) -> DataFrame:
    """Trim header names, map synonyms to one name, and keep the first column per name."""
    targets = [synonyms.get(c.strip(), c.strip()) for c in df.columns]
    positional = df.toDF(*[f"c{i}" for i in range(len(targets))])
    first: dict[str, int] = {}
    for i, name in enumerate(targets):
        first.setdefault(name, i)
    return positional.select(*[F.col(f"c{i}").alias(name) for name, i in first.items()])


def resolve_column(df: DataFrame, words: Sequence[str], target: str) -> DataFrame:
    """Rename to ``target`` the first column whose name contains one of ``words``, else the first."""
    hits = [c for c in df.columns if any(w in c.lower() for w in words)]
    chosen = (hits or df.columns)[0]
    if chosen == target:
        return df
    return df.select(*[
        F.col(f"`{c}`").alias(target if c == chosen else c)
        for c in df.columns if c == chosen or c != target
    ])


def ensure_columns(df: DataFrame, wanted: Mapping[str, T.DataType | str] | Sequence[str]) -> DataFrame:
    """Add the absent columns as nulls (text unless a type is given)."""
    types = wanted if isinstance(wanted, Mapping) else {c: "string" for c in wanted}
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def select_allowed(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """The allowed columns that exist, in the allowed order; none at all is an error."""
    kept = [c for c in allowed if c in df.columns]
    if not kept:
        raise ValueError(f"none of {list(allowed)} in {df.columns}")
    return df.select(*kept)


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Provenance and other constant columns; a bare ``None`` is a null text."""
    return df.withColumns({
        c: F.lit(v) if v is not None else F.lit(None).cast("string") for c, v in constants.items()
    })


def map_text_columns(df: DataFrame, rule: Callable[[str], Column] = clean_text,
                     skip: Sequence[str] = ()) -> DataFrame:
    """Apply one rule to every text column, in one projection."""
    return df.select(*[
        rule(f.name).alias(f.name)
        if isinstance(f.dataType, T.StringType) and f.name not in skip else F.col(f.name)
        for f in df.schema.fields
    ])


def clean_columns(df: DataFrame, columns: Sequence[str], rule: Callable[[str], Column] = clean_text) -> DataFrame:
    """Apply one rule to the named columns that exist."""
    present = {c: rule(c) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def fill_defaults(df: DataFrame, defaults: Mapping[str, object],
                  absent: Mapping[str, object] | None = None) -> DataFrame:
    """Defaults for null cells, and other defaults for columns that are absent altogether."""
    absent = absent or {}
    missing = {c: F.lit(v) for c, v in absent.items() if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    present = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    return df.withColumns(present) if present else df


def completeness(columns: Sequence[str]) -> Column:
    """How many of the columns hold a value."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def advance_status(status: str = "validation_status", known: str = "city",
                   done: str = "VALID") -> Column:
    """Row status after validation: done once the known column has a value."""
    return F.when(F.col(known).isNotNull(), F.lit(done)).otherwise(F.col(status))


def when_pending(new: Column, column: str, status: str = "validation_status") -> Column:
    """The new value on pending rows, the old one elsewhere."""
    return F.when(F.col(status) == "PENDING", new).otherwise(F.col(column))
