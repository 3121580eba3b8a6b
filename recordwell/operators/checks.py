"""Quality checks: rules, duplicates, references, counts. Each returns a small report or the bad rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from recordwell.functions.text import email_invalid, fold
from recordwell.sources.schemas import Constraints


def any_missing(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def noise(name: str, min_length: int = 5, code: str | None = r"^[A-Z]{2}\d+$",
          blacklist: Sequence[str] = ()) -> Column:
    """Name too short, a bare code, or blacklisted."""
    bad = F.length(name) < min_length
    if code:
        bad = bad | F.col(name).rlike(code)
    if blacklist:
        bad = bad | F.col(name).isin(*blacklist)
    return F.coalesce(bad, F.lit(False))


def junk_place(name: str, street: str = "RUE ") -> Column:
    """An address in place of a name: starts with a digit or with the street word."""
    return F.coalesce(
        F.col(name).rlike("^[0-9]+") | fold(name).startswith(street.lower()), F.lit(False)
    )


def price_inversion(df: DataFrame, low: str = "price_hospital", high: str = "price_public") -> DataFrame:
    """Rows whose usually lower price is the higher one."""
    return df.filter(F.col(low) > F.col(high))


def dosage_mismatch(df: DataFrame, substance: str = "active_substance", dosage: str = "dosage",
                    columns: Sequence[str] = ("name", "active_substance", "dosage")) -> DataFrame:
    """Several ingredients but one dosage."""
    one = ~F.col(dosage).contains("/") & ~F.col(dosage).contains("+")
    return df.filter(F.col(substance).contains("+") & one).select(*columns)


def unreachable(df: DataFrame, contacts: Sequence[str] = ("phone", "email")) -> DataFrame:
    """Rows without any contact."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNull() for c in contacts]))


def bad_emails(df: DataFrame, columns: Sequence[str] = ("id", "name", "email"),
               email: str = "email", max_tld: int = 4) -> DataFrame:
    return df.filter(email_invalid(email, max_tld)).select(*columns)


def still_missing(df: DataFrame, column: str = "region") -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicate_report(df: DataFrame, keys: Sequence[str], count: str = "duplicate_count") -> DataFrame:
    """Keys held by more than one row; counted map-side, so hot keys cost nothing extra."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def frequency(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    """Values by falling frequency, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias(count)).orderBy(F.desc(count), column)


def dirty_count(df: DataFrame, columns: Sequence[str] = ("region",), name: str = "dirty_rows") -> DataFrame:
    """How many rows lack one of the columns."""
    return df.agg(F.count_if(any_missing(columns)).alias(name))


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, with a warning for empty ones."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows",
            F.when(F.col("rows") > 0, F.lit("ok")).otherwise(F.lit("warn")).alias("status"),
        )
        for name, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference names no parent; a null reference is allowed."""
    known = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("_pk"), "left_anti")


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The dangling references and how many rows hold each; references are counted before the join."""
    held = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(pk).alias("_pk"))
    return held.join(known, held[fk] == known["_pk"], "left_anti")


def set_null_on_delete(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """What deleting parents does to children that may lose their reference."""
    known = parent.select(F.col(pk).alias("_pk"))
    joined = child.join(known, child[fk] == known["_pk"], "left")
    return joined.select(*[F.col("_pk").alias(c) if c == fk else child[c] for c in child.columns])


def cascade_on_delete(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """What deleting parents does to children that go with them."""
    known = parent.select(F.col(pk).alias("_pk"))
    return child.join(known, child[fk] == known["_pk"], "left_semi")


def constraint_violations(df: DataFrame, rules: Constraints, id_col: str) -> DataFrame:
    """One row per (id, broken rule): missing values, texts too long, decimals out of range.

    All rules are tested in one pass.
    """
    tests = [F.when(F.col(c).isNull(), F.lit(f"{c}: not null")) for c in rules.not_null if c in df.columns]
    tests += [
        F.when(F.length(c) > n, F.lit(f"{c}: length <= {n}"))
        for c, n in rules.max_length.items() if c in df.columns
    ]
    tests += [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull(),
               F.lit(f"{c}: decimal({p},{s})"))
        for c, (p, s) in rules.decimals.items() if c in df.columns
    ]
    return df.select(id_col, F.explode(F.array_compact(F.array(*tests))).alias("rule"))


def _paired(before: DataFrame, after: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Rows of ``before`` next to the row of ``after`` with their id, if there is one."""
    old = before.select(F.col(id_col), *[F.col(f).alias(f"_old_{f}") for f in fields])
    new = after.select(F.col(id_col).alias("_new_id"), *[F.col(f).alias(f"_new_{f}") for f in fields])
    return old.join(new, old[id_col] == new["_new_id"], "left")


def _change_counts(fields: Sequence[str]) -> list[Column]:
    """Counts over paired rows: found, deleted, updated, and filled per field."""
    kept = F.col("_new_id").isNotNull()
    changed = reduce(
        lambda a, b: a | b,
        [~F.col(f"_old_{f}").eqNullSafe(F.col(f"_new_{f}")) for f in fields],
    )
    return [
        F.count("*").alias("rows_before"),
        F.count_if(~kept).alias("rows_deleted"),
        F.count_if(kept & changed).alias("rows_updated"),
        *[
            F.count_if(kept & F.col(f"_old_{f}").isNull() & F.col(f"_new_{f}").isNotNull()).alias(f"{f}_found")
            for f in fields
        ],
    ]


def change_statistics(before: DataFrame, after: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Rows found, deleted, updated and filled per field between two states, in one aggregate."""
    return _paired(before, after, id_col, fields).agg(*_change_counts(fields))


def write_changes(before: DataFrame, after: DataFrame, id_col: str, fields: Sequence[str], path: str) -> dict[str, int]:
    """Write ``after`` (id and fields) as Parquet and return the counts of ``change_statistics``, taken by the write itself.

    The counts are observed in the tasks that write, after the last shuffle: Spark takes one result per written
    partition, so tasks that are repeated do not count twice. Ids are unique in both states; a row that ``before``
    does not know is not written.
    """
    seen = Observation("changes")
    # deleted rows are counted first and then left out, without another shuffle
    observed = _paired(before, after, id_col, fields).observe(seen, *_change_counts(fields))
    kept = observed.filter(F.col("_new_id").isNotNull())
    kept.select(F.col("_new_id").alias(id_col), *[F.col(f"_new_{f}").alias(f) for f in fields]).write.mode("overwrite").parquet(path)
    return seen.get
