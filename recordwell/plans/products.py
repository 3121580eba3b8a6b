"""Medication and hospital tables: standard forms and rule checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from recordwell.functions.text import (
    clean_address, decimal_point, ingredient_separator, international_phone, lower_trim, nullify,
    split_units, to_price, upper_trim,
)
from recordwell.operators import checks

UPPER_MEDICATION = ("name", "active_substance", "form", "presentation", "therapeutic_class", "manufacturer")


def standardise_medications(df: DataFrame) -> DataFrame:
    """Upper-case texts, ``+`` between ingredients, spaced and pointed dosages, numeric prices."""
    rules = {c: upper_trim(c) for c in UPPER_MEDICATION}
    rules["active_substance"] = ingredient_separator(upper_trim("active_substance"))
    rules["commercialization_status"] = F.trim("commercialization_status")
    rules["dosage"] = decimal_point(split_units("dosage"))
    for c in ("price_public", "price_hospital"):
        if isinstance(df.schema[c].dataType, T.StringType):
            rules[c] = to_price(c)
    return df.withColumns(rules)


def medication_checks(df: DataFrame) -> dict[str, DataFrame]:
    """The four reports on a standardised medication table."""
    return {
        "price_inversion": checks.price_inversion(df),
        "duplicates": checks.duplicate_report(df, ["name", "dosage", "form"]),
        "dosage_mismatch": checks.dosage_mismatch(df),
        "missing_name": df.filter(F.col("name").isNull()),
    }


def standardise_hospitals(df: DataFrame) -> DataFrame:
    """Standard case, clean addresses, international phones, null words and zero beds to null."""
    return df.withColumns({
        "name": upper_trim("name"),
        "address": clean_address("address"),
        "type": upper_trim("type"),
        "email": nullify(F.regexp_replace(lower_trim("email"), "^null$", "")),
        "website": nullify(F.regexp_replace(lower_trim("website"), "^null$", "")),
        "phone": international_phone("phone"),
        "beds": F.nullif(F.col("beds"), F.lit(0)),
    })


def hospital_checks(df: DataFrame) -> dict[str, DataFrame]:
    """The four reports on a standardised hospital table."""
    return {
        "duplicates": checks.duplicate_report(df, ["name", "place_id"]),
        "type_frequency": checks.frequency(df, "type"),
        "unreachable": checks.unreachable(df),
        "bad_emails": checks.bad_emails(df),
    }
