"""Phonetic and similarity measures as native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.text import ColumnOrName, _col, let

# Fixed value: Soundex digit of each letter A..Z ("0" for the letters that carry none).
SOUNDEX_DIGITS = "01230120022455012623010202"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_WORD = 60  # bits per machine word in the common-subsequence count, clear of the sign


def soundex_long(c: ColumnOrName) -> Column:
    """Soundex of any length: vowels go first, then repeats; at least four characters.

    Unlike the built-in ``soundex`` the code is not cut at four, so long names that
    merely start alike stay apart.
    """
    def code(letters: Column) -> Column:
        digits = F.translate(letters, LETTERS, SOUNDEX_DIGITS)
        runs = F.regexp_replace(F.translate(digits, "0", ""), r"([1-6])\1+", "$1")
        # the first letter stands for itself, so its own digit goes
        tail = F.regexp_replace(F.concat(F.substring(digits, 1, 1), F.lit(":"), runs), r"^(?:0?:|([1-6]):\1)", "")
        return F.concat(F.substring(letters, 1, 1), tail)

    def padded(text: Column) -> Column:
        return F.when((text == "") | (F.length(text) >= 4), text).otherwise(F.rpad(text, 4, "0"))

    return let(let(F.regexp_replace(F.upper(_col(c)), "[^A-Z]", ""), code), padded)


def _mask(letters: Column, letter: Column) -> Column:
    """Bit i set where the i-th of ``letters`` is ``letter``."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(letters) - 1),
        F.lit(0).cast("bigint"),
        lambda acc, i: F.when(
            F.get(letters, i) == letter, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
        ).otherwise(acc),
    )


def lcs_length(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Length of the longest common subsequence of two texts, any length.

    Bit-parallel row update on 60-bit words with carry: |a|/60 * |b| word steps.
    """
    a, b = _col(a), _col(b)
    n = F.length(a)

    def ones(word: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.size(word)) - 1

    def cut(letters: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(letters) - 1) / _WORD).cast("int")),
            lambda k: F.slice(letters, k * _WORD + 1, F.lit(_WORD)),
        )

    def word_step(letter: Column, acc: Column, pair: Column) -> Column:
        value, word = pair["v"], pair["w"]

        def step(kept: Column) -> Column:
            total = value + kept + acc["carry"]
            merged = total.bitwiseAND(ones(word)).bitwiseOR(value - kept)
            return F.struct(
                F.shiftright(total, _WORD).alias("carry"),
                F.concat(acc["vs"], F.array(merged)).alias("vs"),
            )

        return let(value.bitwiseAND(_mask(word, letter)), step)

    def rows(words: Column) -> Column:
        start = F.struct(
            F.lit(0).cast("bigint").alias("carry"),
            F.array().cast("array<bigint>").alias("vs"),
        )

        def advance(state: Column, letter: Column) -> Column:
            pairs = F.zip_with(state, words, lambda v, w: F.struct(v.alias("v"), w.alias("w")))
            return F.aggregate(pairs, start, lambda acc, pair: word_step(letter, acc, pair))["vs"]

        return F.aggregate(F.split(b, ""), F.transform(words, ones), advance)

    final = let(let(F.split(a, ""), cut), rows)
    unset = n - F.aggregate(
        F.transform(final, lambda v: F.bit_count(v)), F.lit(0), lambda acc, v: acc + v
    )
    return F.when((n == 0) | (F.length(b) == 0), F.lit(0)).otherwise(unset)


def _similarity(total: Column, apart: Column) -> Column:
    """Similarity 0..100 (rounded half to even) of texts of summed length ``total``, ``apart`` insertions and deletions away."""
    return F.bround(F.lit(100.0) * (total - apart) / total).cast("int")


def indel_similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Similarity 0..100: twice the longest common subsequence over both lengths."""
    a, b = _col(a), _col(b)
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100)).otherwise(_similarity(total, total - lcs_length(a, b) * 2))


def least_ratio(threshold: int) -> float:
    """Smallest real similarity that rounds to more than ``threshold``."""
    return (threshold + 0.5) / 100.0


def edit_budget(a: ColumnOrName, b: ColumnOrName, threshold: int) -> Column:
    """Most insertions plus deletions two texts of these lengths may be apart."""
    total = F.length(_col(a)) + F.length(_col(b))
    return F.floor(total * (1.0 - least_ratio(threshold)) + 1e-9).cast("int")


def similar_by_bounds(a: ColumnOrName, b: ColumnOrName, threshold: int = 85) -> Column:
    """``indel_similarity > threshold`` as far as edit distance can tell, else null.

    With e edits (the built-in ``levenshtein``) and a length difference of d, the
    insert/delete distance lies between e, rounded up to the parity of the summed
    length, and 2e - d.
    """
    a, b = _col(a), _col(b)
    measured = F.struct(
        F.call_function("levenshtein", a, b, edit_budget(a, b, threshold)).alias("edits"),
        (F.length(a) + F.length(b)).alias("total"),
        F.abs(F.length(a) - F.length(b)).alias("gap"),
    )

    def verdict(m: Column) -> Column:
        most = m["edits"] * 2 - m["gap"]
        least = m["edits"] + F.pmod(m["edits"] + m["total"], F.lit(2))
        return (
            F.when(m["total"] == 0, F.lit(True))
            .when(m["edits"] < 0, F.lit(False))
            .when(_similarity(m["total"], most) > threshold, F.lit(True))
            .when(_similarity(m["total"], least) <= threshold, F.lit(False))
        )

    return let(measured, verdict)


def lcs_batches() -> Callable[[Column, Column], Column]:
    """``lcs_length`` in Arrow batches: many times faster than the expression on many pairs.

    Null where either text is null. Made inside a function, so that tasks need not
    import this package to run it.
    """
    import pandas as pd

    def length(a: str, b: str) -> int:
        places: dict[str, int] = {}
        for i, letter in enumerate(a):
            places[letter] = places.get(letter, 0) | 1 << i
        full = (1 << len(a)) - 1
        row = full
        for letter in b:
            kept = row & places.get(letter, 0)
            row = ((row + kept) | (row - kept)) & full
        return len(a) - row.bit_count()

    def batch(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else length(x, y) for x, y in zip(a, b)], dtype="Int32")

    batch.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "int")


def keep_similar(pairs: DataFrame, a: str, b: str, threshold: int = 85) -> DataFrame:
    """The pairs whose similarity exceeds ``threshold``.

    Bounds settle most pairs inside the JVM; only undecided texts are handed to the
    batched common-subsequence count.
    """
    def unless_refuted(sure: Column) -> Column:
        return F.when(F.coalesce(sure, F.lit(True)), F.array(sure))

    # exploding the verdict computes it once; as a filter it would be computed again for the next step
    judged = pairs.select("*", F.explode(let(similar_by_bounds(a, b, threshold), unless_refuted)).alias("_sure"))
    open_ = F.col("_sure").isNull()
    total = F.length(a) + F.length(b)
    counted = judged.withColumn("_lcs", lcs_batches()(F.when(open_, F.col(a)), F.when(open_, F.col(b))))
    good = F.coalesce(F.col("_sure"), _similarity(total, total - F.col("_lcs") * 2) > threshold)
    return counted.filter(good).drop("_sure", "_lcs")
