"""Scalar text rules as native column expressions.

Every function takes a column (name or Column) and returns a Column; nothing here
leaves the JVM, so whole chains of rules run inside one projection.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Words that stand for "no value" in cleaned text.
NULL_WORDS = ("nan", "none", "null")

# Cell texts a delimited-file reader takes as missing (pandas defaults).
READER_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Fixed value: what Python calls white space, as a Java regex.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# Administrative suffixes cut from place names.
PLACE_SUFFIXES = ("(Mun.)", "(Arrond.)")

# Names that replace any longer text they begin.
CANONICAL_PREFIXES = (
    "Témara", "Ait Ouqabli", "Targuist", "Ksar-el-Kebir", "Imouzzer Marmoucha", "Bni Karrich",
)

# Cities looked for inside an address, in order, with their spelling.
ADDRESS_CITIES = (
    ("CASABLANCA", "Casablanca"),
    ("RABAT", "Rabat"),
    ("FES", "Fès"),
    ("TANGER", "Tanger"),
)

# Fixed value: accepted e-mail form.
EMAIL_PATTERN = r"(?i)^[A-Z0-9._%-]+@[A-Z0-9.-]+\.[A-Z]{2,4}$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: ColumnOrName, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it.

    Without it a chain of rules that each mention their input several times grows
    exponentially when the optimizer inlines it.
    """
    return F.get(F.transform(F.array(_col(c)), lambda value: body(value)), F.lit(0))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to) for ``translate``: accented Latin letters to their base letter.

    Derived from Unicode canonical decomposition; combining marks map to nothing.
    """
    source, target = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            source.append(chr(code))
            target.append(base)
    marks = "".join(chr(code) for code in range(0x300, 0x370))
    return "".join(source) + marks, "".join(target)


def strip_accents(c: ColumnOrName) -> Column:
    source, target = accent_table()
    return F.translate(_col(c), source, target)


def fold(c: ColumnOrName) -> Column:
    """Comparison key that ignores case and accents, like the usual SQL collations."""
    return F.lower(strip_accents(c))


def squeeze(c: ColumnOrName) -> Column:
    """Collapse every run of (Unicode) white space to one space and trim the ends."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE, " "))


def clean_text(c: ColumnOrName) -> Column:
    """Squeezed text; blank and null words (any case) become null."""
    def rule(text: Column) -> Column:
        return F.when((text != "") & ~F.lower(text).isin(*NULL_WORDS), text)

    return let(squeeze(c), rule)


def is_null_token(c: ColumnOrName) -> Column:
    """True for null, blank, ``nan`` and ``none`` in any case (a key that names nothing)."""
    text = F.lower(squeeze(c))
    return F.coalesce(text.isin("nan", "none", ""), F.lit(True))


def nullify(c: ColumnOrName, tokens: Iterable[str] = ("NULL", "")) -> Column:
    """Texts that spell a missing value become null."""
    value = _col(c)
    return F.when(value.isin(*tokens), F.lit(None)).otherwise(value)


def upper_trim(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_col(c)))


def lower_trim(c: ColumnOrName) -> Column:
    return F.lower(F.trim(_col(c)))


def strip_suffixes(c: ColumnOrName, suffixes: Sequence[str] = PLACE_SUFFIXES) -> Column:
    """Remove literal suffixes wherever they stand, then trim."""
    value = _col(c)
    for suffix in suffixes:
        value = F.replace(value, F.lit(suffix), F.lit(""))
    return F.trim(value)


def canonical_prefix(c: ColumnOrName, names: Sequence[str] = CANONICAL_PREFIXES) -> Column:
    """A text that begins with a known name (case and accents apart) becomes that name."""
    if not names:
        return _col(c)

    def rule(key: Column) -> Column:
        out = None
        for name in names:
            hit = key.startswith(fold(F.lit(name)))
            out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
        return out

    return F.coalesce(let(fold(c), rule), _col(c))


def is_address_like(c: ColumnOrName, street: str = "RUE") -> Column:
    """Starts with a digit or mentions a street."""
    return _col(c).rlike("^[0-9]+") | fold(c).contains(street.lower())


def address_to_city(
    c: ColumnOrName,
    cities: Sequence[tuple[str, str]] = ADDRESS_CITIES,
    street: str = "RUE",
    street_city: tuple[str, str] | None = ("FES", "Fès"),
) -> Column:
    """Replace an address by the first listed city it mentions; other text is kept.

    ``street_city`` is the rule tried before the ordered list: a street in that city.
    """
    def rule(key: Column) -> Column:
        in_street = key.contains(street.lower())
        picked = F.when(F.lit(False), F.lit(None).cast("string"))
        if street_city:
            token, name = street_city
            picked = picked.when(in_street & key.contains(token.lower()), F.lit(name))
        address = in_street | key.rlike("^[0-9]+")
        for token, name in cities:
            picked = picked.when(address & key.contains(token.lower()), F.lit(name))
        return picked

    return F.coalesce(let(fold(c), rule), _col(c))


def sentence_case(c: ColumnOrName) -> Column:
    """First character upper, the rest lower (unlike ``initcap``, which does each word)."""
    value = _col(c)
    return F.concat(F.upper(F.substring(value, 1, 1)), F.lower(value.substr(F.lit(2), F.length(value))))


def ascii_name(c: ColumnOrName, mode: str = "ascii") -> Column:
    """Upper-case name of ASCII letters, digits and spaces.

    ``ascii`` drops every other character (so ``Fès`` becomes ``FS``); ``fold`` takes
    accents off first and cuts the administrative suffixes.
    """
    value = _col(c)
    if mode == "fold":
        value = strip_accents(strip_suffixes(value))
        return F.upper(F.trim(F.regexp_replace(F.regexp_replace(value, "[^a-zA-Z0-9 -]", ""), "[ -]+", " ")))
    if mode != "ascii":
        raise ValueError(f"unknown mode {mode!r}")
    return F.upper(F.trim(F.regexp_replace(value, "[^a-zA-Z0-9 ]", "")))


def spaceless(c: ColumnOrName) -> Column:
    """Join key without spaces and hyphens."""
    return F.translate(_col(c), " -", "")


def ingredient_separator(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), r"\s*//\s*", " + ")


def split_units(c: ColumnOrName) -> Column:
    """A space between a digit and the letter after it: ``500MG`` to ``500 MG``."""
    return F.regexp_replace(_col(c), "([0-9])([a-zA-Z])", "$1 $2")


def decimal_point(c: ColumnOrName) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit("."))


def clean_address(c: ColumnOrName, whole_word: bool = False) -> Column:
    """Upper-case address without country name and five-digit postcodes.

    The plain rule also cuts `` MAROC`` out of `` MAROCAINE``; ``whole_word`` does not.
    """
    value = upper_trim(c)
    if whole_word:
        value = F.trim(F.regexp_replace(value, r" MAROC\b", ""))
    else:
        value = F.trim(F.replace(value, F.lit(" MAROC"), F.lit("")))
    value = F.trim(F.replace(value, F.lit(", MOROCCO"), F.lit("")))
    return F.regexp_replace(value, "[0-9]{5} ", "")


def international_phone(
    c: ColumnOrName, local: Sequence[str] = ("05", "06"), country: str = "212"
) -> Column:
    """Digits and ``+`` only; local prefixes and a bare country code get ``+country``."""
    def rule(digits: Column) -> Column:
        local_hit = F.lit(False)
        for prefix in local:
            local_hit = local_hit | digits.startswith(prefix)
        rest = digits.substr(F.lit(2), F.length(digits))
        return (
            F.when(digits == "", F.lit(None))
            .when(local_hit, F.concat(F.lit("+" + country), rest))
            .when(digits.startswith(country), F.concat(F.lit("+"), digits))
            .otherwise(digits)
        )

    return let(F.regexp_replace(_col(c), "[^0-9+]", ""), rule)


def split_phones(c: ColumnOrName, **rule) -> Column:
    """Array of the ten-digit numbers in a field that holds several, each international."""
    found = F.regexp_extract_all(_col(c), F.lit(r"(0[0-9](?:[ .]?[0-9]{2}){4})"), F.lit(1))
    return F.transform(found, lambda number: international_phone(number, **rule))


def email_invalid(c: ColumnOrName, max_tld: int = 4) -> Column:
    """A present e-mail that does not have the accepted form."""
    value = _col(c)
    return value.isNotNull() & ~value.rlike(EMAIL_PATTERN.replace("{2,4}", f"{{2,{max_tld}}}"))


def valid_phone(c: ColumnOrName) -> Column:
    value = _col(c)
    return F.when((value == "") | value.startswith("+212") | value.startswith("0"), value)


def valid_email(c: ColumnOrName) -> Column:
    value = _col(c)
    return F.when((value == "") | (value.contains("@") & value.contains(".")), value)


def valid_website(c: ColumnOrName) -> Column:
    """Keep http(s) addresses, complete bare ``www.`` ones, drop the rest."""
    value = _col(c)
    return F.when(
        (value == "") | value.startswith("http://") | value.startswith("https://"), value
    ).when(value.startswith("www."), F.concat(F.lit("https://"), value))


def valid_beds(c: ColumnOrName, low: int = 0, high: int = 10_000) -> Column:
    """Whole number in range, else null; ``12.0`` is 12."""
    number = _col(c).try_cast("double")
    return F.when(number.between(low, high) & (number == F.floor(number)), number.try_cast("int"))


def to_number(c: ColumnOrName, kind: str = "double") -> Column:
    """Number, or null where the text is none."""
    return F.trim(_col(c).cast("string")).try_cast(kind)


def to_price(c: ColumnOrName) -> Column:
    """``3630,00`` or ``3630.00`` as DECIMAL(10,2); text without a number becomes null."""
    return decimal_point(nullify(F.trim(_col(c).cast("string")))).try_cast("decimal(10,2)")


def first_nonblank(*cs: ColumnOrName) -> Column:
    """First column that is neither null nor the empty text."""
    return F.coalesce(*[F.when(_col(c) != "", _col(c)) for c in cs])


def facility_tier(
    c: ColumnOrName,
    tiers: Mapping[str, Sequence[str]] | None = None,
    default: str = "local",
) -> Column:
    """Size class of a facility read off its type text."""
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    out = None
    for tier, words in (tiers or TIER_WORDS).items():
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        out = F.when(hit, F.lit(tier)) if out is None else out.when(hit, F.lit(tier))
    return out.otherwise(F.lit(default))


# Words that place a facility type in a size class, first class wins.
TIER_WORDS = {
    "major": ("chu", "universitaire", "régional"),
    "clinic": ("clinique", "polyclinique"),
}

# Per size class, least and most services, equipment items and beds.
TIER_RANGES = {
    "major": {"services": (10, 20), "equipment": (15, 50), "beds": (300, 800)},
    "clinic": {"services": (5, 12), "equipment": (5, 20), "beds": (30, 150)},
    "local": {"services": (1, 5), "equipment": (1, 5), "beds": (10, 60)},
}


def tier_bound(tier: ColumnOrName, measure: str, which: str) -> Column:
    """Lower or upper bound of a measure for a size class."""
    side = 0 if which == "low" else 1
    out = None
    for name, ranges in TIER_RANGES.items():
        bound = F.lit(ranges[measure][side])
        out = F.when(_col(tier) == name, bound) if out is None else out.when(_col(tier) == name, bound)
    return out
