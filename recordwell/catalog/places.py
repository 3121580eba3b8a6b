"""Queries on place tables: staged cleaning and the repair chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwell.catalog.registry import LETTER_RUN, PLACES, STAGED, fold_sql, query, table
from recordwell.functions import match, text
from recordwell.functions.match import LETTERS, SOUNDEX_DIGITS
from recordwell.operators.columns import when_pending
from recordwell.operators.contain import drop_containers
from recordwell.operators.edits import edit_distance_pairs, typo_match
from recordwell.operators.fill import self_fill
from recordwell.operators.keys import smart_dedup
from recordwell.plans import places as plan
from recordwell.session import cut_lineage

# ---------------------------------------------------------------- statements

_STRIP = "trim(replace(replace(city, '(Mun.)', ''), '(Arrond.)', ''))"
_CANON = "CASE " + " ".join(
    f"WHEN starts_with({fold_sql('city')}, {fold_sql(repr(n))}) THEN '{n}'" for n in text.CANONICAL_PREFIXES
) + " ELSE city END"
_ADDRESS = (
    f"CASE WHEN contains({fold_sql('city')}, 'rue') AND contains({fold_sql('city')}, 'fes') THEN 'Fès' "
    + " ".join(
        f"WHEN (regexp_matches(city, '^[0-9]+') OR contains({fold_sql('city')}, 'rue')) "
        f"AND contains({fold_sql('city')}, '{token.lower()}') THEN '{name}'"
        for token, name in text.ADDRESS_CITIES
    )
    + " ELSE city END"
)
_SENTENCE = "upper(city[1:1]) || lower(city[2:])"


def _pending(expression: str) -> str:
    return f"CASE WHEN validation_status = 'PENDING' THEN {expression} ELSE city END"


def _staged(*steps: str) -> str:
    """CTE chain s0..sn over the staged view, each step rewriting ``city``."""
    out = [f"s0 AS ({STAGED.sql})"]
    for i, step in enumerate(steps):
        out.append(f"s{i + 1} AS (SELECT raw_id, region, province, {step} AS city, validation_status FROM s{i})")
    return "WITH " + ", ".join(out)


_CLEAN = _staged(_pending(_STRIP), _CANON, _pending(_ADDRESS), _pending(_SENTENCE)) + (
    f", donors AS (SELECT {fold_sql('city')} AS k, arg_min(region, raw_id) AS r, "
    f"arg_min(coalesce(province, '\x01'), raw_id) AS p FROM s4 WHERE region IS NOT NULL AND city <> '' GROUP BY 1), "
    "filled AS (SELECT raw_id, "
    "CASE WHEN region IS NULL AND validation_status = 'PENDING' AND k IS NOT NULL THEN r ELSE region END AS region, "
    "CASE WHEN region IS NULL AND validation_status = 'PENDING' AND k IS NOT NULL THEN nullif(p, '\x01') ELSE province END AS province, "
    "city, CASE WHEN city IS NOT NULL THEN 'VALID' ELSE validation_status END AS validation_status "
    f"FROM s4 LEFT JOIN donors ON {fold_sql('city')} = k) "
)

_STANDARD = (
    f"p AS ({PLACES.sql}), "
    "n AS (SELECT id, upper(trim(regexp_replace(regexp_replace(strip_accents("
    "trim(replace(replace(city, '(Mun.)', ''), '(Arrond.)', ''))), '[^a-zA-Z0-9 -]', '', 'g'), '[ -]+', ' ', 'g'))) AS city, "
    "nullif(region, 'NULL') AS region, nullif(province, 'NULL') AS province FROM p), "
    "std AS (SELECT * FROM n WHERE NOT (regexp_matches(city, '^[0-9]+') OR starts_with(lower(city), 'rue ')))"
)

_DICTIONARY = "dict(entry, name_clean, region, province) AS (VALUES " + ", ".join(
    "({}, {})".format(i, ", ".join("'" + v.replace("'", "''") + "'" for v in row))
    for i, row in enumerate(plan.CITY_DICTIONARY)
) + ")"


def soundex_sql(c: str) -> str:
    letters = f"regexp_replace(upper({c}), '[^A-Z]', '', 'g')"
    digits = f"translate({letters}, '{LETTERS}', '{SOUNDEX_DIGITS}')"
    runs = f"replace({digits}, '0', '')"
    for d in "123456":
        runs = f"regexp_replace({runs}, '{d}+', '{d}', 'g')"
    code = f"left({letters}, 1) || CASE WHEN left({digits}, 1) = '0' THEN {runs} ELSE substr({runs}, 2) END"
    return f"CASE WHEN {letters} = '' THEN '' WHEN length({code}) < 4 THEN rpad({code}, 4, '0') ELSE {code} END"


def _match(source: str, target: str, key) -> str:
    return (
        f"{target}_d AS (SELECT {key('name_clean')} AS k, arg_min(name_clean, entry) AS c, arg_min(region, entry) AS r, "
        f"arg_min(province, entry) AS v FROM dict GROUP BY 1), "
        f"{target} AS (SELECT id, CASE WHEN region IS NULL AND k IS NOT NULL THEN c ELSE city END AS city, "
        f"CASE WHEN region IS NULL AND k IS NOT NULL THEN r ELSE region END AS region, "
        f"CASE WHEN region IS NULL AND k IS NOT NULL THEN v ELSE province END AS province "
        f"FROM {source} LEFT JOIN {target}_d ON {key('city')} = k AND k <> '')"
    )


def _spaceless_sql(c: str) -> str:
    return f"replace(replace({c}, ' ', ''), '-', '')"


def _typo(source: str, target: str, least: int) -> str:
    return (
        f"{target}_m AS (SELECT b.id, g.city, g.region, g.province FROM {source} b JOIN {source} g "
        f"ON b.region IS NULL AND g.region IS NOT NULL AND length(b.city) >= {least} AND length(g.city) >= {least} "
        "AND abs(length(b.city) - length(g.city)) <= 2 AND levenshtein(b.city, g.city) BETWEEN 1 AND 2 "
        "QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY levenshtein(b.city, g.city), g.id) = 1), "
        f"{target} AS (SELECT s.id, coalesce(m.city, s.city) AS city, CASE WHEN m.id IS NOT NULL THEN m.region ELSE s.region END AS region, "
        f"CASE WHEN m.id IS NOT NULL THEN m.province ELSE s.province END AS province FROM {source} s LEFT JOIN {target}_m m USING (id))"
    )


def _containers(source: str, target: str) -> str:
    return (
        f"{target} AS (SELECT * FROM {source} b WHERE NOT (b.region IS NULL AND EXISTS (SELECT 1 FROM "
        f"(SELECT DISTINCT city FROM {source} WHERE region IS NOT NULL AND city <> '') v "
        "WHERE contains(b.city, v.city) AND length(b.city) > length(v.city))))"
    )


_DEDUP = ("SELECT id, city, region, province FROM {0} QUALIFY city IS NULL OR "
          "row_number() OVER (PARTITION BY city ORDER BY region IS NULL, id) = 1")

# ---------------------------------------------------------------- staged cleaning


@query("strip_suffix", _staged(_pending(_STRIP)) + " SELECT raw_id, city FROM s1")
def _(spark, folder):
    return STAGED.frame(spark, folder).select("raw_id", when_pending(text.strip_suffixes("city"), "city").alias("city"))


@query("canonical_prefix", _staged(_CANON) + " SELECT raw_id, city FROM s1")
def _(spark, folder):
    return STAGED.frame(spark, folder).select("raw_id", text.canonical_prefix("city").alias("city"))


@query("address_to_city", _staged(_ADDRESS) + " SELECT raw_id, city FROM s1")
def _(spark, folder):
    return STAGED.frame(spark, folder).select("raw_id", text.address_to_city("city").alias("city"))


@query("sentence_case", f"SELECT conv_id, turn, upper(text[1:1]) || lower(text[2:]) AS text FROM conversations")
def _(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", text.sentence_case("text").alias("text"))


@query("self_fill", f"WITH s AS ({STAGED.sql}), d AS (SELECT {fold_sql('city')} AS k, arg_min(region, raw_id) AS r, "
       "arg_min(province, raw_id) AS p FROM s WHERE region IS NOT NULL AND city <> '' GROUP BY 1) "
       "SELECT raw_id, city, CASE WHEN region IS NULL AND k IS NOT NULL THEN r ELSE region END AS region, "
       f"CASE WHEN region IS NULL AND k IS NOT NULL THEN p ELSE province END AS province FROM s LEFT JOIN d ON {fold_sql('city')} = k")
def _(spark, folder):
    df = STAGED.frame(spark, folder).select("raw_id", "city", "region", "province")
    return self_fill(df, "city", ["region", "province"], "raw_id")


@query("clean_places", _CLEAN + "SELECT * FROM filled")
def _(spark, folder):
    return plan.clean_places(STAGED.frame(spark, folder))


@query("promote_valid", _CLEAN + "SELECT coalesce(region, 'Region Inconnue') AS region, "
       "coalesce(province, 'Province Inconnue') AS province, city FROM filled WHERE validation_status = 'VALID' "
       f"QUALIFY row_number() OVER (PARTITION BY {fold_sql('city')} ORDER BY raw_id) = 1")
def _(spark, folder):
    return plan.promote_places(plan.clean_places(STAGED.frame(spark, folder)))


# ---------------------------------------------------------------- repair


@query("ascii_name", f"WITH p AS ({PLACES.sql}) SELECT id, upper(trim(regexp_replace(city, '[^a-zA-Z0-9 ]', '', 'g'))) AS city FROM p")
def _(spark, folder):
    return PLACES.frame(spark, folder).select("id", text.ascii_name("city").alias("city"))


@query("drop_junk", f"WITH {_STANDARD} SELECT * FROM std")
def _(spark, folder):
    return plan.standardise_places(PLACES.frame(spark, folder), "fold")


@query("dict_match", f"WITH {_STANDARD}, {_DICTIONARY}, {_match('std', 'a', _spaceless_sql)} SELECT * FROM a")
def _(spark, folder):
    df = plan.standardise_places(PLACES.frame(spark, folder), "fold")
    return plan.dictionary_match(df, plan.city_dictionary(spark), text.spaceless)


@query("soundex_match", f"WITH {_STANDARD}, {_DICTIONARY}, {_match('std', 'a', soundex_sql)} SELECT * FROM a")
def _(spark, folder):
    df = plan.standardise_places(PLACES.frame(spark, folder), "fold")
    return plan.dictionary_match(df, plan.city_dictionary(spark), match.soundex_long)


@query("edit_distance_match", f"WITH {_STANDARD}, {_typo('std', 'a', 3)} SELECT * FROM a")
def _(spark, folder):
    df = plan.standardise_places(PLACES.frame(spark, folder), "fold")
    return typo_match(df, "city", ["region", "province"], "id", 2, 3)


@query("container_delete", f"WITH {_STANDARD}, {_containers('std', 'a')} SELECT * FROM a")
def _(spark, folder):
    df = plan.standardise_places(PLACES.frame(spark, folder), "fold")
    return drop_containers(df, "city", "region")


@query("smart_dedup", f"WITH {_STANDARD} " + _DEDUP.format("std"))
def _(spark, folder):
    df = plan.standardise_places(PLACES.frame(spark, folder), "fold")
    return smart_dedup(df, "city", "region", "id")


_REPAIR = (
    f"WITH {_STANDARD}, {_DICTIONARY}, {_match('std', 'a', _spaceless_sql)}, {_match('a', 'b', soundex_sql)}, "
    f"{_typo('b', 'c', 3)}, {_containers('c', 'd')}, r AS ({_DEDUP.format('d')}) "
)


@query("repair_places", _REPAIR + "SELECT * FROM r")
def repair(spark, folder):
    return plan.repair_places(PLACES.frame(spark, folder))


@query("still_missing", _REPAIR + "SELECT * FROM r WHERE region IS NULL ORDER BY city")
def _(spark, folder):
    return plan.repair_places(PLACES.frame(spark, folder)).filter(F.col("region").isNull()).orderBy("city")


# ---------------------------------------------------------------- edits on a large vocabulary

_WORDS = (
    "words AS (SELECT w, count(*) AS uses FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) "
    "WHERE length(w) >= 6 GROUP BY w)"
)


@query("edit_distance_words", f"WITH {_WORDS}, pairs AS (SELECT b.w AS word, g.w AS known, levenshtein(b.w, g.w) AS distance, g.uses "
       "FROM words b JOIN words g ON b.uses = 1 AND g.uses >= 20 AND abs(length(b.w) - length(g.w)) <= 2 "
       "AND levenshtein(b.w, g.w) BETWEEN 1 AND 2) "
       "SELECT word, known, CAST(distance AS INT) AS distance FROM pairs "
       "QUALIFY row_number() OVER (PARTITION BY word ORDER BY distance, uses DESC, known) = 1")
def _(spark, folder):
    words = cut_lineage(
        table(spark, folder, "documents")
        .select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("w"))
        .filter(F.length("w") >= 6).groupBy("w").agg(F.count("*").alias("uses"))
    )
    rare = words.filter("uses = 1").select(F.col("w").alias("word"))
    known = words.filter("uses >= 20").select(F.col("w").alias("known"), (-F.col("uses")).alias("u"))
    return edit_distance_pairs(rare, known, "word", "known", 2, nearest="u").select("word", "known", "distance")


# Every word of any script and length on both sides. Words within two edits are equal after two deletions at most on each side.
# The other engine's levenshtein counts bytes, so the letters of a pair are first numbered (up to 127 different ones).
_LETTER_CODES = "array_to_string(list_transform(range(1, 128), lambda i: chr(i::INT)), '')"
_PAIR_LETTERS = "array_to_string(list_distinct(string_split(word || known, '')), '')"
_LETTER_EDITS = (
    "CASE WHEN strlen(word || known) = length(word || known) THEN levenshtein(word, known) "
    f"ELSE levenshtein(translate(word, {_PAIR_LETTERS}, {_LETTER_CODES}), translate(known, {_PAIR_LETTERS}, {_LETTER_CODES})) END"
)


def _shorter(words: str) -> str:
    """Every text left by deleting one letter from each of a list of words."""
    return (f"list_distinct(flatten(list_transform({words}, lambda x: list_transform(range(1, length(x) + 1), "
            "lambda i: substr(x, 1, i - 1) || substr(x, i + 1)))))")


_ALL_WORDS = (
    f"words AS (SELECT w, count(*) AS uses FROM (SELECT unnest(regexp_extract_all(lower(text), '{LETTER_RUN}')) AS w FROM documents) GROUP BY w), "
    f"once AS (SELECT w, {_shorter('[w]')} AS less FROM words), "
    f"left_over AS (SELECT w, unnest(list_distinct([w] || less || {_shorter('less')})) AS v FROM once), "
    "met AS (SELECT DISTINCT a.w AS word, b.w AS known FROM left_over a JOIN left_over b ON a.v = b.v AND a.w <> b.w)"
)


@query("edit_distance_all_words", f"WITH {_ALL_WORDS}, near AS (SELECT word, known, {_LETTER_EDITS} AS distance, uses FROM met JOIN words ON known = w) "
       "SELECT word, known, CAST(distance AS INT) AS distance FROM near WHERE distance <= 2 "
       "QUALIFY row_number() OVER (PARTITION BY word ORDER BY distance, uses DESC, known) = 1")
def _(spark, folder):
    words = cut_lineage(
        table(spark, folder, "documents")
        .select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTER_RUN), F.lit(0))).alias("w"))
        .groupBy("w").agg(F.count("*").alias("uses"))
    )
    known = words.select(F.col("w").alias("known"), (-F.col("uses")).alias("u"))
    return edit_distance_pairs(words.select(F.col("w").alias("word")), known, "word", "known", 2, nearest="u").select("word", "known", "distance")
