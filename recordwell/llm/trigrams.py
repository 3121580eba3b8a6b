"""Secret scans with a trigram inverted index.

From each rule's pattern follows a Boolean query over trigrams that every match must contain (Cox,
"Regular expression matching with a trigram index"), as alternatives of sets: any of these sets, all of its
trigrams. The index holds, for the trigrams the rules ask for, a posting list of texts as bitmaps of
text addresses. Postings are intersected by ``bitmap_and_agg`` and united by ``bitmap_or_agg``; the texts that
are left are candidates, and only they are verified by the pattern itself. A rule without a mandatory trigram
scans every text. The index is built on lower-cased text, so it finds too many texts at most, never too few.

A text's address is a hash of its id and text; texts that share an address share candidates only. Bitmaps
of candidates are broadcast when they were counted to be small, and joined by shuffle otherwise.

Defined results: a null text is empty and has no match; positions count code points from 0, ends are
exclusive. Matches of a rule are leftmost and do not overlap; matches whose ``group`` is shorter than ``least``
are dropped after matching. Matches of different rules may overlap. Rows that repeat an id are each scanned.
Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from recordwell.llm.common import BITMAP_BITS, bitmaps, has_bit
from recordwell.session import cut_lineage

_parser, _ops = re._parser, re._constants

#: Strings, and alternatives of a query, followed at once; beyond, the query asks for less.
MOST = 64
#: Bytes of candidate bitmaps that are broadcast.
BROADCAST_BYTES = 64 * 2 ** 20

Query = list[frozenset[str]]
ANYTHING: Query = [frozenset()]


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the group that needs ``least`` characters (0: the match)."""

    kind: str
    pattern: str
    group: int
    least: int


#: The kinds of secrets in their order.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)


def _grams(strings: set[str]) -> Query:
    return [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]


def _simple(query: Query) -> Query:
    """Without alternatives that ask for more than another one does."""
    different = set(query)
    return sorted((a for a in different if not any(b < a for b in different)), key=sorted)


def _both(left: Query, right: Query) -> Query:
    query = _simple([a | b for a, b in product(left, right)]) if len(left) * len(right) <= MOST ** 2 else left
    return query if len(query) <= MOST else left


def _element(op, value) -> tuple[set[str] | None, Query]:
    """(all strings it can match, if they are few, else none; what any match must contain)."""
    if op is _ops.LITERAL:
        return {chr(value).lower()}, ANYTHING
    if op is _ops.AT:
        return {""}, ANYTHING
    if op is _ops.IN:
        found: set[str] = set()
        for kind, item in value:
            low, high = (item, item) if kind is _ops.LITERAL else item if kind is _ops.RANGE else (0, MOST)
            if kind not in (_ops.LITERAL, _ops.RANGE) or high - low >= MOST:
                return None, ANYTHING
            found |= {chr(c).lower() for c in range(low, high + 1)}
        return (found, ANYTHING) if len(found) <= 8 else (None, ANYTHING)
    if op is _ops.SUBPATTERN:
        return _sequence(value[-1])
    if op is _ops.BRANCH:
        ways = [_sequence(way) for way in value[1]]
        if all(strings is not None for strings, _ in ways):
            return set().union(*[strings for strings, _ in ways]), ANYTHING
        return None, _simple([a for strings, query in ways for a in (query if strings is None else _grams(strings))])
    if op in (_ops.MAX_REPEAT, _ops.MIN_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        if least == 0:
            return None, ANYTHING
        return None, query if strings is None else _simple(_grams(strings))
    return None, ANYTHING


def _sequence(items) -> tuple[set[str] | None, Query]:
    runs, query, whole = {""}, ANYTHING, True
    for op, value in items:
        strings, own = _element(op, value)
        if strings is not None and len(runs) * len(strings) <= MOST:
            runs = {a + b for a in runs for b in strings}
            continue
        query, whole = _both(_both(query, _grams(runs)), own), False
        runs = strings if strings is not None and len(strings) <= MOST else {""}
    return (runs, ANYTHING) if whole else (None, _both(query, _grams(runs)))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams (lower case); an empty one means that the pattern needs a full scan."""
    strings, query = _sequence(_parser.parse(pattern))
    return _simple(query if strings is None else _grams(strings))


def trigram_index(docs: DataFrame, grams: Sequence[str]) -> DataFrame:
    """Postings (gram, bucket, bits) of the texts (address, text) for the trigrams that rules ask for."""
    low = docs.select("address", F.lower("text").alias("text"))
    held = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(g)), F.lit(g)) for g in grams]))
    # by bucket first, so that a bitmap is made once and not in every task
    postings = low.select("address", F.explode(held).alias("gram")).withColumn("part", F.expr(f"address div {BITMAP_BITS}"))
    return bitmaps(postings.repartition("gram", "part"), ["gram"], "address")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(kind, bucket, bits): the addresses whose texts can match, from intersected and united postings."""
    spark = index.sparkSession
    asked = spark.createDataFrame(
        [(kind, n, gram, len(grams)) for kind, query in queries.items() for n, grams in enumerate(query) for gram in sorted(grams)],
        "kind string, way int, asked string, grams int")
    met = index.join(F.broadcast(asked), F.col("gram") == F.col("asked"))  # a few rows per rule
    every = met.groupBy("kind", "way", "grams", "bucket").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("found")).filter("found = grams")
    return every.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _spans(text: Column, matches: Column, rule: Rule, place: int) -> Column:
    """Array of (start, place of the rule, end) of the matches that are long enough."""
    gaps = F.split(text, rule.pattern, -1)  # what stands before each match, and after the last
    value = lambda m: F.regexp_extract(m, rule.pattern, rule.group)
    sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, match: F.struct(
        F.char_length(gap).alias("gap"), F.char_length(match).alias("size"),
        (F.char_length(value(match) if rule.group else match) >= rule.least).alias("long"),
    ))
    span = "array<struct<start: int, rule: int, end: int>>"
    none = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans"))
    return F.aggregate(sizes, none, lambda done, one: F.struct(
        (done["at"] + one["gap"] + one["size"]).alias("at"),
        F.when(one["long"], F.concat(done["spans"], F.array(F.struct(
            (done["at"] + one["gap"]).alias("start"), F.lit(place).alias("rule"), (done["at"] + one["gap"] + one["size"]).alias("end"),
        )))).otherwise(done["spans"]).alias("spans"),
    ), lambda done: done["spans"])


def scan_secrets(
    docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: (key, spans): array of (start, rule number, end), by start, then rule."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if frozenset() not in query}
    total = docs.count()
    slots = 1 << max(15, (2 * total).bit_length())
    texts = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(key, text), F.lit(slots)).alias("address"),
    )
    may = {rule.kind: F.lit(True) for rule in rules}
    if indexed:
        grams = sorted({gram for query in indexed.values() for way in query for gram in way})
        index = cut_lineage(trigram_index(texts, grams))
        found = cut_lineage(candidates(index, indexed))
        small = found.count() * (BITMAP_BITS // 8) <= broadcast_bytes
        for n, kind in enumerate(indexed):
            own = found.filter(F.col("kind") == kind).select(F.col("bucket").alias(f"bucket{n}"), F.col("bits").alias(f"bits{n}"))
            texts = texts.join(F.broadcast(own) if small else own, F.expr(f"address div {BITMAP_BITS}") == F.col(f"bucket{n}"), "left")
            may[kind] = has_bit(F.col(f"bits{n}"), F.col("address") % BITMAP_BITS)
    matched = texts.select("key", "text", *[
        F.when(may[rule.kind] & F.col("text").rlike(_long(rule)), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias(rule.kind)
        for rule in rules
    ])
    empty = F.array().cast("array<struct<start: int, rule: int, end: int>>")
    spans = [
        F.when(F.col(rule.kind).isNotNull(), _spans(F.col("text"), F.col(rule.kind), rule, n)).otherwise(empty)
        for n, rule in enumerate(rules)
    ]
    return matched.select(F.col("key").alias(key), F.array_sort(reduce(lambda a, b: F.concat(a, b), spans)).alias("spans"))


def _long(rule: Rule) -> str:
    """A pattern that every text with a long enough match of the rule matches: cheap, no positions.

    Only where the rule is one repeated class is its match as long as its repeats; a literal in front counts too.
    """
    items = list(_parser.parse(rule.pattern))
    if rule.group or not rule.pattern.endswith("+") or len(items) != 1 or items[0][0] is not _ops.MAX_REPEAT:
        return rule.pattern
    (_, (_, _, inner)) = items[0]
    return rule.pattern[:-1] + "{%d,}" % rule.least if len(inner) == 1 and inner[0][0] is _ops.IN else rule.pattern
