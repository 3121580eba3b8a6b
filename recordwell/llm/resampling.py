"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets. The target model is the
buckets' distribution over target texts, the raw model that over all texts; a text's importance is the
logarithm of how much likelier the target model makes its n-grams. Adding Gumbel noise, a fixed hash of
the text's id and text, and keeping the k highest samples k texts without replacement in proportion to their
importance.

Raw counts cover every row. Target texts come from a bounded sample (``weigh``). Defined results: null
and empty texts have no n-grams and importance 0 per n-gram, that is 0; without target texts every
importance is 0 and the sample is uniform. Keys that agree to 2^-20 are told apart by a hash of id and text,
rows that repeat both by their place. A k beyond the table keeps all rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordwell.llm.common import bounded_sample
from recordwell.session import cut_lineage

#: Buckets of the hashed n-grams (the size of each model), and the pseudo count of a bucket.
BUCKETS, PSEUDO = 10_000, 1.0
#: Bound of the target sample: different texts, and bytes of one text.
TEXTS, TEXT_BYTES = 5000, 131072
#: Parts of the range in one round of the search for the k-th key.
PARTS = 4096
#: Words remembered by one worker.
MEMO = 500_000

TOKEN = re.compile(r"\w+|[^\w\s]+")
_NUMBERS: dict[str, int] = {}


def _number(word: str) -> int:
    known = _NUMBERS.get(word)
    if known is None:
        if len(_NUMBERS) >= MEMO:
            _NUMBERS.clear()
        known = _NUMBERS[word] = xxhash.xxh64_intdigest(word, 7)
    return known


def buckets_of(text: str | None) -> np.ndarray:
    """The bucket of every word and of every pair of neighbours."""
    words = TOKEN.findall(text.lower()) if text else []
    numbers = np.fromiter(map(_number, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        pairs = numbers[:-1] * np.uint64(0x9E3779B97F4A7C15) + numbers[1:]
        pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        pairs ^= pairs >> np.uint64(32)
    return (np.concatenate([numbers, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts; each task sends one row per bucket at most."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch["text"]:
                total += np.bincount(buckets_of(value if isinstance(value, str) else None), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    rows = texts.select(F.col(text).alias("text")).mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(BUCKETS)
    for bucket, n in rows.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def weigh(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
    texts: int = TEXTS, text_bytes: int = TEXT_BYTES,
) -> np.ndarray:
    """Per bucket the logarithm of its target over its raw probability.

    ``target`` names the ids of target texts. At most ``texts`` different ones of up to ``text_bytes`` bytes
    are counted; the raw model counts all of ``docs``.
    """
    ids = target.select(F.col(key).alias(key)).distinct().withColumn("_target", F.lit(1))
    sample = cut_lineage(bounded_sample(docs, "_target", text, texts, text_bytes, ids, key))
    aimed = bucket_counts(sample)
    if not aimed.sum():
        return np.zeros(BUCKETS)
    raw = bucket_counts(docs, text)
    return np.log((aimed + PSEUDO) / (aimed + PSEUDO).sum()) - np.log((raw + PSEUDO) / (raw + PSEUDO).sum())


def importance(text: Column, weights: np.ndarray, spark: SparkSession) -> Column:
    """The logarithm of a text's importance: the sum over its n-grams."""
    model = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        table = model.value
        return pd.Series([float(table[buckets_of(t if isinstance(t, str) else None)].sum()) for t in texts], dtype=float)

    return weight(text)


def gumbel(*columns: str, seed: int = 17) -> Column:
    """Gumbel noise that depends on the columns' values only."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(2 ** 52)) + F.lit(0.5)) / F.lit(2.0 ** 52)
    return -F.log(-F.log(uniform))


def _resolved(value: Column) -> Column:
    """A long that sorts like the double; keys count to 2^-20."""
    return F.round(F.greatest(F.least(value, F.lit(1e12)), F.lit(-1e12)) * F.lit(2.0 ** 20)).cast("long")


def kth_highest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """(the k-th highest value of a long column, how many rows are above it), for 1 <= k <= rows.

    Each round counts ``PARTS`` parts of the range that is left, in place; nothing is sorted or moved.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = -(-(high - low + 1) // PARTS)
        parts = rows.filter(F.col(column).between(low, high)).groupBy(
            F.expr(f"({column} - ({low}L)) div {width}L").alias("part")).count().collect()  # at most PARTS rows
        for part, n in sorted(((part, n) for part, n in parts), reverse=True):
            if above + n >= k:
                low, high = low + part * width, min(high, low + (part + 1) * width - 1)
                break
            above += n
    return low, above


def resample(weighted: DataFrame, k: int, key: str = "doc_id") -> DataFrame:
    """Rows (key, text_hash, log_weight) with their ``gumbel_key`` and ``selected``: the k highest keys."""
    ranked = cut_lineage(weighted.withColumn("gumbel_key", F.col("log_weight") + gumbel(key, "text_hash")).withColumns({
        "_rank": _resolved(F.col("gumbel_key")), "_tie": F.pmod(F.xxhash64(key, "text_hash"), F.lit(2 ** 62)),
        "_row": F.monotonically_increasing_id(),
    }))
    total = ranked.count()
    if k <= 0 or k >= total:
        return ranked.drop("_rank", "_tie", "_row").withColumn("selected", F.lit(k > 0))
    above, level = F.lit(False), F.lit(True)
    for column in ("_rank", "_tie", "_row"):
        bar, n = kth_highest(ranked.filter(level), column, k)
        above, level, k = above | (level & (F.col(column) > bar)), level & (F.col(column) == bar), k - n
    return ranked.withColumn("selected", above | level).drop("_rank", "_tie", "_row")
