"""Benchmark decontamination by greedy string tiling over running Karp-Rabin hashes.

A document is tiled with an item only if both hold a seed, that is ``least`` equal tokens in a row; an item
of fewer tokens is its own seed, so it is found where it stands whole.
Tiling marks the longest common runs first; a token is covered once, runs may come in any order, so
reordered passages are caught. An item is leaked into a document when tiles cover at least
``coverage`` of the item's tokens.

The benchmark is read in blocks whose size is measured (``block_bytes``); each block is broadcast and
met by every document in place, so documents never shuffle. One block is the normal case.

Tokens are runs of letters, digits and underscores of the lower-cased text; in scripts that are written without
spaces each letter is a token. Defined results: null and empty texts contain nothing. Items without any token
are never found. Of items or documents
that repeat an id, each row is searched on its own. An empty benchmark finds nothing. The item id is an
integer; other columns are not looked at.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

#: Tokens of a seed and of the shortest tile, and the share of an item that must be covered.
LEAST, COVERAGE = 5, 0.8
#: Benchmark text broadcast at once.
BLOCK_BYTES = 16 * 2 ** 20

#: Letters of scripts without spaces: Thai and Lao, Myanmar, Khmer, kana, Han.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKEN = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")
BASE = 0x9E3779B97F4A7C15
RESULT = "array<struct<item_id: long, item_tokens: int, covered: int, tiles: array<struct<doc_start: int, item_start: int, tokens: int>>>>"


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def running_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` tokens, modulo 2^64."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(tokens) - size + 1), np.uint64)
        for j in range(size):
            out = out * np.uint64(BASE) + tokens[j:j + len(out)]
    return out


def free_windows(free: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` tokens that are all free."""
    if len(free) < size:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[size:] == taken[:-size])


def _window_hashes(tokens: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the windows of ``size`` free tokens, from one running sum over the tokens."""
    starts = free_windows(free, size)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(tokens), BASE, np.uint64), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * powers, dtype=np.uint64)])
        # BASE is odd, so dividing by its power is multiplying by the inverse power
        back = np.cumprod(np.full(len(tokens), pow(BASE, -1, 2 ** 64), np.uint64), dtype=np.uint64)
        return starts, (sums[starts + size] - sums[starts]) * back[starts]


def greedy_tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, tokens), longest first. Tokens are positive; zero matches nothing."""
    free_doc, free_item = doc != 0, item != 0
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(doc), len(item)) // 2)
    while True:
        at_doc, hash_doc = _window_hashes(doc, free_doc, size)
        at_item, hash_item = _window_hashes(item, free_item, size)
        order = np.argsort(hash_item, kind="stable")
        low = np.searchsorted(hash_item[order], hash_doc, "left")
        high = np.searchsorted(hash_item[order], hash_doc, "right")
        runs: list[tuple[int, int, int]] = []
        for k in np.flatnonzero(high > low).tolist():
            p = int(at_doc[k])
            for t in at_item[order[low[k]:high[k]]].tolist():
                if p and t and doc[p - 1] == item[t - 1] and free_doc[p - 1] and free_item[t - 1]:
                    continue  # part of the run that starts before
                length = 0
                while (
                    p + length < len(doc) and t + length < len(item) and doc[p + length] == item[t + length]
                    and free_doc[p + length] and free_item[t + length]
                ):
                    length += 1
                if length >= size:  # equal tokens, not only equal hashes
                    runs.append((-length, p, t))
        cut = False
        for length, p, t in sorted(runs):
            length = -length
            cut = not (free_doc[p:p + length].all() and free_item[t:t + length].all())
            if cut:
                break  # what is left of it may still be longer than the next run: look again
            free_doc[p:p + length] = False
            free_item[t:t + length] = False
            tiles.append((p, t, length))
        if cut:
            continue
        if size == least or free_item.sum() < least:
            return tiles
        size = max(least, size // 2)


class Block:
    """Items by token number, and per seed length the sorted hashes of the seeds with the item of each."""

    def __init__(self, items: list[tuple[int | None, str | None]], least: int):
        self.vocabulary: dict[str, int] = {}
        self.ids, self.items, self.least = [], [], []
        found: dict[int, tuple[list, list]] = {}
        for key, text in items:
            tokens = tokens_of(text)
            if not tokens:
                continue
            numbers = np.array([self.vocabulary.setdefault(t, len(self.vocabulary) + 1) for t in tokens], np.uint64)
            size = min(least, len(tokens))
            seeds = running_hashes(numbers, size)
            hashes, owners = found.setdefault(size, ([], []))
            owners.append(np.full(len(seeds), len(self.items), np.int64))
            hashes.append(seeds)
            self.ids.append(key)
            self.items.append(numbers)
            self.least.append(size)
        self.seeds = {}
        for size, (hashes, owners) in found.items():
            every = np.concatenate(hashes)
            order = np.argsort(every, kind="stable")
            self.seeds[size] = every[order], np.concatenate(owners)[order]

    def shared(self, doc: np.ndarray) -> list[tuple[int, int]]:
        """(item, seeds of it that the document holds), by item."""
        out = []
        for size, (hashes, owners) in self.seeds.items():
            starts = free_windows(doc != 0, size)
            if not len(starts):
                continue
            seeds = np.unique(running_hashes(doc, size)[starts])
            low, high = np.searchsorted(hashes, seeds, "left"), np.searchsorted(hashes, seeds, "right")
            many = high - low
            places = np.arange(many.sum()) + np.repeat(low - (np.cumsum(many) - many), many)
            item, count = np.unique(owners[places], return_counts=True)
            out += zip(item.tolist(), count.tolist())
        return sorted(out)

    def leaks(self, text: str | None, coverage: float) -> list[dict]:
        """The items that the text covers far enough, with their tiles."""
        known = self.vocabulary.get
        tokens = tokens_of(text)
        doc = np.fromiter((known(t, 0) for t in tokens), np.uint64, len(tokens))
        out = []
        for owner, count in self.shared(doc):
            item, least = self.items[owner], self.least[owner]
            if count * least < coverage * len(item):
                continue  # seeds cover at most ``least`` tokens each, and every tile consists of seeds
            tiles = greedy_tiles(doc, item, least)
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * len(item):
                out.append({"item_id": self.ids[owner], "item_tokens": len(item), "covered": covered,
                            "tiles": [dict(zip(("doc_start", "item_start", "tokens"), t)) for t in tiles]})
        return out


def _blocks(benchmark: DataFrame, item: str, text: str, least: int, block_bytes: int) -> list[Broadcast]:
    """Broadcast blocks of the benchmark; a block holds about ``block_bytes`` of text."""
    items = benchmark.select(F.col(item).cast("long").alias("id"), F.col(text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    context = benchmark.sparkSession.sparkContext
    return [
        context.broadcast(Block([tuple(r) for r in items.filter(block == b).orderBy("id", "text").collect()], least))
        for b in range(count)
    ]


def _leaks(text: str, block: Broadcast, coverage: float):
    @F.pandas_udf(RESULT)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([block.value.leaks(t, coverage) for t in texts], dtype=object)

    return found(F.col(text))


def leaked_items(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item it contains: (key, item_id, item_tokens, covered, coverage, tiles)."""
    parts = [
        docs.select(F.col(key).alias("key"), F.explode(_leaks(text, block, coverage)).alias("leak"))
        for block in _blocks(benchmark, item, item_text, least, block_bytes)
    ]
    found = reduce(DataFrame.unionByName, parts)
    return found.select(
        F.col("key").alias(key), "leak.item_id", "leak.item_tokens", "leak.covered",
        (F.col("leak.covered") / F.col("leak.item_tokens")).alias("coverage"), "leak.tiles",
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    least: int = LEAST, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows that contain no item, with all their columns, decided row by row without a shuffle."""
    for block in _blocks(benchmark, item, item_text, least, block_bytes):
        docs = docs.filter(F.size(_leaks(text, block, coverage)) == 0)
    return docs
