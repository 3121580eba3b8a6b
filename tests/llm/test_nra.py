"""Ranked search against scoring every document, on odd texts, ties, several blocks of queries and small reads."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwell.llm import nra
from tests.llm.test_operators import CLASHING, SCHEMA, WORDS, some_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranking(docs, items, k):
    own = [(r[0], collections.Counter(plain_terms(r[1]))) for r in docs]
    own = [(key, counts) for key, counts in own if counts]
    n, length = len(own), sum(c.total() for _, c in own)
    df = collections.Counter(t for _, c in own for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item].update(plain_terms(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for key, counts in own:
            m = 50 + (50 * counts.total() * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m))
                        for t in terms if t in counts)
            if score > 0:
                scored.append((-score, key is not None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(0, "alpha BETA gamma"), (1, "seven again x3"), (2, None), (3, ""), (4, "...!"), (5, "unheard of"), (6, "É́ ſtraße 中文 k"), (7, "alpha"),
         (7, "beta twice"), (None, "omega psi"), (8, " ".join(WORDS)), (9, "word")]


@pytest.mark.parametrize(("pairs", "postings", "k"), [(1 << 17, 1 << 20, 50), (7, 40, 5), (1, 1, 1)])
def test_ranks_equal_scoring_everything(spark, monkeypatch, pairs, postings, k):
    monkeypatch.setattr(nra, "POSTINGS", postings)
    monkeypatch.setattr(nra, "FIRST_READ", 2)
    rows = some_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit("clash") for name in (*CLASHING, "doc", "n", "terms", "tfs", "score", "item")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("term", F.lit("clash"))
    found = nra.top_documents(docs, items, k=k, pairs=pairs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_ranking(rows, ITEMS, k)


def test_nothing_to_search_or_to_ask(spark):
    docs, items = spark.createDataFrame(some_rows(), SCHEMA), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert nra.top_documents(docs.limit(0), items).count() == 0
    assert nra.top_documents(docs, items.limit(0)).count() == 0
    assert nra.top_documents(docs.filter("doc_id = 2002"), items).count() == 0


def test_terms_of_long_texts_do_not_depend_on_slices(monkeypatch):
    text = " ".join(random.Random(3).choice(WORDS + ["Été", "中文"]) for _ in range(3000))
    whole = nra.count_terms(text.encode())
    monkeypatch.setattr(nra, "SLICE", 7)
    assert nra.count_terms(text.encode()) == whole == collections.Counter(t.encode() for t in plain_terms(text))


def test_reading_stops_early_and_ties_at_the_bar_are_all_resolved():
    rnd = np.random.default_rng(5)
    for trial in range(60):
        documents, lists = 3000, []
        for n in range(int(rnd.integers(1, 6))):
            own = rnd.permutation(documents)[:int(rnd.integers(1, documents))]
            impact = -np.sort(-(rnd.integers(1, 6, len(own)) if trial % 2 else (rnd.pareto(1.0, len(own)) * 1000).astype(np.int64) + 1))
            lists.append((own, impact))
        total = np.zeros(documents, np.int64)
        for own, impact in lists:
            total[own] += impact
        best = np.sort(rnd.integers(1, 20, 5)) if trial % 3 == 0 else np.empty(0, np.int64)
        bar = max(1, nra.kth(np.concatenate([best, total]), 10))
        found, score, read = nra.resolve(lists, documents, 10, best)
        assert sorted(found) == list(np.flatnonzero(total >= bar)) and (score == total[found]).all()
    heads = [(np.arange(3000), -np.sort(-np.where(np.arange(3000) < 20, 10 ** 6, 1))) for _ in range(3)]
    assert nra.resolve(heads, 3000, 10, np.empty(0, np.int64))[2] < 1000


def test_long_corpora_do_not_overflow():
    got = nra.impacts(np.array([3]), np.array([10 ** 8]), np.array([7]), 10 ** 11, 10 ** 14)
    m = 50 + 50 * 10 ** 8 * 10 ** 11 // 10 ** 14
    assert got[0] == 7 * (3 * 10 ** 9 // (3000 + 20 * m))
