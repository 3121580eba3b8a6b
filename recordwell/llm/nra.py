"""Ranked lexical search by NRA: no random access, sequential reads of lists sorted by impact.

Terms are runs of ASCII letters and digits and of anything beyond ASCII; only A-Z are lower-cased. An index row holds
the query terms of one document and how often they occur; it is written once. Each task then searches the
documents of its part: a term's list has the impacts (what the term adds to a document's score), highest
first. All lists of a query are read block by block. A document's lower bound is the sum of the impacts read so far, its
upper bound adds the last impact read of every list that it has not been met in. A document can be left out once its
upper bound is below the k-th highest lower bound; reading goes on until no unread document can reach that
bound and every document that can has equal bounds, so members, ties and scores are final. A list is read no
further when every document that is still open has been met in it. The k best of an earlier block of documents
raise the bound for the next one, and the k best of all tasks hold the k best of all documents.

Queries are taken in blocks of at most ``PAIRS`` terms (a longer query is a block of its own), so what is broadcast has a fixed size.

Defined results: a null or empty text has no terms: as a query it finds nothing, as a document it is not counted. Rows of
``items`` that share an id are one query, a null id among them; every row of ``docs`` is a document of its own, whatever
its id. Equal scores go by document id, null first. Without documents or queries there are no rows. Texts are
read whole, in slices; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from recordwell.session import cut_lineage

#: Bytes of terms are kept (A-Z lower-cased), all others are spaces.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text that are split at once.
SLICE = 1 << 20
#: (query, term) pairs of a block of queries.
PAIRS = 1 << 17
#: Postings that a task holds at once, and postings of a list that are read first.
POSTINGS, FIRST_READ = 1 << 20, 128


def count_terms(text: bytes | None) -> Counter:
    """How often each term occurs."""
    text = (text or b"").translate(_BYTES)
    found, at = Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        found.update(text[at:end].split())
        at = end
    return found


def queries_of(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term) once each."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [list(count_terms(t)) for t in batch["text"].to_pylist()]
            places = np.repeat(np.arange(len(own)), [len(o) for o in own])
            yield pa.RecordBatch.from_arrays(
                [batch["item"].take(pa.array(places)), pa.array([t for o in own for t in o], pa.binary())], ["item", "term"])

    rows = items.select(F.col(item).cast("long").alias("item"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(split, "item long, term binary").distinct()


def index(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document that has a term: (doc, n, terms, tfs) with the terms of the vocabulary and all terms counted in ``n``."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        for batch in batches:
            ns, terms, tfs, ends = [], [], [], [0]
            for value in batch["text"].to_pylist():
                counts = count_terms(value)
                ns.append(counts.total())
                for term in counts.keys() & place.keys():
                    terms.append(place[term])
                    tfs.append(counts[term])
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            rows = pa.RecordBatch.from_arrays([
                batch["doc"], pa.array(ns, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
            ], ["doc", "n", "terms", "tfs"])
            yield rows.filter(pc.greater(rows["n"], 0))

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(read, "doc long, n long, terms array<int>, tfs array<long>")


@dataclass
class Plan:
    """What a task needs to search: the queries' ids and terms, the terms' weights, and the corpus counts."""

    items: list[int | None]
    terms: list[np.ndarray]
    weights: np.ndarray
    documents: int
    length: int
    k: int


def weight_of(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each posting adds to its document's score; ``n`` is the length of its document."""
    if len(n) and 50 * int(n.max()) * documents >= 2 ** 63:
        sizes, at = np.unique(n, return_inverse=True)
        m = np.array([50 + 50 * int(size) * documents // length for size in sizes], np.int64)[at]
    else:
        m = 50 + 50 * n * documents // max(1, length)
    return weight * (1000000000 * tf // (1000 * tf + 20 * m))


def kth(values: np.ndarray, k: int) -> int:
    """The k-th highest positive value, 0 if there are fewer."""
    values = values[values > 0]
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """NRA over one query's lists of (document, impact), impacts descending: (documents, scores, postings read).

    ``best`` are scores found before. Returned are all documents that can be among the k best of both, ties at
    the bar included, with their final scores.
    """
    sizes = np.array([len(own) for own, _ in lists])
    at = np.zeros(len(lists), np.int64)
    bound = np.array([int(impact[0]) for _, impact in lists], np.int64)
    lower = np.zeros(documents, np.int64)
    met, met_in = np.empty(0, np.int64), np.empty(0, np.int64)
    wanted, step = np.ones(len(lists), bool), FIRST_READ
    while True:
        read, read_in = [met], [met_in]
        for n in np.flatnonzero(wanted & (at < sizes)):
            own, impact = lists[n]
            end = min(at[n] + step, sizes[n])
            lower[own[at[n]:end]] += impact[at[n]:end]
            read.append(own[at[n]:end])
            read_in.append(np.full(end - at[n], n))
            at[n] = end
            bound[n] = impact[end - 1] if end < sizes[n] else 0
        met, met_in = np.concatenate(read), np.concatenate(read_in)
        bar = max(1, kth(np.concatenate([best, lower]), k))
        # sums below 2**53 are exact in doubles; an impact is below 10**12
        upper = lower + int(bound.sum()) - np.bincount(met, weights=bound[met_in], minlength=documents).astype(np.int64)
        able = upper >= bar
        still_open = able & (upper > lower)
        if not still_open.any():
            found = np.flatnonzero(able & (lower >= bar))
            return found, lower[found], int(at.sum())
        mine = still_open[met]
        wanted = (bound > 0) & (np.bincount(met_in[mine], minlength=len(lists)) < still_open.sum())
        step *= 2


class Best:
    """The k best documents of a query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        score, doc, known = (np.concatenate(pair) for pair in ((self.score, score), (self.doc, doc), (self.known, known)))
        order = np.lexsort((doc, known, -score))[:self.k]
        self.score, self.doc, self.known = score[order], doc[order], known[order]


def search_block(plan: Plan, best: list[Best], docs: pa.Array, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> int:
    """Searches one block of documents for every query and adds what it finds; returns the postings read."""
    known = ~np.asarray(docs.is_null())
    ids = docs.fill_null(0).to_numpy()
    owner = np.repeat(np.arange(len(n)), sizes)
    impact = impacts(tfs, n[owner], plan.weights[terms], plan.documents, plan.length)
    useful = impact > 0
    owner, terms, impact = owner[useful], terms[useful], impact[useful]
    order = np.lexsort((-impact, terms))
    owner, terms, impact = owner[order], terms[order], impact[order]
    starts = np.searchsorted(terms, np.arange(len(plan.weights) + 1))
    read = 0
    for own, top in zip(plan.terms, best):
        lists = [(owner[starts[t]:starts[t + 1]], impact[starts[t]:starts[t + 1]]) for t in own if starts[t] < starts[t + 1]]
        if lists:
            found, score, reads = resolve(lists, len(n), plan.k, top.score)
            top.add(score, ids[found], known[found])
            read += reads
    return read


def search(indexed: DataFrame, plan: Plan) -> DataFrame:
    """The ``k`` best documents of each query in each part of the index: (item, doc, score)."""
    shared = indexed.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, held, postings = shared.value, [], 0
        best = [Best(plan.k) for _ in plan.items]

        def flush() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            lists = rows["terms"].combine_chunks()
            search_block(
                plan, best, rows["doc"].combine_chunks(), rows["n"].to_numpy(), lists.value_lengths().to_numpy(),
                lists.flatten().to_numpy(), rows["tfs"].combine_chunks().flatten().to_numpy())
            held.clear()

        for batch in batches:
            # a batch may hold many documents of many terms: cut it where the postings would exceed the bound
            sizes = np.cumsum(batch["terms"].value_lengths().to_numpy()) if batch.num_rows else np.empty(0, np.int64)
            start, done = 0, 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(sizes, done + POSTINGS - postings, "right")))
                held.append(batch.slice(start, end - start))
                postings += int(sizes[end - 1]) - done
                start, done = end, int(sizes[end - 1])
                if postings >= POSTINGS or start < batch.num_rows:
                    flush()
                    postings = 0
        if held:
            flush()
        for item, top in zip(plan.items, best):
            size = len(top.score)
            if size:
                yield pa.RecordBatch.from_arrays([
                    pa.array([item] * size, pa.int64()), pa.array(top.doc, mask=~top.known), pa.array(top.score),
                ], ["item", "doc", "score"])

    return indexed.select("doc", "n", "terms", "tfs").mapInArrow(run, "item long, doc long, score long")


def ranked(found: DataFrame, k: int, parts: int) -> DataFrame:
    """The k best of each item with their rank; the best of ``parts`` hashed parts first, so that no rank sees all tasks' rows."""
    order = [F.desc("score"), F.asc_nulls_first("doc")]
    part = F.pmod(F.xxhash64("doc"), F.lit(parts))
    first = found.withColumn("_rank", F.row_number().over(W.partitionBy("item", part).orderBy(*order))).filter(F.col("_rank") <= k)
    last = first.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order)))
    return last.filter(F.col("rank") <= k).select("item", "rank", "doc", "score")


def top_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", pairs: int = PAIRS,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: (item, rank, doc, score), score above 0."""
    asked = cut_lineage(queries_of(items, item, item_text))
    blocks = max(1, -(-asked.count() // pairs))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    results, most = [], 0
    for at in range(blocks):
        own = asked.filter(block == at).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        own.sort(key=lambda r: (r.item is not None, r.item or 0))
        vocabulary: dict[bytes, int] = {}
        terms = [np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r.terms], np.int64) for r in own]
        indexed = cut_lineage(index(docs, vocabulary, key, text))
        documents, length = indexed.agg(F.count(F.lit(1)), F.sum("n")).first()
        most = max(most, documents)
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in indexed.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = weight_of(documents, df)
        plan = Plan([r.item for r in own], terms, weights, documents, length or 0, k)
        results.append(search(indexed, plan))
    found = reduce(DataFrame.unionByName, results)
    # a task holds some thousand documents at least: as many parts as half the digits of the number of tasks
    return ranked(found, k, max(1, math.isqrt(most >> 12)))
