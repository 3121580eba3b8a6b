"""Near duplicates by SimHash: fingerprints, BK-trees over shards, connected components.

A fingerprint has 64 bits; a bit is set if more than half of the text's shingles set it in their
hash. Fingerprints at ``radius`` or fewer differing bits are linked, and links are followed.

Shards: the 64 bits are cut into ``radius + 2`` blocks. Two linked fingerprints agree in at least two
whole blocks, so each distinct fingerprint goes to one shard per pair of blocks and every link has a
shard that holds both ends. A shard is one BK-tree (children keyed by the integer Hamming distance to
the parent); its members are looked up in it, following only edges within the radius. A shard with
more than ``TREE_ROWS`` members is cut into parts; every two parts meet in a cell of their own, so no
tree, and no task, grows with a hot shard. Trees travel to their queries through the shuffle: a
broadcast passes the driver and would grow with the corpus.

Defined results: null and empty texts, and texts without words, have fingerprint zero and are linked
like any other. Fewer words than a shingle: the whole sequence is the one shingle. Rows that repeat
an id or a text are in one component by their equal fingerprints. Null ids never name a component
unless all ids in it are null. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordwell.llm.common import attach_groups, hot_size
from recordwell.session import cut_lineage

#: Members of one BK-tree. A larger shard is cut into parts of about half that size.
TREE_ROWS = 4096


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint of one text; A-Z are lower-cased, words end at space and \\x09-\\x0D."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(parts) > words:
        cuts = zip(starts[:-words + 1 or None].tolist(), ends[words - 1:].tolist())
    else:
        cuts = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in cuts], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """The fingerprint as a long with the same bits."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64)
        return pa.array(values.view(np.int64))

    return of(text)


class BKTree:
    """A tree of distinct fingerprints; a child hangs on the edge of its distance to the parent."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in range(len(values))]
        plain = values.tolist()
        for place in range(1, len(plain)):
            at, value = 0, plain[place]
            while True:
                edge = (plain[at] ^ value).bit_count()
                child = self.children[at].setdefault(edge, place)
                if child == place:
                    break
                at = child

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, places of the queries within the radius of it), for all queries on one walk."""
        todo = [(0, np.arange(len(queries)))] if len(self.values) and len(queries) else []
        while todo:
            node, asked = todo.pop()
            distance = np.bitwise_count(queries[asked] ^ self.values[node])
            near = asked[distance <= radius]
            if len(near):
                yield node, near
            for edge, child in self.children[node].items():
                follow = asked[(distance <= edge + radius) & (distance + radius >= edge)]
                if len(follow):
                    todo.append((child, follow))


def shard_links(tree: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (larger, smaller) that join what the tree and the queries join: a forest, never all pairs."""
    values = np.unique(np.concatenate([tree, queries]))
    label = np.arange(len(values))
    of_tree, of_query = np.searchsorted(values, tree), np.searchsorted(values, queries)
    for node, near in BKTree(tree).search(queries, radius):
        seen = label[of_query[near]]
        own = label[of_tree[node]]
        for other in np.unique(seen[seen != own]).tolist():
            low, high = min(own, other), max(own, other)
            label[label == high] = low
            own = low
    moved = np.flatnonzero(label != np.arange(len(values)))
    return list(zip(values[moved].tolist(), values[label[moved]].tolist()))


def _blocks(radius: int) -> list[int]:
    """Masks of ``radius + 2`` blocks that together hold all 64 bits."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def linked_fingerprints(distinct: DataFrame, radius: int = 3, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links (a, b) between the fingerprints ``print`` of a frame that has each once."""
    masks = [_signed(x | y) for x, y in combinations(_blocks(radius), 2)]
    keys = cut_lineage(distinct.select(
        "print", F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in masks])).alias("pair", "part")
    ))
    sizes = cut_lineage(keys.groupBy("pair", "part").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    total = distinct.count() * len(masks)
    rows = attach_groups(keys, sizes, ["pair", "part"], "members", total)
    # a shard above the bound: every two parts meet in one cell; the first part of a cell is the tree's
    half = max(1, tree_rows // 2)
    cut = F.when(F.col("members") > tree_rows, F.ceil(F.col("members") / half)).otherwise(F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("print"), F.col("cuts")).cast("int")
    cells = rows.withColumn("cuts", cut).withColumn("own", own).select(
        "pair", "part", "print", "own", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    ).select(
        "pair", "part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") <= F.col("other")).alias("in_tree"), (F.col("own") >= F.col("other")).alias("asks"), "print",
    )
    group = ["pair", "part", "low", "high"]
    ordered = cells.repartition(*group).sortWithinPartitions(*group)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None

        def links(rows: pd.DataFrame, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
            prints = rows["print"].to_numpy().view(np.uint64)
            tree, asks = rows["in_tree"].to_numpy(), rows["asks"].to_numpy()
            found: list[tuple[int, int]] = []
            for a, b in zip(starts.tolist(), ends.tolist()):
                found += shard_links(prints[a:b][tree[a:b]], prints[a:b][asks[a:b]], radius)
            out = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})

        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            columns = [rows[c].to_numpy() for c in group]
            change = np.zeros(len(rows), bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = np.flatnonzero(change)
            if not len(cuts):
                kept = rows
                continue
            yield links(rows, np.concatenate([[0], cuts[:-1]]), cuts)
            kept = rows.iloc[cuts[-1]:]
        if kept is not None and len(kept):
            kept = kept.reset_index(drop=True)
            yield links(kept, np.array([0]), np.array([len(kept)]))

    return ordered.select(*group, "in_tree", "asks", "print").mapInPandas(walk, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links; equal roots mean connected. Large-star, small-star.

    Each round hangs neighbours on the smallest node of a star, which keeps the components and
    flattens them; about log(nodes) rounds. Stars of any size are joined by ``attach_groups``.
    """
    def star(edges: DataFrame, larger: bool) -> DataFrame:
        """Neighbours above a node (or below it and itself) hang on the smallest of the star."""
        if larger:
            arcs = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        arcs = cut_lineage(arcs)
        lows = cut_lineage(arcs.groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("low"), F.count(F.lit(1)).alias("degree")
        ))
        stars = attach_groups(arcs, lows, ["a"], "degree", arcs.count())
        if larger:
            moved = stars.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            moved = stars.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
                lows.select("a", F.col("low").alias("b")))
        return moved.filter("a != b").distinct()

    edges = cut_lineage(links.filter("a != b").select("a", "b").distinct())
    state = None
    while True:
        edges = cut_lineage(star(star(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3, tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: (key, print, text_hash, root, component_id).

    ``print`` is the fingerprint as a long, ``root`` the smallest one reachable, ``component_id`` the
    smallest id reachable.
    """
    prints = cut_lineage(docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), fingerprints(F.col(text), words).alias("print")
    ))
    total = prints.count()
    distinct = cut_lineage(prints.groupBy("print").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")))
    roots = components(linked_fingerprints(distinct.select("print"), radius, tree_rows))
    placed = cut_lineage(distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first", "copies", F.coalesce("root", "print").alias("root")
    ))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("prints"))
    named = attach_groups(placed, cut_lineage(smallest), ["root"], "prints", placed.count())
    return attach_groups(prints, cut_lineage(named.select("print", "root", "component_id", "copies")), ["print"], "copies", total).select(
        F.col("key").alias(key), "print", "text_hash", "root", "component_id"
    )


def one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id, with all its columns.

    Of a component's rows that share that id, the smallest text hash stays, then the smallest hash of
    all columns. The decisions are small; texts meet them in one join, whose hot keys Spark can split.
    """
    marks = near_duplicates(docs, key, text, words, radius).filter(F.col(key).eqNullSafe(F.col("component_id")))
    best = marks.groupBy("root").agg(F.min(F.struct("text_hash", F.col(key).alias("key"))).alias("best"))
    rows = marks.groupBy(F.col(key).alias("key"), "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    keep = best.select(F.col("best.key").alias("key"), F.col("best.text_hash").alias("text_hash"))
    keep = cut_lineage(keep.join(rows, keep["key"].eqNullSafe(rows["key"]) & (keep["text_hash"] == rows["text_hash"])).select(
        keep["key"].alias("_near_key"), keep["text_hash"].alias("_near_hash"), F.col("copies").alias("_near_copies")
    ))
    found = docs.join(keep, docs[key].eqNullSafe(F.col("_near_key")) & (F.xxhash64(docs[text]) == F.col("_near_hash")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    order = Window.partitionBy("_near_key", "_near_hash").orderBy(F.xxhash64(*columns))
    repeated = found.filter("_near_copies > 1").withColumn("_near_place", F.row_number().over(order)).filter("_near_place = 1")
    return found.filter("_near_copies = 1").select(*columns).unionByName(repeated.select(*columns))
