"""Merkle manifest of a table: one leaf a row, one tree a source, one root, a witness for every row.

Leaves of a source ascend by key; runs of three consecutive nodes become their parent until one node is left,
the source's subroot; the subroots, ordered by source, are the leaves of a last tree whose single node is the root.

The trees are built by streaming appends. ``Appender`` takes nodes one by one and keeps open runs only: a run
that closes hands each of its members the digests of the others, which extend the witness of every leaf
below, and moves its own digest up. A source is cut into aligned blocks of ``3**height`` leaves, each appended
in one task; block roots are the appends of the next round, and so on until every source has one
block. Witnesses then travel down again, one join a round, in which a row meets at most ``3**height`` others
whatever the size of its source.

Texts do not move: rows are digested where they are read, and only keys and 32-byte digests are sorted.

Defined results: a null field is digested as ``-``; a null source is a source of its own, before all others; null
ids come first in their source; rows with equal source and id are ordered by their digests, so repeated rows are
leaves like any other; an empty table has no rows. Columns that are not named as fields are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from recordwell.session import cut_lineage

#: Nodes of a full run.
ARITY = 3
#: Levels that one task builds: blocks of 3**8 leaves.
HEIGHT = 8
#: The fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bytes of a digest.
DIGEST = 32


def encoded(field: Column) -> Column:
    """A field as digested: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row, lowercase hex."""
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def parent(nodes: Sequence[bytes]) -> bytes:
    """The digest of a run: of the members' hex digests, joined."""
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


class Appender:
    """A tree that grows by appends and witnesses that grow with it.

    ``open[level]`` holds the nodes of the run that is still open on a level, each with the leaves below it;
    no level has more than three. ``witness[leaf]`` has the siblings found so far, lowest level first.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, range]]] = []
        self.witness: list[list[bytes]] = []

    def append(self, node: bytes) -> None:
        at = len(self.witness)
        self.witness.append([])
        self._place(0, node, range(at, at + 1))

    def _place(self, level: int, node: bytes, below: range) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Closes the run of a level: each member learns its siblings, their parent is placed one level up."""
        run, self.open[level] = self.open[level], []
        for own, (_, below) in enumerate(run):
            siblings = b"".join(node for n, (node, _) in enumerate(run) if n != own)
            if siblings:
                for at in below:
                    self.witness[at].append(siblings)
        self._place(level + 1, parent([node for node, _ in run]), range(run[0][1].start, run[-1][1].stop))

    def close(self, height: int | None) -> bytes:
        """Ends the stream and returns its only node: on level ``height``, or on the first level with a single node.

        Runs that are still open have fewer than three members, or one; they complete as they are.
        """
        level = 0
        while True:
            alone = len(self.open[level]) == 1 and not any(self.open[level + 1:])
            if alone and (level == height if height is not None else True):
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1


def _grown(rows: DataFrame, height: int) -> DataFrame:
    """Rows of nodes (tree, position, node, size) with their block, their witness inside it (``siblings``) and its ``top``."""
    width = ARITY ** height

    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("position")
        appender = Appender()
        for node in block["node"].to_pylist():
            appender.append(node)
        top = appender.close(None if block["size"][0].as_py() <= width else height)
        return block.append_column("siblings", pa.array([b"".join(w) for w in appender.witness], pa.binary())).append_column(
            "top", pa.array([top] * block.num_rows, pa.binary()))

    blocks = rows.withColumn("block", F.expr(f"position div {width}"))
    schema = T.StructType([*blocks.schema.fields, T.StructField("siblings", T.BinaryType()), T.StructField("top", T.BinaryType())])
    return blocks.groupBy("tree", "block").applyInArrow(build, schema)


def ascend(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The rounds that build all trees of (tree, position, node, size, ...): leaves in blocks, block roots in blocks, and so on.

    ``size`` is the number of nodes of the tree in the round; positions count from 0 without gaps.
    """
    width = ARITY ** height
    rounds = [cut_lineage(_grown(nodes, height))]
    while not (large := rounds[-1].filter(F.col("size") > width)).isEmpty():
        appends = large.filter(F.col("position") % width == 0).select(
            "tree", F.col("block").alias("position"), F.col("top").alias("node"), F.expr(f"(size + {width - 1}) div {width}").alias("size"))
        rounds.append(cut_lineage(_grown(appends, height)))
    return rounds


def tops(rounds: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """The single node of every tree: (tree, node)."""
    done = [r.filter((F.col("size") <= ARITY ** height) & (F.col("position") == 0)).select("tree", F.col("top").alias("node")) for r in rounds]
    return reduce(DataFrame.unionByName, done)


def descend(rounds: list[DataFrame], crowns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The rows of the first round with their whole witness, and what ``crowns`` (tree, witness, ...) knows of their tree.

    Every join meets a row with one block's rows, so a tree that holds a third of all leaves is no hot key.
    """
    carried = [c for c in crowns.columns if c not in ("tree", "witness")]
    crowns = crowns.withColumnsRenamed({"tree": "_tree", "witness": "_above"})
    found = None
    for here in reversed(rounds):
        own = [c for c in here.columns if c not in ("siblings", "top", "block")]
        whole = [*own, F.concat("siblings", "_above").alias("witness"), *carried]
        last, large = F.col("size") <= ARITY ** height, F.col("size") > ARITY ** height
        ended = here.filter(last).join(crowns, F.col("tree") == F.col("_tree")).select(*whole)
        if found is not None:
            above = found.select(F.col("tree").alias("_tree"), F.col("position").alias("_block"), F.col("witness").alias("_above"), *carried)
            below = here.filter(large).join(above, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block")))
            ended = ended.unionByName(below.select(*whole))
        found = ended
    return found


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Adds ``position`` (from 0 in each tree) and ``size`` (rows of the tree).

    Rows are sorted in ranges, which are written once; a range's place in its tree is the number of rows of the
    tree in earlier ranges. No task sees more than a range, however large a tree is.
    """
    keys = [tree, *order]
    ranges = cut_lineage(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy(tree, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(tree).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(tree).alias("_tree"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(tree)).alias("size"))
    inside = F.row_number().over(W.partitionBy("_range", tree).orderBy(*order)) - 1
    placed = ranges.withColumn("_inside", inside)
    return placed.join(offsets, (F.col(tree) == F.col("_tree")) & (F.col("_range") == F.col("_at"))).withColumn(
        "position", F.col("_inside") + F.col("_before")).drop("_range", "_inside", "_tree", "_at", "_before")


def manifest(
    docs: DataFrame, key: str = "doc_id", source: str = "source", fields: Sequence[str] = FIELDS, height: int = HEIGHT,
    **extra: Column,
) -> DataFrame:
    """One row a document: key, source, leaf, position and size in the source, subroot, place and number of the source, root, witness.

    ``witness`` holds the siblings' digests (32 bytes each) level by level from the leaf's to the root's;
    ``extra`` columns, made from the documents, are carried along.
    """
    # a source as text that sorts null first; the trees' own key
    tree = F.coalesce(F.concat(F.lit("1"), F.col(source)), F.lit("0"))
    # texts are digested once; what is sampled and sorted afterwards is narrow
    rows = cut_lineage(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), tree.alias("tree"),
        F.unhex(leaf([F.col(f) for f in fields])).alias("node"), *[column.alias(name) for name, column in extra.items()]))
    built = ascend(numbered(rows, "tree", ["key", "node"]), height)
    # all sources form one tree, whose leaves are their subroots
    forest = numbered(tops(built, height).select(F.lit("sources").alias("tree"), "node", F.col("tree").alias("own")), "tree", ["own"])
    grown = ascend(forest, height)
    crown = tops(grown, height).select("tree", F.lit(b"").alias("witness"), F.col("node").alias("root"))
    crowns = descend(grown, crown, height).select(
        F.col("own").alias("tree"), "witness", F.col("node").alias("subroot"), F.col("position").alias("place"),
        F.col("size").alias("sources"), "root")
    return descend(built, crowns, height).select(
        "key", "source", F.col("node").alias("leaf"), "position", "size", "subroot", "place", "sources", "root", "witness", *extra)


def fold(leaf: bytes, witness: bytes, *trees: tuple[int, int]) -> bytes:
    """The root that a leaf and its witness lead to.

    ``trees`` gives (position, size) of the leaf in its source and of the source among all. A level with one node ends a tree;
    a run has the nodes that are left of three.
    """
    node, read = leaf, 0
    for position, size in trees:
        while size > 1:
            start = position - position % ARITY
            members = [witness[read + DIGEST * n:read + DIGEST * (n + 1)] for n in range(min(ARITY, size - start) - 1)]
            read += DIGEST * len(members)
            members.insert(position - start, node)
            node = parent(members)
            position, size = position // ARITY, -(-size // ARITY)
    return node


def folded(rows: DataFrame, leaf: Column, root: str = "folded_root") -> DataFrame:
    """Rows of a manifest with the root that ``leaf`` (32 bytes) leads to over each row's own witness."""
    schema = T.StructType([*rows.schema.fields, T.StructField(root, T.BinaryType())])

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [batch[c].to_pylist() for c in ("_leaf", "witness", "position", "size", "place", "sources")]
            found = [fold(own, witness, (position, size), (place, sources)) for own, witness, position, size, place, sources in zip(*read)]
            own = batch.drop_columns(["_leaf"])
            yield own.append_column(root, pa.array(found, pa.binary()))

    return rows.withColumn("_leaf", leaf).mapInArrow(climb, schema)
