"""Similar names inside a block, and the deduplication built on them.

Candidates come from a prefix-filtered join on two-letter grams: names similar enough
must share one of their block's rarest grams, so a block that holds a third of all names is
spread over its grams instead of being compared all with all. The filter is exact for
thresholds of 80 and more. Where it would not prune a block, because most names share their
first words, the block's names are paired once each instead; the rows are the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.match import edit_budget, keep_similar, least_ratio
from recordwell.operators.columns import completeness
from recordwell.operators.keys import keep_best, minus_ids
from recordwell.session import broadcast_if_small, cut_lineage

#: Names of one block that may try one gram before the comparison is dealt out to more tasks.
TILE = 500

#: The gram that all names of a block share where no filter is used.
ALL = 0

#: Duels of one group that a single task may stream through.
GROUP_EDGES = 1_000_000


def _needed_overlap(total: Column, threshold: int) -> Column:
    """Fewest two-letter grams that similar names of this summed length share.

    A deletion breaks at most two grams, an insertion at most one, and together they
    stay within the edit budget.
    """
    miss = 1.0 - least_ratio(threshold)
    return F.greatest(F.lit(1), F.ceil(total * (0.5 - 1.5 * miss) - 1.0 - 1e-9).cast("int"))


def _prefix_size(name: Column, threshold: int) -> Column:
    """How many of a name's rarest grams must be tried."""
    ratio = least_ratio(threshold)
    n = F.length(name)
    shortest = F.ceil(n * (ratio / (2.0 - ratio)) - 1e-9).cast("int")
    return n - 1 - _needed_overlap(n + shortest, threshold) + 1


def _spare_grams(tried: DataFrame) -> DataFrame:
    """One gram in common for all names of a block whose grams would give more pairs than the names have."""
    names = tried.groupBy("block").agg(F.count("*").alias("names"))
    uses = tried.select("block", F.explode("tried").alias("gram")).groupBy("block", "gram").agg(F.count("*").alias("uses"))
    pairs = uses.groupBy("block").agg(F.sum(F.col("uses").cast("double") * F.col("uses")).alias("met"))
    dull = cut_lineage(
        names.join(pairs, names["block"].eqNullSafe(pairs["block"])).filter(F.col("met") >= F.col("names").cast("double") * F.col("names"))
        .select(names["block"].alias("_dull"))
    )
    known = tried.join(broadcast_if_small(dull), F.col("block").eqNullSafe(F.col("_dull")), "left")
    return known.select("block", "node", F.when(F.col("_dull").isNotNull(), F.array(F.lit(ALL).cast("bigint"))).otherwise(F.col("tried")).alias("tried"))


def similar_pairs(df: DataFrame, name: str, blocks: Sequence[str], threshold: int = 85,
                  carry: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of different names in one block whose similarity exceeds ``threshold``.

    ``df`` has one row per (block, name). ``a`` and ``b`` are structs of the name and
    the carried columns, a's name the smaller; null blocks equal each other. No task
    compares more than about ``tile`` squared pairs for one gram, and a name is copied once
    for every ``tile`` names that try the same gram.
    """
    if threshold < 80:
        raise ValueError("the gram filter is exact from a threshold of 80")
    text = F.col(name)
    node = F.struct(text.alias("name"), *carry)
    keyed = df.filter(F.length(text) >= 2).select(
        F.struct(*[F.col(b) for b in blocks]).alias("block"), node.alias("node")
    )
    word = F.col("node.name")
    letters = F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: word.substr(i, F.lit(2)))
    grams = keyed.select("block", "node", F.posexplode(letters).alias("pos", "gram"), letters.alias("all"))
    # the n-th copy of a gram is a gram of its own, so that overlap counts copies
    nth = F.size(F.filter(F.slice("all", F.lit(1), F.col("pos") + 1), lambda g: g == F.col("gram")))
    # rare within the block: what all its names share comes last, whatever other blocks hold
    grams = grams.select("block", "node", F.xxhash64("block", "gram", nth.alias("nth")).alias("gram"))
    usage = grams.groupBy("gram").agg(F.count("*").alias("uses"))
    ranked = grams.join(usage, "gram").groupBy("block", "node").agg(
        F.array_sort(F.collect_list(F.struct("uses", "gram"))).alias("grams")
    )
    rarest = F.slice("grams", F.lit(1), F.least(F.size("grams"), _prefix_size(word, threshold)))
    # written once: both sides of the join read it
    tried = cut_lineage(ranked.select("block", "node", F.transform(rarest, lambda g: g["gram"]).alias("tried")))
    probes = _spare_grams(tried).select("block", "node", "tried", F.explode("tried").alias("gram"))
    # a gram that many names of a block try is work for many tasks: its names are dealt into parts,
    # and every two parts meet in a cell of a grid
    crowded = cut_lineage(
        probes.groupBy("block", "gram").agg(F.count("*").alias("uses")).filter(F.col("uses") > tile)
        .select(F.col("block").alias("_block"), F.col("gram").alias("_gram"), F.ceil(F.col("uses") / F.lit(tile)).cast("int").alias("parts"))
    )
    probes = probes.join(
        broadcast_if_small(crowded), F.col("block").eqNullSafe(F.col("_block")) & (F.col("gram") == F.col("_gram")), "left"
    ).withColumn("parts", F.coalesce("parts", F.lit(1)))
    cells = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    part = F.pmod(F.xxhash64("node.name"), F.col("parts")).cast("int")
    left = probes.select(
        "block", "gram", part.alias("row"), cells.alias("column"), F.col("tried").alias("ta"), F.col("node").alias("a"),
    )
    right = probes.select(
        F.col("block").alias("rblock"), F.col("gram").alias("rgram"), cells.alias("rrow"), part.alias("rcolumn"),
        F.col("tried").alias("tb"), F.col("node").alias("b"),
    )
    # few bytes but many pairs: a stated number of partitions is not merged again by adaptive execution
    session = df.sparkSession
    spread = max(int(session.conf.get("spark.sql.shuffle.partitions")), 2 * session.sparkContext.defaultParallelism)
    left = left.repartition(spread, "gram", "row", "column")
    right = right.repartition(spread, "rgram", "rrow", "rcolumn")
    near = F.abs(F.length("a.name") - F.length("b.name")) <= edit_budget("a.name", "b.name", threshold)
    # a pair that shares several tried grams is taken at the smallest of them only
    once = (F.col("gram") == ALL) | (F.array_min(F.array_intersect("ta", "tb")) == F.col("gram"))
    candidates = left.join(
        right,
        (F.col("gram") == F.col("rgram"))
        & (F.col("row") == F.col("rrow"))
        & (F.col("column") == F.col("rcolumn"))
        & F.col("block").eqNullSafe(F.col("rblock"))
        & (F.col("a.name") < F.col("b.name"))
        & near
        & once,
    )
    return keep_similar(candidates.select("block", "a", "b"), "a.name", "b.name", threshold)


def _settle_round(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(losers settled now, duels still open).

    A row's first possible loss is real when its winner cannot be gone by then, that is
    when the winner's own first possible loss comes later.
    """
    first = edges.groupBy("l").agg(F.min("t").alias("lt"))
    of_winner = first.select(F.col("l").alias("w"), F.col("lt").alias("wt"))
    open_ = edges.join(first, "l").join(of_winner, "w", "left")
    settled = (F.col("t") == F.col("lt")) & (F.col("wt").isNull() | (F.col("t") < F.col("wt")))
    gone = cut_lineage(open_.filter(settled).select("l", F.col("t").alias("gt")))
    as_winner = gone.select(F.col("l").alias("w"), "gt")
    rest = (
        edges.join(gone.select("l"), "l", "left_anti")
        .join(as_winner, "w", "left")
        .filter(F.col("gt").isNull() | (F.col("t") < F.col("gt")))
        .select("g", "w", "l", "t")
    )
    return gone.select("l"), cut_lineage(rest)


def _play(edges: DataFrame) -> DataFrame:
    """Losers of duels played one by one, each group inside one task, streamed in time order."""
    def sweep(frames):
        import pandas as pd

        gone = set()
        for frame in frames:
            lost = []
            for winner, loser in zip(frame["w"].tolist(), frame["l"].tolist()):
                if winner not in gone and loser not in gone:
                    gone.add(loser)
                    lost.append(loser)
            yield pd.DataFrame({"l": pd.Series(lost, dtype=frame["l"].dtype)})

    kind = edges.schema["l"].dataType.simpleString()
    ordered = edges.repartition("g").sortWithinPartitions("t").select("w", "l")
    return ordered.mapInPandas(sweep, f"l {kind}")


def eliminate(edges: DataFrame, group_edges: int = GROUP_EDGES) -> DataFrame:
    """Play out ordered duels and return the losers (column ``l``).

    ``edges`` holds duels (group ``g``, winner ``w``, loser ``l``, unique time ``t``); a
    duel counts only if both are still there at its time, and groups do not meet. Groups
    of at most ``group_edges`` duels are streamed through a task each. Larger ones are
    settled in rounds over all tasks until they are small or empty; a round settles
    every duel that no earlier open duel can change, so the result is the same.
    """
    edges = cut_lineage(edges.select("g", "w", "l", "t"))
    lost = []
    while True:
        large = edges.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > group_edges).select("g")
        large = cut_lineage(large)
        if large.isEmpty():
            lost.append(_play(edges))
            return reduce(DataFrame.union, lost)
        lost.append(_play(edges.join(large, "g", "left_anti")))
        gone, edges = _settle_round(edges.join(large, "g", "left_semi"))
        lost.append(gone)


def fuzzy_dedup(df: DataFrame, name: str, blocks: Sequence[str], id_col: str,
                visit_order: Sequence[Column] = (), complete: Sequence[str] | None = None,
                threshold: int | None = 85) -> DataFrame:
    """Keep one of every two similar names in a block: the more complete row, then the lower id.

    Rows meet in the order (visit order, id) of the lower id, then of the higher; a row
    that lost meets nobody any more, as in a sequential sweep. Equal names are reduced
    to their best row first, so a group of copies of any size is never paired up.
    Without a threshold only equal names are duplicates. Rows without a name all stay.
    """
    complete = list(complete if complete is not None else df.columns)
    named = F.col(name).isNotNull() & (F.col(name) != "")
    rated = df.filter(named).withColumns({
        "_name": F.lower(F.col(name)),
        "_filled": completeness(complete),
        "_visit": F.struct(*[c.alias(f"v{i}") for i, c in enumerate([*visit_order, F.col(id_col)])]),
    })
    copies = [F.struct(*[F.col(b) for b in blocks]), F.col("_name")]
    best = keep_best(rated, copies, [F.desc("_filled"), F.col(id_col)])
    if threshold is not None:
        # names only, written once: the pair search reads them several times
        nodes = cut_lineage(best.select(*blocks, "_name", F.col(id_col).alias("id"), "_filled", "_visit"))
        pairs = similar_pairs(nodes, "_name", blocks, threshold, ["id", "_filled", "_visit"])
        swap = F.col("a.id") > F.col("b.id")
        one = F.when(swap, F.col("b")).otherwise(F.col("a"))
        two = F.when(swap, F.col("a")).otherwise(F.col("b"))
        duels = pairs.select(F.xxhash64("block").alias("g"), one.alias("i"), two.alias("j"))
        first_wins = F.col("i._filled") >= F.col("j._filled")
        edges = duels.select(
            "g",
            F.when(first_wins, F.col("i.id")).otherwise(F.col("j.id")).alias("w"),
            F.when(first_wins, F.col("j.id")).otherwise(F.col("i.id")).alias("l"),
            F.struct(F.col("i._visit").alias("i"), F.col("j._visit").alias("j")).alias("t"),
        )
        best = minus_ids(best, eliminate(edges).withColumnRenamed("l", id_col), id_col)
    kept = best.select(*df.columns)
    return kept.unionByName(df.filter(~F.coalesce(named, F.lit(False))))
