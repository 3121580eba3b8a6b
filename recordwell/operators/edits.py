"""Names within a few edits of each other, as an equi-join instead of all pairs.

Short names share a deletion variant: two texts at most k edits apart become equal
after at most k deletions on each side. Long names share a piece: k edits leave one of
k+1 pieces whole, moved by at most k places. Both keys are exact (nothing within k edits
is missed) and every candidate is verified with the built-in ``levenshtein``.

Where only the nearest name is wanted, the variants of short names are not shuffled: names are dealt by the first letters
of their variants, and the tasks make, sort and verify the variants (``_nearest_in_task``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.text import let
from recordwell.operators.fill import attach
from recordwell.session import broadcast_if_small, cut_lineage

#: Names up to this length use deletion variants (a few hundred keys), longer ones pieces.
SHORT = 30

#: Up to this many keys of the right-hand names are broadcast; more are shuffled.
BROADCAST_KEYS = 500_000

#: First letters of a variant that say which task has it; names and their cuts a task gets, variants and pairs it holds at once.
LEAD, CUTS_PER_TASK, VARIANTS_HELD, PAIRS_HELD = 2, 300_000, 2_000_000, 500_000


def _without(text: Column, position: Column) -> Column:
    return F.concat(text.substr(F.lit(1), position - 1), text.substr(position + 1, F.length(text)))


def deletion_keys(text: Column, k: int) -> Column:
    """Hashes of every variant with at most ``k`` (1 or 2) characters deleted."""
    if k not in (1, 2):
        raise ValueError("k must be 1 or 2")
    none = F.array().cast("array<string>")

    def drop_from(word: Column, first: Column) -> Column:
        """Every text left by deleting one character at or after ``first``."""
        n = F.length(word)
        each = F.transform(F.sequence(first, n), lambda j: _without(word, j))
        return F.when(n >= first, each).otherwise(none)

    def variants(word: Column) -> Column:
        one = drop_from(word, F.lit(1))
        found = F.concat(F.array(word), one)
        if k == 2:
            two = F.transform(one, lambda v, i: drop_from(v, i + 1))
            found = F.concat(found, F.flatten(two))
        return F.transform(found, lambda v: F.xxhash64(v))

    return F.array_distinct(let(text, variants))


def _piece_start(length: Column, piece: Column, k: int) -> Column:
    return F.floor(piece * length / F.lit(k + 1)).cast("int")


def _piece_key(text: Column, length: Column, piece: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length.cast("int"), piece.cast("int"), text.substr(start + 1, size))


def piece_keys(text: Column, k: int) -> Column:
    """One hash per piece of the text."""
    n = F.length(text)

    def key(p: Column) -> Column:
        start = _piece_start(n, p, k)
        return _piece_key(text, n, p, start, _piece_start(n, p + 1, k) - start)

    return F.transform(F.sequence(F.lit(0), F.lit(k)), key)


def piece_probes(text: Column, k: int) -> Column:
    """Hashes of every place a partner's whole piece may stand in this text."""
    m = F.length(text)
    shifts = F.sequence(F.lit(-k), F.lit(k))

    def at_length(length: Column) -> Column:
        def at_piece(p: Column) -> Column:
            start = _piece_start(length, p, k)
            size = _piece_start(length, p + 1, k) - start
            return F.transform(
                shifts,
                lambda d: F.when(
                    (start + d >= 0) & (start + d + size <= m),
                    _piece_key(text, length, p, start + d, size),
                ),
            )
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k)), at_piece))

    keys = F.flatten(F.transform(F.sequence(m - k, m + k), at_length))
    return F.array_distinct(F.array_compact(keys))


def _cuts(k: int) -> list[tuple[int, ...]]:
    """The places of up to ``k`` letters that can be deleted before the last leading letter of a variant."""
    return [cut for j in range(k + 1) for cut in combinations(range(LEAD + j - 1), j)]


def _lead(name: Column, cut: tuple[int, ...]) -> Column:
    """The first letters that the name has after a cut."""
    kept = [i for i in range(LEAD + len(cut)) if i not in cut]
    return F.concat(*[name.substr(i + 1, 1) for i in kept])


def _variant_hashes(letters: np.ndarray, k: int) -> np.ndarray:
    """A row per name of one length: hashes of its variants with at most ``k`` letters after the leading ones deleted."""
    n = letters.shape[1]
    x = letters.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    base = 0xD1342543DE82EF95
    powers = np.array([pow(base, i, 1 << 64) for i in range(n)], dtype=np.uint64)
    sums = np.zeros((len(letters), n + 1), np.uint64)
    np.cumsum(x * powers, axis=1, out=sums[:, 1:])
    # deleting a letter moves those after it one place down
    down = [np.uint64(pow(base, -d, 1 << 64)) for d in range(k + 1)]
    out = []
    for d in range(k + 1):
        gone = list(combinations(range(LEAD, n), d))
        gone = np.array(gone, dtype=np.int64).reshape(len(gone), d)
        edges = [np.full(len(gone), -1), *gone.T, np.full(len(gone), n)]
        out.append(sum((down[i] * (sums[:, edges[i + 1]] - sums[:, edges[i] + 1]) for i in range(d + 1)),
                       np.zeros((len(letters), len(gone)), np.uint64)))
    return np.concatenate(out, axis=1)


def _edits(letters: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Edits between names ``a`` and ``b`` (columns of ``letters``) whose lengths differ by ``k`` at most; k + 1 if there are more."""
    out = np.empty(len(a), np.int8)
    for n in np.unique(lengths[a]):
        at = np.flatnonzero(lengths[a] == n)
        left, right = a[at], b[at]
        none = np.full(len(at), k + 1, np.int8)
        # the cells on 2k+1 diagonals: ``before[d]`` is row i-1, column i-1+d-k
        before = [np.full(len(at), max(0, d - k) if d >= k else k + 1, np.int8) for d in range(2 * k + 1)]
        columns = {j: letters[j - 1][right] for j in range(1, k + 1)}
        for i in range(1, n + 1):
            own, now = letters[i - 1][left], []
            if i + k <= len(letters):
                columns[i + k] = letters[i + k - 1][right]
            for d in range(2 * k + 1):
                j = i + d - k
                if j < 0 or j > len(letters):
                    now.append(none)
                    continue
                if j == 0:
                    now.append(np.full(len(at), min(i, k + 1), np.int8))
                    continue
                cell = before[d] + (own != columns[j])
                if d < 2 * k:
                    cell = np.minimum(cell, before[d + 1] + 1)
                if d:
                    cell = np.minimum(cell, now[d - 1] + 1)
                now.append(np.minimum(cell, k + 1).astype(np.int8))
            before = now
        out[at] = np.stack(before)[lengths[right] - n + k, np.arange(len(at))]
    return out


def _nearest_in_task(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """The best name within ``k`` edits among those met in this task, for every left name.

    Names that share a variant are met in order of rank; the first that is near enough ends the search of that variant.
    """
    cuts = _cuts(k)
    frames = [frame for frame in frames if len(frame)]
    if not frames:
        return
    table = pd.concat(frames, ignore_index=True)
    ids, names = pd.factorize(table["name"])
    first = np.unique(ids, return_index=True)[1]
    is_left = table["left"].to_numpy(bool)[first]
    is_right = table["right"].to_numpy(bool)[first]
    ranks = table["rank"].to_numpy(np.int64)[first]
    lengths = np.array([len(name) for name in names])
    texts = np.array(names, dtype=f"U{lengths.max()}")
    letters = np.ascontiguousarray(texts.view(np.uint32).reshape(len(texts), -1).T)
    place = np.empty(len(texts), np.int64)
    place[np.lexsort((texts, ranks))] = np.arange(len(texts))
    best = np.full(len(texts), len(texts))
    chosen = np.argsort(place)
    groups = [(members, cuts[c], n) for (c, n), members in pd.Series(ids).groupby([table["cut"].to_numpy(), lengths[ids]])]
    rounds = 1 + sum(len(m) * (1 + max(0, n - len(c) - LEAD)) ** (k - len(c)) for m, c, n in groups) // VARIANTS_HELD
    for part in range(rounds):
        keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for members, cut, n in groups:
            members = members.to_numpy()
            kept = [i for i in range(n) if i not in cut]
            for some in np.array_split(members, 1 + len(members) // 20_000):
                found = _variant_hashes(letters[kept][:, some].T, k - len(cut))
                of = np.repeat(some, found.shape[1])
                found = found.ravel()
                mine = slice(None) if rounds == 1 else (found >> np.uint64(40)) % np.uint64(rounds) == part
                keys.append(found[mine])
                owners.append(of[mine])
        _meet(np.concatenate(keys), np.concatenate(owners), is_left, is_right, place, best, chosen, letters, lengths, k)
    hit = np.flatnonzero(best < len(texts))
    other = chosen[best[hit]]
    yield pd.DataFrame({"name": texts[hit].astype(object), "near": texts[other].astype(object), "rank": ranks[other]})


def _meet(keys, owners, is_left, is_right, place, best, chosen, letters, lengths, k) -> None:
    """Lower ``best`` of the left names to the least place of a near right name that shares a key."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    shared = np.repeat(sizes > 1, sizes)
    run = np.repeat(np.arange(len(sizes)), sizes)[shared]
    owner = owners[order][shared]
    order = np.lexsort((place[owner], run))
    run, owner = run[order], owner[order]
    rights = is_right[owner]
    right, right_run = owner[rights], run[rights]
    lefts = is_left[owner]
    left, left_run = owner[lefts], run[lefts]
    at, end = np.searchsorted(right_run, left_run, "left"), np.searchsorted(right_run, left_run, "right")
    width = 1
    while len(left):
        # a later name of the run cannot be better than one already found
        open_ = np.flatnonzero(at < end)
        open_ = open_[place[right[at[open_]]] < best[left[open_]]]
        left, at, end = left[open_], at[open_], end[open_]
        found = np.zeros(len(left), bool)
        for some in np.array_split(np.arange(len(left)), 1 + len(left) * width // PAIRS_HELD):
            counts = np.minimum(end[some] - at[some], width)
            entry = np.repeat(some, counts)
            a = left[entry]
            b = right[np.repeat(at[some] - np.cumsum(counts) + counts, counts) + np.arange(len(entry))]
            use = (a != b) & (place[b] < best[a]) & (np.abs(lengths[a] - lengths[b]) <= k)
            a, b, entry = a[use], b[use], entry[use]
            near = _edits(letters, lengths, a, b, k) <= k
            np.minimum.at(best, a[near], place[b[near]])
            found[entry[near]] = True
        left, at, end = left[~found], (at + width)[~found], end[~found]
        width = min(2 * width, PAIRS_HELD)


def _nearest_short(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """(name, near, rank, distance) for the left (name) and the right (name, rank) of at most ``SHORT`` letters.

    Names without a neighbour at one edit are searched at two: then the first near name is the nearest.
    """
    schema = "name string, near string, rank bigint"
    last = F.lit(2**63 - 1)
    both = left.select("name", F.lit(True).alias("left"), F.lit(False).alias("right"), last.alias("rank")).unionByName(
        right.select("name", F.lit(False).alias("left"), F.lit(True).alias("right"), "rank"))
    names = cut_lineage(both.groupBy("name").agg(
        F.max("left").alias("left"), F.max("right").alias("right"), F.min("rank").alias("rank")))
    count, found = names.count(), None
    for distance in range(1, k + 1):
        if found is not None:
            done = found.select(F.col("name").alias("_done"))
            names = names.join(done.hint("merge"), F.col("name") == F.col("_done"), "left").select(
                "name", (F.col("left") & F.col("_done").isNull()).alias("left"), "right", "rank")
        cuts = _cuts(distance)
        dealt = names.select("*", F.explode(F.array_compact(F.array(*[
            F.when(F.length("name") > max(cut, default=-1), F.lit(i)) for i, cut in enumerate(cuts)]))).alias("cut"))
        lead = F.coalesce(*[F.when(F.col("cut") == i, _lead(F.col("name"), cut)) for i, cut in enumerate(cuts)])
        tasks = max(left.sparkSession.sparkContext.defaultParallelism, count * len(cuts) // CUTS_PER_TASK)

        def search(frames: Iterator[pd.DataFrame], k: int = distance) -> Iterator[pd.DataFrame]:
            return _nearest_in_task(frames, k)

        met = dealt.repartition(tasks, lead).mapInPandas(search, schema)
        least = met.groupBy("name").agg(F.min(F.struct("rank", "near")).alias("m")).select(
            "name", "m.near", "m.rank", F.lit(distance).alias("distance"))
        least = cut_lineage(least)
        found = least if found is None else found.unionByName(least)
    return found


def edit_distance_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                        k: int = 2, min_length: int = 1, nearest: str | None = None) -> DataFrame:
    """All pairs of rows whose names are 1..k edits apart, with ``distance``.

    Give distinct names on both sides: copies are matched once and joined back by the
    caller. Other columns are carried along; a pair may be found by several keys and
    then appears once per key, so reduce with an aggregate.

    ``nearest`` names a whole-number column of ``right``: then every left name has one row, with the right name
    of the least distance, of several that with the least value (null counts as highest), then the least name; of other columns only that one is carried.
    """
    left = left.filter(F.length(left_name) >= min_length)
    right = right.filter(F.length(right_name) >= min_length)
    if nearest is None:
        return _all_pairs(left, right, left_name, right_name, k)
    left = left.select(F.col(left_name).alias("name"))
    right = right.select(F.col(right_name).alias("name"), F.coalesce(F.col(nearest).cast("bigint"), F.lit(2**63 - 1)).alias("rank"))
    size = F.length("name")
    short = _nearest_short(left.filter(size <= SHORT), right.filter(size <= SHORT), k)
    # pairs with a longer name
    rest = _all_pairs(
        left.filter(size > SHORT - k), right.filter(size > SHORT - k).select(F.col("name").alias("near"), "rank"), "name", "near", k)
    columns = ["name", "near", "rank", "distance"]
    best = short.select(columns).unionByName(rest.select(columns)).groupBy("name").agg(
        F.min(F.struct("distance", "rank", "near")).alias("m"))
    return best.select(F.col("name").alias(left_name), F.col("m.near").alias(right_name), F.col("m.rank").alias(nearest), "m.distance")


def _all_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, k: int) -> DataFrame:
    a, b = F.col(left_name), F.col(right_name)
    short = F.lit(SHORT)
    left_keys = F.concat(
        F.when(F.length(a) <= short + k, deletion_keys(a, k)).otherwise(F.array().cast("array<bigint>")),
        F.when(F.length(a) > short, piece_probes(a, k)).otherwise(F.array().cast("array<bigint>")),
    )
    right_keys = F.concat(
        F.when(F.length(b) <= short + k, deletion_keys(b, k)).otherwise(F.array().cast("array<bigint>")),
        F.when(F.length(b) > short, piece_keys(b, k)).otherwise(F.array().cast("array<bigint>")),
    )
    lhs = left.select("*", F.explode(left_keys).alias("_key"))
    rhs = right.select("*", F.explode(right_keys).alias("_rkey"))
    distance = F.levenshtein(a, b, k)
    # Spark takes the size of the names for that of their keys, so it must not choose a broadcast by itself
    return (
        lhs.join(broadcast_if_small(rhs.hint("merge"), BROADCAST_KEYS), (F.col("_key") == F.col("_rkey")) & distance.between(1, k))
        .withColumn("distance", distance)
        .drop("_key", "_rkey")
    )


def name_table(df: DataFrame, name: str, attributes: Sequence[str], id_col: str = "id") -> DataFrame:
    """One row per name: ``donor`` (its lowest row that has the first attribute) and
    ``broken_id`` (its lowest row that lacks it), either null.

    Repairs depend on names alone, so they work on this table; it is written once in
    the shared folder and the rows themselves are read only to join the outcome back.
    """
    has = F.col(attributes[0]).isNotNull()
    names = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(
        F.min_by(
            F.when(has, F.struct(F.col(id_col).alias("id"), *attributes)), F.when(has, F.col(id_col))
        ).alias("donor"),
        F.min(F.when(~has, F.col(id_col))).alias("broken_id"),
    )
    return cut_lineage(names)


def nearest_names(names: DataFrame, k: int = 2, min_length: int = 1) -> DataFrame:
    """For each broken name the nearest name with a donor, then the lowest donor id: (bad, good, donor)."""
    bad = names.filter(F.col("broken_id").isNotNull()).select(F.col("name").alias("bad"))
    good = names.filter(F.col("donor").isNotNull()).select(F.col("name").alias("good"), "donor")
    pairs = edit_distance_pairs(bad, good, "bad", "good", k, min_length)
    best = pairs.groupBy("bad").agg(
        F.min_by(F.struct("good", "donor"), F.struct("distance", F.col("donor.id"))).alias("m")
    )
    return best.select("bad", "m.*")


def typo_match(df: DataFrame, name: str, attributes: Sequence[str], id_col: str = "id",
               k: int = 2, min_length: int = 1) -> DataFrame:
    """Give rows without the first attribute the name and attributes of a near name that has it.

    The donor is the nearest name, then the lowest id.
    """
    best = nearest_names(name_table(df, name, attributes, id_col), k, min_length)
    joined = attach(df, best, F.col(name), "bad")
    take = F.col(attributes[0]).isNull() & F.col("good").isNotNull()
    values = {name: F.col("good")} | {c: F.col("donor")[c] for c in attributes}
    return joined.select(*[
        F.when(take, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns
    ])
