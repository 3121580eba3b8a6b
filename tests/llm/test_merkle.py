"""The manifest against a plain recursive tree: many rounds, odd runs, nulls, repeated rows, tampering."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from recordwell.llm import merkle
from tests.llm.test_operators import CLASHING, SCHEMA, some_rows


def plain_leaf(row):
    def one(value):
        if value is None:
            return "-"
        return f"{len(str(value).encode())}:{value}"
    doc_id, text, lang, source, n_chars = row[:5]
    return hashlib.sha256("".join(one(v) for v in (doc_id, source, lang, n_chars, text)).encode()).hexdigest()


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([hashlib.sha256("".join(last[i:i + 3]).encode()).hexdigest() for i in range(0, len(last), 3)])
    return levels


def plain_witness(levels, at):
    found = []
    for level in levels[:-1]:
        start = at - at % 3
        found += [n for i, n in enumerate(level[start:start + 3], start) if i != at]
        at //= 3
    return found


def plain_manifest(rows):
    """(doc_id, source, leaf, subroot, root, witness) of every row."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[3]].append(((row[0] is not None, row[0] or 0, plain_leaf(row)), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: (sorted(groups[s], key=lambda r: r[0]), None) for s in order}
    built = {s: (members, plain_levels([m[0][2] for m in members])) for s, (members, _) in built.items()}
    forest = plain_levels([built[s][1][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        members, levels = built[s]
        for at, (key, row) in enumerate(members):
            witness = plain_witness(levels, at) + plain_witness(forest, place)
            out.append((row[0], s, key[2], levels[-1][0], forest[-1][0], "".join(witness)))
    return sorted(out, key=repr)


def found_manifest(frame):
    hexed = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "witness")]
    return sorted((tuple(r) for r in frame.select("key", "source", *hexed).collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_witnesses_equal_the_plain_tree(spark, height):
    rows = some_rows() + [(5000 + i, "line\nbreak " * (i % 4), "en", "large", i) for i in range(120)]
    rows += [(9000 + i, f"text {i}", "en", f"source {i}", i) for i in range(14)] + [(1, "", "", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit("clash") for name in CLASHING}).withColumns(
        {name: F.lit("clash") for name in ("tree", "node", "position", "witness", "root", "block", "found", "_range")})
    assert found_manifest(merkle.manifest(docs, height=height)) == plain_manifest(rows)


def test_leaves_and_witnesses_lead_to_the_root_and_tampered_ones_do_not(spark):
    rows = [(i, f"a\nb {i}" if i % 2 else f"ab {i}", "en", f"s{i % 3}", i) for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    altered = F.unhex(merkle.leaf([F.translate("text", "\n", "") if f == "text" else F.col(f) for f in merkle.FIELDS]))
    sealed = merkle.manifest(docs, height=1, altered=altered)
    honest = merkle.folded(sealed, F.col("leaf")).collect()
    assert len(honest) == 50 and all(r.folded_root == r.root for r in honest)
    forged = merkle.folded(sealed, F.col("altered")).collect()
    assert all((r.folded_root == r.root) == (r.key % 2 == 0) for r in forged)


def test_rows_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(some_rows(), SCHEMA)
    assert found_manifest(merkle.manifest(docs.repartition(1), height=1)) == found_manifest(merkle.manifest(docs.repartition(13, "text"), height=1))


def test_single_rows_and_nothing(spark):
    alone = merkle.manifest(spark.createDataFrame([(None, None, None, None, None)], SCHEMA)).collect()
    assert [(r.key, r.leaf, r.root, bytes(r.witness)) for r in alone] == [(None, alone[0].leaf, alone[0].leaf, b"")]
    nothing = spark.createDataFrame([], SCHEMA)
    assert merkle.folded(merkle.manifest(nothing), F.col("leaf")).count() == 0


def test_appends_extend_the_witnesses_of_open_runs():
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(30)]
    for n in range(1, 31):
        appender = merkle.Appender()
        for node in nodes[:n]:
            appender.append(node)
        levels = plain_levels([node.hex() for node in nodes[:n]])
        # before the end a leaf knows the siblings of closed runs only
        assert all(plain_witness(levels, at)[:1] == [] or b"".join(w).hex() == "".join(plain_witness(levels, at))[:64 * len(b"".join(w)) // 32]
                   for at, w in enumerate(appender.witness))
        assert appender.close(None).hex() == levels[-1][0]
        for at in range(n):
            witness = b"".join(appender.witness[at])
            assert witness.hex() == "".join(plain_witness(levels, at))
            assert merkle.fold(nodes[at], witness, (at, n)).hex() == levels[-1][0]
