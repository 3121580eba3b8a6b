"""Arrays and quoted files cut anywhere, next to the standard library's readers."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from recordwell.sources import splits
from recordwell.sources.readers import ORDER


def cut_in_chunks(grammar, text, size):
    """The pieces of a text that is cut into chunks of ``size``, put together as the reader does."""
    state, depth, record, found = 0, 0, 0, {}
    for at in range(0, len(text), size):
        own = text[at:at + size]
        for n, piece in enumerate(grammar.cut(own, state, depth)):
            found[record + n] = found.get(record + n, "") + piece
        scan = grammar.scan(own, state)
        record += sum(c for d, c in scan.cuts.items() if depth + d == grammar.level)
        state, depth = scan.end, depth + scan.deeper
    return [found[n] for n in sorted(found)], (state, depth)


ITEMS = [{"a": 'x "]" \\ , {', "b": [1, [2, {"c": "}"}]]}, 3, "s, \\\"[", None, [1, {"a": 2}], {}, {"é": "\n\\", "d": {"e": ","}}, "", True]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 1000])
def test_arrays_cut_anywhere_give_their_items(size):
    for indent in (None, 1):
        text = " " + json.dumps(ITEMS, indent=indent, ensure_ascii=False) + "\n"
        pieces, end = cut_in_chunks(splits.JsonArray, text, size)
        assert [json.loads(p) for p in pieces] == ITEMS and end == (splits.OUTSIDE, 0)
    assert cut_in_chunks(splits.JsonArray, '[{"a": "b', size)[1] != (splits.OUTSIDE, 0)
    assert [p.strip() for p in cut_in_chunks(splits.JsonArray, "[ ]", size)[0]] == [""]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 1000])
def test_quoted_text_cut_anywhere_gives_its_records(size):
    rnd = random.Random(size)
    rows = [["".join(rnd.choice('ab,"\n') for _ in range(rnd.randint(0, 6))) for _ in range(3)] for _ in range(40)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    pieces, end = cut_in_chunks(splits.QuotedLines, out.getvalue(), size)
    assert [next(csv.reader(io.StringIO(p, newline=""))) for p in pieces[:-1]] == rows and pieces[-1] == "" and end[0] == splits.OUTSIDE


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4096")
    yield
    spark.conf.set(name, before)


def test_one_array_is_read_by_several_tasks(spark, tmp_path, small_splits):
    items = [x for i in range(900) for x in ({"ID": i, "NOM": f'n {i} "],[{{" \\ é', "x": {"ID": 7}, "y": [i]}, i, "ID", None)]
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(json.dumps(items, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "broken.json").write_text('[{"ID": 1}, {"ID": "2}]', encoding="utf-8")
    (tmp_path / "object.json").write_text('{"ID": 1, "NOM": {"ID": 4}}', encoding="utf-8")
    (tmp_path / "empty.json").write_text("", encoding="utf-8")
    df = splits.read_json_array(spark, str(tmp_path), ["ID", "NOM"], with_order=True, chunk=700)
    got = df.orderBy(ORDER).collect()
    assert [(r.ID, r.NOM) for r in got] == [(str(i), f'n {i} "],[{{" \\ é') for i in range(900)] * 2
    chunks = splits._chunks(spark, str(tmp_path / "a.json"), splits.JsonArray, 700)
    assert chunks.select("place").distinct().count() > 5
    assert chunks.agg(F.max(F.length("text"))).first()[0] < 1500
    assert "".join(r.text for r in chunks.orderBy("place", "n").collect()) == (tmp_path / "a.json").read_text(encoding="utf-8")


def test_files_with_breaks_in_quotes_marks_and_preambles(spark, tmp_path, small_splits):
    rows = [(str(i), f'line one\nline "two" {i},\r\n\n' * (i % 5), "N/A" if i % 3 else f"é{i}") for i in range(700)]
    for n, order in enumerate(((0, 1, 2), (2, 0, 1))):
        out = io.StringIO()
        names = ("Région", "texte", "note")
        writer = csv.writer(out, lineterminator="\r\n")
        writer.writerow([names[c] for c in order])
        writer.writerows([[row[c] for c in order] for row in rows])
        (tmp_path / f"{n}.csv").write_bytes(("﻿Liste, \"officielle\"\r\n\r\n;source\r\n" + out.getvalue()).encode())
    df = splits.read_csv_splits(spark, str(tmp_path), ("Région",), columns=("Région", "texte", "note"), with_order=True, chunk=900)
    got = [(r["Région"], r.texte, r.note) for r in df.orderBy(ORDER).collect()]
    assert got == [(a, b or None, None if c == "N/A" else c) for a, b, c in rows] * 2
    chunks = splits._chunks(spark, str(tmp_path / "0.csv"), splits.QuotedLines, 900)
    assert chunks.select("place").distinct().count() > 5 and chunks.agg(F.max(F.length("text"))).first()[0] < 2000


def test_files_without_a_header_word_or_rows(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("\n\na,a\n1,2\n3\n4,5,6\n", encoding="utf-8")
    df = splits.read_csv_splits(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["a", "a.1"] and rows(df) == [("1", "2"), ("3", None), ("4", "5")]
    (tmp_path / "head.csv").write_text("a,b\n", encoding="utf-8")
    assert splits.read_csv_splits(spark, str(tmp_path / "head.csv")).count() == 0
    none = splits.read_csv_splits(spark, str(tmp_path / "none.csv"), columns=("x",), with_order=True)
    assert none.columns == ["x", ORDER] and none.count() == 0
    assert splits.read_json_array(spark, str(tmp_path / "none.json"), ["x"]).columns == ["x"]
