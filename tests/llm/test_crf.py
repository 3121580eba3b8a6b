"""Line labelling against plain counts, all sequences and numeric slopes; held-out accuracy on the given tables."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwell.llm import common, crf, queries
from tests.llm.test_operators import CLASHING, SCHEMA, some_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines, dup = text.split("\n"), 0
    for n, line in enumerate(lines):
        dup += bool(WORD.search(line)) and line in lines[:n]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


ODD = [
    None, "", " \n\t", "a b c d e f g h\n" * 3, "a b c d e f g h", "x " * 30, "é b c\x85d\x1ce 中文 😀 #*$%&|<>", "one\r\none\r\none\n one\n\n\n",
    " ".join(f"w{i % 11}" for i in range(60)), " ".join(f"w{i}" for i in range(200)) + " tail", "a b c d e f g h i " * 2 + "a b c d e f g",
    "\n".join(["same line here"] * 5 + [" ".join("ab"[(i * i) % 7 % 2] for i in range(50))]),
]


def test_base_counts_equal_the_plain_form(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD)] + [r for r in some_rows() if r[0] != 2006]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit("clash") for name in (*CLASHING, "n_words", "kept", "found")})
    got = docs.select("doc_id", "text", crf.judge(F.col("text"), crf.Field(), spark).alias("_v")).collect()
    assert len(got) == len(rows)
    for r in got:
        counts = tuple(r._v)[:5]
        assert counts == plain_counts(r.text)
        assert r._v.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        # a field that learnt nothing calls all lines content
        assert r._v.kept == (not r._v.base_failed) and r._v.content_share == (1.0 if counts[0] else 0.0)


def test_very_long_texts_are_read_whole():
    text = "alpha beta gamma. " * 5 + "\n".join(f"line {i} of a long text" for i in range(60000)) + "\nline 7 of a long text"
    own = crf.read(text)
    assert (own.n_words, own.n_dup_lines, len(own.lines)) == (15 + 6 * 60001, 1, 60001)
    assert own.word_chars == sum(map(len, WORD.findall(text)))


def some_field(seed=1):
    rnd = np.random.default_rng(seed)
    field = crf.Field()
    field.weights, field.steps, field.start = rnd.normal(size=(crf.FEATURES, 2)), rnd.normal(size=(2, 2)), rnd.normal(size=2)
    return field


def score(field, features, labels):
    says = features @ field.weights
    return field.start[labels[0]] + sum(says[i, l] for i, l in enumerate(labels)) + sum(field.steps[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_finds_the_best_of_all_sequences():
    rnd = np.random.default_rng(2)
    for trial in range(40):
        field, features = some_field(trial), rnd.integers(0, 2, (int(rnd.integers(1, 8)), crf.FEATURES))
        best = max(score(field, features, s) for s in itertools.product((0, 1), repeat=len(features)))
        assert score(field, features, list(field.decode(features))) == pytest.approx(best)
    assert list(crf.Field().decode(np.ones((3, crf.FEATURES)))) == [crf.CONTENT] * 3
    assert len(crf.Field().decode(np.ones((0, crf.FEATURES)))) == 0


def test_training_climbs_the_likelihood_of_all_sequences():
    rnd = np.random.default_rng(3)
    texts = [rnd.integers(0, 2, (n, crf.FEATURES)) for n in (1, 4, 3, 6)]
    labels = [rnd.integers(0, 2, len(t)) for t in texts]

    def likelihood(field):
        kinds = [int(l.mean() > 0.5) for l in labels]
        total = 0.0
        for features, own, kind in zip(texts, labels, kinds):
            all_scores = [score(field, features, s) for s in itertools.product((0, 1), repeat=len(own))]
            total += (score(field, features, list(own)) - np.logaddexp.reduce(all_scores)) / (2 * kinds.count(kind) * len(own))
        return total

    before = likelihood(crf.Field())
    field = crf.Field().fit(texts, labels, steps=200)
    assert likelihood(field) > before + 0.3
    # at the end the slope of the likelihood is what the penalty takes
    for at in ((0, 0), (5, 1), (20, 0)):
        moved = crf.Field()
        moved.weights, moved.steps, moved.start = field.weights.copy(), field.steps, field.start
        moved.weights[at] += 1e-4
        slope = (likelihood(moved) - likelihood(field)) / 1e-4
        assert slope == pytest.approx(crf.PENALTY * field.weights[at], abs=5e-3)


def test_lines_are_labelled_in_place(spark):
    good = [" ".join(f"Word{i * 7 % 13}x{j}" for i in range(9)) + "." for j in range(6)]
    menu = ["Home | About | Contact | Login | Cart"] * 4
    texts = [crf.read("\n".join(good[n:] + good[:n])) for n in range(6)] + [crf.read("\n".join(menu + [f"A | {n} | B"])) for n in range(6)]
    field = crf.Field().fit([t.features for t in texts], [np.full(len(t.features), int(n >= 6), np.int8) for n, t in enumerate(texts)])
    docs = spark.createDataFrame([("\n".join(good[:4] + [""] + menu[:2] + ["X | Y | Z | W"]),), (None,)], "text string")
    lines = [r.l for r in docs.select(crf.labelled_lines(F.col("text"), field, spark).alias("l")).collect()]
    assert [x.content for x in lines[0]] == [True] * 4 + [False] * 3 and lines[1] == []
    assert [x.line for x in lines[0]] == good[:4] + menu[:2] + ["X | Y | Z | W"]


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op12_line_labels(spark, folder)
    labels = queries.table(spark, folder, "labels")
    held = found.join(labels, "doc_id").filter(common.is_held_out("doc_id")).filter("NOT base_failed").collect()
    good, bad = [r.kept for r in held if r.quality == 1], [r.kept for r in held if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_nothing_to_learn_from(spark):
    docs, labels = spark.createDataFrame(some_rows(), SCHEMA), spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 7)], "doc_id long, quality int")
    for own, known in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        field = crf.train(own, known)
        assert not field.weights.any()
        assert own.select(crf.judge(F.col("text"), field, spark).alias("v")).count() == own.count()
