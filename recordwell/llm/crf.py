"""Quality rules by labelling the lines of a text with a linear-chain conditional random field.

Every line that holds a word is described by yes/no features (length, symbols, digits, repeated words, how it begins and
ends, whether it or its passages occurred before). The field gives each sequence of labels, content or
boilerplate, a score: what the features of each line say, and what each label says about the next. Viterbi decoding finds the
best sequence of a whole text; the share of its words that stand in content lines decides whether it is kept.

The field is trained here (``train``): conditional likelihood of the lines of a bounded sample of labelled texts, by
forward and backward sums over all sampled texts at once. Lines take the label of their text.

Base rules need no training: words are runs of anything but space, tab and line ends; ``n_dup_lines`` counts lines with a word
that equal an earlier line; ``n_repeat_words`` counts the words that stand in a window of 8 words found twice or more.

Defined results: null and empty texts and texts of separators have no words and fail the base rules. Without a label of
either kind all lines are content. A tie of labels is content. Whole texts are read, however long, one line at a time;
rows that repeat get equal results, an empty table none. Other columns are not looked at.
"""

from __future__ import annotations

import operator
import re
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordwell.llm.common import bounded_sample

#: What separates words: what ``bytes.split`` splits at. All else is done on UTF-8 bytes, too.
SPACES = "\x20\t\n\x0b\x0c\r"
SYMBOLS, DIGITS, CAPITALS = b"#*$%&|<>", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a window that counts as a passage.
PASSAGE = 8
#: Base rules: fewest words, and most words in repeated passages (in 100).
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Share of words in content lines from which a text is kept.
CONTENT_SHARE = 0.5
#: Bounds of the training sample: different texts of each label, bytes of one text.
TEXTS, TEXT_BYTES = 1500, 32768
#: Steps of training, weight of the penalty.
STEPS, PENALTY = 120, 1e-3

CONTENT, BOILERPLATE = 0, 1

#: Steps of shares and counts; each becomes one feature.
_STEPS = {
    "words": (1, 2, 5, 10, 20), "symbols": (0.0, 0.02, 0.1, 0.25), "digits": (0.0, 0.1, 0.3),
    "capitals": (0.0, 0.1, 0.3, 0.6), "calls": (0.0, 0.2, 0.5), "repeated": (0.0, 0.25, 0.5, 0.75), "stutter": (0.0, 0.2, 0.5),
    "passages": (0.0, 0.5), "long": (0.0, 0.1),
}
_FLAGS = ("ends", "capital", "marked", "earlier", "first")
#: Where each step's features start, in the order above; flags follow.
_STARTS = dict(zip(_STEPS, np.cumsum([0, *[len(s) + 1 for s in _STEPS.values()]])))
FEATURES = sum(len(s) + 1 for s in _STEPS.values()) + len(_FLAGS)

_ENDS = tuple(c.encode() for c in ".!?…。！？:;\"'»”)")
_MARKED = re.compile(rb"https?://|www\.|[@\[{\\]|\xc2\xa9")


def repeated_passages(words: Sequence[bytes], size: int = PASSAGE) -> np.ndarray:
    """Which words stand in a window of ``size`` words that is found twice or more (a power of two).

    Windows are named exactly: pairs of words get a number, pairs of those, and so on.
    """
    hit = np.zeros(len(words), bool)
    if len(words) <= size:
        return hit
    numbers = {word: n for n, word in enumerate(set(words))}
    names = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    width = 1
    while width < size:
        both = names[:-width] * (int(names.max()) + 1) + names[width:]
        _, names = np.unique(both, return_inverse=True)
        width *= 2
    _, counts = np.unique(names, return_counts=True)
    starts = np.flatnonzero(counts[names] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return np.cumsum(edges[:-1]) > 0


@dataclass
class Text:
    """A text's base counts and the features of its lines that hold a word."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: list[bytes]
    sizes: np.ndarray
    features: np.ndarray

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def _step(name: str, value: float) -> int:
    return int(_STARTS[name]) + bisect_left(_STEPS[name], value)


def _line_features(line: bytes, words: list[bytes], passages: float, earlier: bool, first: bool) -> list[int]:
    """Numbers of the features that a line has, in the order of ``_STEPS``."""
    n, size = len(words), len(line)
    symbols, digits, capitals = [size - len(line.translate(None, kind)) for kind in (SYMBOLS, DIGITS, CAPITALS)]
    found = [
        _step("words", n), _step("symbols", symbols / size), _step("digits", digits / size),
        _step("capitals", capitals / size), _step("calls", line.count(b"!") / n), _step("repeated", 1 - len(set(words)) / n), _step("stutter", sum(map(operator.eq, words, words[1:])) / n),
        _step("passages", passages), _step("long", sum(map((24).__lt__, map(len, words))) / n),
    ]
    flags = (words[-1].endswith(_ENDS), words[0].decode()[0].isupper(), _MARKED.search(line) is not None, earlier, first)
    at = FEATURES - len(_FLAGS)
    return found + [at + i for i, flag in enumerate(flags) if flag]


def read(text: str | None) -> Text:
    text = text or ""
    whole = text.encode()
    own, lines, seen, duplicates = [], [], set(), 0
    for line in whole.split(b"\n"):
        words = line.split()
        if words:
            earlier = line in seen
            duplicates += earlier
            own.append(words)
            lines.append((line, earlier))
            seen.add(line)
    words = [w for line in own for w in line]
    hit = repeated_passages(words)
    sizes = np.array([len(line) for line in own], np.int64)
    ends = np.cumsum(sizes)
    upto = np.concatenate([[0], np.cumsum(hit)])
    inside = ((upto[ends] - upto[ends - sizes]) / sizes).tolist() if own else []
    features = np.zeros((len(own), FEATURES), np.int8)
    for n, ((line, earlier), line_words) in enumerate(zip(lines, own)):
        features[n, _line_features(line, line_words, inside[n], earlier, n == 0)] = 1
    return Text(len(words), len(text) - sum(map(text.count, SPACES)), len(whole) - len(whole.translate(None, SYMBOLS)), duplicates,
                int(hit.sum()), [line for line, _ in lines], sizes, features)


class Field:
    """Weights of the features, of neighbouring labels and of the first label; a new field calls every line content."""

    def __init__(self) -> None:
        self.weights = np.zeros((FEATURES, 2))
        self.steps = np.zeros((2, 2))
        self.start = np.zeros(2)

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best sequence of labels (Viterbi); of equal ones the one that prefers content from the end on."""
        n = len(features)
        labels = np.zeros(n, np.int8)
        if not n:
            return labels
        says = (features @ self.weights).tolist()
        steps, back = self.steps.tolist(), []
        content, other = self.start[0] + says[0][0], self.start[1] + says[0][1]
        for a, b in says[1:]:
            from_content, from_other = content + steps[0][0], other + steps[1][0]
            to_content, to_other = content + steps[0][1], other + steps[1][1]
            back.append((int(from_other > from_content), int(to_other > to_content)))
            content, other = max(from_content, from_other) + a, max(to_content, to_other) + b
        at = int(other > content)
        for place in range(n - 1, -1, -1):
            labels[place] = at
            if place:
                at = back[place - 1][at]
        return labels

    def content_share(self, text: Text) -> float:
        """Share of the words that stand in content lines; 0 without words."""
        return float(text.sizes[self.decode(text.features) == CONTENT].sum() / max(1, text.n_words))

    def fit(self, texts: Sequence[np.ndarray], labels: Sequence[np.ndarray], steps: int = STEPS, penalty: float = PENALTY) -> Field:
        """Climbs the mean conditional log-likelihood, every text weighing the same and every label as much as the other."""
        order = sorted((n for n in range(len(texts)) if len(texts[n])), key=lambda n: -len(texts[n]))
        texts, labels = [texts[n] for n in order], [labels[n] for n in order]
        sizes = np.array([len(t) for t in texts])
        flat, gold = np.vstack(texts).astype(float), np.concatenate(labels).astype(int)
        begins = np.cumsum([0, *sizes[:-1]])
        longest = int(sizes[0])
        # texts that have a line at each place: sorted by length, so always the first ones
        active = [int(np.searchsorted(-sizes, -place, "left")) for place in range(longest)]
        rows = [begins[:active[p]] + p for p in range(longest)]
        mostly = np.array([label.mean() > 0.5 for label in labels]).astype(int)
        weight = 1 / (2 * np.maximum(1, np.bincount(mostly, minlength=2))[mostly] * sizes)
        line_weight = np.repeat(weight, sizes)
        wanted = np.zeros((len(flat), 2))
        wanted[np.arange(len(flat)), gold] = 1
        gold_start, gold_steps = np.zeros(2), np.zeros((2, 2))
        np.add.at(gold_start, gold[begins], weight)
        inner = np.setdiff1d(np.arange(len(flat)), begins)
        np.add.at(gold_steps, (gold[inner - 1], gold[inner]), line_weight[inner])
        parameters = [self.weights, self.steps, self.start]
        first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
        for step in range(1, steps + 1):
            says = flat @ self.weights
            forward, backward = np.empty_like(says), np.zeros_like(says)
            forward[rows[0]] = self.start + says[rows[0]]
            for p in range(1, longest):
                forward[rows[p]] = np.logaddexp.reduce(forward[rows[p] - 1][:, :, None] + self.steps, axis=1) + says[rows[p]]
            for p in range(longest - 2, -1, -1):
                here = rows[p][:active[p + 1]]
                backward[here] = np.logaddexp.reduce(self.steps + (says[here + 1] + backward[here + 1])[:, None, :], axis=2)
            total = np.repeat(np.logaddexp.reduce(forward[begins + sizes - 1], axis=1), sizes)
            chance = np.exp(forward + backward - total[:, None])
            pairs = np.exp(forward[inner - 1][:, :, None] + self.steps + (says[inner] + backward[inner])[:, None, :] - total[inner][:, None, None])
            slopes = [
                flat.T @ ((wanted - chance) * line_weight[:, None]) - penalty * self.weights,
                gold_steps - (pairs * line_weight[inner][:, None, None]).sum(axis=0) - penalty * self.steps,
                gold_start - (chance[begins] * weight[:, None]).sum(axis=0) - penalty * self.start,
            ]
            for p, slope, m, v in zip(parameters, slopes, first, second):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope ** 2 - v)
                p += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    texts: int = TEXTS, text_bytes: int = TEXT_BYTES,
) -> Field:
    """A field learnt from at most ``texts`` different texts of each label (1 good, 0 bad) of up to ``text_bytes`` bytes.

    Rows labelled otherwise teach nothing; several labels of a document each count.
    """
    asked = labels.select(F.col(key).alias(key), F.col(label).cast("int").alias("_good")).filter("_good IN (0, 1)")
    sample = bounded_sample(docs, "_good", text, texts, text_bytes, asked, key).toPandas().sort_values(["hash", "label"])
    field = Field()
    if sample["label"].nunique() < 2:
        return field
    own = [read(t) for t in sample["text"]]
    if not any(t.n_words for t in own):
        return field
    return field.fit([t.features for t in own], [
        np.full(len(t.features), CONTENT if good == 1 else BOILERPLATE, np.int8) for t, good in zip(own, sample["label"])])


#: The columns that ``judge`` gives.
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "content_share double"
)


def judge(text: Column, field: Field, spark: SparkSession, least: float = CONTENT_SHARE) -> Column:
    """Base counts, base rules and verdict of a text: a struct of ``SCHEMA``."""
    model = spark.sparkContext.broadcast(field)

    @F.pandas_udf(SCHEMA)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for value in texts:
            own = read(value if isinstance(value, str) else None)
            share = model.value.content_share(own)
            out.append((own.n_words, own.word_chars, own.n_symbols, own.n_dup_lines, own.n_repeat_words, own.base_failed,
                        not own.base_failed and share >= least, share))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return verdict(text)


def labelled_lines(text: Column, field: Field, spark: SparkSession) -> Column:
    """The lines of a text that hold a word, in order, each with whether it is content."""
    model = spark.sparkContext.broadcast(field)

    @F.pandas_udf("array<struct<line:string,content:boolean>>")
    def label(texts: pd.Series) -> pd.Series:
        out = []
        for value in texts:
            own = read(value if isinstance(value, str) else None)
            out.append([{"line": line.decode(), "content": bool(mark == CONTENT)} for line, mark in zip(own.lines, model.value.decode(own.features))])
        return pd.Series(out, dtype=object)

    return label(text)
