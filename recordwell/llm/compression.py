"""Toxicity by compression distance.

zstandard trains two dictionaries apart, one on toxic and one on ordinary text. A text is read in windows, a word with its
spaces each; what the ordinary dictionary needs more than the toxic one to compress a window, in bytes, is its
gain. How much a gain is worth is calibrated on labelled texts that trained neither dictionary: the logarithm of how much more
often toxic text has it, made rising. A text's evidence is its best stretch: the highest sum of worths, less ``DRIFT`` a
window, over neighbouring windows. It does not add up over long ordinary text, so a short toxic passage counts
as much in 100 kB as alone. A logistic curve over the evidence, weighted by the share of toxic labels, gives the score.

A toxic text is mostly ordinary prose, and a trainer takes what is frequent. So both dictionaries are trained in rounds: texts are
dealt into folds, dictionaries from the other folds compress a fold's windows, and the windows whose gain, among windows of
their length, is most a toxic text's, toxic and ordinary alike, are what the next round trains on (a short word cannot gain much,
so the highest gains alone would leave it out). The toxic dictionary comes to hold what sets toxic text apart, the ordinary one
what merely looks like it. Passages that several sampled texts share count once.

zstandard stores very short inputs as they are, so a window is compressed three times over; the gain is that of its first time.
Words longer than ``WINDOW`` bytes, as in scripts without spaces, are several windows that overlap by half.

Training reads a bounded sample (``train``). Defined results: null and empty texts and texts without a letter have no
window and get the score of no evidence; with only one label, or none, to learn from, every score is the share of
toxic labels (0 without labels). Equal texts have equal scores. Whole texts are scored. Other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordwell.llm.common import bounded_sample

#: Most bytes of a window, and how often it is compressed over.
WINDOW, TIMES = 24, 3
#: Rounds of training: bytes of the dictionaries, share of the windows that the next round trains on; bytes of the last ones.
ROUNDS, KEPT = ((65536, 0.2), (32768, 0.1), (32768, 0.05), (16384, 0.02)), 8192
#: Folds of the texts that train, and one part in so many that calibrates instead.
FOLDS, CALIBRATES = 3, 4
#: Bytes of the segments that the trainer picks and of the sequences it counts, windows of a training sample.
SEGMENT, SEQUENCE, TOGETHER = 12, 6, 8
#: Training compares windows of these many bytes and up to the next, and those below the first.
LENGTHS = np.array([4, 5, 6, 7, 8, 9, 11, 14])
#: Words of a passage that is counted once.
PASSAGE = 4
#: Gains outside are counted as the nearest one inside.
LEAST_GAIN, MOST_GAIN = -8, 14
#: What every window costs a stretch, and the most evidence there is.
DRIFT, MOST_EVIDENCE = 0.2, 20.0
#: Bounds of the training sample: different texts of each label, bytes of one text.
TEXTS, TEXT_BYTES = 2000, 32768
#: Gains that a task remembers.
REMEMBERED = 1 << 18

WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def windows(text: str | None) -> list[bytes]:
    """The words of the text, lower-cased; long ones in overlapping parts that cover them."""
    out = []
    for word in WORD.findall((text or "").lower().encode()):
        if len(word) <= WINDOW:
            out.append(word)
        else:
            out += [word[i:i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]
    return out


def once(texts: list[list[bytes]]) -> list[list[bytes]]:
    """The texts' windows without those in a passage that an earlier text holds."""
    seen: set[tuple[bytes, ...]] = set()
    out = []
    for own in texts:
        passages = [tuple(own[i:i + PASSAGE]) for i in range(len(own) - PASSAGE + 1)]
        known = {j for i, passage in enumerate(passages) if passage in seen for j in range(i, i + PASSAGE)}
        seen.update(passages)
        out.append([window for i, window in enumerate(own) if i not in known])
    return out


def trained(own: list[bytes], size: int) -> bytes:
    """A dictionary trained on windows, neighbours together."""
    samples = [b" " + b" ".join(own[i:i + TOGETHER]) + b" " for i in range(0, len(own), TOGETHER)]
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=SEQUENCE, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples to train on: the samples themselves
        return b"".join(samples)[-size:] or b" " * 8


class Gain:
    """Bytes that one dictionary saves over the other, by window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.dictionaries = (toxic, ordinary)
        self._open()

    def _open(self) -> None:
        self._remembered: dict[bytes, int] = {}
        options = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=15, hash_log=15, search_log=4, min_match=3, target_length=32,
            strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False)
        compressors = []
        for content in self.dictionaries:
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
            data.precompute_compress(compression_params=options)
            compressors.append(zstandard.ZstdCompressor(compression_params=options, dict_data=data))
        self._toxic, self._ordinary = compressors

    def __getstate__(self) -> tuple[bytes, bytes]:
        return self.dictionaries

    def __setstate__(self, state: tuple[bytes, bytes]) -> None:
        self.dictionaries = state
        self._open()

    def measured(self, window: bytes) -> int:
        whole = (b" " + window) * TIMES + b" "
        gain = len(self._ordinary.compress(whole)) - len(self._toxic.compress(whole))
        return min(max(gain, LEAST_GAIN), MOST_GAIN)

    def of(self, own: list[bytes]) -> np.ndarray:
        known = self._remembered
        if len(known) > REMEMBERED:
            known.clear()
        for window in set(own):
            if window not in known:
                known[window] = self.measured(window)
        return np.fromiter(map(known.__getitem__, own), np.int64, len(own))


def _cells(gain: Gain, own: list[bytes]) -> np.ndarray:
    """The class of length and the gain of every window, as one number."""
    lengths = np.searchsorted(LENGTHS, np.fromiter(map(len, own), np.int64, len(own)), side="right")
    return lengths * (MOST_GAIN - LEAST_GAIN + 1) + gain.of(own) - LEAST_GAIN


def _most_toxic(gain: Gain, kinds: list[list[bytes]], share: float) -> list[list[bytes]]:
    """Of the toxic and the ordinary windows the share that looks most toxic by length and gain, in order."""
    cells = [_cells(gain, own) for own in kinds]
    shape = len(LENGTHS) + 1, MOST_GAIN - LEAST_GAIN + 1
    bad, good = (np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape) / max(1, len(cell)) for cell in cells)
    half = 0.5 / max(1, len(kinds[0]))
    looks = np.concatenate([
        rising(np.log(a + half) - np.log(b + half), a + b + 1e-9) for a, b in zip(bad, good)
    ])
    orders = [np.argsort(-looks[cell], kind="stable")[:int(len(cell) * share)] for cell in cells]
    return [[own[i] for i in np.sort(order)] for own, order in zip(kinds, orders)]


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Gain:
    """The two dictionaries, from the windows of toxic and of ordinary texts."""
    folds = [[texts[i::FOLDS] for i in range(FOLDS)] for texts in (toxic, ordinary)]
    chosen = [[[w for text in fold for w in text] for fold in kind] for kind in folds]
    for size, share in ROUNDS:
        following = [[], []]
        for i in range(FOLDS):
            gain = Gain(*[trained([w for j, fold in enumerate(kind) if j != i for w in fold], size) for kind in chosen])
            own = [[w for text in kind[i] for w in text] for kind in folds]
            for kind, found in enumerate(_most_toxic(gain, own, share)):
                following[kind].append(found)
        if not all(any(kind) for kind in following):
            break
        chosen = following
    return Gain(*[trained([w for fold in kind for w in fold], KEPT) for kind in chosen])


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest values that never fall (neighbours that do are pooled)."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            last, before = pools.pop(), pools.pop()
            weight = before[1] + last[1]
            pools.append([(before[0] * before[1] + last[0] * last[1]) / weight, weight, before[2] + last[2]])
    return np.concatenate([np.full(count, value) for value, _, count in pools])


def best_stretch(worths: np.ndarray) -> float:
    """The highest sum of neighbouring worths, each less the drift; 0 for none."""
    if not len(worths):
        return 0.0
    sums = np.cumsum(worths - DRIFT)
    before = np.minimum.accumulate(np.concatenate([[0.0], sums[:-1]]))
    return float(min(max(0.0, (sums - before).max()), MOST_EVIDENCE))


def _bent(evidence):
    """Evidence as the curve sees it: the first windows say most."""
    return evidence / (evidence + 2)


class Distance:
    """The two dictionaries, what gains are worth, and the curve from evidence to score."""

    def __init__(self, toxic: list[str], ordinary: list[str], toxic_share: float):
        self.share = toxic_share
        self.trained = bool(toxic and ordinary)
        if not self.trained:
            return
        own = [[windows(t) for t in texts] for texts in (toxic, ordinary)]
        fresh = once([*own[0], *own[1]])
        fresh = [fresh[:len(toxic)], fresh[len(toxic):]]

        def parted(texts: list) -> tuple[list, list]:
            """The texts that train and those that calibrate; too few do both."""
            held = texts[CALIBRATES - 1::CALIBRATES]
            return [t for n, t in enumerate(texts) if n % CALIBRATES != CALIBRATES - 1], held or texts

        self.gain = dictionaries(*[parted(texts)[0] for texts in fresh])
        counts = [
            sum((np.bincount(self.gain.of(t) - LEAST_GAIN, minlength=MOST_GAIN - LEAST_GAIN + 1) for t in parted(texts)[1]),
                np.full(MOST_GAIN - LEAST_GAIN + 1, 0.5))
            for texts in fresh
        ]
        self.worth = rising(np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum()), counts[0] + counts[1])
        bad, good = ([self.evidence(t) for t in parted(texts)[1]] for texts in own)
        label = np.array([1.0] * len(bad) + [0.0] * len(good))
        weight = np.where(label == 1, toxic_share / len(bad), (1 - toxic_share) / len(good)) * len(label)
        self.curve = _logistic(_bent(np.array([*bad, *good]))[:, None], label, weight)

    def evidence(self, own: list[bytes]) -> float:
        return best_stretch(self.worth[self.gain.of(own) - LEAST_GAIN])

    def score(self, text: str | None) -> float:
        if not self.trained:
            return self.share
        return float(1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * _bent(self.evidence(windows(text)))))))


def _logistic(rows: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton's steps: intercept first."""
    design = np.hstack([np.ones((len(rows), 1)), rows])
    penalty = ridge * weight.sum() * np.array([0.0] + [1.0] * rows.shape[1])
    at = np.zeros(design.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-design @ at))
        slope = design.T @ (weight * (chance - label)) + penalty * at
        bend = (design * (weight * chance * (1 - chance))[:, None]).T @ design + np.diag(penalty + 1e-6)
        at = at - np.linalg.solve(bend, slope)
    return at


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    texts: int = TEXTS, text_bytes: int = TEXT_BYTES,
) -> Distance:
    """Dictionaries and calibration from at most ``texts`` different texts of each label.

    The share of toxic labels is counted over all labelled rows. Rows labelled otherwise than 0 or 1,
    and rows of ``labels`` without a document, teach nothing; several labels of a document each count.
    """
    asked = labels.select(F.col(key).alias(key), F.col(label).cast("int").alias("_toxic")).filter("_toxic IN (0, 1)")
    own = docs.select(F.col(key).alias("_own"))
    counts = dict(asked.join(own, F.col(key) == F.col("_own"), "left_semi").groupBy("_toxic").count().collect())
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    sample = bounded_sample(docs, "_toxic", text, texts, text_bytes, asked, key).toPandas().sort_values("hash")
    return Distance(
        sample.loc[sample["label"] == 1, "text"].tolist(), sample.loc[sample["label"] == 0, "text"].tolist(), share,
    )


def toxicity(text: Column, distance: Distance, spark: SparkSession) -> Column:
    """The score of a text column, 0 to 1."""
    model = spark.sparkContext.broadcast(distance)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.value.score(t if isinstance(t, str) else None) for t in texts], dtype=float)

    return score(text)
