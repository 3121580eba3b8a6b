"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of 0 to ``ORDER`` bytes with the counts of what followed.
A byte is coded at the longest context that was seen; where the byte did not follow it, an escape is
coded and the next shorter context is asked (escape method C, no exclusions; below order 0 every byte
costs 8 bits). Statistics are frozen after training, so a text's code length in a language is a sum
over its bytes, and the language with the shortest code wins.

The trees are held as sorted arrays: the path of a node is its key, and one row has the code lengths
of all languages, so a text is scored for all of them in one walk.

Training reads a bounded sample (documented in ``train``). Defined results: null texts and texts
without a letter are ``und`` with score 0; ties go to the language that sorts first; with nothing to
learn from every text is ``und``. Whole texts are scored, one after the other as they come out of the
Arrow batch and in slices of bounded memory. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordwell.llm.common import bounded_sample

#: Longest context in bytes.
ORDER = 4
#: Bound of the training sample: whole texts per language, and bytes of one text.
TEXTS, TEXT_BYTES = 200, 32768
#: Bytes scored at once.
SLICE = 1 << 18
UNKNOWN = "und"


def paths(data: bytes | np.ndarray, order: int) -> np.ndarray:
    """Per byte: the ``order`` bytes before it (zeros before the text) and the byte, as one number."""
    values = np.concatenate([np.zeros(order, np.uint8), np.frombuffer(data, np.uint8)]).astype(np.uint64)
    count = len(values) - order
    out = np.zeros(count, np.uint64)
    for j in range(order + 1):
        out = (out << np.uint64(8)) | values[j:j + count]
    return out


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (8 * (order + 1))) - 1)


class Trees:
    """Code lengths in bits for every language, from counts (language, order, path, count)."""

    def __init__(self, languages: list[str], counts: pd.DataFrame, order: int = ORDER):
        self.languages, self.order = languages, order
        self.paths, self.bits, self.contexts, self.escapes = [], [], [], []
        number = {name: i for i, name in enumerate(languages)}
        for k in range(order + 1):
            own = counts[counts["order"] == k]
            path = own["path"].to_numpy().astype(np.uint64)
            known, place = np.unique(path, return_inverse=True)
            seen = np.zeros((len(known), len(languages)))
            seen[place, own["language"].map(number).to_numpy(np.int64)] = own["count"].to_numpy()
            context, first, node = np.unique(known >> np.uint64(8), return_index=True, return_inverse=True)
            total = np.add.reduceat(seen, first, axis=0) if len(known) else seen
            kinds = np.add.reduceat((seen > 0).astype(float), first, axis=0) if len(known) else seen
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                coded = -np.log2(seen / (total + kinds)[node])
            lower = self.code(known & _mask(k - 1), k - 1) if k else np.full(seen.shape, 8.0)
            self.paths.append(known)
            self.contexts.append(context)
            self.escapes.append(escape)
            self.bits.append(np.where(seen > 0, coded, escape[node] + lower))

    def code(self, path: np.ndarray, k: int | None = None) -> np.ndarray:
        """Bits of the last byte of each path after the bytes before it: one column per language."""
        k = self.order if k is None else k
        if k < 0:
            return np.full((len(path), len(self.languages)), 8.0)
        out = np.zeros((len(path), len(self.languages)))
        at = np.minimum(np.searchsorted(self.paths[k], path), max(0, len(self.paths[k]) - 1))
        found = self.paths[k][at] == path if len(self.paths[k]) else np.zeros(len(path), bool)
        out[found] = self.bits[k][at[found]]
        if not found.all():
            rest = path[~found]
            context = rest >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), max(0, len(self.contexts[k]) - 1))
            bits = self.code(rest & _mask(k - 1) if k else rest, k - 1)
            if len(self.contexts[k]):
                bits = bits + np.where((self.contexts[k][at] == context)[:, None], self.escapes[k][at], 0.0)
            out[~found] = bits
        return out

    def code_lengths(self, texts: Iterable[bytes]) -> np.ndarray:
        """Bits of each text in each language; texts are read once and coded in slices of bounded size."""
        owners: list[int] = []
        sums = [np.zeros((0, len(self.languages)))]
        batch: list[tuple[int, np.ndarray]] = []
        size = count = 0

        def flush() -> None:
            nonlocal size
            if batch:
                numbers, unique = pd.factorize(np.concatenate([p for _, p in batch]))
                bits = self.code(unique)[numbers]
                starts = np.cumsum([0, *[len(p) for _, p in batch[:-1]]])
                owners.extend([i for i, _ in batch])
                sums.append(np.add.reduceat(bits, starts, axis=0))
            batch.clear()
            size = 0

        for i, text in enumerate(texts):
            count += 1
            for at in range(0, len(text), SLICE):
                before = text[max(0, at - self.order):at]
                part = paths(before + text[at:at + SLICE], self.order)[len(before):]
                batch.append((i, part))
                size += len(part)
                if size >= SLICE:
                    flush()
        flush()
        out = np.zeros((count, len(self.languages)))
        np.add.at(out, np.array(owners, np.int64), np.concatenate(sums))
        return out

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability (equal priors) of each text; texts are read once."""
        if not self.languages:
            unknown = [UNKNOWN for _ in texts]
            return unknown, np.zeros(len(unknown))
        spoken: list[bool] = []

        def letters() -> Iterator[bytes]:
            for text in texts:
                spoken.append(bool(text) and any(map(str.isalpha, text)))
                yield text.encode() if spoken[-1] else b""

        bits = self.code_lengths(letters())
        best = bits.argmin(axis=1)
        # minus, and at most 1000 bits behind, so that nothing overflows
        behind = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
        score = np.where(spoken, 1.0 / np.exp2(-behind).sum(axis=1), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), spoken)], score


def train(
    rows: DataFrame, text: str = "text", language: str = "lang", order: int = ORDER,
    texts: int = TEXTS, text_bytes: int = TEXT_BYTES,
) -> Trees:
    """Trees from at most ``texts`` whole texts per language, none above ``text_bytes`` bytes.

    Spark counts the paths; the counts that come to the driver are bounded by the sample:
    languages x texts x text_bytes x (order + 1) at the very most, in practice far fewer.
    """
    sample = bounded_sample(rows, language, text, texts, text_bytes)

    def count(own: pd.DataFrame) -> pd.DataFrame:
        known, n = np.unique(np.concatenate([paths(t.encode(), order) for t in own["text"]]), return_counts=True)
        found = []
        for k in range(order, -1, -1):  # the paths of an order are sums over those of the next longer
            known, place = np.unique(known & _mask(k), return_inverse=True)
            n = np.bincount(place, n).astype(np.int64)
            found.append((k, known, n))
        return pd.concat([
            pd.DataFrame({"language": own["label"].iloc[0], "order": k, "path": path.astype(np.int64), "count": n}) for k, path, n in found])

    # a language's group has at most ``texts`` texts
    counts = sample.groupBy("label").applyInPandas(count, "language string, order int, path long, count long").toPandas()
    return Trees(sorted(counts["language"].unique()), counts, order)


def languages(text: Column, trees: Trees, spark) -> Column:
    """Struct (lang, score) of a text column."""
    model = spark.sparkContext.broadcast(trees)

    @F.arrow_udf("lang string, score double")
    def predict(values: pa.Array) -> pa.Array:
        lang, score = model.value.predict(v.as_py() for v in values)
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    return predict(text)
