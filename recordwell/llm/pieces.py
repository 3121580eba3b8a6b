"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice has an edge for every piece of the vocabulary that spells a stretch of the text. The
search keeps, for the last ``longest piece`` positions only, the best way to reach them. Whenever
all surviving ways go back through one boundary, the ids before it are committed and forgotten, so
memory is bounded however long the text is.

Two kinds of vocabulary: ``unigram`` adds the pieces' scores. ``bpe`` scores are ranks of merges, whose
sum means nothing; there a way survives only if every two neighbouring pieces are what merging their
joined text gives again. Exactly one way to each position does, and it is the one that merging the
whole text gives, so ids equal those of the SentencePiece library.

Spaces become the visible mark, one is put in front of the text, and characters without a piece are
written as byte pieces (or the unknown id where the vocabulary has none). Where no piece of
the vocabulary crosses (before marks, at line ends, between letters and others) all ways share a
boundary beforehand, so the words between are searched by themselves; a bounded memo keeps frequent ones.

Defined results: null and empty texts give no ids and decode to an empty text. Decoding drops the
mark in front and gives back every text that holds no mark of its own (and no unknown character where
bytes are lacking); ``lossless`` says whether it did. Unknown, negative or null ids decode to nothing.
Other columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, SparkSession, functions as F

#: The visible mark for a space: a fixed property of the format.
MARK = "▁"
#: Letters of Latin scripts, as a range for patterns.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Words and pairs remembered by one worker. A full memo of words is kept as the older one; words
#: asked again move to the new one.
MEMO = 200_000
#: No piece yet; numbers below it stand for characters without a piece.
NONE = -1


class Pieces:
    """A vocabulary with its search. ``kind`` is ``bpe`` or ``unigram``."""

    def __init__(self, model: bytes, kind: str = "bpe"):
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = own.get_piece_size()
        #: Whether scores add up along a way.
        self.adds = kind == "unigram"
        self.id, self.score, self.byte, self.piece, self.spelt = {}, {}, {}, [], []
        #: Pieces by their characters: a character leads to (the next level, the number of the piece
        #: that ends there or none).
        self.tree: dict = {}
        for i in range(size):
            piece = own.id_to_piece(i)
            self.piece.append(piece)
            if own.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                self.spelt.append(bytes([int(piece[1:-1], 16)]))
            elif own.is_control(i) or own.is_unknown(i) or own.is_unused(i):
                self.spelt.append(b"")
            else:
                self.id[piece] = i
                self.score[i] = own.get_score(i)
                self.spelt.append(piece.replace(MARK, " ").encode())
                level = self.tree
                for character in piece:
                    above, level = level, level.setdefault(character, ({}, NONE))[0]
                above[piece[-1]] = (level, i)
        self.single = {p for p in self.id if len(p) == 1}
        self.unknown = own.unk_id()
        self.longest = max(map(len, self.id), default=1)
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        self.words = self._words()
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def _words(self) -> Callable[[str], list[str]]:
        """Cuts a text where no piece of this vocabulary can cross: marks, line ends, letters from others."""
        joints = {pair for p in self.id for pair in zip(p, p[1:])}
        if any(a != MARK and b == MARK for a, b in joints):
            return lambda text: [text]
        line = "" if any("\n" in joint for joint in joints) else "\n"
        letter = re.compile(f"[{LATIN}]").match
        if any(a != MARK and bool(letter(a)) != bool(letter(b)) for a, b in joints):
            word = f"[^{MARK}{line}]+"
        else:
            word = f"[{LATIN}]+|{MARK}*[^{LATIN}{MARK}{line}]+"
        return re.compile(f"{MARK}*{word}|{MARK}+" + (f"|{line}" if line else "")).findall

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                number = self.id.get(parts[i] + parts[i + 1])
                if number is not None and (best is None or self.score[number] > best):
                    best, at = self.score[number], i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def survives(self, left: int, right: int) -> bool:
        """Whether the two pieces are what merging their joined text gives.

        Without a left piece the right one must be what merging its own text gives; a character
        without a piece never merges.
        """
        pair = left * len(self.spelt) + right
        known = self.pairs.get(pair)
        if known is None:
            parts = [self.piece[i] for i in (left, right) if i >= 0]
            known = self.merged("".join(parts)) == parts
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            self.pairs[pair] = known
        return known

    def _advance(
        self, window: str, last: list[int | None], came: list[int], score: list[float], start: int, stop: int,
    ) -> None:
        """Extend the ways to the positions from ``start`` to ``stop`` by every piece that begins there.

        Of the best way to a position, ``last`` has the piece that ends there and ``came`` where it begins.
        """
        more = len(window) + 1 - len(last)
        last += [None] * more
        came += [0] * more
        score += [0.0] * more
        tree, pairs, size, longest, adds = self.tree, self.pairs, len(self.spelt), self.longest, self.adds
        for at in range(start, stop):
            before = last[at]
            if before is None:
                continue
            level, to = tree, at
            for character in window[at:at + longest]:
                node = level.get(character)
                if node is None:
                    break
                level, number = node
                to += 1
                if number < 0:
                    continue
                if adds:
                    total = score[at] + self.score[number]
                    if last[to] is None or total > score[to]:
                        last[to], came[to], score[to] = number, at, total
                elif last[to] is None:  # else the one way there is known
                    fits = before < NONE or pairs.get(before * size + number)
                    if fits or fits is None and self.survives(before, number):
                        last[to], came[to] = number, at
            if window[at] not in self.single:
                total = score[at] + self.unknown_score
                if last[at + 1] is None or adds and total > score[at + 1]:
                    last[at + 1], came[at + 1], score[at + 1] = NONE - 1 - ord(window[at]), at, total

    @staticmethod
    def _back(last: list[int | None], came: list[int], end: int) -> list[int]:
        """The pieces of the way from the first position of the window to ``end``."""
        out = []
        while end > 0:
            out.append(last[end])
            end = came[end]
        out.reverse()
        return out

    @staticmethod
    def _boundary(last: list[int | None], came: list[int], start: int) -> int:
        """The last boundary that the ways to all positions from ``start`` on have in common."""
        live = {i for i in range(start, len(last)) if last[i] is not None}
        while len(live) > 1:
            end = max(live)
            live.remove(end)
            live.add(came[end])
        return live.pop() if live else 0

    def search(self, characters: Iterable[str]) -> Iterator[int]:
        """Pieces of a stream of characters, each as soon as no survivor can change it.

        A number below ``NONE`` stands for a character without a piece.
        """
        stream, window, start = iter(characters), "", 0
        last: list[int | None] = [NONE]
        came, score = [0], [0.0]
        while True:
            more = "".join(islice(stream, 4 * self.longest))
            window += more
            stop = max(start, len(window) - self.longest + 1) if more else len(window)
            self._advance(window, last, came, score, start, stop)
            if not more:
                yield from self._back(last, came, len(window))
                return
            boundary = self._boundary(last, came, stop)
            yield from self._back(last, came, boundary)
            window, last, score, start = window[boundary:], last[boundary:], score[boundary:], stop - boundary
            came = [c - boundary for c in came[boundary:]]

    def ids_of(self, number: int) -> tuple[int, ...]:
        if number >= 0:
            return (number,)
        if self.byte:
            return tuple(self.byte[b] for b in chr(NONE - 1 - number).encode())
        return (self.unknown,)

    def _word(self, word: str) -> tuple[int, ...]:
        if len(word) > 4 * self.longest:
            return tuple([i for n in self.search(word) for i in self.ids_of(n)])
        last, came = [NONE], [0]
        self._advance(word, last, came, [0.0], 0, len(word))
        found = self._back(last, came, len(word))
        return tuple(found) if min(found) >= 0 else tuple([i for n in found for i in self.ids_of(n)])

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        memo = self.memo
        for word in self.words((MARK + text).replace(" ", MARK)):
            known = memo.get(word)
            if known is None:
                known = self.older.get(word)
                if known is None:
                    known = self._word(word)
                if len(word) < 4 * self.longest:
                    if len(memo) >= MEMO:
                        self.older, memo = memo, {}
                        self.memo = memo
                    memo[word] = known
            ids += known
        return ids

    def encode_all(self, texts: Iterable[str | None]) -> pa.Array:
        """Struct (ids, lossless) of texts that are read once, one at a time; the ids are held as 32-bit numbers."""
        ids, ends, lossless = array("i"), array("i", [0]), []
        for text in texts:
            own = self.encode(text)
            ids.fromlist(own)
            ends.append(len(ids))
            lossless.append(self.lossless(text, own))
        lists = pa.ListArray.from_arrays(np.asarray(ends), np.asarray(ids))
        return pa.StructArray.from_arrays([lists, pa.array(lossless, pa.bool_())], ["ids", "lossless"])

    def lossless(self, text: str | None, ids: list[int]) -> bool:
        """Whether ids of this vocabulary decode to the text."""
        return b"".join(map(self.spelt.__getitem__, ids)).removeprefix(b" ") == (text or "").encode()

    def decode(self, ids: Iterable[int] | None) -> str:
        size = len(self.spelt)
        spelt = b"".join([self.spelt[i] for i in ids if i is not None and 0 <= i < size] if ids is not None else [])
        return spelt.removeprefix(b" ").decode("utf-8", "replace")


_LOADED: dict[tuple[int, str], Pieces] = {}


def _loaded(model: bytes, kind: str) -> Pieces:
    """One vocabulary per worker, so that its memo lasts over batches."""
    key = (hash(model), kind)
    if key not in _LOADED:
        _LOADED[key] = Pieces(model, kind)
    return _LOADED[key]


def read_model(spark: SparkSession, path: str) -> bytes:
    """The bytes of a vocabulary file (half a megabyte or so): a path on the driver or one Spark can read."""
    try:
        with open(path, "rb") as file:
            return file.read()
    except FileNotFoundError:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def encode(text: Column, model: bytes, kind: str = "bpe") -> Column:
    """Struct (ids, lossless) of a text column."""
    @F.arrow_udf("ids array<int>, lossless boolean")
    def encoded(texts: pa.Array) -> pa.Array:
        return _loaded(model, kind).encode_all(t.as_py() for t in texts)

    return encoded(text)


def decode(ids: Column, model: bytes, kind: str = "bpe") -> Column:
    """The text of a column of ids."""
    @F.pandas_udf("string")
    def decoded(values: pd.Series) -> pd.Series:
        pieces = _loaded(model, kind)
        return pd.Series([pieces.decode(v) for v in values], dtype=object)

    return decoded(ids)
