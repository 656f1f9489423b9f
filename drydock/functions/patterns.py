"""The first of many words that a text contains, found in one pass over the text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession, types as T
from pyspark.sql.functions import arrow_udf

_NONE = np.iinfo(np.int32).max


@dataclass(frozen=True)
class WordAutomaton:
    """An Aho-Corasick automaton as a table: ``step[state, letter]``, and for each
    state the least number of the words that end there (or ``_NONE``). ``letters``
    are the words' code points, sorted; letter 0 stands for all others."""

    letters: np.ndarray
    step: np.ndarray
    least: np.ndarray

    def first(self, texts: Sequence[str | None]) -> np.ndarray:
        """For each text the least number of a word it contains, or ``_NONE``;
        all texts take one letter at a time together."""
        size = np.array([len(t or "") for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.minimum(np.searchsorted(self.letters, points), max(len(self.letters) - 1, 0))
        letter = np.where(self.letters[at] == points, at + 1, 0) if len(self.letters) else np.zeros(len(points), np.int64)
        order = np.argsort(-size, kind="stable")
        begin, length = (np.cumsum(size) - size)[order], size[order]
        state = np.zeros(len(order), dtype=np.int64)
        found = np.full(len(order), self.least[0], dtype=np.int32)
        for t in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -t, "left"))  # lengths fall: those above t
            state[:n] = self.step[state[:n], letter[begin[:n] + t]]
            found[:n] = np.minimum(found[:n], self.least[state[:n]])
        out = np.empty(len(order), dtype=np.int32)
        out[order] = found
        return out


def word_automaton(words: Sequence[str]) -> WordAutomaton:
    """Words in order of precedence. States are as many as the letters of all words at most."""
    letters = sorted({ord(c) for w in words for c in w})
    place = {c: k + 1 for k, c in enumerate(letters)}
    children: list[dict[int, int]] = [{}]
    own = [_NONE]
    for number, word in enumerate(words):
        state = 0
        for c in word:
            code = place[ord(c)]
            if code not in children[state]:
                children[state][code] = len(children)
                children.append({})
                own.append(_NONE)
            state = children[state][code]
        own[state] = min(own[state], number)
    step = np.zeros((len(children), len(letters) + 1), dtype=np.int32)
    least = np.array(own, dtype=np.int32)
    level = [(0, 0)]  # states of one depth, each with where it falls back to
    while level:
        following = []
        for state, back in level:
            if state:  # a letter without a child leads where it leads from the fall-back
                step[state] = step[back]
                least[state] = min(least[state], least[back])
            for code, child in children[state].items():
                following.append((child, int(step[back, code]) if state else 0))
        for state, _ in level:
            for code, child in children[state].items():
                step[state, code] = child
        level = following
    return WordAutomaton(np.array(letters, dtype=np.uint32), step, least)


def first_word(spark: SparkSession, text: Column, words: Sequence[str]) -> Column:
    """The position in ``words`` of the first of them that a text contains (null: none of them, or no text)."""
    shared = spark.sparkContext.broadcast(word_automaton(words))

    def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = shared.value.first(texts.to_pylist())
            yield pa.array(found, pa.int32(), mask=(found == _NONE) | texts.is_null().to_numpy(zero_copy_only=False))

    return arrow_udf(first, T.IntegerType())(text)
