"""FM-index over word numbers, in both directions, for patterns up to a fixed depth.

The rows of the Burrows-Wheeler transform are the positions of a sequence sorted
by the ``depth`` words from there on; for patterns no longer than that, intervals
and the LF step are those of a full suffix order. Word 0 separates pieces.

A set of patterns is three arrays: where their intervals begin in the index and
in that of the reversed sequence, and how long they are (their counts). One call
extends all patterns of a set by every word that occurs before (or after) them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np


def context_order(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` numbers that begin there (0 beyond the end); depth is a power of two."""
    rank, width = sequence.astype(np.int64), 1
    while width < depth:
        after = np.zeros(len(rank), np.int64)
        after[:-width] = rank[width:]
        keys = rank * (int(rank.max(initial=0)) + 1) + after
        width *= 2
        if width < depth:
            rank = np.unique(keys, return_inverse=True)[1]
        else:
            rank = keys
    return np.argsort(rank, kind="stable")


class Index:
    """The transform, where each word's rows begin, and ranks by binary search in sorted (word, row) keys."""

    def __init__(self, sequence: np.ndarray, n_words: int, depth: int):
        order = context_order(sequence, depth)
        self.size = len(sequence)
        self.before = sequence[order - 1].astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=n_words))])
        self.places = np.sort(self.before * self.size + np.arange(self.size))

    def rank(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each word occurs in the transform above its row."""
        return np.searchsorted(self.places, words * self.size + rows) - self.first[words]


@dataclass
class Patterns:
    """Words of each pattern, its interval here and in the reversed sequence, and its count."""

    words: np.ndarray
    here: np.ndarray
    there: np.ndarray
    count: np.ndarray


def extend(index: Index, here: np.ndarray, there: np.ndarray, count: np.ndarray, n_words: int):
    """Every word before each pattern: (pattern, word, begin here, begin there, count)."""
    ends = np.cumsum(count)
    rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(here - (ends - count), count)
    pattern = np.repeat(np.arange(len(count)), count)
    keys, times = np.unique(pattern * n_words + index.before[rows], return_counts=True)
    pattern, word = keys // n_words, keys % n_words
    # In the other direction the extended patterns follow one another, the separator first.
    smaller = np.cumsum(times) - times - (ends - count)[pattern]
    inner = word > 0
    pattern, word, times, smaller = pattern[inner], word[inner], times[inner], smaller[inner]
    begin = index.first[word] + index.rank(word, here[pattern])
    return pattern, word, begin, there[pattern] + smaller, times


class BiIndex:
    """Both directions of a sequence that ends with a separator."""

    def __init__(self, sequence: np.ndarray, n_words: int, depth: int):
        self.sequence, self.n_words, self.depth = sequence, n_words, depth

    @cached_property
    def forward(self) -> Index:
        return Index(self.sequence, self.n_words, self.depth)

    @cached_property
    def backward(self) -> Index:
        # Reversed, the sequence must end with a separator too.
        return Index(np.append(self.sequence[:-1][::-1], 0), self.n_words, self.depth)

    def words(self) -> Patterns:
        """Every word that occurs, as a pattern of one; its rows are the same in both directions."""
        count = np.diff(self.forward.first)
        some = np.flatnonzero(count[1:]) + 1
        begins = self.forward.first[some]
        return Patterns(some[:, None], begins, begins, count[some])

    def left(self, patterns: Patterns) -> Patterns:
        found, word, here, there, count = extend(
            self.forward, patterns.here, patterns.there, patterns.count, self.n_words
        )
        return Patterns(np.column_stack([word, patterns.words[found]]), here, there, count)

    def right(self, patterns: Patterns) -> Patterns:
        found, word, there, here, count = extend(
            self.backward, patterns.there, patterns.here, patterns.count, self.n_words
        )
        return Patterns(np.column_stack([patterns.words[found], word]), here, there, count)
