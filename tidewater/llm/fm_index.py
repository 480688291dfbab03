"""A bidirectional FM-index over a delimited vocabulary, searched for many
words at once with numpy.

The text is ``$w1$w2$...$`` with the words in code-point order; ``$`` is
smaller than any letter.  One index is built on the text (its intervals grow
to the left), one on its reverse (to the right).  A state is a pair of
suffix-rank intervals of the same size, one in each index; extending a state
to one side follows that side's index and keeps the other interval in step by
the number of smaller symbols.  A full match ``$w$`` has an interval of one
suffix, and its rank among the suffixes that begin with ``$`` is the word's
number: no suffix array is kept.

Search scheme for one error: every word is cut in two halves; one search
matches the left half exactly and extends to the right with one error, the
other the right half exactly and then to the left.
"""

from __future__ import annotations

import numpy as np

STEP = 32                         # distance of the counted positions


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points and the lengths of words."""
    return (np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64),
            np.fromiter(map(len, words), np.int64, len(words)))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; the rounds follow the longest repeat."""
    _, rank = np.unique(text, return_inverse=True)
    rank, n, k = rank.astype(np.int64), len(text), 1
    while True:
        second = np.full(n, -1, np.int64)
        second[:max(n - k, 0)] = rank[k:]
        key = rank * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank[order] = new
        if new[-1] == n - 1:
            return order
        k *= 2


class Ranks:
    """The Burrows-Wheeler transform of a text with, every STEP positions, the
    number of symbols below each symbol."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        self.bwt = text[suffix_array(text) - 1].astype(np.int16)
        self.padded = np.concatenate((self.bwt, np.full(STEP, sigma, np.int16)))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))  # suffixes below a symbol
        blocks = n // STEP + 1
        count = np.zeros((blocks, sigma + 1), np.int32)
        np.add.at(count, (np.arange(n) // STEP, self.bwt), 1)
        before = np.zeros((blocks, sigma + 1), np.int32)
        np.cumsum(count[:-1], axis=0, out=before[1:])
        self.below = np.zeros((blocks, sigma + 1), np.int32)
        np.cumsum(before[:, :-1], axis=1, out=self.below[:, 1:])

    def smaller(self, at: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols below c, and below c + 1, among the first ``at``."""
        block, inside = at // STEP, at % STEP
        near = self.padded[(block * STEP)[:, None] + np.arange(STEP)]
        near = np.where(np.arange(STEP) < inside[:, None], near, np.iinfo(np.int16).max)
        return (self.below[block, c] + (near < c[:, None]).sum(1),
                self.below[block, c + 1] + (near <= c[:, None]).sum(1))


class Vocabulary:
    """Bidirectional index of distinct words."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        points, length = code_points(self.words)
        self.alphabet = np.unique(points)                 # symbol s > 0 is alphabet[s - 1], 0 is $
        self.sigma = len(self.alphabet) + 1
        end = np.cumsum(length + 1)
        text = np.zeros(int(end[-1]) + 1, np.int64)
        letters = np.ones(len(text), bool)
        letters[0] = letters[end] = False
        text[letters] = np.searchsorted(self.alphabet, points) + 1
        self.size = len(text)
        self.left, self.right = Ranks(text, self.sigma), Ranks(text[::-1], self.sigma)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words as a matrix (-1: not in the alphabet, and
        after the end) and the words' lengths."""
        points, length = code_points(words)
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        out = np.full((len(words), int(length.max(initial=0)) + 1), -1, np.int64)
        row = np.repeat(np.arange(len(words)), length)
        col = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
        out[row, col] = np.where(known, at + 1, -1)
        return out, length

    def extend(self, ranks: Ranks, lo, other, size, c):
        """Intervals after adding symbol c on the side of ``ranks``: ``lo``
        in its index, ``other`` in the opposite one."""
        a, a1 = ranks.smaller(lo, c)
        b, b1 = ranks.smaller(lo + size, c)
        return ranks.first[c] + a1 - a, other + b - a, (b1 - b) - (a1 - a)

    def children(self, ranks: Ranks, lo, size):
        """(state, symbol) of every symbol but $ that extends a state."""
        out = []
        for some in (size <= 2 * self.sigma, size > 2 * self.sigma):
            at = np.flatnonzero(some)
            if not len(at):
                continue
            if size[at[0]] <= 2 * self.sigma:
                n = size[at]
                pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[at], n)
                key = np.unique(np.repeat(at, n) * self.sigma + ranks.bwt[pos])
            else:
                # wide intervals: every symbol, those that do not occur fall out when extended
                key = (at[:, None] * self.sigma + np.arange(self.sigma)).ravel()
            out.append(key)
        key = np.concatenate(out) if out else np.zeros(0, np.int64)
        key = key[key % self.sigma > 0]
        return key // self.sigma, key % self.sigma

    def near(self, words: list[str], side: str) -> tuple[np.ndarray, np.ndarray]:
        """(query, word number) of the indexed words that differ from a query
        by one inserted, deleted or replaced code point and agree with its
        half on ``side`` ("left" or "right") exactly.  A pair occurs once."""
        if not self.words or not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sym, length = self.symbols(words)
        half = length // 2
        if side == "right":
            # read from the right end: the last symbol first
            back = length[:, None] - 1 - np.arange(sym.shape[1])
            sym = np.where(back >= 0, np.take_along_axis(sym, np.maximum(back, 0), 1), -1)
            half = length - half
        ranks = self.right if side == "left" else self.left
        q = np.arange(len(words))
        zero = np.zeros(len(words), np.int64)
        # the delimiter, then the exact half
        lo, other, size = self.extend(ranks, zero, zero, zero + self.size, zero)
        pos = zero.copy()
        while (todo := np.flatnonzero((pos < half) & (size > 0))).size:
            c = sym[q[todo], pos[todo]]
            size[todo[c < 0]] = 0
            todo, c = todo[c >= 0], c[c >= 0]
            lo[todo], other[todo], size[todo] = self.extend(ranks, lo[todo], other[todo], size[todo], c)
            pos[todo] += 1
        keep = size > 0
        state = np.column_stack((q, pos, lo, other, size, zero))[keep]       # the last column: errors so far
        found = []
        while len(state):
            clean = state[state[:, 5] == 0]
            grown = [state[state[:, 5] == 1]]
            if len(clean):
                q, pos, lo, other, size, _ = clean.T
                left_over = pos < length[q]
                # the word lacks this symbol of the query
                drop = clean[left_over].copy()
                drop[:, 1] += 1
                drop[:, 5] = 1
                at, c = self.children(ranks, lo, size)
                lo2, other2, size2 = self.extend(ranks, lo[at], other[at], size[at], c)
                here = size2 > 0
                at, c, lo2, other2, size2 = at[here], c[here], lo2[here], other2[here], size2[here]
                want = np.where(left_over[at], sym[q[at], np.minimum(pos[at], sym.shape[1] - 1)], -1)
                one = np.ones(len(at), np.int64)
                insert = np.column_stack((q[at], pos[at], lo2, other2, size2, one))
                step = np.column_stack((q[at], pos[at] + 1, lo2, other2, size2, (c != want).astype(np.int64)))[left_over[at]]
                grown += [drop, insert, step[step[:, 5] == 1]]
                clean = step[step[:, 5] == 0]
            wrong = np.concatenate(grown)
            # an error made in several ways leads to the same interval
            wrong = wrong[np.unique(wrong[:, [0, 1, 2, 4]], axis=0, return_index=True)[1]]
            full = wrong[:, 1] >= length[wrong[:, 0]]
            done, rest = wrong[full], wrong[~full]
            if len(done):
                own, opposite, s = self.extend(ranks, *done.T[2:5], np.zeros(len(done), np.int64))
                rank = opposite if side == "left" else own    # in the index of the text itself
                found.append(np.column_stack((done[:, 0], rank))[s > 0])
            if len(rest):
                c = sym[rest[:, 0], rest[:, 1]]
                rest, c = rest[c >= 0], c[c >= 0]
                lo2, other2, size2 = self.extend(ranks, rest[:, 2], rest[:, 3], rest[:, 4], c)
                rest = np.column_stack((rest[:, 0], rest[:, 1] + 1, lo2, other2, size2, rest[:, 5]))[size2 > 0]
            state = np.concatenate((clean, rest))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = np.unique(np.concatenate(found), axis=0)
        # suffix 0 is the last $ (a one-letter query without its letter); the
        # others that begin with $ are the words in order
        pair = pair[pair[:, 1] > 0]
        return pair[:, 0], pair[:, 1] - 1
