"""Probabilistic automata inferred from examples, by merging compatible states of a prefix tree.

The tree's states hold how often they were passed, how often a string ended there, and how
often each character followed. From the root on, each state that isn't yet part of the automaton is compared with
those that are: two are compatible if the frequencies of ending and of each character agree within Hoeffding's bound,
and so do those of the states that follow. A compatible state is merged, with all that follows it; one without a
match joins the automaton.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np

#: Characters that candidates are made of, in the order of their columns; one more column stands for the end.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
END = len(ALPHABET)
_COLUMN = np.full(256, -1, np.int64)
_COLUMN[list(ALPHABET.encode())] = np.arange(END)


@dataclass
class Grammar:
    """log_p and follow: log probability and next state by [state, character]; log_p has a column for the end. State 0 is the first."""

    log_p: np.ndarray
    follow: np.ndarray

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Log likelihood of each word. All words advance together, the longest to the end."""
        size = np.array([len(w) for w in words], np.int64)
        by = np.argsort(-size, kind="stable")
        data = _COLUMN[np.frombuffer(b"".join(words), np.uint8)]
        first = (np.cumsum(size) - size)[by]
        longer = np.searchsorted(-size[by], -np.arange(size.max(initial=0)), side="left")  # words that have a character at each step
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words))
        for k, n in enumerate(longer.tolist()):
            column = data[first[:n] + k]
            total[:n] += self.log_p[state[:n], column]
            state[:n] = self.follow[state[:n], column]
        out = np.empty(len(words))
        out[by] = total + self.log_p[state, END]
        return out


class _Tree:
    def __init__(self, words: list[bytes]) -> None:
        self.passed, self.ended, self.often, self.kids = [0], [0], [{}], [{}]
        for word in words:
            node = 0
            self.passed[0] += 1
            for c in _COLUMN[np.frombuffer(word, np.uint8)].tolist():
                self.often[node][c] = self.often[node].get(c, 0) + 1
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.passed)
                    self.passed.append(0)
                    self.ended.append(0)
                    self.often.append({})
                    self.kids.append({})
                node = self.kids[node][c]
                self.passed[node] += 1
            self.ended[node] += 1

    def compatible(self, a: int, b: int, bound: float, least: int) -> bool:
        """Whether all frequencies from two states on agree; states passed fewer than least times agree with any."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.passed[a], self.passed[b]
            if n < least or m < least:
                continue
            far = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[a] / n - self.ended[b] / m) >= far:
                return False
            f, g = self.often[a], self.often[b]
            if any(abs(f.get(c, 0) / n - g.get(c, 0) / m) >= far for c in f.keys() | g.keys()):
                return False
            pairs += [(self.kids[a][c], self.kids[b][c]) for c in self.kids[a].keys() & self.kids[b].keys()]
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree at b to the automaton at a."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for c, n in self.often[b].items():
                self.often[a][c] = self.often[a].get(c, 0) + n
            for c, kid in self.kids[b].items():
                if c in self.kids[a]:
                    pairs.append((self.kids[a][c], kid))
                else:
                    self.kids[a][c] = kid


def inferred(words: list[bytes], alpha: float = 0.05, least: int = 8, smoothing: float = 0.5) -> Grammar:
    """The automaton of words (characters of ALPHABET only); alpha: chance at which equal frequencies are held for different.

    Characters that a state hasn't met share ``smoothing`` virtual passings, and lead back to the first state.
    """
    tree, bound = _Tree(words), math.sqrt(0.5 * math.log(2 / alpha))
    kept, open_ = [0], []
    number = {0: 0}

    def widen(state: int) -> None:
        for c, kid in sorted(tree.kids[state].items()):
            if kid not in number:
                heapq.heappush(open_, (-tree.passed[kid], state, c, kid))

    widen(0)
    while open_:
        _, parent, c, state = heapq.heappop(open_)
        if state in number or tree.kids[parent].get(c) != state:
            continue
        match = next((k for k in kept if tree.compatible(k, state, bound, least)), None)
        if match is None:
            number[state] = len(kept)
            kept.append(state)
            widen(state)
        else:
            tree.kids[parent][c] = match
            tree.fold(match, state)
            for k in kept:  # folding may have hung new states to any of them
                widen(k)
    log_p, follow = np.empty((len(kept), END + 1)), np.zeros((len(kept), END), np.int64)
    for k, state in enumerate(kept):
        n = np.full(END + 1, smoothing / (END + 1))
        n[END] += tree.ended[state]
        for c, often in tree.often[state].items():
            n[c] += often
            follow[k, c] = number[tree.kids[state][c]]
        log_p[k] = np.log(n / n.sum())
    return Grammar(log_p, follow)
