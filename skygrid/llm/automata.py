"""Counting automata over bytes, run on all blocks of many texts at once.

A block of bytes is a function from the state in which it is entered to the state
in which it is left, with a count for each state of entry. Such functions compose
associatively, so blocks are scanned without knowing how they are entered; composing
them from a text's start then gives each block's state of entry and what was counted
before it. The same composition joins blocks to chunks and chunks to texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes that are scanned one after another; all blocks of a batch advance together.
BLOCK = 64


@dataclass(frozen=True)
class Automaton:
    """delta and emits: next state and count (0 or 1) by [class, state]. The class ``idle`` keeps the state and counts nothing."""

    classes: np.ndarray  # class of each byte
    delta: np.ndarray
    emits: np.ndarray
    idle: int
    start: int = 0

    @property
    def states(self) -> int:
        return self.delta.shape[1]


def blocks(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all bytes by [place in the block, block], and how many blocks each text has. Blocks end with idle classes."""
    sizes = np.diff(offsets)
    n = -(-sizes // BLOCK)
    first = np.cumsum(n) - n
    out = np.full(int(n.sum()) * BLOCK, automaton.idle, np.uint8)
    out[np.arange(len(data)) + np.repeat(first * BLOCK - offsets[:-1], sizes)] = automaton.classes[data]
    return np.ascontiguousarray(out.reshape(-1, BLOCK).T), n


def functions(automaton: Automaton, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each block and state of entry the state at its end, and the count."""
    s = automaton.states
    delta, emits = automaton.delta.ravel().astype(np.uint8), automaton.emits.ravel().astype(np.uint8)
    ends = np.tile(np.arange(s, dtype=np.uint8), (classes.shape[1], 1))
    counts = np.zeros((classes.shape[1], s), np.int64)
    for column in classes:
        at = (column * np.uint8(s))[:, None] + ends
        counts += emits[at]
        ends = delta[at]
    return ends, counts


def composed(ends: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Functions of blocks (sizes of them a text) to functions from each text's start to the end of each block."""
    ends, counts = ends.copy(), counts.copy()
    place = np.arange(len(ends)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    step = 1
    while step <= place.max(initial=0):
        later = np.flatnonzero(place >= step)
        state, before = ends[later - step].astype(np.int64), counts[later - step]
        new_ends, new_counts = np.take_along_axis(ends[later], state, 1), before + np.take_along_axis(counts[later], state, 1)
        ends[later], counts[later] = new_ends, new_counts
        step *= 2
    return ends, counts


@dataclass
class Scan:
    """What a batch of texts does, whatever state each is entered in."""

    automaton: Automaton
    classes: np.ndarray
    sizes: np.ndarray  # blocks a text
    ends: np.ndarray  # from the text's start to the end of each block, by [block, state of entry]
    counts: np.ndarray

    @property
    def last(self) -> np.ndarray:
        return np.cumsum(self.sizes) - 1

    def ends_of_texts(self) -> np.ndarray:
        """By [text, state of entry]; an empty text keeps the state."""
        out = np.tile(np.arange(self.automaton.states), (len(self.sizes), 1))
        some = self.sizes > 0
        out[some] = self.ends[self.last[some]]
        return out

    def counts_of_texts(self) -> np.ndarray:
        out = np.zeros((len(self.sizes), self.automaton.states), np.int64)
        some = self.sizes > 0
        out[some] = self.counts[self.last[some]]
        return out

    def places(self, text: np.ndarray, entry: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """For each query the byte of the text, entered in the given state, that counts as number rank (from 0). It must exist."""
        if not len(text):
            return np.zeros(0, np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        low, high = first[text], self.last[text]
        while (low < high).any():  # all queries halve their text's blocks at once
            middle = (low + high) // 2
            over = self.counts[middle, entry] > rank
            low, high = np.where(over, low, np.minimum(middle + 1, high)), np.where(over, middle, high)
        inner = low > first[text]
        before = np.where(inner, low - 1, low)
        state = np.where(inner, self.ends[before, entry], entry).astype(np.int64)
        left = rank - np.where(inner, self.counts[before, entry], 0)
        out = np.full(len(text), -1, np.int64)
        for k, column in enumerate(self.classes):
            kind = column[low].astype(np.int64)
            hit = self.automaton.emits[kind, state].astype(bool)
            out[hit & (left == 0)] = k
            left = left - hit
            state = self.automaton.delta[kind, state].astype(np.int64)
        return (low - first[text]) * BLOCK + out


def scanned(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> Scan:
    classes, sizes = blocks(automaton, data, offsets)
    return Scan(automaton, classes, sizes, *composed(*functions(automaton, classes), sizes))
