"""Sentence pieces: encoding and decoding in numpy batches over whole Arrow columns.

A text is cut where no piece can reach across, and each distinct cut ("word")
is encoded once; a worker keeps what it has learned for its next batch, within a bound.

Words of equal length advance together. Every substring up to the longest piece
is hashed from prefix sums and looked up among the sorted hashes of the pieces. Then, from
the first character to the last, each position takes the best of the pieces that end
there, over all words at once, and keeps the length of that piece as
its backpointer.

What "best" means is the model's affair. For a unigram model it is the sum of
piece scores. A BPE model is no such sum: its result is the one
in which every two neighbours are stable, that is, in which merging by score would
not have joined anything across their border. So for a BPE model the
transitions are limited to stable neighbours; exactly one piece then remains at each position, and
the ids are those of the library. Whether two neighbours are stable is found
by undoing their merges from the last to the first, and looking at the piece
that would join across the border at each point.

Only models whose normaliser is the identity (with blanks as U+2581 and a leading
one added) are taken; others raise.

Defined cases
- text null or empty: no ids, decoded as empty
- characters without a piece: their UTF-8 bytes as byte pieces, or the unknown
  id where the model has none
- very long words (text without blanks): overlapping windows of one word advance together, and are joined at
  pieces that they share; for a unigram model, whose best sum has no such joints, the word advances whole
- an empty table: no rows; repeated rows get equal ids; extra columns stay out
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, mapped, mix64, powers, slices, span_hashes

BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 22
#: Characters from which a word is cut into windows; from one window to the next (a multiple of many periods), and what they share at least.
LONG, STEP, OVERLAP = 2048, 720, 160
#: Distinct words that a worker remembers, and their bytes; beyond, it starts afresh.
MEMORY, MEMORY_BYTES = 1_500_000, 1 << 26
#: Bytes that are compared with what is held at a time.
COMPARED = 1 << 18
BLANK = "▁"
FAR = np.int64(1 << 40)


class Memory:
    """Words met so far: an open-addressing table of their hashes, and for each its bytes and ids.

    learn: new words to their ids. A word that is found by its hash is compared with the bytes held;
    if they differ it goes by another hash.
    """

    BITS = 22

    def __init__(self, learn: Callable[[list[str]], list[np.ndarray] | list[list[int]]], most: int = MEMORY) -> None:
        self.learn, self.most = learn, most
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slots = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.int32)
        self.begin, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.at, self.size, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 where it is new. No hash is 0."""
        mask = np.int64((1 << self.BITS) - 1)
        at = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        met = self.keys[at]
        out = np.where(met == hashes, self.slots[at], -1)
        live = np.flatnonzero((met != hashes) & (met != 0))
        while len(live):
            at[live] = (at[live] + 1) & mask
            met = self.keys[at[live]]
            hit = met == hashes[live]
            out[live[hit]] = self.slots[at[live[hit]]]
            live = live[~hit & (met != 0)]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has. start: first bytes of the words."""
        if len(self.begin) > self.most or len(self.bytes) > MEMORY_BYTES:
            self._forget()
        stop = np.append(start[1:], len(data))[: len(start)]
        hashes, which, raw = self._hashed(data, start, stop), np.full(len(start), -1), None
        left = np.arange(len(start))
        while len(left):
            which[left] = self._place(hashes[left])
            fresh = left[which[left] < 0]
            if len(fresh):
                distinct, first = np.unique(hashes[fresh], return_index=True)
                raw, new = raw or data.tobytes(), fresh[first]
                words = [raw[a:b] for a, b in zip(start[new].tolist(), stop[new].tolist(), strict=True)]
                for k in range(0, len(distinct), self.most):
                    some = words[k : k + self.most]
                    self._add(distinct[k : k + self.most], some, self.learn([w.decode() for w in some]))
                which[fresh] = self._place(hashes[fresh])
            left = left[~self._same(data, start[left], stop[left], which[left])]
            hashes[left] = mix64(hashes[left]) | np.uint64(1)
        length = self.length[which]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(self.begin[which] - total[:-1], length) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(start, offsets)])

    @staticmethod
    def _hashed(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return span_hashes(data, start, stop) | np.uint64(1)

    def _same(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether words have the bytes that are held under their numbers."""
        n = stop - start
        out = self.size[which] == n
        some = np.flatnonzero(out & (n > 0))
        ends = np.cumsum(n[some])
        a = 0
        while a < len(some):  # some bytes at a time
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + COMPARED, side="right")))
            mine = some[a:b]
            first = np.cumsum(n[mine]) - n[mine]
            place = np.arange(n[mine].sum()) - np.repeat(first, n[mine])
            out[mine] = ~np.logical_or.reduceat(data[place + np.repeat(start[mine], n[mine])] != self.bytes[place + np.repeat(self.at[which[mine]], n[mine])], first)
            a = b
        return out

    def _add(self, hashes: np.ndarray, words: list[bytes], found: list) -> None:
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.concatenate([self.at, len(self.bytes) + np.cumsum(size) - size])
        self.size, self.bytes = np.concatenate([self.size, size]), np.concatenate([self.bytes, np.frombuffer(b"".join(words), np.uint8)])
        length = np.fromiter(map(len, found), np.int64, len(found))
        number = np.arange(len(self.begin), len(self.begin) + len(found), dtype=np.int32)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        flat = np.concatenate(found) if isinstance(found[0], np.ndarray) else np.fromiter(chain.from_iterable(found), np.int32, int(length.sum()))
        self.ids = np.concatenate([self.ids, flat.astype(np.int32)])
        while len(self.begin) * 2 > len(self.keys):
            self._grow()
        self._put(hashes, number)

    def _put(self, hashes: np.ndarray, number: np.ndarray) -> None:
        at = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(at):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]  # of those that want one place the last gets it
            mine = free & (self.keys[at] == hashes)
            self.slots[at[mine]] = number[mine]
            hashes, number, at = hashes[~mine], number[~mine], (at[~mine] + 1) & np.int64((1 << self.BITS) - 1)

    def _grow(self) -> None:
        old, slots = self.keys, self.slots
        self.BITS += 1
        self.keys, self.slots = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.int32)
        self._put(old[old != 0], slots[old != 0])


@dataclass
class Pieces:
    """A model's pieces. Arrays over ids, with one more place at the end for a character without a piece."""

    text: list[str]
    score: np.ndarray
    unigram: bool
    byte_ids: np.ndarray | None
    unknown: int
    keys: np.ndarray  # sorted hashes of usable pieces
    key_ids: np.ndarray
    longest: int
    rank: np.ndarray  # order of merging; -1: a single character
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray  # characters
    line_cuts: bool  # no piece holds a line feed


def load(path: str) -> Pieces:
    """Read a model file."""
    from sentencepiece import sentencepiece_model_pb2 as pb2

    proto = pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces) or kind not in (1, 2) or any(p.type == 4 for p in proto.pieces):
        raise ValueError(f"{path}: only BPE and unigram models with an identity normaliser and no symbols of the user's own are supported")
    return from_pieces([(p.piece, p.score, p.type) for p in proto.pieces], unigram=kind == 1)


def from_pieces(pieces: list[tuple[str, float, int]], unigram: bool) -> Pieces:
    n = len(pieces)
    text = [p for p, _, _ in pieces]
    usable = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == 1}
    if any(BLANK in p.lstrip(BLANK) for p in usable):
        raise ValueError("a piece holds a blank after another character")
    score = np.array([s for _, s, _ in pieces] + [min(s for _, s, _ in pieces) - 10.0])
    bytes_at = [i for i, (_, _, kind) in enumerate(pieces) if kind == 6]
    unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == 2), 0)
    rank, left, right = np.full(n + 1, -1, np.int64), np.arange(n + 1), np.arange(n + 1)
    if not unigram:
        runs = {p for p in usable if len(p) > 1 and set(p) == {BLANK}}
        order = sorted((p for p in usable if len(p) > 1 and p not in runs), key=lambda p: (-pieces[usable[p]][1], usable[p]))
        rank[[usable[p] for p in order]] = np.arange(len(order))
        usable = _merges(order, {p: i for p, i in usable.items() if p not in runs}, rank, left, right)
    names = list(usable)
    keys = string_hashes(names)
    by = np.argsort(keys)
    size = np.array([*map(len, text), 1])
    return Pieces(
        text, score, unigram, np.array(bytes_at) if len(bytes_at) == 256 else None, unknown, keys[by], np.array([usable[p] for p in names])[by], max(map(len, names), default=1), rank, left, right, size, not any("\n" in p for p in usable)
    )


def _merges(order: list[str], usable: dict[str, int], rank: np.ndarray, left: np.ndarray, right: np.ndarray) -> dict[str, int]:
    """Fill in the last merge of each piece; pieces that merging never makes are left out."""
    made = {p: i for p, i in usable.items() if len(p) == 1}
    name = {i: p for p, i in usable.items()}
    for p in order:
        own = usable[p]
        for k in range(1, len(p)):
            a, b = made.get(p[:k], -1), made.get(p[k:], -1)
            if a >= 0 and b >= 0 and _stable(a, b, int(rank[own]), made, name, rank, left, right):
                left[own], right[own] = a, b
                made[p] = own
                break
    return made


def _stable(a: int, b: int, limit: int, made: dict[str, int], name: dict[int, str], rank: np.ndarray, left: np.ndarray, right: np.ndarray) -> bool:
    while True:
        across = made.get(name[a] + name[b])
        if across is not None and rank[across] < limit:
            return False
        if rank[a] > rank[b]:
            limit, a = rank[a], int(right[a])
        elif rank[b] >= 0:
            limit, b = rank[b] + 1, int(left[b])
        else:
            return True


def string_hashes(strings: list[str]) -> np.ndarray:
    out = np.zeros(len(strings), np.uint64)
    for size in {len(s) for s in strings}:
        at = [i for i, s in enumerate(strings) if len(s) == size]
        points = np.frombuffer("".join(strings[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), size)
        out[at] = ((points.astype(np.uint64) + np.uint64(1)) * powers(BASE, size)).sum(axis=1, dtype=np.uint64)
    return out


class Lattice:
    """All substrings of words of one length that are pieces: ids by [word, start, length - 1]; -1 where none."""

    def __init__(self, pieces: Pieces, points: np.ndarray) -> None:
        words, size = points.shape
        self.pieces = pieces
        most = min(size, pieces.longest)
        sums = np.zeros((words, size + 1), np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers(BASE, size), axis=1, out=sums[:, 1:])
        back = powers(INVERSE, size + 1)
        self.ids = np.full((words, size, most), -1, np.int32)
        for length in range(1, most + 1):
            hashes = (sums[:, length:] - sums[:, : size + 1 - length]) * back[: size + 1 - length]
            at = np.minimum(np.searchsorted(pieces.keys, hashes), len(pieces.keys) - 1)
            self.ids[:, : size + 1 - length, length - 1] = np.where(pieces.keys[at] == hashes, pieces.key_ids[at], -1)
        single = self.ids[:, :, 0]
        single[single < 0] = len(pieces.text)

    def stable(self, word: np.ndarray, border: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces a and b apart at the border (arrays over candidates)."""
        p, most = self.pieces, self.ids.shape[2]
        good = np.ones(len(word), bool)
        live, limit = np.arange(len(word)), np.full(len(word), FAR)
        while len(live):
            reach = p.size[a] + p.size[b]
            fits = reach <= most
            across = self.ids[word, border - p.size[a], np.where(fits, reach, 1) - 1]
            bad = fits & (across >= 0) & (p.rank[across] < limit)
            good[live[bad]] = False
            first, second = p.rank[a], p.rank[b]
            go = ~bad & ((first >= 0) | (second >= 0))
            undo = (first > second)[go]
            live, word, border, a, b = live[go], word[go], border[go], a[go], b[go]
            limit = np.where(undo, first[go], second[go] + 1)
            a, b = np.where(undo, p.right[a], a), np.where(undo, b, p.left[b])
        return good

    def best(self) -> np.ndarray:
        """Backpointers: the length of the piece that ends at each position."""
        words, size, most = self.ids.shape
        back = np.zeros((words, size + 1), np.int32)
        last = np.full((words, size + 1), -1, np.int64)
        total = np.full((words, size + 1), -np.inf)
        total[:, 0] = 0.0
        rows = np.arange(words)
        for end in range(1, size + 1):
            lengths = np.arange(1, min(end, most) + 1)
            ids = self.ids[:, end - lengths, lengths - 1]
            allowed = ids >= 0
            if self.pieces.unigram:
                value = np.where(allowed, total[:, end - lengths] + self.pieces.score[ids], -np.inf)
            else:
                word, k = np.nonzero(allowed & (lengths < end))
                border = end - lengths[k]
                before = last[word, border]
                whole = before >= 0
                ok = np.zeros(len(word), bool)
                ok[whole] = self.stable(word[whole], border[whole], before[whole], ids[word, k][whole].astype(np.int64))
                allowed[word, k] = ok
                # Of a position's stable pieces there is one; the longest is named first.
                value = np.where(allowed, lengths, -np.inf)
            pick = value.argmax(axis=1)
            total[:, end] = value[rows, pick]
            back[:, end], last[:, end] = lengths[pick], ids[rows, pick]
        return back


def encode_words(pieces: Pieces, words: list[str]) -> list[np.ndarray]:
    """Ids of each word; all blanks are U+2581 here, and lead."""
    out = segmented(pieces, words)
    for i, ids in enumerate(out):
        if (ids == len(pieces.text)).any():
            out[i] = _spelled(pieces, ids, np.frombuffer(words[i].encode("utf-32-le"), np.uint32))
    return out


def segmented(pieces: Pieces, words: list[str], long: int = LONG) -> list[np.ndarray]:
    """Pieces of each word; len(pieces.text) stands for a character without one. BPE words above long go by windows."""
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        if size > long and not pieces.unigram:
            for i in at.tolist():
                out[i] = stitched(pieces, words[i])
            continue
        for part in np.array_split(at, max(1, len(at) * size * min(size, pieces.longest) // 4_000_000)):
            points = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le"), np.uint32).reshape(len(part), size)
            lattice = Lattice(pieces, points)
            back = lattice.best()
            end = np.full(len(part), size)
            column, found = np.arange(len(part)), np.full((len(part), size), -1, np.int32)
            live = column
            while len(live):
                length = back[live, end[live]]
                begin = end[live] - length
                found[live, begin] = lattice.ids[live, begin, length - 1]
                end[live] = begin
                live = live[begin > 0]
            there = found >= 0
            flat, kept = found[there], np.cumsum(there.sum(axis=1)).tolist()
            for i, a, b in zip(part.tolist(), [0, *kept], kept):
                out[i] = flat[a:b]
    return out


def stitched(pieces: Pieces, word: str) -> np.ndarray:
    """segmented() for a long word and a BPE model: windows of it advance together.

    A piece that two neighbouring windows have at one place joins their results: left of it all neighbours
    are stable in the one, right of it in the other, and the whole word's result is the only one in
    which all are. Where two windows have no piece in common (texts with a period), the later ones are moved to where the
    earlier one has a border.
    """
    n, reach = len(word), STEP + OVERLAP + 4 * pieces.longest
    starts = list(range(0, n, STEP))

    def windows(at: list[int]) -> list[np.ndarray]:
        return segmented(pieces, [word[x : x + reach] for x in at], n)

    found, kept, k, moves, tries = windows(starts), [], 1, 0, 0
    now, begin, end = found[0], 0, reach
    while end < n:
        size, others = pieces.size[now], pieces.size[found[k]]
        places, other_places = begin + np.cumsum(size) - size, starts[k] + np.cumsum(others) - others
        _, a, b = np.intersect1d(places * (pieces.longest + 1) + size, other_places * (pieces.longest + 1) + others, return_indices=True)
        if len(a):
            kept.append(now[: a[0]])
            now, begin, end = found[k][b[0] :], int(other_places[b[0]]), starts[k] + reach
            k, tries = k + 1, 0
            continue
        borders = places[(places > starts[k]) & (places < starts[k] + pieces.longest)]
        if not len(borders) or tries > 8:
            return segmented(pieces, [word], n)[0]
        # All later windows move alike, as a period asks for; if that has not helped, this one alone.
        shift, stop = int(borders[0]) - starts[k], len(starts) if moves < 4 else k + 1
        starts[k:stop] = [x + shift for x in starts[k:stop] if x + shift < n]
        found[k:stop] = windows(starts[k : min(stop, len(starts))])
        moves, tries = moves + 1, tries + 1
    return np.concatenate([*kept, now])


def _spelled(pieces: Pieces, ids: np.ndarray, points: np.ndarray) -> np.ndarray:
    """ids with characters that have no piece as bytes."""
    out: list[int] = []
    at = 0
    for i in ids.tolist():
        if i < len(pieces.text):
            out.append(i)
        elif pieces.byte_ids is not None:
            out += pieces.byte_ids[list(chr(points[at]).encode())].tolist()
        else:
            out.append(pieces.unknown)
        at += int(pieces.size[i])
    return np.array(out, np.int32)


class Codec:
    """Encoder and decoder of one model, with the words it remembers."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.memory = Memory(self._learn)
        ids = {p: i for i, p in enumerate(pieces.text)}
        self.runs = {k: ids[BLANK * k] for k in range(1, max(map(len, pieces.text), default=0) + 1) if BLANK * k in ids}
        raw = [p.replace(BLANK, " ").encode() for p in pieces.text]
        if pieces.byte_ids is not None:
            for value, i in enumerate(pieces.byte_ids.tolist()):
                raw[i] = bytes([value])
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.width = np.fromiter(map(len, raw), np.int64, len(raw))
        self.begin = np.cumsum(self.width) - self.width

    def _learn(self, words: list[str]) -> list[np.ndarray]:
        # A run of blanks merges last and from its left end, after one of them may have joined the word.
        words = [w.replace(" ", BLANK) for w in words]
        bare = [w.lstrip(BLANK) for w in words]
        lead = [len(w) - len(b) for w, b in zip(words, bare, strict=True)]
        if self.pieces.unigram:
            return encode_words(self.pieces, words)
        found = encode_words(self.pieces, [(BLANK if n else "") + b if b else BLANK for n, b in zip(lead, bare, strict=True)])
        for i, n in enumerate(lead):
            if n > 1:
                alone = self.pieces.text[found[i][0]] == BLANK if found[i][0] < len(self.pieces.text) else False
                found[i] = np.concatenate([self._run(n if alone else n - 1), found[i][1:] if alone else found[i]]).astype(np.int32)
        return found

    def _run(self, n: int) -> list[int]:
        """Pieces of n blanks. All of them merge alike, so the leftmost two that can, do."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                stack.append(stack.pop() + stack.pop())
        return [self.runs[k] for k in stack]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        full = np.diff(offsets) > 0
        # The blank that the model puts before each text.
        data = np.insert(data, offsets[:-1][full], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        blank = data == 0x20
        # U+2581 in a text is a blank as well.
        if (mark := np.flatnonzero(data == 0xE2)).size and (np.concatenate([data, [0, 0]])[mark + 1] == 0x96).any():
            return self._plain(data, offsets)
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        cut = first[:-1] | (blank & ~np.concatenate([[False], blank[:-1]]))
        if self.pieces.line_cuts:
            line = data == 0x0A
            cut |= line | np.concatenate([[False], line[:-1]])
        return self.memory.encode(data, offsets, np.flatnonzero(cut))

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """encode for texts in which U+2581 may stand: with it written as a blank."""
        raw = data.tobytes()
        texts = [raw[a:b].replace(BLANK.encode(), b" ")[1:] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return self.encode(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts end to end, and offsets; the leading blank goes."""
        width = self.width[ids]
        total = np.concatenate([[0], np.cumsum(width)])
        data = self.bytes[np.repeat(self.begin[ids] - total[:-1], width) + np.arange(total[-1])]
        offsets = total[np.concatenate([[0], np.cumsum(counts)])]
        some = np.flatnonzero(np.diff(offsets) > 0)
        lead = some[data[offsets[some]] == 0x20]
        gone = np.zeros(len(offsets), np.int64)
        gone[lead + 1] = 1
        return np.delete(data, offsets[lead]), offsets - np.cumsum(gone)


_CODECS: dict[str, Codec] = {}


def codec(path: str, pieces: Callable[[], Pieces]) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(pieces())
    return _CODECS[path]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, exact (the ids decode to the very text)."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model_path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, lambda: shared.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                data, offsets = joined_bytes(part.column("text"))
                ids, counts = own.encode(data, offsets)
                raw, ends = own.decode(ids, counts)
                same = np.diff(ends) == np.diff(offsets)
                if len(raw) == len(data) and same.all():
                    wrong = np.concatenate([[0], np.cumsum(raw != data)])
                    same = wrong[offsets[1:]] == wrong[offsets[:-1]]
                else:
                    same = np.array([raw[a:b].tobytes() == data[c:d].tobytes() for a, b, c, d in zip(ends[:-1], ends[1:], offsets[:-1], offsets[1:], strict=True)], bool)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts), lists, pa.array(same)], ["doc_id", "n_tokens", "ids", "exact"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(narrow, work, "doc_id long, n_tokens long, ids array<int>, exact boolean")


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text. Null ids decode as empty; bytes that are no UTF-8 become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(model_path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, lambda: shared.value)
        for batch in batches:
            lists = batch.column("ids")
            counts = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
            raw, ends = own.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return mapped(narrow, work, "doc_id long, text string")
