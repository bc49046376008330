"""Repeated substrings by an enhanced suffix array and its common-prefix intervals.

The corpus is no single string that a task could sort, so its suffixes are dealt
out such that all that share their first ``width`` bytes meet:

0. Equal texts are dealt to one part, which goes on with the one of least id; the others are covered whole.
1. Every window of ``width`` bytes is led by one of its k-grams, the one with the least hash.
   Equal windows have equal leaders at equal places. Leaders that only one document
   has are left out: parts of the corpus send the distinct leaders they hold, and are told
   which of them are shared.
2. For each shared leader a part sends the stretch of text with the windows it leads,
   one copy of equal stretches. Leaders with very many occurrences send each
   window by itself, under the window's own hash, which spreads them.
3. Where stretches meet, a suffix array over all their windows is built by prefix
   doubling, with the common-prefix length of neighbours. A stack scan gives the tree of common-prefix
   intervals of at least ``width``. An interval whose occurrences differ in the byte before them (a
   stretch's begin differs from all) is a maximal repeat group within these stretches; so is a stretch that occurs several times.
   Every string of ``width`` bytes that occurs twice lies in a group with just its occurrences: to the left
   it is extended until they differ.
4. Of each group every occurrence whose document isn't the group's first is covered; its ranges go back to
   its part, where they are united and cut out.

All steps are Spark shuffles of compact binary rows; a hot passage is combined
before it is sent. Text is shuffled once, and that shuffle is read three times.

Defined cases
- text null or empty, or shorter than ``width``: nothing to remove
- very long texts: as any other (a text is held whole by one task)
- repeated ids: texts under one id don't cover each other, as neither id is smaller
- id null: comes before all ids
- an empty table: no rows; extra columns are ignored, whatever their names
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import joined_bytes, mix64, powers, releasing, span_hashes

BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
HASH_BITS = 48
#: Text of a part, and parts of the hashes for each part of the texts.
PART_BYTES, SPREAD = 4 << 20, 2
#: Parts from which on they grow, and how many times at most. They grow with the root of the corpus, so that the rows between parts grow with the corpus and not with its square.
FEW_PARTS, MOST_GROWTH = 128, 16
#: Sections of a part of the hashes (more, as parts grow), worked on one after the other: sorting takes about a hundred bytes for each of a section's.
SECTIONS = 8
#: Bytes of text that are hashed at a time.
STEP = 1 << 18
#: Occurrences of groups that are worked on at a time.
GROUP_PLACES = 1 << 19
#: Occurrences of a leader from which its windows go separately.
MANY = 2000
#: Bytes that a row counts for, whatever its text.
ROW_WEIGHT = 64
#: Stands for an id that is null.
FIRST = -(1 << 63)


# --- binary rows ---------------------------------------------------------------------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed binary; byte by byte of their numbers, so that small ones take little."""
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if x.itemsize > 1 and len(x) else x.tobytes()
        body = pa.compress(planes, codec="zstd", asbytes=True) if planes else b""
        out.append(np.array([ord(x.dtype.char), len(x), len(body)], "<i8").tobytes() + body)
    return b"".join(out)


def unpacked(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        char, n, size = np.frombuffer(raw, "<i8", 3, at).tolist()
        kind = np.dtype(chr(char))
        planes = pa.decompress(raw[at + 24 : at + 24 + size], n * kind.itemsize, codec="zstd", asbytes=True) if size else b""
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel() if n else np.zeros(0, kind))
        at += 24 + size
    return out


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for each pair, end to end."""
    total = np.cumsum(count)
    return np.repeat(begin - (total - count), count) + np.arange(total[-1] if len(total) else 0)


# --- leaders -------------------------------------------------------------------------------------------------------


def led_windows(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one leader: first window, number of windows, leader's hash (HASH_BITS)."""
    n, span = len(data), width - gram + 1
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < width:
        return none
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    hashes = mix64((sums[gram:] - sums[:-gram]) * powers(INVERSE, n + 1)[: n - gram + 1])
    del sums
    # Least hash of each window, and where it is first: a running minimum of (hash, place), doubling its reach.
    least, reach = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64), 1
    while reach * 2 <= span:
        least, reach = np.minimum(least[:-reach], least[reach:]), reach * 2
    if reach < span:
        least = np.minimum(least[: reach - span], least[span - reach :])
    # Windows may not pass the end of a text.
    over = np.zeros(n + 1, np.int32)
    np.add.at(over, np.maximum(offsets[:-1], offsets[1:] - (width - 1)), 1)
    np.add.at(over, offsets[1:], -1)
    windows = np.flatnonzero(np.cumsum(over[: len(least)]) == 0)
    if not len(windows):
        return none
    place = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    # Leaders' hashes are small ones; mixed again they spread evenly.
    return windows[first], np.diff(np.append(first, len(windows))), mix64(hashes[place[first]]) >> np.uint64(64 - HASH_BITS)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(16)) * np.uint64(parts) >> np.uint64(HASH_BITS - 16)).astype(np.int64)


def by_part(order_by: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of equal values of a sorted array."""
    cuts = np.flatnonzero(np.concatenate([[True], order_by[1:] != order_by[:-1]])) if len(order_by) else []
    for a, b in zip(cuts, [*cuts[1:], len(order_by)], strict=False):
        yield int(order_by[a]), slice(int(a), int(b))


def ordered(table: pa.Table) -> pa.Table:
    """The rows of a part by id, and of one id by text: a row's place is its name within the part."""
    ids = table.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(np.unique(ids)) < len(ids):
        texts = [hashlib.blake2b(t or b"").digest() for t in table.column("text").cast(pa.binary()).to_pylist()]
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
    return table.take(pa.array(order))


def later_copies(ids: np.ndarray, texts: pa.ChunkedArray) -> np.ndarray:
    """Whether a text, of rows that are ordered by id, is also that of a smaller id."""
    codes = pc.fill_null(pc.dictionary_encode(texts.combine_chunks()).indices, -1).to_numpy(zero_copy_only=False)
    _, first, which = np.unique(codes, return_index=True, return_inverse=True)
    return (ids > ids[first][which]) & (codes >= 0) if len(ids) else np.zeros(0, bool)


class Part:
    """The texts of one part in their order, end to end; with every, also those that are later copies."""

    def __init__(self, table: pa.Table, width: int, gram: int, every: bool = False) -> None:
        table = ordered(table)
        self.ids, texts = table.column("doc_id").to_numpy(), table.column("text")
        copies = np.zeros(len(self.ids), bool) if every else later_copies(self.ids, texts)
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        #: Rows that are covered whole, and their bytes.
        self.copies = np.flatnonzero(copies & (size >= width))
        self.copy_size = size[self.copies].astype(np.int64)
        if len(self.copies):
            texts = pc.if_else(pa.array(copies), pa.scalar(None, texts.type), texts)
        self.data, self.offsets = joined_bytes(texts)
        found = []
        # Some texts at a time: arrays of eight bytes a byte stay in the cache.
        step = np.unique(np.searchsorted(self.offsets, np.arange(0, len(self.data) + STEP, STEP)).clip(0, len(self.ids)))
        for a, b in zip(step[:-1], step[1:], strict=True):
            begin = self.offsets[a]
            first, count, hashes = led_windows(self.data[begin : self.offsets[b]], self.offsets[a : b + 1] - begin, width, gram)
            found.append((first + begin, count, hashes))
        self.first, self.count, self.hashes = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        self.doc = np.searchsorted(self.offsets, self.first, side="right") - 1


def part_leaders(part: Part, parts: int) -> Iterator[tuple[int, bytes]]:
    """For each part of the hashes: the distinct leaders and how often each occurs (as 0: in one document only)."""
    order = np.argsort(part.hashes)
    doc, hashes = part.doc[order], part.hashes[order]
    cuts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    times, hashes = np.diff(np.append(cuts, len(hashes))), hashes[cuts]
    alone = np.minimum.reduceat(doc, cuts) == np.maximum.reduceat(doc, cuts) if len(cuts) else np.zeros(0, bool)
    times = np.where(alone, 0, np.minimum(times, MANY)).astype(np.uint16)
    for at, s in by_part(part_of(hashes, parts)):
        yield at, packed(np.diff(hashes[s], prepend=np.uint64(0)), times[s])


def shared_leaders(rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """(part, leaders it shares with another part or between documents of its own, which of them occur very often)."""
    hashes, times, who = [], [], []
    for part, raw in rows:
        h, t = unpacked(raw)
        hashes.append(np.cumsum(h, dtype=np.uint64))
        times.append(t)
        who.append(np.full(len(h), part))
    h, t, w = np.concatenate(hashes), np.concatenate(times).astype(np.int64), np.concatenate(who)
    names, place, seen = np.unique(h, return_inverse=True, return_counts=True)
    total = np.bincount(place, weights=np.maximum(t, 1), minlength=len(names))
    inside = np.bincount(place, weights=t > 0, minlength=len(names))
    keep = ((seen > 1) | (inside > 0))[place]
    h, w, many = h[keep], w[keep], (total >= MANY)[place][keep]
    order = np.lexsort((h, w))
    h, w, many = h[order], w[order], many[order]
    for part, s in by_part(w):
        yield part, packed(np.diff(h[s], prepend=np.uint64(0)), many[s])


def hashes_at(data: np.ndarray, begin: np.ndarray, size: np.ndarray, step: int = STEP) -> np.ndarray:
    """span_hashes of stretches, some of the data at a time."""
    out, order = np.empty(len(begin), np.uint64), np.argsort(begin, kind="stable")
    cuts = np.searchsorted(begin[order], np.arange(0, len(data) + step, step))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            k = order[a:b]
            low = begin[k[0]]
            start = begin[k] - low
            out[k] = span_hashes(data[low : low + (start + size[k]).max()], start, start + size[k])
    return out


def part_stretches(part: Part, rows: list[bytes], width: int, parts: int, sections: int = SECTIONS, every: bool = False) -> tuple[list[tuple[int, bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches to send, by part of the hashes, and ranges (row, begin, end) that this part covers by itself."""
    found = [unpacked(raw) for raw in rows]
    shared = np.concatenate([np.cumsum(h, dtype=np.uint64) for h, _ in found]) if found else np.zeros(0, np.uint64)
    many = np.concatenate([m for _, m in found]) if found else np.zeros(0, bool)
    order = np.argsort(shared)
    shared, many = shared[order], many[order]
    at = np.minimum(np.searchsorted(shared, part.hashes), max(len(shared) - 1, 0))
    mine = np.flatnonzero(shared[at] == part.hashes) if len(shared) else np.zeros(0, np.int64)
    begin, count, hashes, often = part.first[mine], part.count[mine], part.hashes[mine], many[at[mine]] if len(shared) else np.zeros(0, bool)
    often = often & (not every)  # groups are of whole stretches, however often they occur
    # Windows of leaders that occur very often, one by one.
    single = ranges(begin[often], count[often])
    doc = np.concatenate([part.doc[mine][~often], np.repeat(part.doc[mine][often], count[often])])
    begin, size = np.concatenate([begin[~often], single]), np.concatenate([count[~often] + width - 1, np.full(len(single), width)])
    whole = hashes_at(part.data, begin, size)
    key = np.concatenate([hashes[~often], whole[int((~often).sum()) :] >> np.uint64(64 - HASH_BITS)])
    # Equal stretches: the first document's goes on, and covers those of later documents.
    order = np.lexsort((begin, whole))
    begin, size, whole, key, doc = begin[order], size[order], whole[order], key[order], doc[order]
    new = np.concatenate([[True], whole[1:] != whole[:-1]]) if len(whole) else np.zeros(0, bool)
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
    later = part.ids[doc] > part.ids[doc[lead]]
    at = begin[later] - part.offsets[doc[later]]
    covered = tuple(np.concatenate(x) for x in ((doc[later], part.copies), (at, np.zeros(len(part.copies), np.int64)), (at + size[later], part.copy_size)))
    # Of the first document all equal stretches go on, as another part may cover them; for groups, those of every document.
    go = ~later | every
    begin, size, key, doc = begin[go], size[go], key[go], doc[go]
    section = part_of(key, parts * sections)
    order = np.lexsort((begin, section))  # within a section rows and ids ascend, and their differences are small
    begin, size, doc, section = begin[order], size[order], doc[order], section[order]
    ids, places, kind = part.ids[doc], (begin - part.offsets[doc]).astype(np.int32), np.uint8 if width < 100 else np.int64
    out = []
    for to, s in by_part(section // sections):
        counts = np.bincount(section[s] % sections, minlength=sections).astype(np.int32)
        out.append((to, packed(counts, np.diff(ids[s], prepend=0), np.diff(doc[s], prepend=0).astype(np.int32), places[s], size[s].astype(kind), part.data[ranges(begin[s], size[s])])))
    return out, covered


# --- the enhanced suffix array ---------------------------------------------------------------------------------------


#: Masks that keep the first 0 to 8 bytes of a big-endian number.
_FIRST_BYTES = np.array([(1 << 64) - (1 << 8 * (8 - n)) for n in range(9)], np.uint64)


def words(padded: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a big-endian number; bytes past size (0 to 8) are 0. padded ends with eight bytes more."""
    views = np.ndarray(len(padded) - 7, ">u8", np.ascontiguousarray(padded), strides=(1,))
    return views[np.minimum(at, len(views) - 1)].astype(np.uint64) & _FIRST_BYTES[size]


def common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of their eight bytes two numbers have in common from the first on."""
    differ, out = a ^ b, np.zeros(len(a), np.int64)
    for k in range(1, 9):
        out += differ < np.uint64(1 << 8 * (8 - k)) if k < 8 else differ == 0
    return out


def repeated_suffixes(data: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and common-prefix lengths of the stretches' suffixes of at least width bytes.

    Suffixes that share their first width bytes with no other are left out; prefix[i]
    is the length common to suffix i and i - 1, 0 at the start of each group.
    """
    counts = np.maximum(size - width + 1, 0)
    order = ranges(np.cumsum(size) - size, counts)
    left = ranges(size - counts + 1, counts)
    left = np.repeat(size + width, counts) - left if len(order) else order
    # Only suffixes whose first width bytes occur again are sorted; a hash tells which these may be, and the bytes decide.
    _, one, which, times = np.unique(span_hashes(data, order, order + width), return_index=True, return_inverse=True, return_counts=True)
    names = np.flatnonzero(times > 1)
    if not len(names):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # The order of the different beginnings of width bytes, by words of eight.
    heads = order[one[names]]
    keys = [words(padded, heads + k, np.full(len(heads), min(8, width - k))) for k in range(0, width, 8)]
    rank = np.full(len(times), -1)
    rank[names[np.lexsort(keys[::-1])]] = np.arange(len(names))
    keep = times[which] > 1
    order, left, rank = order[keep], left[keep], rank[which[keep]]
    # And within one beginning, by words to the end of the stretch.
    deep = max(0, int(left.max()) - width)
    keys = [words(padded, order + width + k, np.clip(left - width - k, 0, 8)) for k in range(0, deep, 8)]
    again = np.lexsort((left, *keys[::-1], rank))
    order, left = order[again], left[again]
    # Common prefixes of neighbours, from their bytes.
    prefix, live = np.zeros(len(order) - 1, np.int64), np.ones(len(order) - 1, bool)
    for k in range(0, width + deep, 8):
        word = words(padded, order + k, np.clip(left - k, 0, 8))
        equal = common_bytes(word[1:], word[:-1])
        prefix += np.where(live, equal, 0)
        live &= equal == 8
    prefix = np.minimum(prefix, np.minimum(left[1:], left[:-1]))
    prefix = np.concatenate([[0], np.where(prefix >= width, prefix, 0)])
    alone = (prefix == 0) & np.concatenate([prefix[1:] == 0, [True]])  # hashes that agreed by chance
    return order[~alone], prefix[~alone]


def prefix_intervals(prefix: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common-prefix intervals of at least least: length, first, last. By a stack scan.

    Neighbours whose common prefix doesn't change add nothing to the tree and are passed over.
    """
    turn = np.flatnonzero(np.concatenate([prefix[1:] != prefix[:-1], [True]])) if len(prefix) else np.zeros(0, np.int64)
    length, first, last = [], [], []
    stack: list[tuple[int, int]] = []
    begin = 0
    for value, end in zip(prefix[turn].tolist(), turn.tolist(), strict=True):
        # Entries begin..end have this common prefix with the one before.
        value = value if value >= least else 0
        start = begin - 1
        while stack and stack[-1][0] > value:
            size, start = stack.pop()
            length.append(size)
            first.append(start)
            last.append(begin - 1)
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, start))
        begin = end + 1
    while stack:
        size, start = stack.pop()
        length.append(size)
        first.append(start)
        last.append(len(prefix) - 1)
    return np.array(length, np.int64), np.array(first, np.int64), np.array(last, np.int64)


def left_diverse(before: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the bytes before an interval's occurrences differ (-1, no byte, differs from all)."""
    changes = np.concatenate([[0], np.cumsum(np.concatenate([[False], (before[1:] != before[:-1]) | (before[1:] < 0)]))]) if len(before) else np.zeros(1, int)
    return changes[last + 1] > changes[first + 1]


class Meeting:
    """All stretches of one section of the hashes: distinct ones, their suffix array and intervals.

    found: part, and from there ids, rows of the part, begins and sizes of stretches, and their bytes.
    """

    def __init__(self, found: list[tuple], width: int) -> None:
        self.part = np.repeat([x[0] for x in found], [len(x[1]) for x in found])
        self.doc, self.row, self.begin = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in (1, 2, 3))
        size = np.concatenate([x[4] for x in found]).astype(np.int64)
        data = np.concatenate([x[5] for x in found])
        start = np.cumsum(size) - size
        names = span_hashes(data, start, start + size)
        _, one, self.which = np.unique(names, return_index=True, return_inverse=True)
        self.size = size[one]
        self.start = np.cumsum(self.size) - self.size
        self.data = data[ranges(start[one], self.size)]
        self.width = width
        self.order, self.prefix = repeated_suffixes(self.data, self.size, width)
        self.length, self.first, self.last = prefix_intervals(self.prefix, width)
        starts = np.zeros(len(self.data) + 1, bool)
        starts[self.start] = True
        before = np.where(starts[self.order], -1, self.data[self.order - 1].astype(np.int64)) if len(self.order) else self.order
        #: The intervals that are maximal repeat groups.
        self.maximal = np.flatnonzero(left_diverse(before, self.first, self.last))

    def covered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ranges that the groups cover: part, row of the part, begin, end."""
        owner = np.full(len(self.size), np.iinfo(np.int64).max)
        np.minimum.at(owner, self.which, self.doc)
        # The first document of the groups that each window is in; a stretch's own occurrences are one.
        least = np.repeat(owner, self.size)
        docs = least[self.order]
        count = self.last[self.maximal] - self.first[self.maximal] + 1
        # Some groups at a time, for a bounded number of places.
        cuts = np.unique(np.searchsorted(np.cumsum(count), np.arange(0, count.sum() + GROUP_PLACES, GROUP_PLACES)).clip(0, len(count)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            n, longer = count[a:b], self.length[self.maximal[a:b]] - self.width + 1
            members = ranges(self.first[self.maximal[a:b]], n)
            first = np.repeat(np.minimum.reduceat(docs[members], np.cumsum(n) - n), n)
            reach = np.repeat(longer, n)
            np.minimum.at(least, ranges(self.order[members], reach), np.repeat(first, reach))
        windows = self.size[self.which] - self.width + 1
        at = ranges(self.start[self.which], windows)
        row = np.repeat(np.arange(len(windows)), windows)
        hit = np.flatnonzero(self.doc[row] > least[at])
        row, place = row[hit], (at[hit] - self.start[self.which][row[hit]])
        fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]) if len(row) else np.zeros(0, bool)
        final = np.concatenate([fresh[1:], [True]]) if len(row) else fresh
        a, b, row = place[fresh], place[final], row[fresh]
        return self.part[row], self.row[row], self.begin[row] + a, self.begin[row] + b + self.width

    def groups(self) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Maximal repeats: length, and all occurrences as (doc_id, offset). Longer ones go on in the next stretch."""
        stretch = np.searchsorted(self.start, self.order, side="right") - 1
        rows, first = np.argsort(self.which, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(self.which, minlength=len(self.size)))])
        for i in self.maximal.tolist():
            places = []
            for j in range(self.first[i], self.last[i] + 1):
                s = stretch[j]
                places += [(int(self.doc[r]), int(self.begin[r] + self.order[j] - self.start[s])) for r in rows[first[s] : first[s + 1]]]
            yield int(self.length[i]), sorted(places)
        # A stretch of several occurrences that no other stretch begins or holds is in no interval.
        deepest = np.zeros(len(self.order), np.int64)
        for i in np.argsort(self.length, kind="stable").tolist():
            deepest[self.first[i] : self.last[i] + 1] = self.length[i]
        place = np.full(len(self.data) + 1, -1)
        place[self.order] = np.arange(len(self.order))
        for s in np.flatnonzero(np.diff(first) > 1).tolist():
            at = place[self.start[s]]
            if at < 0 or deepest[at] < self.size[s]:
                yield int(self.size[s]), sorted((int(self.doc[r]), int(self.begin[r])) for r in rows[first[s] : first[s + 1]])


def met(rows: list[tuple[int, bytes]], width: int, sections: int = SECTIONS) -> Iterator[Meeting]:
    """The meetings of a part of the hashes, one at a time."""
    found = []
    for part, raw in rows:
        counts, ids, docs, *columns = unpacked(raw)
        cuts = np.concatenate([[0], np.cumsum(counts)])
        at = np.concatenate([[0], np.cumsum(columns[1], dtype=np.int64)])[cuts]
        found.append((part, cuts.tolist(), at.tolist(), np.cumsum(ids), np.cumsum(docs, dtype=np.int32), *columns))
    for k in range(sections):
        here = []
        for part, cuts, at, *columns, data in found:
            a, b = cuts[k], cuts[k + 1]
            if b > a:
                here.append((part, *(c[a:b] for c in columns), data[at[k] : at[k + 1]]))
        if here:
            yield Meeting(here, width)


# --- the Spark job -----------------------------------------------------------------------------------------------------


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(list(x), f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else schema.empty_table()


_TO = pa.schema([("hp", pa.int32()), ("dp", pa.int32()), ("blob", pa.binary())])
_BACK = pa.schema([("dp", pa.int32()), ("blob", pa.binary())])


def _marks(parts: np.ndarray, rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.lexsort((begin, rows, parts))
    parts, rows, begin, end = parts[order], rows[order], begin[order], end[order]
    return [(p, packed(rows[s], begin[s], end[s])) for p, s in by_part(parts)]


def _all_marks(found: Iterator[Meeting]) -> list[tuple]:
    columns = list(zip(*(m.covered() for m in found), strict=True))
    return _marks(*(np.concatenate(x) for x in columns)) if columns else []


def parted(docs: DataFrame, id_col: str, text_col: str, rest: bool = False) -> tuple[DataFrame, int]:
    """dp, doc_id, text (and rest: all columns but the text, in a struct), dealt by part; and the number of parts."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    size = part_bytes(total)
    parts = max(2, -(-total // size))
    others = [F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]).alias("rest")] if rest else []
    texts = docs.select(F.xxhash64(F.col(text_col)).alias("name"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("doc_id"), F.col(text_col).alias("text"), *others)
    # By text, so that copies meet; those of a text that fills a good part of a part are dealt out by id besides. A row counts as some bytes, so that empty texts part too.
    weight = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_WEIGHT)
    often = texts.groupBy("name").agg(weight.alias("weight")).where(F.col("weight") > size // 4).select("name", F.ceil(F.col("weight") / (size // 4)).alias("pieces"))
    dp = F.pmod(F.xxhash64("name", F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("doc_id"), "pieces"))), F.lit(parts)).cast("int").alias("dp")
    return texts.join(F.broadcast(often), "name", "left").select(dp, "doc_id", "text", *["rest"] * rest).repartition(parts, "dp"), parts


def part_bytes(total: int) -> int:
    """Text of a part of a corpus of so many bytes."""
    return max(PART_BYTES, min(PART_BYTES * MOST_GROWTH, math.isqrt(total * PART_BYTES // FEW_PARTS)))


def section_count(parts: int) -> int:
    """Sections of a part of the hashes, where the texts have so many parts."""
    return SECTIONS * min(MOST_GROWTH, -(-parts // FEW_PARTS))


def meetings(texts: DataFrame, parts: int, width: int, gram: int, work: Callable[[Iterator[Meeting]], list[tuple]], schema: pa.Schema, sql: str, own: Callable[[int, tuple], list[tuple]] | None = None) -> DataFrame:
    """Rows of work for the meetings of each part of the hashes, and of own for the ranges that a part covers by itself."""

    every = own is None  # of groups all occurrences are asked for
    sections = section_count(parts)

    def lead(table: pa.Table) -> pa.Table:
        dp = table.column("dp")[0].as_py() if table.num_rows else 0
        return _arrow([(hp, dp, raw) for hp, raw in part_leaders(Part(table, width, gram, every), parts * SPREAD)], _TO)

    def share(table: pa.Table) -> pa.Table:
        return _arrow(list(shared_leaders(list(zip(table.column("dp").to_pylist(), table.column("blob").to_pylist(), strict=True)))), _BACK)

    def send(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _TO.empty_table()
        dp = key[0].as_py()
        out, (docs, begin, end) = part_stretches(Part(left, width, gram, every), right.column("blob").to_pylist(), width, parts * SPREAD, sections, every)
        rows = [(hp, dp, raw) for hp, raw in out]
        # Own ranges travel with the stretches, as rows of no meeting.
        if not every and len(docs):
            rows.append((-1 - dp, dp, packed(docs, begin, end)))
        return _arrow(rows, _TO)

    def meet(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("dp").to_pylist(), table.column("blob").to_pylist(), strict=True))
        if table.column("hp")[0].as_py() < 0:
            return _arrow([r for dp, raw in rows for r in own(dp, tuple(unpacked(raw)))], schema)
        return _arrow(work(met(rows, width, sections)), schema)

    to, back = "hp int, dp int, blob binary", "dp int, blob binary"
    shared = texts.groupBy("dp").applyInArrow(releasing(lead), to).groupBy("hp").applyInArrow(releasing(share), back)
    sent = texts.groupBy("dp").cogroup(shared.groupBy("dp")).applyInArrow(releasing(send), to)
    return sent.groupBy("hp").applyInArrow(releasing(meet), sql)


def repeat_groups(docs: DataFrame, width: int = 50, gram: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """length, occurrences (array of doc_id, begin): maximal repeats of at least width bytes.

    A repeat that is longer than a stretch is joined from its parts, unless some of these occur elsewhere besides: then each shows by itself.
    """
    texts, parts = parted(docs, id_col, text_col)
    pair = pa.struct([("doc_id", pa.int64()), ("begin", pa.int64())])
    schema = pa.schema([("length", pa.int64()), ("occurrences", pa.list_(pair))])

    def work(found: Iterator[Meeting]) -> list[tuple]:
        return [(n, [{"doc_id": d, "begin": b} for d, b in places]) for meeting in found for n, places in meeting.groups()]

    return chained(meetings(texts, parts, width, gram, work, schema, "length long, occurrences array<struct<doc_id: long, begin: long>>"))


def chained(groups: DataFrame) -> DataFrame:
    """groups with those joined whose occurrences are the same but for one common shift, and which overlap or touch.

    As a group has all occurrences of its string, what is joined is a repeat with all its occurrences as well.
    """
    places = F.array_sort("occurrences")
    first = places[0]["begin"]
    shape = F.transform(places, lambda o: F.struct(o["doc_id"].alias("doc_id"), (o["begin"] - first).alias("shift")))
    rows = groups.where(F.size("occurrences") > 0).select(shape.alias("shape"), first.alias("a"), (first + F.col("length")).alias("b"))
    along = Window.partitionBy("shape").orderBy("a", "b")
    rows = rows.withColumn("reach", F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("chain", F.count(F.when(F.coalesce(F.col("a") > F.col("reach"), F.lit(True)), 1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = rows.groupBy("shape", "chain").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    back = F.transform("shape", lambda o: F.struct(o["doc_id"].alias("doc_id"), (o["shift"] + F.col("a")).alias("begin")))
    return whole.select((F.col("b") - F.col("a")).alias("length"), back.alias("occurrences"))


def _cut(docs: DataFrame, width: int, gram: int, id_col: str, text_col: str, schema: pa.Schema, sql: str, rows: Callable[[pa.Table, list[tuple]], pa.Table], rest: bool = False) -> DataFrame:
    """rows of each part's table and, for each of its texts, (bytes, spans removed, what is left)."""
    texts, parts = parted(docs, id_col, text_col, rest)
    narrow = texts.select("dp", "doc_id", "text")
    marks = meetings(narrow, parts, width, gram, _all_marks, _BACK, "dp int, blob binary", own=lambda dp, x: [(dp, packed(*x))])

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        left = ordered(left)
        found = [unpacked(raw) for raw in right.column("blob").to_pylist()] if right.num_rows else []
        which, begin, end = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        order = np.argsort(which, kind="stable")
        which, begin, end = which[order], begin[order], end[order]
        out = []
        for i, text in enumerate(left.column("text").cast(pa.binary()).to_pylist()):
            text = text or b""
            a, b = np.searchsorted(which, [i, i + 1])
            spans = _united(begin[a:b], end[a:b])
            left_over = b"".join(text[x:y] for x, y in zip([0, *[y for _, y in spans]], [*[x for x, _ in spans], len(text)], strict=True)) if spans else text
            out.append((len(text), len(spans), left_over))
        return rows(left, out)

    return texts.groupBy("dp").cogroup(marks.groupBy("dp")).applyInArrow(releasing(cut), sql)


def repeats_cut(docs: DataFrame, width: int = 50, gram: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Each byte goes that lies in a string of width bytes which also starts in a document of smaller id.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def rows(left: pa.Table, out: list[tuple]) -> pa.Table:
        ids = left.column("doc_id").to_pylist()
        return _arrow([(None if i == FIRST else i, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()) for i, (n, spans, kept) in zip(ids, out, strict=True)], schema)

    return _cut(docs, width, gram, id_col, text_col, schema, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", rows)


def without_repeats(docs: DataFrame, width: int = 50, gram: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with what repeats_cut leaves of each text; all rows stay. A character that is cut in part goes whole."""
    fields = {f"c{i}": docs.schema[c].dataType.simpleString() for i, c in enumerate(docs.columns) if c != text_col}
    sql = "text string, rest struct<" + ", ".join(f"{c}: {kind}" for c, kind in fields.items()) + ">"

    def rows(left: pa.Table, out: list[tuple]) -> pa.Table:
        texts = [None if was is None else kept.decode("utf-8", "ignore") for was, (_, _, kept) in zip(left.column("text").to_pylist(), out, strict=True)]
        return pa.table({"text": pa.array(texts, pa.string()), "rest": left.column("rest")})

    cut = _cut(docs, width, gram, id_col, text_col, pa.schema([("text", pa.string())]), sql, rows, rest=True)
    return cut.select(*[(F.col("text") if c == text_col else F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def _united(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(begin.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
