"""Audio fingerprints from chroma, and the alignment of recordings.

A recording is a binary column of mono samples as ``Sound`` describes them, or a WAV file of whatever
rate and channels. Its spectrum is
folded frame by frame into twelve pitch classes. Sixteen filters, each the log ratio of two
areas of that image, are evaluated at every frame from one integral image; two bits
of each make a 32-bit integer per frame.

Recordings with equal integers throughout are one class. Keys are the meeting points of classes, thinned (the least hash of
every window, and of a run of equal ones the ends): of three successive whole integers, which short
recordings have as well, and of the signs of eight sturdy filters at five places of 17, which mostly stay when there is noise or
the frames are cut elsewhere. Whether two classes that share a key belong together is found by ``agree``: how often any of
their keys meet at each offset is a histogram; at its peaks the integers are laid side by side, and the pair
is linked if enough of them overlap and few of their bits differ.

Each member of a key is compared with the key's smallest class, which is linear in its members. A key whose
members then still lie in several groups may hide links between them: those outside its largest group
meet all others, in blocks of bounded size, and those of different groups are compared; a task
returns only links that join groups, so never all pairs. Linked classes make groups by union-find.

Defined cases
- samples null or empty: no integers, a group of their own
- samples too short for one integer: one group with those of equal bytes
- silence: equal integers; such recordings are one class if equally long
- very long recordings: whole, a few thousand frames at a time
- id null: a group of its own
- repeated ids: as two recordings with one id; an empty table: no rows
- extra columns are ignored, whatever their names
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mapped, mix64, releasing, written
from .graph import components

CLASSES, FILTERS, REACH = 12, 16, 8
#: Integers in a key, and keys in a window of which one is taken.
KEY, WINDOW = 3, 8
#: Filters whose signs turn least under noise and when frames are cut elsewhere, and the bits that hold these signs.
STURDY_FILTERS = (3, 7, 9, 10, 11, 12, 14, 15)
STURDY = np.uint32(sum(1 << (31 - 2 * k) for k in STURDY_FILTERS))
#: Integers of which a sturdy key has these bits, how far apart they are, and keys in a window of which one is taken.
FRAMES, STRIDE, STURDY_WINDOW = 5, 4, 4
#: Links of one class that meet in one task.
LEADER_LINKS = 64
#: Members of a key that meet in one task are two blocks at most.
BLOCK = 128
#: A filter's value is put in one of four bins at these bounds.
BOUNDS = (-0.25, 0.0, 0.25)


@dataclass(frozen=True)
class Sound:
    """Samples a second as worked on, samples in a frame and between frames, and bits of raw samples: 8 (unsigned) or 16 (signed, little-endian)."""

    rate: int = 1024
    frame: int = 256
    hop: int = 128
    bits: int = 8

    def samples(self, raw: bytes | None) -> np.ndarray:
        """A recording in units of the 8-bit scale. WAV files (PCM of 8 or 16 bits) say their own format."""
        raw, rate, channels, bits = raw or b"", self.rate, 1, self.bits
        if raw[:4] == b"RIFF" and raw[8:12] == b"WAVE":
            at, body = 12, b""
            while at + 8 <= len(raw):
                name, size = raw[at : at + 4], struct.unpack("<I", raw[at + 4 : at + 8])[0]
                if name == b"fmt " and size >= 16:
                    _, channels, rate, _, _, bits = struct.unpack("<HHIIHH", raw[at + 8 : at + 24])
                elif name == b"data":
                    body = raw[at + 8 : at + 8 + size]
                at += 8 + size + size % 2
            raw = body
        if bits not in (8, 16) or not channels or not rate:
            return np.zeros(0)
        step = bits // 8 * channels
        flat = np.frombuffer(raw[: len(raw) // step * step], np.uint8 if bits == 8 else "<i2")
        x = (flat.astype(np.float64) - 128.0 if bits == 8 else flat / 256.0).reshape(-1, channels).mean(axis=1)
        if rate == self.rate or not len(x):
            return x
        # Means of what falls between two of the wanted samples, or a line where that is less than one.
        edges = np.arange(0, len(x) + 1e-9, rate / self.rate)
        sums = np.interp(edges, np.arange(len(x) + 1), np.concatenate([[0.0], np.cumsum(x)]))
        return np.diff(sums) / (rate / self.rate)


SOUND = Sound()


def pitch_fold(sound: Sound = SOUND) -> np.ndarray:
    """Spectrum bins (rows) to pitch classes; bins below 55 Hz go nowhere."""
    hertz = np.arange(sound.frame // 2 + 1) * sound.rate / sound.frame
    out = np.zeros((len(hertz), CLASSES))
    for i, f in enumerate(hertz):
        if f >= 55.0:
            out[i, int(round(12 * np.log2(f / 440.0))) % 12] = 1.0
    return out


def filter_areas() -> list[tuple[tuple[int, int, int, int], tuple[int, int, int, int]]]:
    """Two areas (first and last frame, first and last class; ends excluded) for each filter, by rule.

    Even filters weigh the earlier half of a strip of classes against the later, odd ones a
    strip's lower half against its upper; strips differ in place and height.
    """
    out = []
    for k in range(FILTERS):
        low, height = (k * 5) % 8, 2 + 2 * (k // 2 % 2)
        if k % 2 == 0:
            width = 2 + 2 * (k // 4)
            out.append(((0, width // 2, low, low + height), (width // 2, width, low, low + height)))
        else:
            width = 1 + k // 2
            out.append(((0, width, low, low + height // 2), (0, width, low + height // 2, low + height)))
    return out


def chroma(samples: np.ndarray, offsets: np.ndarray, sound: Sound = SOUND) -> tuple[np.ndarray, np.ndarray]:
    """Frames (each of sum 1, or 0 for silence) of all recordings end to end, and how many each has."""
    counts = np.maximum((np.diff(offsets) - sound.frame) // sound.hop + 1, 0)
    begin = np.repeat(offsets[:-1], counts) + sound.hop * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    window, fold = np.hanning(sound.frame), pitch_fold(sound)
    out, step = np.zeros((len(begin), CLASSES)), max(1, (1 << 20) // sound.frame)
    for k in range(0, len(begin), step):
        power = np.abs(np.fft.rfft(samples[begin[k : k + step, None] + np.arange(sound.frame)] * window, axis=1)) ** 2 @ fold
        total = power.sum(axis=1, keepdims=True)
        out[k : k + step] = np.where(total > 1e-6, power / np.maximum(total, 1e-6), 0.0)
    return out, counts


def prints(frames: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit integers of all recordings end to end, and how many each has."""
    image = np.zeros((len(frames) + 1, CLASSES + 1))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    kept = np.maximum(counts - REACH + 1, 0)
    at = np.repeat(np.cumsum(counts) - counts, kept) + np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept)
    out = np.zeros(len(at), np.uint32)
    for (a, b, c, d), (e, f, g, h) in filter_areas():
        first = image[at + b, d] - image[at + a, d] - image[at + b, c] + image[at + a, c]
        other = image[at + f, h] - image[at + e, h] - image[at + f, g] + image[at + e, g]
        # Sums of many frames leave rounding; silence must not turn on it.
        value = np.round(np.log((1e-3 + np.maximum(first, 0)) / (1e-3 + np.maximum(other, 0))), 6)
        bin_ = np.searchsorted(BOUNDS, value, side="right").astype(np.uint32)
        out = (out << np.uint32(2)) | (bin_ ^ (bin_ >> np.uint32(1)))
    return out, kept


def fingerprints(recordings: DataFrame, id_col: str, media_col: str, sound: Sound = SOUND) -> DataFrame:
    """id, n_frames, n_prints, prints (array), prints_crc32 (of them as little-endian unsigned integers), raw (md5 of samples without prints)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                heard = [sound.samples(x) for x in part.column("media").to_pylist()]
                frames, counts = chroma(np.concatenate(heard), np.concatenate([[0], np.cumsum([len(x) for x in heard])]), sound)
                found, kept = prints(frames, counts)
                ends = np.concatenate([[0], np.cumsum(kept)])
                crcs = [zlib.crc32(found[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                raw = [hashlib.md5(x).digest() if not n and x else None for n, x in zip(kept.tolist(), part.column("media").to_pylist(), strict=True)] if not kept.all() else [None] * part.num_rows
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(counts.astype(np.int64)), pa.array(kept.astype(np.int64)), lists, pa.array(crcs, pa.int64()), pa.array(raw, pa.binary())], ["id", "n_frames", "n_prints", "prints", "prints_crc32", "raw"])

    narrow = recordings.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media"))
    return mapped(narrow, work, "id long, n_frames long, n_prints long, prints array<int>, prints_crc32 long, raw binary")


def _exact_keys(prints: np.ndarray) -> np.ndarray:
    """A key of the whole integers at each place that has KEY of them."""
    own = np.zeros(max(len(prints) - KEY + 1, 0), np.uint64)
    for k in range(KEY if len(own) else 0):
        own += mix64(prints[k : len(own) + k].view(np.uint32).astype(np.uint64) + np.uint64(k << 40))
    return mix64(own)


def _sturdy_keys(prints: np.ndarray) -> np.ndarray:
    """A key of the sturdiest bits of FRAMES integers, STRIDE apart, at each place that has them."""
    own = np.zeros(max(len(prints) - STRIDE * (FRAMES - 1), 0), np.uint64)
    for k in range(FRAMES if len(own) else 0):
        own += mix64((prints[STRIDE * k : len(own) + STRIDE * k].view(np.uint32) & STURDY).astype(np.uint64) + np.uint64((k + 64) << 40))
    return mix64(own)


def _thin(own: np.ndarray, window: int) -> np.ndarray:
    """Places of which each window has one; of a run of equal keys, as silence has, the ends say where it lies."""
    if not len(own):
        return np.zeros(0, np.int64)
    span = min(window, len(own))
    place = np.unique(np.lib.stride_tricks.sliding_window_view(own, span).argmin(axis=1) + np.arange(len(own) - span + 1))
    same = (own[place[1:]] == own[place[:-1]]) & (place[1:] == place[:-1] + 1)
    inner = np.concatenate([[False], same]) & np.concatenate([same, [False]])
    return place[~inner]


def thinned(prints: np.ndarray) -> np.ndarray:
    """The keys by which a recording meets others."""
    found = [own[_thin(own, window)] for own, window in ((_exact_keys(prints), WINDOW), (_sturdy_keys(prints), STURDY_WINDOW))]
    return np.unique(np.concatenate(found)).view(np.int64)


def placed_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a recording and their places; inside a run of equal ones the ends."""
    found = [(own, _thin(own, 1)) for own in (_exact_keys(prints), _sturdy_keys(prints))]
    return np.concatenate([own[at] for own, at in found]).view(np.int64), np.concatenate([at for _, at in found])


@dataclass(frozen=True)
class Likeness:
    """What makes two classes one group: how many integers overlap at least, what share of the shorter one, and the share of bits that may differ."""

    least_overlap: int = 8
    least_share: float = 0.5
    most_errors: float = 0.15

    def agree(self, a: np.ndarray, b: np.ndarray, keyed_a: tuple[np.ndarray, np.ndarray] | None = None, keyed_b: tuple[np.ndarray, np.ndarray] | None = None) -> bool:
        """Whether the integers a and b align at one of the three offsets at which most of their keys meet (of several, the nearest to 0)."""
        (keys_a, at_a), (keys_b, at_b) = keyed_a or placed_keys(a), keyed_b or placed_keys(b)
        order = np.argsort(keys_b, kind="stable")
        first = np.searchsorted(keys_b, keys_a, sorter=order)
        count = np.searchsorted(keys_b, keys_a, side="right", sorter=order) - first
        total = np.cumsum(count)
        if not len(total) or not total[-1]:
            return False
        met = at_b[order[np.repeat(first - (total - count), count) + np.arange(total[-1])]]
        offsets, votes = np.unique(np.repeat(at_a, count) - met, return_counts=True)
        return any(self.align(a, b, int(offsets[k])) for k in np.lexsort((offsets, np.abs(offsets), -votes))[:3])

    def align(self, a: np.ndarray, b: np.ndarray, offset: int) -> bool:
        """Whether enough integers overlap at an offset, and few enough of their bits differ."""
        x, y = a[max(offset, 0) :], b[max(-offset, 0) :]
        overlap = min(len(x), len(y))
        if overlap < self.least_overlap or overlap < min(len(a), len(b)) * self.least_share:
            return False
        return int(np.bitwise_count(x[:overlap].view(np.uint32) ^ y[:overlap].view(np.uint32)).sum()) <= overlap * 32 * self.most_errors


def class_keys(classes: DataFrame) -> DataFrame:
    """rep, key: the distinct thinned keys of each class."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prints")
            found = [thinned(x) for x in np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])] if batch.num_rows else []
            if found:
                reps = np.repeat(batch.column("rep").to_numpy(), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(np.concatenate(found))], ["rep", "key"])

    return mapped(classes.select("rep", "prints"), work, "rep long, key long")


def verified(pairs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Those of pairs(u, v) that agree. v may repeat without bound: it goes to as many places as its pairs fill."""
    degree = pairs.groupBy("v").agg(F.ceil(F.count("*") / LEADER_LINKS).cast("int").alias("places"))
    right = degree.join(classes, F.col("v") == F.col("rep")).select("v", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.col("prints").alias("b"))
    left = pairs.join(degree, "v").withColumn("place", F.pmod(F.xxhash64("u"), F.col("places")).cast("int"))
    left = left.join(classes.select(F.col("rep").alias("u"), F.col("prints").alias("a")), "u")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c) for c in ("a", "b"))
            keep = pa.array([like.agree(a[i].values.to_numpy(), b[i].values.to_numpy()) for i in range(batch.num_rows)], pa.bool_())
            yield batch.select(["u", "v"]).filter(keep)

    return mapped(left.join(right, ["v", "place"]).select("u", "v", "a", "b"), work, "u long, v long")


def joining_links(reps: list[int], groups: list[int], prints: list[np.ndarray], like: Likeness) -> list[tuple[int, int]]:
    """Links between members (in the order of reps) of different groups, as few as join all that agree."""
    parent = {g: g for g in groups}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keyed, links = [placed_keys(x) for x in prints], []
    names, times = np.unique(groups, return_counts=True)
    main = int(names[times.argmax()])
    for i in (i for i, g in enumerate(groups) if g != main):
        for j in range(len(reps)):
            # Of two outside the largest group the later one is compared with the earlier.
            if (groups[j] == main or j < i) and root(groups[i]) != root(groups[j]):
                late, early = max(i, j), min(i, j)
                if like.agree(prints[late], prints[early], keyed[late], keyed[early]):
                    parent[root(groups[i])] = root(groups[j])
                    links.append((reps[late], reps[early]))
    return links


def hidden_links(members: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Links (u, v) between groups that a key's members hide; members: key, rep, comp.

    A task is a block of those outside the key's largest group with a block of that group, or with another block of others.
    """
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("k"))
    open_ = sizes.groupBy("key").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("n"), F.max("k").alias("k")).where("k < n")
    blocks = lambda x: F.ceil(x / BLOCK).cast("int")
    open_ = open_.select("key", "main", blocks(F.col("n") - F.col("k")).alias("others"), blocks(F.col("k")).alias("mains"))
    apart = F.col("comp") != F.col("main")
    rows = members.join(open_, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.when(apart, F.col("others")).otherwise(F.col("mains"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    with_main = F.transform(upto("mains"), lambda j: F.struct(F.lit(True).alias("main"), F.col("own").alias("i"), j.alias("j")))
    others = F.transform(F.filter(upto("others"), lambda k: k != F.col("own")), lambda k: F.struct(F.lit(False).alias("main"), F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    of_main = F.transform(upto("others"), lambda i: F.struct(F.lit(True).alias("main"), i.alias("i"), F.col("own").alias("j")))
    rows = rows.select("key", "rep", "comp", F.explode(F.when(apart, F.concat(with_main, others)).otherwise(of_main)).alias("t")).select("key", "t.*", "rep", "comp")
    # A key with the same members as another has nothing to add.
    name = ["key", "main", "i", "j"]
    tasks = rows.groupBy(*name).agg(F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("same"), F.count("*").alias("size"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b")
    once = tasks.groupBy("same", "size", "a", "b").agg(F.min(F.struct(*name)).alias("t")).select("t.*")
    full = rows.join(once, name).join(classes.select("rep", "prints"), "rep").select(*name, "rep", "comp", "prints")

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        links = joining_links(table.column("rep").to_pylist(), table.column("comp").to_pylist(), [x.values.to_numpy() for x in table.column("prints").combine_chunks()], like) if table.num_rows else []
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return full.groupBy(*name).applyInArrow(releasing(work), "u long, v long")


def aligned(recordings: DataFrame, id_col: str, media_col: str, sound: Sound = SOUND, like: Likeness = Likeness()) -> DataFrame:
    """id, n_frames, n_prints, prints_crc32, class_id (smallest id with these integers), group_id (smallest id of all that align, over whatever steps)."""
    signed = written(fingerprints(recordings, id_col, media_col, sound))
    usable = (F.col("n_prints") > 0) & F.col("id").isNotNull()
    some = signed.where(usable)
    classes = written(some.groupBy("prints_crc32", "prints").agg(F.min("id").alias("rep")))
    keyed = class_keys(classes)
    leaders = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = written(keyed.join(leaders, "key"))
    stars = members.where("rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()
    links = written(verified(stars, classes, like))
    groups = components(links)
    # Of two members the star has compared all there is.
    several = members.where("n > 2").join(groups, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    hidden = written(hidden_links(several, classes, like))
    if hidden.limit(1).count():
        discard(groups)
        groups = components(links.unionByName(hidden))
    named = written(classes.join(groups, F.col("rep") == F.col("node"), "left").select("prints_crc32", "prints", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("group_id")))
    discard(members, links, hidden, groups, classes)
    full = some.join(named, ["prints_crc32", "prints"]).select("id", "n_frames", "n_prints", "prints_crc32", "class_id", "group_id")
    rest = signed.where(~usable)
    equal = rest.where("raw is not null and id is not null").groupBy("raw").agg(F.min("id").alias("least"))
    rest = rest.join(equal, "raw", "left").withColumn("class_id", F.when(F.col("id").isNotNull(), F.coalesce("least", "id")))
    return full.unionByName(rest.select("id", "n_frames", "n_prints", "prints_crc32", "class_id", F.col("class_id").alias("group_id")))


def sonified(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, media: a recording of each text, a tone of one hop for each word.

    A word's tone is a semitone between 110 and 440 Hz taken from its crc32. This stands in for a
    media table, of which there is none: equal words sound alike, so texts that share a passage
    share a stretch of sound.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tones = np.stack([128 + 100 * np.sin(2 * np.pi * 110 * 2 ** (k / 12) * np.arange(SOUND.hop) / SOUND.rate) for k in range(24)]).round().astype(np.uint8)
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                heard = [tones[[zlib.crc32(w.encode()) % 24 for w in (text or "").split()]].tobytes() if (text or "").split() else b"" for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(heard, pa.binary())], ["id", "media"])

    return mapped(texts.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), work, "id long, media binary")
