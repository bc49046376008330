"""Near-duplicate documents: SuperMinHash, banding, exact verification, union-find.

1. Each text becomes its set of word shingles (64-bit hashes, of words hashed modulo two primes), a digest of that
   set, and a SuperMinHash signature: every shingle takes the slots in the
   order of its own random permutation, with value step + random fraction, and
   a slot keeps its least value. As values of a later step are larger than all
   before, a text is finished as soon as each slot is filled; long texts need
   one step or two. The ranks that a shingle takes are correlated (a permutation),
   which gives less variance than as many independent hashes.
2. Texts with one digest are one class; it has a number, and its smallest id.
3. Bands of the signature are buckets. Each member is compared with the
   smallest of its bucket on full sets, which is linear in the bucket.
4. A bucket of three or more whose members still lie in several components may
   hide links between members. Those outside its largest component meet all others with
   their full sets, in blocks of bounded size, and those of different components are
   compared; a task returns only the links that join components, so never all pairs.
5. Components of all links give the result.

With 20 bands of 4 a pair at similarity 0.85 shares no bucket with chance
4e-7, and every link is confirmed on the full sets.

Defined cases
- text null, empty or blank: an empty set, linked with nothing, kept
- fewer words than a shingle has: the whole sequence is the only shingle
- repeated rows (one id and text): one document; both rows get its component
- one id with several texts: each text is a document of its own, in the component of what it links to
- id null: linked with nothing, kept
- an empty table: no rows; extra columns are ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, joined_bytes, mapped, mix64, releasing, slices, span_hashes, written
from .graph import components

#: Text that is hashed at a time.
SLICE_BYTES = 1 << 21
#: Members of a bucket that meet in one task are two blocks at most.
BLOCK = 256
#: Links of one leader that meet in one task.
LEADER_LINKS = 64
#: A-Z to a-z, all other bytes as they are; and which bytes belong to words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and the number of words of each text."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IN_WORD[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True  # a text begins a word anew
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    return span_hashes(_LOWER[data], start, end), np.diff(np.searchsorted(start, offsets))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts end to end, and how many each text has."""
    words, counts = word_hashes(data, offsets)
    if not len(words):
        return words, np.zeros(len(counts), np.int64)
    odd = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    rolled = sum((padded[k : k + len(words)] * odd[k] for k in range(width)), np.zeros(len(words), np.uint64))
    ends = np.cumsum(counts)
    begins = ends - counts
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[text]
    short = np.flatnonzero((counts > 0) & (counts < width))
    found = rolled[at]
    first = np.cumsum(sizes) - sizes
    for i in short:
        found[first[i]] = np.sum(words[begins[i] : ends[i]] * odd[: counts[i]], dtype=np.uint64) + np.uint64(counts[i])
    found = mix64(found)
    for a, n in zip(first.tolist(), sizes.tolist(), strict=True):
        found[a : a + n].sort()
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.bincount(text[new], minlength=len(counts))


def super_minhash(elements: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """Signatures (texts x slots); texts without elements keep the largest value throughout.

    Whole batches go step by step: in step t every element of an unfinished text
    takes one more slot of its permutation, drawn by Fisher-Yates.
    """
    unset = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(counts) * slots, unset, dtype=np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    order: np.ndarray | None = None
    for step in range(slots):
        drawn = mix64(elements + np.uint64((step * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
        place = ((drawn >> np.uint64(32)) % np.uint64(slots - step)).astype(np.int64) + step
        if order is None:
            slot = place
        else:
            rows = np.arange(len(elements))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, step]
            order[:, step] = slot
        np.minimum.at(out, text * slots + slot, np.uint64(step << 32) | (drawn & np.uint64(0xFFFFFFFF)))
        live = (out.reshape(-1, slots) == unset).any(axis=1)[text]
        if not live.any():
            break
        if order is None:
            place = place[live]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(place), 1))
            order[np.arange(len(place)), place] = 0
            order[:, 0] = place
        else:
            order = order[live]
        elements, text = elements[live], text[live]
    return out.reshape(-1, slots)


def band_hashes(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One hash for each text and band, different for equal values in different bands."""
    rows = signatures.shape[1] // bands
    odd = mix64(np.arange(7, 7 + rows, dtype=np.uint64)) | np.uint64(1)
    sums = (signatures[:, : rows * bands].reshape(-1, bands, rows) * odd).sum(axis=2, dtype=np.uint64)
    return mix64(sums + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _digests(elements: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two numbers for each set."""
    ends, out = np.concatenate([[0], np.cumsum(counts)]), []
    for salt in (11, 13):
        sums = np.zeros(len(elements) + 1, np.uint64)
        np.cumsum(mix64(elements ^ mix64(np.full(1, salt, np.uint64))), out=sums[1:])
        out.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
    return out


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, t (what tells the texts of one id apart)."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))


def signatures(docs: DataFrame, width: int = 5, bands: int = 20, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, t (hash of the text), n_shingles, d1 and d2 (digest of the set), bands (array of hashes; empty for empty sets)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                elements, counts = shingle_sets(*joined_bytes(part.column("text")), width)
                hashes = band_hashes(super_minhash(elements, counts, bands * rows), bands)
                some = counts > 0
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("t"), pa.array(counts.astype(np.int64)), *map(pa.array, _digests(elements, counts)), _lists(hashes[some].ravel(), np.where(some, bands, 0))],
                    ["doc_id", "t", "n_shingles", "d1", "d2", "bands"],
                )

    return mapped(_narrow(docs, id_col, text_col), work, "doc_id long, t long, n_shingles long, d1 long, d2 long, bands array<long>")


def shingles_of(docs: DataFrame, width: int = 5, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node (the key), shingles (sorted distinct hashes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("node"), _lists(*shingle_sets(*joined_bytes(part.column("text")), width))], ["node", "shingles"])

    return mapped(docs.select(F.col(key).cast("long").alias("node"), F.col(text_col).alias("text")), work, "node long, shingles array<long>")


def _similar(percent: int, shared: F.Column, a: F.Column, b: F.Column) -> F.Column:
    return shared * 100 >= (a + b - shared) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs(u, v) whose full sets are similar enough. v may repeat without bound.

    The set of v goes to as many places as its pairs fill, LEADER_LINKS in each.
    """
    degree = pairs.groupBy("v").agg(F.ceil(F.count("*") / LEADER_LINKS).cast("int").alias("places"))
    right = degree.join(sets, degree["v"] == sets["node"]).select("v", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.col("shingles").alias("b"))
    left = pairs.join(degree, "v").withColumn("place", F.pmod(F.xxhash64("u"), F.col("places")).cast("int"))
    left = left.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    both = left.join(right, ["v", "place"]).where(_similar(percent, F.least(F.size("a"), F.size("b")), F.size("a"), F.size("b")))
    return both.where(_similar(percent, F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b"))).select("u", "v")


def joining_links(ids: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, as few as join all that are linked.

    Overlaps come from lists of the members that hold each shingle; members
    of the commonest component are only looked up, never looked from.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(code, kind="stable")
    holders, first = owner[order], np.searchsorted(code[order], np.arange(code.max(initial=-1) + 2))
    begin = np.cumsum(sizes) - sizes
    names, group = np.unique(comps, return_inverse=True)
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in np.flatnonzero(group != np.bincount(group).argmax()):
        own = code[begin[i] : begin[i] + sizes[i]]
        lo, n = first[own], first[own + 1] - first[own]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        for j in np.flatnonzero((group != group[i]) & (shared * 100 >= (sizes + sizes[i] - shared) * percent)):
            a, b = root(group[i]), root(group[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return links


def hidden_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components inside buckets; members: h, rep, comp.

    Those of a bucket's largest component need no comparison with each other. It and all others are dealt
    into blocks; a task is a block of others with a block of the largest component, or with another block of others.
    """
    sizes = members.groupBy("h", "comp").agg(F.count("*").alias("k"))
    open_ = sizes.groupBy("h").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("n"), F.max("k").alias("k")).where("k < n")
    open_ = open_.select("h", "main", *[F.ceil(x / BLOCK).cast("int").alias(c) for x, c in ((F.col("n") - F.col("k"), "others"), (F.col("k"), "mains"))])
    apart, upto = F.col("comp") != F.col("main"), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = F.pmod(F.xxhash64("rep"), F.when(apart, F.col("others")).otherwise(F.col("mains"))).cast("int")
    task = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("block")
    among = F.transform(F.filter(upto("others"), lambda k: k != own), lambda k: task(1, F.least(k, own), F.greatest(k, own)))
    places = F.when(apart, F.concat(F.transform(upto("mains"), lambda j: task(0, own, j)), among)).otherwise(F.transform(upto("others"), lambda i: task(0, i, own)))
    rows = members.join(open_, "h").withColumn("block", block).select("h", "rep", "comp", F.explode(places).alias("t")).select("h", "t.kind", "t.i", "t.j", "rep", "comp")
    # A bucket over the same members as another has nothing to add.
    name = ["h", "kind", "i", "j"]
    tasks = rows.groupBy(*name).agg(F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("same"), F.count("*").alias("size"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b")
    once = tasks.groupBy("same", "size", "a", "b").agg(F.min(F.struct(*name)).alias("t")).select("t.*")
    full = rows.join(once, name).join(sets, F.col("rep") == F.col("node")).select(*name, "rep", "comp", "shingles")

    def work(table: pa.Table) -> pa.Table:
        sets = [x.values.to_numpy() for x in table.column("shingles").combine_chunks()] if table.num_rows else []
        links = joining_links(table.column("rep").to_numpy(), table.column("comp").to_numpy(), sets, percent)
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return full.groupBy(*name).applyInArrow(releasing(work), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, bands: int = 20, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Documents link when 100 * shared >= percent * united distinct shingles.
    """
    return _signed_components(docs, percent, width, bands, rows, id_col, text_col).drop("t")


def _signed_components(docs: DataFrame, percent: int, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates() with t, the hash of each row's text."""
    signed = written(signatures(docs, width, bands, rows, id_col, text_col))
    some = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = signed.where(some).groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"), F.min_by("t", "doc_id").alias("t"), F.first("bands").alias("bands"))
    # A class is a node by a number of its own, as one id may have several texts; the table is written once, so its numbers stay.
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()))
    dealt = classes.select("rep", F.explode("bands").alias("h"))
    buckets = dealt.groupBy("h").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = written(dealt.join(buckets, "h"))
    wanted = classes.select("rep", F.col("id").alias("doc_id"), "t").join(members.select("rep").distinct(), "rep", "left_semi")
    # One text of each class: the join's partitions serve for telling repeated rows apart, so texts are dealt once.
    texts = _narrow(docs, id_col, text_col).join(wanted, ["doc_id", "t"]).dropDuplicates(["doc_id", "t"])
    sets = written(shingles_of(texts, width, "rep"))
    stars = members.where("rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()
    links = written(verified(stars, sets, percent))
    comps = components(links)
    # Of two members the star has compared all there is.
    several = members.where("n > 2").join(comps, F.col("rep") == F.col("node"), "left").select("h", "rep", F.coalesce("component", "rep").alias("comp"))
    hidden = written(hidden_links(several, sets, percent))
    if hidden.limit(1).count():
        discard(comps)
        comps = components(links.unionByName(hidden))
    joined = classes.select("rep", "id", "d1", "d2", "n_shingles").join(comps, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "rep"))
    least = joined.where("component IS NOT NULL").groupBy("comp").agg(F.min("id").alias("least"))
    named = written(joined.join(least, "comp", "left").select("d1", "d2", "n_shingles", F.coalesce("least", "id").alias("component_id")))
    discard(members, sets, links, hidden, comps, classes)
    full = signed.where(some).select("doc_id", "t", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"]).select("doc_id", "t", "n_shingles", "component_id")
    empty = signed.where(~some).select("doc_id", "t", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = 85, width: int = 5, bands: int = 20, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near duplicates: of each component the row with the smallest id stays."""
    found = _signed_components(docs, percent, width, bands, rows, id_col, text_col)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone"), F.col("t").alias("_text")).distinct()
    return docs.join(gone, (docs[id_col].cast("long") == gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_text"]), "left_anti")
