"""Spelling variants: words that differ by one character, and the common form of each.

1. Words come from texts by DataFrame functions, are counted and written.
2. Two words that differ by one insertion, deletion or replacement share the first or the last half of the
   shorter one, so each word goes to groups named by its halves (for its own length as the
   shorter, and for one less as the longer). A group of more than GROUP words is dealt again by the halves of
   what its words don't share yet, until it is small or a single character is left, which the alphabet bounds.
3. In each group, positional 2-grams form an inverted index. The postings of a word's
   2-grams at the same place or one off are merged, which counts the 2-grams shared with each other word of
   a fitting length; words that share as many as one edit must leave (longer length less 3) are candidates.
   The merge sorts the joined postings of many words at once, in place of one heap a word: same order, same counts.
4. Candidates are verified character by character where they meet. A pair may come from two groups and is kept once.
5. A word's form is its commonest near word, if that is common enough. Roots follow forms by pointer jumping;
   as counts grow by a factor at each step, chains are short.

Defined cases
- text null, empty or without letters: no words; id null: its words are taken as they stand
- very long words: indexed whole, with postings limited by their places
- ties: the first word in code-point order
- repeated rows: each counts
- an empty table, or no word often enough: no rows; extra columns are ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, mapped, spread, written

#: Maximal runs of letters that are taken as words.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a group that is dealt no further.
GROUP = 256
#: Characters of a gram, and pairs of postings that are merged at a time.
Q, MERGED = 2, 1 << 22


def runs(docs: DataFrame, least_length: int, drop_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, for each run of letters in lower case (A-Z alone), of least_length characters at least.

    With drop_every, a run whose crc32 of ``id:run`` it divides loses a character: planted misspellings.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    found = found.select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    if drop_every:
        h, word = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "word").cast("binary")), F.col("word")
        at = (h % F.length(word)).cast("int")
        found = found.select(F.when(h % drop_every == 0, F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))).otherwise(word).alias("word"))
    return found.select("word").where(F.length("word") >= least_length)


def _halves(rows: DataFrame) -> DataFrame:
    """rows(name, word, n, rest, short) dealt by the first and the last half of rest. short: characters of the shorter words' rest."""
    rest, k = F.col("rest"), F.expr("short div 2")
    ways = F.array(
        F.struct(F.concat(F.lit("<"), F.substr(rest, F.lit(1), k)).alias("step"), F.substr(rest, k + 1).alias("rest")),
        F.struct(F.concat(F.lit(">"), F.substr(rest, F.length(rest) - k + 1, k)).alias("step"), F.substr(rest, F.lit(1), F.length(rest) - k).alias("rest")),
    )
    return rows.select("name", "word", "n", (F.col("short") - k).alias("short"), F.explode(ways).alias("way")).select(F.concat("name", "way.step").alias("name"), "word", "n", "way.rest", "short")


def grouped(words: DataFrame, least_length: int) -> list[DataFrame]:
    """Written tables of name, word, n, again: words(word, n) in groups such that each near pair shares one that isn't dealt again."""
    short = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda m: m >= least_length))
    rows, done = _halves(words.select("word", "n", F.col("word").alias("rest"), short.alias("short")).withColumn("name", F.col("short").cast("string"))), []
    while True:
        sizes = rows.groupBy("name").agg(F.count("*").alias("members"), F.min("short").alias("left")).where("members > 1")
        sizes = sizes.withColumn("again", (F.col("members") > GROUP) & (F.col("left") > 1))
        dealt = written(rows.join(sizes.select("name", "again"), "name"))
        done.append(dealt)
        if not dealt.where("again").limit(1).count():
            return done
        rows = _halves(dealt.where("again"))


def _merged(points: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of words (first < second) of one group. points: characters end to end."""
    size, words = np.diff(offsets), len(offsets) - 1
    grams = np.maximum(size - Q + 1, 0)
    word = np.repeat(np.arange(words), grams)
    place = np.arange(len(word)) - np.repeat(np.cumsum(grams) - grams, grams)
    at = offsets[word] + place
    _, gram = np.unique(points[at].astype(np.int64) << 21 | points[at + 1], return_inverse=True)
    _, gram = np.unique(gram * np.int64(words) + group[word], return_inverse=True)
    spot = gram * np.int64(size.max(initial=0) + 2) + place + 1  # two grams' spots are never neighbours
    postings = np.sort(spot * words + word)
    ranges = [(np.searchsorted(postings, (spot + d) * words + word + 1), np.searchsorted(postings, (spot + d + 1) * words)) for d in (-1, 0, 1)]
    low, n = np.concatenate([r[0] for r in ranges]), np.concatenate([r[1] - r[0] for r in ranges])
    owner = np.tile(word, len(ranges))
    by = np.argsort(owner, kind="stable")
    low, n, owner = low[by], n[by], owner[by]
    load = np.concatenate([[0], np.cumsum(n)])
    first = np.searchsorted(owner, np.arange(words + 1))
    a = 0
    while a < words:  # as many words as few enough postings are merged for; one at least
        b = max(a + 1, int(np.searchsorted(load[first], load[first[a]] + MERGED, side="right")) - 1)
        mine = slice(first[a], first[b])
        m = n[mine]
        other = postings[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(low[mine], m)] % words
        i, j = _counted(np.repeat(owner[mine], m), other, size)
        near = _one_edit(points, offsets, i, j)
        yield i[near], j[near]
        a = b


def _counted(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs that occur as often as an edit must leave them."""
    fits = np.abs(size[a] - size[b]) <= 1
    code = np.sort(a[fits] * np.int64(len(size)) + b[fits], kind="stable")
    start = np.flatnonzero(np.diff(code, prepend=-1))
    a, b = np.divmod(code[start], len(size))
    enough = np.diff(np.append(start, len(code))) >= np.maximum(size[a], size[b]) - 2 * Q + 1
    return a[enough], b[enough]


def _one_edit(points: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words a and b, whose lengths differ by one at most, are one edit apart; linear in their characters."""
    size = np.diff(offsets)
    swap = size[a] > size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    out = np.zeros(len(a), bool)
    equal = size[a] == size[b]
    load = np.cumsum(size[a])
    start = 0
    while start < len(a):  # pairs of MERGED characters together, one pair at least
        stop = max(start + 1, int(np.searchsorted(load, (load[start - 1] if start else 0) + MERGED, side="right")))
        n = size[a[start:stop]]
        pair = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        left, right = points[offsets[a[start:stop]][pair] + k], offsets[b[start:stop]][pair] + k
        straight = left != points[right]
        first = n.copy()  # where the two first differ
        np.minimum.at(first, pair[straight], k[straight])
        late = ~equal[start:stop][pair] & (k >= first[pair])
        shifted = np.bincount(pair[late], left[late] != points[right[late] + 1], minlength=len(n))
        out[start:stop] = np.where(equal[start:stop], np.bincount(pair, straight, minlength=len(n)) == 1, shifted == 0)
        start = stop
    return out


def matches(groups: DataFrame) -> DataFrame:
    """word, n, other, other_n: near pairs of groups(name, word, n); each pair of a group once."""

    def one(table: pa.Table) -> pa.RecordBatch:
        text = table.column("word").combine_chunks()
        points = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(pc.utf8_length(text).to_numpy())]).astype(np.int64)
        group = pc.dictionary_encode(table.column("name").combine_chunks()).indices.to_numpy()
        pairs = list(_merged(points, offsets, group))
        a, b = (pa.array(np.concatenate([p[k] for p in pairs])) for k in (0, 1))
        n = table.column("n").combine_chunks()
        return pa.RecordBatch.from_arrays([text.take(a), n.take(a), text.take(b), n.take(b)], ["word", "n", "other", "other_n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            names = table.column("name").combine_chunks()
            last = int(pc.index(names, names[-1]).as_py())  # where the group begins that may go on in the next batch
            if last:
                yield one(table.slice(0, last).combine_chunks())
            held = table.slice(last)
        if held is not None:
            yield one(held.combine_chunks())

    dealt = groups.repartition(spread(groups.sparkSession), "name").sortWithinPartitions("name", "word")
    return mapped(dealt, work, "word string, n long, other string, other_n long")


def near_pairs(words: DataFrame, least_length: int) -> DataFrame:
    """word, n, other, other_n: all pairs of words(word, n), both ways, at an edit distance of one."""
    tables = grouped(words, least_length)
    found = [matches(t.where("not again").select("name", "word", "n")) for t in tables]
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    both = F.explode(F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))))
    out = written(pairs.select(both.alias("p")).select("p.*").distinct())
    discard(*tables)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where following forms(word, form) ends. No chain of forms may be a circle."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        after = written(now.join(ahead, F.col("root") == F.col("_from"), "left").select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")))
        discard(now)
        if not after.where("moved").limit(1).count():
            return after.select("word", "root")
        now = after


def spelling_groups(words: DataFrame, least_length: int = 7, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of words(word, n)."""
    near = near_pairs(words, least_length)
    best = F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other")))
    found = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    common: Column = F.col("best.other_n") >= F.col("n") * ratio
    found = written(found.select("word", "n_near", *[F.when(common, F.col(c)).alias(a) for c, a in (("best.other", "form"), ("best.other_n", "form_n"))]))
    named = found.join(roots(found.where("form IS NOT NULL")), "word", "left")
    out = words.join(named, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def counted(runs_: DataFrame, least_count: int = 2) -> DataFrame:
    """word, n of the words that occur often enough; written, as several steps read it."""
    return written(runs_.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))
