"""Language identification by interpolated Kneser-Ney character models.

Text is seen as lower-cased letters with single blanks for all else. For each
language the counts of all character 5-grams of the learning texts are summed by
Spark; the lower orders follow from them, as Kneser-Ney counts there in how
many different contexts an n-gram occurs. A model holds, for each order, one
sorted array of n-gram hashes and beside it one row of values per n-gram with a
column for each language: the interpolated log probability, and for contexts the
weight that goes to the next lower order. Looking up an n-gram once so scores
it in all languages; only n-grams met in no language go to lower orders.

A text gets the language of least cross-entropy per character. It is rejected if
it has no letter, or if that entropy is too high for a text of its language and length. What is too high
is calibrated on texts set aside from the counting: their entropies' mean for each language
and their spread for each class of lengths make every entropy a distance in spreads, and the limit is
the distance that a share ``reject_rate`` of such texts passes (by an exponential tail above
their ninth decile; the fewer texts it is known from, the further out the limit lies). A language with
fewer than KNOWN_TEXTS calibration texts rejects nothing by entropy.

Statistics and scores are of all counts, however many there are, and are worked out by Spark as tables
that grow with the corpus (``Tables``). The scores of the most frequent 5-grams are broadcast as
sorted hash arrays, ``max_scores`` numbers in all. What a text has beside them is joined with the tables, so each
text gets the score that the whole model gives.

Defined cases
- text null, empty or without a letter: "und", score 0, rejected
- no usable learning text: every text is "und"
- ties in entropy: the first language in code point order
- very long texts are scored whole; repeated rows get equal answers
- an empty table: no rows; extra columns are ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, joined_bytes, mapped, mix64, slices, written

ORDER = 5
SLICE_BYTES = 1 << 19
#: Scores (5-grams times languages) that may be broadcast, of four bytes each.
MAX_SCORES = 1 << 22
#: Distinct 5-grams of a language that a counting task holds before it sends them on.
HELD_GRAMS = 1 << 20
#: Sums of joined scores are whole multiples of 1 / SCALE, so that their order doesn't matter.
SCALE = 1 << 30
_STEP = np.uint64(0x9FB21C651E98DF25)  # odd; n-gram hashes are polynomials in it
BLANK = 32


def _fold_table() -> np.ndarray:
    """Code point to its lower-case letter, or a blank."""
    out = np.full(0x110000, BLANK, np.uint32)
    for c in (*range(0xD800), *range(0xE000, 0x110000)):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_FOLD: list[np.ndarray] = []


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of letters and single blanks, a blank after each text that has letters, and offsets."""
    if not _FOLD:
        _FOLD.append(_fold_table())
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    # The text of each character: count of the offsets at or before its first byte.
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.searchsorted(lead, offsets[1:])
    marked = np.insert(_FOLD[0][points], ends, BLANK)
    ends = ends + np.arange(1, len(ends) + 1)
    before = np.empty(len(marked), np.uint32)
    if len(marked):
        before[0], before[1:] = BLANK, marked[:-1]
        before[ends[:-1]] = BLANK  # no text begins with one
    keep = (marked != BLANK) | (before != BLANK)
    sums = np.concatenate([[0], np.cumsum(keep)])
    return marked[keep], sums[np.concatenate([[0], ends])]


def windows_at(points: np.ndarray, ends: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n characters that end at each place (rows); before a text there are blanks."""
    begin = ends[np.searchsorted(ends, at, side="right") - 1]
    place = at[:, None] + np.arange(1 - n, 1)
    return np.where(place >= begin[:, None], points[np.maximum(place, 0)], BLANK).astype(np.uint64)


def rows_hash(windows: np.ndarray) -> np.ndarray:
    out = windows[:, 0].astype(np.uint64)
    for k in range(1, windows.shape[1]):
        out = out * _STEP + windows[:, k].astype(np.uint64)
    return mix64(out)


def gram_hashes(points: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """rows_hash of the n characters that end at each place, for all places."""
    padded = np.concatenate([np.full(n - 1, BLANK, np.uint64), points.astype(np.uint64)])
    out = padded[: len(points)].copy()
    for k in range(1, n):
        out *= _STEP
        out += padded[k : k + len(points)]
    out = mix64(out)
    # A text's first places don't see the text before.
    early = (ends[:-1, None] + np.arange(n - 1))[np.arange(n - 1) < np.diff(ends)[:, None]]
    out[early] = rows_hash(windows_at(points, ends, early, n)) if len(early) else out[early]
    return out


@dataclass
class Model:
    """Sorted hashes of the broadcast 5-grams and their log probabilities (rows x languages); the tables have all."""

    langs: list[str]
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    values: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    tables: Tables | None = None
    #: Calibration: usual entropy by language, spread by class of length, and the spreads above which a text is rejected.
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: float = float("inf")


@dataclass
class Tables:
    """A model as tables: gram (of 1 to ORDER characters), p (probability in each language), and context, back (the weight of the next lower order)."""

    grams: dict[int, DataFrame]
    contexts: DataFrame
    base: float


def probe(hashes: np.ndarray, wanted: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted in the sorted hashes, and whether they are there."""
    if not len(hashes):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    # Leading bits say where to begin; hashes are even, so few steps end the search.
    lead = (wanted >> np.uint64(44)).astype(np.int64)
    at, stop = index[lead].astype(np.int64), index[lead + 1]
    live = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] < wanted)
    while len(live):
        at[live] += 1
        live = live[(at[live] < stop[live])]
        live = live[hashes[at[live]] < wanted[live]]
    at = np.minimum(at, len(hashes) - 1)
    return at, hashes[at] == wanted


def lead_index(hashes: np.ndarray) -> np.ndarray:
    return np.searchsorted(hashes, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44)).astype(np.int32) if len(hashes) else np.zeros((1 << 20) + 1, np.int32)


# --- learning ------------------------------------------------------------------------------------------------------


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram (five characters, "" at the start padded with blanks), n. docs: lang, text.

    Tasks sum what they read before it is shuffled: a language with most of the
    texts costs as many rows as it has different 5-grams.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out(lang: str) -> pa.RecordBatch:
            windows, counts = kept.pop(lang)
            grams = windows.astype("<u4").tobytes().decode("utf-32-le")
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), pa.array([grams[i : i + ORDER] for i in range(0, len(grams), ORDER)], pa.string()), pa.array(counts)], ["lang", "gram", "n"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                rows = batch.filter(pa.array([x == lang for x in langs]))
                for part in slices(rows, "text", SLICE_BYTES):
                    points, ends = folded(*joined_bytes(part.column("text")))
                    if len(points):
                        kept[lang] = _added(kept.get(lang), *_distinct(points, ends))
                        if len(kept[lang][1]) > HELD_GRAMS:
                            yield out(lang)
        for lang in list(kept):
            yield out(lang)

    return mapped(docs.select("lang", "text"), work, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _distinct(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, counts = np.unique(gram_hashes(points, ends, ORDER), return_index=True, return_counts=True)
    return windows_at(points, ends, first, ORDER).astype(np.uint32), counts.astype(np.int64)


def _added(old: tuple[np.ndarray, np.ndarray] | None, windows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if old is None:
        return windows, counts
    windows, counts = np.concatenate([old[0], windows]), np.concatenate([old[1], counts])
    whole, which = np.unique(rows_hash(windows), return_inverse=True)
    first = np.zeros(len(whole), np.int64)
    first[which] = np.arange(len(which))
    return windows[first], np.bincount(which, weights=counts, minlength=len(whole)).astype(np.int64)


def kneser_ney_tables(counts: DataFrame, langs: list[str]) -> Tables:
    """The model of counts(lang, gram, n). Absolute discounting with D = n1 / (n1 + 2 n2) at each order."""
    spark = counts.sparkSession
    # In lower orders an n-gram counts once for each different character before it.
    tails = counts.select("lang", F.explode(F.transform(F.sequence(F.lit(2), F.lit(ORDER)), lambda m: F.substring("gram", F.lit(ORDER + 1) - m, m))).alias("gram")).distinct()
    lower = tails.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))
    every = written(counts.unionByName(lower).withColumn("order", F.length("gram")))
    few = {(r["order"], r["lang"]): r for r in every.groupBy("order", "lang").agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2)]).collect()}
    discounts = [(n, i, x, min(0.9, max(0.1, (r["n1"] + 0.5) / (r["n1"] + 2 * r["n2"] + 1.0)))) for i, x in enumerate(langs) for n in range(1, ORDER + 1) if (r := few.get((n, x)))]
    discounts = spark.createDataFrame(discounts, "order int, i int, lang string, d double")
    every = every.join(F.broadcast(discounts), ["order", "lang"]).withColumn("context", F.expr("left(gram, order - 1)"))
    totals = written(every.groupBy("i", "context").agg(F.sum("n").alias("total"), (F.count("*") * F.first("d")).alias("share")).withColumn("back", F.col("share") / F.col("total")))

    def by_lang(value: str, none: float) -> Column:
        """An array of each language's value (at most one row for each); none where a language has no row."""
        known = F.map_from_entries(F.collect_list(F.struct("i", value)))
        return F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), lambda i: F.coalesce(known[i], F.lit(none)))

    contexts = written(totals.groupBy("context").agg(by_lang("back", 1.0).cast("array<float>").alias("back")))
    direct = every.join(totals.select("i", "context", "total"), ["i", "context"]).withColumn("direct", F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total"))
    direct = direct.groupBy("order", "gram", "context").agg(by_lang("direct", 0.0).alias("direct")).join(contexts, "context")
    direct = written(direct.select("order", "gram", F.expr("substring(gram, 2)").alias("tail"), "direct", "back"), by="order")
    base = 1.0 / (direct.where("order = 1").count() + 1)
    below = spark.createDataFrame([("", [base] * len(langs))], "gram string, p array<float>")
    grams = {}
    for n in range(1, ORDER + 1):
        full = direct.where(F.col("order") == n).drop("order").join(below.select(F.col("gram").alias("tail"), F.col("p").alias("lower")), "tail")
        mixed = F.zip_with("direct", F.zip_with("back", "lower", lambda b, q: b.cast("double") * q), lambda d, x: d + x)
        grams[n] = below = written(full.select("gram", mixed.cast("array<float>").alias("p")))
    discard(every, totals, direct)
    return Tables(grams, contexts, base)


def table_scores(tables: Tables, grams: DataFrame, size: int) -> DataFrame:
    """gram, whole (log probability in each of size languages times SCALE, rounded); grams: distinct 5-grams, seen or not."""
    at = lambda n: F.substring("gram", F.lit(ORDER + 1) - n, n)
    tails = F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda n: F.struct(n.alias("n"), at(n).alias("tail"), F.substring("gram", F.lit(ORDER + 1) - n, n - 1).alias("context")))
    known = reduce(DataFrame.unionByName, tables.grams.values()).select(F.col("gram").alias("tail"), "p")
    steps = grams.select("gram", F.explode(tails).alias("t")).select("gram", "t.*").join(known, "tail", "left").join(tables.contexts, "context", "left")
    steps = steps.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("n", F.col("p").cast("array<double>").alias("p"), F.col("back").cast("array<double>").alias("back")))).alias("steps"))

    def longer(p: Column, step: Column) -> Column:
        return F.when(step["p"].isNotNull(), step["p"]).when(step["back"].isNotNull(), F.zip_with(p, step["back"], lambda x, b: x * b)).otherwise(p)

    p = F.aggregate("steps", F.array_repeat(F.lit(tables.base), size), longer)
    return steps.select("gram", F.transform(p, lambda x: F.round(F.log(x) * SCALE).cast("long")).alias("whole"))


def frequent_model(tables: Tables, langs: list[str], grams: DataFrame) -> Model:
    """A model whose broadcast part has the scores of grams; the tables have all."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, _ = joined_bytes(batch.column("gram"))
            hashes = rows_hash(np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).reshape(-1, ORDER))
            logs = np.log(batch.column("p").flatten().to_numpy()).astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * len(langs)), len(hashes), [None, pa.py_buffer(logs)]).cast(pa.binary())], ["hash", "logs"])

    found = mapped(tables.grams[ORDER].join(grams.select("gram").distinct(), "gram", "left_semi"), hashed, "hash long, logs binary").toArrow()
    hashes = found.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    values = np.frombuffer(joined_bytes(found.column("logs"))[0].tobytes(), "<f4").reshape(-1, len(langs))
    return Model(langs, hashes[order], values[order], tables)


def bounded(counts: DataFrame, most: int) -> DataFrame:
    """counts without the rarest n-grams of a language that has more than most.

    By a threshold on the count to five leading bits, so none of equal count is
    preferred. If more than most share the highest, a hash of the n-gram picks about most of them.
    """
    shift = F.greatest(F.lit(0), F.length(F.bin("n")) - 5)
    level = F.expr("shiftleft(shiftright(n, shift), shift)")
    leveled = counts.withColumn("shift", shift).withColumn("level", level).drop("shift")
    ladder = leveled.groupBy("lang", "level").agg(F.count("*").alias("grams"))
    above = Window.partitionBy("lang").orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = ladder.withColumn("kept", F.sum("grams").over(above)).groupBy("lang").agg(
        F.min(F.when(F.col("kept") <= most, F.col("level"))).alias("least"), F.max("level").alias("top"), F.max_by("grams", "level").alias("top_grams")
    )
    drawn = F.pmod(F.xxhash64("gram"), F.lit(1 << 30)) * F.col("top_grams") < F.lit(most << 30).cast("double")
    kept = F.when(F.col("least").isNotNull(), F.col("level") >= F.col("least")).otherwise((F.col("level") == F.col("top")) & drawn)
    return leveled.join(F.broadcast(cuts), "lang").where(kept).select(*counts.columns)


#: Classes of length: by the number of binary digits. Calibration texts that a language needs.
LENGTHS, KNOWN_TEXTS = 48, 20


def learn(docs: DataFrame, calibrate: Column, max_scores: int = MAX_SCORES, reject_rate: float = 0.001, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from all of docs with text and language; rows where calibrate holds set the limit of rejection instead."""
    usable = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.coalesce(calibrate, F.lit(False)).alias("held")).where("lang is not null and text is not null")
    counts = written(gram_counts(usable.where("not held")))
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([])
    tables = kneser_ney_tables(counts, langs)
    model = frequent_model(tables, langs, bounded(counts, max(1, max_scores // len(langs) ** 2)))
    discard(counts)
    scored = scores(usable.where("held"), model, keep=())
    calibrated(model, scored.where("lang_pred <> 'und'").select("lang_pred", "entropy", "length"), reject_rate)
    return model


def calibrated(model: Model, texts: DataFrame, reject_rate: float) -> None:
    """Set the model's limit from texts (lang_pred, entropy, length) of its languages."""
    texts = written(texts.withColumn("size", F.length(F.bin("length"))))
    enough = [r["lang_pred"] for r in texts.groupBy("lang_pred").count().where(F.col("count") >= KNOWN_TEXTS).collect()]
    texts, every = texts.where(F.col("lang_pred").isin(enough)), texts
    cells = texts.groupBy("lang_pred", "size").agg(F.count("*").alias("n"), F.sum("entropy").alias("s"), F.sum(F.col("entropy") * F.col("entropy")).alias("q")).collect()
    if not cells:
        discard(every)
        return
    n, s, q = (np.array([r[c] for r in cells], float) for c in ("n", "s", "q"))
    lang, size = np.array([model.langs.index(r["lang_pred"]) for r in cells]), np.array([r["size"] for r in cells])
    by_lang = np.bincount(lang, n, len(model.langs))
    usual = np.where(by_lang > 0, np.bincount(lang, s, len(model.langs)) / np.maximum(by_lang, 1), np.inf)
    # A mean over n characters varies as a + b / n; what a class of lengths shows by itself counts more the more texts it has.
    squares = np.maximum(np.bincount(size, q - 2 * usual[lang] * s + n * usual[lang] ** 2, LENGTHS), 0.0)
    texts_of, short = np.bincount(size, n, LENGTHS), 2.0 ** -np.arange(LENGTHS)
    seen = np.flatnonzero(texts_of)
    weight = np.sqrt(texts_of[seen]) / short[seen] ** 0.5
    fit = np.linalg.lstsq(np.stack([np.ones(len(seen)), short[seen]], axis=1) * weight[:, None], squares[seen] / texts_of[seen] * weight, rcond=None)[0]
    law = np.maximum(fit[0], 1e-6) + np.maximum(fit[1], 0.0) * short
    model.usual, model.spread = usual, np.sqrt((squares + 20 * law) / (texts_of + 20))
    usual_of, spread_of = (F.create_map(*chain(*[(F.lit(k), F.lit(float(v))) for k, v in pairs])) for pairs in ([(x, u) for x, u in zip(model.langs, usual, strict=True) if u < np.inf], enumerate(model.spread.tolist())))
    far = texts.select(((F.col("entropy") - usual_of[F.col("lang_pred")]) / spread_of[F.col("size")]).alias("far"))
    decile = far.agg(F.percentile_approx("far", 0.9, 10000)).first()[0]
    beyond = far.where(F.col("far") > decile).agg(F.sum(F.col("far") - decile).alias("s"), F.count("*").alias("n")).first()
    discard(every)
    # The chance that the next text lies x above the decile, given n excesses of sum s, is a tenth of (1 + x / s) ** -n.
    model.limit = decile + beyond["s"] * ((0.1 / reject_rate) ** (1 / beyond["n"]) - 1) if beyond["n"] else float("inf")


def verdicts(model: Model, nats: np.ndarray, letters: np.ndarray, length: np.ndarray) -> list[pa.Array]:
    """lang_pred, score, entropy, length and rejected of texts with these entropies."""
    rows = len(letters)
    names = np.array([*model.langs, "und"], dtype=object)
    none = letters == 0
    if model.langs:
        best = nats.argmin(axis=1)
        least = nats[np.arange(rows), best]
        share = 1 / np.exp(np.maximum(least[:, None] - nats, -50.0)).sum(axis=1)
        high = (least - model.usual[best]) / model.spread[np.frexp(length)[1]] > model.limit if model.usual is not None else np.zeros(rows, bool)
    else:
        best, least, share, none, high = np.zeros(rows, int), np.zeros(rows), np.zeros(rows), np.ones(rows, bool), np.zeros(rows, bool)
    found = names[np.where(none, len(names) - 1, best)]
    return [pa.array(found.tolist(), pa.string()), pa.array(np.where(none, 0.0, share)), pa.array(np.where(none, 0.0, least)), pa.array(length.astype(np.int64)), pa.array(none | high)]


VERDICT = ["lang_pred", "score", "entropy", "length", "rejected"]
VERDICT_TYPES = "lang_pred string, score double, entropy double, length long, rejected boolean"


def scores(docs: DataFrame, model: Model, keep: tuple[str, ...] = (), text_col: str = "text") -> DataFrame:
    """The columns keep, with lang_pred, score (the best language's share, 0 to 1), entropy, length (characters as counted) and rejected.

    5-grams that aren't broadcast are scored by the tables. A text's md5 brings these scores back
    to its rows; equal texts have equal ones.
    """
    size = len(model.langs)
    out = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("mark"), F.col(text_col).alias("_text"))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in out.schema.fields[:-2])
    head = Model(model.langs, usual=model.usual, spread=model.spread, limit=model.limit)
    shared = docs.sparkSession.sparkContext.broadcast((model.hashes, model.values))

    def broadcast_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, values = shared.value
        index = lead_index(hashes)
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                points, ends = folded(*joined_bytes(part.column("_text")))
                length, own = np.diff(ends), gram_hashes(points, ends, ORDER)
                letters = np.concatenate([[0], np.cumsum(points != BLANK)])
                at, hit = probe(hashes, own, index)
                sums, some = np.zeros((part.num_rows, size)), np.flatnonzero(length)
                if len(some) and len(values):
                    sums[some] = np.add.reduceat(np.where(hit[:, None], values[at], np.float32(0)), ends[some], axis=0, dtype=np.float64)
                miss = np.flatnonzero(~hit) if size else np.zeros(0, np.int64)
                text = np.searchsorted(ends, miss, side="right") - 1
                order = np.lexsort((own[miss], text))
                miss, text = miss[order], text[order]
                new = np.ones(len(miss), bool)
                new[1:] = (text[1:] != text[:-1]) | (own[miss[1:]] != own[miss[:-1]])
                first = np.flatnonzero(new)
                grams = windows_at(points, ends, miss[first], ORDER).astype("<u4").tobytes().decode("utf-32-le")
                grams = pa.array([grams[i : i + ORDER] for i in range(0, len(grams), ORDER)], pa.string())
                times = pa.array(np.diff(np.append(first, len(miss))).astype(np.int64))
                starts = np.concatenate([[0], np.cumsum(np.bincount(text[first], minlength=part.num_rows))]).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays([grams, times], ["gram", "n"]))
                whole = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * size), pa.array(sums.reshape(-1)))
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, whole, pa.array(letters[ends[1:]] - letters[ends[:-1]]), pa.array(length), rest], [*part.schema.names[:-1], "sums", "letters", "length", "rest"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            nats = -batch.column("sums").flatten().to_numpy().reshape(-1, size) / np.maximum(length, 1)[:, None] if size else None
            columns = [batch.column(i) for i in range(batch.num_columns - 3)]
            yield pa.RecordBatch.from_arrays([*columns, *verdicts(head, nats, batch.column("letters").to_numpy(), length)], [*batch.schema.names[:-3], *VERDICT])

    near = written(mapped(out, broadcast_part, fields + "mark binary, sums array<double>, letters long, length long, rest array<struct<gram: string, n: long>>"))
    shared.destroy()
    whole = near.drop("rest")
    if size:
        far = near.where(F.size("rest") > 0).dropDuplicates(["mark"]).select("mark", F.explode("rest").alias("r")).select("mark", "r.gram", "r.n")
        scored = written(table_scores(model.tables, near.select(F.explode("rest.gram").alias("gram")).distinct(), size))
        added = far.join(scored, "gram").groupBy("mark").agg(F.array(*[F.sum(F.col("n") * F.col("whole")[i]) for i in range(size)]).alias("added"))
        whole = whole.join(added, "mark", "left")
        sums = F.array(*[F.col("sums")[i] + F.coalesce(F.col("added")[i], F.lit(0)) / SCALE for i in range(size)])
        whole = whole.withColumn("sums", sums)
    whole = whole.select(*[f"k{i}" for i in range(len(keep))], "sums", "letters", "length")
    return mapped(whole, judge, fields + VERDICT_TYPES).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *VERDICT)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; remainder 1 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, length, rejected for every row of docs.

    Learns from the rows that are not held out; of these a tenth (by another
    hash of the id) sets the limit of rejection.
    """
    held = F.coalesce(fold(id_col) == 1, F.lit(False))
    model = learn_from(docs, id_col, lang_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    out = scores(rows, model, keep=("doc_id", "held_out"))
    forget(model)
    return out


def learn_from(docs: DataFrame, id_col: str, lang_col: str, text_col: str, **options) -> Model:
    learning = docs.where(F.coalesce(fold(id_col) != 1, F.lit(True)))
    calibrate = F.pmod(F.xxhash64(F.lit("calibrate"), F.col(id_col).cast("string")), F.lit(10)) == 0
    return learn(learning, calibrate, lang_col=lang_col, text_col=text_col, **options)


def forget(model: Model) -> None:
    """Delete the model's tables, when all that is to be scored is scored."""
    if model.tables is not None:
        discard(*model.tables.grams.values(), model.tables.contexts)


def accepted(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows whose language is rejected; the rejected texts' md5 are taken from docs."""
    model = learn_from(docs, id_col, lang_col, text_col, **options)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    marked = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, names, strict=True)]).where(F.col(text).isNotNull()).withColumn("mark", F.unhex(F.md5(F.col(text).cast("binary"))))
    gone = written(scores(marked, model, keep=("mark",), text_col=text).where("rejected").select("mark").distinct())
    forget(model)
    return marked.join(gone, "mark", "left_anti").select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
