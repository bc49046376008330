"""Fill-in-the-middle: documents as prefix, suffix and middle, cut between tokens.

Tokens are runs of letters A-Z, a-z and single other characters. An automaton of two
states (inside a run of letters or not) counts where tokens begin. A text of up to CHUNK bytes
is scanned by the task that reads it. A longer one is dealt out in chunks, as rows of
a table in the shared folder: each chunk gives its state-transition function and its count for each
state of entry; composing these resolves how each chunk is entered, how many tokens
the text has and which chunks hold the cuts; only those chunks are read again, each where it is,
to find the cut. Both ways use the same functions of automata.py.

The cuts come from the hash of ``seed:id``, so reruns agree. Outputs and the
way back are built by Spark's own string functions.

Defined cases
- text null or empty: the form is plain, n is 0, the output is empty
- a text that holds a sentinel: plain, so an output can always be undone
- id null: hashed as an empty string
- very long texts, texts without letters or of one word alone: as any other
- repeated rows: each gives the same output; rows of one id with different texts are told apart
- an empty table: no rows; extra columns are left out, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automata import Automaton, composed, scanned
from .common import joined_bytes, mapped, releasing, slices, spread, written

#: Bytes of a chunk.
CHUNK = 1 << 16
SLICE_BYTES = 1 << 22
SENTINELS = ("<P>", "<S>", "<M>")

_CLASS = np.ones(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = 0
_CLASS[0x80:0xC0] = 2
#: Classes: a letter, any other first byte of a character, a later byte. States: outside or inside a run of letters.
TOKENS = Automaton(_CLASS, delta=np.array([[1, 1], [0, 0], [0, 1]]), emits=np.array([[1, 0], [1, 1], [0, 0]]), idle=2)


def _characters(data: np.ndarray) -> np.ndarray:
    """Characters before each byte, and in all."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def _cut_ranks(n: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens before the first and the second cut."""
    a, b = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


def _short_cuts(docs: DataFrame) -> DataFrame:
    """n, cut1 and cut2 (characters before each cut) to docs(.., text, h1, h2) of one chunk each."""
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                data, offsets = joined_bytes(part.column("text"))
                scan, chars = scanned(TOKENS, data, offsets), _characters(data)
                n = scan.counts_of_texts()[:, TOKENS.start]
                cuts = []
                for rank in _cut_ranks(n, part.column("h1").to_numpy(), part.column("h2").to_numpy()):
                    inner = np.flatnonzero(rank < n)
                    at = offsets[1:].copy()
                    at[inner] = offsets[inner] + scan.places(inner, np.full(len(inner), TOKENS.start), rank[inner])
                    cuts.append(pa.array(chars[at] - chars[offsets[:-1]]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n), *cuts], [*names, "n", "cut1", "cut2"])

    return mapped(docs, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n long, cut1 long, cut2 long")


def _chunk_functions(chunks: DataFrame) -> DataFrame:
    """key, chunk, h1, h2, chars, ends and counts (by state of entry)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", SLICE_BYTES):
                data, offsets = joined_bytes(part.column("bytes"))
                scan, chars = scanned(TOKENS, data, offsets), _characters(data)
                lists = [pa.array(list(x), pa.list_(pa.int64())) for x in (scan.ends_of_texts(), scan.counts_of_texts())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("key", "chunk", "h1", "h2")), pa.array(np.diff(chars[offsets])), *lists], ["key", "chunk", "h1", "h2", "chars", "ends", "counts"])

    return mapped(chunks, work, "key string, chunk int, h1 long, h2 long, chars long, ends array<long>, counts array<long>")


def _selected(functions: DataFrame) -> DataFrame:
    """key, n, which (cut 1 or 2), chunk, entry, rank (inside the chunk), before (characters before it).

    One row a chunk comes in: a text of the largest size that a string can have gives 32,768.
    A cut at a text's end has no chunk, and all characters before it.
    """

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        ends, counts = (np.array(table.column(c).to_pylist(), np.int64).reshape(-1, TOKENS.states) for c in ("ends", "counts"))
        ends, counts = composed(ends, counts, np.array([len(ends)]))
        inclusive = counts[:, TOKENS.start]
        entry = np.concatenate([[TOKENS.start], ends[:-1, TOKENS.start]])
        chars = np.concatenate([[0], np.cumsum(table.column("chars").to_numpy())])
        n, rows = inclusive[-1], []
        ranks = _cut_ranks(inclusive[-1:], table.column("h1").to_numpy()[:1], table.column("h2").to_numpy()[:1])
        for which, rank in enumerate((int(r[0]) for r in ranks), start=1):
            k = int(np.searchsorted(inclusive, rank, side="right"))
            inside = k < len(inclusive)
            rows.append((table.column("key")[0].as_py(), int(n), which, k if inside else None, int(entry[k]) if inside else 0, rank - (int(inclusive[k - 1]) if inside and k else 0), int(chars[k])))
        return pa.table([*zip(*rows, strict=True)], names=["key", "n", "which", "chunk", "entry", "rank", "before"]).cast(_SELECTED)

    return functions.groupBy("key").applyInArrow(releasing(work), "key string, n long, which int, chunk int, entry int, rank long, before long")


_SELECTED = pa.schema([("key", pa.string()), ("n", pa.int64()), ("which", pa.int32()), ("chunk", pa.int32()), ("entry", pa.int32()), ("rank", pa.int64()), ("before", pa.int64())])


def _found(wanted: DataFrame) -> DataFrame:
    """key, n, which, cut of wanted with the bytes of their chunks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", SLICE_BYTES):
                data, offsets = joined_bytes(part.column("bytes"))
                scan, chars, every = scanned(TOKENS, data, offsets), _characters(data), np.arange(part.num_rows)
                at = offsets[:-1] + scan.places(every, part.column("entry").to_numpy().astype(np.int64), part.column("rank").to_numpy())
                cut = part.column("before").to_numpy() + chars[at] - chars[offsets[:-1]]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("key", "n", "which")), pa.array(cut)], ["key", "n", "which", "cut"])

    return mapped(wanted, work, "key string, n long, which int, cut long")


def _long_cuts(docs: DataFrame) -> DataFrame:
    """n, cut1 and cut2 to docs(.., text, h1, h2) of several chunks each."""
    key = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text"), 256)
    raw = docs.withColumn("key", key)
    pieces = F.transform(
        F.sequence(F.lit(0), F.ceil(F.octet_length("text") / CHUNK).cast("int") - 1), lambda i: F.struct(i.alias("chunk"), F.substr(F.col("text").cast("binary"), i * CHUNK + 1, F.lit(CHUNK)).alias("bytes"))
    )
    cells = raw.select("key", "h1", "h2", F.explode(pieces).alias("c")).select("key", "h1", "h2", "c.chunk", "c.bytes")
    chunks = written(cells.repartition(spread(docs.sparkSession), "key", "chunk"))
    functions = _chunk_functions(chunks).dropDuplicates(["key", "chunk"])
    selected = written(_selected(functions))
    wanted = selected.where("chunk IS NOT NULL").join(chunks.select("key", "chunk", "bytes"), ["key", "chunk"])
    cuts = _found(wanted).unionByName(selected.where("chunk IS NULL").select("key", "n", "which", F.col("before").alias("cut")))
    both = cuts.groupBy("key").agg(F.first("n").alias("n"), *[F.max(F.when(F.col("which") == k, F.col("cut"))).alias(f"cut{k}") for k in (1, 2)])
    return raw.join(both, "key").drop("key")


def fill_in_middle(docs: DataFrame, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20, sentinels: Sequence[str] = SENTINELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain), output.

    plain_percent of the documents stay as they are; of the others spm_percent have the suffix first.
    """
    prefix_mark, suffix_mark, middle_mark = sentinels
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substr(digest, F.lit(8 * k - 7), F.lit(8)), 16, 10).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({f"h{k}": number(k) for k in (1, 2, 3, 4)})
    size = F.octet_length("text")
    cut = _short_cuts(rows.where(size <= CHUNK)).unionByName(_long_cuts(rows.where(size > CHUNK)))
    text = F.col("text")
    holds = F.contains(text, F.lit(prefix_mark)) | F.contains(text, F.lit(suffix_mark)) | F.contains(text, F.lit(middle_mark))
    form = F.when((text == "") | holds | (F.col("h3") % 100 >= 100 - plain_percent), "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    cut = cut.withColumn("form", form)
    one, a, b = F.lit(1), F.col("cut1").cast("int"), F.col("cut2").cast("int")
    prefix, middle, suffix = F.substr(text, one, a), F.substr(text, a + 1, b - a), F.substr(text, b + 1, F.length(text) - b)
    p, s, m = F.lit(prefix_mark), F.lit(suffix_mark), F.lit(middle_mark)
    output = F.when(F.col("form") == "plain", text).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    cuts = [F.when(F.col("form") != "plain", x).alias(c) for x, c in ((F.col("cut1"), "prefix_chars"), (F.col("cut2") - F.col("cut1"), "middle_chars"))]
    return cut.select("doc_id", "n", "form", *cuts, output.alias("output"))


def restored(form: Column, output: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text of an output."""
    p, s, m = map(F.lit, sentinels)

    def between(first: Column, second: Column) -> tuple[Column, Column, Column]:
        """The three parts of an output in their order; no part holds a sentinel."""
        i, j = F.position(second, output), F.position(m, output)
        return F.substr(output, F.length(first) + 1, i - F.length(first) - 1), F.substr(output, i + F.length(second), j - i - F.length(second)), F.substr(output, j + F.length(m), F.length(output))

    prefix, suffix, middle = between(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(s, p)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
