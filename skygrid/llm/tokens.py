"""Token ids as Parquet list columns, written and read by Spark.

The file format is Parquet with one row a document: ``part`` and ``row`` (place in
the output's order), the id, ``n_tokens`` and the list ``ids``. The writer is
Spark's, told to use data pages of version 2, in which integers without a
dictionary are delta-encoded and bit-packed; row groups and pages have set sizes,
and each file carries column and offset indexes. So a reader that asks for some
documents opens the pages that hold them, and one that asks for lengths reads
no tokens. As Spark writes and commits the files, a lost executor costs its tasks
only and any file system will do.

Encoding looks at whole texts but calls the tokenizer once for each distinct piece
of text between two safe cuts (a single space between characters that are not
blank is one; byte-level BPE never joins across it), and keeps what it learns
for the next batch, within a bound.

Defined cases
- text null or empty: no ids but the end id
- very long texts: one row, encoded whole
- repeated ids: each row is written, next to each other
- an empty table: files without rows
- extra columns stay out, whatever their names
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import joined_bytes, mapped, slices, spread
from .pieces import Memory

SLICE_BYTES = 1 << 22
#: Pieces that are encoded as one text.
ROW = 256

_ENCODERS: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """A tokenizer, and the pieces that it has met."""

    def __init__(self, path: str, specials_as_text: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id: a letter of a byte-level token is a byte
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.memory = Memory(self._learn)

    def _learn(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece. Pieces that may stand one after another are encoded so, and told apart by their bytes."""
        joins = [p[0] == " " and len(p) > 1 and ("!" <= p[1] <= "~" or "\u00c0" <= p[1] <= "\u07ff") and "!" <= p[-1] <= "~" for p in pieces]
        row = [p for p, j in zip(pieces, joins, strict=True) if j]
        texts = ["".join(row[k : k + ROW]) for k in range(0, len(row), ROW)] + [p for p, j in zip(pieces, joins, strict=True) if not j]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        rows = len(texts) - (len(pieces) - len(row))
        flat = np.fromiter(chain.from_iterable(found[:rows]), np.int32)
        ends = np.cumsum([len(p.encode()) for p in row], dtype=np.int64)
        at = np.searchsorted(np.cumsum(self.width[flat]), ends).tolist()
        in_row, alone = ((flat[a + 1 : b + 1] for a, b in zip([-1, *at], at, strict=False)), (np.array(x, np.int32) for x in found[rows:]))
        return [next(in_row) if j else next(alone) for j in joins]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        ids, counts = self.memory.encode(data, offsets, piece_starts(data, offsets))
        if end_id is None:
            return ids, counts
        out = np.full(len(ids) + len(counts), end_id, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return out, counts + 1


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the texts may be cut without changing their ids, the start of each non-empty text included.

    That is before a space, and before and after a line feed, that stands alone between two characters
    which are certainly not blank: ASCII signs, or characters of two bytes from U+00C0 on.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        sign = (data > 0x20) & (data < 0x7F)
        lead = (data >= 0xC3) & (data <= 0xDF)
        before = sign[: n - 2].copy()
        before[1:] |= (data[1 : n - 2] >= 0x80) & lead[: n - 3]
        alone = before & (sign[2:] | lead[2:])
        line = alone & (data[1 : n - 1] == 0x0A)
        cut[1 : n - 1] = (alone & (data[1 : n - 1] == 0x20)) | line
        cut[2:n] |= line
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut[:n])


def encoder(path: str, specials_as_text: bool) -> Encoder:
    """This worker's encoder, which outlives its tasks."""
    if (path, specials_as_text) not in _ENCODERS:
        _ENCODERS[path, specials_as_text] = Encoder(path, specials_as_text)
    return _ENCODERS[path, specials_as_text]


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int | None = 0, specials_as_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part, row, doc_id, n_tokens, ids; partitions and rows ascend with doc_id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, specials_as_text)
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                ids, counts = own.encode(*joined_bytes(piece.column("text")), end_id)
                n = len(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), piece.column("doc_id"), pa.array(counts), lists],
                    ["part", "row", "doc_id", "n_tokens", "ids"],
                )
                row += n

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = narrow.repartitionByRange(spread(docs.sparkSession), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return mapped(ordered, work, "part int, row long, doc_id long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 0, encoding: str = "delta", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000, **options) -> None:
    """Encode docs and write the table at path. encoding of the ids: "delta" or "dictionary"."""
    if encoding not in ("delta", "dictionary"):
        raise ValueError(f"unknown encoding {encoding!r}")
    writer = encoded(docs, tokenizer_path, end_id, **options).write.option("compression", "zstd")
    writer = writer.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
    writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes).option("parquet.page.row.count.limit", page_rows)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The table. Filters on doc_id and narrower selections reach the files' pages and columns."""
    return spark.read.schema("part int, row long, doc_id long, n_tokens long, ids array<int>").parquet(path)


def token_starts(tokens: DataFrame) -> DataFrame:
    """part, row, start: ids of all documents before each one. Reads no ids."""
    lengths = tokens.select("part", "row", "n_tokens")
    parts = lengths.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return lengths.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(F.broadcast(parts), "part").select("part", "row", (F.col("first") + F.col("inside")).alias("start"))


def token_checks(tokens: DataFrame) -> DataFrame:
    """part, row, doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), from the ids read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("row"), batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())], ["part", "row", "doc_id", "n_tokens", "ids_crc32"]
            )

    return mapped(tokens.select("part", "row", "doc_id", "ids"), work, "part int, row long, doc_id long, n_tokens long, ids_crc32 long")


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32."""
    return token_checks(tokens).join(token_starts(tokens), ["part", "row"]).select("doc_id", "start", "n_tokens", "ids_crc32")
