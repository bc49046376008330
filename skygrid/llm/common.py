"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: the space and the ASCII controls from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; read by Spark alone, so any path that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where unset (tests), a local one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "skygrid-shared")


_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_SCOPES: list[list[str]] = []


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder (with a folder for each value of by), read back.

    This cuts the lineage: a lost executor costs a reread, not a recomputation,
    and what is used several times is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skygrid-{uuid.uuid4().hex}"
    df.write.partitionBy(*[by] * bool(by)).option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    if _SCOPES:
        _SCOPES[-1].append(path)
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table's folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing will read again."""
    for table in tables:
        if path := _PATHS.pop(table, None):
            removed(table.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What written() leaves inside goes at the end; a result must be written or collected before that."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            removed(spark, path)


_LIBC: list[ctypes.CDLL] = []


def release() -> None:
    """Give memory that a Python worker has freed back to the system: workers live on, next to their executor's heap."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        if not _LIBC:
            _LIBC.append(ctypes.CDLL("libc.so.6"))
        _LIBC[0].malloc_trim(0)


#: Rows that pass between the JVM and Python at a time; texts are long.
BATCH_ROWS = 1000


def mapped(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """df.mapInArrow(work, schema) with batches of texts that fit, and workers that end small."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def releasing(work: Callable) -> Callable:
    """work for a group, after which the worker ends small."""

    def one(table):  # noqa: ANN001, ANN202
        try:
            return work(table)
        finally:
            release()

    def keyed(key, left, right):  # noqa: ANN001, ANN202
        try:
            return work(key, left, right)
        finally:
            release()

    return one if work.__code__.co_argcount == 1 else keyed


def spread(spark: SparkSession) -> int:
    """Partitions for a shuffle that is asked for by hand."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """name, or a variant that no column of df has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def text_bytes(text: str = "text") -> F.Column:
    """Bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


# --- hashing in numpy, for work on whole Arrow batches ------------------------------------------------------------

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # splitmix64's constants
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over an array of uint64."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, to read only; kept for the next call."""
    if base not in _POWERS or n > len(_POWERS[base]):
        out = np.full(max(n, 1), base, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > 1 << 23:
            return out
        _POWERS[base] = out
    return _POWERS[base][:n]


#: Two primes just below 2**31, and a base for each. Sums modulo a prime have no strings that agree for every base, as sums modulo 2**64 have.
PRIMES, BASES = (2147483647, 2147483629), (1486287349, 1911520717)
_PRIME_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _prime_powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo prime, to read only; kept for the next call."""
    out = _PRIME_POWERS.get((base, prime), np.ones(1, np.uint32))
    while len(out) < n:
        more = out[: max(1, -(-n // 65536) * 65536 - len(out))]
        out = np.concatenate([out, (more * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)).astype(np.uint32)])
    if len(out) <= 1 << 23:
        _PRIME_POWERS[base, prime] = out
    return out[:n]


def _power_at(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    """base**exponents modulo prime, from two short tables."""
    high = _prime_powers(pow(base, 4096, prime), prime, int(exponents.max(initial=0) >> 12) + 1)
    return _prime_powers(base, prime, 4096)[exponents & 4095] * high[exponents >> 12].astype(np.uint64) % np.uint64(prime)


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each span of the bytes, from prefix sums modulo two primes; equal for equal bytes wherever they lie."""
    out = np.zeros(len(start), np.uint64)
    for prime, base in zip(PRIMES, BASES, strict=True):
        p = np.uint64(prime)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.multiply(data + np.uint16(1), _prime_powers(base, prime, len(data)), out=sums[1:], dtype=np.uint64)
        if len(data) > 1 << 23:
            sums %= p  # so that sums of up to 2**32 terms fit
        np.cumsum(sums, out=sums)
        out = (out << np.uint64(31)) + (sums[stop] - sums[start]) % p * _power_at(pow(base, -1, prime), prime, start) % p
    return mix64(out + mix64((stop - start).astype(np.uint64)))


def joined_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column end to end, and len + 1 offsets; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch, column: str, most_bytes: int = 1 << 23):
    """An Arrow batch in runs of whole rows of up to most_bytes in column (one row, if that is longer)."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(size), 0
    while start < len(size):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
