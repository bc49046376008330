"""The hourly archive: which files there are, where they lie, and landing them by tasks in a shared store."""

from __future__ import annotations

import http.client
import os
import time
import urllib.error
import urllib.request
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.plans.products import Product
from skygrid.sources import store

#: Answers after which another attempt makes sense.
TRY_AGAIN = frozenset({408, 429, 500, 502, 503, 504})


def hours(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """hour: every hour from start to end, both included."""
    a, b = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (start, end))
    return spark.range(1).where(a <= b).select(F.explode(F.sequence(a, b, F.expr("INTERVAL 1 HOUR"))).alias("hour"))


def hourly_urls(hour: DataFrame, product: Product, root: str) -> DataFrame:
    """hour, url of each hour's file below the archive's root."""
    day, name = F.date_format("hour", "yyyy/MM/dd"), F.date_format("hour", "yyyyMMdd_HH'00.gz'")
    return hour.withColumn("url", F.concat_ws("/", F.lit(root.rstrip("/")), day, F.lit(product.folder), name))


def local_name(url: F.Column, product: Product) -> F.Column:
    """Name of a landed file: the product's, then the file's."""
    return F.concat(F.lit(f"{product.name}."), F.element_at(F.split(url, "/"), -1))


def table_name(file: F.Column) -> F.Column:
    """Name of what a landed file becomes: with .nc for its last suffix."""
    return F.concat(F.regexp_replace(file, r"\.[^./]*$", ""), F.lit(".nc"))


def not_yet_ingested(wanted: DataFrame, manifest: DataFrame, key: str = "url") -> DataFrame:
    """What is wanted and not in the manifest with all its columns (complete)."""
    return wanted.join(manifest.where("complete").select(key), key, "left_anti")


class _Inflating:
    """Whether what passes through is a whole gzip file: every member inflates to its end and agrees with its checksum."""

    def __init__(self) -> None:
        self.inflate, self.members, self.pending, self.broken = zlib.decompressobj(wbits=31), 0, False, False

    def feed(self, block: bytes) -> None:
        if self.members and not self.pending:
            block = block.lstrip(b"\0")
        try:
            while block and not self.broken:
                self.inflate.decompress(block)
                block = self.inflate.unused_data
                self.pending = True
                if self.inflate.eof:
                    self.inflate, self.members = zlib.decompressobj(wbits=31), self.members + 1
                    block = block.lstrip(b"\0")  # padding after the last member
                    self.pending = bool(block)
        except zlib.error:
            self.broken = True

    @property
    def whole(self) -> bool:
        return self.members > 0 and not self.pending and not self.broken


def gzip_is_whole(path: str | os.PathLike) -> bool:
    """Whether a gzip file is whole."""
    check = _Inflating()
    try:
        with open(path, "rb") as f:
            while block := f.read(1 << 20):
                check.feed(block)
    except OSError:
        return False
    return check.whole


def exists(url: str, timeout: float = 10.0, opener: Callable = urllib.request.urlopen) -> bool:
    """Whether a URL answers; asked by GET where HEAD isn't allowed."""
    for method in ("HEAD", "GET"):
        try:
            with opener(urllib.request.Request(url, method=method), timeout=timeout) as answer:
                return answer.status == 200
        except urllib.error.HTTPError as e:
            if e.code == 404 or e.code >= 500:
                return False
        except (OSError, http.client.HTTPException):
            return False
    return False


class CutShort(ConnectionError):
    """A transfer that ended before the file did."""


def fetch(url: str, target: str, known: str | None = None, retries: int = 3, delay: float = 2.0, timeout: float = 60.0, opener: Callable = urllib.request.urlopen) -> tuple[str, int, bool]:
    """Land one file at target, a URI of a store; its ETag, its bytes, and whether it was transferred. A file with the ETag known stays.

    Blocks pass through this process and are checked on their way. The file appears under its name only when it is
    complete: a transfer that was cut, or a .gz that doesn't inflate, is tried again. Whoever fetches a file
    twice puts one whole file in place of another.
    """
    system, path = store.at(target)
    zipped = path.lower().endswith(".gz")
    for attempt in range(retries + 1):
        try:
            with opener(urllib.request.Request(url, method="HEAD"), timeout=timeout) as head:
                etag = head.headers.get("ETag")
            if not etag:
                raise ValueError(f"{url}: no ETag")
            there = system.get_file_info(path)
            if etag == known and there.type == fs.FileType.File:
                return etag, there.size, False
            part, check, n = f"{path}.{uuid.uuid4().hex}.part", _Inflating(), 0
            try:
                with opener(urllib.request.Request(url), timeout=timeout) as body, system.open_output_stream(part) as out:
                    while block := body.read(1 << 20):
                        out.write(block)
                        n += len(block)
                        if zipped:
                            check.feed(block)
                    expected = body.headers.get("Content-Length")
                if (zipped and not check.whole) or (expected is not None and int(expected) != n):
                    raise CutShort(f"{url}: cut short")
                system.move(part, path)
            finally:
                if system.get_file_info(part).type == fs.FileType.File:
                    system.delete_file(part)
            return etag, n, True
        except urllib.error.HTTPError as e:
            if e.code not in TRY_AGAIN or attempt == retries:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError, http.client.HTTPException):
            if attempt == retries:
                raise
        time.sleep(delay * 2**attempt)
    raise AssertionError("unreachable")


LANDED = "url string, file string, etag string, bytes long, transferred boolean, error string"


def land(wanted: DataFrame, folder: str, per_host: int = 8, **options) -> DataFrame:
    """url, file, etag, bytes, transferred, error: one row for each row of wanted(url, file, and etag where known).

    Tasks land the files in a folder of the shared store, at most per_host at a time from one host, as a host's files
    are dealt into so many partitions. Nothing of a file passes through the driver. A task that runs again finds its
    files or replaces them whole. The result is lazy: write it (``land_interval`` does), and read what was written.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store.at(folder)
        system.create_dir(path, recursive=True)
        for batch in batches:
            for url, file, known in zip(*(batch.column(c).to_pylist() for c in ("url", "file", "etag")), strict=True):
                try:
                    row = (url, file, *fetch(url, f"{folder.rstrip('/')}/{file}", known, **options), None)
                except (OSError, ValueError, http.client.HTTPException) as e:
                    row = (url, file, None, None, False, str(e) or type(e).__name__)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _LANDED.types, strict=True)], schema=_LANDED)

    rows = wanted if "etag" in wanted.columns else wanted.withColumn("etag", F.lit(None).cast("string"))
    host = F.element_at(F.split("url", "/"), 3)
    hosts = max(1, rows.select(host).distinct().count())
    slot = F.pmod(F.xxhash64("url"), F.lit(per_host))
    return rows.select("url", "file", "etag").repartition(hosts * per_host, host, slot).mapInArrow(work, LANDED)


_LANDED = pa.schema([("url", pa.string()), ("file", pa.string()), ("etag", pa.string()), ("bytes", pa.int64()), ("transferred", pa.bool_()), ("error", pa.string())])


def last_landed(landed: DataFrame) -> DataFrame:
    """url, etag of the last time that each file was landed; landed: all results, with run."""
    return landed.where("error IS NULL").groupBy("url").agg(F.max_by("etag", "run").alias("etag"))


def land_interval(spark: SparkSession, product: Product, start: datetime, end: datetime, root: str, folder: str, log: str, per_host: int = 8, refresh: bool = False, **options) -> DataFrame:
    """Land the archive's files of all hours from start to end; the rows of this run, which are added to the table at log.

    A file whose ETag is that of the last time isn't transferred again, unless refresh.
    """
    wanted = hourly_urls(hours(spark, start, end), product, root).select("url", local_name(F.col("url"), product).alias("file"))
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not refresh and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        wanted = wanted.join(last_landed(spark.read.parquet(log)), "url", "left")
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    land(wanted, folder, per_host, **options).withColumn("run", F.lit(run)).write.mode("append").parquet(log)
    return spark.read.parquet(log).where(F.col("run") == run)


def remove_landed(files: DataFrame) -> int:
    """Drop files (URIs in column file) from their store; tasks do so. How many there were."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                system, path = store.at(uri)
                if system.get_file_info(path).type == fs.FileType.File:
                    system.delete_file(path)
                    yield pa.RecordBatch.from_pydict({"file": [uri]})

    return files.select("file").mapInArrow(work, "file string").count()
