"""NetCDF classic files (plain or gzip) as a data source: ``spark.read.format("netcdf3")``.

Each record is a row. The schema names the variables that are wanted; only these are decoded, by strided views of a block of
records, without a loop over cells. Large plain files are read by ranges of records, in as many tasks as their size asks for. Comparisons of
numbers are pushed into the reader (with spark.sql.python.filterPushdown.enabled). Fill and missing values that a variable
declares become null, character arrays become binary or, without the NULs at their end, strings; other variables of several dimensions are read as array columns.

Hourly series are written in the same format, by ``df.write.format("netcdf3")``: see ``CubeWriter``.

Options: ``onInvalid`` ("raise", or "skip" to leave out files that can't be read; ``header_catalogue`` names them and says why),
``partitionBytes`` (of a plain file that a task reads). Two more columns may be asked for: source_file and record_pos.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from skygrid.sources import store

# Fixed values of the format: type codes and tags.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12

ORIGIN = ("source_file", "record_pos")
#: Bytes of records that are decoded together, and of a header that are read first.
BLOCK_BYTES, HEAD_BYTES = 32 << 20, 1 << 16
#: Bytes of a plain file that a task reads.
PARTITION_BYTES = 128 << 20


class InvalidFile(ValueError):
    """A file that isn't NetCDF classic, is cut short, or lacks a column."""


class _Short(Exception):
    """The header goes on beyond the bytes at hand."""


@dataclass
class Variable:
    name: str
    dims: tuple[tuple[str, int], ...]  # name and length; 0: one for each record
    attrs: dict[str, object]
    kind: np.dtype
    begin: int

    @property
    def recorded(self) -> bool:
        return bool(self.dims) and self.dims[0][1] == 0

    @property
    def cell(self) -> int:
        """Bytes of one row."""
        return int(np.prod([n for _, n in self.dims[1:]], dtype=np.int64)) * self.kind.itemsize

    def fills(self) -> np.ndarray:
        """Values that stand for none, the declared fill value last."""
        found = [self.attrs[a] for a in ("missing_value", "_FillValue") if a in self.attrs and not isinstance(self.attrs[a], str)]
        return np.concatenate(found) if found else np.zeros(0)


@dataclass
class Header:
    records: int
    dims: list[tuple[str, int]]
    attrs: dict[str, object]
    variables: dict[str, Variable]
    size: int = field(default=0)  # bytes that were parsed

    @property
    def step(self) -> int:
        """Bytes from one record to the next."""
        found = [v.cell for v in self.variables.values() if v.recorded]
        return found[0] if len(found) == 1 else sum(-(-n // 4) * 4 for n in found)

    def first_record(self) -> int:
        return min((v.begin for v in self.variables.values() if v.recorded), default=0)

    def rows(self, columns: Sequence[str]) -> int:
        """Length of the dimension that the columns share."""
        absent = [c for c in columns if c not in self.variables]
        if absent:
            raise InvalidFile(f"no variable {', '.join(absent)}")
        leading = {self.variables[c].dims[:1] for c in columns}
        if len(leading) > 1 or () in leading:
            raise InvalidFile(f"columns of different dimensions: {', '.join(columns)}")
        return next((n or self.records for ((_, n),) in leading), self.records)


class _Parser:
    def __init__(self, raw: bytes) -> None:
        self.raw, self.at = raw, 4

    def take(self, n: int) -> bytes:
        self.at += n
        if self.at > len(self.raw):
            raise _Short
        return self.raw[self.at - n : self.at]

    def int(self) -> int:
        return struct.unpack(">i", self.take(4))[0]

    def padded(self, n: int) -> bytes:
        if n < 0:
            raise InvalidFile("broken header")
        return self.take(-(-n // 4) * 4)[:n]

    def count(self, tag: int) -> int:
        got, n = self.int(), self.int()
        if got not in (0, tag) or n < 0 or (got == 0 and n):
            raise InvalidFile("broken header")
        return n

    def attributes(self) -> dict[str, object]:
        out = {}
        for _ in range(self.count(ATTRIBUTE)):
            name, kind = self.padded(self.int()).decode(), np.dtype(TYPES[self.int()])
            raw = self.padded(self.int() * kind.itemsize)
            out[name] = raw.decode("utf-8", "replace").rstrip("\0") if kind.kind == "S" else np.frombuffer(raw, kind)
        return out

    def header(self) -> Header:
        wide = self.raw[3] == 2
        records = self.int()
        dims = [(self.padded(self.int()).decode(), self.int()) for _ in range(self.count(DIMENSION))]
        attrs, found = self.attributes(), {}
        for _ in range(self.count(VARIABLE)):
            name = self.padded(self.int()).decode()
            own = tuple(dims[self.int()] for _ in range(self.int()))
            notes, kind = self.attributes(), np.dtype(TYPES[self.int()])
            self.int()  # the size that the file states; it follows from the dimensions
            found[name] = Variable(name, own, notes, kind, struct.unpack(">q" if wide else ">i", self.take(8 if wide else 4))[0])
        return Header(records, dims, attrs, found, self.at)


def header(stream: BinaryIO, size: int | None = None) -> Header:
    """The header at the start of a stream; reads little more than it has. size: of the whole file, if known."""
    raw = stream.read(HEAD_BYTES)
    if raw[:3] != b"CDF" or raw[3:4] not in (b"\x01", b"\x02"):
        raise InvalidFile("not NetCDF classic")
    while True:
        try:
            found = _Parser(raw).header()
            break
        except _Short as e:
            more = stream.read(len(raw))
            if not more:
                raise InvalidFile("cut short") from e
            raw += more
        except (struct.error, KeyError, IndexError, UnicodeDecodeError) as e:
            raise InvalidFile(f"broken header: {e}") from e
    if found.records < 0 and size is not None and found.step:  # still being written to when it was closed
        found.records = max(0, (size - found.first_record()) // found.step)
    return found


def _zipped(stream: BinaryIO) -> bool:
    magic = stream.read(2)
    stream.seek(0)
    return magic == b"\x1f\x8b"


class _Opened:
    """A file, inflated if it is gzip."""

    def __init__(self, uri: str) -> None:
        system, path = store.at(uri)
        self.file = system.open_input_file(path)
        self.zipped = _zipped(self.file)
        self.stream = gzip.GzipFile(fileobj=self.file) if self.zipped else self.file
        self.size = None if self.zipped else self.file.size()

    def __enter__(self) -> _Opened:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def bytes(self, begin: int, n: int) -> bytes:
        self.stream.seek(begin)
        out = self.stream.read(n)
        if len(out) < n:
            raise InvalidFile("cut short")
        return out

    def to_the_end(self) -> None:
        """Inflate what is left, which checks its checksum."""
        while self.zipped and self.stream.read(1 << 20):
            pass


_SPARK = {"i1": types.ByteType(), ">i2": types.ShortType(), ">i4": types.IntegerType(), ">f4": types.FloatType(), ">f8": types.DoubleType()}


def _array(variable: Variable, flat: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow column of the cells of a variable (rows of bytes)."""
    n = len(flat)
    if pa.types.is_binary(kind) or pa.types.is_string(kind):
        flat = np.ascontiguousarray(flat)
        if pa.types.is_binary(kind):
            if not flat.shape[1]:
                return pa.array([b""] * n, kind)
            return pa.FixedSizeBinaryArray.from_buffers(pa.binary(flat.shape[1]), n, [None, pa.py_buffer(flat)]).cast(kind)
        some = flat != 0
        length = np.where(some.any(axis=1), flat.shape[1] - np.argmax(some[:, ::-1], axis=1), 0) if flat.shape[1] else np.zeros(n, np.int64)
        kept = flat[np.arange(flat.shape[1]) < length[:, None]]
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(kept))])
        try:
            return found.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that aren't UTF-8
            return pa.array([b.decode("utf-8", "replace") for b in found.to_pylist()], pa.string())
    if variable.kind.kind == "S":
        raise InvalidFile(f"{variable.name} holds characters")
    values = np.ascontiguousarray(flat).view(variable.kind)
    if pa.types.is_list(kind):
        each = Variable(variable.name, variable.dims[:1], variable.attrs, variable.kind, 0)
        inner = _array(each, np.ascontiguousarray(values).reshape(-1, 1).view(np.uint8), kind.value_type)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * values.shape[1], pa.int32()), inner)
    if values.shape[1:] != (1,):
        raise InvalidFile(f"{variable.name} has more than one value a row")
    values = values[:, 0]
    missing = np.isin(values, variable.fills().astype(variable.kind))
    if variable.kind.kind == "f":
        missing |= np.isnan(values)
    return pa.array(values.astype(kind.to_pandas_dtype()), kind, mask=missing)


_COMPARED = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal}


def batches(uri: str, schema: pa.Schema, part: int = 0, parts: int = 1, filters: Sequence[tuple[str, str, float]] = ()) -> Iterator[pa.RecordBatch]:
    """The rows of one of so many equal ranges of a file's records that pass the filters (column, name of a numpy comparison, value)."""
    columns = [c for c in schema.names if c not in ORIGIN]
    tested = dict.fromkeys([*columns, *(c for c, _, _ in filters)])
    with _Opened(uri) as opened:
        head = header(opened.stream, opened.size)
        n = head.rows(list(tested))
        wanted = sorted((head.variables[c] for c in tested), key=lambda v: v.begin)
        recorded = not wanted or wanted[0].recorded
        step = head.step if recorded else 0
        if opened.size is not None and n:
            last = max((v.begin + (n - 1) * (step if recorded else v.cell) + v.cell for v in wanted), default=0)
            if last > opened.size:
                raise InvalidFile("cut short")
        base, a, stop = head.first_record(), n * part // parts, n * (part + 1) // parts
        row = max(1, step if recorded else sum(v.cell for v in wanted))
        while a < stop:
            b = min(stop, a + max(1, BLOCK_BYTES // row))
            cells = {}
            block = opened.bytes(base + a * step, (b - a - 1) * step + max(v.begin - base + v.cell for v in wanted)) if recorded and wanted else b""
            for v in wanted:
                if recorded:
                    cells[v.name] = np.ndarray((b - a, v.cell), np.uint8, block, v.begin - base, (step, 1))
                else:
                    cells[v.name] = np.frombuffer(opened.bytes(v.begin + a * v.cell, (b - a) * v.cell), np.uint8).reshape(b - a, v.cell)
            good = np.ones(b - a, bool)
            for c, compare, value in filters:
                v = head.variables[c]
                x = np.ascontiguousarray(cells[c]).view(v.kind)[:, 0]
                good &= getattr(np, compare)(x.astype(np.float64), value) & ~np.isin(x, v.fills().astype(v.kind))
            kept = slice(None) if good.all() else np.flatnonzero(good)
            arrays = []
            for f in schema:
                if f.name == "source_file":
                    arrays.append(pa.array([uri] * int(good.sum()), f.type))
                elif f.name == "record_pos":
                    arrays.append(pa.array(np.arange(a, b)[kept], f.type))
                else:
                    arrays.append(_array(head.variables[f.name], cells[f.name][kept], f.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            a = b
        opened.to_the_end()


_BROKEN = (struct.error, OSError, EOFError, zlib.error)


def _reason(uri: str, error: Exception) -> InvalidFile:
    return InvalidFile(f"{uri}: {error}")


@dataclass
class Range(InputPartition):
    uri: str
    part: int
    parts: int


class NetCDFReader(DataSourceReader):
    def __init__(self, schema: types.StructType, options: dict[str, str]) -> None:
        self.schema, self.files = schema, _files(options)
        self.skip, self.bytes = options.get("oninvalid", options.get("onInvalid", "raise")), int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        if self.skip not in ("raise", "skip"):
            raise ValueError(f"onInvalid: {self.skip}")
        self.filters: list[tuple[str, str, float]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        numbers = {f.name for f in self.schema if isinstance(f.dataType, (types.FloatType, types.DoubleType))}
        for f in filters:
            compare = _COMPARED.get(type(f))
            # A float is compared as the number that Spark holds; other types and nested columns stay with Spark.
            if compare is not None and len(f.attribute) == 1 and f.attribute[0] in numbers and isinstance(f.value, float) and f.value == f.value:
                self.filters.append((f.attribute[0], compare.__name__, f.value))
            else:
                yield f

    def partitions(self) -> list[Range]:
        out = []
        for info, uri in self.files:
            parts = 1 if uri.endswith(".gz") else max(1, -(-info // self.bytes))
            out += [Range(uri, k, parts) for k in range(parts)]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.parts:
            return
        schema = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in self.schema])
        try:
            with _Opened(partition.uri) as opened:
                zipped = opened.zipped
            if zipped and partition.part:
                return  # gzip without its ending in the name is read by one task
            found = batches(partition.uri, schema, partition.part, 1 if zipped else partition.parts, self.filters)
            # Whether a gzip file is whole shows at its end, so its rows (the wanted columns of one file) wait for it.
            yield from list(found) if zipped else found
        except (InvalidFile, *_BROKEN) as e:
            if self.skip == "raise":
                raise _reason(partition.uri, e) from e


_ARROW = {"binary": pa.binary(), "string": pa.string(), "float": pa.float32(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}
_ARROW |= {f"array<{k}>": pa.list_(t) for k, t in _ARROW.items() if k not in ("binary", "string")}


def _files(options: dict[str, str]) -> list[tuple[int, str]]:
    """(bytes, URI) of all files below the paths, without hidden ones and those that landing leaves beside them."""
    import re

    paths = json.loads(options["paths"]) if options.get("paths") else [options["path"]]
    out = []
    for uri in paths:
        system, path = store.at(uri)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(uri)
        found = system.get_file_info(fs.FileSelector(path, recursive=True)) if info.type == fs.FileType.Directory else [info]
        prefix = uri.rstrip("/")[: -len(path.rstrip("/"))] if uri.rstrip("/").endswith(path.rstrip("/")) else ""
        for f in found:
            if f.type == fs.FileType.File and not re.search(store.ASIDE, f.path) and f.base_name[:1] not in "._":
                out.append((f.size, prefix + f.path))
    return sorted(out, key=lambda x: x[1])


class NetCDFSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf3"

    def schema(self) -> types.StructType:
        """All variables over the records of the first file that can be read, and the origin."""
        for _, uri in _files(self.options):
            try:
                with _Opened(uri) as opened:
                    head = header(opened.stream, opened.size)
            except (InvalidFile, *_BROKEN):
                continue
            kinds = [(v.name, types.BinaryType() if v.kind.kind == "S" else _SPARK[v.kind.str.lstrip("|")]) for v in head.variables.values() if v.recorded]
            return types.StructType([types.StructField(n, k) for n, k in [*kinds, ("source_file", types.StringType()), ("record_pos", types.LongType())]])
        raise InvalidFile("no file that can be read")

    def reader(self, schema: types.StructType) -> NetCDFReader:
        return NetCDFReader(schema, dict(self.options))

    def writer(self, schema: types.StructType, overwrite: bool) -> CubeWriter:
        return CubeWriter(schema, dict(self.options), overwrite)


def _named(text: str) -> bytes:
    raw = text.encode()
    return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def _attributes(notes: dict[str, object]) -> bytes:
    out = struct.pack(">ii", ATTRIBUTE if notes else 0, len(notes))
    for name, value in notes.items():
        if isinstance(value, str):
            out += _named(name) + struct.pack(">i", 2) + _named(value)
        else:
            raw = np.asarray(value, ">f4" if isinstance(value, np.float32) else ">f8").tobytes()
            out += _named(name) + struct.pack(">ii", 5 if isinstance(value, np.float32) else 6, 1) + raw
    return out


def encoded(records: int, dims: dict[str, int], variables: list[tuple[str, tuple[str, ...], np.ndarray, dict[str, object]]], attrs: dict[str, object]) -> list[bytes]:
    """A NetCDF classic file (64-bit offsets) in pieces: variables as (name, dimensions, values, attributes). Dimensions of length 0 grow by record."""
    names, codes = list(dims), {"S1": 2, "f4": 5, "f8": 6}
    kind = lambda x: ">f8" if x.dtype.str[1:] == "f8" else ">f4" if x.dtype.str[1:] == "f4" else "S1"
    metas, sizes, grows = [], [], []
    for name, own, values, notes in variables:
        growing = bool(own) and dims[own[0]] == 0
        cell = int(np.prod([dims[d] for d in own[1:]], dtype=np.int64)) * np.dtype(kind(values)).itemsize
        size = -(-(cell if growing else values.nbytes) // 4) * 4
        metas.append(_named(name) + struct.pack(">i", len(own)) + b"".join(struct.pack(">i", names.index(d)) for d in own) + _attributes(notes) + struct.pack(">ii", codes[kind(values).lstrip(">")], min(size, 2**31 - 4)))
        sizes.append(size)
        grows.append(growing)
    head = b"CDF\x02" + struct.pack(">i", records) + struct.pack(">ii", DIMENSION if dims else 0, len(dims)) + b"".join(_named(d) + struct.pack(">i", n) for d, n in dims.items()) + _attributes(attrs) + struct.pack(">ii", VARIABLE if variables else 0, len(variables))
    at = len(head) + sum(len(m) + 8 for m in metas)
    begin = {}
    for growing in (False, True):
        for k, size in enumerate(sizes):
            if grows[k] == growing:
                begin[k] = at
                at += size
    pieces = [head + b"".join(m + struct.pack(">q", begin[k]) for k, m in enumerate(metas))]
    for k, (_, _, values, _) in enumerate(variables):
        if not grows[k]:
            raw = values.astype(kind(values)).tobytes()
            pieces.append(raw + b"\0" * (sizes[k] - len(raw)))
    if records:
        body = np.zeros((records, sum(n for n, g in zip(sizes, grows, strict=True) if g)), np.uint8)
        place = 0
        for k, (_, _, values, _) in enumerate(variables):
            if grows[k]:
                cells = np.ascontiguousarray(values.astype(kind(values))).view(np.uint8).reshape(records, -1)
                body[:, place : place + cells.shape[1]] = cells
                place += sizes[k]
        pieces.append(body.tobytes())
    return pieces


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # as written, and as it is to be named


class CubeWriter(DataSourceArrowWriter):
    """Hourly rows as files of (time, station) arrays: one file for each block of stations.

    Rows have block (int), station_id, time (of full hours), columns to write, and columns whose names options["station"] lists: they are
    the same for all rows of a station, and are written once. Rows come by block, as ``operators.sinks.write_cube`` deals and sorts them.
    options: start and end (epoch seconds of the first and last hour), notes (JSON: attributes by column, and those of the file under "").
    Tasks write aside; the driver names the files when all have ended, or removes them when one has failed.
    """

    FILL = np.float32(9.969209968386869e36)  # fixed value of the format

    def __init__(self, schema: types.StructType, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.run = options["path"].rstrip("/"), options.get("run", hashlib.sha256(repr(sorted(options.items())).encode()).hexdigest()[:12])
        self.start, self.hours = int(options["start"]), (int(options["end"]) - int(options["start"])) // 3600 + 1
        self.station = json.loads(options.get("station", "[]"))
        self.notes = json.loads(options.get("notes", "{}"))
        self.values = [f.name for f in schema if f.name not in ("block", "station_id", "time", *self.station)]
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import uuid

        from pyspark import TaskContext

        system, path = store.at(self.path)
        aside = f"{path}/_aside-{self.run}"
        system.create_dir(aside, recursive=True)
        context, held, out = TaskContext.get(), [], []

        def flush(table: pa.Table) -> None:
            block = table.column("block")[0].as_py()
            name = f"{aside}/{block:06}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.nc"
            with system.open_output_stream(name) as f:
                for piece in self._file(table):
                    f.write(piece)
            out.append((name, f"{path}/part-{block:06}.nc"))

        for batch in iterator:
            table = pa.Table.from_batches([batch])
            blocks = table.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                part = table.slice(a, b - a)
                if held and held[0].column("block")[0] != part.column("block")[0]:
                    flush(pa.concat_tables(held))
                    held = []
                if len(part):
                    held.append(part)
        if held:
            flush(pa.concat_tables(held))
        return Written(out)

    def _file(self, table: pa.Table) -> list[bytes]:
        names, which = np.unique(np.array(table.column("station_id").to_pylist(), object), return_inverse=True)
        hour = (table.column("time").cast(pa.int64()).to_numpy() // 1_000_000 - self.start) // 3600
        first = np.unique(which, return_index=True)[1]
        inside = (hour >= 0) & (hour < self.hours)
        raw = [str(n).encode() for n in names]
        width = max(1, max(map(len, raw)))
        variables = [
            ("time", ("time",), self.start + 3600.0 * np.arange(self.hours), {"units": "seconds since 1970-01-01 00:00:00", "standard_name": "time", "calendar": "standard"}),
            ("station_id", ("station", "length"), np.array([list(n.ljust(width, b"\0")) for n in raw], np.uint8).view("S1").reshape(len(raw), width), {"cf_role": "timeseries_id"}),
        ]
        dims = {"time": 0, "station": len(names), "length": width}
        for c in self.station:
            own = table.column(c).take(pa.array(first))
            if pa.types.is_string(own.type):
                texts = [(t or "").encode() for t in own.to_pylist()]
                dims[f"{c}_length"] = max(1, max(map(len, texts)))
                cells = np.array([list(t.ljust(dims[f"{c}_length"], b"\0")) for t in texts], np.uint8).view("S1").reshape(len(texts), -1)
                variables.append((c, ("station", f"{c}_length"), cells, self.notes.get(c, {})))
            else:
                x = np.array([float("nan") if v is None else float(v) for v in own.to_pylist()])
                variables.append((c, ("station",), x, self.notes.get(c, {})))
        for c in self.values:
            cube = np.full((self.hours, len(names)), self.FILL, np.float32)
            x = table.column(c).cast(pa.float32()).combine_chunks()
            good = inside & x.is_valid().to_numpy(zero_copy_only=False)
            cube[hour[good], which[good]] = x.fill_null(0).to_numpy(zero_copy_only=False)[good]
            variables.append((c, ("time", "station"), cube, {**self.notes.get(c, {}), "_FillValue": self.FILL}))
        return encoded(self.hours, dims, variables, {"Conventions": "CF-1.8", "featureType": "timeSeries", **self.notes.get("", {})})

    def commit(self, messages: list[Written | None]) -> None:
        system, path = store.at(self.path)
        system.create_dir(path, recursive=True)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(path)):
                if f.type == fs.FileType.File and f.base_name.startswith("part-"):
                    system.delete_file(f.path)
        for message in messages:
            for aside, name in message.files if message else []:
                system.move(aside, name)
        self._tidy()

    def abort(self, messages: list[Written | None]) -> None:
        self._tidy()

    def _tidy(self) -> None:
        system, path = store.at(self.path)
        if system.get_file_info(f"{path}/_aside-{self.run}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/_aside-{self.run}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NetCDFSource)


def read(spark: SparkSession, path: str | list[str], schema: str, on_invalid: str = "raise") -> DataFrame:
    """Rows of schema (names of variables; binary, string or numbers) with source_file and record_pos."""
    if on_invalid not in ("raise", "skip"):
        raise ValueError(on_invalid)
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    paths = {"paths": json.dumps(path)} if isinstance(path, list) else {"path": path}
    return spark.read.format("netcdf3").schema(f"{schema}, source_file string, record_pos long").options(onInvalid=on_invalid, **paths).load()


_CATALOGUE = "file string, records long, dims string, digest string, variables array<struct<name: string, type: string, dims: array<string>, units: string, fills: array<double>, attributes: map<string, string>>>, error string"


def header_catalogue(files: DataFrame, whole: bool = False) -> DataFrame:
    """What the headers of files (file) say; error is null for a file that can be read.

    Reads the first bytes of plain files alone, and checks that they are as long as their records ask for. With whole,
    gzip files are inflated to their end; otherwise only as far as their header goes. digest is the same
    for files with the same dimension names, variables, types and fill values.
    """

    def one(uri: str) -> tuple:
        try:
            with _Opened(uri) as opened:
                head = header(opened.stream, opened.size)
                if opened.size is not None and head.records > 0 and head.first_record() + (head.records - 1) * head.step + max(v.begin - head.first_record() + v.cell for v in head.variables.values() if v.recorded) > opened.size:
                    raise InvalidFile("cut short")
                if whole:
                    opened.to_the_end()
        except (InvalidFile, *_BROKEN) as e:
            return uri, None, None, None, None, str(e) or type(e).__name__
        variables = []
        for v in head.variables.values():
            attrs = {k: x if isinstance(x, str) else ", ".join(map(str, np.asarray(x).tolist())) for k, x in v.attrs.items()}
            variables.append({"name": v.name, "type": v.kind.str.lstrip("|>"), "dims": [n for n, _ in v.dims], "units": attrs.get("units"), "fills": [float(x) for x in v.fills()], "attributes": list(attrs.items())})
        same = json.dumps(sorted((v["name"], v["type"], v["dims"], v["fills"]) for v in variables))
        return uri, head.records, json.dumps(dict(head.dims)), hashlib.sha256(same.encode()).hexdigest(), variables, None

    def work(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = [one(uri) for uri in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_CATALOGUE_ARROW.types)], schema=_CATALOGUE_ARROW)

    return files.select("file").mapInArrow(work, _CATALOGUE)


_VARIABLES = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string()), ("dims", pa.list_(pa.string())), ("units", pa.string()), ("fills", pa.list_(pa.float64())), ("attributes", pa.map_(pa.string(), pa.string()))]))
_CATALOGUE_ARROW = pa.schema([("file", pa.string()), ("records", pa.int64()), ("dims", pa.string()), ("digest", pa.string()), ("variables", _VARIABLES), ("error", pa.string())])


def require_one_form(catalogue: DataFrame) -> None:
    """Raise ValueError with the odd files' names if readable files differ in dimension names, variables, types or fill values."""
    forms = catalogue.where("error IS NULL").groupBy("digest").agg(F.count("*").alias("n"), F.min("file").alias("file")).orderBy(F.desc("n"), "digest").limit(11).collect()
    if len(forms) > 1:
        raise ValueError(f"files of different forms: {', '.join(r['file'] for r in forms)}")


def declared_fills(catalogue: DataFrame) -> DataFrame:
    """variable, fills (all that any file declares), units: one row a variable."""
    rows = catalogue.where("error IS NULL").select(F.explode("variables").alias("v")).select("v.*")
    return rows.groupBy(F.col("name").alias("variable")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("fills")))).alias("fills"), F.min("units").alias("units"))
