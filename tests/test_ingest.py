import gzip
import http.server
import os
import struct
import threading
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources import chars, classic, raw_file

from skygrid import cli
from skygrid.operators import ingest
from skygrid.plans.products import MESONET
from skygrid.sources import archive, netcdf, store


class Archive(http.server.BaseHTTPRequestHandler):
    """Cuts the first transfer of each file named cut, and counts what is asked for."""

    files: dict = {}
    asked: list = []
    at_once, most, lock = 0, 0, threading.Lock()

    def do_HEAD(self):
        body = self.files.get(self.path)
        self.send_response(404 if body is None else 200)
        self.send_header("ETag", f'"{hash(body)}"')
        self.send_header("Content-Length", str(len(body or b"")))
        self.end_headers()
        return body or b""

    def do_GET(self):
        cls = type(self)
        with cls.lock:
            cls.at_once += 1
            cls.most = max(cls.most, cls.at_once)
        first = self.path not in cls.asked
        cls.asked.append(self.path)
        body = self.do_HEAD()
        self.wfile.write(body[: len(body) // 2] if first and "cut" in self.path else body)
        with cls.lock:
            cls.at_once -= 1

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    Archive.files, Archive.asked, Archive.most = {}, [], 0
    out = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Archive)
    threading.Thread(target=out.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{out.server_port}"
    out.shutdown()


def test_landing_by_tasks(spark, tmp_path, server):
    names = [f"f{k}.gz" for k in range(12)] + ["cut.gz", "cut.txt", "gone.gz"]
    Archive.files = {f"/{n}": gzip.compress(n.encode() * 1000) for n in names if n != "gone.gz"}
    wanted = spark.createDataFrame([(f"{server}/{n}", n) for n in names], "url string, file string")
    folder = f"file://{tmp_path}/raw"
    got = {r.file: r for r in archive.land(wanted, folder, per_host=2, delay=0).collect()}
    assert sorted(got) == sorted(names) and "404" in got["gone.gz"].error and Archive.most <= 2
    assert {n: (tmp_path / "raw" / n).read_bytes() for n in os.listdir(tmp_path / "raw") if n[0] != "."} == {n[1:]: b for n, b in Archive.files.items()}
    assert all(r.transferred and r.bytes == len(Archive.files[f"/{n}"]) and r.error is None for n, r in got.items() if n != "gone.gz")
    assert Archive.asked.count("/cut.gz") == Archive.asked.count("/cut.txt") == 2
    # A second time only what has changed passes; a task that runs again leaves the same files.
    Archive.files["/f3.gz"] = gzip.compress(b"new")
    known = wanted.join(spark.createDataFrame([(r.url, r.etag) for r in got.values()], "url string, etag string"), "url", "left")
    assert [r.file for r in archive.land(known, folder, delay=0).where("transferred").collect()] == ["f3.gz"]
    assert archive.land(wanted, folder, delay=0).where("error IS NULL").count() == 14 and (tmp_path / "raw/f3.gz").read_bytes() == Archive.files["/f3.gz"]
    assert archive.remove_landed(spark.createDataFrame([(f"{folder}/{n}",) for n in names], "file string")) == 14


def test_landing_an_interval_keeps_a_log(spark, tmp_path, server):
    day = "/d/2024/01/01/LDAD/mesonet/netCDF/20240101_"
    Archive.files = {f"{day}{h:02}00.gz": gzip.compress(raw_file()) for h in range(3)}
    ends = datetime(2024, 1, 1), datetime(2024, 1, 1, 3)
    paths = f"{server}/d", f"{tmp_path}/raw", f"{tmp_path}/landed"
    assert sorted((r.file, r.transferred, r.error is None) for r in archive.land_interval(spark, MESONET, *ends, *paths, delay=0).collect()) == [(f"mesonet.20240101_{h:02}00.gz", h < 3, h < 3) for h in range(4)]
    assert archive.land_interval(spark, MESONET, *ends, *paths, delay=0).where("transferred").count() == 0
    assert archive.land_interval(spark, MESONET, *ends, *paths, delay=0, refresh=True).where("transferred").count() == 3


def day_file(day, n=24, temperature=280.0, late=()):
    hours = [24 * (day - 1) + h for h in range(n)] + list(late)
    f4 = lambda x: np.full(len(hours), x, "f4")
    columns = [("stationId", chars(*["KDEN"] * len(hours), width=6), {}), ("latitude", f4(39.5), {}), ("longitude", f4(-105.0), {}), ("elevation", f4(1600.0), {}), ("solarRadiation", f4(1.0), {}), ("dewpoint", f4(270.0), {}), ("temperature", f4(temperature), {}), ("windSpeed", f4(5.0), {}), ("windDir", f4(90.0), {})]
    columns += [(c, np.array([b"S"] * len(hours)), {}) for c in MESONET.flags.values()]
    columns += [("reportTime", np.array([1704067200.0 + 3600 * h for h in hours], "f8"), {})]
    return classic(columns, len(hours))


def test_a_late_record_leaves_its_day(spark, tmp_path):
    """The next file's record of the day before is added to that day; only new and changed files are read."""
    raw, table = tmp_path / "raw", str(tmp_path / "obs")
    raw.mkdir()
    run = lambda: ingest.ingest(spark, str(raw), table, MESONET, cli.raw_schema(MESONET))
    days = lambda: {str(r.date): r["count"] for r in ingest.current(spark, table, "mesonet").groupBy("date").count().collect()}
    assert run().count() == 0
    (raw / "a.nc").write_bytes(day_file(1))
    (raw / "a.nc.etag").write_text("x")
    (raw / "b.nc.part").write_bytes(b"half")
    assert [(r.file.rsplit("/", 1)[-1], r.rows) for r in run().collect()] == [("a.nc", 24)] and days() == {"2024-01-01": 24}
    (raw / "b.nc").write_bytes(day_file(2, late=[5]))
    assert [r.file.rsplit("/", 1)[-1] for r in run().collect()] == ["b.nc"] and days() == {"2024-01-01": 25, "2024-01-02": 24}
    # What was landed may go, and a file that changes replaces its own rows alone.
    (raw / "a.nc").unlink()
    assert run().count() == 0 and days() == {"2024-01-01": 25, "2024-01-02": 24}
    (raw / "b.nc").write_bytes(day_file(2, n=20, temperature=300.0))
    os.utime(raw / "b.nc", (2e9, 2e9))
    run()
    assert days() == {"2024-01-01": 24, "2024-01-02": 20}
    assert {r.temperature for r in ingest.current(spark, table, "mesonet").where("date = '2024-01-02'").collect()} == {300.0}
    plan = ingest.current(spark, table, "mesonet").where(F.col("date") == "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_half_written_ingest_changes_nothing(spark, tmp_path):
    """Rows that no manifest names are not read, before and after the run is done again."""
    raw, table = tmp_path / "raw", str(tmp_path / "obs")
    raw.mkdir()
    (raw / "a.nc").write_bytes(day_file(1))
    ingest.ingest(spark, str(raw), table, MESONET, cli.raw_schema(MESONET))
    half = spark.read.parquet(table).drop("run").withColumn("run", F.lit("99990101T000000"))
    half.write.mode("append").partitionBy("product", "date", "run").parquet(table)
    assert spark.read.parquet(table).count() == 48 and ingest.current(spark, table, "mesonet").count() == 24


def test_products_keep_their_columns(spark, tmp_path):
    table = str(tmp_path / "obs")
    for product, column in (("metar", "dewpoint"), ("mesonet", "solarRadiation")):
        obs = spark.createDataFrame([(datetime(2024, 1, 1), "a", 1.0, "f", 0)], f"time timestamp_ntz, station_id string, {column} double, source_file string, record_pos long")
        ingest.append(obs, spark.createDataFrame([("f", 1, datetime(2024, 2, 1))], "file string, bytes long, changed timestamp"), table, product)
    assert [set(ingest.current(spark, table, p).columns) & {"dewpoint", "solarRadiation"} for p in ("metar", "mesonet")] == [{"dewpoint"}, {"solarRadiation"}]
    with pytest.raises(ValueError, match="no observations of other"):
        ingest.current(spark, table, "other")


def test_files_that_are_left_out_are_named(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "obs")
    raw.mkdir()
    (raw / "a.nc").write_bytes(day_file(1))
    (raw / "b.nc").write_bytes(day_file(1)[:-40])
    (raw / "c.gz").write_bytes(gzip.compress(day_file(2))[:-20])
    (raw / "d.nc").write_bytes(b"<html>")
    (raw / "metar.e.nc").write_bytes(b"another product's")
    ingest.ingest(spark, str(raw), table, MESONET, cli.raw_schema(MESONET))
    got = {r.file.rsplit("/", 1)[-1]: r.reason for r in ingest.rejects(spark, table).collect()}
    assert sorted(got) == ["b.nc", "c.gz", "d.nc"] and got["b.nc"] == "cut short" and got["d.nc"] == "not NetCDF classic" and got["c.gz"]
    assert ingest.current(spark, table, "mesonet").count() == 24


def wide_file(path, n, step=1 << 16):
    """A sparse file of n records: x is the record's number in every thousandth record and 0 elsewhere; pad fills the record."""
    name = lambda s: struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    absent = struct.pack(">ii", 0, 0)
    head = b"CDF\x02" + struct.pack(">i", n) + struct.pack(">ii", 10, 2) + name("rec") + struct.pack(">i", 0) + name("w") + struct.pack(">i", step - 8) + absent + struct.pack(">ii", 11, 2)
    size = len(head) + 2 * (12 + 4 + 8) + 4 * 3 + 2 * (8 + 8 + 8)
    begin = -(-size // 64) * 64
    var = lambda nm, dims, kind, size, at: name(nm) + struct.pack(">i", len(dims)) + b"".join(struct.pack(">i", d) for d in dims) + absent + struct.pack(">iiq", kind, size, at)
    head += var("x", [0], 6, 8, begin) + var("pad", [0, 1], 2, step - 8, begin + 8)
    with open(path, "wb") as f:
        f.write(head)
        for k in range(0, n, 1000):
            f.seek(begin + k * step)
            f.write(struct.pack(">d", k))
        f.truncate(begin + n * step)


def test_large_files_are_read_by_ranges(spark, tmp_path):
    """3.3 GB (sparse) in more than 20 tasks; only the column asked for is decoded, and comparisons reach the reader."""
    wide_file(tmp_path / "big.nc", 50_000)
    rows = netcdf.read(spark, str(tmp_path), "x double")
    assert rows.rdd.getNumPartitions() > 20
    some = rows.where("x >= 1000").select("x", "record_pos")
    assert sorted((r.x, r.record_pos) for r in some.collect()) == [(float(k), k) for k in range(1000, 50_000, 1000)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "pad" not in plan and "1000.0" not in plan  # the comparison is the reader's


def test_columns_and_forms(spark, tmp_path):
    f4 = np.array([1, -9, 3], "f4")
    columns = [("id", chars("ab", "c", "d\u00e9", width=4), {}), ("v", f4, {"_FillValue": -9.0}), ("t", np.array([1.5, 2.5, np.nan], "f8"), {}), ("q", np.array([b"S", b"\xff", b"\0"]), {})]
    (tmp_path / "a.nc").write_bytes(classic(columns, 3))
    (tmp_path / "b.gz").write_bytes(gzip.compress(classic(columns, 3)))
    got = sorted(tuple(r)[:4] + (r.record_pos,) for r in netcdf.read(spark, str(tmp_path), "id string, v float, t double, q string").where("source_file LIKE '%a.nc'").collect())
    assert got == [("ab", 1.0, 1.5, "S", 0), ("c", None, 2.5, "\ufffd", 1), ("d\u00e9", 3.0, None, "", 2)]
    assert bytes(netcdf.read(spark, str(tmp_path), "id binary").orderBy("record_pos").first().id) == b"ab\0\0"
    spark.dataSource.register(netcdf.NetCDFSource)
    assert spark.read.format("netcdf3").load(str(tmp_path)).columns == ["id", "v", "t", "q", "source_file", "record_pos"]
    assert netcdf.read(spark, str(tmp_path), "v float").where("v > 1").count() == 2 and netcdf.read(spark, str(tmp_path), "v float").where("v IS NULL").count() == 2
    with pytest.raises(Exception, match="no variable w"):
        netcdf.read(spark, str(tmp_path), "w float").count()
    said = netcdf.header_catalogue(store.listing(spark, str(tmp_path)))
    netcdf.require_one_form(said)
    assert {r.variable: (r.fills, r.units) for r in netcdf.declared_fills(said).collect()}["v"] == ([-9.0], None)
    (tmp_path / "c.nc").write_bytes(classic(columns, 3).replace(b"recNum", b"recMum"))
    with pytest.raises(ValueError, match="a.nc.*c.nc|c.nc.*a.nc"):
        netcdf.require_one_form(netcdf.header_catalogue(store.listing(spark, str(tmp_path))))
