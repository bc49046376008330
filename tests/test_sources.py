import gzip
import http.client
import http.server
import io
import json
import struct
import threading
import urllib.error
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid import cli
from skygrid.operators import ingest as ingest_table
from skygrid.operators import preprocess, sinks
from skygrid.plans.build import build
from skygrid.plans.products import MESONET, METAR
from skygrid.sources import archive, netcdf, store, tables
from skygrid.streaming import ingest


def classic(variables, records):
    """A NetCDF classic file with a record dimension: variables as (name, array, attributes)."""
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    name = lambda s: struct.pack(">i", len(s)) + pad(s.encode())
    kinds = {"S": (2, 1), "f4": (5, 4), "f8": (6, 8)}
    widths = sorted({a.shape[1] for _, a, _ in variables if a.ndim == 2})
    dims = [("recNum", 0)] + [(f"w{w}", w) for w in widths]
    head = b"CDF\x01" + struct.pack(">i", records) + struct.pack(">ii", 10, len(dims)) + b"".join(name(n) + struct.pack(">i", k) for n, k in dims) + struct.pack(">ii", 0, 0)
    metas, sizes = [], []
    for n, a, attrs in variables:
        code, width = kinds["S" if a.dtype.kind == "S" else a.dtype.str[1:]]
        ids = [0] + ([1 + widths.index(a.shape[1])] if a.ndim == 2 else [])
        size = -(-(width * (a.shape[1] if a.ndim == 2 else 1)) // 4) * 4
        att = struct.pack(">ii", 12, len(attrs)) + b"".join(name(k) + (struct.pack(">i", 2) + name(v) if isinstance(v, str) else struct.pack(">ii", code, 1) + pad(np.array([v], a.dtype.newbyteorder(">")).tobytes())) for k, v in attrs.items()) if attrs else struct.pack(">ii", 0, 0)
        metas.append(name(n) + struct.pack(">i", len(ids)) + b"".join(struct.pack(">i", i) for i in ids) + att + struct.pack(">ii", code, size))
        sizes.append(size)
    begin = len(head) + 8 + sum(len(m) + 4 for m in metas)
    table, at = struct.pack(">ii", 11, len(variables)), begin
    for m, s in zip(metas, sizes, strict=True):
        table += m + struct.pack(">i", at)
        at += s
    body = b""
    for r in range(records):
        for (_, a, _), s in zip(variables, sizes, strict=True):
            cell = a[r].tobytes() if a.dtype.kind == "S" else a[r : r + 1].astype(a.dtype.newbyteorder(">")).tobytes()
            body += cell + b"\0" * (s - len(cell))
    return head + table + body


def chars(*texts, width):
    return np.array([list(t.encode().ljust(width, b"\0")) for t in texts], np.uint8).view("S1")


def raw_file(temperatures=(280.0, -9999.0, 282.0)):
    n = len(temperatures)
    f4 = lambda *x: np.array(x, "f4")
    columns = [("stationId", chars(*["KDEN"] * n, width=6), {}), ("latitude", f4(*[39.5] * n), {}), ("longitude", f4(*[-105.0] * n), {}), ("elevation", f4(*[1600.0] * n), {}), ("solarRadiation", f4(*[1.0] * n), {}), ("dewpoint", f4(*[270.0] * n), {}), ("temperature", f4(*temperatures), {"_FillValue": -9999.0, "units": "kelvin"}), ("windSpeed", f4(*[5.0] * n), {}), ("windDir", f4(*[90.0] * n), {})]
    columns += [(c, np.array([b"S"] * n), {}) for c in MESONET.flags.values()]
    columns += [("reportTime", np.array([1704067200.0 + 1800 * k for k in range(n)], "f8"), {})]
    return classic(columns, n)


def test_netcdf_to_observations(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(raw_file()))
    (tmp_path / "b.nc").write_bytes(raw_file())
    (tmp_path / "c.gz").write_bytes(gzip.compress(raw_file())[:-40])
    schema = cli.raw_schema(MESONET)
    with pytest.raises(Exception, match="c.gz"):
        netcdf.read(spark, str(tmp_path), schema).count()
    raw = netcdf.read(spark, str(tmp_path), schema, on_invalid="skip")
    obs = preprocess.observations(raw, MESONET).orderBy("source_file", "record_pos").collect()
    assert len(obs) == 6 and {r.station_id for r in obs} == {"KDEN"}
    assert [r.temperature for r in obs[:3]] == [280.0, None, 282.0] and obs[0].U10 == -5.0
    assert obs[1].time == datetime(2024, 1, 1, 0, 30)


def test_missing_column(spark):
    with pytest.raises(preprocess.MissingColumns, match="timeObs"):
        preprocess.project(spark.createDataFrame([("x",)], "stationName string"), METAR)


def test_build_and_command_line(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.nc").write_bytes(raw_file((280.0, 281.0, 282.0)))
    ring = [{"x": float(x), "y": float(y)} for x, y in ((-110, 36), (-100, 36), (-100, 42), (-110, 42))]
    spark.createDataFrame([("CO", "CO", 1, 0, ring)], "STUSPS string, region string, polygon int, ring int, points array<struct<x: double, y: double>>").write.parquet(str(tmp_path / "rings"))
    cli.main(["mesonet", *"2024 1 1 2024 1 1 CO".split(), str(tmp_path), "--rings", str(tmp_path / "rings"), "--cube"])
    hours = spark.read.parquet(str(tmp_path / "CO.20240101_20240101.hourly")).orderBy("time").collect()
    assert [(r.time.hour, r.temperature) for r in hours] == [(0, 280.0), (1, 282.0)]
    assert sinks.hourly_at_least(spark, str(tmp_path / "CO.20240101_20240101"), 0.5).count() == 0
    obs = tables.with_sequence(ingest_table.current(spark, str(tmp_path / "obs"), "mesonet").drop("date"))
    assert build(obs, "NOSUCH", datetime(2024, 1, 1), datetime(2024, 1, 1)).hourly.count() == 0
    one = build(obs, "KDEN", datetime(2024, 1, 1), datetime(2024, 1, 1))
    assert one.stations.first().coordinate_warning is False and one.fractions().first().valid_fraction == 2 / 24
    assert [r.source_file.rsplit("/", 1)[-1] for r in spark.read.parquet(str(tmp_path / "CO.20240101_20240101.files")).collect()] == ["a.nc"]
    notes = json.loads(spark.read.text(str(tmp_path / "CO.20240101_20240101.hourly.notes")).first().value)
    assert "Of 1 stations, 0 have" in notes["0.500"] and len(notes) == 5
    cube = netcdf.read(spark, str(tmp_path / "CO.20240101_20240101.cube"), "time double, temperature array<float>").orderBy("time").collect()
    assert [r.temperature for r in cube] == [[280.0], [282.0]] + [[None]] * 22 and cube[1].time == 1704070800.0
    said = netcdf.header_catalogue(store.listing(spark, str(tmp_path / "CO.20240101_20240101.cube"))).first()
    assert next(v for v in said.variables if v.name == "temperature").units == "K"


def test_a_build_reads_its_days_only(spark, tmp_path):
    rows = [(datetime(2024, 1, d, h), "KDEN", 39.0, -105.0, 1.0, 280.0 + h, "f", h) for d in (1, 9, 10, 11, 30) for h in (0, 1)]
    obs = spark.createDataFrame(rows, "time timestamp_ntz, station_id string, latitude float, longitude float, elevation float, temperature float, source_file string, record_pos long")
    ingest_table.append(obs, spark.createDataFrame([("f", 1, datetime(2024, 2, 1))], "file string, bytes long, changed timestamp"), str(tmp_path / "obs"), "mesonet")
    read = tables.with_sequence(ingest_table.current(spark, str(tmp_path / "obs"), "mesonet"))
    built = build(read, "KDEN", datetime(2024, 1, 10), datetime(2024, 1, 10))
    plan = built.records._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert sorted({r.time.day for r in built.records.collect()}) == [9, 10, 11]
    assert [(r.time.day, r.time.hour) for r in built.hourly.orderBy("time").collect()] == [(10, 0), (10, 1)]


class Archive(http.server.BaseHTTPRequestHandler):
    files: dict = {}

    def do_HEAD(self):
        body = self.files.get(self.path)
        self.send_response(404 if body is None else 200)
        self.send_header("ETag", '"1"')
        self.send_header("Content-Length", str(len(body or b"")))
        self.end_headers()
        return body

    def do_GET(self):
        self.wfile.write(self.do_HEAD() or b"")

    def log_message(self, *_):
        pass


def metar_file():
    f4 = lambda *x: np.array(x, "f4")
    columns = [("stationName", chars("KDEN", "KDEN", "KBOU", width=5), {}), ("latitude", f4(39, 39, 40), {}), ("longitude", f4(-105, -105, -105), {}), ("elevation", f4(1600, 1600, 1700), {})]
    columns += [("tempFromTenths", f4(280.1, 281.1, 270.0), {}), ("dpFromTenths", f4(270.1, 271.1, 260.0), {}), ("windSpeed", f4(5, 5, 5), {}), ("windDir", f4(0, 0, 0), {})]
    columns += [(c, np.array([bytes([x]) for x in v]), {}) for c, v in (("temperatureDD", b"SVX"), ("dewpointDD", b"SXS"), ("windSpeedDD", b"SSS"), ("windDirDD", b"SSS"))]
    return classic([*columns, ("timeObs", np.array([1704067200.0, 1704070800.0, 1704067200.0], "f8"), {})], 3)


def test_landing_and_building_the_other_product(spark, tmp_path):
    """METAR files from an archive, by the command line: landed, flagged by the flags of whole degrees, built, removed."""
    Archive.files = {"/data/2024/01/01/point/metar/netcdf/20240101_0000.gz": gzip.compress(metar_file())}
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Archive)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        cli.main(["metar", *"2024 1 1 2024 1 1 KDEN".split(), str(tmp_path), "--land", f"http://127.0.0.1:{server.server_port}/data", "--remove-original"])
    finally:
        server.shutdown()
    hours = spark.read.parquet(str(tmp_path / "KDEN.20240101_20240101.hourly")).orderBy("time").collect()
    assert [(r.time.hour, round(r.temperature, 2), r.dewpoint and round(r.dewpoint, 2), r.V10) for r in hours] == [(0, 280.1, 270.1, -5.0), (1, 281.1, None, -5.0)]
    assert not [p for p in (tmp_path / "raw").iterdir() if not p.name.startswith(".")]
    obs = spark.read.parquet(str(tmp_path / "obs")).where("station_id = 'KBOU'").first()
    assert obs.temperature is None and obs.dewpoint == 260.0 and obs.product == "metar"


def test_name_tables(spark, tmp_path):
    (tmp_path / "names.csv").write_text('AB1 ,,,,,,,"DENVER  CO US"\nAB1,,,,,,,OTHER\n,,,,,,,NONE\nAB2,,,,,,,\n')
    assert [tuple(r) for r in tables.csv_names(spark, str(tmp_path / "names.csv")).collect()] == [("AB1", "DENVER")]
    (tmp_path / "names.txt").write_text("CO DENVER_INTL      KDEN x\n!  heading\nCO AGAIN            KDEN\n")
    assert [tuple(r) for r in tables.wide_names(spark, str(tmp_path / "names.txt")).collect()] == [("KDEN", "DENVER INTL")]


def test_first_names_of_split_files(spark, tmp_path):
    """The first line of a station counts, though the file is read in many tasks."""
    (tmp_path / "names.csv").write_text("".join(f"S{k % 300:03},,,,,,,PLACE{k:06}\n" for k in range(30_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        rows = tables.csv_names(spark, str(tmp_path / "names.csv"))
        assert {r.station_id: r.name for r in rows.collect()} == {f"S{k:03}": f"PLACE{k:06}" for k in range(300)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_geojson(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    features = [
        {"type": "Feature", "properties": {"RTO_ISO": "SPP", "LOC_TYPE": "REG"}, "geometry": {"type": "Polygon", "coordinates": [square]}},
        {"type": "Feature", "properties": {"RTO_ISO": "SPP", "LOC_TYPE": "HUB"}, "geometry": {"type": "Polygon", "coordinates": [square]}},
        {"type": "Feature", "properties": {"RTO_ISO": "PJM", "LOC_TYPE": "HUB"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square, square]]}},
    ]
    (tmp_path / "r.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rings = tables.geojson_rings(spark, str(tmp_path / "r.json"), "RTO_ISO", "LOC_TYPE = 'REG' OR RTO_ISO = 'PJM'")
    got = sorted((r.region, r.ring, len(r.points)) for r in rings.collect())
    assert got == [("PJM", 0, 5), ("PJM", 0, 5), ("PJM", 1, 5), ("SPP", 0, 5)]


class Answer:
    def __init__(self, body=b"", etag='"1"'):
        self.body, self.headers = io.BytesIO(body), {"ETag": etag}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def read(self, n=-1):
        return self.body.read(n)


def test_fetching(tmp_path):
    calls = []

    def opener(request, timeout):
        calls.append(request.get_method())
        if len(calls) == 1:
            raise urllib.error.HTTPError("u", 503, "", {}, None)
        return Answer(gzip.compress(b"x"))

    target = f"file://{tmp_path}/f.gz"
    etag, n, moved = archive.fetch("http://x/f.gz", target, delay=0, opener=opener)
    assert archive.gzip_is_whole(tmp_path / "f.gz") and calls == ["HEAD", "HEAD", "GET"] and moved and n == (tmp_path / "f.gz").stat().st_size
    assert archive.fetch("http://x/f.gz", target, etag, delay=0, opener=opener) == (etag, n, False) and calls[3:] == ["HEAD"]
    assert archive.fetch("http://x/f.gz", target, '"0"', delay=0, opener=opener)[2]
    with pytest.raises(urllib.error.HTTPError):
        archive.fetch("http://x/g.gz", f"{tmp_path}/g.gz", delay=0, opener=lambda r, timeout: (_ for _ in ()).throw(urllib.error.HTTPError("u", 404, "", {}, None)))
    assert [p.name for p in tmp_path.iterdir()] == ["f.gz"]


def test_cut_transfers_are_tried_again(tmp_path):
    """A .gz that doesn't inflate, a body that ends early, and a file without .gz; nothing half done stays."""
    whole = gzip.compress(b"observations" * 1000)
    bodies = [whole[:-9], http.client.IncompleteRead(b""), whole]

    class Cut(Answer):
        def read(self, n=-1):
            if isinstance(self.body, Exception):
                raise self.body
            return super().read(n)

    def opener(request, timeout):
        answer = Cut()
        if request.get_method() == "GET":
            body = bodies.pop(0)
            answer.body = body if isinstance(body, Exception) else io.BytesIO(body)
        return answer

    archive.fetch("http://x/f.gz", f"{tmp_path}/f.gz", delay=0, opener=opener)
    assert (tmp_path / "f.gz").read_bytes() == whole
    bodies += [b"plain", whole[:50], whole[:50]]
    archive.fetch("http://x/f.txt", f"{tmp_path}/f.txt", delay=0, opener=opener)
    assert (tmp_path / "f.txt").read_bytes() == b"plain"
    with pytest.raises(archive.CutShort):
        archive.fetch("http://x/h.gz", f"{tmp_path}/h.gz", delay=0, retries=1, opener=opener)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["f.gz", "f.txt"]


def test_gzip_files(tmp_path):
    good = gzip.compress(b"a" * 5000)
    for k, (body, whole) in enumerate([(good, True), (good + good, True), (good + b"\0" * 20, True), (good[:-1], False), (good + good[:10], False), (b"", False), (b"text", False), (good[:-8] + b"12345678", False)]):
        (tmp_path / str(k)).write_bytes(body)
        assert archive.gzip_is_whole(tmp_path / str(k)) == whole, k
    assert not archive.gzip_is_whole(tmp_path / "none")


def test_existence():
    def answers(head, get=200):
        def opener(request, timeout):
            code = head if request.get_method() == "HEAD" else get
            if isinstance(code, Exception):
                raise code
            if code >= 400:
                raise urllib.error.HTTPError("u", code, "", {}, None)
            out = Answer()
            out.status = code
            return out

        return opener

    for head, get, want in ((200, 500, True), (405, 200, True), (403, 404, False), (404, 200, False), (500, 200, False), (TimeoutError(), 200, False), (204, 200, False)):
        assert archive.exists("http://x/f", opener=answers(head, get)) == want, (head, get)


def test_stream_ingests_each_file_once(spark, tmp_path):
    schema = "stationId binary, latitude float, longitude float, elevation float, solarRadiation float, dewpoint float, temperature float, windSpeed float, windDir float, dewpointDD string, temperatureDD string, windSpeedDD string, windDirDD string, reportTime double"
    row = (bytearray(b"A"), 1.0, 1.0, 1.0, 1.0, 1.0, 280.0, 5.0, 90.0, "S", "S", "S", "S", 1704067200.0)
    for k in range(2):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "raw"))
        q = ingest.ingest(spark, str(tmp_path / "raw"), schema, MESONET, str(tmp_path / "obs"), str(tmp_path / "checkpoint"))
        q.awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "obs")).count() == k + 1
    assert spark.read.parquet(str(tmp_path / "obs")).where(F.col("product") == "mesonet").first().temperature == 280.0


def test_files_without_records(spark):
    rows = [("a", -1.0), ("a", 1.0), ("b", -1.0), ("b", None), ("c", 0.0)]
    raw = spark.createDataFrame(rows, "source_file string, reportTime double")
    assert [r.source_file for r in preprocess.files_without_records(raw, MESONET).collect()] == ["b"]


def test_exported_times(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 1),)], "time timestamp_ntz")
    assert sinks.exported(df).first().time == 1704067201.0


def test_streams_of_late_records(spark, tmp_path):
    """Repeated records within the watermark go; an hour is counted once it is past the watermark."""
    rows = [("A", datetime(2024, 1, 1, 0, 10), 1.0), ("A", datetime(2024, 1, 1, 0, 10), 1.0), ("A", datetime(2024, 1, 1, 0, 50), 3.0), ("B", datetime(2024, 1, 1, 6, 0), 5.0)]
    schema = "station_id string, time timestamp_ntz, temperature double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    for name, work in (("distinct", ingest.late_distinct), ("counts", ingest.hourly_counts)):
        stream = work(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}.c")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "distinct")).count() == 3
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "counts")).collect()] == [("A", datetime(2024, 1, 1), 3, 5 / 3)]
