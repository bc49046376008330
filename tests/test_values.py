"""Small cases with answers worked out by hand."""

import pytest
from pyspark.sql import functions as F

from skygrid.functions import text, times, values
from skygrid.plans.regions import classify, kind_of, shape_filter


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_flags(spark):
    rows = [(10.0, "S"), (11.0, "V"), (12.0, "X"), (13.0, None), (float("nan"), "S")]
    got = one(spark, rows, "v double, f string", values.flagged(values.finite(F.col("v")), F.col("f")))
    assert [x for (x,) in got] == [10.0, 11.0, None, None, None]


def test_fills_and_infinities(spark):
    rows = [(1.0,), (-9999.0,), (float("inf"),), (None,)]
    assert [x for (x,) in one(spark, rows, "v double", values.without_fills(F.col("v"), [-9999.0]))] == [1.0, None, None, None]


def test_wind(spark):
    got = one(spark, [(5.0, 90.0), (5.0, 0.0), (5.0, 270.0), (None, 90.0)], "s double, d double", values.wind_u(F.col("s"), F.col("d")), values.wind_v(F.col("s"), F.col("d")))
    for (u, v), want in zip(got, [(-5, 0), (0, -5), (5, 0)], strict=False):
        assert u == pytest.approx(want[0], abs=1e-6) and v == pytest.approx(want[1], abs=1e-6)
    assert got[3] == (None, None)


def test_wind_range(spark):
    got = one(spark, [(-0.1,), (0.0,), (50.0,), (50.1,), (None,)], "s double", values.within(F.col("s"), *values.WIND_RANGE))
    assert [x for (x,) in got] == [None, 0.0, 50.0, None, None]


def test_epoch(spark):
    got = one(spark, [(-1.0,), (0.0,), (32503679999.0,), (32503680000.0,), (float("nan"),), (None,)], "t double", times.valid_epoch(F.col("t")))
    assert [x for (x,) in got] == [False, True, True, False, False, False]


def test_identifiers(spark):
    rows = [(bytearray(b"KDEN\0\0"),), (bytearray(b" A1 "),), (bytearray(b"A\xff"),), (None,)]
    assert [x for (x,) in one(spark, rows, "b binary", text.decoded_id(F.col("b")))] == ["KDEN", "A1", "A�", ""]


def test_place_names(spark):
    rows = [("DENVER  CO US",), ("TORONTO ON CA",), ("PLAIN",), ("A" * 39 + "provider",)]
    assert [x for (x,) in one(spark, rows, "n string", text.clean_place_name(F.col("n")))] == ["DENVER", "TORONTO", "PLAIN", "A" * 39]


def test_region_codes():
    assert classify("CO").kind == "state" and classify("PJM").kind == "grid operator" and classify("CONUS").kind == "contiguous" and classify("KDEN").kind == "station"
    assert shape_filter(classify("PJM")) == "RTO_ISO = 'PJM'" and "LOC_TYPE" in shape_filter(classify("SPP")) and shape_filter(classify("KDEN")) is None
    with pytest.raises(ValueError):
        classify("XX")
    assert classify("co1").kind == "station"


def test_anything_as_text(spark):
    assert one(spark, [(1.5, None)], "a double, b string", text.as_text(F.col("a")), text.as_text(F.col("b"))) == [("1.5", "")]


def test_kinds_of_codes_as_a_column(spark):
    codes = ["CO", "ERCOT", "CONUS", "KDEN", "co", "ZZ"]
    got = [r[0] for r in one(spark, [(c,) for c in codes], "c string", kind_of(F.col("c")))]
    for code, kind in zip(codes, got, strict=True):
        if kind is None:
            with pytest.raises(ValueError):
                classify(code)
        else:
            assert classify(code).kind == kind
