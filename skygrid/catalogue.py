"""Registered queries over the station operators, with the SQL that each must agree with.

The driver's tables stand in for observations: events are records (user_id the station, ts the time, value the
observable, event_type its flag, of which view and purchase count as good), customers are stations,
nations and regions their places, and the first two components of a vector are coordinates.
Times come and go without zone; rounding is to six places on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions import projections, text, times, values
from skygrid.operators import hourly, ingest, preprocess, regions, series, sinks, stations, validity
from skygrid.plans.products import MESONET, METAR
from skygrid.plans.regions import classify, kind_of, shape_filter
from skygrid.session import shared_dir
from skygrid.sources import archive, netcdf, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ROOT = "https://archive.example.org/data"
#: Longest gap that the stand-in series are interpolated over: their records are about seven hours apart.
GAP_HOURS = 12
N_HOURS = 720
#: A polygon in the plane of the first two vector components, not convex, and a hole in it.
OUTER = [(-1.5, -1.5), (1.5, -1.0), (0.25, 0.0), (1.0, 1.5), (-1.0, 1.0)]
HOLE = [(-0.5, -0.5), (0.0, -0.5), (0.0, 0.25), (-0.5, 0.25)]
FAR = [(1.25, -0.25), (2.5, -0.25), (2.5, 0.75), (1.25, 0.75)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None) -> Callable:
    """Register a function under its name, with its SQL."""

    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def r6(x: Column) -> Column:
    return F.round(x.cast("double"), 6)


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as observations."""
    rows = table(spark, sf_dir, "events")
    return rows.select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").alias("time"), F.col("event_id").alias("seq"), F.col("value").alias("temperature"), F.col("event_type").alias("flag"))


def two_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with two variables: values of views and purchases, and values of all else."""
    good = F.col("flag").isin("view", "purchase")
    rows = observed(spark, sf_dir)
    return rows.select("station_id", "time", "seq", F.when(good, F.col("temperature")).alias("temperature"), F.when(~good, F.col("temperature")).alias("dewpoint"))


# --- sources -------------------------------------------------------------------------------------------------------


@query(f"""
WITH h AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS hour FROM events)
SELECT hour, '{ROOT}/' || strftime(hour, '%Y/%m/%d') || '/LDAD/mesonet/netCDF/' || strftime(hour, '%Y%m%d_%H') || '00.gz' AS url,
 'mesonet.' || strftime(hour, '%Y%m%d_%H') || '00.gz' AS file, 'mesonet.' || strftime(hour, '%Y%m%d_%H') || '00.nc' AS table_file FROM h""")
def hourly_url_sequence(spark, sf_dir):
    ends = table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    hours = archive.hours(spark, *(x.replace(minute=0, second=0, microsecond=0) for x in ends))
    named = archive.hourly_urls(hours, MESONET, ROOT).withColumn("file", archive.local_name(F.col("url"), MESONET))
    return named.withColumn("table_file", archive.table_name(F.col("file")))


@query(f"""
WITH h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00', INTERVAL 1 HOUR)) AS hour)
SELECT hour, '{ROOT}/' || strftime(hour, '%Y/%m/%d') || '/point/metar/netcdf/' || strftime(hour, '%Y%m%d_%H') || '00.gz' AS url FROM h
WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'view')""")
def ingest_manifest_antijoin(spark, sf_dir):
    wanted = archive.hourly_urls(archive.hours(spark, datetime(2024, 1, 1), datetime(2024, 1, 31, 23)), METAR, ROOT)
    done = table(spark, sf_dir, "events").where("event_type = 'view'").select(times.from_micros(times.hour_floor(times.micros(F.col("ts")))).alias("hour")).distinct().withColumn("complete", F.lit(True))
    return archive.not_yet_ingested(wanted, done, "hour").select("hour", "url")


# --- projections and predicates ------------------------------------------------------------------------------------


@query("SELECT l_orderkey AS station_id, l_linenumber AS seq, l_shipdate AS time, l_quantity AS temperature, l_discount AS dewpoint FROM lineitem")
def projection_rename(spark, sf_dir):
    names = {"l_orderkey": "station_id", "l_linenumber": "seq", "l_shipdate": "time", "l_quantity": "temperature", "l_discount": "dewpoint"}
    return table(spark, sf_dir, "lineitem").select(*names).withColumnsRenamed(names)


@query("""SELECT event_id, ts AS time FROM events WHERE epoch_us(ts) / 1e6 - 1704067200 - 86400.0 * (event_id % 5) * 10 >= 0
 AND epoch_us(ts) / 1e6 - 1704067200 - 86400.0 * (event_id % 5) * 10 < 32503680000""")
def valid_time_filter(spark, sf_dir):
    seconds = times.to_epoch(F.col("ts")) - 1704067200 - F.lit(86400.0) * (F.col("event_id") % 5) * 10
    return table(spark, sf_dir, "events").where(times.valid_epoch(seconds)).select("event_id", F.col("ts").alias("time"))


@query("SELECT event_id, CASE WHEN event_id % 7 IN (0, 3) THEN NULL ELSE value END AS value FROM events")
def fill_value_null(spark, sf_dir):
    given = F.when(F.col("event_id") % 7 == 0, -9999.0).when(F.col("event_id") % 7 == 3, float("nan")).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", values.without_fills(given, [-9999.0]).alias("value"))


@query("SELECT event_id, CASE WHEN event_type IN ('view', 'purchase') THEN value END AS value, event_type AS flag FROM events")
def qc_mask(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", values.flagged(F.col("value"), F.col("event_type"), ("view", "purchase")).alias("value"), F.col("event_type").alias("flag"))


@query("SELECT event_id, CASE WHEN value >= 0 AND value <= 50 THEN value END AS speed, CASE WHEN value >= 0 AND value <= 50 THEN (event_id % 360)::DOUBLE END AS direction FROM events")
def wind_range_mask(spark, sf_dir):
    direction = (F.col("event_id") % 360).cast("double")
    believed = F.col("value").between(*values.WIND_RANGE)
    return table(spark, sf_dir, "events").select("event_id", values.within(F.col("value"), *values.WIND_RANGE).alias("speed"), values.masked(direction, believed).alias("direction"))


@query("""SELECT event_id, round((-value * sin(radians(event_id % 360)))::FLOAT::DOUBLE, 3) + 0.0 AS u10, round((-value * cos(radians(event_id % 360)))::FLOAT::DOUBLE, 3) + 0.0 AS v10 FROM events""")
def wind_components(spark, sf_dir):
    direction = (F.col("event_id") % 360).cast("double")
    u, v = (F.round(f(F.col("value"), direction).cast("double"), 3) + 0.0 for f in (values.wind_u, values.wind_v))
    return table(spark, sf_dir, "events").select("event_id", u.alias("u10"), v.alias("v10"))


@query("SELECT event_id, round(sqrt(value * value + (event_id % 11) * (event_id % 11)), 6) AS speed FROM events")
def wind_speed_from_uv(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", r6(values.wind_speed(F.col("value"), (F.col("event_id") % 11).cast("double"))).alias("speed"))


@query("SELECT p_partkey, p_size, CASE p_size % 5 WHEN 0 THEN 'K' WHEN 1 THEN 'm' WHEN 2 THEN 'W m-2' WHEN 3 THEN 'm s-1' ELSE 'degree' END AS unit FROM part")
def unit_mapping(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("kelvin", "meter", "watt/meter2", "meter/sec", "degree")])
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", values.unit_name(F.get(names, F.col("p_size") % 5)).alias("unit"))


@query("""SELECT event_id, (ts - INTERVAL 5 HOUR)::TIMESTAMP AS local_time, ts AS time, date_trunc('hour', ts) AS floor_hour,
 CASE WHEN ts = date_trunc('hour', ts) THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END AS ceil_hour, epoch_us(ts) AS micros FROM events""")
def time_functions(spark, sf_dir):
    local = F.col("ts") - F.expr("INTERVAL 5 HOUR")
    t = times.micros(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", local.alias("local_time"), times.to_utc(local, "-05:00").alias("time"), times.from_micros(times.hour_floor(t)).alias("floor_hour"), times.from_micros(times.hour_ceil(t)).alias("ceil_hour"), t.alias("micros")
    )


@query("""SELECT event_id, '2024' AS dated, user_id::VARCHAR AS station_id, CASE WHEN event_type IN ('view', 'purchase') THEN value::FLOAT::DOUBLE END AS temperature,
 CASE WHEN event_type IN ('view', 'purchase') AND value::FLOAT BETWEEN 0 AND 50 THEN round((-value::FLOAT::DOUBLE * sin(radians(event_id % 360)))::FLOAT::DOUBLE, 3) + 0.0 END AS u10 FROM events""")
def preprocessed_records(spark, sf_dir):
    """The whole preprocessing of one product on raw records made of events."""
    flag = F.when(F.col("event_type").isin("view", "purchase"), "S").otherwise("X")
    e = table(spark, sf_dir, "events")
    raw = e.select(
        F.col("user_id").cast("string").cast("binary").alias("stationId"), times.to_epoch(F.col("ts")).alias("reportTime"), *[F.lit(0.0).cast("float").alias(c) for c in ("latitude", "longitude", "elevation", "solarRadiation", "dewpoint")],
        F.col("value").cast("float").alias("temperature"), F.col("value").cast("float").alias("windSpeed"), (F.col("event_id") % 360).cast("float").alias("windDir"),
        *[flag.alias(c) for c in MESONET.flags.values()], F.lit("f").alias("source_file"), F.col("event_id").alias("record_pos"),
    )
    obs = preprocess.observations(raw, MESONET)
    return obs.select(F.col("record_pos").alias("event_id"), F.date_format("time", "yyyy").alias("dated"), "station_id", F.col("temperature").cast("double").alias("temperature"), (F.round(F.col("U10").cast("double"), 3) + 0.0).alias("u10"))


@query("""SELECT event_id, ts AS time, CASE WHEN event_id % 50 = 0 THEN '' ELSE user_id::VARCHAR END AS station_id,
 CASE WHEN event_type IN ('view', 'purchase') THEN value::FLOAT::DOUBLE END AS temperature, CASE WHEN event_id % 2 = 0 THEN (value + 1)::FLOAT::DOUBLE END AS dewpoint,
 CASE WHEN event_type IN ('view', 'purchase') AND value::FLOAT BETWEEN 0 AND 50 THEN round((-value::FLOAT::DOUBLE * cos(radians(event_id % 360)))::FLOAT::DOUBLE, 3) + 0.0 END AS v10
FROM events WHERE event_id % 9 <> 0""")
def preprocessed_metar(spark, sf_dir):
    """The other product: tenths go by the flags of whole degrees; some records lack a time or an identifier."""
    good, e = F.col("event_type").isin("view", "purchase"), table(spark, sf_dir, "events")
    flags = {"temperatureDD": F.when(good, "V").otherwise("X"), "dewpointDD": F.when(F.col("event_id") % 2 == 0, "S"), "windDirDD": F.lit("S"), "windSpeedDD": F.when(good, "S").otherwise("Q")}
    numbers = {"tempFromTenths": F.col("value"), "dpFromTenths": F.col("value") + 1, "windSpeed": F.col("value"), "windDir": F.col("event_id") % 360, **{c: F.lit(0) for c in ("latitude", "longitude", "elevation")}}
    raw = e.select(
        F.when(F.col("event_id") % 50 != 0, F.rpad(F.col("user_id").cast("string"), 5, " ")).cast("binary").alias("stationName"), F.when(F.col("event_id") % 9 != 0, times.to_epoch(F.col("ts"))).alias("timeObs"),
        *[x.cast("float").alias(c) for c, x in numbers.items()], *[x.alias(c) for c, x in flags.items()], F.lit("f").alias("source_file"), F.col("event_id").alias("record_pos"),
    )
    obs = preprocess.observations(raw, METAR)
    return obs.select(F.col("record_pos").alias("event_id"), "time", "station_id", *[F.col(c).cast("double").alias(c) for c in ("temperature", "dewpoint")], (F.round(F.col("V10").cast("double"), 3) + 0.0).alias("v10"))


# --- identifiers and names -------------------------------------------------------------------------------------------


@query("SELECT c_custkey, trim(c_name) AS station_id FROM customer")
def station_id_decode(spark, sf_dir):
    raw = F.concat(F.lit("  "), F.col("c_name"), F.lit("\t "), F.repeat(F.lit("\x00"), 3)).cast("binary")
    return table(spark, sf_dir, "customer").select("c_custkey", text.decoded_id(raw).alias("station_id"))


@query(r"""SELECT n_nationkey, k, trim(regexp_replace(regexp_replace(rtrim(substr(n_name || suffix, 1, 39)), '\s{2,}(?:[A-Z]{2}\s+)?[A-Z]{2}$', ''), '\s+[A-Z]{2}\s+(?:US|CA)$', '')) AS name
FROM nation, (VALUES (0, '  CO US'), (1, ' ON CA'), (2, '   QQ'), (3, ''), (4, ' XX YY'), (5, '                                  provider')) AS s(k, suffix)""")
def station_name_clean(spark, sf_dir):
    suffix = F.array(*[F.lit(x) for x in ("  CO US", " ON CA", "   QQ", "", " XX YY", " " * 34 + "provider")])
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.posexplode(suffix).alias("k", "suffix"))
    return rows.select("n_nationkey", "k", text.clean_place_name(F.concat("n_name", "suffix")).alias("name"))


@query("SELECT p_brand AS station_id, arg_min(replace(p_name, ' ', ' '), p_partkey) AS name FROM part WHERE regexp_full_match(replace(upper(p_type), ' ', ''), '[A-Z0-9]+') GROUP BY p_brand")
def station_names_first(spark, sf_dir):
    rows = table(spark, sf_dir, "part").where(F.upper(F.replace("p_type", F.lit(" "), F.lit(""))).rlike("^[A-Z0-9]+$"))
    return tables.first_named(rows.select(F.col("p_brand").alias("station_id"), text.clean_wide_name(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name"), F.col("p_partkey").alias("line")))


@query("SELECT c_custkey::VARCHAR AS station_id, coalesce(n_name, c_custkey::VARCHAR) AS station_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0")
def station_name_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("station_id"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0")
    names = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("station_id", F.col("n_name").alias("name"))
    return stations.with_names(customers.select("station_id"), names)


@query("""WITH c AS (SELECT n_name, ['CO', 'ERCOT', 'CONUS', 'KDEN', 'ca', 'QQ'][n_nationkey % 6 + 1] AS code FROM nation)
SELECT n_name AS identifier, CASE WHEN code IN ('CAISO', 'ERCOT', 'ISONE', 'NYISO', 'MISO', 'PJM', 'SPP') THEN 'grid operator' WHEN code = 'CONUS' THEN 'contiguous'
 WHEN length(code) <> 2 THEN 'station' WHEN code IN ('CO', 'CA', 'TX') THEN 'state' END AS kind FROM c""")
def region_code_kinds(spark, sf_dir):
    codes = F.array(*[F.lit(x) for x in ("CO", "ERCOT", "CONUS", "KDEN", "ca", "QQ")])
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("identifier"), kind_of(F.get(codes, F.col("n_nationkey") % 6)).alias("kind"))


@query("""WITH s AS (SELECT c_custkey, ['CO', 'AK', 'TX', 'PR'][c_custkey % 4 + 1] AS STUSPS, ['PJM', 'MISO', 'SPP'][c_custkey % 3 + 1] AS RTO_ISO, CASE WHEN c_custkey % 2 = 0 THEN 'REG' ELSE 'HUB' END AS LOC_TYPE FROM customer)
SELECT c_custkey, 'CO' AS code FROM s WHERE STUSPS = 'CO' UNION ALL SELECT c_custkey, 'CONUS' FROM s WHERE STUSPS NOT IN ('AK', 'HI', 'PR', 'GU', 'VI', 'AS', 'MP')
UNION ALL SELECT c_custkey, 'MISO' FROM s WHERE RTO_ISO = 'MISO' AND LOC_TYPE = 'REG' UNION ALL SELECT c_custkey, 'PJM' FROM s WHERE RTO_ISO = 'PJM'""")
def region_code_filters(spark, sf_dir):
    pick = lambda names, n: F.get(F.array(*[F.lit(x) for x in names]), (F.col("c_custkey") % n).cast("int"))
    kinds = {"STUSPS": pick(("CO", "AK", "TX", "PR"), 4), "RTO_ISO": pick(("PJM", "MISO", "SPP"), 3), "LOC_TYPE": pick(("REG", "HUB"), 2)}
    shapes = table(spark, sf_dir, "customer").select("c_custkey", *[x.alias(c) for c, x in kinds.items()])
    parts = [shapes.where(shape_filter(classify(c))).select("c_custkey", F.lit(c).alias("code")) for c in ("CO", "CONUS", "MISO", "PJM")]
    return hourly.merged(*parts)


@query("""WITH e AS (SELECT strftime(ts, '%Y%m%d') AS source_file, event_id, CASE WHEN event_id % 10 = 3 THEN ts - INTERVAL 1 DAY ELSE ts END AS time, value, CAST(strftime(ts, '%d') AS INTEGER) % 3 = 0 AS again FROM events),
c AS (SELECT source_file, time, value FROM e WHERE NOT again UNION ALL SELECT source_file, time, value + 1000 FROM e WHERE again AND event_id % 2 = 0)
SELECT strftime(time, '%Y-%m-%d') AS date, source_file, count(*) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high FROM c GROUP BY ALL""")
def ingest_by_file(spark, sf_dir):
    """A day's events as a file, a tenth of them late by a day; every third file comes again, with other values and half its records."""
    rows = observed(spark, sf_dir).withColumn("source_file", F.date_format("time", "yyyyMMdd"))
    rows = rows.withColumn("time", F.when(F.col("seq") % 10 == 3, F.col("time") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("time"))).drop("flag")
    again = rows.where((F.substring("source_file", 7, 2).cast("int") % 3 == 0) & (F.col("seq") % 2 == 0)).withColumn("temperature", F.col("temperature") + 1000)
    path = f"{shared_dir(spark)}/obs-{uuid.uuid4().hex}"
    for part in (rows, again):
        ingest.append(part, part.groupBy(F.col("source_file").alias("file")).agg(F.count("*").alias("bytes"), F.lit(None).cast("timestamp").alias("changed")), path, MESONET.name)
    found = ingest.current(spark, path, MESONET.name)
    return found.groupBy(F.col("date").cast("string").alias("date"), "source_file").agg(F.count("*").alias("n"), r6(F.min("temperature")).alias("low"), r6(F.max("temperature")).alias("high"))


# --- joins ---------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def select_stations_semi(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("station_id"))
    obs = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("station_id"))
    return stations.select_records(obs, wanted).select("o_orderkey", F.col("station_id").alias("o_custkey"))


@query("SELECT c_custkey AS station_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def missing_stations_anti(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    return stations.missing_stations(wanted, table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("station_id")))


@query("SELECT user_id::VARCHAR AS station_id, count(*) AS n FROM events WHERE user_id IN (3, 1, 4, 15, 9, 2, 6) GROUP BY ALL")
def requested_order(spark, sf_dir):
    wanted = stations.requested(spark, ["3", "1", "4", "1", "15", "9", "2", "6"])
    found = stations.select_records(observed(spark, sf_dir), wanted).groupBy("station_id").agg(F.count("*").alias("n"))
    return found.join(wanted, "station_id").orderBy("ord").select("station_id", "n")


# --- aggregation -----------------------------------------------------------------------------------------------------

DEDUPE_SQL = """WITH e AS (SELECT user_id::VARCHAR AS station_id, date_trunc('day', ts) AS time, event_id AS seq, CASE WHEN event_type IN ('view', 'purchase') THEN value END AS temperature,
 CASE WHEN event_type NOT IN ('view', 'purchase') THEN value END AS dewpoint FROM events)
SELECT station_id, time, arg_min(temperature, seq) FILTER (temperature IS NOT NULL) AS temperature, arg_min(dewpoint, seq) FILTER (dewpoint IS NOT NULL) AS dewpoint FROM e GROUP BY ALL"""


@query(DEDUPE_SQL)
def dedupe_first_valid(spark, sf_dir):
    rows = two_series(spark, sf_dir).withColumn("time", F.date_trunc("day", "time").cast("timestamp_ntz"))
    return series.consolidated(rows)


@query("SELECT user_id::VARCHAR AS station_id, count(*) - 1 AS extra FROM events GROUP BY user_id, date_trunc('day', ts) HAVING count(*) > 1")
def repeated_times(spark, sf_dir):
    rows = observed(spark, sf_dir).withColumn("time", F.date_trunc("day", "time").cast("timestamp_ntz"))
    return series.repeated_times(rows).select("station_id", (F.col("n") - 1).alias("extra"))


PLACES_SQL = """p AS (SELECT l_suppkey::VARCHAR AS station_id, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS seq,
 (CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE 40 + (l_suppkey % 20) + CASE WHEN l_suppkey % 5 = 0 THEN l_linenumber * 0.0078125 ELSE 0 END END)::FLOAT AS latitude, (-105 + (l_suppkey % 7))::FLOAT AS longitude,
 (CASE WHEN l_linenumber = 1 THEN NULL WHEN l_suppkey % 3 = 0 THEN 1000 + 20 * l_linenumber ELSE 1000 END)::FLOAT AS elevation FROM lineitem)"""


def moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as records of suppliers, some of which move or climb."""
    step = F.when(F.col("l_suppkey") % 5 == 0, F.col("l_linenumber") * F.lit(0.0078125)).otherwise(0.0)
    lat = F.when(F.col("l_orderkey") % 97 != 0, F.lit(40) + F.col("l_suppkey") % 20 + step)
    elev = F.when(F.col("l_linenumber") == 1, F.lit(None)).when(F.col("l_suppkey") % 3 == 0, 1000 + 20 * F.col("l_linenumber")).otherwise(1000)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("station_id"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("seq"), lat.cast("float").alias("latitude"), (F.col("l_suppkey") % 7 - 105).cast("float").alias("longitude"), elev.cast("float").alias("elevation")
    )


BASE_SQL = f"""{PLACES_SQL}, v AS (SELECT * FROM p WHERE latitude IS NOT NULL), b0 AS (SELECT station_id, arg_min(latitude, seq) AS base_lat, arg_min(longitude, seq) AS base_lon, min(seq) AS s FROM v GROUP BY station_id),
b1 AS (SELECT b0.*, v.elevation AS e0 FROM b0 JOIN v ON v.station_id = b0.station_id AND v.seq = b0.s),
f AS (SELECT b1.station_id, arg_min(v.elevation, v.seq) FILTER (v.elevation IS NOT NULL) AS fill FROM b1 JOIN v USING (station_id)
 WHERE abs(v.latitude::DOUBLE - base_lat::DOUBLE) <= 0.01 AND abs(v.longitude::DOUBLE - base_lon::DOUBLE) <= 0.01 GROUP BY b1.station_id),
b AS (SELECT station_id, base_lat, base_lon, coalesce(e0, fill) AS base_elev FROM b1 LEFT JOIN f USING (station_id)),
c AS (SELECT b.*, (SELECT bool_or(abs(v.latitude::DOUBLE - b.base_lat::DOUBLE) > 0.01 OR abs(v.longitude::DOUBLE - b.base_lon::DOUBLE) > 0.01 OR coalesce(abs(v.elevation::DOUBLE - b.base_elev::DOUBLE) > 25, false)) FROM v WHERE v.station_id = b.station_id) AS changed FROM b)"""


@query(f"WITH {PLACES_SQL} SELECT station_id, arg_min(latitude, seq)::DOUBLE AS base_lat, arg_min(longitude, seq)::DOUBLE AS base_lon FROM p WHERE latitude IS NOT NULL GROUP BY station_id")
def first_record_per_station(spark, sf_dir):
    return stations.first_records(moving(spark, sf_dir)).select("station_id", *[F.col(c).cast("double").alias(c) for c in ("base_lat", "base_lon")])


@query(f"WITH {BASE_SQL} SELECT station_id, base_lat::DOUBLE AS base_lat, base_lon::DOUBLE AS base_lon, base_elev::DOUBLE AS base_elev, changed FROM c")
def station_drift_flag(spark, sf_dir):
    found = stations.station_locations(moving(spark, sf_dir))
    return found.select("station_id", *[F.col(c).cast("double").alias(c) for c in ("base_lat", "base_lon", "base_elev")], "changed")


@query(f"WITH {BASE_SQL} SELECT station_id, base_lat::DOUBLE AS latitude, base_lon::DOUBLE AS longitude FROM c WHERE NOT changed")
def stable_stations(spark, sf_dir):
    found = stations.stable_stations(stations.station_locations(moving(spark, sf_dir)))
    return found.select("station_id", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))


MEAN_SQL = f"""WITH {PLACES_SQL}, d AS (SELECT DISTINCT station_id, latitude, longitude, elevation FROM p WHERE latitude IS NOT NULL)
SELECT station_id, round(avg(latitude::DOUBLE), 6) AS latitude, round(avg(longitude::DOUBLE), 6) AS longitude, round(avg(elevation::DOUBLE), 6) AS elevation FROM d GROUP BY station_id"""


@query(MEAN_SQL)
def station_mean_distinct_coords(spark, sf_dir):
    return stations.mean_places(moving(spark, sf_dir)).select("station_id", *[r6(F.col(c)).alias(c) for c in ("latitude", "longitude", "elevation")])


@query(f"""WITH {BASE_SQL}, d AS (SELECT DISTINCT latitude, longitude, elevation FROM v WHERE station_id = '5'), m AS (SELECT round(avg(latitude::DOUBLE), 6) AS a, round(avg(longitude::DOUBLE), 6) AS o, round(avg(elevation::DOUBLE), 6) AS e FROM d)
SELECT station_id, CASE WHEN changed THEN m.a ELSE base_lat END AS latitude, CASE WHEN changed THEN m.o ELSE base_lon END AS longitude, CASE WHEN changed THEN m.e ELSE base_elev END AS elevation, changed AS coordinate_warning FROM c, m WHERE station_id = '5'""")
def single_station_table(spark, sf_dir):
    found = stations.station_table(moving(spark, sf_dir), "5")
    return found.select("station_id", *[r6(F.col(c)).alias(c) for c in ("latitude", "longitude", "elevation")], "coordinate_warning")


#: Place by place: the first point that is left, the first elevation reported around it, and what is within reach of both.
ANCHOR_SQL = f"""WITH RECURSIVE {BASE_SQL},
q AS (SELECT station_id, latitude, longitude, elevation, row_number() OVER (PARTITION BY station_id ORDER BY min(seq)) AS nth FROM v WHERE station_id IN (SELECT station_id FROM c WHERE changed) GROUP BY station_id, latitude, longitude, elevation),
r AS (SELECT 0 AS step, station_id, nth, latitude::DOUBLE AS la, longitude::DOUBLE AS lo, elevation::DOUBLE AS el, false AS done, NULL::DOUBLE AS pa, NULL::DOUBLE AS po, NULL::DOUBLE AS pe FROM q
 UNION ALL
 SELECT step + 1, station_id, nth, la, lo, el, near AND NOT coalesce(abs(el - level) > 25, false), fa, fo, level FROM (
  SELECT *, arg_min(el, nth) FILTER (near AND el IS NOT NULL) OVER (PARTITION BY station_id) AS level FROM (
   SELECT *, abs(la - fa) <= 0.01 AND abs(lo - fo) <= 0.01 AS near FROM (
    SELECT step, station_id, nth, la, lo, el, arg_min(la, nth) OVER (PARTITION BY station_id) AS fa, arg_min(lo, nth) OVER (PARTITION BY station_id) AS fo FROM r WHERE NOT done)))),
k AS (SELECT station_id, la, lo, el, (step - 1)::INTEGER AS place, pa, po, pe FROM r WHERE done)"""


@query(f"""{ANCHOR_SQL} SELECT v.seq, v.station_id, place, round(pa, 6) AS place_latitude, round(po, 6) AS place_longitude, round(pe, 6) AS place_elevation
FROM v JOIN k ON v.station_id = k.station_id AND v.latitude::DOUBLE = la AND v.longitude::DOUBLE = lo AND v.elevation::DOUBLE IS NOT DISTINCT FROM el""")
def record_places(spark, sf_dir):
    found = stations.record_places(moving(spark, sf_dir))
    return found.select("seq", "station_id", "place", *[r6(F.col(f"place_{c}")).alias(f"place_{c}") for c in ("latitude", "longitude", "elevation")])


@query(f"{ANCHOR_SQL} SELECT DISTINCT station_id, place, round(pa, 6) AS latitude, round(po, 6) AS longitude, round(pe, 6) AS elevation FROM k")
def changed_station_places(spark, sf_dir):
    found = stations.changed_places(moving(spark, sf_dir))
    return found.select("station_id", "place", *[r6(F.col(c)).alias(c) for c in ("latitude", "longitude", "elevation")])


# --- regions -------------------------------------------------------------------------------------------------------


def shapes(spark: SparkSession) -> DataFrame:
    rows = [("north", 1, 0, OUTER), ("north", 1, 1, HOLE), ("north", 2, 0, FAR), ("south", 3, 0, [(x, y - 1.0) for x, y in FAR])]
    return spark.createDataFrame(rows, "region string, polygon int, ring int, points array<struct<x: double, y: double>>")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    xy = [F.get("embedding", k).cast("double") for k in (0, 1)]
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("station_id"), (xy[0] * 8).alias("longitude"), (xy[1] * 8).alias("latitude"), F.lit(None).cast("double").alias("elevation"))


def _edge_rows() -> str:
    rows = []
    for region, polygon, ring in (("north", 1, OUTER), ("north", 1, HOLE), ("north", 2, FAR), ("south", 3, [(x, y - 1.0) for x, y in FAR])):
        rows += [f"('{region}', {polygon}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
    return ", ".join(rows)


INSIDE_SQL = f"""e(region, polygon, x1, y1, x2, y2) AS (VALUES {_edge_rows()}),
v AS (SELECT vec_id, embedding[1]::DOUBLE * 8 AS x, embedding[2]::DOUBLE * 8 AS y FROM embeddings),
i AS (SELECT vec_id, region, polygon, sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS inside FROM v, e GROUP BY ALL)"""


@query(f"WITH {INSIDE_SQL}, b AS (SELECT region, min(x1) AS west, min(y1) AS south, max(x1) AS east, max(y1) AS north FROM e GROUP BY region) SELECT vec_id, region FROM v JOIN b ON x BETWEEN west AND east AND y BETWEEN south AND north WHERE region = 'north'")
def bbox_filter(spark, sf_dir):
    box = regions.boxes(regions.edges(shapes(spark))).where("region = 'north'")
    found = vectors(spark, sf_dir).join(F.broadcast(box))  # one row a region
    return found.where(regions.in_box(F.col("longitude"), F.col("latitude"))).select(F.col("station_id").alias("vec_id"), "region")


LAMBERT = projections.Lambert()
MAP_SQL = f"""v AS (SELECT vec_id, -97.0 + embedding[1]::DOUBLE * 80 AS lon, 38.0 + embedding[2]::DOUBLE * 40 AS lat FROM embeddings),
m AS (SELECT *, {projections.AXIS!r}::DOUBLE AS a, sqrt({projections.FLATTENING!r}::DOUBLE * (2 - {projections.FLATTENING!r}::DOUBLE)) AS e, radians(38.5::DOUBLE) AS p0, radians(lat) AS p FROM v WHERE lon BETWEEN -123 AND -71 AND lat BETWEEN 25 AND 50),
t AS (SELECT *, sin(p0) AS n, tan(pi() / 4 - p / 2) / pow((1 - e * sin(p)) / (1 + e * sin(p)), e / 2) AS t, tan(pi() / 4 - p0 / 2) / pow((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2) AS t0, cos(p0) / sqrt(1 - pow(e * sin(p0), 2)) AS m0 FROM m),
r AS (SELECT *, a * m0 / (n * pow(t0, n)) AS f FROM t)"""


def _on_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "embeddings").select("vec_id", (F.get("embedding", 0).cast("double") * 80 - 97).alias("longitude"), (F.get("embedding", 1).cast("double") * 40 + 38).alias("latitude"))
    return stations.on_map(places)


@query(f"WITH {MAP_SQL} SELECT vec_id, round(f * pow(t, n) * sin(n * radians(lon + 97.5)), 3) AS x, round(f * pow(t0, n) - f * pow(t, n) * cos(n * radians(lon + 97.5)), 3) AS y FROM r")
def station_map(spark, sf_dir):
    return _on_map(spark, sf_dir).select("vec_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(f"WITH {MAP_SQL} SELECT vec_id, round(lon, 6) AS longitude, round(lat, 6) AS latitude FROM m")
def map_to_degrees(spark, sf_dir):
    lon, lat = LAMBERT.inverse(F.col("x"), F.col("y"))
    return _on_map(spark, sf_dir).select("vec_id", r6(lon).alias("longitude"), r6(lat).alias("latitude"))


@query(f"WITH {INSIDE_SQL} SELECT DISTINCT vec_id FROM i WHERE inside AND polygon = 1")
def points_in_polygon(spark, sf_dir):
    edge = regions.edges(shapes(spark).where("polygon = 1"))
    return regions.members(vectors(spark, sf_dir), edge).select(F.col("station_id").alias("vec_id"))


@query(f"WITH {INSIDE_SQL} SELECT DISTINCT vec_id, region FROM i WHERE inside")
def region_union_membership(spark, sf_dir):
    return regions.members(vectors(spark, sf_dir), regions.edges(shapes(spark))).select(F.col("station_id").alias("vec_id"), "region")


@query(f"WITH {INSIDE_SQL}, s AS (SELECT DISTINCT vec_id FROM i WHERE inside AND region = 'north') SELECT event_id, user_id, round(x, 6) AS longitude, round(y, 6) AS latitude FROM events JOIN v ON vec_id = user_id WHERE user_id IN (SELECT vec_id FROM s)")
def region_semi_join(spark, sf_dir):
    found = regions.regional_stations(vectors(spark, sf_dir), regions.edges(shapes(spark)), "north")
    obs = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("station_id"), *[F.lit(0.0).alias(c) for c in ("latitude", "longitude", "elevation")])
    return regions.regional_records(obs, found).select("event_id", F.col("station_id").alias("user_id"), r6(F.col("longitude")).alias("longitude"), r6(F.col("latitude")).alias("latitude"))


# --- ordered operators and interpolation -----------------------------------------------------------------------------


@query("SELECT user_id::VARCHAR AS station_id, ts AS time, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_time FROM events")
def consecutive_pairs(spark, sf_dir):
    return hourly.consecutive(observed(spark, sf_dir))


GRID_SQL = "g AS (SELECT s.station_id, unnest(generate_series(date_trunc('hour', a), date_trunc('hour', b) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM (SELECT station_id, min(time) AS a, max(time) AS b FROM o GROUP BY station_id) s)"


def _at_hours(name: str, source: str, gap: int = GAP_HOURS, where: str = "") -> str:
    """Common table expressions of one interpolated variable: NAME_h(station_id, time, v)."""
    return f"""{name}_o AS (SELECT station_id, time, {source} AS v FROM o WHERE {source} IS NOT NULL),
{name}_p AS (SELECT g.station_id, g.h, p.time AS pt, p.v AS pv FROM g ASOF JOIN {name}_o p ON g.station_id = p.station_id AND g.h >= p.time),
{name}_n AS (SELECT q.*, n.time AS nt, n.v AS nv FROM {name}_p q ASOF LEFT JOIN {name}_o n ON q.station_id = n.station_id AND q.h < n.time),
{name}_h AS (SELECT station_id, h AS time, CASE WHEN pt = h THEN pv ELSE pv + (epoch_us(h) - epoch_us(pt)) * (nv - pv) / (epoch_us(nt) - epoch_us(pt)) END AS v FROM {name}_n
 WHERE pt = h OR (nt IS NOT NULL AND epoch_us(nt) - epoch_us(pt) <= {gap} * 3600000000){where})"""


OBS_SQL = "o AS (SELECT user_id::VARCHAR AS station_id, ts AS time, arg_min(value, event_id) FILTER (value IS NOT NULL) AS temperature FROM events GROUP BY ALL)"
TWO_SQL = """o AS (SELECT user_id::VARCHAR AS station_id, ts AS time, arg_min(value, event_id) FILTER (value IS NOT NULL AND event_type IN ('view', 'purchase')) AS temperature,
 arg_min(value, event_id) FILTER (value IS NOT NULL AND event_type NOT IN ('view', 'purchase')) AS dewpoint FROM events GROUP BY ALL)"""


def interpolated(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return hourly.at_full_hours(series.consolidated(observed(spark, sf_dir), ["temperature"]), ["temperature"], GAP_HOURS, **options)


@query(f"WITH {OBS_SQL}, {GRID_SQL}, {_at_hours('t', 'temperature')} SELECT station_id, time, round(v, 6) AS temperature FROM t_h")
def hourly_interpolation(spark, sf_dir):
    return interpolated(spark, sf_dir).select("station_id", "time", r6(F.col("temperature")).alias("temperature"))


@query(f"WITH {OBS_SQL}, {GRID_SQL}, {_at_hours('t', 'temperature', where=''' AND h BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 23:00' ''')} SELECT station_id, time, round(v, 6) AS temperature FROM t_h")
def hourly_interpolation_dates(spark, sf_dir):
    found = interpolated(spark, sf_dir, start=datetime(2024, 1, 10, 0, 20), end=datetime(2024, 1, 12, 23, 40))
    return found.select("station_id", "time", r6(F.col("temperature")).alias("temperature"))


@query(f"WITH {OBS_SQL}, {GRID_SQL}, {_at_hours('t', 'temperature')} SELECT station_id, count(v) AS n, round(min(v)::FLOAT::DOUBLE, 2) AS low, round(max(v)::FLOAT::DOUBLE, 2) AS high, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS first FROM t_h WHERE v IS NOT NULL GROUP BY station_id")
def hourly_cube(spark, sf_dir):
    """The hourly series written as NetCDF files of 64 stations each and read back."""
    whole = interpolated(spark, sf_dir)
    ends = observed(spark, sf_dir).agg(*[F.date_trunc("hour", f("time")).cast("timestamp_ntz") for f in (F.min, F.max)]).first()
    path = f"{shared_dir(spark)}/cube-{uuid.uuid4().hex}"
    sinks.write_cube(whole.select("station_id", "time", "temperature"), whole.select("station_id").distinct(), path, *ends, block=64)
    cells = netcdf.read(spark, path, "time double, temperature array<float>").select("source_file", "time", F.posexplode("temperature").alias("record_pos", "v")).where("v IS NOT NULL")
    names = netcdf.read(spark, path, "station_id string").withColumn("record_pos", F.col("record_pos").cast("int"))
    found = cells.join(names, ["source_file", "record_pos"]).groupBy("station_id")
    first = F.date_format(times.from_epoch(F.min("time")), "yyyy-MM-dd HH:mm:ss").alias("first")
    return found.agg(F.count("*").alias("n"), *[F.round(f("v").cast("double"), 2).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))], first)


BOUNDS_SQL = "SELECT CASE WHEN min(ts) = date_trunc('hour', min(ts)) THEN min(ts) ELSE date_trunc('hour', min(ts)) + INTERVAL 1 HOUR END AS first_hour, date_trunc('hour', max(ts)) AS last_hour FROM events"


@query(f"""WITH {OBS_SQL}, {GRID_SQL}, {_at_hours('t', 'temperature')}, b AS ({BOUNDS_SQL}),
d AS (SELECT s.station_id, unnest(generate_series(first_hour, last_hour, INTERVAL 1 HOUR)) AS time FROM (SELECT DISTINCT station_id FROM o) s, b)
SELECT d.station_id, d.time, round(v, 6) AS temperature FROM d LEFT JOIN t_h USING (station_id, time)""")
def hourly_interpolation_dense(spark, sf_dir):
    obs = observed(spark, sf_dir)
    grid = hourly.hour_grid(obs.select("station_id"), hourly.grid_bounds(obs))
    return hourly.dense(interpolated(spark, sf_dir), grid).select("station_id", "time", r6(F.col("temperature")).alias("temperature"))


@query(BOUNDS_SQL)
def grid_bounds(spark, sf_dir):
    return hourly.grid_bounds(observed(spark, sf_dir))


@query(f"""WITH {OBS_SQL}, x AS (SELECT station_id, time, temperature FROM o WHERE temperature IS NOT NULL), g AS (SELECT station_id, unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-09', INTERVAL 1 HOUR)) AS time FROM (SELECT DISTINCT station_id FROM o) s)
SELECT q.station_id, q.time, q.prev_time, q.prev_value, n.time AS next_time, n.temperature AS next_value FROM (SELECT g.*, p.time AS prev_time, p.temperature AS prev_value FROM g ASOF LEFT JOIN x p ON g.station_id = p.station_id AND g.time >= p.time) q
ASOF LEFT JOIN x n ON q.station_id = n.station_id AND q.time < n.time""")
def asof_prev_next(spark, sf_dir):
    obs = series.consolidated(observed(spark, sf_dir), ["temperature"])
    ends = spark.range(1).select(F.lit("2024-01-05").cast("timestamp_ntz").alias("first_hour"), F.lit("2024-01-09").cast("timestamp_ntz").alias("last_hour"))
    return hourly.neighbours(hourly.hour_grid(obs, ends), obs, "temperature")


#: For two series of half the records; so that some stations reach each threshold, and some don't.
WIDE_GAP_HOURS = 120
MERGED_SQL = f"WITH {TWO_SQL}, {GRID_SQL}, {_at_hours('t', 'temperature', WIDE_GAP_HOURS)}, {_at_hours('d', 'dewpoint', WIDE_GAP_HOURS)}, m AS (SELECT station_id, time, t_h.v AS temperature, d_h.v AS dewpoint FROM t_h FULL JOIN d_h USING (station_id, time))"


def merged_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.at_full_hours(series.consolidated(two_series(spark, sf_dir)), ["temperature", "dewpoint"], WIDE_GAP_HOURS)


@query(f"{MERGED_SQL} SELECT station_id, time, round(temperature, 6) AS temperature, round(dewpoint, 6) AS dewpoint FROM m")
def hourly_merge_two_series(spark, sf_dir):
    found = merged_hourly(spark, sf_dir)
    halves = [found.where(F.pmod(F.crc32("station_id"), F.lit(2)) == k) for k in (0, 1)]
    return hourly.merged(*halves).select("station_id", "time", r6(F.col("temperature")).alias("temperature"), r6(F.col("dewpoint")).alias("dewpoint"))


FRACTION_SQL = f"{MERGED_SQL}, f AS (SELECT station_id, count(*) FILTER (temperature IS NOT NULL AND dewpoint IS NOT NULL) / {N_HOURS}.0 AS valid_fraction FROM m GROUP BY station_id)"


@query(f"{FRACTION_SQL} SELECT station_id, round(valid_fraction, 6) AS valid_fraction FROM f")
def concurrent_valid_fraction(spark, sf_dir):
    found = validity.valid_fraction(merged_hourly(spark, sf_dir), ["temperature", "dewpoint"], N_HOURS)
    return found.select("station_id", r6(F.col("valid_fraction")).alias("valid_fraction"))


def _threshold(t: float) -> None:
    def run(spark, sf_dir):
        found = validity.at_least_of(merged_hourly(spark, sf_dir), ["temperature", "dewpoint"], N_HOURS, t)
        return found.select("station_id", "time", r6(F.col("temperature")).alias("temperature"), r6(F.col("dewpoint")).alias("dewpoint"))

    run.__name__ = f"valid_fraction_filter_{round(t * 1000)}"
    query(f"{FRACTION_SQL} SELECT station_id, time, round(temperature, 6) AS temperature, round(dewpoint, 6) AS dewpoint FROM m WHERE station_id IN (SELECT station_id FROM f WHERE valid_fraction >= {t})")(run)


for _t in validity.THRESHOLDS:
    _threshold(_t)


# --- sets and order ------------------------------------------------------------------------------------------------


@query("SELECT o_custkey AS station_id, o_orderkey AS seq FROM orders UNION ALL SELECT c_custkey, -c_custkey FROM customer")
def union_sources(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("station_id"), F.col("o_orderkey").alias("seq"))
    b = table(spark, sf_dir, "customer").select((-F.col("c_custkey")).alias("seq"), F.col("c_custkey").alias("station_id"))
    return hourly.merged(a, b)


@query("SELECT c_custkey FROM customer EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey").exceptAll(gone)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def membership_isin(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("SELECT count(DISTINCT user_id) AS stations, count(DISTINCT event_type) AS flags, count(*) AS records FROM events")
def count_distinct(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.countDistinct("user_id").alias("stations"), F.countDistinct("event_type").alias("flags"), F.count("*").alias("records"))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_name")
def sort_stations(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal").orderBy("s_name")
