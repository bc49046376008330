"""Command line: build hourly series from tables of observations.

skygrid.cli PRODUCT Y M D Y M D IDENTIFIER DATA_DIR [--rings PATH] [--region-column SQL] [--names PATH] [--max-hours H] [--land ROOT]

DATA_DIR holds obs/ and its manifest, and raw/ (NetCDF files); results go beside them. Files of raw/ that are new or changed are added
to obs/; those that can't be read are named, and listed in rejects/. With --land, the archive's files of the interval (and a day on either side) are first
landed in raw/ by the tasks of a Spark job, so DATA_DIR is a folder (or URI) that all executors reach.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timedelta

from skygrid.operators import ingest, sinks
from skygrid.plans.build import HALO, WARNING, build, interval
from skygrid.plans.products import PRODUCTS, Product
from skygrid.session import session
from skygrid.sources import archive, tables


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    out.add_argument("product", choices=sorted(PRODUCTS))
    for end in ("start", "end"):
        for part in ("year", "month", "day"):
            out.add_argument(f"{end}_{part}", type=int)
    out.add_argument("identifier", help="state, grid operator, CONUS or a station")
    out.add_argument("data_dir")
    out.add_argument("--rings", help="Parquet table of shapes: region, polygon, ring, points and the columns that select them")
    out.add_argument("--names", help="Parquet table of station_id, name")
    out.add_argument("--max-hours", type=float, default=2.0)
    out.add_argument("--refresh", action="store_true", help="land files again even if their ETag is the same")
    out.add_argument("--land", metavar="ROOT", help="land the files below this root of the archive first")
    out.add_argument("--jobs", type=int, default=8, help="files landed at a time from one host")
    out.add_argument("--cube", action="store_true", help="write the hourly table as NetCDF files as well")
    out.add_argument("--remove-original", action="store_true", help="drop landed files once their observations are written")
    return out


def raw_schema(product: Product) -> str:
    kinds = {product.station: "binary", product.time: "double"} | dict.fromkeys(product.flags.values(), "string")
    return ", ".join(f"{c} {kinds.get(c, 'float')}" for c in product.raw_columns)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    product, spark = PRODUCTS[args.product], session()
    start, end = datetime(args.start_year, args.start_month, args.start_day), datetime(args.end_year, args.end_month, args.end_day)
    table, raw = f"{args.data_dir}/obs", f"{args.data_dir}/raw"
    if args.land:
        landed = archive.land_interval(spark, product, start - HALO, end + timedelta(hours=23) + HALO, args.land, raw, f"{args.data_dir}/landed", args.jobs, refresh=args.refresh)
        for row in landed.where("error IS NOT NULL").select("url", "error").limit(20).collect():
            print(f"not landed: {row['url']}: {row['error']}")
    run = ingest.ingest(spark, raw, table, product, raw_schema(product))
    if run.where("rows = 0").limit(1).count():
        left = ingest.rejects(spark, table).join(run.select("run").distinct(), "run", "left_semi")
        sinks.write_table(left, f"{args.data_dir}/rejects")
        for row in left.limit(20).collect():
            print(f"left out: {row['file']}: {row['reason']}")
    if args.remove_original:
        archive.remove_landed(run.where("rows > 0").select("file"))
    obs = tables.with_sequence(ingest.current(spark, table, product.name))
    read = {k: spark.read.parquet(p) if p else None for k, p in (("rings", args.rings), ("names", args.names))}
    built = build(obs, args.identifier, start, end, max_hours=args.max_hours, **read)
    out = f"{args.data_dir}/{args.identifier}.{start:%Y%m%d}_{end:%Y%m%d}"
    sinks.write_table(built.records.drop("seq"), out)
    sinks.write_table(sinks.source_files(spark.read.parquet(out)), f"{out}.files")
    sinks.write_table(built.stations, f"{out}.stations", {"coordinate_warning": WARNING})
    columns = [c for c in built.hourly.columns if c not in ("station_id", "time")]
    notes = sinks.hourly_notes(columns, args.max_hours, ingest.declared_units(spark, table, product))
    sinks.write_hourly(sinks.described(built.hourly, notes), out, built.counted, built.n_hours)
    if args.cube:
        places = spark.read.parquet(f"{out}.stations").select("station_id", "latitude", "longitude", "elevation", "station_name")
        sinks.write_cube(sinks.hourly_at_least(spark, out), places, f"{out}.cube", *interval(start, end))


if __name__ == "__main__":
    main()
