"""Observations that grow by files: what is new or changed is read, and replaces what those files gave before.

The table holds the rows of every run, by product, day and run. A manifest has a row for each file of a run; it is written last, in one
commit, so a run that fails leaves rows that no manifest names. ``current`` gives the rows of each file's last run: runs that
aren't in the manifest are left out as partitions, and rows that a later run replaced by an anti-join with the few (file, run) that were.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygrid.operators import preprocess
from skygrid.plans.products import PRODUCTS, Product
from skygrid.sources import netcdf, store

MANIFEST = "product string, file string, bytes long, changed timestamp, run string, rows long, first timestamp_ntz, last timestamp_ntz, error string"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """The manifest of the table at this path; without rows where there is none."""
    return spark.read.schema(MANIFEST).parquet(f"{table}.manifest") if exists(spark, f"{table}.manifest") else spark.createDataFrame([], MANIFEST)


def last_runs(manifest_: DataFrame) -> DataFrame:
    """The manifest's row of each file's last run."""
    newest = Window.partitionBy("product", "file").orderBy(F.desc("run"))
    return manifest_.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def new_files(listed: DataFrame, manifest_: DataFrame) -> DataFrame:
    """Files of listed(file, bytes, changed) that the manifest doesn't have, or has with other bytes or another time."""
    return listed.join(last_runs(manifest_).select("file", "bytes", "changed"), ["file", "bytes", "changed"], "left_anti")


def append(obs: DataFrame, files: DataFrame, table: str, product: str) -> DataFrame:
    """Add the rows that files(file, bytes, changed) gave, as one run; the manifest's rows of the run.

    obs has source_file. A file without rows is in the manifest with none, and with error where one is given in files.
    """
    spark = obs.sparkSession
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rows = obs.withColumns({"product": F.lit(product), "date": F.to_date("time"), "run": F.lit(run)})
    # Few files a day: a day's rows go to some tasks, not to all.
    spread = F.pmod(F.xxhash64("source_file"), F.lit(4))
    rows.repartition("date", spread).write.mode("append").partitionBy("product", "date", "run").parquet(table)
    done = None
    if exists(spark, f"{table}/product={product}"):
        read = _rows(spark, table, product).where(F.col("run") == run)
        done = read.groupBy(F.col("source_file").alias("file")).agg(F.count("*").alias("rows"), F.min("time").alias("first"), F.max("time").alias("last"))
    given = files if "error" in files.columns else files.withColumn("error", F.lit(None).cast("string"))
    given = given.join(done, "file", "left") if done is not None else given.withColumns({"rows": F.lit(0), "first": F.lit(None), "last": F.lit(None)})
    given = given.withColumns({"product": F.lit(product), "run": F.lit(run), "rows": F.coalesce("rows", F.lit(0)).cast("long")})
    given.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in MANIFEST.split(", ")]).write.mode("append").parquet(f"{table}.manifest")
    return manifest(spark, table).where(F.col("run") == run)


def _rows(spark: SparkSession, table: str, product: str) -> DataFrame:
    """All rows of a product, of whatever run; products differ in their columns, so only its own files say which there are."""
    return spark.read.option("basePath", table).parquet(f"{table}/product={product}").drop("product")


def current(spark: SparkSession, table: str, product: str) -> DataFrame:
    """The observations of a product, with date: each file's rows of its last run."""
    told = manifest(spark, table).where(F.col("product") == product)
    if not exists(spark, f"{table}/product={product}"):
        raise ValueError(f"{table} has no observations of {product}")
    rows = _rows(spark, table, product)
    replaced = told.select("file", "run").join(last_runs(told).select("file", "run"), ["file", "run"], "left_anti")
    rows = rows.join(told.select("run").distinct(), "run", "left_semi")
    return rows.join(replaced, (rows["source_file"] == replaced["file"]) & (rows["run"] == replaced["run"]), "left_anti").drop("run")


def _of_product(file: Column, product: Product) -> Column:
    """Landed files bear their product's name; what lies there besides may be of any."""
    name = F.element_at(F.split(file, "/"), -1)
    return name.startswith(f"{product.name}.") | ~name.rlike(f"^({'|'.join(PRODUCTS)})\\.")


def ingest(spark: SparkSession, raw: str, table: str, product: Product, schema: str) -> DataFrame:
    """Read the new and changed NetCDF files below raw into the table; the manifest's rows of this run (none, if nothing is new).

    A file that can't be read, or has no record with a valid time, is in the manifest without rows (``rejects`` says why); it is tried
    again when it changes. Files are listed once: one that changes meanwhile is new to the next run.
    """
    told = manifest(spark, table).where(F.col("product") == product.name)
    if not exists(spark, raw):
        return told.where("false")
    new = new_files(store.listing(spark, raw).where(_of_product(F.col("file"), product)), told).collect()
    if not new:
        return told.where("false")
    obs = preprocess.observations(netcdf.read(spark, [r["file"] for r in new], schema, "skip"), product)
    run = append(obs, spark.createDataFrame(new, "file string, bytes long, changed timestamp"), table, product.name)
    said = netcdf.declared_fills(netcdf.header_catalogue(run.where("rows > 0"))).select("variable", "units").where("units IS NOT NULL")
    said.withColumns({"product": F.lit(product.name), "run": F.lit(run.select("run").first()["run"])}).coalesce(1).write.mode("append").parquet(f"{table}.units")
    return run


def declared_units(spark: SparkSession, table: str, product: Product) -> dict[str, str]:
    """Unit of each observable, as the headers of the product's files declare it; kept beside the table as files go."""
    path = f"{table}.units"
    if not exists(spark, path):
        return {}
    rows = spark.read.parquet(path).where((F.col("product") == product.name) & F.col("units").isNotNull())
    found = {r["variable"]: r["units"] for r in rows.groupBy("variable").agg(F.max_by("units", "run").alias("units")).collect()}
    out = {product.renames.get(v, v): u for v, u in found.items()}
    return out | {c: out["windSpeed"] for c in ("U10", "V10") if "windSpeed" in out}


def rejects(spark: SparkSession, table: str) -> DataFrame:
    """file, run, reason of all files whose last run gave no rows; their headers are read, and their ends where they are gzip."""
    empty = last_runs(manifest(spark, table)).where("rows = 0").select("product", "file", "run")
    said = netcdf.header_catalogue(empty.select("file").distinct(), whole=True).select("file", "error", "records")
    reason = F.coalesce("error", F.when(F.col("records") == 0, "no records").otherwise("no usable record, or a column of the product is missing"))
    return empty.join(said, "file").select("product", "file", "run", reason.alias("reason"))
