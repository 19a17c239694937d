"""Sinks and caches (SNK): Parquet, partitioned so that a step, a pollutant or a cache entry is replaced alone."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.operators.units import encoded_date


def write_steps(field: DataFrame, path: str) -> None:
    """SNK-01. Append or replace the time steps that the field holds."""
    field.write.partitionBy("ts").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_levels(field: DataFrame, path: str, ts: str = "ts") -> None:
    """SNK-11. One partition a level, with the date of each step as a number beside it."""
    field.withColumn("encoded_date", encoded_date(F.col(ts))).write.partitionBy("lev").mode("overwrite").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def cached_fields(spark: SparkSession, path: str, wanted: DataFrame, make) -> DataFrame:
    """SNK-04, SNK-14. Fields of a cache by pollutant; what is wanted (pollutant) and not yet there is made by
    ``make(missing)`` and added.

    Data lie under ``data`` by pollutant and run; a run's pollutants enter ``finished`` last, when all their rows
    are written. Only finished ones are read, so a run that ended half-way is made again and its rows
    are never seen. One row for each pollutant comes to the driver.
    """
    names = {r[0] for r in wanted.select("pollutant").distinct().collect()}

    def done() -> list:
        return spark.read.parquet(f"{path}/finished").collect() if exists(spark, f"{path}/finished/_SUCCESS") else []

    if lost := sorted(names - {r["pollutant"] for r in done()}):
        run = uuid.uuid4().hex
        make(spark.createDataFrame([(p,) for p in lost], "pollutant string")).withColumn("run", F.lit(run)).write.partitionBy("pollutant", "run").mode("append").parquet(f"{path}/data")
        spark.createDataFrame([(p, run) for p in lost], "pollutant string, run string").coalesce(1).write.mode("append").parquet(f"{path}/finished")
    first: dict[str, str] = {}
    for r in sorted(done()):  # two runs at once may both have made one
        first.setdefault(r["pollutant"], r["run"])
    runs = {first[p] for p in names}
    kept = [f"{p}/{first[p]}" for p in sorted(names)]
    table = spark.read.parquet(f"{path}/data").where(F.col("run").isin(sorted(runs)) & F.col("pollutant").isin(sorted(names)))
    return table.where(F.concat_ws("/", "pollutant", "run").isin(kept)).drop("run")


def cache_name(sector: str, proxy: dict) -> str:
    """SNK-05. Fingerprint of a proxy for its weight cache: 16 hex digits."""
    return hashlib.sha256(json.dumps([sector, proxy], sort_keys=True).encode()).hexdigest()[:16]


def cached(spark: SparkSession, path: str, make) -> DataFrame:
    """SNK-05, SNK-06. A table from its cache; made and stored where there is none."""
    if not exists(spark, f"{path}/_SUCCESS"):  # a write that ended half-way is no cache
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stored_warnings(spark: SparkSession, path: str, new: DataFrame | None = None) -> DataFrame:
    """SNK-07. Warnings (message) kept beside a cache, each once; ``new`` ones are added."""
    if new is not None:
        fresh = new.select("message").distinct()
        (fresh.join(spark.read.parquet(path), "message", "left_anti") if exists(spark, path) else fresh).write.mode("append").parquet(path)
    return spark.read.parquet(path).distinct()


def cell_polygons(field: DataFrame, cells: DataFrame, variables: list[str]) -> DataFrame:
    """SNK-12. Cells as WKT polygons with a column for each variable, of one time and level."""
    wide = field.groupBy("fid").pivot("variable", variables).agg(F.first("value"))
    at = lambda x, y: F.concat_ws(" ", F.format_string("%.6f", x), F.format_string("%.6f", y))
    corners = [at(F.col(x), F.col(y)) for x, y in (("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max"), ("lon_min", "lat_min"))]
    return cells.join(wide, "fid").select("fid", F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corners), F.lit("))")).alias("wkt"), *variables)


def write_debug(table: DataFrame, path: str, *order: str) -> None:
    """SNK-13, SRT-02. Debug table as CSV files whose rows go on in order from one file name to the next."""
    table.orderBy(*order).write.mode("overwrite").csv(path, header=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one that the cluster names in spark.checkpoint.dir; a temporary one on
    a single machine that names none."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='gridflux-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/gridflux/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in a scratch folder, for what reads it more than once."""
    to = scratch(df.sparkSession, name)
    df.write.parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)


def is_small(df: DataFrame, most: int = 64 << 20) -> bool:
    """Whether the rows, counted as JSON, may be broadcast; ``df`` should be cheap to read."""
    return (df.agg(F.sum(F.length(F.to_json(F.struct("*"))).cast("long"))).first()[0] or 0) <= most
