"""Structured Streaming jobs on arriving hourly tables (ST)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridflux.operators.stats import without_nan


def write_hours(fires: DataFrame, weights: DataFrame, species: DataFrame, path: str, checkpoint: str, part: str | None = None) -> StreamingQuery:
    """ST-01. Arriving fire hours mapped to the grid, speciated and written by hour.

    One file is one whole hour; an hour that arrives again replaces the former one, so the job keeps no
    state. Where an hour comes in several files, ``part`` names a column that tells them apart (a region, a
    satellite, a file name): each part of an hour is whole, replaces only itself when it arrives again, and
    ``read_hours`` sums them. weights: src_fid, dst_fid, weight; species: pollutant, species, fr.
    """
    mapped = fires.join(weights, "src_fid").join(species, "pollutant")
    parts = [part] if part else []
    rows = mapped.select(F.date_trunc("hour", "ts").alias("ts"), *parts, F.col("dst_fid").alias("fid"), "species", (F.col("flux") * F.col("weight") * F.col("fr")).alias("value"))

    def save(batch: DataFrame, _: int) -> None:
        batch.groupBy("ts", *parts, "fid", "species").agg(F.sum("value").alias("value")).write.partitionBy("ts", *parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start()


def read_hours(spark: SparkSession, path: str, part: str | None = None) -> DataFrame:
    """ST-01. What ``write_hours`` wrote: ts, fid, species, value, the parts of an hour summed."""
    kinds = "fid long, species string, value double, ts timestamp"
    rows = spark.read.schema(kinds + (f", `{part}` string" if part else "")).parquet(path)
    return rows.groupBy("ts", "fid", "species").agg(F.sum("value").alias("value")) if part else rows


def hourly_totals(field: DataFrame, late: str = "2 hours", *by: str) -> DataFrame:
    """ST-02. Total of each hour and variable of an arriving field."""
    return field.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "variable", *by).agg(F.sum(without_nan()).alias("total")).select(F.col("window.start").alias("hour"), "variable", *by, "total")


def daily_statistics(field: DataFrame, late: str = "1 day") -> DataFrame:
    """ST-03. Mean, greatest and least value of each day, variable and cell of an arriving hourly field."""
    v = without_nan()
    return field.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "variable", "fid").agg(F.avg(v).alias("mean_value"), F.max(v).alias("max_value"), F.min(v).alias("min_value"), F.count("*").alias("steps")).where("steps > 1").select(F.col("window.start").alias("day"), "variable", "fid", "mean_value", "max_value", "min_value")
