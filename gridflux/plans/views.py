"""Emission-like views on the driver's tables, in Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.operators.grid import EARTH_RADIUS_M, global_cells
from gridflux.operators.regrid import RegularGrid

FINE = RegularGrid(-90.0, -180.0, 5.0, 5.0, 36, 72)
COARSE = RegularGrid(-90.0, -180.0, 10.0, 10.0, 18, 36)


def load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cells(spark: SparkSession, grid: RegularGrid = FINE) -> DataFrame:
    """Global cells with a whole-hour zone, a country key and the equal-area plane's area."""
    c = global_cells(spark, grid.inc_lat, grid.inc_lon)
    area = EARTH_RADIUS_M * EARTH_RADIUS_M * F.radians(F.col("lon_max") - F.col("lon_min")) * (F.sin(F.radians("lat_max")) - F.sin(F.radians("lat_min")))
    return c.withColumns({"tz_h": (F.floor((F.col("lon") + 187.5) / 15.0) - 12).cast("int"), "nationkey": (F.col("fid") % 25).cast("int"), "area_m2": area})


def flux(spark: SparkSession, d: str) -> DataFrame:
    """Surface field by inventory, sector, pollutant, cell and month."""
    keys = {"inventory": F.col("l_returnflag"), "sector": F.col("l_linestatus"), "pollutant": (F.col("l_linenumber") % 4).cast("int"), "fid": (F.col("l_partkey") * 7 + F.col("l_suppkey")) % 2592, "month_i": F.month("l_shipdate")}
    return load(spark, d, "lineitem").groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.sum("l_quantity").alias("flux"))


def points(spark: SparkSession, d: str) -> DataFrame:
    """Stacks."""
    lat, lon = (F.col("o_custkey") * 37 % 1800) / 10.0 - 90 + 0.05, (F.col("o_orderkey") * 53 % 3600) / 10.0 - 180 + 0.05
    return load(spark, d, "orders").select(F.col("o_orderkey").alias("point_id"), F.col("o_orderstatus").alias("pollutant"), lat.alias("lat"), lon.alias("lon"), (F.col("o_orderkey") % 700).cast("int").alias("height_m"), F.col("o_totalprice").alias("emis"))


def field(spark: SparkSession, d: str) -> DataFrame:
    """Hourly gridded variable on 20 cells."""
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.col("event_type").alias("variable"), F.date_trunc("hour", "ts").alias("ts"), (F.col("user_id") % 20).alias("fid")).agg(F.avg("value").alias("value"))


_GRID = """SELECT fid, row_i, col_i, -90.0::DOUBLE + {i} * row_i AS lat_min, -90.0::DOUBLE + {i} * row_i + {i} AS lat_max,
 -180.0::DOUBLE + {i} * col_i AS lon_min, -180.0::DOUBLE + {i} * col_i + {i} AS lon_max,
 -90.0::DOUBLE + {i} * row_i + {i} / 2.0 AS lat, -180.0::DOUBLE + {i} * col_i + {i} / 2.0 AS lon,
 CAST(floor((-180.0::DOUBLE + {i} * col_i + {i} / 2.0 + 187.5) / 15.0) - 12 AS INTEGER) AS tz_h, CAST(fid % 25 AS INTEGER) AS nationkey,
 6371000.0::DOUBLE * 6371000.0 * radians({i}) * (sin(radians(-90.0 + {i} * row_i + {i})) - sin(radians(-90.0 + {i} * row_i))) AS area_m2
 FROM (SELECT CAST(range AS BIGINT) AS fid, CAST(range // {n} AS INTEGER) AS row_i, CAST(range % {n} AS INTEGER) AS col_i FROM range({m}))"""
VIEWS = {
    "cells": _GRID.format(i="5.0::DOUBLE", n=72, m=2592),
    "coarse": _GRID.format(i="10.0::DOUBLE", n=36, m=648),
    "flux": "SELECT l_returnflag AS inventory, l_linestatus AS sector, CAST(l_linenumber % 4 AS INTEGER) AS pollutant, CAST((l_partkey * 7 + l_suppkey) % 2592 AS BIGINT) AS fid, CAST(month(l_shipdate) AS INTEGER) AS month_i, sum(l_quantity) AS flux FROM lineitem GROUP BY 1, 2, 3, 4, 5",
    "points": "SELECT o_orderkey AS point_id, o_orderstatus AS pollutant, ((o_custkey * 37) % 1800) / 10.0::DOUBLE - 90 + 0.05::DOUBLE AS lat, ((o_orderkey * 53) % 3600) / 10.0::DOUBLE - 180 + 0.05::DOUBLE AS lon, CAST(o_orderkey % 700 AS INTEGER) AS height_m, o_totalprice AS emis FROM orders",
    "field": "SELECT event_type AS variable, date_trunc('hour', ts) AS ts, CAST(user_id % 20 AS BIGINT) AS fid, avg(value) AS value FROM events GROUP BY 1, 2, 3",
    "w": """SELECT c.fid AS src_fid, CAST((c.row_i // 2) * 36 + c.col_i // 2 AS BIGINT) AS dst_fid, 1.0::DOUBLE AS weight FROM cells c""",
}


def with_views(body: str, *names: str, **more: str) -> str:
    """``body`` behind the named views and further ones."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    text = body.strip()
    if not parts:
        return text
    return f"WITH {', '.join(parts)} {text}" if not text.upper().startswith("WITH ") else f"WITH {', '.join(parts)}, {text[5:]}"
