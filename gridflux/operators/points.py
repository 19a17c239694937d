"""Stack and fire sources on the grid (AGG-09, AGG-10, JON-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.operators.regrid import RegularGrid, owned_points
from gridflux.operators.vertical import fire_weights, injection_level


def stack_flux(points: DataFrame, grid: RegularGrid, area: DataFrame, tops: list[float]) -> DataFrame:
    """AGG-09, JON-08, VRT-04. Flux of stacks (lat, lon, height_m, pollutant, emis) in each cell and level."""
    placed = owned_points(points, grid).where("fid IS NOT NULL").withColumn("lev", injection_level(F.col("height_m"), tops))
    mass = placed.groupBy("fid", "lev", "pollutant").agg(F.sum("emis").alias("emis"))
    return mass.join(area.select("fid", "area_m2"), "fid").select("fid", "lev", "pollutant", (F.col("emis") / F.col("area_m2")).alias("flux"))


def fire_flux(fires: DataFrame, src_area: DataFrame, owners: DataFrame, dst_area: DataFrame, tops: list[float], approach: str, height: Column, *by: str) -> DataFrame:
    """AGG-10, VRT-05, VRT-06. Fire flux (src_fid, pollutant, flux) moved to its destination cell, spread
    up to its injection height and divided by the destination's area, for each of ``by`` (time steps)."""
    mass = fires.join(src_area.select(F.col("fid").alias("src_fid"), "area_m2"), "src_fid").withColumn("mass", F.col("flux") * F.col("area_m2")).drop("area_m2")
    placed = mass.join(owners, "src_fid").where("dst_fid IS NOT NULL").withColumn("w", fire_weights(injection_level(height, tops), tops, approach))
    spread = placed.select(*by, "dst_fid", "pollutant", "mass", F.posexplode("w").alias("lev", "f")).where("f > 0")
    total = spread.groupBy(*by, "dst_fid", "lev", "pollutant").agg(F.sum(F.col("mass") * F.col("f")).alias("mass"))
    return total.join(dst_area.select(F.col("fid").alias("dst_fid"), F.col("area_m2").alias("dst_area")), "dst_fid").select(*by, F.col("dst_fid").alias("fid"), "lev", "pollutant", (F.col("mass") / F.col("dst_area")).alias("flux"))
