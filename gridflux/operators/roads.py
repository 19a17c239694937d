"""Grid emissions on road lines (JON-19, JON-20, SNK-08 to SNK-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.operators.regrid import RegularGrid, cut_segments, normalise_parts, planar_length, segments


def road_weights(roads: DataFrame, grid: RegularGrid) -> DataFrame:
    """JON-19. Share of each cell that a road segment gets for each metre and 1000 units: length *
    weight, normalised in the cell, over the segment's whole length, * 1000."""
    pieces = cut_segments(segments(roads), grid, "fid").withColumn("length", planar_length(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")))
    parts = pieces.groupBy("fid", "link").agg(F.sum(F.col("length") * F.col("weight")).alias("part"))
    whole = segments(roads).groupBy("link").agg(F.sum(planar_length(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))).alias("whole"))
    return normalise_parts(parts, "fid").join(whole, "link").select("fid", "link", (F.col("weight") / F.col("whole") * 1000).alias("weight"), F.col("weight").alias("share"))


def to_roads(field: DataFrame, weights: DataFrame, *by: str) -> DataFrame:
    """JON-20. Emissions of each road link: sum of value * weight over its cells."""
    return field.join(weights, "fid").groupBy("link", *by).agg(F.sum(F.col("value") * F.col("weight")).alias("value"))


def wide_links(links: DataFrame, names: list[int]) -> DataFrame:
    """SNK-08. One row a step with Year, Mon, Day, JDay, Hr and a column L_%07d for each link."""
    stamped = links.select(F.year("ts").alias("Year"), F.month("ts").alias("Mon"), F.dayofmonth("ts").alias("Day"), F.dayofyear("ts").alias("JDay"), F.hour("ts").alias("Hr"), "link", "value")
    wide = stamped.groupBy("Year", "Mon", "Day", "JDay", "Hr").pivot("link", names).agg(F.sum("value"))
    return wide.select("Year", "Mon", "Day", "JDay", "Hr", *[F.col(f"`{n}`").alias(f"L_{n:07d}") for n in names])


def link_geometry(roads: DataFrame) -> DataFrame:
    """SNK-09. First and last vertex of each link, rounded to 3 digits, each link once."""
    a, b = F.element_at("line", 1), F.element_at("line", -1)
    ends = roads.select("link", *[F.round(p[c], 3).alias(n) for p, c, n in ((a, "x", "x1"), (a, "y", "y1"), (b, "x", "x2"), (b, "y", "y2"))])
    return ends.dropDuplicates(["link"])


def repeated_keys(weights: DataFrame) -> DataFrame:
    """SNK-10. Keys that stand more than once in a weight table."""
    return weights.groupBy("fid", "link").count().where("count > 1")
