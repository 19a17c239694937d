"""Joins of cells with vector layers (JON-01 to JON-03, JON-18, JON-23, JON-24, JON-26, SET-04, SRC-16).

A layer has a row for each ring of its features: attributes, ring (array of (x, y)) and sign (1: shell, -1:
hole; without it all are shells), as in ``polygons``. Rings may be concave; cells are boxes or convex rings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridflux.operators import polygons
from gridflux.operators.nearest import candidates
from gridflux.operators.polygons import shifted, shoelace, signed, tile_size, with_bounds


def prepare_layer(layer: DataFrame, columns: list[str], xmin: float, xmax: float, ymin: float, ymax: float) -> DataFrame:
    """SRC-16. Layer with the wanted columns and the rings that touch a box."""
    near = with_bounds(signed(layer)).where((F.col("xmax") >= xmin) & (F.col("xmin") <= xmax) & (F.col("ymax") >= ymin) & (F.col("ymin") <= ymax))
    return near.select(*columns, "ring", "sign", "xmin", "xmax", "ymin", "ymax")


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting: whether a ring holds a point; lower and left borders count as inside."""
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        return (((a["y"] <= y) != (b["y"] <= y)) & (x < a["x"] + (y - a["y"]) * F.try_divide(b["x"] - a["x"], b["y"] - a["y"]))).cast("int")

    hits = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + F.coalesce(crosses(i), F.lit(0)))
    return hits % 2 == 1


def centroid_join(points: DataFrame, layer: DataFrame, attribute: str, tile: float | None = None) -> DataFrame:
    """JON-02. Attribute of the polygon that holds each point (fid, lon, lat); null outside and in holes, the
    least attribute where several do. Tiles follow from the layer's number and size of rings; a feature
    holds a point if more of its shells than of its holes do."""
    bounded = with_bounds(signed(layer))
    p = points.select("fid", "lon", "lat", *(F.col(c).alias(b) for b, c in (("cxmin", "lon"), ("cxmax", "lon"), ("cymin", "lat"), ("cymax", "lat"))))
    found = polygons.touching(bounded.select(attribute, "ring", "sign", "xmin", "xmax", "ymin", "ymax"), p, tile or tile_size(bounded, target=16))
    holds = found.where(contains(F.col("ring"), F.col("lon"), F.col("lat"))).groupBy("fid", attribute).agg(F.sum("sign").alias("n")).where("n > 0")
    return points.join(holds.groupBy("fid").agg(F.min(attribute).alias(attribute)), "fid", "left")


def nearest_join(points: DataFrame, layer: DataFrame, attribute: str, period: float | None = 360.0) -> DataFrame:
    """JON-01. Attribute of the nearest feature of each point (fid, lon, lat), the least of equal ones;
    distances are compared to nine decimals, so summing orders can't tell equal ones apart.

    Distance is planar, 0 within a feature and to the line of a hole within that. Longitudes come round
    after ``period``: a point looks across the seam too. Candidates come from ``nearest.candidates``.
    """
    rows = signed(layer).select(F.col(attribute).alias("_attribute"), "ring", "sign")
    rows = with_bounds(rows if period is None else shifted(rows, period))
    rows = rows.withColumnsRenamed({"xmin": "lo_x", "xmax": "hi_x", "ymin": "lo_y", "ymax": "hi_y"})
    p = points.select("fid", F.col("lon").alias("x"), F.col("lat").alias("y"))
    near = candidates(p, rows, "xy", 1, ["_attribute", "ring", "sign"], together="fid")
    near = near.select("fid", "_attribute", "sign", polygons.beside("ring", "x", "y").alias("_b"))
    near = near.select("fid", "_attribute", F.col("_b.line").alias("line"), F.when(F.col("_b.inside"), F.col("sign")).otherwise(0).alias("inside"))
    each = near.groupBy("fid", "_attribute").agg(F.when(F.sum("inside") > 0, F.lit(0.0)).otherwise(F.round(F.min("line"), 9)).alias("distance"))
    best = each.groupBy("fid").agg(F.min(F.struct("distance", "_attribute")).alias("b"))
    return points.join(best.select("fid", F.col("b.distance").alias("distance"), F.col("b._attribute").alias(attribute)), "fid", "left")


def cell_windows(cells: DataFrame) -> DataFrame:
    """fid, window (the cell's ring, or its box as one) and its bounds."""
    if "ring" in cells.columns:
        return with_bounds(cells.select("fid", "ring")).withColumnsRenamed({"ring": "window", "xmin": "cxmin", "xmax": "cxmax", "ymin": "cymin", "ymax": "cymax"})
    c = F.col
    window = polygons.box(c("lon_min"), c("lon_max"), c("lat_min"), c("lat_max"))
    return cells.select("fid", window.alias("window"), *(c(a).alias(b) for a, b in (("lon_min", "cxmin"), ("lon_max", "cxmax"), ("lat_min", "cymin"), ("lat_max", "cymax"))))


def overlaps(cells: DataFrame, layer: DataFrame, attribute: str, tile: float | None = None) -> DataFrame:
    """Planar area of each feature within each cell it touches, 0 where it only does that: fid, attribute, overlap."""
    windows = cell_windows(cells)
    size = tile or tile_size(windows, "cxmin", "cxmax", "cymin", "cymax")
    pairs = polygons.touching(with_bounds(signed(layer).select(attribute, "ring", "sign")), windows, size)
    parts = polygons.clipped(pairs.select("fid", attribute, "sign", "ring", "window"))
    parts = parts.where(F.size("ring") > 0)  # bounds may touch where the ring doesn't
    return parts.groupBy("fid", attribute).agg(F.greatest(F.sum(F.col("sign") * F.col("area")), F.lit(0.0)).alias("overlap"))


def largest_overlap(cells: DataFrame, layer: DataFrame, attribute: str, tile: float | None = None) -> DataFrame:
    """JON-03, WIN-05. Attribute with the largest overlap of each cell, the least of equal ones.

    A cell's only candidate counts even if it just touches; of several, those that only touch drop out.
    Overlaps are compared to nine decimals.
    """
    found = overlaps(cells, layer, attribute, tile)
    alone = F.count("*").over(Window.partitionBy("fid")) == 1
    ranked = found.withColumn("alone", alone).where("alone OR overlap > 0")
    best = ranked.groupBy("fid").agg(F.min(F.struct((-F.round("overlap", 9)).alias("o"), F.col(attribute).alias("a"))).alias("b"))
    return cells.join(best.select("fid", F.col("b.a").alias(attribute)), "fid", "left")


def region_mask(cells: DataFrame, layer: DataFrame, attribute: str, wanted: list[str]) -> DataFrame:
    """JON-18. Region of each cell by largest overlap; regions that aren't wanted are OTHERS."""
    mask = largest_overlap(cells, layer, attribute)
    name = F.when(F.col(attribute).isin(wanted), F.col(attribute)).when(F.col(attribute).isNotNull(), F.lit("OTHERS"))
    return mask.select("fid", name.alias("region_id"))


def grid_to_features(field: DataFrame, cells: DataFrame, layer: DataFrame, attribute: str) -> DataFrame:
    """JON-23. Mean of the field over each feature, weighted by overlap: attribute, variable, value."""
    parts = overlaps(cells, layer, attribute).where("overlap > 0")
    total = F.sum(F.col("value") * F.col("overlap")) / F.sum("overlap")
    return field.join(parts, "fid").groupBy(attribute, "variable").agg(total.alias("value"))


def from_layer(cells: DataFrame, layer: DataFrame, attribute: str, method: str) -> DataFrame:
    """JON-24. Cells with an attribute of a layer by nearest, centroid or intersection."""
    return {"nearest": nearest_join, "centroid": centroid_join, "intersection": largest_overlap}[method](cells, layer, attribute)


def iso2_of(cells: DataFrame, codes: DataFrame) -> DataFrame:
    """JON-26. ISO2 code of each cell's ISO3 code; unknown ones are UNK."""
    return cells.join(codes.select("iso3", "iso2"), "iso3", "left").withColumn("iso2", F.coalesce("iso2", F.lit("UNK")))


def covered_share(cells: DataFrame, layer: DataFrame, attribute: str) -> DataFrame:
    """SET-04, CHK-07. Share of each feature's planar area that the cells cover, and whether all of it."""
    whole = signed(layer).groupBy(attribute).agg(F.sum(F.col("sign") * shoelace(F.col("ring"))).alias("area"))
    inside = overlaps(cells, layer, attribute).groupBy(attribute).agg(F.sum("overlap").alias("inside"))
    share = F.coalesce("inside", F.lit(0.0)) / F.col("area")
    return whole.join(inside, attribute, "left").select(attribute, share.alias("share"), (share > 1 - 1e-9).alias("covered"))
