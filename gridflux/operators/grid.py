"""Grids as DataFrames, coordinate columns and cell measures (GRD)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0


def regular_cells(spark: SparkSession, lat_orig: float, lon_orig: float, inc_lat: float, inc_lon: float, n_lat: int, n_lon: int) -> DataFrame:
    """GRD-01. Regular lat-lon cells: centre = origin + inc / 2 + i * inc; fid = row * n_lon + column."""
    cells = spark.range(n_lat * n_lon).select(
        F.col("id").alias("fid"), F.floor(F.col("id") / n_lon).cast("int").alias("row_i"), (F.col("id") % n_lon).cast("int").alias("col_i")
    )
    south, west = lat_orig + F.col("row_i") * inc_lat, lon_orig + F.col("col_i") * inc_lon
    return cells.withColumns(
        {"lat": south + inc_lat / 2, "lon": west + inc_lon / 2, "lat_min": south, "lat_max": south + inc_lat, "lon_min": west, "lon_max": west + inc_lon}
    )


def global_cells(spark: SparkSession, inc_lat: float, inc_lon: float) -> DataFrame:
    """GRD-02. Whole globe from (-90, -180)."""
    return regular_cells(spark, -90.0, -180.0, inc_lat, inc_lon, int(180 // inc_lat), int(360 // inc_lon))


def global_half_end_cells(spark: SparkSession, inc_lat: float, inc_lon: float) -> DataFrame:
    """GRD-03. Whole globe whose first and last rows and columns are half cells, centres moved inward."""
    if (90 / inc_lat) % 1 or (180 / inc_lon) % 1:
        raise ValueError("the increment must divide 90 and 180 degrees")
    n_lat, n_lon = 2 * int(90 / inc_lat) + 1, 2 * int(180 / inc_lon) + 1
    cells = regular_cells(spark, -90.0 - inc_lat / 2, -180.0 - inc_lon / 2, inc_lat, inc_lon, n_lat, n_lon)

    def inward(centre: str, at: str, n: int, inc: float) -> Column:
        return F.when(F.col(at) == 0, F.col(centre) + inc / 4).when(F.col(at) == n - 1, F.col(centre) - inc / 4).otherwise(F.col(centre))

    return cells.withColumns(
        {
            "lat": inward("lat", "row_i", n_lat, inc_lat),
            "lon": inward("lon", "col_i", n_lon, inc_lon),
            "lat_min": F.greatest("lat_min", F.lit(-90.0)),
            "lat_max": F.least("lat_max", F.lit(90.0)),
            "lon_min": F.greatest("lon_min", F.lit(-180.0)),
            "lon_max": F.least("lon_max", F.lit(180.0)),
        }
    )


def rotated_to_lonlat(rlon: Column, rlat: Column, centre_lon: float, centre_lat: float) -> tuple[Column, Column]:
    """GRD-04, GRD-23. Geographic longitude and latitude of rotated-pole coordinates."""
    tilt = math.radians(centre_lat)
    x, y = F.radians(rlon), F.radians(rlat)
    z = math.sin(tilt) * F.cos(y) * F.cos(x) + math.cos(tilt) * F.sin(y)
    east = F.cos(y) * F.sin(x)
    north = math.cos(tilt) * F.cos(y) * F.cos(x) - math.sin(tilt) * F.sin(y)
    return wrap_longitude(F.degrees(F.atan2(east, north)) + centre_lon), F.degrees(F.asin(F.least(F.greatest(z, F.lit(-1.0)), F.lit(1.0))))


def lonlat_to_rotated(lon: Column, lat: Column, centre_lon: float, centre_lat: float) -> tuple[Column, Column]:
    """GRD-23. Rotated-pole longitude and latitude of geographic coordinates."""
    tilt = math.radians(centre_lat)
    x, y = F.radians(lon - centre_lon), F.radians(lat)
    z = math.cos(tilt) * F.sin(y) - math.sin(tilt) * F.cos(y) * F.cos(x)
    east = F.cos(y) * F.sin(x)
    north = math.cos(tilt) * F.cos(y) * F.cos(x) + math.sin(tilt) * F.sin(y)
    return F.degrees(F.atan2(east, north)), F.degrees(F.asin(F.least(F.greatest(z, F.lit(-1.0)), F.lit(1.0))))


def rotated_cells(spark: SparkSession, centre_lat: float, centre_lon: float, west: float, south: float, inc_rlat: float, inc_rlon: float) -> DataFrame:
    """GRD-04. Rotated-pole cells; n = int(|bound| / inc * 2 + 1) on each axis."""
    n_lat, n_lon = int(abs(south) / inc_rlat * 2 + 1), int(abs(west) / inc_rlon * 2 + 1)
    return _native_cells(spark, south, west, inc_rlat, inc_rlon, n_lat, n_lon, lambda x, y: rotated_to_lonlat(x, y, centre_lon, centre_lat))


def nested_rotated_cells(spark: SparkSession, parent: dict, ratio: int, i_start: int, j_start: int, n_rlat: int, n_rlon: int) -> DataFrame:
    """GRD-05. Cells nested in a rotated parent, from a 1-based parent start, ``ratio`` times finer.

    ``parent``: centre_lat, centre_lon, west, south, inc_rlat, inc_rlon.
    """
    inc_lat, inc_lon = parent["inc_rlat"] / ratio, parent["inc_rlon"] / ratio
    south, west = parent["south"] + (j_start - 1) * parent["inc_rlat"], parent["west"] + (i_start - 1) * parent["inc_rlon"]
    return _native_cells(spark, south, west, inc_lat, inc_lon, n_rlat, n_rlon, lambda x, y: rotated_to_lonlat(x, y, parent["centre_lon"], parent["centre_lat"]))


def _native_cells(spark: SparkSession, y0: float, x0: float, inc_y: float, inc_x: float, ny: int, nx: int, to_lonlat) -> DataFrame:
    """Cells whose first centre is (x0, y0) in native coordinates, with their four corners."""
    cells = spark.range(ny * nx).select(F.col("id").alias("fid"), F.floor(F.col("id") / nx).cast("int").alias("row_i"), (F.col("id") % nx).cast("int").alias("col_i"))
    cells = cells.withColumns({"y": y0 + F.col("row_i") * inc_y, "x": x0 + F.col("col_i") * inc_x})
    lon, lat = to_lonlat(F.col("x"), F.col("y"))
    return cells.withColumns({"lon": lon, "lat": lat, "ring": corner_ring(F.col("x"), F.col("y"), inc_x, inc_y, to_lonlat)})


def corner_ring(x: Column, y: Column, inc_x: float, inc_y: float, to_lonlat=lambda x, y: (x, y)) -> Column:
    """GRD-11, GRD-12. Corners of a cell, counter-clockwise from the south-west, as array of (x, y)."""
    sides = [(-1, -1), (1, -1), (1, 1), (-1, 1)]
    corners = [to_lonlat(x + sx * inc_x / 2, y + sy * inc_y / 2) for sx, sy in sides]
    return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in corners])


def lcc_to_lonlat(x: Column, y: Column, lat_1: float, lat_2: float, lat_0: float, lon_0: float) -> tuple[Column, Column]:
    """GRD-06. Inverse of the spherical Lambert conformal conic projection."""
    n, scale, rho_0 = _lcc(lat_1, lat_2, lat_0)
    rho = math.copysign(1.0, n) * F.sqrt(x * x + (rho_0 - y) * (rho_0 - y))
    theta = F.atan2(math.copysign(1.0, n) * x, math.copysign(1.0, n) * (rho_0 - y))
    return wrap_longitude(lon_0 + F.degrees(theta / n)), F.degrees(2 * F.atan(F.pow(scale / rho, F.lit(1 / n))) - math.pi / 2)


def lonlat_to_lcc(lon: Column, lat: Column, lat_1: float, lat_2: float, lat_0: float, lon_0: float) -> tuple[Column, Column]:
    """GRD-06, GRD-23. Spherical Lambert conformal conic projection; null at the pole that lies at infinity."""
    n, scale, rho_0 = _lcc(lat_1, lat_2, lat_0)
    rho = F.try_divide(F.lit(scale), F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), F.lit(n)))
    theta = n * F.radians(wrap_longitude(lon - lon_0))
    return rho * F.sin(theta), rho_0 - rho * F.cos(theta)


def _lcc(lat_1: float, lat_2: float, lat_0: float) -> tuple[float, float, float]:
    a, b, c = (math.radians(v) for v in (lat_1, lat_2, lat_0))
    half = lambda v: math.tan(math.pi / 4 + v / 2)
    n = math.sin(a) if lat_1 == lat_2 else math.log(math.cos(a) / math.cos(b)) / math.log(half(b) / half(a))
    scale = EARTH_RADIUS_M * math.cos(a) * half(a) ** n / n
    return n, scale, scale / half(c) ** n


def mercator_to_lonlat(x: Column, y: Column, lat_ts: float, lon_0: float) -> tuple[Column, Column]:
    """GRD-07. Inverse of the spherical Mercator projection with a true-scale latitude."""
    k = EARTH_RADIUS_M * math.cos(math.radians(lat_ts))
    return wrap_longitude(lon_0 + F.degrees(x / k)), F.degrees(2 * F.atan(F.exp(y / k)) - math.pi / 2)


def lonlat_to_mercator(lon: Column, lat: Column, lat_ts: float, lon_0: float) -> tuple[Column, Column]:
    """GRD-07, GRD-23. Spherical Mercator projection."""
    k = EARTH_RADIUS_M * math.cos(math.radians(lat_ts))
    return k * F.radians(wrap_longitude(lon - lon_0)), k * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def laea_to_lonlat(x: Column, y: Column, lat_0: float, lon_0: float) -> tuple[Column, Column]:
    """GRD-08. Inverse of the spherical Lambert azimuthal equal-area projection."""
    p = math.radians(lat_0)
    rho = F.sqrt(x * x + y * y)
    c = 2 * F.asin(F.least(rho / (2 * EARTH_RADIUS_M), F.lit(1.0)))
    lat = F.when(rho == 0, F.lit(p)).otherwise(F.asin(F.cos(c) * math.sin(p) + y * F.sin(c) * math.cos(p) / rho))
    lon = F.atan2(x * F.sin(c), rho * math.cos(p) * F.cos(c) - y * math.sin(p) * F.sin(c))
    return wrap_longitude(lon_0 + F.degrees(lon)), F.degrees(lat)


def lonlat_to_laea(lon: Column, lat: Column, lat_0: float, lon_0: float) -> tuple[Column, Column]:
    """GRD-08, GRD-23. Spherical Lambert azimuthal equal-area projection."""
    p, y, x = math.radians(lat_0), F.radians(lat), F.radians(lon - lon_0)
    k = EARTH_RADIUS_M * F.sqrt(2 / (1 + math.sin(p) * F.sin(y) + math.cos(p) * F.cos(y) * F.cos(x)))
    return k * F.cos(y) * F.sin(x), k * (math.cos(p) * F.sin(y) - math.sin(p) * F.cos(y) * F.cos(x))


def projected_cells(spark: SparkSession, nx: int, ny: int, inc_x: float, inc_y: float, x_0: float, y_0: float, to_lonlat) -> DataFrame:
    """GRD-06, GRD-07, GRD-08. Cells of a projected grid whose south-west edge is (x_0, y_0) metres."""
    return _native_cells(spark, y_0 + inc_y / 2, x_0 + inc_x / 2, inc_y, inc_x, ny, nx, to_lonlat)


def wrap_longitude(lon: Column) -> Column:
    """Longitude from -180 on, under 180."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def stations(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """GRD-09. A point set: the points with a station number in the order of (lat, lon, key columns)."""
    return points.withColumn("station", F.xxhash64(*points.columns)).select("station", *points.columns).where(F.col(lat).between(-90, 90) & F.col(lon).isNotNull())


def axis_bounds(axis: DataFrame, key: str, coordinate: str, tolerance: float = 1e-6) -> DataFrame:
    """GRD-10. Bounds half-way between neighbours of each uniform axis; a non-uniform one gives null.

    ``axis``: the values of each axis ``key``; the increment is the whole span over the steps.
    """
    by = Window.partitionBy(key).orderBy(coordinate)
    whole = Window.partitionBy(key)
    steps = axis.select(key, coordinate).distinct().withColumn("gap", F.lead(coordinate).over(by) - F.col(coordinate))
    steps = steps.withColumn("inc", F.when(F.count("*").over(whole) > 1, F.try_divide(F.max(coordinate).over(whole) - F.min(coordinate).over(whole), F.count("*").over(whole) - 1)))
    uniform = F.max(F.abs(F.col("gap") - F.col("inc"))).over(whole) <= tolerance * F.abs(F.col("inc"))
    steps = steps.withColumn("uniform", uniform)
    return steps.select(key, coordinate, F.when(F.col("uniform"), F.col(coordinate) - F.col("inc") / 2).alias("lower"), F.when(F.col("uniform"), F.col(coordinate) + F.col("inc") / 2).alias("upper"))


def triangle_area(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column], radius_a: float = EARTH_RADIUS_M, radius_b: float = EARTH_RADIUS_M) -> Column:
    """GRD-13. L'Huilier's spherical triangle of (lon, lat) corners, times both radii."""

    def side(p: tuple[Column, Column], q: tuple[Column, Column]) -> Column:
        dlat, dlon = F.radians(q[1] - p[1]) / 2, F.radians(q[0] - p[0]) / 2
        h = F.pow(F.sin(dlat), F.lit(2)) + F.cos(F.radians(p[1])) * F.cos(F.radians(q[1])) * F.pow(F.sin(dlon), F.lit(2))
        return 2 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))

    x, y, z = side(a, b), side(b, c), side(c, a)
    s = (x + y + z) / 2
    t = F.tan(s / 2) * F.tan((s - x) / 2) * F.tan((s - y) / 2) * F.tan((s - z) / 2)
    return 4 * F.atan(F.sqrt(F.greatest(t, F.lit(0.0)))) * radius_a * radius_b


def ring_area(ring: Column) -> Column:
    """GRD-13, GRD-14. Spherical area of a convex ring of (x, y): triangles from its first corner."""
    first = ring[0]
    at = lambda p: (p["x"], p["y"])
    fans = F.transform(F.sequence(F.lit(1), F.size(ring) - 2), lambda i: triangle_area(at(first), at(F.get(ring, i)), at(F.get(ring, i + 1))))
    return F.when(F.size(ring) < 3, F.lit(0.0)).otherwise(F.aggregate(fans, F.lit(0.0), lambda s, v: s + v))


def box_area(lon_min: Column, lon_max: Column, lat_min: Column, lat_max: Column) -> Column:
    """GRD-13. L'Huilier area of a lat-lon cell with great-circle edges: two triangles."""
    sw, se, ne, nw = (lon_min, lat_min), (lon_max, lat_min), (lon_max, lat_max), (lon_min, lat_max)
    return triangle_area(sw, se, ne) + triangle_area(sw, ne, nw)


def feature_area(parts: DataFrame, feature: str = "feature_id", ring: str = "ring") -> DataFrame:
    """GRD-14. Area of each multi-part feature: the sum over its parts."""
    return parts.groupBy(feature).agg(F.sum(ring_area(F.col(ring))).alias("area_m2"))


def with_cell_area(cells: DataFrame) -> DataFrame:
    """GRD-15. Cells with their area as cell_area_m2."""
    return cells.withColumn("cell_area_m2", box_area(F.col("lon_min"), F.col("lon_max"), F.col("lat_min"), F.col("lat_max")))


def equal_area_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """GRD-16. Equal-area plane: x = R * lon, y = R * sin(lat); longitudes are not wrapped."""
    return EARTH_RADIUS_M * F.radians(lon), EARTH_RADIUS_M * F.sin(F.radians(lat))


def expand(field: DataFrame, n: int, n_row: int, n_col: int) -> DataFrame:
    """GRD-17. The field on a grid with ``n`` more cells at each border; new cells have no rows.

    ``fid`` is renumbered on the larger grid.
    """
    row, col = F.floor(F.col("fid") / n_col), F.col("fid") % n_col
    return field.withColumn("fid", ((row + n) * (n_col + 2 * n) + col + n).cast("long"))


def contract(field: DataFrame, n: int, n_row: int, n_col: int) -> DataFrame:
    """GRD-18. The field without ``n`` cells at each border, ``fid`` renumbered."""
    if min(n_row, n_col) <= 2 * n:
        raise ValueError("at least one cell must remain")
    row, col = F.floor(F.col("fid") / n_col), F.col("fid") % n_col
    inside = row.between(n, n_row - 1 - n) & col.between(n, n_col - 1 - n)
    return field.where(inside).withColumn("fid", ((row - n) * (n_col - 2 * n) + col - n).cast("long"))


def bbox(points: DataFrame, *by: str) -> DataFrame:
    """GRD-19. Bounding box of lat and lon."""
    return points.groupBy(*by).agg(F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"))
