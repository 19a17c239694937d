"""Regridding: weight tables (src_fid, dst_fid, weight) and their use (JON-04 to JON-16, JON-25).

Two kinds of grids: ``RegularGrid`` in longitude and latitude, and ``ProjectedGrid`` in the coordinates of a
projection. Either finds the cells that a ring's bounds reach by index arithmetic in its own
coordinates, so no join is needed to find overlapping cells.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridflux.operators import grid as grids
from gridflux.operators import polygons
from gridflux.operators.grid import EARTH_RADIUS_M, equal_area_xy, wrap_longitude
from gridflux.operators.nearest import candidates


@dataclass(frozen=True)
class RegularGrid:
    """Regular lat-lon grid by its south-west corner, steps and counts."""

    lat_orig: float
    lon_orig: float
    inc_lat: float
    inc_lon: float
    n_lat: int
    n_lon: int

    def owner(self, lon: Column, lat: Column) -> Column:
        """JON-07. The one cell of a point: lower edges belong to it, and the grid's upper edges too."""

        def index(v: Column, orig: float, inc: float, n: int) -> Column:
            return F.when(v == orig + n * inc, n - 1).otherwise(F.floor((v - orig) / inc))

        row, col = index(lat, self.lat_orig, self.inc_lat, self.n_lat), index(lon, self.lon_orig, self.inc_lon, self.n_lon)
        return F.when(row.between(0, self.n_lat - 1) & col.between(0, self.n_lon - 1), (row * self.n_lon + col).cast("long"))

    def reached(self, low: Column, high: Column, axis: str) -> Column:
        """Indexes along an axis that an interval overlaps, as an array."""
        orig, inc, n = (self.lat_orig, self.inc_lat, self.n_lat) if axis == "lat" else (self.lon_orig, self.inc_lon, self.n_lon)
        first, last = F.greatest(F.floor((low - orig) / inc), F.lit(0)), F.least(F.ceil((high - orig) / inc) - 1, F.lit(n - 1))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def windows(self, rows: DataFrame, name: str) -> DataFrame:
        """Each row with ``ring`` (longitude, latitude) once for every cell that its bounds reach: the cell as
        ``name`` and its ring as ``window``. Longitudes are not wrapped: what lies beyond the grid has no cell."""
        b = polygons.with_bounds(rows)
        b = b.withColumn("_row", F.explode(self.reached(F.col("ymin"), F.col("ymax"), "lat"))).withColumn("_col", F.explode(self.reached(F.col("xmin"), F.col("xmax"), "lon")))
        x, y = self.lon_orig + F.col("_col") * self.inc_lon, self.lat_orig + F.col("_row") * self.inc_lat
        cell = {name: (F.col("_row") * self.n_lon + F.col("_col")).cast("long"), "window": polygons.box(x, x + self.inc_lon, y, y + self.inc_lat)}
        return b.withColumns(cell).drop("_row", "_col", "xmin", "xmax", "ymin", "ymax")


@dataclass(frozen=True)
class ProjectedGrid:
    """Regular grid in projected coordinates, by its south-west edge, steps and counts. A cell is the
    quadrilateral between its four corners' longitudes and latitudes."""

    x_orig: float
    y_orig: float
    inc_x: float
    inc_y: float
    n_x: int
    n_y: int
    to_lonlat: Callable[[Column, Column], tuple[Column, Column]]
    from_lonlat: Callable[[Column, Column], tuple[Column, Column]]

    @staticmethod
    def rotated(centre_lat: float, centre_lon: float, west: float, south: float, inc_rlat: float, inc_rlon: float) -> ProjectedGrid:
        """GRD-04. Rotated pole: ``west`` and ``south`` are the first centres, as many cells on both sides of 0."""
        n_y, n_x = int(abs(south) / inc_rlat * 2 + 1), int(abs(west) / inc_rlon * 2 + 1)
        there, back = (lambda x, y: grids.rotated_to_lonlat(x, y, centre_lon, centre_lat)), (lambda x, y: grids.lonlat_to_rotated(x, y, centre_lon, centre_lat))
        return ProjectedGrid(west - inc_rlon / 2, south - inc_rlat / 2, inc_rlon, inc_rlat, n_x, n_y, there, back)

    @staticmethod
    def lambert(lat_1: float, lat_2: float, lat_0: float, lon_0: float, n_x: int, n_y: int, inc_x: float, inc_y: float, x_0: float, y_0: float) -> ProjectedGrid:
        """GRD-06. Lambert conformal conic."""
        there, back = (lambda x, y: grids.lcc_to_lonlat(x, y, lat_1, lat_2, lat_0, lon_0)), (lambda x, y: grids.lonlat_to_lcc(x, y, lat_1, lat_2, lat_0, lon_0))
        return ProjectedGrid(x_0, y_0, inc_x, inc_y, n_x, n_y, there, back)

    @staticmethod
    def mercator(lat_ts: float, lon_0: float, n_x: int, n_y: int, inc_x: float, inc_y: float, x_0: float, y_0: float) -> ProjectedGrid:
        """GRD-07. Mercator."""
        there, back = (lambda x, y: grids.mercator_to_lonlat(x, y, lat_ts, lon_0)), (lambda x, y: grids.lonlat_to_mercator(x, y, lat_ts, lon_0))
        return ProjectedGrid(x_0, y_0, inc_x, inc_y, n_x, n_y, there, back)

    @staticmethod
    def azimuthal(lat_0: float, lon_0: float, n_x: int, n_y: int, inc_x: float, inc_y: float, x_0: float, y_0: float) -> ProjectedGrid:
        """GRD-08. Lambert azimuthal equal-area."""
        there, back = (lambda x, y: grids.laea_to_lonlat(x, y, lat_0, lon_0)), (lambda x, y: grids.lonlat_to_laea(x, y, lat_0, lon_0))
        return ProjectedGrid(x_0, y_0, inc_x, inc_y, n_x, n_y, there, back)

    def cells(self, spark: SparkSession) -> DataFrame:
        return grids.projected_cells(spark, self.n_x, self.n_y, self.inc_x, self.inc_y, self.x_orig, self.y_orig, self.to_lonlat)

    def owner(self, lon: Column, lat: Column) -> Column:
        """JON-07. The one cell of a point, half-open in the grid's own coordinates."""
        x, y = self.from_lonlat(lon, lat)
        col, row = F.floor((x - self.x_orig) / self.inc_x), F.floor((y - self.y_orig) / self.inc_y)
        return F.when(row.between(0, self.n_y - 1) & col.between(0, self.n_x - 1), (row * self.n_x + col).cast("long"))

    def windows(self, rows: DataFrame, name: str) -> DataFrame:
        """As ``RegularGrid.windows``. A ring's edges may bend in the grid's coordinates: bounds are taken over
        eight points of each edge, and widened by a cell and a sixteenth of their span. A window's
        longitudes go on from the ring's, so rings and cells meet across the seam. Rings that hold a
        pole of the projection aren't found there, corners at infinity don't count for the bounds."""
        n = F.size("ring")
        along = F.transform(F.sequence(F.lit(0), n * 8 - 1), lambda i: F.struct(_between(i, "x", n).alias("x"), _between(i, "y", n).alias("y")))
        native = F.transform("_edge", lambda p: F.struct(*(c.alias(a) for a, c in zip("xy", self.from_lonlat(p["x"], p["y"])))))
        b = rows.withColumn("_edge", along).withColumn("_edge", native)
        b = b.withColumn("_col", F.explode(_span("x", self.x_orig, self.inc_x, self.n_x))).withColumn("_row", F.explode(_span("y", self.y_orig, self.inc_y, self.n_y)))
        x, y = self.x_orig + (F.col("_col") + 0.5) * self.inc_x, self.y_orig + (F.col("_row") + 0.5) * self.inc_y
        ring = grids.corner_ring(x, y, self.inc_x, self.inc_y, self.to_lonlat)
        near, corner = F.element_at("ring", 1)["x"], F.element_at(ring, 1)["x"]
        window = F.transform(ring, lambda p: F.struct((near + wrap_longitude(corner - near) + wrap_longitude(p["x"] - corner)).alias("x"), p["y"].alias("y")))
        return b.withColumns({name: (F.col("_row") * self.n_x + F.col("_col")).cast("long"), "window": window}).drop("_edge", "_row", "_col")


def _between(i: Column, axis: str, n: Column) -> Column:
    """A coordinate of the i-th of eight points on each edge of ``ring``."""
    a, b = F.get("ring", F.floor(i / 8).cast("int"))[axis], F.get("ring", ((F.floor(i / 8) + 1) % n).cast("int"))[axis]
    return a + (b - a) * (i % 8) / 8


def _span(axis: str, orig: float, inc: float, n: int) -> Column:
    """Indexes that ``_edge`` reaches along an axis; what can't be projected reaches all."""
    v = F.transform("_edge", lambda p: F.when(F.isnan(p[axis]), None).otherwise(p[axis]))
    low, high = (F.array_min(v) - orig) / inc, (F.array_max(v) - orig) / inc
    wide = 1 + (high - low) / 16
    clamp = lambda c, other: F.when(c.isNull() | F.isnan(c), F.lit(other)).otherwise(F.least(F.greatest(c, F.lit(-1.0)), F.lit(float(n)))).cast("long")
    first, last = F.greatest(clamp(F.floor(low - wide), 0), F.lit(0)), F.least(clamp(F.floor(high + wide), n - 1), F.lit(n - 1))
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def equal_area_ring(ring: str | Column) -> Column:
    """A ring of longitudes and latitudes in the equal-area plane."""
    return F.transform(ring, lambda p: F.struct(*(c.alias(a) for a, c in zip("xy", equal_area_xy(p["x"], p["y"])))))


def lonlat_ring(ring: str | Column) -> Column:
    """A ring of the equal-area plane in longitude and latitude."""
    up = lambda p: F.degrees(F.asin(F.least(F.greatest(p["y"] / EARTH_RADIUS_M, F.lit(-1.0)), F.lit(1.0))))
    return F.transform(ring, lambda p: F.struct(F.degrees(p["x"] / EARTH_RADIUS_M).alias("x"), up(p).alias("y")))


def within_cells(rows: DataFrame, grid: RegularGrid | ProjectedGrid, name: str, area: str, whole: str | None = None) -> DataFrame:
    """Rows with ``ring`` (longitude, latitude) cut along a grid: a row for each cell with some of its area,
    which is taken in the equal-area plane; ``ring`` is what lies within the cell."""
    pairs = grid.windows(rows, name).withColumns({"ring": equal_area_ring("ring"), "window": equal_area_ring("window")})
    return polygons.clipped(pairs, area=area, whole=whole).where(F.col(area) > 0).withColumn("ring", lonlat_ring("ring"))


def overlap_weights(src: DataFrame, grid: RegularGrid | ProjectedGrid) -> DataFrame:
    """JON-04, for cells or targets of any shape: share of each source cell's area in each destination cell,
    in the equal-area plane. src: fid and ring, or a lat-lon box."""
    c = F.col
    ring = c("ring") if "ring" in src.columns else polygons.box(c("lon_min"), c("lon_max"), c("lat_min"), c("lat_max"))
    parts = within_cells(src.select(c("fid").alias("src_fid"), ring.alias("ring")), grid, "dst_fid", "area", "whole")
    return parts.select("src_fid", "dst_fid", (c("area") / c("whole")).alias("weight")).where("weight > 1e-12")


def polygons_proxy(layer: DataFrame, src: RegularGrid | ProjectedGrid, dst: RegularGrid | ProjectedGrid, weight: str = "weight") -> DataFrame:
    """JON-12, WIN-02. Weights from polygons (signed rings with a weight): within a source cell its mass is
    dealt by weight * equal-area size of the parts there, each part by area among the destination cells it
    reaches. What lies outside all destination cells is lost, as in the plain regrid."""
    rows = polygons.signed(layer).select("ring", "sign", F.col(weight).alias("_w")).where((F.col("_w") > 0) & ~F.isnan("_w") & (F.col("_w") != float("inf")))
    return _dealt(*_polygon_parts(rows, src, dst))


def _polygon_parts(rows: DataFrame, src, dst) -> tuple[DataFrame, DataFrame]:
    """Signed parts of polygons: by source cell, and by source and destination cell."""
    mine = within_cells(rows, src, "src_fid", "_a")
    by_src = mine.select("src_fid", (F.col("sign") * F.col("_w") * F.col("_a")).alias("part"))
    shared = within_cells(mine.drop("_a"), dst, "dst_fid", "_a")
    return by_src, shared.select("src_fid", "dst_fid", (F.col("sign") * F.col("_w") * F.col("_a")).alias("part"))


def _dealt(by_src: DataFrame, shared: DataFrame) -> DataFrame:
    """Parts of source and destination cells over all parts of the source cell."""
    total = by_src.groupBy("src_fid").agg(F.sum("part").alias("total")).where("total > 0")
    pairs = shared.groupBy("src_fid", "dst_fid").agg(F.sum("part").alias("part"))
    return pairs.join(total, "src_fid").select("src_fid", "dst_fid", (F.col("part") / F.col("total")).alias("weight")).where("weight > 1e-12")


def owned_points(points: DataFrame, grid: RegularGrid, name: str = "fid") -> DataFrame:
    """JON-07, JON-08. Points with the cell that owns them; those outside get null."""
    return points.withColumn(name, grid.owner(F.col("lon"), F.col("lat")))


def fire_cells(cells: DataFrame, grid: RegularGrid) -> DataFrame:
    """JON-09. Destination cell of each fire cell's centre, one row for each source cell; null outside."""
    return cells.select(F.col("fid").alias("src_fid"), grid.owner(F.col("lon"), F.col("lat")).alias("dst_fid")).dropDuplicates(["src_fid"])


def conservative_weights(src: DataFrame, grid: RegularGrid) -> DataFrame:
    """JON-04. Share of each source cell's area in each destination cell, in the equal-area plane.

    Lat-lon cells overlap axis by axis, so each axis is joined by index arithmetic on its own few
    intervals and the cells meet their two axes by equality.
    """

    def axis(low: str, high: str, name: str, orig: float, inc: float, measure) -> DataFrame:
        parts = src.select(low, high).distinct().select(low, high, F.explode(grid.reached(F.col(low), F.col(high), name)).alias(f"{name}_at"))
        a, b = orig + F.col(f"{name}_at") * inc, orig + (F.col(f"{name}_at") + 1) * inc
        shared = measure(F.least(F.col(high), b)) - measure(F.greatest(F.col(low), a))
        return parts.withColumn(f"{name}_share", shared / (measure(F.col(high)) - measure(F.col(low)))).where(f"{name}_share > 0")

    x = axis("lon_min", "lon_max", "lon", grid.lon_orig, grid.inc_lon, lambda v: v)
    y = axis("lat_min", "lat_max", "lat", grid.lat_orig, grid.inc_lat, lambda v: F.sin(F.radians(v)))
    pairs = src.select("fid", "lon_min", "lon_max", "lat_min", "lat_max").join(x, ["lon_min", "lon_max"]).join(y, ["lat_min", "lat_max"])
    return pairs.select(F.col("fid").alias("src_fid"), (F.col("lat_at") * grid.n_lon + F.col("lon_at")).cast("long").alias("dst_fid"), (F.col("lon_share") * F.col("lat_share")).alias("weight"))


def apply_weights(field: DataFrame, weights: DataFrame, *by: str, value: str = "value", keep_nan: bool = False) -> DataFrame:
    """JON-05. Sum of weight * value for each destination cell; NaN is left out unless kept."""
    v = F.col(value) if keep_nan else F.nanvl(F.col(value), F.lit(None).cast("double"))
    joined = field.withColumnRenamed("fid", "src_fid").join(weights, "src_fid")
    return joined.groupBy(*by, F.col("dst_fid").alias("fid")).agg(F.sum(v * F.col("weight")).alias(value))


def mass_to_flux(weights: DataFrame, src_area: DataFrame, dst_area: DataFrame) -> DataFrame:
    """JON-16. Weights for values per area: weight * source area / destination area."""
    s = src_area.select(F.col("fid").alias("src_fid"), F.col("area_m2").alias("src_area"))
    d = dst_area.select(F.col("fid").alias("dst_fid"), F.col("area_m2").alias("dst_area"))
    return weights.join(s, "src_fid").join(d, "dst_fid").select("src_fid", "dst_fid", (F.col("weight") * F.col("src_area") / F.col("dst_area")).alias("weight"))


def normalise_parts(parts: DataFrame, key: str = "src_fid", value: str = "part") -> DataFrame:
    """WIN-02. Each part over the sum of its source cell's parts, as weight."""
    total = parts.groupBy(key).agg(F.sum(value).alias("_total")).where("_total > 0")
    return parts.join(total, key).withColumn("weight", F.col(value) / F.col("_total")).drop("_total")


def points_proxy(points: DataFrame, src: RegularGrid, dst: RegularGrid, weight: str = "weight") -> DataFrame:
    """JON-10. Weights from points; SRC-17: weights must be positive and finite."""
    used = points.where((F.col(weight) > 0) & ~F.isnan(weight) & (F.col(weight) != float("inf")))
    owned = used.select(src.owner(F.col("lon"), F.col("lat")).alias("src_fid"), dst.owner(F.col("lon"), F.col("lat")).alias("dst_fid"), F.col(weight).alias("part"))
    parts = owned.where("src_fid IS NOT NULL AND dst_fid IS NOT NULL").groupBy("src_fid", "dst_fid").agg(F.sum("part").alias("part"))
    return normalise_parts(parts).select("src_fid", "dst_fid", "weight")


def read_proxy(layer: DataFrame, weight: str | None = None) -> DataFrame:
    """SRC-17. Vector proxy with a weight column, 1.0 where the layer has none; null, NaN, infinite and
    non-positive weights are dropped."""
    w = F.col(weight).cast("double") if weight and weight in layer.columns else F.lit(1.0)
    return layer.withColumn("weight", w).where((F.col("weight") > 0) & ~F.isnan("weight") & (F.col("weight") != float("inf")))


def raster_pixels(raster: DataFrame, x0: float, y0: float, dx: float, dy: float, nodata: float | None = None, categories: list | None = None) -> DataFrame:
    """SRC-18, SRC-19. Pixels (row, col, value) as rectangles with a value; with categories each kept
    pixel counts 1, without only positive finite values stay."""
    px = raster if nodata is None else raster.where(F.col("value") != nodata)
    if categories is not None:
        px = px.where(F.col("value").isin(categories)).withColumn("value", F.lit(1.0))
    px = px.where((F.col("value") > 0) & ~F.isnan("value") & (F.col("value") != float("inf")))
    x, y = x0 + F.col("col") * dx, y0 + F.col("row") * dy
    return px.select(F.col("value").cast("double").alias("value"), F.least(x, x + dx).alias("lon_min"), F.greatest(x, x + dx).alias("lon_max"), F.least(y, y + dy).alias("lat_min"), F.greatest(y, y + dy).alias("lat_max"))


def masked_raster(numbers: DataFrame, kinds: DataFrame, categories: list) -> DataFrame:
    """SRC-20. Numeric pixels of one grid whose category on the same grid is kept."""
    return numbers.join(kinds.where(F.col("value").isin(categories)).select("row", "col"), ["row", "col"], "left_semi")


def raster_proxy(pixels: DataFrame, src: RegularGrid, dst: RegularGrid) -> DataFrame:
    """JON-14. Weights from pixel values, shared by the area of each pixel within both cells."""
    cut = _cut_boxes(_cut_boxes(pixels.withColumnRenamed("value", "part"), src, "src_fid", "part"), dst, "dst_fid", "part")
    parts = cut.groupBy("src_fid", "dst_fid").agg(F.sum("part").alias("part"))
    return normalise_parts(parts).select("src_fid", "dst_fid", "weight")


def _cut_boxes(boxes: DataFrame, grid: RegularGrid, name: str, part: str) -> DataFrame:
    """Boxes cut along a grid; each piece keeps its share of ``part`` by equal-area size."""
    s = lambda c: F.sin(F.radians(c))
    cut = boxes.withColumn("_row", F.explode(grid.reached(F.col("lat_min"), F.col("lat_max"), "lat"))).withColumn("_col", F.explode(grid.reached(F.col("lon_min"), F.col("lon_max"), "lon")))
    low_x, low_y = F.greatest("lon_min", grid.lon_orig + F.col("_col") * grid.inc_lon), F.greatest("lat_min", grid.lat_orig + F.col("_row") * grid.inc_lat)
    high_x, high_y = F.least("lon_max", grid.lon_orig + (F.col("_col") + 1) * grid.inc_lon), F.least("lat_max", grid.lat_orig + (F.col("_row") + 1) * grid.inc_lat)
    share = (high_x - low_x) * (s(high_y) - s(low_y)) / ((F.col("lon_max") - F.col("lon_min")) * (s(F.col("lat_max")) - s(F.col("lat_min"))))
    new = {part: F.col(part) * share, name: (F.col("_row") * grid.n_lon + F.col("_col")).cast("long"), "lon_min": low_x, "lon_max": high_x, "lat_min": low_y, "lat_max": high_y}
    return cut.withColumns(new).drop("_row", "_col").where(F.col(part) > 0)


def haversine_m(lon_1: Column, lat_1: Column, lon_2: Column, lat_2: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat_2 - lat_1) / 2), F.lit(2)) + F.cos(F.radians(lat_1)) * F.cos(F.radians(lat_2)) * F.pow(F.sin(F.radians(lon_2 - lon_1) / 2), F.lit(2))
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def segments(lines: DataFrame) -> DataFrame:
    """Straight pieces x1, y1, x2, y2 of lines (line: array of (x, y)), with the other columns."""
    pairs = F.zip_with(F.slice("line", F.lit(1), F.size("line") - 1), F.slice("line", F.lit(2), F.size("line") - 1), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    return lines.where(F.size("line") > 1).withColumn("_s", F.explode(pairs)).select(*[c for c in lines.columns if c != "line"], "_s.*")


def cut_segments(parts: DataFrame, grid: RegularGrid, name: str) -> DataFrame:
    """Segments clipped to the grid's cells (Liang-Barsky as columns); each piece has its cell as ``name``."""
    cut = parts.withColumn("_row", F.explode(grid.reached(F.least("y1", "y2"), F.greatest("y1", "y2") + 1e-12, "lat"))).withColumn("_col", F.explode(grid.reached(F.least("x1", "x2"), F.greatest("x1", "x2") + 1e-12, "lon")))

    def span(a: str, b: str, low: Column, high: Column) -> tuple[Column, Column]:
        d = F.col(b) - F.col(a)
        t, u = F.try_divide(low - F.col(a), d), F.try_divide(high - F.col(a), d)
        inside = (F.col(a) >= low) & (F.col(a) < high)
        return F.when(d != 0, F.least(t, u)).when(inside, F.lit(0.0)).otherwise(2.0), F.when(d != 0, F.greatest(t, u)).when(inside, F.lit(1.0)).otherwise(-1.0)

    tx = span("x1", "x2", grid.lon_orig + F.col("_col") * grid.inc_lon, grid.lon_orig + (F.col("_col") + 1) * grid.inc_lon)
    ty = span("y1", "y2", grid.lat_orig + F.col("_row") * grid.inc_lat, grid.lat_orig + (F.col("_row") + 1) * grid.inc_lat)
    cut = cut.withColumns({"_t": F.greatest(tx[0], ty[0], F.lit(0.0)), "_u": F.least(tx[1], ty[1], F.lit(1.0))}).where("_u - _t > 1e-12")  # not what rounding leaves where a line meets a corner
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    new = {c: F.col(a) + F.col(t) * d for c, a, t, d in (("x1", "x1", "_t", dx), ("y1", "y1", "_t", dy), ("x2", "x1", "_u", dx), ("y2", "y1", "_u", dy))}
    return cut.withColumns(new | {name: (F.col("_row") * grid.n_lon + F.col("_col")).cast("long")}).drop("_row", "_col", "_t", "_u")


def lines_proxy(lines: DataFrame, src: RegularGrid, dst: RegularGrid, weight: str = "weight") -> DataFrame:
    """JON-11, WIN-03. Weights from the geodesic length of lines within both cells.

    Pieces are cut half-open, so a line along a border counts once and the matched length never
    exceeds the whole.
    """
    pieces = cut_segments(cut_segments(segments(lines), src, "src_fid"), dst, "dst_fid")
    length = haversine_m(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    parts = pieces.groupBy("src_fid", "dst_fid").agg(F.sum(F.col(weight) * length).alias("part"))
    return normalise_parts(parts).select("src_fid", "dst_fid", "weight")


def planar_length(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def mixed_proxy(points: DataFrame, lines: DataFrame, layer: DataFrame, src: RegularGrid, dst: RegularGrid) -> DataFrame:
    """JON-13. One pool of points (weight), lines (weight * planar length) and polygons (weight * planar area
    of the signed rings), all in degrees: lines and areas of one plane count against each other."""
    p = points.select(src.owner(F.col("lon"), F.col("lat")).alias("src_fid"), dst.owner(F.col("lon"), F.col("lat")).alias("dst_fid"), F.col("weight").alias("part"))
    pieces = cut_segments(cut_segments(segments(lines), src, "src_fid"), dst, "dst_fid")
    ln = pieces.select("src_fid", "dst_fid", (F.col("weight") * planar_length(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))).alias("part"))
    rings = polygons.signed(layer).select("ring", "sign", "weight")
    mine = polygons.clipped(src.windows(rings, "src_fid"), area="_a").where("_a > 0").drop("_a")
    both = polygons.clipped(dst.windows(mine, "dst_fid"), area="_a").where("_a > 0")
    pg = both.select("src_fid", "dst_fid", (F.col("sign") * F.col("weight") * F.col("_a")).alias("part"))
    parts = p.unionByName(ln).unionByName(pg).where("src_fid IS NOT NULL AND dst_fid IS NOT NULL").groupBy("src_fid", "dst_fid").agg(F.sum("part").alias("part"))
    return normalise_parts(parts.where("part > 0")).select("src_fid", "dst_fid", "weight")


def priority_weights(cells: DataFrame, proxies: list[DataFrame], grid: RegularGrid) -> DataFrame:
    """JON-15. Each source cell by the first proxy that covers it, the rest by plain area."""
    done, rest = None, cells
    for proxy in proxies:
        mine = proxy.join(rest.select(F.col("fid").alias("src_fid")), "src_fid", "left_semi")
        done = mine if done is None else done.unionByName(mine)
        rest = rest.join(proxy.select(F.col("src_fid").alias("fid")).distinct(), "fid", "left_anti")
    plain = conservative_weights(rest, grid)
    return plain if done is None else done.unionByName(plain)


def ecef(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Geocentric coordinates in metres on the WGS84 ellipsoid (fixed values of its axis and flattening)."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    phi, lam = F.radians(lat), F.radians(lon)
    n = a / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    return n * F.cos(phi) * F.cos(lam), n * F.cos(phi) * F.sin(lam), n * (1 - e2) * F.sin(phi)


def nearest_neighbours(src: DataFrame, dst: DataFrame, k: int = 4) -> DataFrame:
    """JON-06, WIN-07. The k nearest source points of each destination by chord distance, the lower id of
    equal ones, weights 1 / distance (at least 1 m) normalised to 1; src: fid, lon, lat; dst: fid, lon, lat.
    Candidates come from ``nearest.candidates`` in geocentric coordinates."""
    s = _with_ecef(src, "src_fid", "at_").withColumns({f"{e}_{a}": F.col(f"at_{a}") for e in ("lo", "hi") for a in "xyz"})
    near = candidates(_with_ecef(dst, "dst_fid", ""), s, "xyz", k, ["src_fid", "at_x", "at_y", "at_z"], least=1.0, together="dst_fid")
    gap = F.sqrt(sum(((F.col(f"at_{c}") - F.col(c)) * (F.col(f"at_{c}") - F.col(c)) for c in "xyz"), F.lit(0.0)))
    rank = F.row_number().over(Window.partitionBy("dst_fid").orderBy("distance", "src_fid"))
    best = near.select("src_fid", "dst_fid", F.greatest(gap, F.lit(1.0)).alias("distance")).withColumn("_rank", rank).where(F.col("_rank") <= k)
    inverse = 1 / F.col("distance")
    return best.select("src_fid", "dst_fid", "distance", (inverse / F.sum(inverse).over(Window.partitionBy("dst_fid"))).alias("weight"))


def _with_ecef(points: DataFrame, name: str, p: str) -> DataFrame:
    x, y, z = ecef(F.col("lon"), F.col("lat"))
    return points.select(F.col("fid").alias(name), x.alias(f"{p}x"), y.alias(f"{p}y"), z.alias(f"{p}z"))
