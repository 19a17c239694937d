"""End-to-end jobs, composed of operators into one lazy plan each (JOB)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.operators import checks, regrid, rescale, runlog, speciation, stats, temporal, units, vertical
from gridflux.operators.filters import positive_sources
from gridflux.operators.grid import box_area
from gridflux.operators.points import fire_flux, stack_flux
from gridflux.operators.regrid import RegularGrid
from gridflux.operators.roads import road_weights, to_roads
from gridflux.sources import sinks


def cell_areas(cells: DataFrame) -> DataFrame:
    """fid and area_m2: the areas that the cells bring along, else those of lat-lon boxes."""
    if "area_m2" in cells.columns:
        return cells.select("fid", "area_m2")
    return cells.select("fid", box_area(F.col("lon_min"), F.col("lon_max"), F.col("lat_min"), F.col("lat_max")).alias("area_m2"))


def area_inventory(flux: DataFrame, mask: DataFrame | None, src: DataFrame, dst: DataFrame, grid: RegularGrid, factors: DataFrame | None, regions: DataFrame | None, weights: DataFrame | None = None) -> DataFrame:
    """JOB-01, first half. Flux (inventory, sector, pollutant, fid, flux) masked, regridded by mass and
    rescaled; the row count stays that of the surface field. mask: fid, factor; factors: region_id,
    pollutant, factor."""
    if mask is not None:
        flux = flux.join(mask, "fid").withColumn("flux", F.col("flux") * F.col("factor")).drop("factor")
    w = weights if weights is not None else regrid.conservative_weights(src, grid)
    w = regrid.mass_to_flux(w, cell_areas(src), cell_areas(dst))
    out = regrid.apply_weights(flux, w, "inventory", "sector", "pollutant", value="flux")
    return out if factors is None else rescale.apply_by_region(out, regions, factors, "pollutant", value="flux")


def to_hours(flux: DataFrame, calendar: DataFrame, factor: Column, vfac: DataFrame | None, n_levels: int, molecular: dict[str, float], expressions: dict[str, str]) -> DataFrame:
    """JOB-01, second half: surface flux to ts, lev, fid, species, value. Species first, then hours, levels
    last; ``calendar`` holds a row for each cell and step with what ``factor`` uses."""
    surface = speciation.speciate(flux, molecular, expressions, ["inventory", "sector", "fid"]).where("value <> 0")
    timed = surface.join(calendar.select("fid", "ts", factor.alias("_t")), "fid").withColumn("value", F.col("value") * F.col("_t")).drop("_t")
    timed = timed.join(vfac, "sector", "left") if vfac is not None else timed.withColumn("vfac", F.lit(None).cast("array<double>"))  # a profile for each sector
    return stats.sum_inventories(vertical.to_levels(timed, n_levels).select("ts", "lev", "fid", "species", "value"))


def stack_inventory(points: DataFrame, grid: RegularGrid, dst: DataFrame, tops: list[float], calendar: DataFrame, factor: Column, molecular: dict[str, float], expressions: dict[str, str]) -> DataFrame:
    """JOB-02. Stacks as ts, lev, fid, species, value: flux of cells and levels, species, then the steps of
    ``calendar`` (a row for each cell and step)."""
    flux = speciation.speciate(stack_flux(points, grid, cell_areas(dst), tops), molecular, expressions, ["fid", "lev"]).where("value <> 0")
    timed = flux.join(calendar.select("fid", "ts", factor.alias("_t")), "fid")
    return timed.select("ts", "lev", "fid", "species", (F.col("value") * F.col("_t")).alias("value"))


def fire_inventory(fires: DataFrame, src: DataFrame, dst: DataFrame, grid: RegularGrid, tops: list[float], pollutant: str, approach: str = "uniform") -> DataFrame:
    """JOB-03, JOB-04. Fires (ts, src_fid, pollutant, flux, height) of each day or hour as flux of cells and
    levels at that step: only cells where the first pollutant is positive then."""
    burning = positive_sources(fires, pollutant, "ts", "src_fid")
    return fire_flux(burning, cell_areas(src), regrid.fire_cells(src, grid), cell_areas(dst), tops, approach, F.col("height"), "ts")


def kind_of(cross: DataFrame) -> Column:
    """The job of a cross table's row: area, stack, fire_daily or fire_hourly. Points of a daily or hourly
    frequency are fires, others stacks."""
    point = F.when(F.col("frequency").isin("daily", "hourly"), F.concat(F.lit("fire_"), "frequency")).otherwise("stack")
    return F.when(F.col("source_type") == "area", "area").when(F.col("source_type") == "point", point)


def combine(cross: DataFrame, jobs: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """JOB-05. All inventories of a cross table (active rows, one for each pollutant) as one plan: rows are
    dealt by source type and frequency, each kind's rows go to its job, and the jobs' emissions
    (ts, lev, fid, species, value) are summed. A row of an unknown kind, or of one without a job, is an error."""
    rows = cross.withColumn("kind", kind_of(cross))
    kinds = [r[0] for r in rows.select("kind").distinct().collect()]  # four at most
    if lost := sorted({str(k) for k in kinds} - set(jobs)):
        raise ValueError(f"no job for {lost}")
    return stats.sum_inventories(*[jobs[k](rows.where(F.col("kind") == k).drop("kind")) for k in sorted(kinds)])


def preprocess_gridded(table: DataFrame, renames: DataFrame, year: int) -> DataFrame:
    """JOB-06, JOB-07. Native monthly fields of a year under the engine's names (name, pollutant)."""
    mine = table.where(F.year("ts") == year).join(renames, "name").drop("name")
    return mine.withColumn("period", F.date_format("ts", "yyyyMM")).drop("ts")


def preprocess_shipping(daily: DataFrame, split: DataFrame, half: float = 0.05, input_is_mass: bool = True, area: Column | None = None) -> DataFrame:
    """JOB-08, SPC-04. Daily ship fields moved by half a cell, summed to months, VOC split by a table
    (pollutant, species, fr)."""
    moved = daily.withColumns({"lon": F.col("lon") - half, "lat": F.col("lat") + half})
    months = stats.monthly_sum(moved, "pollutant", "lon", "lat", value="flux")
    if input_is_mass and area is not None:
        months = months.withColumn("flux", F.col("flux") / area)
    return speciation.apply_split(months, split, ["pollutant"]).unionByName(months.join(split, "pollutant", "left_anti").withColumn("species", F.col("pollutant")))


def preprocess_table(rows: DataFrame, inc: float, unit: str, area: DataFrame, lon_0: float = -180.0, lat_0: float = -90.0) -> DataFrame:
    """JOB-09, JOB-10, JOB-12, AGG-11. Table rows (sector, pollutant, lon, lat, mass) summed to cells of a
    global grid and turned into flux; the nearest cell is taken by rounding."""
    n_col = round(360 / inc)
    row, col = F.round((F.col("lat") - lat_0 - inc / 2) / inc), F.round((F.col("lon") - lon_0 - inc / 2) / inc)
    cells = rows.withColumn("fid", (row * n_col + col).cast("long")).groupBy("sector", "pollutant", "fid").agg(F.sum("mass").alias("mass"))
    return cells.join(area, "fid").select("sector", "pollutant", "fid", units.mass_to_flux(F.col("mass"), unit, F.col("area_m2")).alias("flux"))


def preprocess_sectors(flux: DataFrame, renames: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """JOB-11, TMP-13. Yearly sector fields under the engine's names, to months by a gridded profile."""
    named = flux.join(renames, "sector").withColumn("sector", F.col("new_sector")).drop("new_sector")
    return named if profile is None else temporal.yearly_to_monthly(named, profile)


def preprocess_national(mass: DataFrame, sub_totals: DataFrame, species: DataFrame, unit: str = "kt") -> DataFrame:
    """JOB-13, JOB-14, AGG-13, SPC-05. Mass by cell (sector, fid, pollutant, mass, area_m2) shared among
    sub-sectors by their national totals and split by one factor for each species."""
    shares = speciation.sector_shares(sub_totals, "sector").select("sector", "sub_sector", "share")
    split = mass.join(shares, "sector").join(species.where("fr > 0"), "pollutant")
    return split.select("sub_sector", "species", "fid", units.mass_to_flux(F.col("mass") * F.col("share") * F.col("fr"), unit, F.col("area_m2")).alias("flux"))


def grid_to_roads(field: DataFrame, roads: DataFrame, grid: RegularGrid, units: dict[str, str] | None = None) -> DataFrame:
    """JOB-15. Level-0 field (pollutant, ts, lev, fid, value) on road links; ``units`` of the pollutants,
    where given, must be kilograms a second."""
    checks.need_mass_rates(units or {})
    return to_roads(field.where("lev = 0"), road_weights(roads, grid), "pollutant", "ts")


def interpolate(field: DataFrame, src: DataFrame, grid: RegularGrid | None = None, stations: DataFrame | None = None, *by: str) -> DataFrame:
    """JOB-16, JON-25. A dataset on another grid (conservative) or, at the surface only, at stations (four nearest)."""
    if stations is not None:
        if "lev" in by:
            raise ValueError("stations take one level")
        w = regrid.nearest_neighbours(src, stations.select(F.col("station").alias("fid"), "lon", "lat")).select("src_fid", "dst_fid", "weight")
        held = sinks.stored(field.join(src.select("fid"), "fid", "left_semi"), "field")
        field = F.broadcast(held) if sinks.is_small(held) else held  # a station's weights then stay together for its sum
    else:
        w = regrid.conservative_weights(src, grid)
    return regrid.apply_weights(field, w, *by)


def interpolate_levels(field: DataFrame, heights: DataFrame, new: list[float], by: list[str], kind: str = "linear", below: str | float | None = None, above: str | float | None = None) -> DataFrame:
    """JOB-16. A field (by, lev, value) at new heights: lev, value. ``heights`` are (lev, height) for all columns, or
    differ by the columns of ``by`` that they carry. Splines for the kinds of ``vertical.DEGREES``."""
    keys = [c for c in by if c in heights.columns] + ["lev"]
    tall = field.join(heights.select(*keys, "height"), keys)
    columns = vertical.gathered(tall, *by)
    if kind in vertical.DEGREES:
        return vertical.interpolate_spline(columns, new, by, kind, below, above)
    return vertical.interpolate_linear(columns, new, kind, below, above).select(*by, "lev", "value")


def analyse_log(log: DataFrame, names: DataFrame, method: str = "iqr") -> DataFrame:
    """JOB-17. Timers under their present names, outliers left out, and the mean of replications with its
    speed-up and efficiency for each process count."""
    kept = runlog.aggregate_replications(runlog.inliers(runlog.map_legacy(log, names), method))
    return runlog.speedup(kept, *runlog.TIMER)
