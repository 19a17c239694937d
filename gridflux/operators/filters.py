"""Selection on the axes of a field (FLT): columns variable, ts, fid, value and, where given, lev."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_value(axis: DataFrame, column: str, limit: float | str) -> DataFrame:
    """The axis value nearest to a limit, the lower one of two, as a one-row table (``near``)."""
    at = F.lit(limit).cast(dict(axis.dtypes)[column])
    gap = F.abs(F.unix_micros(column) - F.unix_micros(at)) if dict(axis.dtypes)[column] == "timestamp" else F.abs(F.col(column) - at)
    return axis.agg(F.min_by(column, F.struct(gap, F.col(column))).alias("near"))


def select_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """FLT-01. Rows between the axis values nearest to the limits, both included."""
    for limit, beyond in ((low, lambda c, n: c >= n), (high, lambda c, n: c <= n)):
        if limit is not None:
            near = nearest_value(df.select(column), column, limit)
            df = df.join(F.broadcast(near), beyond(F.col(column), F.col("near"))).drop("near")  # one row
    return df


def select_hours(df: DataFrame, from_start: int = 0, from_end: int = 0) -> DataFrame:
    """FLT-01, FLT-05. Without the first and the last hours of the time axis."""
    ends = df.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    inside = (F.col("ts") >= F.timestamp_add("HOUR", F.lit(from_start), "first_ts")) & (F.col("ts") <= F.timestamp_add("HOUR", F.lit(-from_end), "last_ts"))
    return df.join(F.broadcast(ends), inside).drop("first_ts", "last_ts")  # one row


def select_time(df: DataFrame, ts: str) -> DataFrame:
    """FLT-02. One time step; a missing one is an error."""
    found = df.where(F.col("ts") == F.lit(ts).cast("timestamp"))
    if found.isEmpty():
        raise ValueError(f"no time step {ts}")
    return found


def last_time_step(df: DataFrame) -> DataFrame:
    """FLT-03. The last step only, stamped with the first day's midnight."""
    ends = df.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return df.join(F.broadcast(ends), F.col("ts") == F.col("last_ts")).withColumn("ts", F.date_trunc("day", "first_ts")).drop("first_ts", "last_ts")


def keep_variables(df: DataFrame, names: list[str]) -> DataFrame:
    """FLT-04. The named variables only."""
    return df.where(F.col("variable").isin(names))


def drop_variables(df: DataFrame, names: list[str]) -> DataFrame:
    """FLT-04. All but the named variables."""
    return df.where(~F.col("variable").isin(names))


def signed_longitude(lon: Column) -> Column:
    """FLT-06. Longitude of 0..360 as -180..180."""
    lon = F.pmod(lon, F.lit(360.0))
    return F.when(lon > 180, lon - 360).otherwise(lon)


def reorder_longitudes(cells: DataFrame) -> DataFrame:
    """FLT-06, SRT-01. Cells with signed longitudes and columns numbered again from west to east.

    Only the axis is sorted; bounds that a column's turn would leave outside are cut at 180.
    """
    moved = cells.withColumn("lon", signed_longitude(F.col("lon")))
    axis = moved.select("lon").distinct().withColumn("new_col", F.row_number().over(Window.orderBy("lon")) - 1)
    return moved.join(F.broadcast(axis), "lon").drop("col_i").withColumnRenamed("new_col", "col_i")  # one row a column


def reverse_levels(df: DataFrame, lev: str = "lev") -> DataFrame:
    """FLT-07. Level order reversed."""
    top = df.agg(F.max(lev).alias("top_lev"))
    return df.join(F.broadcast(top)).withColumn(lev, F.col("top_lev") - F.col(lev)).drop("top_lev")


def to_type(df: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """FLT-08. The values as another type."""
    return df.withColumn(column, F.col(column).cast(kind))


def apply_mask(field: DataFrame, mask: DataFrame, inverse: bool = False) -> DataFrame:
    """FLT-09. Values times the mask of their cell, or times 1 - mask; ``outside`` marks a mask beyond
    0..1. A cell without mask keeps a row with a null value, so a check can count it."""
    m = mask.select("fid", F.col("mask").cast("double").alias("mask"))
    factor = 1 - F.col("mask") if inverse else F.col("mask")
    return field.join(m, "fid", "left").withColumns({"value": F.col("value") * factor, "outside": ~F.col("mask").between(0, 1)}).drop("mask")


def inside_bbox(points: DataFrame, box: DataFrame, buffer: float = 0.1) -> DataFrame:
    """FLT-10. Points within a one-row bounding box and its buffer."""
    b = F.broadcast(box.select(*[F.col(c).alias(f"b_{c}") for c in ("lon_min", "lon_max", "lat_min", "lat_max")]))
    near = F.col("lon").between(F.col("b_lon_min") - buffer, F.col("b_lon_max") + buffer) & F.col("lat").between(F.col("b_lat_min") - buffer, F.col("b_lat_max") + buffer)
    return points.join(b, near).select(*points.columns)


def parse_regions(text: str | None) -> list[str] | None:
    """FLT-11. Region list; None means all. ``ALL`` stands alone and ``OTHERS`` is reserved."""
    names = list(dict.fromkeys(n.strip() for n in (text or "").split(",") if n.strip()))
    upper = [n.upper() for n in names]
    if "OTHERS" in upper:
        raise ValueError("OTHERS is reserved")
    if "ALL" in upper and len(names) > 1:
        raise ValueError("ALL can't be combined")
    return None if not names or upper == ["ALL"] else names


def select_regions(totals: DataFrame, regions: list[str] | None, column: str = "region") -> DataFrame:
    """FLT-11. Totals of the listed regions; a region without totals is an error."""
    if regions is None:
        return totals
    found = totals.where(F.col(column).isin(regions))
    missing = sorted(set(regions) - {r[0] for r in found.select(column).distinct().collect()})
    if missing:
        raise ValueError(f"no totals for {missing}")
    return found


def positive_sources(df: DataFrame, pollutant: str, *key: str, value: str = "flux") -> DataFrame:
    """FLT-12. All rows of cells (or of what else ``key`` names) where the first pollutant is positive."""
    keys = list(key) or ["fid"]
    return df.join(df.where((F.col("pollutant") == pollutant) & (F.col(value) > 0)).select(*keys).distinct(), keys, "left_semi")


def restamp(df: DataFrame, mapping: DataFrame, column: str = "ts") -> DataFrame:
    """FLT-15. New axis values from a table (old, new); steps without one are dropped."""
    return df.join(mapping.select(F.col("old").alias(column), F.col("new").alias("_new")), column).withColumn(column, F.col("_new")).drop("_new")


def time_interval(df: DataFrame, *by: str) -> DataFrame:
    """FLT-15. Shortest step of each time axis in seconds."""
    w = Window.partitionBy(*by).orderBy("ts")
    steps = df.select(*by, "ts").distinct().withColumn("gap", F.unix_timestamp(F.lead("ts").over(w)) - F.unix_timestamp("ts"))
    return steps.groupBy(*by).agg(F.min("gap").alias("interval_s"))


def across_seam(lon: Column, west: float, east: float) -> Column:
    """FLT-16. Longitudes of 0..360 between a western limit, negative across the seam, and an eastern one."""
    return (lon >= west + 360) | (lon <= east) if west < 0 else lon.between(west, east)


def union_first(*fields: DataFrame) -> DataFrame:
    """SET-01, SRC-02. Union of datasets; a variable comes from the first that has it."""

    def add(done: DataFrame, more: DataFrame) -> DataFrame:
        return done.unionByName(more.join(done.select("variable").distinct(), "variable", "left_anti").select(*done.columns))

    return reduce(add, fields)
