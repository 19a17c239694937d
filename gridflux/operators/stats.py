"""Aggregates and windows over fields (AGG, WIN): columns variable, ts, lev, fid, value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without_nan(value: str = "value") -> Column:
    """The value, null where it is NaN."""
    return F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))


def sum_inventories(*fields: DataFrame, keys: tuple[str, ...] = ("ts", "lev", "fid", "species")) -> DataFrame:
    """AGG-01. Sum of inventories for each key."""
    whole = reduce(lambda a, b: a.unionByName(b), fields)
    return whole.groupBy(*keys).agg(F.sum("value").alias("value"))


def totals(field: DataFrame, *by: str) -> DataFrame:
    """AGG-03. Total of each variable, NaN and null left out."""
    return field.groupBy("variable", *by).agg(F.coalesce(F.sum(without_nan()), F.lit(0.0)).alias("total"))


def extremes(field: DataFrame, *by: str) -> DataFrame:
    """AGG-04. Least and greatest value of each variable, NaN left out."""
    return field.groupBy("variable", *by).agg(F.min(without_nan()).alias("min_value"), F.max(without_nan()).alias("max_value"))


def statistic(op: str, value: str = "value") -> Column:
    """mean, max or min, which a NaN makes NaN, or their nan- forms, which leave NaN out."""
    plain = {"mean": F.avg, "max": F.max, "min": F.min}[op.removeprefix("nan")]
    if op.startswith("nan"):
        return plain(without_nan(value))
    return F.when(F.coalesce(F.bool_or(F.isnan(value)), F.lit(False)), F.lit(float("nan"))).otherwise(plain(without_nan(value)))


def daily_statistic(field: DataFrame, op: str = "mean", mode: str = "calendar", keys: tuple[str, ...] = ("variable", "fid")) -> DataFrame:
    """AGG-05, AGG-06, AGG-07. Statistic of each calendar day (days of one step dropped; by the full
    date), of all steps (``alltsteps``), or of all but the first (``withoutt0``)."""
    if mode == "calendar":
        steps = field.withColumn("day", F.to_date("ts"))
        full = steps.groupBy("day").agg(F.count_distinct("ts").alias("n")).where("n > 1").select("day")
        return steps.join(full, "day", "left_semi").groupBy("day", *keys).agg(statistic(op).alias("value"))
    if mode == "withoutt0":
        first = field.agg(F.min("ts").alias("first_ts"))
        field = field.join(F.broadcast(first), F.col("ts") > F.col("first_ts")).drop("first_ts")  # one row
    elif mode != "alltsteps":
        raise ValueError(f"unknown mode {mode}")
    return field.groupBy(*keys).agg(statistic(op).alias("value"))


def sum_axis(field: DataFrame, axis: str) -> DataFrame:
    """AGG-08. Sum over an axis, whose coordinate becomes its first value."""
    others = [c for c in field.columns if c not in (axis, "value")]
    return field.groupBy(*others).agg(F.sum("value").alias("value"), F.min(axis).alias(axis))


def monthly_sum(field: DataFrame, *by: str, value: str = "value") -> DataFrame:
    """AGG-12. Monthly sums of daily values."""
    return field.groupBy(F.month("ts").alias("month_i"), *by).agg(F.sum(value).alias(value))


def add_fields(*fields: DataFrame) -> DataFrame:
    """AGG-15. Union of variables; shared ones are summed, null counts as 0."""
    whole = reduce(lambda a, b: a.unionByName(b), fields)
    keys = [c for c in whole.columns if c != "value"]
    return whole.groupBy(*keys).agg(F.sum(F.coalesce("value", F.lit(0.0))).alias("value"))


def rolling_mean(field: DataFrame, hours: int = 8, keys: tuple[str, ...] = ("variable", "fid"), include_current: bool = False) -> DataFrame:
    """WIN-01. Mean over the hours - 1 steps before each step, itself left out unless asked for; null
    unless the step of hours - 1 before exists."""
    second = F.unix_timestamp("ts")
    w = Window.partitionBy(*keys).orderBy(second)
    back = w.rangeBetween(-(hours - 1) * 3600, 0 if include_current else -1)
    there = F.min(F.unix_timestamp("ts")).over(back) == second - (hours - 1) * 3600
    return field.withColumn("value", F.when(there, F.avg("value").over(back)))


def layer_thickness(levels: DataFrame, *by: str) -> DataFrame:
    """WIN-06. Thickness of each layer from its top."""
    return levels.withColumn("thickness", F.col("top") - F.lag("top", 1, 0.0).over(Window.partitionBy(*by).orderBy("lev")))


def layer_heights(levels: DataFrame, *by: str) -> DataFrame:
    """WIN-06, VRT-09. Top of each layer as the running sum of thickness."""
    return levels.withColumn("top", F.sum("thickness").over(Window.partitionBy(*by).orderBy("lev")))


def top_k(df: DataFrame, k: int, by: list[str], *order: Column) -> DataFrame:
    """SRT-03. The first k rows of each group, in an order that should leave no ties."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def number_contributions(weights: DataFrame) -> DataFrame:
    """WIN-04. Number of each contribution to its destination, from 0."""
    return weights.withColumn("number", F.row_number().over(Window.partitionBy("dst_fid").orderBy("src_fid")) - 1)


def grid_increment(points: DataFrame, column: str, *by: str, digits: int = 6) -> DataFrame:
    """WIN-09. Smallest positive spacing of the values of a column."""
    axis = points.select(*by, F.round(column, digits).alias(column)).distinct()
    gap = F.lead(column).over(Window.partitionBy(*by).orderBy(column)) - F.col(column)
    return axis.withColumn("gap", F.round(gap, digits)).where("gap > 0").groupBy(*by).agg(F.min("gap").alias("increment"))
