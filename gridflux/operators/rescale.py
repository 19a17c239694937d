"""Rescaling of emissions to regional totals (AGG-02, RSC, SRC-10, SRC-11, CHK-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def read_totals(table: DataFrame, keys: list[str], units: str = "units") -> DataFrame:
    """SRC-10. Wide totals as rows: keys, pollutant, total_kg; tonnes become kilograms."""
    pollutants = [c for c in table.columns if c not in (*keys, units)]
    rows = table.unpivot([*keys, units], pollutants, "pollutant", "total")
    return rows.select(*keys, "pollutant", F.when(F.col(units).startswith("t/"), F.col("total") * 1000).otherwise(F.col("total")).alias("total_kg"))


def pick_period(totals: DataFrame, keys: list[str], period: str) -> DataFrame:
    """SRC-11. Rows of the period where there are some, else of ``default``."""
    rank = F.when(F.col("period") == period, 0).when(F.col("period") == "default", 1)
    best = F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))
    return totals.withColumn("rank", rank).where("rank IS NOT NULL").withColumn("best", best).where("best = 1").drop("rank", "best")


def period_seconds(frequency: Column, year: Column, month: Column) -> Column:
    """RSC-05. Seconds of a year of 365 days, or of the month in the reference year."""
    days = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.when(frequency == "yearly", F.lit(365)).when(frequency == "monthly", days) * SECONDS_PER_DAY


def inventory_totals(flux: DataFrame, area: DataFrame, regions: DataFrame, seconds: Column, *by: str, value: str = "flux") -> DataFrame:
    """AGG-02. Mass of each region and pollutant: sum of flux * area * seconds, NaN left out."""
    v = F.nanvl(F.col(value), F.lit(None).cast("double"))
    joined = flux.join(area.select("fid", "area_m2"), "fid").join(regions.select("fid", "region_id"), "fid")
    return joined.groupBy("region_id", *by).agg(F.sum(v * F.col("area_m2") * seconds).alias("inventory_kg"))


def factors(inventory: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """RSC-02. local / inventory: null (unchanged) without a local total, 0 where the inventory has none."""
    ratio = F.when(F.col("total_kg").isNull(), None).when(F.coalesce("inventory_kg", F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("total_kg"), F.col("inventory_kg")))
    return inventory.join(local, keys, "left").withColumn("factor", ratio)


def apply_by_region(flux: DataFrame, regions: DataFrame, factor: DataFrame, *by: str, value: str = "flux") -> DataFrame:
    """RSC-03. Flux times its region's factor; other cells stay."""
    f = factor.select("region_id", *by, "factor")
    joined = flux.join(regions.select("fid", "region_id"), "fid", "left").join(f, ["region_id", *by], "left")
    return joined.withColumn(value, F.col(value) * F.coalesce("factor", F.lit(1.0))).select(*flux.columns)


def apply_everywhere(flux: DataFrame, factor: DataFrame, *by: str, value: str = "flux") -> DataFrame:
    """RSC-04. Flux times the factor of the one region there is; more than one is an error."""
    if factor.select("region_id").distinct().limit(2).count() != 1:
        raise ValueError("exactly one region is needed")
    return flux.join(factor.select(*by, "factor"), list(by), "left").withColumn(value, F.col(value) * F.coalesce("factor", F.lit(1.0))).select(*flux.columns)


def rescaled(cross: DataFrame, totals: DataFrame) -> DataFrame:
    """RSC-01. Active inventories and sectors that have totals; daily, hourly or point ones are marked
    as errors."""
    mine = cross.join(totals.select("ei", "sector").distinct(), ["ei", "sector"], "left_semi")
    return mine.withColumn("is_error", F.col("frequency").isin("daily", "hourly") | (F.col("source_type") != "area"))


def wrong_units(totals: DataFrame, frequency: DataFrame) -> DataFrame:
    """CHK-09. Totals whose unit isn't one of their inventory's frequency."""
    fits = ((F.col("frequency") == "yearly") & F.col("units").isin("kg/year", "t/year")) | ((F.col("frequency") == "monthly") & F.col("units").isin("kg/month", "t/month"))
    return totals.join(frequency, ["ei", "sector"]).where(~fits)
