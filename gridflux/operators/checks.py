"""Quality checks (CHK): each returns the rows that fail, or a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.operators.stats import extremes

CROSS_COLUMNS = ("ei", "sector", "ref_year", "active", "factor_mask", "regrid_mask", "pollutants", "path", "frequency", "source_type", "p_vertical", "p_month", "p_week", "p_day", "p_hour", "p_speciation")


def bounds_report(field: DataFrame, bounds: DataFrame) -> DataFrame:
    """CHK-02. Extremes of each variable against six bounds: beyond an absolute one an error, outside a
    range a warning; ``missing`` where the field lacks a bounded variable, ``unbounded`` where the bounds lack one."""
    r = extremes(field).withColumn("there", F.lit(True)).join(bounds.withColumn("bounded", F.lit(True)), "variable", "full")
    failed = (F.col("min_value") < F.col("min_abs")) | (F.col("max_value") > F.col("max_abs"))
    soft = ~F.col("min_value").between(F.col("min_lower"), F.col("min_upper")) | ~F.col("max_value").between(F.col("max_lower"), F.col("max_upper"))
    return r.select("variable", "min_value", "max_value", F.when(F.col("there").isNull(), "missing").when(F.col("bounded").isNull(), "unbounded").when(failed, "error").when(soft, "warning").otherwise("ok").alias("status"))


def cross_table_errors(cross: DataFrame) -> DataFrame:
    """CHK-11. Rows with an unknown source type or frequency, or a year that is no integer."""
    missing = sorted(set(CROSS_COLUMNS) - set(cross.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    problem = F.when(~F.col("source_type").isin("area", "point"), "source_type").when(~F.col("frequency").isin("yearly", "monthly", "daily", "hourly"), "frequency").when(F.col("ref_year").try_cast("int").isNull(), "ref_year")
    return cross.withColumn("problem", problem).where("problem IS NOT NULL")


def grid_differences(table: DataFrame, cells: DataFrame) -> DataFrame:
    """CHK-10, CHK-14. Variables of a cached table whose cells aren't those of the grid, id by id; a null
    id is no cell. A table without any row differs as the variable null."""
    grid = cells.agg(F.count_distinct("fid").alias("g_n"))
    known = cells.select("fid", F.lit(1).alias("known")).distinct()
    own = table.select("variable", "fid").distinct().join(known, "fid", "left").groupBy("variable").agg(F.count("fid").alias("n"), F.count("known").alias("n_known"), F.count("*").alias("n_all"))
    whole = table.agg(F.count("*").alias("rows"))
    none = whole.join(grid).where("rows = 0 AND g_n > 0").select(F.lit(None).cast(dict(table.dtypes)["variable"]).alias("variable"), F.col("rows").alias("n"), "g_n")  # one row each
    return own.join(F.broadcast(grid)).where("n_all <> g_n OR n_known <> g_n").select("variable", "n", "g_n").unionByName(none)  # one row


def other_geometries(layer: DataFrame, kind: str = "Point") -> DataFrame:
    """CHK-12. Features that aren't of the one kind allowed."""
    return layer.where(F.coalesce(F.col("kind") != kind, F.lit(True)))


#: Units in which a field may go on road lines (fixed values).
MASS_RATES = ("kg/s", "Kg/s", "kg.s-1", "Kg.s-1")


def need_mass_rates(units: dict[str, str]) -> None:
    """JOB-15. All named variables must be in kilograms a second."""
    if bad := sorted(v for v, u in units.items() if u not in MASS_RATES):
        raise ValueError(f"not in kg/s: {bad}")


def mass_balance(before: DataFrame, after: DataFrame, key: str = "pollutant") -> DataFrame:
    """CHK-15. Mass of each pollutant before and after an allocation."""
    a, b = (df.groupBy(key).agg(F.sum("mass").alias(n)) for df, n in ((before, "mass_in"), (after, "mass_out")))
    return a.join(b, key, "full_outer").withColumn("lost", F.coalesce("mass_in", F.lit(0.0)) - F.coalesce("mass_out", F.lit(0.0)))
