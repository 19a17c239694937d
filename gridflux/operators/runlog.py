"""Run-time logs (AGG-18 to AGG-21, WIN-08, SRC-24): section, subsection, replication, processes, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIMER = ("section", "subsection")


def rank_summary(times: DataFrame, *by: str) -> DataFrame:
    """AGG-21. Least, mean and greatest over ranks of the time that each timer adds up to."""
    each = times.groupBy(*by, *TIMER, "rank").agg(F.sum("seconds").alias("seconds"))
    return each.groupBy(*by, *TIMER).agg(F.min("seconds").alias("min_s"), F.avg("seconds").alias("mean_s"), F.max("seconds").alias("max_s"))


def map_legacy(log: DataFrame, names: DataFrame) -> DataFrame:
    """SRC-24. Old timers under their new names (old_section, old_subsection, section, subsection, sign);
    several sum up, never below zero."""
    joined = log.join(names, (log["section"] == names["old_section"]) & (log["subsection"] == names["old_subsection"])).select("replication", "processes", names["section"], names["subsection"], (log["value"] * names["sign"]).alias("value"))
    return joined.groupBy("replication", "processes", *TIMER).agg(F.greatest(F.sum("value"), F.lit(0.0)).alias("value"))


def inliers(log: DataFrame, method: str = "iqr", limit: float = 1.5, at_least: int = 4) -> DataFrame:
    """WIN-08. Whether each replication's value is no outlier of its timer and process count, by iqr, mad
    (0.6745) or zscore; with fewer replications or no spread all are kept."""
    keys = [*TIMER, "processes"]
    n = F.count("*").over(Window.partitionBy(*keys))
    if method == "iqr":
        q = log.groupBy(*keys).agg(F.percentile("value", F.lit(0.25)).alias("a"), F.percentile("value", F.lit(0.75)).alias("b"))
        spread, ok = F.col("b") - F.col("a"), F.col("value").between(F.col("a") - limit * (F.col("b") - F.col("a")), F.col("b") + limit * (F.col("b") - F.col("a")))
    elif method == "mad":
        m = log.groupBy(*keys).agg(F.percentile("value", F.lit(0.5)).alias("b"))
        q = log.join(m, keys).groupBy(*keys).agg(F.first("b").alias("b"), F.percentile(F.abs(F.col("value") - F.col("b")), F.lit(0.5)).alias("a"))
        spread, ok = F.col("a"), F.abs(0.6745 * F.try_divide(F.col("value") - F.col("b"), F.col("a"))) <= limit
    elif method == "zscore":
        q = log.groupBy(*keys).agg(F.avg("value").alias("b"), F.stddev_pop("value").alias("a"))
        spread, ok = F.col("a"), F.abs(F.try_divide(F.col("value") - F.col("b"), F.col("a"))) <= limit
    else:
        raise ValueError(f"unknown method {method}")
    kept = F.when((F.col("n") < at_least) | (spread == 0), True).otherwise(ok)
    return log.withColumn("n", n).join(q, keys).withColumn("inlier", kept).drop("a", "b", "n")


def aggregate_replications(log: DataFrame, how: str = "mean") -> DataFrame:
    """AGG-18. Mean or median of the inliers, with the counts kept and removed."""
    value: Column = F.when(F.col("inlier"), F.col("value"))
    middle = F.avg(value) if how == "mean" else F.percentile(value, F.lit(0.5))
    return log.groupBy(*TIMER, "processes").agg(middle.alias("value"), F.count_if("inlier").alias("kept"), F.count_if(~F.col("inlier")).alias("removed"))


def summarize(log: DataFrame, groups: DataFrame) -> DataFrame:
    """AGG-19. Time of each phase by a table (section, subsection, phase, skip_if_detail); a timer marked
    so is left out where others of its section are there."""
    joined = log.join(groups, list(TIMER))
    detail = F.max(F.when(~F.col("skip_if_detail"), 1).otherwise(0)).over(Window.partitionBy("processes", "section"))
    used = joined.withColumn("detail", detail).where(~F.col("skip_if_detail") | (F.col("detail") == 0))
    return used.groupBy("processes", "phase").agg(F.sum("value").alias("value"))


def speedup(log: DataFrame, *by: str) -> DataFrame:
    """AGG-20. Speed-up T(1) / T(p) and efficiency; a timer without p = 1 has none."""
    one = log.where("processes = 1").select(*by, F.col("value").alias("one"))
    return log.join(one, list(by), "left").withColumn("speedup", F.try_divide(F.col("one"), F.col("value"))).withColumn("efficiency", F.col("speedup") / F.col("processes")).drop("one")
