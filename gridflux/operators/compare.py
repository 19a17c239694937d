"""Comparison of two datasets and set operations on their variables (JON-21, JON-22, SET)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("variable", "ts", "fid")


def _paired(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Both values of each key of the shared variables; ``missing`` marks a key that one side lacks."""
    shared = common_variables(a, b)
    x = a.join(shared, "variable", "left_semi").select(*keys, F.col("value").alias("a"), F.lit(1).alias("in_a"))
    y = b.join(shared, "variable", "left_semi").select(*keys, F.col("value").alias("b"), F.lit(1).alias("in_b"))
    return x.join(y, list(keys), "full_outer").withColumn("missing", F.col("in_a").isNull() | F.col("in_b").isNull()).drop("in_a", "in_b")


def difference(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """JON-21. b - a of the shared variables, with ``identical`` (equal, or both NaN or null) and ``missing``."""
    same = F.col("a").eqNullSafe(F.col("b")) | F.coalesce(F.isnan("a") & F.isnan("b"), F.lit(False))
    return _paired(a, b, keys).select(*keys, (F.col("b") - F.col("a")).alias("value"), (same & ~F.col("missing")).alias("identical"), "missing")


def percent_difference(a: DataFrame, b: DataFrame, eps: float = 0.0, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """JON-22. 100 (b - a) / (a + eps); a division by zero gives NaN for 0 / 0, else infinity."""
    low, gap = F.col("a") + eps, 100 * (F.col("b") - F.col("a"))
    at_zero = F.when(gap == 0, float("nan")).when(gap > 0, float("inf")).when(gap < 0, float("-inf"))
    return _paired(a, b, keys).select(*keys, F.when(low == 0, at_zero).otherwise(F.try_divide(gap, low)).alias("value"), "missing")


def count_odd(df: DataFrame, column: str = "value") -> DataFrame:
    """JON-22, CHK-01. NaN and infinite values of each variable."""
    return df.groupBy("variable").agg(F.count_if(F.isnan(column)).alias("n_nan"), F.count_if(F.abs(column) == float("inf")).alias("n_inf"))


def common_variables(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-02. Variables of both."""
    return a.select("variable").intersect(b.select("variable"))


def missing_codes(wanted: DataFrame, there: DataFrame, column: str) -> DataFrame:
    """SET-03, CHK-05, CHK-06, CHK-08. Wanted codes that aren't there, each once."""
    return wanted.select(column).distinct().join(there.select(column).distinct(), column, "left_anti")
