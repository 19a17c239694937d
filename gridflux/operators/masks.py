"""Country masks and factors (MSK, JON-17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_code(code: Column, size: int) -> Column:
    """MSK-04. Code in upper case without blanks and NUL; placeholders and other lengths are null."""
    clean = F.upper(F.trim(F.translate(code, "\x00", "")))
    return F.when((F.length(clean) == size) & ~clean.isin("NAN", "NONE", "UNK", "NA"), clean)


def parse_factors(masks: DataFrame, key: str, text: str) -> DataFrame:
    """MSK-01. ``ESP 0.5, FRA 1.2`` or one number: key, iso3 (null: the default), factor.

    A list has the default 1. A factor that is no number gives a row with a null factor, which
    ``bad_factors`` finds.
    """
    parts = F.filter(F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s*,\s*"), lambda p: p != "")
    rows = masks.select(key, F.explode(parts).alias("p")).withColumn("w", F.split("p", r"\s+"))
    one = F.size("w") == 1
    listed = rows.select(key, F.when(one, None).otherwise(F.upper(F.col("w")[0])).alias("iso3"), F.when(one, F.col("w")[0]).otherwise(F.get("w", F.lit(1))).try_cast("double").alias("factor"))
    lone = listed.where("iso3 IS NULL").select(key)
    default = masks.select(key).join(lone, key, "left_anti").select(key, F.lit(None).cast("string").alias("iso3"), F.lit(1.0).alias("factor"))
    return listed.unionByName(default)


def bad_factors(factors: DataFrame) -> DataFrame:
    """MSK-01. Entries whose factor is no number."""
    return factors.where("factor IS NULL")


def parse_inclusion(masks: DataFrame, key: str, text: str) -> DataFrame:
    """MSK-02. ``+ A B``: only these; ``- A B``: all but these; any other start has no effect.

    key, iso3 (null: the default), factor of 0 or 1, and ``ignored`` for the warning.
    """
    t = F.trim(F.coalesce(F.col(text), F.lit("")))
    sign = F.substring(t, 1, 1)
    rows = masks.select(key, sign.alias("sign"), t.alias("t"), F.filter(F.split(F.expr(f"substring(trim(coalesce(`{text}`, '')), 2)"), r"[\s,]+"), lambda c: c != "").alias("codes"))
    known = F.col("sign").isin("+", "-")
    listed = rows.where(known).select(key, F.explode("codes").alias("iso3"), F.when(F.col("sign") == "+", 1.0).otherwise(0.0).alias("factor"), F.lit(False).alias("ignored"))
    default = rows.select(key, F.lit(None).cast("string").alias("iso3"), F.when(F.col("sign") == "+", 0.0).otherwise(1.0).alias("factor"), (~known & (F.col("t") != "")).alias("ignored"))
    return listed.withColumn("iso3", F.upper("iso3")).unionByName(default)


def cell_factors(cells: DataFrame, factors: DataFrame, key: str) -> DataFrame:
    """JON-17. Factor of each cell (fid, iso3) for each key: the country's, else the default."""
    listed, default = factors.where("iso3 IS NOT NULL"), factors.where("iso3 IS NULL")
    base = cells.select("fid", "iso3").crossJoin(F.broadcast(default.select(key, F.col("factor").alias("base"))))  # a row for each mask
    return base.join(listed.select(key, "iso3", "factor"), [key, "iso3"], "left").select(key, "fid", F.coalesce("factor", "base").alias("factor"))


def mask_product(scaling: DataFrame, inclusion: DataFrame, key: str) -> DataFrame:
    """MSK-03. Scaling factor times inclusion of each cell; a mask that is absent counts as 1."""
    a, b = scaling.withColumnRenamed("factor", "a"), inclusion.withColumnRenamed("factor", "b")
    return a.join(b, [key, "fid"], "full_outer").select(key, "fid", (F.coalesce("a", F.lit(1.0)) * F.coalesce("b", F.lit(1.0))).alias("factor"))
