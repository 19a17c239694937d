"""Chemical speciation and species splits (SPC, SRC-07, SRC-08, SRC-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridflux.functions import arithmetic, names_in

INFO_ROWS = ("units", "short_description")


def read_profiles(table: DataFrame) -> DataFrame:
    """SRC-07. Wide table ID + species as rows profile, species, expr, units, description."""
    species = [c for c in table.columns if c != "ID"]
    rows = table.unpivot(["ID"], species, "species", "expr").withColumnRenamed("ID", "profile")
    info = rows.where(F.col("profile").isin(*INFO_ROWS)).groupBy("species").agg(F.max(F.when(F.col("profile") == "units", F.col("expr"))).alias("units"), F.max(F.when(F.col("profile") == "short_description", F.col("expr"))).alias("description"))
    return rows.where(~F.col("profile").isin(*INFO_ROWS)).join(info, "species", "left").select("profile", "species", "expr", "units", "description")


def incomplete(profiles: DataFrame) -> DataFrame:
    """CHK-03. Cells of a speciation table that hold nothing: null, blank, NaN, NA or null as text."""
    clean = F.upper(F.trim("expr"))
    return profiles.where(F.col("expr").isNull() | clean.isin("", "NAN", "NA", "NULL", "NONE"))


def speciate(flux: DataFrame, weights: dict[str, float], expressions: dict[str, str], keys: list[str], value: str = "flux") -> DataFrame:
    """SPC-01. Each pollutant over its molecular weight (1 where none is given), then one expression for
    each output species; ``0`` gives zeros. A pollutant without rows counts as 0."""
    inputs = sorted(weights)
    wide = flux.groupBy(*keys).pivot("pollutant", inputs).agg(F.sum(value))
    moles = wide.select(*keys, *[(F.coalesce(F.col(f"`{p}`"), F.lit(0.0)) / weights[p]).alias(p) for p in inputs])
    out = moles.select(*keys, *[arithmetic(e, inputs).alias(s) for s, e in expressions.items()])
    return out.unpivot(keys, list(expressions), "species", "value")


def unused_inputs(pollutants: DataFrame, profiles: DataFrame) -> DataFrame:
    """CHK-16. Input pollutants that no expression names as a whole word."""
    used = profiles.select(F.explode(names_in(F.col("expr"))).alias("pollutant")).distinct()
    return pollutants.select("pollutant").distinct().join(used, "pollutant", "left_anti")


def split_ratios(wanted: DataFrame, ratios: DataFrame, default: str = "EUR") -> DataFrame:
    """SPC-02. Ratio of each wanted (iso3, sector, species, year): the country's, or the default
    region's where it has none above zero."""
    own = ratios.select("iso3", "sector", "species", "year", F.col("fr").alias("own"))
    base = ratios.where(F.col("iso3") == default).select("sector", "species", "year", F.col("fr").alias("base"))
    joined = wanted.join(own, ["iso3", "sector", "species", "year"], "left").join(base, ["sector", "species", "year"], "left")
    return joined.withColumn("fr", F.coalesce(F.when(F.col("own") > 0, F.col("own")), F.col("base"))).drop("own", "base")


def latest_year(ratios: DataFrame, year: int) -> DataFrame:
    """SRT-04. Ratios of the year, or of the latest one there is."""
    chosen = ratios.agg(F.coalesce(F.max(F.when(F.col("year") == year, F.col("year"))), F.max("year")).alias("_year"))
    return ratios.join(F.broadcast(chosen), F.col("year") == F.col("_year")).drop("_year")  # one row


def apply_split(flux: DataFrame, ratios: DataFrame, keys: list[str], value: str = "flux") -> DataFrame:
    """SPC-03, SPC-04. Parent flux times the ratio of each species, ratios above zero only."""
    return flux.join(ratios.where("fr > 0").select(*keys, "species", "fr"), keys).withColumn(value, F.col(value) * F.col("fr")).drop("fr")


def single_factor(ratios: DataFrame, *by: str) -> DataFrame:
    """SPC-05. The one factor of each key; several different ones leave null."""
    return ratios.groupBy(*by).agg(F.when(F.count_distinct("fr") == 1, F.max("fr")).alias("fr"), F.count_distinct("fr").alias("n"))


def with_parents(wanted: DataFrame, parents: DataFrame) -> DataFrame:
    """SPC-06. Wanted species and the parents (species, parent) that they are split from."""
    return wanted.select("species").unionByName(wanted.join(parents, "species").select(F.col("parent").alias("species"))).distinct()


def all_species(result: DataFrame, species: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-03. Result with every declared species at every key, zero where there is none."""
    full = result.select(*keys).distinct().crossJoin(F.broadcast(species.select("species").distinct()))  # a short list
    return full.join(result, [*keys, "species"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def sector_shares(totals: DataFrame, *by: str) -> DataFrame:
    """AGG-13. Share of each sub-sector in its sector's total."""
    whole = F.sum("total").over(Window.partitionBy(*by))
    return totals.withColumn("share", F.try_divide(F.col("total"), whole))


def parent_check(parent: DataFrame, parts: DataFrame, *by: str) -> DataFrame:
    """AGG-14. Percent difference between the split parts' total and their parent's."""
    a = parent.groupBy(*by).agg(F.sum("flux").alias("parent_total"))
    b = parts.groupBy(*by).agg(F.sum("flux").alias("parts_total"))
    return a.join(b, list(by), "full_outer").withColumn("percent", 100 * F.try_divide(F.col("parts_total") - F.col("parent_total"), F.col("parent_total")))
