"""Input tables (SRC). Paths are anything that Spark reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridflux.operators.checks import CROSS_COLUMNS
from gridflux.operators.speciation import incomplete, read_profiles
from gridflux.operators.vertical import profile_layers

INVENTORY = "inventory STRING, sector STRING, pollutant STRING, period STRING, fid BIGINT, flux DOUBLE"
STACKS = "Lat DOUBLE, Lon DOUBLE, Alt_Injection DOUBLE, Emis DOUBLE"
#: Partitions that a filter lists one by one.
SHORT_LIST = 2_000


def read_inventory(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """SRC-01. Fields of the wanted (inventory, sector, pollutant, period) from Parquet partitioned by
    them; a wanted one without rows is an error."""
    keys = ["inventory", "sector", "pollutant", "period"]
    wanted = wanted.select(*keys).distinct()
    table = spark.read.schema(INVENTORY).parquet(path)
    listed = wanted.limit(SHORT_LIST + 1).collect()
    if len(listed) <= SHORT_LIST:
        found = table.where(partitions_of(listed, keys))
    else:  # too long for a filter: the join prunes while it runs
        found = table.join(wanted, keys, "left_semi")
    missing = wanted.join(found.select(*keys).distinct(), keys, "left_anti").collect()
    if missing:
        raise FileNotFoundError(f"no field for {[tuple(m) for m in missing]}")
    return found


def partitions_of(rows: list, keys: list[str]) -> Column:
    """A filter on partition columns that holds for the rows' keys: the last one listed under each of the others."""
    groups: dict[tuple, list] = {}
    for row in rows:
        groups.setdefault(tuple(row[k] for k in keys[:-1]), []).append(row[keys[-1]])
    out = F.lit(False)
    for values, last in sorted(groups.items()):
        here = F.col(keys[-1]).isin(last)
        for k, v in zip(keys, values):
            here &= F.col(k) == v
        out |= here
    return out


def read_fire_field(spark: SparkSession, path: str, pollutants: list[str], altitude: str, days: list[str]) -> DataFrame:
    """SRC-22. Fires (ts, src_fid, pollutant, flux, height) of a table (ts, src_fid, variable, value) that is
    partitioned by day: all pollutants of a step with the injection height of the same step and cell, which
    stands in the table as one more variable. A day or variable without any row is an error; a cell
    without a height keeps null."""
    names = [*pollutants, altitude]
    rows = spark.read.parquet(path).where(F.col("day").cast("string").isin(days) & F.col("variable").isin(names))
    there = {(r["day"], r["variable"]) for r in rows.select(F.col("day").cast("string").alias("day"), "variable").distinct().collect()}
    if lost := sorted({(d, n) for d in days for n in names} - there):
        raise FileNotFoundError(f"no rows for {lost}")
    height = F.max(F.when(F.col("variable") == altitude, F.col("value"))).over(Window.partitionBy("ts", "src_fid"))
    return rows.withColumn("height", height).where(F.col("variable") != altitude).select("ts", "src_fid", F.col("variable").alias("pollutant"), F.col("value").alias("flux"), "height")


def read_cross_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03, CHK-11. Active rows of the `;` separated cross table, one for each pollutant."""
    return active_rows(spark.read.csv(path, sep=";", header=True))


def active_rows(table: DataFrame) -> DataFrame:
    """SRC-03. Active rows, one for each pollutant; at least one must be active."""
    missing = sorted(set(CROSS_COLUMNS) - set(table.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    rows = table.where(F.col("active").try_cast("int") == 1)
    if rows.isEmpty():
        raise ValueError("no active row")
    names = F.filter(F.split(F.trim("pollutants"), r"[,;\s]+"), lambda p: p != "")
    return rows.withColumn("pollutant", F.explode(names)).drop("pollutants")


def read_profile(spark: SparkSession, path: str, ids: list[str] | None = None) -> DataFrame:
    """SRC-04. Wide temporal profile CSV as id, bucket (from 0), factor."""
    return long_profile(spark.read.csv(path, header=True, sep=","), ids)


def long_profile(table: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """SRC-04. Profile rows id, bucket, factor; a repeated or missing id is an error."""
    twice = table.groupBy("ID").count().where("count > 1").select("ID").collect()
    if twice:
        raise ValueError(f"repeated profiles {[r[0] for r in twice]}")
    if ids and (lost := sorted(set(ids) - {r[0] for r in table.where(F.col("ID").isin(ids)).select("ID").collect()})):
        raise ValueError(f"missing profiles {lost}")
    names = [c for c in table.columns if c != "ID"]
    place = F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(k))])
    return table.unpivot(["ID"], names, "name", "factor").select(F.col("ID").alias("id"), place[F.col("name")].alias("bucket"), F.col("factor").cast("double").alias("factor"))


def check_gridded_profile(profile: DataFrame, n_cells: int, n_buckets: int) -> DataFrame:
    """SRC-05, CHK-14. Ids of a gridded profile that don't hold each bucket of each cell once."""
    return profile.groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("bucket", "fid").alias("different")).where((F.col("n") != n_cells * n_buckets) | (F.col("different") != n_cells * n_buckets))


def _by_header(table: DataFrame, schema: str) -> DataFrame:
    """The schema's columns by the names in the file's header, in whatever order they stand there."""
    return table.select(*[F.col(name).cast(kind).alias(name) for name, kind in (c.split() for c in schema.split(", "))])


def read_vertical_profiles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-06. Profiles of a `;` separated file (ID, layers, weights) as rows id, layer, bottom, top, weight;
    a profile whose lists differ in length, are empty or hold anything but numbers is an error."""
    table = _by_header(spark.read.csv(path, header=True, sep=";"), "ID STRING, layers STRING, weights STRING")
    rows = profile_layers(table.withColumnRenamed("ID", "id"))
    odd = rows.where("top IS NULL OR weight IS NULL").select("id").union(table.where("layers IS NULL OR weights IS NULL").select("ID")).distinct()
    if bad := [r[0] for r in odd.limit(20).collect()]:  # names some in the message
        raise ValueError(f"profiles whose layers and weights don't match: {sorted(map(str, bad))}")
    return rows


def read_speciation(spark: SparkSession, path: str) -> DataFrame:
    """SRC-07, CHK-03. Wide speciation CSV as rows profile, species, expr, units, description; rows without any
    entry are ignored, a cell without an expression is an error that names its profile and species."""
    table = spark.read.csv(path, header=True)
    names = [F.col(f"`{c}`") for c in table.columns]
    profiles = read_profiles(table.where(F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in names]).isNotNull()))
    if bad := incomplete(profiles).select("profile", "species").limit(20).collect():
        raise ValueError(f"no expression for {sorted(tuple(map(str, r)) for r in bad)}")
    return profiles


def read_molecular_weights(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08. Specie and MW."""
    return _by_header(spark.read.csv(path, header=True), "Specie STRING, MW DOUBLE")


def read_stacks(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09. Stacks of CSV files named after their pollutant, or in folders ``pollutant=<name>``."""
    table = spark.read.csv(path, header=True)
    name = F.col("pollutant").cast("string") if "pollutant" in table.columns else F.regexp_extract(F.input_file_name(), r"([^/_]+)(?:_[^/]*)?\.csv$", 1)
    return _by_header(table.withColumn("_name", name), STACKS + ", _name STRING").withColumnRenamed("_name", "pollutant")


def read_ratios(spark: SparkSession, path: str, code: str) -> DataFrame:
    """SRC-15. Split ratios iso3, sector, species, year, fr of a CSV (ISO3, year, gnfr, fr) whose species stand
    in the column ``code``."""
    rows = _by_header(spark.read.csv(path, header=True), f"ISO3 STRING, gnfr STRING, {code} STRING, year INT, fr DOUBLE")
    return rows.toDF("iso3", "sector", "species", "year", "fr")


def ratio_species(ratios: DataFrame, sign: str | None = None, prefix: str = "") -> DataFrame:
    """SRC-15. Species that a ratio table splits, each once, ``sign`` in their code spelt as ``prefix``."""
    name = F.replace("species", F.lit(sign), F.lit(prefix)) if sign else F.col("species")
    return ratios.where("species IS NOT NULL").select(name.alias("species")).distinct()


def ratio_sectors(ratios: DataFrame, species: str, prefix: str = "gnfr_") -> DataFrame:
    """SRC-15. Sectors for which a ratio table splits the species."""
    return ratios.where((F.col("species") == species) & F.col("sector").isNotNull()).select(F.concat(F.lit(prefix), "sector").alias("sector")).distinct()


def read_text_inventory(spark: SparkSession, path: str) -> DataFrame:
    """SRC-14. Text inventory whose first lines start with `#`, eight `;` separated columns; a row whose
    numbers can't be read has nulls there (see ``unread_rows``)."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    p = F.split("value", ";")
    names = ("ISO2", "YEAR", "SECTOR", "POLLUTANT", "LONGITUDE", "LATITUDE", "UNIT", "EMISSION")
    kinds = {"YEAR": "int", "LONGITUDE": "double", "LATITUDE": "double", "EMISSION": "double"}
    return lines.select(*[F.trim(F.get(p, F.lit(k))).try_cast(kinds.get(n, "string")).alias(n) for k, n in enumerate(names)])


def unread_rows(rows: DataFrame) -> DataFrame:
    """SRC-14. Rows of a text inventory without a year, place or emission; a caller reports or drops them."""
    return rows.where("YEAR IS NULL OR LONGITUDE IS NULL OR LATITUDE IS NULL OR EMISSION IS NULL")


def fix_coordinates(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """SRC-14. Known wrong coordinates replaced by a table (bad_lon, bad_lat, lon, lat)."""
    j = rows.join(fixes, (rows["LONGITUDE"] == fixes["bad_lon"]) & (rows["LATITUDE"] == fixes["bad_lat"]), "left")
    return j.withColumns({"LONGITUDE": F.coalesce("lon", "LONGITUDE"), "LATITUDE": F.coalesce("lat", "LATITUDE")}).select(*rows.columns)


def wide_inventory(table: DataFrame, keys: list[str]) -> DataFrame:
    """SRC-12, SRC-13. Wide regional inventory as keys, pollutant, mass; nulls and zeros dropped."""
    names = [c for c in table.columns if c not in keys]
    return table.unpivot(keys, names, "pollutant", "mass").withColumn("mass", F.col("mass").cast("double")).where("mass <> 0")


def read_logs(spark: SparkSession, pattern: str, path_regex: str) -> DataFrame:
    """SRC-23. Timing logs (section, subsection, ranks ..., min, mean, max); ``path_regex`` has the
    groups processes and replication in this order."""
    logs = spark.read.csv(pattern, header=True).withColumn("path", F.input_file_name())
    return logs.withColumns({"processes": F.regexp_extract("path", path_regex, 1).cast("int"), "replication": F.regexp_extract("path", path_regex, 2)}).drop("path")
