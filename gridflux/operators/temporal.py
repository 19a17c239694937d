"""Temporal allocation (TMP, AGG-16, AGG-17): profiles are long tables id, bucket, factor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP = {"hourly": "HOUR", "daily": "DAY", "monthly": "MONTH", "yearly": "YEAR"}
#: Weekday names in the order of the buckets 0 to 6 (fixed values).
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def time_steps(spark: SparkSession, start: str, kind: str, n: int, freq: int = 1) -> DataFrame:
    """TMP-01. The n output steps from a start; months and years keep the calendar."""
    at = F.to_timestamp(F.lit(start))
    shift = F.col("id").cast("int") * freq
    ts = F.timestamp_add(STEP[kind], shift, at)
    return spark.range(n).select(F.col("id").cast("int").alias("step"), ts.alias("ts"))


def start_dates(spark: SparkSession, start: str, end: str, kind: str = "daily") -> DataFrame:
    """TMP-11. Start dates of the runs: a day, month or year apart, up to the end."""
    step = {"daily": "INTERVAL 1 DAY", "monthly": "INTERVAL 1 MONTH", "yearly": "INTERVAL 1 YEAR"}[kind]
    return spark.sql(f"SELECT explode(sequence(to_date('{start}'), to_date('{end}'), {step})) AS sim_date")


def local_calendar(cells: DataFrame, steps: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """TMP-02, TMP-03. Local time of each cell (fid, tz) and step, with month, weekday (Monday 0),
    hour and day of year. ``aliases``: names of zones (tz, zone) that the time-zone data lacks."""
    c = cells
    if aliases is not None:
        c = c.join(aliases, "tz", "left").withColumn("tz", F.coalesce("zone", "tz")).drop("zone")
    local = c.crossJoin(F.broadcast(steps)).withColumn("local_ts", F.from_utc_timestamp("ts", F.col("tz")))  # a few output steps
    return with_calendar(local, "local_ts")


def with_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """TMP-03. month_i, weekday_i (Monday 0), hour_i and julian of a timestamp."""
    return df.withColumns({"month_i": F.month(ts), "weekday_i": F.weekday(ts), "hour_i": F.hour(ts), "julian": F.dayofyear(ts)})


def holidays_as_sunday(calendar: DataFrame, holidays: DataFrame, country: str = "iso2") -> DataFrame:
    """TMP-04. Weekday 6 on national holidays (country, holiday date)."""
    h = holidays.select(country, F.col("date").alias("_date")).distinct().withColumn("_hit", F.lit(True))
    joined = calendar.withColumn("_date", F.to_date("local_ts")).join(h, [country, "_date"], "left")
    return joined.withColumn("weekday_i", F.when(F.col("_hit"), 6).otherwise(F.col("weekday_i"))).drop("_date", "_hit")


def weekday_counts(months: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """AGG-16. Days of each weekday in each month (year_i, month_i[, country]); with ``holidays`` they
    count as Sundays."""
    keys = months.columns
    first = F.make_date("year_i", "month_i", F.lit(1))
    days = months.withColumn("date", F.explode(F.sequence(first, F.last_day(first)))).withColumn("weekday_i", F.weekday("date"))
    if holidays is not None:
        h = holidays.select("country", "date").distinct().withColumn("hit", F.lit(True))
        days = days.join(h, ["country", "date"], "left").withColumn("weekday_i", F.when(F.col("hit"), 6).otherwise(F.col("weekday_i")))
    return days.groupBy(*keys, "weekday_i").agg(F.count("*").alias("n_days"))


def rebalance_weekly(profile: DataFrame, counts: DataFrame, *by: str) -> DataFrame:
    """TMP-06. Weekly factors shifted by the same amount so that they keep the month's total:
    f + (N - sum f n) / N."""
    joined = profile.join(counts, profile["bucket"] == counts["weekday_i"]).drop("weekday_i")
    keys = ["id", "year_i", "month_i", *by]
    total = joined.groupBy(*keys).agg(F.sum("n_days").alias("n"), F.sum(F.col("factor") * F.col("n_days")).alias("used"))
    return joined.join(total, keys).select(*keys, "bucket", (F.col("factor") + (F.col("n") - F.col("used")) / F.col("n")).alias("factor"))


def parse_hourly_id(profiles: DataFrame, key: str, text: str) -> DataFrame:
    """TMP-08. ``weekday=H1, saturday=H2``, or one id for all days: key, weekday_i, id.

    ``weekday`` means Monday to Friday, ``weekend`` the rest, and a named day beats both; of two that
    name a day alike the last one counts. A key's texts, in one row as a rule, are put together before
    they become days; an unknown name is day -1.
    """
    texts = profiles.select(F.col(key), F.col(text).alias("_t")).repartition(key).groupBy(key).agg(F.array_sort(F.collect_list("_t")).alias("_t"))

    def rule(p: Column) -> Column:
        name = F.when(F.instr(p, "=") > 0, F.lower(F.trim(F.element_at(F.split(p, "="), 1)))).otherwise(F.lit("all"))
        day = F.array_position(F.array(*map(F.lit, WEEKDAYS)), name).cast("int") - 1
        of = lambda all_days, week, weekend, named: F.when(name == "all", all_days).when(name == "weekday", week).when(name == "weekend", weekend).otherwise(named)
        return F.struct(of(0, 0, 5, day).alias("first"), of(6, 4, 6, day).alias("last"), of(0, 1, 1, 2).alias("rank"), F.trim(F.element_at(F.split(p, "="), -1)).alias("id"))

    rules = texts.select(key, F.transform(F.flatten(F.transform("_t", lambda t: F.split(t, r"\s*,\s*"))), rule).alias("_r"))

    def chosen(d: Column) -> Column:
        mine = F.filter("_r", lambda x: (x["first"] <= d) & (d <= x["last"]))
        return F.element_at(F.filter(mine, lambda x: x["rank"] == F.array_max(F.transform(mine, lambda y: y["rank"]))), -1)["id"]

    days = F.filter(F.transform(F.sequence(F.lit(-1), F.lit(6)), lambda d: F.struct(d.alias("weekday_i"), F.when(F.exists("_r", lambda x: (x["first"] <= d) & (d <= x["last"])), chosen(d)).alias("id"))), lambda x: x["id"].isNotNull())
    return rules.select(key, F.explode(days).alias("_d")).select(key, "_d.weekday_i", "_d.id")


def lookup(df: DataFrame, profile: DataFrame, id_column: str, bucket: Column, name: str, gridded: bool = False) -> DataFrame:
    """TMP-05, TMP-07, TMP-08. Factor of a profile at a bucket as ``name``; 1 where the id is null.

    Gridded profiles hold the cell as well.
    """
    p = profile.select(F.col("id").alias(id_column), F.col("bucket").alias("_bucket"), *(["fid"] if gridded else []), F.col("factor").alias(name))
    out = df.withColumn("_bucket", bucket).join(p, [id_column, "_bucket", *(["fid"] if gridded else [])], "left")
    return out.withColumn(name, F.when(F.col(id_column).isNull(), F.lit(1.0)).otherwise(F.col(name))).drop("_bucket")


def temporal_factor(month: Column, week: Column, day: Column | None, hour: Column, step: str = "hourly") -> Column:
    """TMP-09, TMP-10. Product of the factors that the step type uses; a daily one replaces month and week."""
    one = F.lit(1.0)
    w = week if step in ("daily", "hourly") else one
    h = hour if step == "hourly" else one
    base = month * w
    if day is not None and step in ("daily", "hourly"):
        base = F.coalesce(day, base)
    return base * h


def profile_sums(profile: DataFrame, expected: float, severe: bool, digits: int = 2) -> DataFrame:
    """AGG-17, CHK-04. Sum of each profile against what it should be, with the severity of a miss."""
    total = F.round(F.sum("factor"), digits)
    severity = F.when(total == expected, "ok").otherwise("error" if severe else "warning")
    return profile.groupBy("id").agg(total.alias("total"), severity.alias("severity"))


def yearly_to_monthly(flux: DataFrame, profile: DataFrame, keys: tuple[str, ...] = ("fid",)) -> DataFrame:
    """TMP-13. Monthly field from a yearly one and 12 gridded factors (fid, bucket 1-12, factor)."""
    return flux.join(profile, list(keys)).withColumns({"month_i": F.col("bucket"), "flux": F.col("flux") * F.col("factor")}).drop("bucket", "factor")
