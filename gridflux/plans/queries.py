"""Registered queries of the engine's own operators, each with its DuckDB SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridflux import streaming
from gridflux.operators import checks, compare, filters, grid, masks, polygons, regrid, rescale, roads, runlog, spatial, speciation, stats, temporal, units, vertical
from gridflux.operators.points import stack_flux
from gridflux.plans import jobs
from gridflux.plans.views import COARSE, FINE, cells, field, flux, load, points, with_views
from gridflux.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TOPS = [40.0, 120.0, 300.0, 600.0]


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def r(c: str | Column, n: int = 6) -> Column:
    return F.round(c, n)


def hour_no(ts: str = "ts") -> Column:
    """Hours since 1970, a time stamp that no zone or precision changes."""
    return F.floor(F.unix_timestamp(F.col(ts)) / 3600).cast("long")


# Sources ---------------------------------------------------------------------------------------


@query(with_views("SELECT inventory, sector, pollutant, count(*) AS n, round(sum(flux), 4) AS flux FROM flux WHERE inventory = 'A' AND pollutant IN (1, 2) GROUP BY 1, 2, 3", "flux"))
def src_01_inventory_by_partition(spark, d):
    keys, to = ["inventory", "sector", "pollutant", "period"], sinks.scratch(spark, "inventory")
    f = flux(spark, d).select("inventory", "sector", F.col("pollutant").cast("string").alias("pollutant"), F.format_string("%02d", "month_i").alias("period"), "fid", "flux")
    f.repartition(*keys).write.partitionBy(*keys).parquet(to)
    wanted = spark.read.schema(readers.INVENTORY).parquet(to).where("inventory = 'A' AND pollutant IN ('1', '2')").select(*keys).distinct()
    found = readers.read_inventory(spark, to, wanted).withColumn("pollutant", F.col("pollutant").cast("int"))
    return found.groupBy("inventory", "sector", "pollutant").agg(F.count("*").alias("n"), r(F.sum("flux"), 4).alias("flux"))


def as_csv(df: DataFrame, name: str, *folders: str, sep: str = ",") -> str:
    """``df`` written as CSV files with headers; the folder."""
    to = sinks.scratch(df.sparkSession, name)
    df.write.partitionBy(*folders).option("header", True).option("sep", sep).csv(to)
    return to


@query("""SELECT 'V' || s_suppkey AS id, CAST(k AS INTEGER) AS layer, CASE k WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 50.0 + s_suppkey % 30 ELSE 400.0 END AS bottom, CASE k WHEN 0 THEN 50.0::DOUBLE + s_suppkey % 30 WHEN 1 THEN 400.0 ELSE 410.0 + s_suppkey % 50 * 20 END AS top,
 CASE k WHEN 0 THEN 1.0::DOUBLE + s_suppkey % 3 WHEN 1 THEN 2.0 ELSE 1.5 END AS weight FROM supplier, (VALUES (0), (1), (2)) t(k)""")
def src_06_vertical_profiles(spark, d):
    k = F.col("s_suppkey")
    tops, weights = F.concat_ws(", ", 50 + k % 30, F.lit(400), 410 + k % 50 * 20), F.concat_ws(",", 1 + k % 3, F.lit("2"), F.lit("1.5"))
    table = load(spark, d, "supplier").select(F.concat(F.lit("V"), k).alias("ID"), tops.alias("layers"), weights.alias("weights"))
    return readers.read_vertical_profiles(spark, as_csv(table, "vertical", sep=";"))


@query("""SELECT 'P' || p_partkey AS profile, species, CASE species WHEN 'NO' THEN (90 - p_size) / 100.0::DOUBLE || '*nox' WHEN 'NO2' THEN (10 + p_size) / 100.0::DOUBLE || '*nox' ELSE '0' END AS expr, 'mol.s-1' AS units, species || ' of sources' AS description FROM part, (VALUES ('NO'), ('NO2'), ('PM')) t(species)""")
def src_07_speciation_profiles(spark, d):
    share = lambda n: F.concat((n / 100).cast("string"), F.lit("*nox"))
    rows = load(spark, d, "part").select(F.concat(F.lit("P"), "p_partkey").alias("ID"), share(90 - F.col("p_size")).alias("NO"), share(10 + F.col("p_size")).alias("NO2"), F.lit("0").alias("PM"))
    about = spark.createDataFrame([("units", *["mol.s-1"] * 3), ("short_description", *[f"{s} of sources" for s in ("NO", "NO2", "PM")])], rows.schema)
    return readers.read_speciation(spark, as_csv(rows.union(about), "speciation"))


@query("SELECT 'S' || n_nationkey AS \"Specie\", 12.011::DOUBLE + n_nationkey AS \"MW\" FROM nation")
def src_08_molecular_weights(spark, d):
    k = F.col("n_nationkey")
    table = load(spark, d, "nation").select((k + F.lit(12.011)).alias("MW"), F.lit("a gas").alias("Note"), F.concat(F.lit("S"), k).alias("Specie"))
    return readers.read_molecular_weights(spark, as_csv(table, "weights"))


@query(with_views("SELECT pollutant, count(*) AS n, max(lat) AS lat, min(lon) AS lon, max(height_m)::DOUBLE AS height, round(sum(emis), 2) AS emis FROM points GROUP BY 1", "points"))
def src_09_stack_files(spark, d):
    p = points(spark, d).select("pollutant", F.col("emis").alias("Emis"), F.col("lat").alias("Lat"), F.col("lon").alias("Lon"), F.col("height_m").alias("Alt_Injection"))
    found = readers.read_stacks(spark, as_csv(p, "stacks", "pollutant"))
    return found.groupBy("pollutant").agg(F.count("*").alias("n"), F.max("Lat").alias("lat"), F.min("Lon").alias("lon"), F.max("Alt_Injection").alias("height"), r(F.sum("Emis"), 2).alias("emis"))


@query("""SELECT 'N' || c_nationkey AS iso2, c_mktsegment AS sector, count(*) AS n, CAST(count(*) FILTER (c_custkey % 11 = 0) AS BIGINT) AS unread, round(sum(c_acctbal) FILTER (c_custkey % 11 <> 0), 2) AS emission, min(CASE WHEN c_custkey % 17 = 3 THEN 5.05::DOUBLE ELSE c_custkey % 17 + 0.25 END) AS lon FROM customer GROUP BY 1, 2""")
def src_14_text_inventory(spark, d):
    """Rows with an unreadable emission and a known wrong place."""
    k = F.col("c_custkey")
    emission = F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    line = F.concat_ws(";", F.concat(F.lit("N"), "c_nationkey"), F.lit("2020"), "c_mktsegment", F.lit("NOx"), k % 17 + F.lit(0.25), F.lit(40.0), F.lit("Mg"), emission)
    to = sinks.scratch(spark, "text")
    load(spark, d, "customer").select(F.explode(F.array(F.lit("# a remark"), line)).alias("value")).write.text(to)
    fixes = spark.createDataFrame([(3.25, 40.0, 5.05, 40.0)], "bad_lon double, bad_lat double, lon double, lat double")
    rows = readers.fix_coordinates(readers.read_text_inventory(spark, to), fixes)
    return rows.groupBy(F.col("ISO2").alias("iso2"), F.col("SECTOR").alias("sector")).agg(F.count("*").alias("n"), F.count_if(F.col("EMISSION").isNull()).alias("unread"), r(F.sum("EMISSION"), 2).alias("emission"), F.min("LONGITUDE").alias("lon"))


_RATIO_ROWS = "SELECT 'N' || c_nationkey AS iso3, c_mktsegment AS gnfr, CASE WHEN c_custkey % 13 > 0 THEN 'v' || lpad(CAST(c_custkey % 13 AS VARCHAR), 2, '0') END AS vcode FROM customer"


@query(f"SELECT DISTINCT replace(vcode, 'v', 'voc') AS species, 'gnfr_' || gnfr AS sector FROM ({_RATIO_ROWS}) WHERE vcode = 'v07' UNION SELECT DISTINCT replace(vcode, 'v', 'voc'), NULL FROM ({_RATIO_ROWS}) WHERE vcode IS NOT NULL")
def src_15_ratio_species_and_sectors(spark, d):
    """All species, without a sector, and the sectors of one."""
    k = F.col("c_custkey")
    code = F.when(k % 13 > 0, F.concat(F.lit("v"), F.lpad((k % 13).cast("string"), 2, "0")))
    table = load(spark, d, "customer").select((2015 + k % 5).alias("year"), F.concat(F.lit("N"), "c_nationkey").alias("ISO3"), F.col("c_mktsegment").alias("gnfr"), code.alias("vcode"), (F.col("c_acctbal") / 1e4).alias("fr"))
    ratios = readers.read_ratios(spark, as_csv(table, "ratios"), "vcode")
    every = readers.ratio_species(ratios, "v", "voc").withColumn("sector", F.lit(None).cast("string"))
    return every.unionByName(readers.ratio_sectors(ratios, "v07").withColumn("species", F.lit("voc07")))


@query("SELECT CAST(user_id % 8 + 1 AS INTEGER) AS processes, 'r' || event_id % 3 AS replication, event_type AS section, count(*) AS n, round(sum(value), 4) AS mean, max(value) AS \"max\" FROM events GROUP BY 1, 2, 3")
def src_23_run_logs(spark, d):
    e = load(spark, d, "events").select((F.col("user_id") % 8 + 1).alias("processes"), F.concat(F.lit("r"), F.col("event_id") % 3).alias("replication"), F.col("event_type").alias("section"), F.lit("all").alias("subsection"), *[F.col("value").alias(c) for c in ("min", "mean", "max")])
    logs = readers.read_logs(spark, as_csv(e, "logs", "processes", "replication") + "/*/*/*.csv", r"processes=(\d+)/replication=(\w+)/")
    return logs.groupBy("processes", "replication", "section").agg(F.count("*").alias("n"), r(F.sum(F.col("mean").cast("double")), 4).alias("mean"), F.max(F.col("max").cast("double")).alias("max"))


@query("""SELECT ei, sector, trim(p) AS pollutant, count(*) AS n FROM (SELECT 'EI' || l_suppkey % 7 AS ei, l_linestatus AS sector,
 unnest(string_split_regex(CASE WHEN l_linenumber % 3 = 0 THEN 'nox,co' WHEN l_linenumber % 3 = 1 THEN 'nox; so2 co' ELSE 'pm25' END, '[,;\\s]+')) AS p
 FROM lineitem WHERE l_quantity > 10) GROUP BY 1, 2, 3""")
def src_03_active_cross_table(spark, d):
    li = load(spark, d, "lineitem")
    names = F.when(F.col("l_linenumber") % 3 == 0, "nox,co").when(F.col("l_linenumber") % 3 == 1, "nox; so2 co").otherwise("pm25")
    table = li.select(F.concat(F.lit("EI"), F.col("l_suppkey") % 7).alias("ei"), F.col("l_linestatus").alias("sector"), F.when(F.col("l_quantity") > 10, "1").otherwise("0").alias("active"), names.alias("pollutants"), *[F.lit("").alias(c) for c in checks.CROSS_COLUMNS if c not in ("ei", "sector", "active", "pollutants")])
    return readers.active_rows(table).groupBy("ei", "sector", "pollutant").agg(F.count("*").alias("n"))


@query("""SELECT id, CAST(k AS INTEGER) AS bucket, round(sum(CASE WHEN month(l_shipdate) = k + 1 THEN l_quantity ELSE 0 END) * 12 / sum(l_quantity), 6) AS factor
 FROM (SELECT l_returnflag AS id, l_shipdate, l_quantity FROM lineitem), range(12) t(k) GROUP BY 1, 2""")
def src_04_monthly_profiles(spark, d):
    li = load(spark, d, "lineitem").select(F.col("l_returnflag").alias("ID"), F.month("l_shipdate").alias("m"), "l_quantity")
    wide = li.groupBy("ID").pivot("m", list(range(1, 13))).agg(F.sum("l_quantity")).na.fill(0.0)
    total = sum(F.col(str(m)) for m in range(1, 13))
    wide = wide.select("ID", *[(F.col(str(m)) * 12 / total).alias(str(m)) for m in range(1, 13)])
    return readers.long_profile(wide).select("id", "bucket", r("factor").alias("factor"))


@query(with_views("SELECT region, pollutant, round(sum(total) / 1000, 4) AS total_t FROM t GROUP BY 1, 2", t="""SELECT r_name AS region, 'co' AS pollutant, o_totalprice * (CASE WHEN o_orderkey % 2 = 0 THEN 1000 ELSE 1 END) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 UNION ALL SELECT r_name, 'nox', 0.5 * o_totalprice * (CASE WHEN o_orderkey % 2 = 0 THEN 1000 ELSE 1 END) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""))
def src_10_region_totals_kg(spark, d):
    o, c, n, g = (load(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    t = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(g, F.col("n_regionkey") == F.col("r_regionkey"))
    wide = t.select(F.col("r_name").alias("region"), F.when(F.col("o_orderkey") % 2 == 0, "t/year").otherwise("kg/year").alias("units"), F.col("o_totalprice").alias("co"), (F.col("o_totalprice") * 0.5).alias("nox"))
    return rescale.read_totals(wide, ["region"]).groupBy("region", "pollutant").agg(r(F.sum("total_kg") / 1000, 4).alias("total_t"))


@query("""SELECT ei, pollutant, period, round(total, 4) AS total FROM (SELECT *, row_number() OVER (PARTITION BY ei, pollutant ORDER BY CASE WHEN period = '1998' THEN 0 ELSE 1 END) AS k
 FROM (SELECT CAST(o_custkey % 50 AS BIGINT) AS ei, o_orderstatus AS pollutant, CASE WHEN year(o_orderdate) = 1998 THEN '1998' WHEN o_orderkey % 2 = 0 THEN 'default' ELSE '1901' END AS period, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2, 3) WHERE period IN ('1998', 'default')) WHERE k = 1""")
def src_11_period_or_default(spark, d):
    o = load(spark, d, "orders")
    period = F.when(F.year("o_orderdate") == 1998, "1998").when(F.col("o_orderkey") % 2 == 0, "default").otherwise("1901")
    totals = o.groupBy((F.col("o_custkey") % 50).alias("ei"), F.col("o_orderstatus").alias("pollutant"), period.alias("period")).agg(F.sum("o_totalprice").alias("total"))
    return rescale.pick_period(totals, ["ei", "pollutant"], "1998").select("ei", "pollutant", "period", r("total", 4).alias("total"))


@query("""SELECT kind, CAST(epoch(CASE kind WHEN 'hours' THEN o_orderdate + to_hours(n) WHEN 'days' THEN o_orderdate + to_days(CAST(n AS INTEGER)) WHEN 'months' THEN o_orderdate + to_months(CAST(n AS INTEGER)) ELSE o_orderdate + to_years(CAST(n AS INTEGER)) END) AS BIGINT) AS sec, count(*) AS n
 FROM (SELECT o_orderdate, o_orderkey % 40 AS n, ['hours', 'days', 'months', 'years'][1 + o_orderkey % 4] AS kind FROM orders) GROUP BY 1, 2""")
def src_25_decoded_times(spark, d):
    o = load(spark, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    kind = F.element_at(F.array(*map(F.lit, ("hours", "days", "months", "years"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    t = o.select(kind.alias("kind"), units.decode_time(F.col("o_orderkey") % 40, kind, F.col("at")).alias("ts"))
    return t.groupBy("kind", F.unix_timestamp("ts").alias("sec")).agg(F.count("*").alias("n"))


# Grids -----------------------------------------------------------------------------------------


@query(with_views("SELECT fid, nationkey, tz_h, round(sum(area_m2) / 1e9, 6) AS area, count(flux) AS n, round(sum(flux), 4) AS flux FROM cells LEFT JOIN flux USING (fid) GROUP BY 1, 2, 3", "cells", "flux"))
def grd_01_cells_with_flux(spark, d):
    return cells(spark).join(flux(spark, d), "fid", "left").groupBy("fid", "nationkey", "tz_h").agg(r(F.sum("area_m2") / 1e9).alias("area"), F.count("flux").alias("n"), r(F.sum("flux"), 4).alias("flux"))


_ROT = """SELECT point_id, round(degrees(atan2(cos(y) * sin(x), cos(t) * cos(y) * cos(x) + sin(t) * sin(y))), 5) AS rlon,
 round(degrees(asin(cos(t) * sin(y) - sin(t) * cos(y) * cos(x))), 5) AS rlat FROM (SELECT point_id, radians(lon - 10.0) AS x, radians(lat) AS y, radians(40.0::DOUBLE) AS t FROM points)"""


@query(with_views(_ROT, "points"))
def grd_23_rotated_coordinates(spark, d):
    x, y = grid.lonlat_to_rotated(F.col("lon"), F.col("lat"), 10.0, 40.0)
    return points(spark, d).select("point_id", r(x, 5).alias("rlon"), r(y, 5).alias("rlat"))


@query(with_views("SELECT point_id, round(lon, 4) AS lon, round(lat, 4) AS lat FROM points WHERE abs(lat) < 85", "points"))
def grd_04_rotated_round_trip(spark, d):
    p = points(spark, d).where(F.abs("lat") < 85)
    lon, lat = grid.rotated_to_lonlat(*grid.lonlat_to_rotated(F.col("lon"), F.col("lat"), 10.0, 40.0), 10.0, 40.0)
    return p.select("point_id", r(lon, 4).alias("lon"), r(lat, 4).alias("lat"))


_LCC = """SELECT point_id, round(rho * sin(th) / 1000, 4) AS x_km, round((r0 - rho * cos(th)) / 1000, 4) AS y_km FROM (SELECT point_id, s / pow(tan(pi() / 4 + radians(lat) / 2), n) AS rho, n * radians(lon - 5.0) AS th, s / pow(tan(pi() / 4 + radians(40.0) / 2), n) AS r0
 FROM (SELECT *, 6371000.0 * cos(radians(37.0)) * pow(tan(pi() / 4 + radians(37.0) / 2), n) / n AS s FROM (SELECT *, ln(cos(radians(37.0)) / cos(radians(43.0))) / ln(tan(pi() / 4 + radians(43.0) / 2) / tan(pi() / 4 + radians(37.0) / 2)) AS n FROM points WHERE lat BETWEEN 10 AND 80 AND lon BETWEEN -100 AND 110)))"""


@query(with_views(_LCC, "points"))
def grd_06_lambert_conformal(spark, d):
    p = points(spark, d).where("lat BETWEEN 10 AND 80 AND lon BETWEEN -100 AND 110")
    x, y = grid.lonlat_to_lcc(F.col("lon"), F.col("lat"), 37.0, 43.0, 40.0, 5.0)
    return p.select("point_id", r(x / 1000, 4).alias("x_km"), r(y / 1000, 4).alias("y_km"))


@query(with_views("SELECT point_id, round(6371.0 * cos(radians(20.0)) * radians(lon), 4) AS x_km, round(6371.0 * cos(radians(20.0)) * ln(tan(pi() / 4 + radians(lat) / 2)), 4) AS y_km, round(lon, 4) AS lon, round(lat, 4) AS lat FROM points WHERE abs(lat) < 80", "points"))
def grd_07_mercator(spark, d):
    p = points(spark, d).where(F.abs("lat") < 80)
    x, y = grid.lonlat_to_mercator(F.col("lon"), F.col("lat"), 20.0, 0.0)
    lon, lat = grid.mercator_to_lonlat(x, y, 20.0, 0.0)
    return p.select("point_id", r(x / 1000, 4).alias("x_km"), r(y / 1000, 4).alias("y_km"), r(lon, 4).alias("lon"), r(lat, 4).alias("lat"))


@query(with_views("""SELECT point_id, round(k * cos(y) * sin(x) / 1000, 3) AS x_km, round(k * (cos(p) * sin(y) - sin(p) * cos(y) * cos(x)) / 1000, 3) AS y_km, round(lon, 4) AS lon, round(lat, 4) AS lat
 FROM (SELECT *, 6371000.0 * sqrt(2 / (1 + sin(p) * sin(y) + cos(p) * cos(y) * cos(x))) AS k FROM (SELECT *, radians(52.0) AS p, radians(lat) AS y, radians(lon - 10.0) AS x FROM points WHERE lat BETWEEN 0 AND 80 AND lon BETWEEN -60 AND 80))""", "points"))
def grd_08_azimuthal_equal_area(spark, d):
    p = points(spark, d).where("lat BETWEEN 0 AND 80 AND lon BETWEEN -60 AND 80")
    x, y = grid.lonlat_to_laea(F.col("lon"), F.col("lat"), 52.0, 10.0)
    lon, lat = grid.laea_to_lonlat(x, y, 52.0, 10.0)
    return p.select("point_id", r(x / 1000, 3).alias("x_km"), r(y / 1000, 3).alias("y_km"), r(lon, 4).alias("lon"), r(lat, 4).alias("lat"))


@query("""WITH a AS (SELECT DISTINCT l_suppkey % 10 AS k, (l_partkey % 40) * (CASE WHEN l_suppkey % 10 = 3 THEN l_partkey % 40 ELSE 1 END) * 0.5::DOUBLE AS x FROM lineitem),
 b AS (SELECT *, (max(x) OVER w - min(x) OVER w) / (count(*) OVER w - 1) AS inc, lead(x) OVER (PARTITION BY k ORDER BY x) - x AS gap FROM a WINDOW w AS (PARTITION BY k)),
 c AS (SELECT *, max(abs(gap - inc)) OVER (PARTITION BY k) <= 1e-6 * abs(inc) AS u FROM b)
 SELECT CAST(k AS BIGINT) AS axis, x, CASE WHEN u THEN x - inc / 2 END AS lower, CASE WHEN u THEN x + inc / 2 END AS upper FROM c""")
def grd_10_axis_bounds(spark, d):
    li = load(spark, d, "lineitem")
    x = (F.col("l_partkey") % 40) * F.when(F.col("l_suppkey") % 10 == 3, F.col("l_partkey") % 40).otherwise(1) * 0.5
    return grid.axis_bounds(li.select((F.col("l_suppkey") % 10).alias("axis"), x.alias("x")), "axis", "x")


_SIDE = "2 * asin(sqrt(pow(sin(radians(({b1}) - ({a1})) / 2), 2) + cos(radians({a1})) * cos(radians({b1})) * pow(sin(radians(({b0}) - ({a0})) / 2), 2)))"


def _lhuilier(p: tuple, q: tuple, s: tuple) -> str:
    a, b, c = (_SIDE.format(a0=u[0], a1=u[1], b0=v[0], b1=v[1]) for u, v in ((p, q), (q, s), (s, p)))
    return f"(SELECT 4 * atan(sqrt(greatest(tan(h / 2) * tan((h - a) / 2) * tan((h - b) / 2) * tan((h - c) / 2), 0))) FROM (SELECT (a + b + c) / 2 AS h, a, b, c FROM (SELECT {a} AS a, {b} AS b, {c} AS c)))"


_BOX = (("lon", "lat"), ("lon + 0.5", "lat"), ("lon + 0.5", "lat + 0.25"), ("lon", "lat + 0.25"))


@query(with_views(f"SELECT point_id, round(({_lhuilier(_BOX[0], _BOX[1], _BOX[2])} + {_lhuilier(_BOX[0], _BOX[2], _BOX[3])}) * 40589641.0, 2) AS area_km2 FROM points WHERE abs(lat) < 89", "points"))
def grd_13_cell_area(spark, d):
    p = points(spark, d).where(F.abs("lat") < 89)
    ring = F.array(*[F.struct((F.col("lon") + a).alias("x"), (F.col("lat") + b).alias("y")) for a, b in ((0.0, 0.0), (0.5, 0.0), (0.5, 0.25), (0.0, 0.25))])
    return p.select("point_id", r(grid.ring_area(ring) / 1e6, 2).alias("area_km2"))


@query(with_views("SELECT point_id, round(6371.0 * radians(lon), 5) AS x_km, round(6371.0 * sin(radians(lat)), 5) AS y_km FROM points", "points"))
def grd_16_equal_area_plane(spark, d):
    x, y = grid.equal_area_xy(F.col("lon"), F.col("lat"))
    return points(spark, d).select("point_id", r(x / 1000, 5).alias("x_km"), r(y / 1000, 5).alias("y_km"))


@query(with_views("SELECT CAST((fid // 72 + 2) * 76 + fid % 72 + 2 AS BIGINT) AS fid, round(sum(flux), 4) AS value FROM flux GROUP BY 1", "flux"))
def grd_17_expand(spark, d):
    return grid.expand(flux(spark, d), 2, 36, 72).groupBy("fid").agg(r(F.sum("flux"), 4).alias("value"))


@query(with_views("SELECT CAST((fid // 72 - 3) * 66 + fid % 72 - 3 AS BIGINT) AS fid, round(sum(flux), 4) AS value FROM flux WHERE fid // 72 BETWEEN 3 AND 32 AND fid % 72 BETWEEN 3 AND 68 GROUP BY 1", "flux"))
def grd_18_contract(spark, d):
    return grid.contract(flux(spark, d), 3, 36, 72).groupBy("fid").agg(r(F.sum("flux"), 4).alias("value"))


@query(with_views("SELECT pollutant, round(min(lon), 4) AS lon_min, round(max(lon), 4) AS lon_max, round(min(lat), 4) AS lat_min, round(max(lat), 4) AS lat_max FROM points GROUP BY 1", "points"))
def grd_19_bounding_box(spark, d):
    b = grid.bbox(points(spark, d), "pollutant")
    return b.select("pollutant", *[r(c, 4).alias(c) for c in ("lon_min", "lon_max", "lat_min", "lat_max")])


# Filters ---------------------------------------------------------------------------------------


@query(with_views("SELECT variable, fid, CAST(epoch(ts) // 3600 AS BIGINT) AS hour_no, round(value, 6) AS value FROM field WHERE ts >= TIMESTAMP '2024-01-05 07:00:00' AND ts <= TIMESTAMP '2024-01-09 18:00:00' AND fid BETWEEN 3 AND 12", "field"))
def flt_01_slice(spark, d):
    f = filters.select_range(field(spark, d), "ts", "2024-01-05 07:10:00", "2024-01-09 17:50:00")
    return filters.select_range(f, "fid", 3, 12).select("variable", "fid", hour_no().alias("hour_no"), r("value").alias("value"))


@query(with_views("SELECT variable, fid, round(value, 6) AS value FROM field WHERE ts = (SELECT max(ts) FROM field)", "field"))
def flt_03_last_step(spark, d):
    return filters.last_time_step(field(spark, d)).select("variable", "fid", r("value").alias("value"))


@query(with_views("SELECT variable, count(*) AS n, round(sum(value), 4) AS total FROM field WHERE ts >= (SELECT min(ts) FROM field) + INTERVAL 24 HOUR AND ts <= (SELECT max(ts) FROM field) - INTERVAL 48 HOUR AND variable <> 'error' GROUP BY 1", "field"))
def flt_05_drop_ends_and_variables(spark, d):
    f = filters.drop_variables(filters.select_hours(field(spark, d), 24, 48), ["error"])
    return f.groupBy("variable").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query(with_views("""WITH m AS (SELECT point_id, CASE WHEN l > 180 THEN l - 360 ELSE l END AS lon FROM (SELECT point_id, (point_id * 7) % 360 + 0.5::DOUBLE AS l FROM points)),
 a AS (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS c FROM (SELECT DISTINCT lon FROM m)) SELECT point_id, lon, CAST(c AS INTEGER) AS col_i FROM m JOIN a USING (lon)""", "points"))
def flt_06_signed_longitudes(spark, d):
    p = points(spark, d).select("point_id", ((F.col("point_id") * 7) % 360 + 0.5).alias("lon"), F.lit(0).alias("col_i"))
    return filters.reorder_longitudes(p).select("point_id", "lon", "col_i")


@query(with_views("SELECT CAST(11 - (month_i - 1) AS INTEGER) AS lev, pollutant, round(CAST(sum(flux) AS FLOAT), 1) AS value FROM flux GROUP BY 1, 2", "flux"))
def flt_07_reverse_levels_float(spark, d):
    f = flux(spark, d).groupBy((F.col("month_i") - 1).alias("lev"), "pollutant").agg(F.sum("flux").alias("value"))
    return filters.to_type(filters.reverse_levels(f), "float").select(F.col("lev").cast("int").alias("lev"), "pollutant", F.round("value", 1).alias("value"))


@query(with_views("SELECT variable, round(sum(value * (1 - (fid % 5) / 4.0::DOUBLE)), 4) AS total, CAST(sum(CASE WHEN (fid % 5) / 4.0 > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_outside FROM field GROUP BY 1", "field"))
def flt_09_inverse_mask(spark, d):
    f = field(spark, d)
    mask = f.select("fid").distinct().withColumn("mask", F.col("fid") % 5 / 4.0)
    return filters.apply_mask(f, mask, inverse=True).groupBy("variable").agg(r(F.sum("value"), 4).alias("total"), F.count_if("outside").alias("n_outside"))


@query(with_views("SELECT p.pollutant, count(*) AS n FROM points p, (SELECT min(lon) AS a, max(lon) AS b, min(lat) AS c, max(lat) AS e FROM points WHERE pollutant = 'P' AND lat > 40 AND lat < 60 AND lon > 0 AND lon < 30) WHERE lon BETWEEN a - 0.1 AND b + 0.1 AND lat BETWEEN c - 0.1 AND e + 0.1 GROUP BY 1", "points"))
def flt_10_sources_near_domain(spark, d):
    p = points(spark, d)
    return filters.inside_bbox(p, grid.bbox(p.where("pollutant = 'P' AND lat > 40 AND lat < 60 AND lon > 0 AND lon < 30"))).groupBy("pollutant").agg(F.count("*").alias("n"))


@query(with_views("SELECT pollutant, count(*) AS n, round(sum(flux), 4) AS flux FROM flux f WHERE EXISTS (SELECT 1 FROM flux g WHERE g.fid = f.fid AND g.pollutant = 1 AND g.flux > 40) GROUP BY 1", "flux"))
def flt_12_positive_sources(spark, d):
    f = flux(spark, d)
    hot = f.where((F.col("pollutant") == 1) & (F.col("flux") > 40)).select("fid").distinct()
    return filters.positive_sources(f.join(hot, "fid", "left_semi"), 1).groupBy("pollutant").agg(F.count("*").alias("n"), r(F.sum("flux"), 4).alias("flux"))


@query(with_views("SELECT variable, CAST(min(g) AS BIGINT) AS interval_s FROM (SELECT variable, epoch(lead(ts) OVER (PARTITION BY variable ORDER BY ts)) - epoch(ts) AS g FROM (SELECT DISTINCT variable, ts FROM field)) GROUP BY 1", "field"))
def flt_15_time_interval(spark, d):
    return filters.time_interval(field(spark, d), "variable")


@query(with_views("SELECT pollutant, count(*) AS n FROM (SELECT pollutant, (lon + 360) % 360 AS l FROM points) WHERE l >= 350 OR l <= 12.5 GROUP BY 1", "points"))
def flt_16_across_seam(spark, d):
    p = points(spark, d).withColumn("l", F.pmod(F.col("lon") + 360, F.lit(360.0)))
    return p.where(filters.across_seam(F.col("l"), -10.0, 12.5)).groupBy("pollutant").agg(F.count("*").alias("n"))


# Statistics ------------------------------------------------------------------------------------


@query(with_views("SELECT sector, pollutant, fid, round(sum(flux), 4) AS value FROM flux GROUP BY 1, 2, 3", "flux"))
def agg_01_sum_inventories(spark, d):
    f = flux(spark, d).withColumnRenamed("flux", "value")
    parts = [f.where(F.col("inventory") == i).select("sector", "pollutant", "fid", "value") for i in ("A", "N", "R")]
    return stats.sum_inventories(*parts, keys=("sector", "pollutant", "fid")).withColumn("value", r("value", 4))


@query(with_views("SELECT variable, round(sum(CASE WHEN fid = 3 THEN 0 ELSE value END), 4) AS total, round(min(CASE WHEN fid <> 3 THEN value END), 6) AS min_value, round(max(CASE WHEN fid <> 3 THEN value END), 6) AS max_value FROM field GROUP BY 1", "field"))
def agg_03_totals_and_extremes(spark, d):
    f = field(spark, d).withColumn("value", F.when(F.col("fid") == 3, float("nan")).otherwise(F.col("value")))
    return stats.totals(f).join(stats.extremes(f), "variable").select("variable", r("total", 4).alias("total"), r("min_value").alias("min_value"), r("max_value").alias("max_value"))


@query(with_views("SELECT variable, fid, CAST(date_part('doy', ts) AS INTEGER) AS julian, round(avg(value), 6) AS mean_value FROM field WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM field GROUP BY 1 HAVING count(DISTINCT ts) > 1) GROUP BY 1, 2, 3", "field"))
def agg_05_daily_mean(spark, d):
    return stats.daily_statistic(field(spark, d), "nanmean").select("variable", "fid", F.dayofyear("day").alias("julian"), r("value").alias("mean_value"))


@query(with_views("SELECT variable, fid, CASE WHEN fid = 5 THEN 'NaN'::DOUBLE ELSE round(max(value), 6) END AS max_value FROM field WHERE ts > (SELECT min(ts) FROM field) GROUP BY 1, 2", "field"))
def agg_07_maximum_without_first(spark, d):
    f = field(spark, d).withColumn("value", F.when((F.col("fid") == 5) & (F.hour("ts") == 7), float("nan")).otherwise(F.col("value")))
    f = f.unionByName(f.where("fid = 5").withColumn("value", F.lit(float("nan"))))
    return stats.daily_statistic(f, "max", "withoutt0").select("variable", "fid", r("value").alias("max_value"))


@query(with_views("SELECT inventory, sector, pollutant, fid, round(sum(flux), 4) AS value, CAST(min(month_i) AS INTEGER) AS month_i FROM flux GROUP BY 1, 2, 3, 4", "flux"))
def agg_08_sum_axis(spark, d):
    return stats.sum_axis(flux(spark, d).withColumnRenamed("flux", "value"), "month_i").withColumn("value", r("value", 4))


@query("""SELECT CAST(month(o_orderdate) AS INTEGER) AS month_i, o_orderstatus AS pollutant, round(sum(o_totalprice), 2) AS emis FROM orders GROUP BY 1, 2""")
def agg_12_monthly_sum(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderdate").alias("ts"), F.col("o_orderstatus").alias("pollutant"), F.col("o_totalprice").alias("emis"))
    return stats.monthly_sum(o, "pollutant", value="emis").withColumn("emis", r("emis", 2))


@query(with_views("SELECT variable, fid, round(sum(value) * 1.5, 4) AS value FROM field WHERE variable <> 'view' GROUP BY 1, 2 UNION ALL SELECT variable, fid, round(sum(value), 4) FROM field WHERE variable = 'view' GROUP BY 1, 2", "field"))
def agg_15_add_fields(spark, d):
    f = field(spark, d).groupBy("variable", "fid").agg(F.sum("value").alias("value"))
    return stats.add_fields(f, f.where("variable <> 'view'").withColumn("value", F.col("value") / 2)).withColumn("value", r("value", 4))


@query(with_views("""SELECT variable, fid, CAST(epoch(ts) // 3600 AS BIGINT) AS hour_no, CASE WHEN first = epoch(ts) - 3 * 3600 THEN round(m, 6) END AS value
 FROM (SELECT *, avg(value) OVER w AS m, min(epoch(ts)) OVER w AS first FROM field WINDOW w AS (PARTITION BY variable, fid ORDER BY epoch(ts) RANGE BETWEEN 10800 PRECEDING AND 1 PRECEDING))""", "field"))
def win_01_rolling_mean(spark, d):
    return stats.rolling_mean(field(spark, d), 4).select("variable", "fid", hour_no().alias("hour_no"), r("value").alias("value"))


@query(with_views("SELECT sector, pollutant, month_i AS lev, round(sum(flux) OVER (PARTITION BY sector, pollutant ORDER BY month_i), 3) AS top FROM (SELECT sector, pollutant, month_i, sum(flux) AS flux FROM flux GROUP BY 1, 2, 3)", "flux"))
def win_06_layer_heights(spark, d):
    t = flux(spark, d).groupBy("sector", "pollutant", F.col("month_i").alias("lev")).agg(F.sum("flux").alias("thickness"))
    again = stats.layer_thickness(stats.layer_heights(t, "sector", "pollutant").drop("thickness"), "sector", "pollutant")
    return stats.layer_heights(again.drop("top"), "sector", "pollutant").select("sector", "pollutant", "lev", r("top", 3).alias("top"))


@query(with_views("SELECT pollutant, min(g) AS increment FROM (SELECT pollutant, round(lead(x) OVER (PARTITION BY pollutant ORDER BY x) - x, 6) AS g FROM (SELECT DISTINCT pollutant, round(lat, 6) AS x FROM points)) WHERE g > 0 GROUP BY 1", "points"))
def win_09_grid_increment(spark, d):
    return stats.grid_increment(points(spark, d), "lat", "pollutant")


# Comparison and sets ---------------------------------------------------------------------------


@query(with_views("""SELECT variable, count(*) AS n, CAST(sum(CASE WHEN a.value IS NULL OR b.value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, CAST(sum(CASE WHEN a.value = b.value THEN 1 ELSE 0 END) AS BIGINT) AS n_same, round(sum(b.value - a.value), 4) AS total, round(sum(100 * (b.value - a.value) / (a.value + 1)), 3) AS percent
 FROM (SELECT variable, fid, round(avg(value), 9) AS value FROM field WHERE fid < 15 GROUP BY 1, 2) a FULL JOIN (SELECT variable, fid, CASE WHEN fid % 3 = 0 THEN round(avg(value), 9) ELSE round(avg(value), 9) * 2 END AS value FROM field WHERE fid > 4 GROUP BY 1, 2) b USING (variable, fid) GROUP BY 1""", "field"))
def jon_21_difference(spark, d):
    m = field(spark, d).groupBy("variable", "fid").agg(r(F.avg("value"), 9).alias("value"))  # equal whatever the order of the sum
    a, b = m.where("fid < 15"), m.where("fid > 4").withColumn("value", F.when(F.col("fid") % 3 == 0, F.col("value")).otherwise(F.col("value") * 2))
    x = compare.difference(a, b, ("variable", "fid"))
    y = compare.percent_difference(a, b, 1.0, ("variable", "fid")).groupBy("variable").agg(r(F.sum("value"), 3).alias("percent"))
    return x.groupBy("variable").agg(F.count("*").alias("n"), F.count_if("missing").alias("n_missing"), F.count_if("identical").alias("n_same"), r(F.sum("value"), 4).alias("total")).join(y, "variable")


@query("""SELECT p_type AS variable, 'both' AS side FROM (SELECT DISTINCT o_orderpriority AS p_type FROM orders WHERE o_orderkey % 3 = 0 INTERSECT SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus = 'F')
 UNION ALL SELECT * FROM (SELECT DISTINCT event_type, 'new' FROM events WHERE event_type NOT IN (SELECT o_orderpriority FROM orders))""")
def set_01_variables(spark, d):
    o, e = load(spark, d, "orders"), load(spark, d, "events")
    a = o.where("o_orderkey % 3 = 0").select(F.col("o_orderpriority").alias("variable"))
    both = compare.common_variables(a, o.where("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("variable")))
    new = compare.missing_codes(e.select(F.col("event_type").alias("variable")), o.select(F.col("o_orderpriority").alias("variable")), "variable")
    return both.withColumn("side", F.lit("both")).unionByName(new.withColumn("side", F.lit("new")))


# Regridding ------------------------------------------------------------------------------------


@query(with_views("SELECT inventory, pollutant, dst_fid AS fid, round(sum(flux), 4) AS value FROM flux JOIN w ON fid = src_fid GROUP BY 1, 2, 3", "cells", "flux", "w"))
def jon_04_conservative_mass(spark, d):
    w = regrid.conservative_weights(cells(spark), COARSE)
    return regrid.apply_weights(flux(spark, d), w, "inventory", "pollutant", value="flux").select("inventory", "pollutant", "fid", r("flux", 4).alias("value"))


_SHIFT = """SELECT c.fid AS src_fid, CAST(y.j * 40 + x.i AS BIGINT) AS dst_fid, (least(c.lon_max, -180 + 9.0 * (x.i + 1)) - greatest(c.lon_min, -180 + 9.0 * x.i)) / 5.0 * (sin(radians(least(c.lat_max, -90 + 7.2 * (y.j + 1)))) - sin(radians(greatest(c.lat_min, -90 + 7.2 * y.j)))) / (sin(radians(c.lat_max)) - sin(radians(c.lat_min))) AS weight
 FROM cells c, range(40) x(i), range(25) y(j) WHERE least(c.lon_max, -180 + 9.0 * (x.i + 1)) > greatest(c.lon_min, -180 + 9.0 * x.i) AND least(c.lat_max, -90 + 7.2 * (y.j + 1)) > greatest(c.lat_min, -90 + 7.2 * y.j)"""


@query(with_views("SELECT pollutant, dst_fid AS fid, round(sum(flux * weight), 4) AS value FROM flux JOIN s ON fid = src_fid GROUP BY 1, 2 HAVING sum(flux * weight) > 0.001", "cells", "flux", s=_SHIFT))
def jon_05_conservative_any_grid(spark, d):
    w = regrid.conservative_weights(cells(spark), regrid.RegularGrid(-90.0, -180.0, 7.2, 9.0, 25, 40))
    return regrid.apply_weights(flux(spark, d), w, "pollutant", value="flux").where("flux > 0.001").select("pollutant", "fid", r("flux", 4).alias("value"))


#: A point of the equal-area plane.
_PLANE = "{{'x': 6371000.0 * radians({x}), 'y': 6371000.0 * sin(radians({y}))}}"


def _clipped(pairs: str, corners: int = 4) -> str:
    """SQL of the ``pairs``, ``ring`` cut by one edge of the counter-clockwise ``win`` after the other; area as ``area``."""
    steps = [f"p0 AS MATERIALIZED ({pairs})"]
    new = "{'x': ring[i].x + s[i] / (s[i] - s[i % len(s) + 1]) * (ring[i % len(s) + 1].x - ring[i].x), 'y': ring[i].y + s[i] / (s[i] - s[i % len(s) + 1]) * (ring[i % len(s) + 1].y - ring[i].y)}"
    cut = f"flatten(list_transform(range(1, len(ring) + 1), lambda i: CASE WHEN s[i] >= 0 AND s[i % len(s) + 1] >= 0 THEN [ring[i]] WHEN s[i] >= 0 THEN [ring[i], {new}] WHEN s[i % len(s) + 1] >= 0 THEN [{new}] ELSE [] END))"
    for k in range(1, corners + 1):
        a, b = f"win[{k}]", f"win[{k % corners + 1}]"
        steps.append(f"s{k} AS MATERIALIZED (SELECT *, list_transform(ring, lambda p: ({b}.x - {a}.x) * (p.y - {a}.y) - ({b}.y - {a}.y) * (p.x - {a}.x)) AS s FROM p{k - 1})")
        steps.append(f"p{k} AS MATERIALIZED (SELECT * EXCLUDE (s) REPLACE ({cut} AS ring) FROM s{k})")
    area = "list_sum(list_transform(range(1, len(ring) + 1), lambda i: (ring[i].x - ring[1].x) * (ring[i % len(ring) + 1].y - ring[1].y) - (ring[i % len(ring) + 1].x - ring[1].x) * (ring[i].y - ring[1].y)))"
    return f"WITH {', '.join(steps)} SELECT *, coalesce({area}, 0) / 2 AS area FROM p{corners}"


def _projected(n_x: int, n_y: int, x_0: float, y_0: float, inc_x: float, inc_y: float, lon: str, lat: str) -> str:
    """SQL of the weights from the fine cells to a projected grid; ``lon`` and ``lat`` of native x and y."""
    native = [{"x": f"({x_0!r}::DOUBLE + (i + {a}) * {inc_x!r}::DOUBLE)", "y": f"({y_0!r}::DOUBLE + (j + {b}) * {inc_y!r}::DOUBLE)"} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]
    corners = ", ".join(f"{{'lon': {lon.format(**p)}, 'lat': {lat.format(**p)}}}" for p in native)
    grid = f"SELECT CAST(j * {n_x} + i AS BIGINT) AS dst_fid, [{corners}] AS c FROM range({n_x}) x(i), range({n_y}) y(j)"
    wrap = "({0} - 360 * floor(({0} + 180) / 360))"
    near = f"SELECT fid AS src_fid, dst_fid, lon_min, lon_max, lat_min, lat_max, list_transform(c, lambda p: {{'lon': lon_min + {wrap.format('c[1].lon - lon_min')} + {wrap.format('p.lon - c[1].lon')}, 'lat': p.lat}}) AS c FROM cells, ({grid})"
    box = ", ".join(_PLANE.format(x=x, y=y) for x, y in (("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max")))
    touch = "list_max(list_transform(c, lambda p: p.lon)) > lon_min AND list_min(list_transform(c, lambda p: p.lon)) < lon_max AND list_max(list_transform(c, lambda p: p.lat)) > lat_min AND list_min(list_transform(c, lambda p: p.lat)) < lat_max"
    pairs = f"SELECT src_fid, dst_fid, 6371000.0 * 6371000.0 * radians(lon_max - lon_min) * (sin(radians(lat_max)) - sin(radians(lat_min))) AS whole, [{box}] AS ring, list_transform(c, lambda p: {_PLANE.format(x='p.lon', y='p.lat')}) AS win FROM ({near}) WHERE {touch}"
    return f"SELECT src_fid, dst_fid, area / whole AS weight FROM ({_clipped(pairs)}) WHERE area / whole > 1e-12"


_REGRIDDED = "SELECT dst_fid AS fid, round(sum(coalesce(flux, 0) * weight), 4) AS value, round(sum(weight), 6) AS weight FROM v LEFT JOIN (SELECT fid AS src_fid, sum(flux) AS flux FROM flux GROUP BY 1) USING (src_fid) GROUP BY 1"
ROTATED = regrid.ProjectedGrid.rotated(46.0, 12.0, -18.0, -16.0, 3.2, 2.4)  # edges from -19.2 and -17.6
LAMBERT = regrid.ProjectedGrid.lambert(35.0, 55.0, 45.0, 174.0, 9, 8, 400_000.0, 400_000.0, -1_900_000.0, -1_500_000.0)
_ROTATED = _projected(
    ROTATED.n_x, ROTATED.n_y, -19.2, -17.6, 2.4, 3.2,
    "12.0 + degrees(atan2(cos(radians({y})) * sin(radians({x})), cos(radians(46.0)) * cos(radians({y})) * cos(radians({x})) - sin(radians(46.0)) * sin(radians({y}))))",
    "degrees(asin(sin(radians(46.0)) * cos(radians({y})) * cos(radians({x})) + cos(radians(46.0)) * sin(radians({y}))))",
)
_N = "(ln(cos(radians(35.0)) / cos(radians(55.0))) / ln(tan(pi() / 4 + radians(55.0) / 2) / tan(pi() / 4 + radians(35.0) / 2)))"
_K = f"(6371000.0 * cos(radians(35.0)) * pow(tan(pi() / 4 + radians(35.0) / 2), {_N}) / {_N})"
_R0 = f"({_K} / pow(tan(pi() / 4 + radians(45.0) / 2), {_N}))"
_LAMBERT = _projected(
    9, 8, -1_900_000.0, -1_500_000.0, 400_000.0, 400_000.0,
    f"174.0 + degrees(atan2({{x}}, {_R0} - {{y}}) / {_N})",
    f"degrees(2 * atan(pow({_K} / sqrt({{x}} * {{x}} + ({_R0} - {{y}}) * ({_R0} - {{y}})), 1 / {_N})) - pi() / 2)",
)


def _regridded(spark: SparkSession, d: str, grid: regrid.ProjectedGrid) -> DataFrame:
    f = flux(spark, d).groupBy(F.col("fid").alias("src_fid")).agg(F.sum("flux").alias("flux"))
    w = regrid.overlap_weights(cells(spark), grid).join(f, "src_fid", "left")
    return w.groupBy(F.col("dst_fid").alias("fid")).agg(r(F.sum(F.coalesce("flux", F.lit(0)) * F.col("weight")), 4).alias("value"), r(F.sum("weight")).alias("weight"))


@query(with_views(_REGRIDDED, "cells", "flux", v=_ROTATED))
def jon_04_rotated_target(spark, d):
    return _regridded(spark, d, ROTATED)


@query(with_views(_REGRIDDED, "cells", "flux", v=_LAMBERT))
def jon_04_lambert_target_across_seam(spark, d):
    return _regridded(spark, d, LAMBERT)


@query(with_views("SELECT pollutant, f.dst_fid AS fid, round(sum(flux * s.area_m2 / t.area_m2), 6) AS flux FROM (SELECT pollutant, fid, sum(flux) AS flux, any_value(dst_fid) AS dst_fid FROM flux JOIN w ON fid = src_fid GROUP BY 1, 2) f JOIN cells s USING (fid) JOIN coarse t ON t.fid = f.dst_fid GROUP BY 1, 2", "cells", "coarse", "flux", "w"))
def jon_16_flux_weights(spark, d):
    src, dst = cells(spark), cells(spark, COARSE)
    w = regrid.mass_to_flux(regrid.conservative_weights(src, COARSE), src, dst)
    return regrid.apply_weights(flux(spark, d), w, "pollutant", value="flux").select("pollutant", "fid", r("flux").alias("flux"))


@query(with_views("SELECT point_id, CAST(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS fid FROM points", "points"))
def jon_07_point_owner(spark, d):
    return regrid.owned_points(points(spark, d), FINE).select("point_id", "fid")


@query(with_views("""SELECT src_fid, dst_fid, round(part / sum(part) OVER (PARTITION BY src_fid), 6) AS weight FROM (SELECT CAST(floor((lat + 90) / 10) * 36 + floor((lon + 180) / 10) AS BIGINT) AS src_fid, CAST(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS dst_fid, sum(emis) AS part FROM points WHERE height_m % 5 <> 0 GROUP BY 1, 2)""", "points"))
def jon_10_points_proxy(spark, d):
    p = points(spark, d).withColumn("weight", F.when(F.col("height_m") % 5 == 0, -1.0).otherwise(F.col("emis")))
    return regrid.points_proxy(regrid.read_proxy(p, "weight"), COARSE, FINE).withColumn("weight", r("weight"))


_CELL10 = "CAST(floor((lat + 90) / 10) * 36 + floor((lon + 180) / 10) AS BIGINT)"


@query(with_views("""WITH p AS (SELECT src_fid, dst_fid, part / sum(part) OVER (PARTITION BY src_fid) AS weight FROM (SELECT CAST(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS src_fid, CAST(floor((lat + 90) / 10) * 36 + floor((lon + 180) / 10) AS BIGINT) AS dst_fid, sum(emis) AS part FROM points WHERE lat > 30 GROUP BY 1, 2)),
 a AS (SELECT * FROM p UNION ALL SELECT * FROM w WHERE src_fid NOT IN (SELECT src_fid FROM p)) SELECT pollutant, dst_fid AS fid, round(sum(flux * weight), 4) AS value FROM flux JOIN a ON fid = src_fid GROUP BY 1, 2""", "cells", "flux", "points", "w"))
def jon_15_priority_chain(spark, d):
    proxy = regrid.points_proxy(points(spark, d).where("lat > 30").withColumn("weight", F.col("emis")), FINE, COARSE)
    w = regrid.priority_weights(cells(spark), [proxy], COARSE)
    return regrid.apply_weights(flux(spark, d), w, "pollutant", value="flux").select("pollutant", "fid", r("flux", 4).alias("value"))


@query(with_views("""WITH px AS (SELECT CAST(l_partkey % 180 AS INTEGER) AS "col", CAST(l_suppkey % 90 AS INTEGER) AS "row", sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
 s AS (SELECT CAST(("row" * 2 // 10) * 36 + "col" * 2 // 10 AS BIGINT) AS src_fid, value, "row" * 2.0::DOUBLE - 90 AS y, "col" * 2.0::DOUBLE - 180 AS x FROM px),
 c AS (SELECT src_fid, value, y, x, unnest([floor((y + 90) / 5), floor((y + 2 + 90) / 5 - 1e-9)]) AS j FROM s), e AS (SELECT DISTINCT * FROM c),
 g AS (SELECT DISTINCT *, i FROM (SELECT *, unnest([floor((x + 180) / 5), floor((x + 2 + 180) / 5 - 1e-9)]) AS i FROM e)),
 h AS (SELECT src_fid, CAST(j * 72 + i AS BIGINT) AS dst_fid, sum(value * (least(x + 2, i * 5 - 175) - greatest(x, i * 5 - 180)) / 2 * (sin(radians(least(y + 2, j * 5 - 85))) - sin(radians(greatest(y, j * 5 - 90)))) / (sin(radians(y + 2)) - sin(radians(y)))) AS part FROM g GROUP BY 1, 2)
 SELECT src_fid, dst_fid, round(part / sum(part) OVER (PARTITION BY src_fid), 6) AS weight FROM h"""))
def jon_14_raster_proxy(spark, d):
    px = load(spark, d, "lineitem").groupBy((F.col("l_partkey") % 180).cast("int").alias("col"), (F.col("l_suppkey") % 90).cast("int").alias("row")).agg(F.sum("l_quantity").alias("value"))
    return regrid.raster_proxy(regrid.raster_pixels(px, -180.0, -90.0, 2.0, 2.0, nodata=-9999.0), COARSE, FINE).withColumn("weight", r("weight"))


# Vector layers ---------------------------------------------------------------------------------


def regions_layer(spark: SparkSession, d: str) -> DataFrame:
    """A diamond of a 12.03 degree half-width (no point lies on its border) for each nation, at a place that follows from its key."""
    n = load(spark, d, "nation")
    x, y = (F.col("n_nationkey") * 61 % 300 - 150.0), (F.col("n_nationkey") * 37 % 130 - 65.0)
    ring = F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((-12.03, 0.0), (0.0, -12.03), (12.03, 0.0), (0.0, 12.03))])
    return n.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), ring.alias("ring"), x.alias("cx"), y.alias("cy"))


_LAYER = "SELECT n_name AS name, n_regionkey AS region, (n_nationkey * 61) % 300 - 150.0::DOUBLE AS cx, (n_nationkey * 37) % 130 - 65.0::DOUBLE AS cy, 12.03::DOUBLE AS w, 1 AS sign FROM nation"


@query(with_views("SELECT p.point_id, min(l.name) AS name FROM points p LEFT JOIN layer l ON abs(p.lon - l.cx) + abs(p.lat - l.cy) < 12.03 GROUP BY 1", "points", layer=_LAYER))
def jon_02_centroid_within(spark, d):
    p = points(spark, d).select(F.col("point_id").alias("fid"), "lon", "lat")
    return spatial.centroid_join(p, regions_layer(spark, d), "name").select(F.col("fid").alias("point_id"), "name")


@query(with_views("""SELECT point_id, round(b.d, 4) AS distance, b.name AS name FROM (SELECT point_id, min({'d': round(CASE WHEN u <= 12.03 THEN 0 WHEN abs(x - y) <= 12.03 THEN (u - 12.03) / sqrt(2) ELSE sqrt(pow(greatest(x, y) - 12.03, 2) + pow(least(x, y), 2)) END, 9), 'name': name}) AS b
 FROM (SELECT point_id, name, abs(lon - cx) AS x, abs(lat - cy) AS y, abs(lon - cx) + abs(lat - cy) AS u FROM points, (SELECT name, cx + unnest([-360, 0, 360]) AS cx, cy FROM layer)) GROUP BY 1)""", "points", layer=_LAYER))
def jon_01_nearest_polygon(spark, d):
    p = points(spark, d).select(F.col("point_id").alias("fid"), "lon", "lat")
    near = spatial.nearest_join(p, regions_layer(spark, d), "name")
    return near.select(F.col("fid").alias("point_id"), r("distance", 4).alias("distance"), "name")


#: Area of diamonds of half-width w within a cell: trapezoids between all places where the height of the cut can
#: bend, a feature's holes (sign -1) less its shells.
_OVERLAPS = """SELECT fid, name, sum(sign * list_sum(list_transform(range(1, len(b)), lambda i: (b[i + 1] - b[i]) * (h[i] + h[i + 1]) / 2))) AS overlap
 FROM (SELECT *, list_transform(b, lambda x: greatest(0, least(y1, w - abs(x)) - greatest(y0, abs(x) - w))) AS h
 FROM (SELECT *, list_sort(list_transform([x0, x1, 0, -w, w, w - abs(y0), abs(y0) - w, w - abs(y1), abs(y1) - w], lambda x: least(greatest(x, x0), x1))) AS b
 FROM (SELECT fid, name, w, sign, lon_min - cx AS x0, lon_max - cx AS x1, lat_min - cy AS y0, lat_max - cy AS y1 FROM cells, layer)
 WHERE greatest(0, x0, -x1) + greatest(0, y0, -y1) <= w)) GROUP BY 1, 2"""
_MASK = """SELECT fid, b.name AS name FROM cells LEFT JOIN (SELECT fid, min({'o': -round(overlap, 9), 'name': name}) AS b
 FROM (SELECT *, count(*) OVER (PARTITION BY fid) AS n FROM parts) WHERE n = 1 OR overlap > 0 GROUP BY 1) USING (fid)"""


def diamond(x: Column, y: Column, w: float, back: bool = False) -> Column:
    corners = [(-w, 0.0), (0.0, -w), (w, 0.0), (0.0, w)]
    return F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in (corners[::-1] if back else corners)])


def holed_layer(spark: SparkSession, d: str) -> DataFrame:
    """Features of two parts: the nation's diamond with a hole, and a small diamond inside that hole's cell; a
    ring's direction differs from part to part and some are closed."""
    n, x, y = regions_layer(spark, d), F.col("cx"), F.col("cy")
    first = F.array(diamond(x, y, 12.03), F.concat(diamond(x, y, 7.01), F.array(F.struct((x - 7.01).alias("x"), y.alias("y")))))
    second = F.array(diamond(x + 1.5, y, 2.02, back=True))
    return polygons.rings(n.select("name", F.explode(F.array(first, second)).alias("rings")))


_HOLED = f"""SELECT name, cx, cy, w, sign FROM ({_LAYER}) UNION ALL SELECT name, cx, cy, 7.01, -1 FROM ({_LAYER}) UNION ALL SELECT name, cx + 1.5, cy, 2.02, 1 FROM ({_LAYER})"""


@query(with_views("SELECT name, pollutant, count(*) AS n, round(sum(flux), 4) AS flux, (SELECT round(sum(overlap), 5) FROM parts p WHERE p.name = mask.name) AS area FROM flux JOIN mask USING (fid) GROUP BY 1, 2", "cells", "flux", layer=_HOLED, parts=_OVERLAPS, mask=_MASK))
def jon_03_features_with_holes(spark, d):
    layer = holed_layer(spark, d)
    mask = spatial.largest_overlap(cells(spark), layer, "name").select("fid", "name")
    areas = spatial.overlaps(cells(spark), layer, "name").groupBy("name").agg(r(F.sum("overlap"), 5).alias("area"))
    out = flux(spark, d).join(mask, "fid").groupBy("name", "pollutant").agg(F.count("*").alias("n"), r(F.sum("flux"), 4).alias("flux"))
    return out.join(areas, "name", "left")


@query(with_views("SELECT point_id, min(name) AS name FROM points LEFT JOIN (SELECT point_id, name FROM points JOIN layer ON abs(lon - cx) + abs(lat - cy) < w GROUP BY 1, 2 HAVING sum(sign) > 0) USING (point_id) GROUP BY 1", "points", layer=_HOLED))
def jon_02_centroid_with_holes(spark, d):
    p = points(spark, d).select(F.col("point_id").alias("fid"), "lon", "lat")
    return spatial.centroid_join(p, holed_layer(spark, d), "name").select(F.col("fid").alias("point_id"), "name")


@query(with_views("SELECT name, pollutant, count(*) AS n, round(sum(flux), 4) AS flux FROM flux JOIN mask USING (fid) GROUP BY 1, 2", "cells", "flux", layer=_LAYER, parts=_OVERLAPS, mask=_MASK))
def jon_03_largest_overlap(spark, d):
    mask = spatial.largest_overlap(cells(spark), regions_layer(spark, d), "name").select("fid", "name")
    return flux(spark, d).join(mask, "fid").groupBy("name", "pollutant").agg(F.count("*").alias("n"), r(F.sum("flux"), 4).alias("flux"))


@query(with_views("SELECT CASE WHEN name IN ('NATION_1', 'NATION_2', 'NATION_3') THEN name WHEN name IS NOT NULL THEN 'OTHERS' END AS region_id, pollutant, round(sum(flux), 4) AS flux FROM flux JOIN mask USING (fid) GROUP BY 1, 2", "cells", "flux", layer=_LAYER, parts=_OVERLAPS, mask=_MASK))
def jon_18_region_mask(spark, d):
    wanted = ["NATION_1", "NATION_2", "NATION_3"]
    mask = spatial.region_mask(cells(spark), regions_layer(spark, d), "name", wanted)
    return flux(spark, d).join(mask, "fid").groupBy("region_id", "pollutant").agg(r(F.sum("flux"), 4).alias("flux"))


@query(with_views("SELECT name, round(sum(overlap), 5) AS area, round(sum(flux * overlap), 5) AS load FROM parts JOIN (SELECT fid, sum(flux) AS flux FROM flux GROUP BY 1) USING (fid) GROUP BY 1", "cells", "flux", layer=_LAYER, parts=_OVERLAPS))
def jon_12_polygon_overlap_areas(spark, d):
    parts = spatial.overlaps(cells(spark), regions_layer(spark, d), "name")
    f = flux(spark, d).groupBy("fid").agg(F.sum("flux").alias("flux"))
    return parts.join(f, "fid").groupBy("name").agg(r(F.sum("overlap"), 5).alias("area"), r(F.sum(F.col("flux") * F.col("overlap")), 5).alias("load"))


@query(with_views("SELECT name, CAST(pollutant AS VARCHAR) AS variable, round(sum(flux * overlap) / sum(overlap), 6) AS value FROM parts JOIN (SELECT fid, pollutant, sum(flux) AS flux FROM flux GROUP BY 1, 2) USING (fid) WHERE overlap > 0 GROUP BY 1, 2", "cells", "flux", layer=_LAYER, parts=_OVERLAPS))
def jon_23_field_on_features(spark, d):
    f = flux(spark, d).groupBy("fid", F.col("pollutant").cast("string").alias("variable")).agg(F.sum("flux").alias("value"))
    return spatial.grid_to_features(f, cells(spark), regions_layer(spark, d), "name").withColumn("value", r("value"))


_BOX = "[" + ", ".join(_PLANE.format(x=x, y=y) for x, y in (("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max"))) + "]"
_DIAMOND = "[" + ", ".join(_PLANE.format(x=x, y=y) for x, y in (("cx - w", "cy"), ("cx", "cy - w"), ("cx + w", "cy"), ("cx", "cy + w"))) + "]"
_PROXY_PARTS = _clipped(f"SELECT CAST((c.row_i // 2) * 36 + c.col_i // 2 AS BIGINT) AS src_fid, c.fid AS dst_fid, CAST(replace(name, 'NATION_', '') AS INTEGER) % 5 + 1 AS weight, sign, {_DIAMOND} AS ring, {_BOX} AS win FROM cells c, layer WHERE cx - w < lon_max AND cx + w > lon_min AND cy - w < lat_max AND cy + w > lat_min")
_PROXY = """SELECT src_fid, dst_fid, round(weight, 6) AS weight, coalesce(flux, 0) AS flux FROM (SELECT src_fid, dst_fid, part / sum(part) OVER (PARTITION BY src_fid) AS weight FROM (SELECT src_fid, dst_fid, sum(sign * weight * area) AS part FROM parts WHERE area > 0 GROUP BY 1, 2))
 LEFT JOIN (SELECT fid AS dst_fid, round(sum(flux), 4) AS flux FROM flux GROUP BY 1) USING (dst_fid) WHERE weight > 1e-9"""


@query(with_views(_PROXY, "cells", "flux", layer=_HOLED, parts=_PROXY_PARTS))
def jon_12_polygons_proxy(spark, d):
    layer = holed_layer(spark, d).withColumn("weight", F.regexp_extract("name", r"NATION_(\d+)", 1).cast("int") % 5 + 1.0)
    w = regrid.polygons_proxy(layer, COARSE, FINE).where("weight > 1e-9")
    f = flux(spark, d).groupBy(F.col("fid").alias("dst_fid")).agg(r(F.sum("flux"), 4).alias("flux"))
    return w.join(f, "dst_fid", "left").select("src_fid", "dst_fid", r("weight").alias("weight"), F.coalesce("flux", F.lit(0)).alias("flux"))


@query(with_views("SELECT name, 1.0::DOUBLE AS share, true AS covered, count(point_id) AS n FROM layer LEFT JOIN points ON abs(lon - cx) + abs(lat - cy) < 12.03 GROUP BY 1", "points", layer=_LAYER))
def set_04_regions_covered(spark, d):
    share = spatial.covered_share(cells(spark), regions_layer(spark, d), "name")
    inside = spatial.centroid_join(points(spark, d).select(F.col("point_id").alias("fid"), "lon", "lat"), regions_layer(spark, d), "name").groupBy("name").agg(F.count("*").alias("n"))
    return share.join(inside, "name", "left").select("name", r("share").alias("share"), "covered", F.coalesce("n", F.lit(0)).alias("n"))


@query(with_views("SELECT CASE WHEN c_nationkey % 4 = 3 THEN 'UNK' ELSE 'X' || c_nationkey END AS iso2, count(*) AS n FROM customer GROUP BY 1"))
def jon_26_iso2_of_iso3(spark, d):
    codes = load(spark, d, "nation").where("n_nationkey % 4 <> 3").select("n_name", F.col("n_name").alias("iso3"), F.concat(F.lit("X"), "n_nationkey").alias("iso2"))
    c = load(spark, d, "customer").select(F.concat(F.lit("NATION_"), "c_nationkey").alias("iso3"))
    return spatial.iso2_of(c, codes).groupBy("iso2").agg(F.count("*").alias("n"))


# Nearest neighbours and lines ------------------------------------------------------------------


def _ecef(table: str, key: str) -> str:
    return f"SELECT {key}, n * cos(a) * cos(o) AS x, n * cos(a) * sin(o) AS y, n * (1 - e2) * sin(a) AS z FROM (SELECT *, 6378137.0 / sqrt(1 - e2 * pow(sin(a), 2)) AS n FROM (SELECT {key}, radians(lat) AS a, radians(lon) AS o, 2 / 298.257223563 - pow(1 / 298.257223563, 2) AS e2 FROM {table}))"


#: The four nearest cells of each point, by brute force.
_NEAR = """SELECT point_id, min(g, 4) AS g, min_by(fid, g, 4) AS fids FROM (SELECT point_id, fid, greatest(sqrt((s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) + (s.z - t.z) * (s.z - t.z)), 1.0) AS g FROM s, t) GROUP BY 1"""


@query(with_views("SELECT point_id, round(g[1] / 1000, 3) AS nearest_km, round(list_sum(g) / 1000, 3) AS total_km, 1.0::DOUBLE AS weight FROM near", "cells", "points", s=_ecef("cells", "fid"), t=_ecef("points", "point_id"), near=_NEAR))
def jon_06_nearest_cells(spark, d):
    p = points(spark, d).select(F.col("point_id").alias("fid"), "lon", "lat")
    w = regrid.nearest_neighbours(cells(spark), p, 4)
    return w.groupBy(F.col("dst_fid").alias("point_id")).agg(r(F.min("distance") / 1000, 3).alias("nearest_km"), r(F.sum("distance") / 1000, 3).alias("total_km"), r(F.sum("weight"), 6).alias("weight"))


def road_lines(spark: SparkSession, d: str) -> DataFrame:
    """A road of two pieces for each supplier."""
    s = load(spark, d, "supplier")
    x, y = (F.col("s_suppkey") * 97 % 320 - 160.0), (F.col("s_suppkey") * 41 % 150 - 75.0)
    line = F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((0.0, 0.0), (6.3, 2.1), (9.4, 7.7))])
    return s.select(F.col("s_suppkey").cast("int").alias("link"), (F.col("s_suppkey") % 7 + 1.0).alias("weight"), line.alias("line"))


#: Roads cut at all lines of the fine grid: pieces with their cells, by where along the segment they begin and end.
_PIECES = {
    "seg": "SELECT link, weight, x + a AS x1, y + b AS y1, x + c AS x2, y + e AS y2 FROM (SELECT CAST(s_suppkey AS INTEGER) AS link, s_suppkey % 7 + 1.0::DOUBLE AS weight, s_suppkey * 97 % 320 - 160.0::DOUBLE AS x, s_suppkey * 41 % 150 - 75.0::DOUBLE AS y FROM supplier), (VALUES (0.0::DOUBLE, 0.0::DOUBLE, 6.3::DOUBLE, 2.1::DOUBLE), (6.3, 2.1, 9.4, 7.7)) v(a, b, c, e)",
    "cut": "SELECT *, unnest(t[:-2]) AS t0, unnest(t[2:]) AS t1 FROM (SELECT *, list_sort(list_concat([0.0, 1.0], list_filter(list_concat(list_transform(range(73), lambda i: (5 * i - 180 - x1) / (x2 - x1)), list_transform(range(37), lambda i: (5 * i - 90 - y1) / (y2 - y1))), lambda t: t > 0 AND t < 1))) AS t FROM seg)",
    "piece": "SELECT *, CAST((fid // 72 // 2) * 36 + fid % 72 // 2 AS BIGINT) AS src FROM (SELECT link, weight, x1 + t0 * (x2 - x1) AS x1, y1 + t0 * (y2 - y1) AS y1, x1 + t1 * (x2 - x1) AS x2, y1 + t1 * (y2 - y1) AS y2, CAST(floor((y1 + (t0 + t1) / 2 * (y2 - y1) + 90) / 5) * 72 + floor((x1 + (t0 + t1) / 2 * (x2 - x1) + 180) / 5) AS BIGINT) AS fid FROM cut WHERE t1 - t0 > 1e-12)",
}
_ON_ROADS = """part AS (SELECT fid, link, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) * weight) AS part FROM piece GROUP BY 1, 2),
 share AS (SELECT fid, link, part / sum(part) OVER (PARTITION BY fid) AS share FROM part),
 whole AS (SELECT link, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS whole FROM seg GROUP BY 1)"""


@query(with_views("""WITH f AS (SELECT pollutant, (fid // 72 // 2) * 36 + fid % 72 // 2 AS src, sum(flux) AS value FROM flux GROUP BY 1, 2),
 g AS (SELECT src, fid, sum(weight * 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2), 1.0)))) AS part FROM piece GROUP BY 1, 2)
 SELECT pollutant, fid, round(sum(value * share), 4) AS value FROM (SELECT src, fid, part / sum(part) OVER (PARTITION BY src) AS share FROM g) JOIN f USING (src) GROUP BY 1, 2""", "flux", **_PIECES))
def jon_11_lines_proxy(spark, d):
    w = regrid.lines_proxy(road_lines(spark, d), COARSE, FINE)
    f = flux(spark, d).groupBy(F.floor(F.floor(F.col("fid") / 72) / 2).alias("rr"), F.floor(F.col("fid") % 72 / 2).alias("cc"), "pollutant").agg(F.sum("flux").alias("value")).select((F.col("rr") * 36 + F.col("cc")).alias("fid"), "pollutant", "value")
    return regrid.apply_weights(f, w, "pollutant").withColumn("value", r("value", 4))


@query(with_views("""WITH box AS (SELECT c_custkey % 340 - 170.0::DOUBLE AS x, c_custkey % 160 - 80.0::DOUBLE AS y FROM customer),
 hit AS (SELECT x, y, unnest([floor((x + 180) / 5), floor((x + 181.5) / 5)]) AS i, y AS low FROM box),
 tile AS (SELECT DISTINCT x, y, i, j FROM (SELECT x, y, i, unnest([floor((y + 90) / 5), floor((y + 91) / 5)]) AS j FROM hit)),
 n AS (SELECT x, y, count(*) AS n FROM box GROUP BY 1, 2),
 pool AS (SELECT CAST(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS fid, emis / 1e6 AS part FROM points
 UNION ALL SELECT fid, weight * sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) FROM piece
 UNION ALL SELECT CAST(j * 72 + i AS BIGINT), n * 2.0 * greatest(least(x + 1.5, i * 5 - 175) - greatest(x, i * 5 - 180), 0) * greatest(least(y + 1, j * 5 - 85) - greatest(y, j * 5 - 90), 0) FROM tile JOIN n USING (x, y))
 SELECT src_fid, fid AS dst_fid, round(part / sum(part) OVER (PARTITION BY src_fid), 6) AS weight FROM (SELECT CAST((fid // 72 // 2) * 36 + fid % 72 // 2 AS BIGINT) AS src_fid, fid, sum(part) AS part FROM pool GROUP BY 1, 2) WHERE part > 0""", "points", **_PIECES))
def jon_13_mixed_proxy(spark, d):
    p = points(spark, d).select("lon", "lat", (F.col("emis") / 1e6).alias("weight"))
    x, y = F.col("c_custkey") % 340 - 170.0, F.col("c_custkey") % 160 - 80.0
    layer = load(spark, d, "customer").select(polygons.box(x, x + 1.5, y, y + 1.0).alias("ring"), F.lit(2.0).alias("weight"))
    return regrid.mixed_proxy(p, road_lines(spark, d), layer, COARSE, FINE).withColumn("weight", r("weight"))


@query(with_views(f"WITH {_ON_ROADS} SELECT link, pollutant, month_i, round(sum(flux * share / whole * 1000), 4) AS value FROM flux JOIN share USING (fid) JOIN whole USING (link) GROUP BY 1, 2, 3", "flux", **_PIECES))
def job_15_grid_to_roads(spark, d):
    f = flux(spark, d).select("pollutant", F.make_date(F.lit(2024), "month_i", F.lit(1)).alias("ts"), F.lit(0).alias("lev"), "fid", F.col("flux").alias("value"))
    out = jobs.grid_to_roads(f, road_lines(spark, d), FINE, {str(p): "kg/s" for p in range(4)})
    return out.select("link", "pollutant", F.month("ts").alias("month_i"), r("value", 4).alias("value"))


@query(with_views(f"WITH {_ON_ROADS}, f AS (SELECT pollutant, fid, sum(flux) AS mass FROM flux GROUP BY 1, 2), a AS (SELECT pollutant, sum(mass) AS mass_in FROM f SEMI JOIN share USING (fid) GROUP BY 1), b AS (SELECT pollutant, sum(mass * share) AS mass_out FROM f JOIN share USING (fid) GROUP BY 1) SELECT pollutant, round(mass_in, 4) AS mass_in, round(mass_out, 4) AS mass_out, round(mass_in - mass_out, 4) + 0.0 AS lost FROM a JOIN b USING (pollutant)", "flux", **_PIECES))
def chk_15_road_mass_balance(spark, d):
    w = roads.road_weights(road_lines(spark, d), FINE)
    f = flux(spark, d).groupBy("pollutant", "fid").agg(F.sum("flux").alias("mass"))
    after = f.join(w, "fid").select("pollutant", (F.col("mass") * F.col("share")).alias("mass"))
    before = f.join(w.select("fid").distinct(), "fid", "left_semi").select("pollutant", "mass")
    return checks.mass_balance(before, after).select("pollutant", r("mass_in", 4).alias("mass_in"), r("mass_out", 4).alias("mass_out"), r("lost", 4).alias("lost"))


@query("SELECT CAST(s_suppkey AS INTEGER) AS link, s_suppkey * 97 % 320 - 160.0::DOUBLE AS x1, s_suppkey * 41 % 150 - 75.0::DOUBLE AS y1, round(s_suppkey * 97 % 320 - 160.0::DOUBLE + 9.4, 3) AS x2, round(s_suppkey * 41 % 150 - 75.0::DOUBLE + 7.7, 3) AS y2 FROM supplier")
def snk_09_link_geometry(spark, d):
    return roads.link_geometry(road_lines(spark, d))


# Masks and rescaling ---------------------------------------------------------------------------


def mask_texts(spark: SparkSession, d: str) -> DataFrame:
    """A scaling and an inclusion text for each region, from its nations."""
    n = load(spark, d, "nation").withColumn("iso3", F.format_string("N%02d", "n_nationkey"))
    listed = F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "iso3", (F.col("n_nationkey") / 10).cast("string")))), ", ")
    codes = F.array_join(F.sort_array(F.collect_list("iso3")), " ")
    return n.groupBy(F.col("n_regionkey").alias("region")).agg(listed.alias("scaling"), F.concat(F.when(F.col("n_regionkey") % 2 == 0, "+ ").otherwise("- "), codes).alias("inclusion"))


@query(with_views("""SELECT r.n_regionkey AS region, c.fid, (CASE WHEN n.n_regionkey = r.n_regionkey THEN n.n_nationkey / 10.0::DOUBLE ELSE 1.0 END) * (CASE WHEN (n.n_regionkey = r.n_regionkey) = (r.n_regionkey % 2 = 0) THEN 1.0 ELSE 0.0 END) AS factor
 FROM (SELECT DISTINCT n_regionkey FROM nation) r, cells c JOIN nation n ON n.n_nationkey = c.nationkey""", "cells"))
def msk_03_mask_product(spark, d):
    t = mask_texts(spark, d)
    c = cells(spark).select("fid", F.format_string("N%02d", "nationkey").alias("iso3"))
    a = masks.cell_factors(c, masks.parse_factors(t, "region", "scaling"), "region")
    b = masks.cell_factors(c, masks.parse_inclusion(t, "region", "inclusion"), "region")
    return masks.mask_product(a, b, "region")


@query("SELECT CASE WHEN length(c) = 3 AND c <> 'NAN' THEN c END AS code, count(*) AS n FROM (SELECT upper(trim(substr(o_orderpriority, 3, 3))) AS c FROM orders) GROUP BY 1")
def msk_04_normalized_codes(spark, d):
    o = load(spark, d, "orders").select(F.concat(F.lit(" "), F.substring("o_orderpriority", 3, 3), F.lit("\x00")).alias("c"))
    return o.select(masks.normalize_code(F.col("c"), 3).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query(with_views("SELECT n_regionkey AS region_id, pollutant, round(sum(flux * area_m2 * 31536000.0) / 1e21, 6) AS inventory_eg FROM flux JOIN cells USING (fid) JOIN nation ON n_nationkey = nationkey GROUP BY 1, 2", "cells", "flux"))
def agg_02_regional_totals(spark, d):
    c = cells(spark)
    regions = c.join(load(spark, d, "nation"), F.col("nationkey") == F.col("n_nationkey")).select("fid", F.col("n_regionkey").alias("region_id"))
    seconds = rescale.period_seconds(F.lit("yearly"), F.lit(2019), F.lit(1))
    t = rescale.inventory_totals(flux(spark, d), c, regions, seconds, "pollutant")
    return t.select("region_id", "pollutant", r(F.col("inventory_kg") / 1e21).alias("inventory_eg"))


@query(with_views("""SELECT inventory, pollutant, fid, month_i, round(sum(flux * (CASE WHEN n_regionkey = 3 OR pollutant = 2 THEN 1.0 ELSE l.total / t.total END)), 4) AS flux FROM flux JOIN cells USING (fid) JOIN nation ON n_nationkey = nationkey
 JOIN (SELECT n_regionkey, pollutant, sum(flux) AS total FROM flux JOIN cells USING (fid) JOIN nation ON n_nationkey = nationkey GROUP BY 1, 2) t USING (n_regionkey, pollutant) LEFT JOIN (SELECT n_regionkey, 1000.0 * sum(n_nationkey) AS total FROM nation GROUP BY 1) l USING (n_regionkey) GROUP BY 1, 2, 3, 4""", "cells", "flux"))
def rsc_03_rescaled_flux(spark, d):
    n, f = load(spark, d, "nation"), flux(spark, d)
    regions = cells(spark).join(n, F.col("nationkey") == F.col("n_nationkey")).select("fid", F.col("n_regionkey").alias("region_id"))
    own = f.join(regions, "fid").groupBy("region_id", "pollutant").agg(F.sum("flux").alias("inventory_kg"))
    local = n.groupBy(F.col("n_regionkey").alias("region_id")).agg((1000.0 * F.sum("n_nationkey")).alias("total_kg")).where("region_id <> 3")
    local = local.withColumn("pollutant", F.explode(F.array(*map(F.lit, (0, 1, 3)))))
    out = rescale.apply_by_region(f, regions, rescale.factors(own, local, ["region_id", "pollutant"]), "pollutant")
    return out.groupBy("inventory", "pollutant", "fid", "month_i").agg(r(F.sum("flux"), 4).alias("flux"))


@query("""SELECT ei, sector, freq, CASE WHEN freq IN ('daily', 'hourly') THEN true ELSE false END AS is_error, count(*) AS n FROM (SELECT CAST(l_suppkey % 9 AS BIGINT) AS ei, l_linestatus AS sector, ['yearly', 'monthly', 'daily', 'hourly'][1 + l_partkey % 4] AS freq FROM lineitem) WHERE ei IN (SELECT s_suppkey % 5 FROM supplier) AND sector = 'F' GROUP BY 1, 2, 3, 4""")
def rsc_01_rescaled_inventories(spark, d):
    li = load(spark, d, "lineitem")
    freq = F.element_at(F.array(*map(F.lit, ("yearly", "monthly", "daily", "hourly"))), (F.col("l_partkey") % 4 + 1).cast("int"))
    cross = li.select((F.col("l_suppkey") % 9).alias("ei"), F.col("l_linestatus").alias("sector"), freq.alias("frequency"), F.lit("area").alias("source_type"))
    t = load(spark, d, "supplier").select((F.col("s_suppkey") % 5).alias("ei"), F.lit("F").alias("sector"))
    return rescale.rescaled(cross, t).groupBy("ei", "sector", F.col("frequency").alias("freq"), "is_error").agg(F.count("*").alias("n"))


# Time ------------------------------------------------------------------------------------------


@query(with_views("""SELECT month_i, weekday_i, hour_i, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT CAST(month(l) AS INTEGER) AS month_i, CAST(isodow(l) - 1 AS INTEGER) AS weekday_i, CAST(hour(l) AS INTEGER) AS hour_i, value FROM (SELECT ts + to_hours(CAST(fid % 13 - 6 AS BIGINT)) AS l, value FROM field)) GROUP BY 1, 2, 3""", "field"))
def tmp_03_local_calendar(spark, d):
    f = field(spark, d).withColumn("local_ts", F.from_utc_timestamp("ts", F.format_string("GMT%+d", (F.col("fid") % 13 - 6).cast("int"))))
    return temporal.with_calendar(f, "local_ts").groupBy("month_i", "weekday_i", "hour_i").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query("""SELECT CAST(y AS INTEGER) AS year_i, CAST(m AS INTEGER) AS month_i, country, CAST(CASE WHEN h.hit THEN 6 ELSE isodow(day) - 1 END AS INTEGER) AS weekday_i, count(*) AS n_days FROM
 (SELECT y, m, country, CAST(unnest(generate_series(make_date(y, m, 1)::TIMESTAMP, last_day(make_date(y, m, 1))::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderstatus AS country FROM orders)) d
 LEFT JOIN (SELECT DISTINCT o_orderstatus AS country, CAST(o_orderdate AS DATE) AS day, true AS hit FROM orders WHERE o_totalprice > 480000) h USING (country, day) GROUP BY 1, 2, 3, 4""")
def agg_16_weekdays_with_holidays(spark, d):
    o = load(spark, d, "orders").withColumn("country", F.col("o_orderstatus"))
    months = o.select(F.year("o_orderdate").alias("year_i"), F.month("o_orderdate").alias("month_i"), "country").distinct()
    holidays = o.where("o_totalprice > 480000").select("country", F.to_date("o_orderdate").alias("date"))
    return temporal.weekday_counts(months, holidays)


_WEEK = """SELECT l_returnflag AS id, CAST(isodow(l_shipdate) - 1 AS INTEGER) AS bucket, 7 * sum(l_quantity) / any_value(t) AS factor FROM lineitem JOIN (SELECT l_returnflag, sum(l_quantity) AS t FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1, 2"""


def weekly_profile(spark: SparkSession, d: str) -> DataFrame:
    days = load(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("id"), F.weekday("l_shipdate").alias("bucket")).agg(F.sum("l_quantity").alias("q"))
    return days.join(days.groupBy("id").agg(F.sum("q").alias("t")), "id").select("id", "bucket", (7 * F.col("q") / F.col("t")).alias("factor"))


@query(with_views("""SELECT id, year_i, month_i, bucket, round(factor + (sum(n) OVER w - sum(n * factor) OVER w) / sum(n) OVER w, 6) AS factor FROM p JOIN c ON c.weekday_i = p.bucket WINDOW w AS (PARTITION BY id, year_i, month_i)""", p=_WEEK,
    c="""SELECT CAST(y AS INTEGER) AS year_i, CAST(m AS INTEGER) AS month_i, CAST(isodow(day) - 1 AS INTEGER) AS weekday_i, count(*) AS n FROM (SELECT y, m, unnest(generate_series(make_date(y, m, 1)::TIMESTAMP, last_day(make_date(y, m, 1))::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders)) GROUP BY 1, 2, 3"""))
def tmp_06_rebalanced_weeks(spark, d):
    months = load(spark, d, "orders").select(F.year("o_orderdate").alias("year_i"), F.month("o_orderdate").alias("month_i")).distinct()
    return temporal.rebalance_weekly(weekly_profile(spark, d), temporal.weekday_counts(months)).withColumn("factor", r("factor"))


@query(with_views("SELECT id, round(sum(factor), 2) AS total, 'ok' AS severity FROM p GROUP BY 1", p=_WEEK))
def agg_17_profile_sums(spark, d):
    return temporal.profile_sums(weekly_profile(spark, d), 7.0, True)


@query("""SELECT CAST(c_custkey AS BIGINT) AS k, CAST(w AS INTEGER) AS weekday_i, CASE WHEN c_custkey % 3 = 0 THEN 'H' || c_custkey % 10 WHEN w = 5 THEN 'S' || c_custkey % 7 WHEN w < 5 THEN 'W' || c_custkey % 5 ELSE 'E1' END AS id FROM customer, range(7) t(w)""")
def tmp_08_hourly_ids(spark, d):
    c = load(spark, d, "customer")
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("H"), k % 10)).otherwise(F.concat(F.lit("weekday=W"), k % 5, F.lit(", saturday=S"), k % 7, F.lit(", weekend=E1")))
    return temporal.parse_hourly_id(c.select(k.alias("k"), text.alias("t")), "k", "t")


@query(with_views("""SELECT l_returnflag AS inventory, julian, round(sum(q * m.factor * w.factor), 3) AS value FROM (SELECT l_returnflag, CAST(month(l_shipdate) AS INTEGER) AS mo, CAST(isodow(l_shipdate) - 1 AS INTEGER) AS wd, CAST(date_part('doy', l_shipdate) AS INTEGER) AS julian, l_quantity AS q FROM lineitem) x
 JOIN (SELECT l_returnflag AS id, CAST(month(l_shipdate) AS INTEGER) AS bucket, 12 * sum(l_quantity) / any_value(t) AS factor FROM lineitem JOIN (SELECT l_returnflag, sum(l_quantity) AS t FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1, 2) m ON m.id = l_returnflag AND m.bucket = mo JOIN p w ON w.id = l_returnflag AND w.bucket = wd GROUP BY 1, 2""", p=_WEEK))
def tmp_09_temporal_factors(spark, d):
    li = load(spark, d, "lineitem")
    months = li.groupBy(F.col("l_returnflag").alias("id"), F.month("l_shipdate").alias("bucket")).agg(F.sum("l_quantity").alias("q"))
    months = months.join(months.groupBy("id").agg(F.sum("q").alias("t")), "id").select("id", "bucket", (12 * F.col("q") / F.col("t")).alias("factor"))
    x = temporal.with_calendar(li.select(F.col("l_returnflag").alias("inventory"), F.col("l_shipdate").alias("ts"), "l_quantity")).withColumns({"p_month": F.col("inventory"), "p_week": F.col("inventory")})
    x = temporal.lookup(temporal.lookup(x, months, "p_month", F.col("month_i"), "fm"), weekly_profile(spark, d), "p_week", F.col("weekday_i"), "fw")
    factor = temporal.temporal_factor(F.col("fm"), F.col("fw"), None, F.lit(1.0), "daily")
    return x.groupBy("inventory", "julian").agg(r(F.sum(F.col("l_quantity") * factor), 3).alias("value"))


# Vertical --------------------------------------------------------------------------------------


@query(with_views("""SELECT k, lev, round(sum(weight * greatest(0, least(ltop, ttop) - greatest(lbot, tbot)) / (ltop - lbot)) / any_value(s), 6) AS factor FROM (SELECT s_suppkey AS k, unnest([[0, 50 + s_suppkey % 30, 1 + s_suppkey % 3], [50 + s_suppkey % 30, 400, 2], [400, 400 + s_suppkey % 50 * 20 + 10, 1.5]]) AS l, 4.5 + s_suppkey % 3 AS s FROM supplier) x,
 (VALUES (0, 0, 40), (1, 40, 120), (2, 120, 300), (3, 300, 600)) m(lev, tbot, ttop), LATERAL (SELECT l[1] AS lbot, l[2] AS ltop, l[3] AS weight) GROUP BY 1, 2"""))
def vrt_01_profile_to_levels(spark, d):
    k = F.col("s_suppkey")
    tops = F.concat_ws(",", 50 + k % 30, F.lit(400), 400 + k % 50 * 20 + 10)
    weights = F.concat_ws(", ", 1 + k % 3, F.lit("2"), F.lit("1.5"))
    p = load(spark, d, "supplier").select(k.alias("id"), tops.alias("layers"), weights.alias("weights"))
    levels = spark.createDataFrame([(i, b, t) for i, (b, t) in enumerate(zip([0.0, *TOPS[:-1]], TOPS))], "lev int, bottom double, top double")
    return vertical.level_weights(vertical.profile_layers(p), levels).select(F.col("id").alias("k"), "lev", r("factor").alias("factor"))


@query(with_views("""SELECT CAST(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS fid, CASE WHEN height_m <= 40 THEN 0 WHEN height_m <= 120 THEN 1 WHEN height_m <= 300 THEN 2 WHEN height_m <= 600 THEN 3 ELSE 0 END AS lev, pollutant, round(sum(emis), 2) AS emis, CAST(sum(CASE WHEN height_m > 600 THEN 1 ELSE 0 END) AS BIGINT) AS n_above FROM points GROUP BY 1, 2, 3""", "points"))
def vrt_04_stack_levels(spark, d):
    p = regrid.owned_points(points(spark, d), FINE).withColumn("lev", vertical.injection_level(F.col("height_m"), TOPS))
    return p.groupBy("fid", "lev", "pollutant").agg(r(F.sum("emis"), 2).alias("emis"), F.count_if(vertical.above_top(F.col("height_m"), TOPS)).alias("n_above"))


@query(with_views("""SELECT fid, lev, pollutant, round(sum(emis) / any_value(area_m2) * 1e9, 4) AS flux FROM (SELECT CAST(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS fid, CASE WHEN height_m <= 40 THEN 0 WHEN height_m <= 120 THEN 1 WHEN height_m <= 300 THEN 2 WHEN height_m <= 600 THEN 3 ELSE 0 END AS lev, pollutant, emis FROM points) JOIN cells USING (fid) GROUP BY 1, 2, 3""", "cells", "points"))
def agg_09_stack_flux(spark, d):
    return stack_flux(points(spark, d), FINE, cells(spark), TOPS).withColumn("flux", r(F.col("flux") * 1e9, 4))


def fires(spark: SparkSession, d: str) -> DataFrame:
    """Fires on the fine grid: hourly fluxes of events, with an injection height."""
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(F.date_trunc("hour", "ts").alias("ts"), (F.col("user_id") * 131 % 2592).alias("src_fid"), F.col("event_type").alias("pollutant"), F.col("value").alias("flux"), (F.col("event_id") % 650).cast("double").alias("height"))


_FIRE = "SELECT (user_id * 131) % 2592 AS src_fid, event_type AS pollutant, value AS flux, CAST(event_id % 650 AS DOUBLE) AS height, CAST(epoch(date_trunc('hour', ts)) // 86400 AS BIGINT) AS day FROM events"


@query(with_views("""SELECT dst_fid AS fid, lev, pollutant, round(sum(flux * s.area_m2 * (CASE WHEN lev > top THEN 0 ELSE ([40, 80, 180, 300])[lev + 1] / ([40.0, 120.0, 300.0, 600.0])[top + 1] END)) / any_value(t.area_m2), 4) AS flux FROM (SELECT *, CASE WHEN height <= 40 THEN 0 WHEN height <= 120 THEN 1 WHEN height <= 300 THEN 2 WHEN height <= 600 THEN 3 ELSE 0 END AS top FROM fire) JOIN w USING (src_fid) JOIN cells s ON s.fid = src_fid JOIN coarse t ON t.fid = dst_fid, (VALUES (0), (1), (2), (3)) l(lev) WHERE lev <= top GROUP BY 1, 2, 3""", "cells", "coarse", "w", fire=_FIRE))
def agg_10_fire_flux(spark, d):
    from gridflux.operators.points import fire_flux

    src = cells(spark)
    out = fire_flux(fires(spark, d), src, regrid.fire_cells(src, COARSE), cells(spark, COARSE), TOPS, "uniform", F.col("height"))
    return out.withColumn("flux", r("flux", 4))


@query(with_views("""SELECT variable, fid, hour_no, CAST(k AS INTEGER) AS lev, round(CASE WHEN h >= 1.5 THEN v2 + 0 * h ELSE v1 + (h - 0.5) * (v2 - v1) END, 6) AS value FROM (SELECT variable, fid, CAST(epoch(ts) // 3600 AS BIGINT) AS hour_no, value AS v1, value * 1.5 + 1 AS v2 FROM field), (VALUES (0, 0.5), (1, 0.75), (2, 1.25), (3, 2.0)) t(k, h)""", "field"))
def vrt_08_linear_interpolation(spark, d):
    f = field(spark, d).select("variable", "fid", hour_no().alias("hour_no"), F.array(F.lit(0.5), F.lit(1.5)).alias("z"), F.array(F.col("value"), F.col("value") * 1.5 + 1).alias("v"))
    return vertical.interpolate_linear(f, [0.5, 0.75, 1.25, 2.0]).select("variable", "fid", "hour_no", "lev", r("value").alias("value"))


@query(with_views("""SELECT pollutant, fid, CAST(k AS INTEGER) AS lev, round(list_sum(list_transform(range(1, len(z) + 1), lambda i: v[i] * list_product(list_transform(range(1, len(z) + 1), lambda j: CASE WHEN i = j THEN 1.0 ELSE (x - z[j]) / (z[i] - z[j]) END)))), 6) AS value
 FROM (SELECT *, least(greatest(h, z[1]), z[len(z)]) AS x FROM (SELECT pollutant, fid, list(q * 100.0::DOUBLE ORDER BY q) AS z, list(flux::DOUBLE ORDER BY q) AS v FROM (SELECT pollutant, fid, (month_i - 1) // 3 + 1 AS q, sum(flux) AS flux FROM flux GROUP BY 1, 2, 3) GROUP BY 1, 2), (VALUES (0, 153.71239417331), (1, 233.33917718593), (2, 950.0)) t(k, h))""", "flux"))
def vrt_08_cubic_interpolation(spark, d):
    """Splines of four levels at most, each one polynomial."""
    f = flux(spark, d).groupBy("pollutant", "fid", (F.floor((F.col("month_i") - 1) / 3) + 1).alias("lev")).agg(F.sum("flux").alias("value"))
    columns = vertical.columns_of(f, f.select("pollutant", "fid", "lev", (F.col("lev") * 100.0).alias("height")), "pollutant", "fid")
    return vertical.interpolate_spline(columns, [153.71239417331, 233.33917718593, 950.0], ["pollutant", "fid"]).withColumn("value", r("value"))


# Speciation and units --------------------------------------------------------------------------


@query(with_views("""SELECT inventory, sector, fid, species, round(CASE species WHEN 'NO' THEN 0.9 * p1 / 46 WHEN 'NO2' THEN 0.1 * p1 / 46 WHEN 'PM' THEN p2 + p3 / 2 ELSE 0 END, 6) AS value FROM (SELECT inventory, sector, fid, sum(CASE WHEN pollutant = 1 THEN flux ELSE 0 END) AS p1, sum(CASE WHEN pollutant = 2 THEN flux ELSE 0 END) AS p2, sum(CASE WHEN pollutant = 3 THEN flux ELSE 0 END) AS p3 FROM flux GROUP BY 1, 2, 3), (VALUES ('NO'), ('NO2'), ('PM'), ('NONE')) t(species)""", "flux"))
def spc_01_speciation(spark, d):
    f = flux(spark, d).withColumn("pollutant", F.concat(F.lit("p"), "pollutant"))
    out = speciation.speciate(f, {"p0": 1.0, "p1": 46.0, "p2": 1.0, "p3": 1.0}, {"NO": "0.9*p1", "NO2": "0.1 * p1", "PM": "p2+p3/2", "NONE": "0"}, ["inventory", "sector", "fid"])
    return out.withColumn("value", r("value"))


_RATIO = "SELECT 'N' || n_nationkey AS iso3, CASE WHEN n_nationkey % 3 = 0 THEN -1.0::DOUBLE ELSE n_nationkey / 50.0::DOUBLE END AS own FROM nation WHERE n_nationkey < 20"


@query(with_views("SELECT inventory, sector, fid, round(sum(flux) * any_value(CASE WHEN own > 0 THEN own ELSE 0.25 END), 4) AS flux FROM flux JOIN cells USING (fid) LEFT JOIN ratio ON iso3 = 'N' || nationkey WHERE pollutant = 1 GROUP BY 1, 2, 3", "cells", "flux", ratio=_RATIO))
def spc_02_country_split(spark, d):
    n = load(spark, d, "nation").where("n_nationkey < 20")
    own = n.select(F.concat(F.lit("N"), "n_nationkey").alias("iso3"), F.when(F.col("n_nationkey") % 3 == 0, -1.0).otherwise(F.col("n_nationkey") / 50.0).alias("fr"))
    whole = load(spark, d, "region").limit(1).select(F.lit("EUR").alias("iso3"), F.lit(0.25).alias("fr"))
    ratios = own.unionByName(whole).withColumns({"sector": F.lit("all"), "species": F.lit("voc01"), "year": F.lit(2019)})
    wanted = cells(spark).select(F.concat(F.lit("N"), "nationkey").alias("iso3")).distinct().withColumns({"sector": F.lit("all"), "species": F.lit("voc01"), "year": F.lit(2019)})
    per_cell = cells(spark).select("fid", F.concat(F.lit("N"), "nationkey").alias("iso3")).join(speciation.split_ratios(wanted, ratios), "iso3").select("fid", "species", "fr")
    f = flux(spark, d).where("pollutant = 1").groupBy("inventory", "sector", "fid").agg(F.sum("flux").alias("flux"))
    return speciation.apply_split(f, per_cell, ["fid"]).select("inventory", "sector", "fid", r("flux", 4).alias("flux"))


@query("SELECT o_orderstatus AS sector, o_orderpriority AS sub_sector, round(sum(o_totalprice) / any_value(t), 6) AS share FROM orders JOIN (SELECT o_orderstatus, sum(o_totalprice) AS t FROM orders GROUP BY 1) USING (o_orderstatus) GROUP BY 1, 2")
def agg_13_sector_shares(spark, d):
    t = load(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("sector"), F.col("o_orderpriority").alias("sub_sector")).agg(F.sum("o_totalprice").alias("total"))
    return speciation.sector_shares(t, "sector").select("sector", "sub_sector", r("share").alias("share"))


@query(with_views("SELECT pollutant, round(sum(flux), 4) AS parent_total, round(sum(flux * 0.75), 4) AS parts_total, -25.0::DOUBLE AS percent FROM flux GROUP BY 1", "flux"))
def agg_14_parent_check(spark, d):
    f = flux(spark, d)
    split = f.limit(1).select(F.explode(F.array(F.struct(F.lit("a").alias("species"), F.lit(0.5).alias("fr")), F.struct(F.lit("b").alias("species"), F.lit(0.25).alias("fr")))).alias("s")).select("s.*")
    parts = f.crossJoin(F.broadcast(split)).withColumn("flux", F.col("flux") * F.col("fr"))  # two species
    out = speciation.parent_check(f, parts, "pollutant")
    return out.select("pollutant", r("parent_total", 4).alias("parent_total"), r("parts_total", 4).alias("parts_total"), r("percent", 4).alias("percent"))


@query(with_views("SELECT pollutant, fid, round(sum(flux) * 1000, 3) AS molar, round(sum(flux) * any_value(area_m2) / 1e9, 4) AS cell_g, round(sum(flux) * 3.6, 4) AS per_hour, round(sum(flux) * 6.022140857e-2, 6) AS molecules FROM flux JOIN cells USING (fid) GROUP BY 1, 2", "cells", "flux"))
def uni_01_model_units(spark, d):
    f = flux(spark, d).groupBy("pollutant", "fid").agg(F.sum("flux").alias("v")).join(cells(spark).select("fid", "area_m2"), "fid")
    u, v = F.lit("kmol.m-2.s-1"), F.col("v")
    return f.select("pollutant", "fid", r(units.molar_per_area(v, u), 3).alias("molar"), r(units.per_cell(v, u, F.col("area_m2")) / 1e12, 4).alias("cell_g"), r(units.hourly_per_km2(v, u) / 1e12, 4).alias("per_hour"), r(units.molecules_per_cm2(v, u) / 1e24, 6).alias("molecules"))


@query(with_views("SELECT variable, fid, CAST(strftime(ts, '%Y%j') AS INTEGER) AS yyyyjjj, CAST(strftime(ts, '%H%M%S') AS INTEGER) AS hhmmss, strftime(ts, '%Y-%m-%d_%H:%M:%S') AS times, CAST(epoch(ts) - 1704067200 AS DOUBLE) / 3600 AS hours, CAST(strftime(ts, '%Y%m%d') AS DOUBLE) + hour(ts) / 24.0::DOUBLE AS encoded FROM field", "field"))
def uni_06_time_tags(spark, d):
    ts, start = F.col("ts"), F.lit("2024-01-01").cast("timestamp")
    return field(spark, d).select("variable", "fid", units.time_tag_pair(ts).alias("t"), units.time_tag_text(ts).alias("times"), units.hours_since(ts, start).alias("hours"), units.encoded_date(ts).alias("encoded")).select("variable", "fid", "t.*", "times", "hours", "encoded")


# Checks, logs and jobs -------------------------------------------------------------------------


@query(with_views("SELECT variable, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value, CASE WHEN max(value) > 300 THEN 'error' WHEN NOT (min(value) BETWEEN 0 AND 2 AND max(value) BETWEEN 50 AND 200) THEN 'warning' ELSE 'ok' END AS status FROM field GROUP BY 1", "field"))
def chk_02_bounds_report(spark, d):
    f = field(spark, d)
    b = f.select("variable").distinct().withColumns({"min_abs": F.lit(-1.0), "min_lower": F.lit(0.0), "min_upper": F.lit(2.0), "max_lower": F.lit(50.0), "max_upper": F.lit(200.0), "max_abs": F.lit(300.0)})
    return checks.bounds_report(f, b).select("variable", r("min_value").alias("min_value"), r("max_value").alias("max_value"), "status")


@query("SELECT DISTINCT event_type AS variable, CAST((SELECT count(*) FROM events e WHERE e.event_type = x.event_type AND user_id % 9 = 4) AS BIGINT) AS n_nan, CAST((SELECT count(*) FROM events e WHERE e.event_type = x.event_type AND user_id % 9 = 5) AS BIGINT) AS n_inf FROM events x")
def chk_01_odd_values(spark, d):
    v = F.when(F.col("user_id") % 9 == 4, float("nan")).when(F.col("user_id") % 9 == 5, float("-inf")).otherwise(F.col("value"))
    return compare.count_odd(load(spark, d, "events").select(F.col("event_type").alias("variable"), v.alias("value")))


@query("SELECT DISTINCT 'N' || s_nationkey AS iso3 FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)")
def chk_05_unknown_codes(spark, d):
    s = load(spark, d, "supplier").select(F.concat(F.lit("N"), "s_nationkey").alias("iso3"))
    return compare.missing_codes(s, load(spark, d, "nation").where("n_regionkey <> 2").select(F.concat(F.lit("N"), "n_nationkey").alias("iso3")), "iso3")


_LOG = "SELECT 'regrid' AS section, l_returnflag AS subsection, CAST(1 + l_linenumber % 3 AS INTEGER) AS processes, CAST(l_suppkey % 40 AS BIGINT) AS replication, sum(l_extendedprice) / 1000 AS value FROM lineitem GROUP BY 1, 2, 3, 4"


def run_log(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem")
    return li.groupBy(F.lit("regrid").alias("section"), F.col("l_returnflag").alias("subsection"), (F.col("l_linenumber") % 3 + 1).cast("int").alias("processes"), (F.col("l_suppkey") % 40).alias("replication")).agg((F.sum("l_extendedprice") / 1000).alias("value"))


@query(with_views("""SELECT section, subsection, processes, round(avg(CASE WHEN ok THEN value END), 4) AS value, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS removed FROM (SELECT *, n < 4 OR b = a OR value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) AS ok FROM (SELECT *, count(*) OVER w AS n, quantile_cont(value, 0.25) OVER w AS a, quantile_cont(value, 0.75) OVER w AS b FROM log WINDOW w AS (PARTITION BY section, subsection, processes))) GROUP BY 1, 2, 3""", log=_LOG))
def agg_18_replications(spark, d):
    return runlog.aggregate_replications(runlog.inliers(run_log(spark, d), "iqr")).withColumn("value", r("value", 4))


@query(with_views("SELECT section, subsection, processes, round(one / value, 6) AS speedup, round(one / value / processes, 6) AS efficiency FROM (SELECT section, subsection, processes, avg(value) AS value FROM log GROUP BY 1, 2, 3) a JOIN (SELECT subsection, avg(value) AS one FROM log WHERE processes = 1 GROUP BY 1) b USING (subsection)", log=_LOG))
def agg_20_speedup(spark, d):
    m = run_log(spark, d).groupBy("section", "subsection", "processes").agg(F.avg("value").alias("value"))
    return runlog.speedup(m, "section", "subsection").select("section", "subsection", "processes", r("speedup").alias("speedup"), r("efficiency").alias("efficiency"))


@query("""SELECT section, subsection, round(min(s), 3) AS min_s, round(avg(s), 3) AS mean_s, round(max(s), 3) AS max_s FROM (SELECT l_linestatus AS section, l_returnflag AS subsection, l_suppkey % 16 AS rank, sum(l_quantity) AS s FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def agg_21_rank_summary(spark, d):
    t = load(spark, d, "lineitem").select(F.col("l_linestatus").alias("section"), F.col("l_returnflag").alias("subsection"), (F.col("l_suppkey") % 16).alias("rank"), F.col("l_quantity").alias("seconds"))
    out = runlog.rank_summary(t)
    return out.select("section", "subsection", *[r(c, 3).alias(c) for c in ("min_s", "mean_s", "max_s")])


@query(with_views("SELECT sector, pollutant, fid, round(sum(mass) * 1000 / any_value(area_m2) / 31536000 * 1e9, 6) AS flux FROM (SELECT l_linestatus AS sector, CAST(l_linenumber % 4 AS INTEGER) AS pollutant, CAST(round((l_partkey % 35 * 5 - 85 + 90 - 2.5) / 5) * 72 + round((l_suppkey % 70 * 5 - 175 + 180 - 2.5) / 5) AS BIGINT) AS fid, l_quantity AS mass FROM lineitem) JOIN cells USING (fid) GROUP BY 1, 2, 3", "cells"))
def job_09_table_to_flux(spark, d):
    rows = load(spark, d, "lineitem").select(F.col("l_linestatus").alias("sector"), (F.col("l_linenumber") % 4).cast("int").alias("pollutant"), (F.col("l_partkey") % 35 * 5 - 85.0).alias("lat"), (F.col("l_suppkey") % 70 * 5 - 175.0).alias("lon"), F.col("l_quantity").alias("mass"))
    return jobs.preprocess_table(rows, 5.0, "Mg", cells(spark)).withColumn("flux", r(F.col("flux") * 1e9))


#: Hours of the yearly area inventories; {which} picks rows of flux.
_AREA_HOURS = """SELECT h AS hour_i, l.lev, dst AS fid, s.species, flux * t.area_s / t.area_d * s.fr * (CASE WHEN (h + tz_h + 24) % 24 BETWEEN 7 AND 18 THEN 1.5 ELSE 0.5 END) * l.f AS value
 FROM (SELECT fid, pollutant, sum(flux * CASE WHEN nationkey % 5 = 0 THEN 0.5 WHEN nationkey % 5 = 1 THEN 0 ELSE 1 END) AS flux FROM flux JOIN cells USING (fid) WHERE {which} GROUP BY 1, 2) f
 JOIN (SELECT src_fid, dst_fid AS dst, s.area_m2 AS area_s, c.area_m2 AS area_d, c.tz_h FROM w JOIN cells s ON s.fid = src_fid JOIN coarse c ON c.fid = dst_fid) t ON t.src_fid = f.fid JOIN (VALUES (0, 'CO', 1 / 28.01::DOUBLE), (1, 'NO', 0.9 / 46.0055::DOUBLE), (1, 'NO2', 0.1 / 46.0055::DOUBLE), (2, 'SO2', 1 / 64.066::DOUBLE), (3, 'PM', 0.97::DOUBLE)) s(pollutant, species, fr) USING (pollutant), (VALUES (0, 0.75), (1, 0.25)) l(lev, f), range(24) r(h)"""


@query(with_views("SELECT hour_i, lev, fid, species, round(sum(value), 6) AS value FROM hours GROUP BY 1, 2, 3, 4 HAVING sum(value) <> 0", "cells", "coarse", "flux", "w", hours=_AREA_HOURS.format(which="true")))
def job_01_hourly_emissions(spark, d):
    """Yearly inventory to hourly model emissions: mask, regrid, speciate, local hours, levels, sum."""
    return area_by_hour(spark, flux(spark, d)).select(F.hour("ts").alias("hour_i"), "lev", "fid", "species", r("value").alias("value"))


def area_by_hour(spark: SparkSession, fields: DataFrame) -> DataFrame:
    src, dst = cells(spark), cells(spark, COARSE)
    n = F.col("nationkey") % 5
    mask = src.select("fid", F.when(n == 0, 0.5).when(n == 1, 0.0).otherwise(1.0).alias("factor"))
    f = fields.withColumn("pollutant", F.get(F.array(*map(F.lit, ("co", "nox", "sox", "pm"))), F.col("pollutant")))
    out = jobs.area_inventory(f, mask, src, dst, COARSE, None, None)
    steps = temporal.time_steps(spark, "2024-07-01", "hourly", 24)
    zone = F.format_string("GMT%+d", "tz_h")
    calendar = temporal.with_calendar(temporal.local_calendar(dst.select("fid", zone.alias("tz")), steps), "local_ts")
    by_hour = F.when(F.col("hour_i").between(7, 18), 1.5).otherwise(0.5)
    vfac = f.select("sector").distinct().withColumn("vfac", F.array(F.lit(0.75), F.lit(0.25)))
    return jobs.to_hours(out, calendar, by_hour, vfac, 2, {"co": 28.01, "nox": 46.0055, "sox": 64.066, "pm": 1.0}, {"CO": "co", "NO": "0.9*nox", "NO2": "0.1*nox", "SO2": "sox", "PM": "0.97*pm"})


@query(with_views("SELECT pollutant, point_id AS fid, round(sum(flux / g) / any_value(total), 4) AS value FROM (SELECT point_id, unnest(g) AS g, unnest(fids) AS fid, list_sum(list_transform(g, lambda x: 1 / x)) AS total FROM near) JOIN (SELECT pollutant, fid, sum(flux) AS flux FROM flux GROUP BY 1, 2) USING (fid) GROUP BY 1, 2", "cells", "flux", "points", s=_ecef("cells", "fid"), t=_ecef("points", "point_id"), near=_NEAR))
def job_16_interpolated_at_stations(spark, d):
    f = flux(spark, d).groupBy("pollutant", "fid").agg(F.sum("flux").alias("value"))
    s = points(spark, d).select(F.col("point_id").alias("station"), "lon", "lat")
    return jobs.interpolate(f, cells(spark), None, s, "pollutant").withColumn("value", r("value", 4))


@query(with_views("""WITH f AS (SELECT pollutant, dst_fid AS fid, q, sum(flux) AS flux FROM (SELECT pollutant, fid AS src_fid, (month_i - 1) // 3 + 1 AS q, flux FROM flux) JOIN w USING (src_fid) GROUP BY 1, 2, 3),
 c AS (SELECT pollutant, fid, list(q * 100.0::DOUBLE ORDER BY q) AS z, list(flux::DOUBLE ORDER BY q) AS v FROM f GROUP BY 1, 2),
 x AS (SELECT *, greatest(least(len(list_filter(z, lambda a: a <= h)), len(z) - 1), 1) AS i, least(greatest(h, z[1]), z[len(z)]) AS p FROM c, (VALUES (0, 50.0::DOUBLE), (1, 153.7), (2, 333.3), (3, 950.0)) t(k, h))
 SELECT pollutant, fid, CAST(k AS INTEGER) AS lev, round(CASE WHEN len(z) = 1 THEN v[1] ELSE v[i] + (p - z[i]) / (z[i + 1] - z[i]) * (v[i + 1] - v[i]) END, 4) AS value FROM x""", "cells", "flux", "w"))
def job_16_interpolated_levels(spark, d):
    """Each quarter stands for a level."""
    f = flux(spark, d).groupBy("pollutant", "fid", (F.floor((F.col("month_i") - 1) / 3) + 1).cast("int").alias("lev")).agg(F.sum("flux").alias("value"))
    heights = spark.createDataFrame([(k, 100.0 * k) for k in range(1, 5)], "lev int, height double")
    coarse = jobs.interpolate(f, cells(spark), COARSE, None, "pollutant", "lev")
    return jobs.interpolate_levels(coarse, heights, [50.0, 153.7, 333.3, 950.0], ["pollutant", "fid"]).withColumn("value", r("value", 4))


# Streaming: each reads the events file as a stream and returns what the finished stream has written ----


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = load(spark, d, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return e.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("variable"), (F.col("user_id") % 20).alias("fid"), "value", "user_id", "event_id")


def finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Rows that an append stream has written once all that is there is read."""
    to = sinks.scratch(spark, "stream")
    run = stream.writeStream.format("parquet").option("path", f"{to}/out").option("checkpointLocation", f"{to}/state").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{to}/out")


@query("SELECT CAST(epoch(date_trunc('hour', ts)) // 3600 AS BIGINT) AS hour_no, event_type AS variable, round(sum(value), 4) AS total FROM events GROUP BY 1, 2 HAVING date_trunc('hour', any_value(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR")
def st_02_hourly_totals(spark, d):
    out = finished(spark, streaming.hourly_totals(event_stream(spark, d), "2 hours"))
    return out.select(hour_no("hour").alias("hour_no"), "variable", r("total", 4).alias("total"))


@query("SELECT CAST(epoch(date_trunc('day', ts)) // 3600 AS BIGINT) AS hour_no, event_type AS variable, CAST(user_id % 20 AS BIGINT) AS fid, round(avg(value), 6) AS mean_value, round(max(value), 6) AS max_value, round(min(value), 6) AS min_value FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1 AND date_trunc('day', any_value(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
def st_03_daily_statistics(spark, d):
    out = finished(spark, streaming.daily_statistics(event_stream(spark, d), "1 day"))
    return out.select(hour_no("day").alias("hour_no"), "variable", "fid", *[r(c).alias(c) for c in ("mean_value", "max_value", "min_value")])


@query(with_views("SELECT CAST(epoch(ts) // 3600 AS BIGINT) AS hour_no, dst_fid AS fid, pollutant || s.x AS species, round(sum(flux * s.fr), 5) AS value FROM (SELECT date_trunc('hour', ts) AS ts, (user_id * 131) % 2592 AS src_fid, event_type AS pollutant, value AS flux FROM events) JOIN w USING (src_fid), (VALUES ('_a', 0.25), ('_b', 0.5)) s(x, fr) GROUP BY 1, 2, 3", "cells", "w"))
def st_01_fire_hours(spark, d):
    fires_in = event_stream(spark, d).select("ts", (F.col("user_id") * 131 % 2592).alias("src_fid"), F.col("variable").alias("pollutant"), F.col("value").alias("flux"))
    split = F.array(F.struct(F.lit("_a").alias("x"), F.lit(0.25).alias("fr")), F.struct(F.lit("_b").alias("x"), F.lit(0.5).alias("fr")))
    species = load(spark, d, "events").select(F.col("event_type").alias("pollutant")).distinct().withColumn("s", F.explode(split)).select("pollutant", F.concat("pollutant", "s.x").alias("species"), "s.fr")
    to = sinks.scratch(spark, "fires")
    streaming.write_hours(fires_in, regrid.conservative_weights(cells(spark), COARSE), species, f"{to}/out", f"{to}/state").awaitTermination()
    return spark.read.schema("fid long, species string, value double, ts timestamp").parquet(f"{to}/out").select(hour_no().alias("hour_no"), "fid", "species", r("value", 5).alias("value"))


# Preprocessing jobs and species tables ------------------------------------------------------------


@query(with_views("SELECT pollutant, strftime(o_orderdate, '%Y%m') AS period, count(*) AS n, round(sum(o_totalprice), 2) AS flux FROM orders JOIN (SELECT DISTINCT o_orderpriority, lower(substr(o_orderpriority, 3)) AS pollutant FROM orders WHERE o_orderpriority < '4') USING (o_orderpriority) WHERE year(o_orderdate) = 1997 GROUP BY 1, 2"))
def job_06_gridded_preprocess(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderpriority").alias("name"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("flux"))
    names = o.where("name < '4'").select("name", F.lower(F.expr("substring(name, 3)")).alias("pollutant")).distinct()
    return jobs.preprocess_gridded(o, names, 1997).groupBy("pollutant", "period").agg(F.count("*").alias("n"), r(F.sum("flux"), 2).alias("flux"))


@query(with_views("""SELECT pollutant, species, month_i, round(sum(v * fr), 3) AS flux, round(min(lon) - 0.05, 4) AS west FROM (SELECT o_orderstatus AS pollutant, CAST(month(o_orderdate) AS INTEGER) AS month_i, o_totalprice AS v, ((o_orderkey * 53) % 3600) / 10.0::DOUBLE - 180 + 0.05 AS lon FROM orders)
 JOIN (SELECT 'P' AS pollutant, 'P_a' AS species, 0.2 AS fr UNION ALL SELECT 'P', 'P_b', 0.4 UNION ALL SELECT 'O', 'O', 1 UNION ALL SELECT 'F', 'F', 1) USING (pollutant) GROUP BY 1, 2, 3"""))
def job_08_shipping(spark, d):
    daily = points(spark, d).join(load(spark, d, "orders").select(F.col("o_orderkey").alias("point_id"), F.col("o_orderdate").alias("ts")), "point_id").select("pollutant", "lon", "lat", "ts", F.col("emis").alias("flux"))
    parts = F.array(F.struct(F.lit("P_a").alias("species"), F.lit(0.2).alias("fr")), F.struct(F.lit("P_b").alias("species"), F.lit(0.4).alias("fr")))
    split = load(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderstatus").alias("pollutant")).distinct().withColumn("s", F.explode(parts)).select("pollutant", "s.*")
    out = jobs.preprocess_shipping(daily, split)
    return out.groupBy("pollutant", "species", "month_i").agg(r(F.sum("flux"), 3).alias("flux"), r(F.min("lon"), 4).alias("west"))


@query(with_views("SELECT CASE sector WHEN 'F' THEN 'road' ELSE 'ship' END AS sector, pollutant, fid, CAST(m AS INTEGER) AS month_i, round(sum(flux) * (1 + (fid % 7 - 3) * (any_value(m) - 6.5) / 60.0), 4) AS flux FROM flux, range(1, 13) t(m) GROUP BY 1, 2, 3, 4", "flux"))
def job_11_sectors_to_months(spark, d):
    f = flux(spark, d).groupBy("sector", "pollutant", "fid").agg(F.sum("flux").alias("flux"))
    names = f.select("sector").distinct().withColumn("new_sector", F.when(F.col("sector") == "F", "road").otherwise("ship"))
    profile = f.select("fid").distinct().withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumn("factor", 1 + (F.col("fid") % 7 - 3) * (F.col("bucket") - 6.5) / 60.0)
    return jobs.preprocess_sectors(f, names, profile).select("sector", "pollutant", "fid", F.col("month_i").cast("int").alias("month_i"), r("flux", 4).alias("flux"))


@query(with_views("""SELECT sub_sector, species, fid, round(sum(mass * share * fr) * 1e6 / any_value(area_m2) / 31536000 * 1e6, 6) AS flux FROM (SELECT sector, pollutant, fid, sum(flux) AS mass FROM flux GROUP BY 1, 2, 3) JOIN cells USING (fid)
 JOIN (SELECT o_orderpriority AS sub_sector, o_orderstatus AS sector, sum(o_totalprice) / sum(sum(o_totalprice)) OVER (PARTITION BY o_orderstatus) AS share FROM orders GROUP BY 1, 2) USING (sector) JOIN (VALUES (0, 'sox', 0.5), (1, 'nox', 0.75), (2, 'nh3', 1.0), (3, 'co', 0.25)) s(pollutant, species, fr) USING (pollutant) GROUP BY 1, 2, 3""", "cells", "flux"))
def job_13_national_inventory(spark, d):
    f = flux(spark, d).groupBy("sector", "pollutant", "fid").agg(F.sum("flux").alias("mass")).join(cells(spark).select("fid", "area_m2"), "fid")
    sub = load(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("sub_sector"), F.col("o_orderstatus").alias("sector")).agg(F.sum("o_totalprice").alias("total"))
    at = lambda *v: F.get(F.array(*map(F.lit, v)), F.col("pollutant"))
    species = f.select("pollutant").distinct().select("pollutant", at("sox", "nox", "nh3", "co").alias("species"), at(0.5, 0.75, 1.0, 0.25).alias("fr"))
    out = jobs.preprocess_national(f, sub, species)
    return out.groupBy("sub_sector", "species", "fid").agg(r(F.sum("flux") * 1e6).alias("flux"))


@query("SELECT o_orderstatus AS iso3, CAST(o_custkey % 300 AS BIGINT) AS species, CASE WHEN count(DISTINCT o_orderkey % 3) = 1 THEN max(o_orderkey % 3) / 4.0::DOUBLE END AS fr, count(DISTINCT o_orderkey % 3) AS n FROM orders GROUP BY 1, 2")
def spc_05_single_factors(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderstatus").alias("iso3"), (F.col("o_custkey") % 300).alias("species"), (F.col("o_orderkey") % 3 / 4.0).alias("fr"))
    return speciation.single_factor(o, "iso3", "species")


@query("SELECT DISTINCT s AS species FROM (SELECT 'v' || l_partkey % 50 AS s FROM lineitem WHERE l_quantity > 49 UNION ALL SELECT 'parent' || (l_partkey % 50) % 3 FROM lineitem WHERE l_quantity > 49 AND l_partkey % 2 = 0)")
def spc_06_species_and_parents(spark, d):
    li = load(spark, d, "lineitem")
    wanted = li.where("l_quantity > 49").select(F.concat(F.lit("v"), F.col("l_partkey") % 50).alias("species"))
    parents = li.where("l_partkey % 2 = 0").select(F.concat(F.lit("v"), F.col("l_partkey") % 50).alias("species"), F.concat(F.lit("parent"), F.col("l_partkey") % 50 % 3).alias("parent")).distinct()
    return speciation.with_parents(wanted, parents)


@query(with_views("SELECT f.fid, p.species, round(coalesce(sum(CASE WHEN pollutant = p.species THEN flux END), 0), 4) AS value FROM flux f, (SELECT DISTINCT l_linenumber AS species FROM lineitem) p GROUP BY 1, 2", "flux"))
def snk_03_all_declared_species(spark, d):
    f = flux(spark, d).groupBy("fid", F.col("pollutant").alias("species")).agg(F.sum("flux").alias("value"))
    names = load(spark, d, "lineitem").select(F.col("l_linenumber").alias("species"))
    return speciation.all_species(f, names, ["fid"]).select("fid", "species", r("value", 4).alias("value"))


@query("SELECT ei, units, frequency, count(*) AS n FROM (SELECT CAST(o_custkey % 20 AS BIGINT) AS ei, ['kg/year', 't/year', 'kg/month', 't/day'][1 + o_orderkey % 4] AS units, CASE WHEN o_custkey % 20 < 10 THEN 'yearly' ELSE 'monthly' END AS frequency FROM orders) WHERE NOT ((frequency = 'yearly' AND units IN ('kg/year', 't/year')) OR (frequency = 'monthly' AND units IN ('kg/month', 't/month'))) GROUP BY 1, 2, 3")
def chk_09_wrong_units(spark, d):
    o = load(spark, d, "orders")
    unit = F.element_at(F.array(*map(F.lit, ("kg/year", "t/year", "kg/month", "t/day"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    totals = o.select((F.col("o_custkey") % 20).alias("ei"), F.lit("F").alias("sector"), unit.alias("units"))
    freq = totals.select("ei", "sector").distinct().withColumn("frequency", F.when(F.col("ei") < 10, "yearly").otherwise("monthly"))
    return rescale.wrong_units(totals, freq).groupBy("ei", "units", "frequency").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey AS cell, pollutant, round(sum(mass), 3) AS mass FROM (SELECT l_suppkey, 'co' AS pollutant, l_quantity AS mass FROM lineitem UNION ALL SELECT l_suppkey, 'nox', l_discount FROM lineitem WHERE l_discount <> 0 UNION ALL SELECT l_suppkey, 'sox', l_tax FROM lineitem WHERE l_tax <> 0) GROUP BY 1, 2")
def src_12_wide_inventory(spark, d):
    wide = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_quantity").alias("co"), F.col("l_discount").alias("nox"), F.col("l_tax").alias("sox"))
    return readers.wide_inventory(wide, ["cell"]).groupBy("cell", "pollutant").agg(r(F.sum("mass"), 3).alias("mass"))


@query("SELECT o_orderstatus AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1, 2")
def srt_04_latest_year(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderstatus").alias("iso3"), F.year("o_orderdate").alias("year"))
    return speciation.latest_year(o, 2030).groupBy("iso3", "year").agg(F.count("*").alias("n"))


# Point and fire jobs, logs and small tables --------------------------------------------------------

_LEV = "CASE WHEN {h} <= 40 THEN 0 WHEN {h} <= 120 THEN 1 WHEN {h} <= 300 THEN 2 WHEN {h} <= 600 THEN 3 ELSE 0 END"
_STACK_HOURS = f"""SELECT h AS hour_i, lev, fid, s.species, emis / area_m2 * 1e9 * s.fr * (CASE WHEN (h + tz_h + 24) % 24 BETWEEN 7 AND 18 THEN 1.5 ELSE 0.5 END) AS value
 FROM (SELECT CAST(floor((lat + 90) / 10) * 36 + floor((lon + 180) / 10) AS BIGINT) AS fid, {_LEV.format(h="height_m")} AS lev, pollutant, sum(emis) AS emis FROM points GROUP BY 1, 2, 3) JOIN coarse USING (fid)
 JOIN (VALUES ('F', 'CO', 1 / 28.0::DOUBLE), ('O', 'NO', 0.9 / 46.0::DOUBLE), ('O', 'NO2', 0.1 / 46.0::DOUBLE), ('P', 'SO2', 1 / 64.0::DOUBLE)) s(pollutant, species, fr) USING (pollutant), range(24) r(h)"""
_FIRE_STEPS = """SELECT b.{step}, dst_fid AS fid, lev, pollutant, sum(flux * s.area_m2 * ([40, 80, 180, 300])[lev + 1] / ([40.0, 120.0, 300.0, 600.0])[top + 1]) / any_value(t.area_m2) AS flux
 FROM (SELECT *, %s AS top FROM fire) b SEMI JOIN (SELECT DISTINCT {step}, src_fid FROM fire WHERE pollutant = 'click' AND flux > 0) c ON b.{step} = c.{step} AND b.src_fid = c.src_fid
 JOIN w ON w.src_fid = b.src_fid JOIN cells s ON s.fid = b.src_fid JOIN coarse t ON t.fid = dst_fid, (VALUES (0), (1), (2), (3)) l(lev) WHERE lev <= top GROUP BY 1, 2, 3, 4""" % _LEV.format(h="height")
_FIRES = "SELECT (user_id * 131) % 2592 AS src_fid, event_type AS pollutant, value AS flux, CAST(event_id % 650 AS DOUBLE) AS height, CAST(epoch(date_trunc('hour', ts)) / 3600 AS BIGINT) AS hour_no, CAST(epoch(date_trunc('day', ts)) / 3600 AS BIGINT) AS day_no FROM events"


def stacks_by_hour(spark: SparkSession, d: str, wanted: DataFrame | None = None) -> DataFrame:
    dst = cells(spark, COARSE)
    steps = temporal.time_steps(spark, "2024-07-01", "hourly", 24)
    calendar = temporal.with_calendar(temporal.local_calendar(dst.select("fid", F.format_string("GMT%+d", "tz_h").alias("tz")), steps), "local_ts")
    by_hour = F.when(F.col("hour_i").between(7, 18), 1.5).otherwise(0.5)
    p = points(spark, d).withColumn("emis", F.col("emis") * 1e9)
    p = p if wanted is None else p.join(wanted, "pollutant", "left_semi")
    return jobs.stack_inventory(p, COARSE, dst, TOPS, calendar, by_hour, {"F": 28.0, "O": 46.0, "P": 64.0}, {"CO": "F", "NO": "0.9*O", "NO2": "0.1*O", "SO2": "P"})


def fires_by(spark: SparkSession, d: str, step: str) -> DataFrame:
    f = fires(spark, d).withColumn("ts", F.date_trunc(step, "ts"))
    return jobs.fire_inventory(f, cells(spark), cells(spark, COARSE), COARSE, TOPS, "click")


@query(with_views("SELECT hour_i, lev, fid, species, round(value, 4) AS value FROM hours WHERE value <> 0", "coarse", "points", hours=_STACK_HOURS))
def job_02_stack_inventory(spark, d):
    return stacks_by_hour(spark, d).select(F.hour("ts").alias("hour_i"), "lev", "fid", "species", r("value", 4).alias("value"))


@query(with_views("SELECT day_no, fid, lev, pollutant, round(flux, 4) AS flux FROM steps", "cells", "coarse", "w", fire=_FIRES, steps=_FIRE_STEPS.format(step="day_no")))
def job_03_daily_fires(spark, d):
    return fires_by(spark, d, "day").select(hour_no().alias("day_no"), "fid", "lev", "pollutant", r("flux", 4).alias("flux"))


@query(with_views("SELECT hour_no, fid, lev, pollutant, round(flux, 4) AS flux FROM steps", "cells", "coarse", "w", fire=_FIRES, steps=_FIRE_STEPS.format(step="hour_no")))
def job_04_hourly_fires(spark, d):
    return fires_by(spark, d, "hour").select(hour_no().alias("hour_no"), "fid", "lev", "pollutant", r("flux", 4).alias("flux"))


def cross_table(spark: SparkSession, d: str) -> DataFrame:
    """A cross table of area inventories (one for each inventory and sector of the fields), stacks and
    fires; one inventory is switched off."""
    area = flux(spark, d).select("inventory", "sector").distinct().select(F.col("inventory").alias("ei"), "sector", F.lit("area").alias("source_type"), F.lit("yearly").alias("frequency"), F.lit("0, 1; 2").alias("pollutants"), F.when(F.col("inventory") == "R", "0").otherwise("1").alias("active"))
    stacks = load(spark, d, "orders").select(F.lit("stacks").alias("ei"), F.col("o_orderstatus").alias("pollutants")).distinct().select("ei", F.lit("energy").alias("sector"), F.lit("point").alias("source_type"), F.lit("monthly").alias("frequency"), "pollutants", F.lit("1").alias("active"))
    burnt = load(spark, d, "events").where("event_type = 'click'").select(F.lit("fires").alias("ei"), F.col("event_type").alias("pollutants")).distinct().select("ei", F.lit("biomass").alias("sector"), F.lit("point").alias("source_type"), F.lit("hourly").alias("frequency"), "pollutants", F.lit("1").alias("active"))
    rows = area.unionByName(stacks).unionByName(burnt)
    return readers.active_rows(rows.withColumns({c: F.lit(None).cast("string") for c in checks.CROSS_COLUMNS if c not in rows.columns}))


@query(with_views("SELECT hour_i, lev, fid, species, round(sum(value), 3) AS value FROM (SELECT * FROM area UNION ALL SELECT * FROM hours WHERE value <> 0 UNION ALL SELECT hour_no % 24, lev, fid, 'CO', flux FROM steps WHERE pollutant = 'click') GROUP BY 1, 2, 3, 4 HAVING sum(value) <> 0", "cells", "coarse", "flux", "points", "w", area=_AREA_HOURS.format(which="inventory <> 'R' AND pollutant < 3"), hours=_STACK_HOURS, fire=_FIRES, steps=_FIRE_STEPS.format(step="hour_no")))
def job_05_all_inventories(spark, d):
    """Area inventories, stacks and fires that a cross table names as one sum, at the hours of a model day."""

    def area(rows: DataFrame) -> DataFrame:
        keys = rows.select(F.col("ei").alias("inventory"), "sector", F.col("pollutant").cast("int").alias("pollutant")).distinct()
        return area_by_hour(spark, flux(spark, d).join(keys, ["inventory", "sector", "pollutant"], "left_semi"))

    def stack(rows: DataFrame) -> DataFrame:
        return stacks_by_hour(spark, d, rows.select("pollutant").distinct())

    def fire(rows: DataFrame) -> DataFrame:
        burnt = fires_by(spark, d, "hour").join(rows.select("pollutant").distinct(), "pollutant", "left_semi")
        day = F.to_timestamp(F.lit("2024-07-01"))
        return burnt.select(F.timestamp_add("HOUR", F.hour("ts"), day).alias("ts"), "lev", "fid", F.lit("CO").alias("species"), F.col("flux").alias("value"))

    out = jobs.combine(cross_table(spark, d), {"area": area, "stack": stack, "fire_hourly": fire})
    return out.select(F.hour("ts").alias("hour_i"), "lev", "fid", "species", r("value", 3).alias("value"))


@query("SELECT pollutant, count(*) AS n, count(height) AS n_height, round(sum(flux), 4) AS flux, round(sum(height), 4) AS height FROM (SELECT event_type AS pollutant, ts, fid, sum(value) AS flux, any_value(height) AS height FROM (SELECT event_type, ts, user_id % 2592 AS fid, value FROM events WHERE event_type <> 'view') LEFT JOIN (SELECT ts, user_id % 2592 AS fid, sum(value) AS height FROM events WHERE event_type = 'view' GROUP BY 1, 2) USING (ts, fid) GROUP BY 1, 2, 3) GROUP BY 1")
def src_22_fire_field(spark, d):
    """Fires of a table by day, with the height variable of their step and cell (many have none)."""
    e, to = load(spark, d, "events"), sinks.scratch(spark, "fire_field")
    rows = e.groupBy("ts", (F.col("user_id") % 2592).alias("src_fid"), F.col("event_type").alias("variable")).agg(F.sum("value").alias("value"))
    rows.withColumn("day", F.date_format("ts", "yyyyMMdd")).repartition("day").write.partitionBy("day").parquet(to)
    days = [x[0] for x in e.select(F.date_format("ts", "yyyyMMdd")).distinct().collect()]
    names = [x[0] for x in e.where("event_type <> 'view'").select("event_type").distinct().collect()]
    out = readers.read_fire_field(spark, to, sorted(names), "view", days)
    return out.groupBy("pollutant").agg(F.count("*").alias("n"), F.count("height").alias("n_height"), r(F.sum("flux"), 4).alias("flux"), r(F.sum("height"), 4).alias("height"))


def timer_names(log: DataFrame) -> DataFrame:
    """Old timers under new names: two of them are one timer now."""
    new = F.when(F.col("subsection") == "R", "mask").otherwise("rescale")
    return log.select("section", "subsection").distinct().select(F.col("section").alias("old_section"), F.col("subsection").alias("old_subsection"), F.lit("grid").alias("section"), new.alias("subsection"), F.when(F.col("subsection") == "N", -0.25).otherwise(1.0).alias("sign"))


_MAPPED = "SELECT replication, processes, 'grid' AS section, CASE subsection WHEN 'R' THEN 'mask' ELSE 'rescale' END AS subsection, greatest(sum(value * CASE subsection WHEN 'N' THEN -0.25 ELSE 1.0 END), 0) AS value FROM log GROUP BY 1, 2, 3, 4"


@query(with_views("SELECT replication, processes, section, subsection, round(value, 8) AS value FROM mapped", log=_LOG, mapped=_MAPPED))
def src_24_legacy_timers(spark, d):
    log = run_log(spark, d)
    return runlog.map_legacy(log, timer_names(log)).withColumn("value", r("value", 8))


@query(with_views("""SELECT m.section, m.subsection, m.processes, round(m.value, 4) AS value, m.kept, m.removed, round(o.value / m.value, 6) AS speedup, round(o.value / m.value / m.processes, 6) AS efficiency
 FROM means m LEFT JOIN (SELECT * FROM means WHERE processes = 1) o USING (section, subsection)""", log=_LOG, mapped=_MAPPED, means="""SELECT section, subsection, processes, avg(CASE WHEN ok THEN value END) AS value, CAST(count_if(ok) AS BIGINT) AS kept, CAST(count_if(NOT ok) AS BIGINT) AS removed
 FROM (SELECT *, n < 4 OR b = a OR value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) AS ok FROM (SELECT *, count(*) OVER w AS n, quantile_cont(value, 0.25) OVER w AS a, quantile_cont(value, 0.75) OVER w AS b FROM mapped WINDOW w AS (PARTITION BY section, subsection, processes))) GROUP BY 1, 2, 3"""))
def job_17_log_analysis(spark, d):
    log = run_log(spark, d)
    out = jobs.analyse_log(log, timer_names(log))
    return out.select("section", "subsection", "processes", r("value", 4).alias("value"), "kept", "removed", r("speedup").alias("speedup"), r("efficiency").alias("efficiency"))


@query("""SELECT processes, phase, round(sum(value), 4) AS value FROM (SELECT *, max(CASE WHEN subsection <> 'N' THEN 1 ELSE 0 END) OVER (PARTITION BY processes, section) AS detail FROM (SELECT l_linestatus AS section, l_returnflag AS subsection, CAST(1 + l_suppkey % 3 AS INTEGER) AS processes, CASE l_returnflag WHEN 'R' THEN 'write' ELSE 'compute' END AS phase, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3, 4)) WHERE subsection <> 'N' OR detail = 0 GROUP BY 1, 2""")
def agg_19_phases(spark, d):
    li = load(spark, d, "lineitem")
    log = li.groupBy(F.col("l_linestatus").alias("section"), F.col("l_returnflag").alias("subsection"), (F.col("l_suppkey") % 3 + 1).cast("int").alias("processes")).agg(F.sum("l_quantity").alias("value"))
    phases = log.select("section", "subsection").distinct().select("section", "subsection", F.when(F.col("subsection") == "R", "write").otherwise("compute").alias("phase"), (F.col("subsection") == "N").alias("skip_if_detail"))
    return runlog.summarize(log, phases).withColumn("value", r("value", 4))


@query("SELECT id, count(*) AS n, count(*) AS different FROM (SELECT DISTINCT l_partkey % 200 AS id, month(l_shipdate) - 1 AS bucket, l_suppkey % 3 AS fid FROM lineitem) GROUP BY 1 HAVING count(*) <> 36")
def src_05_incomplete_profiles(spark, d):
    profile = load(spark, d, "lineitem").select((F.col("l_partkey") % 200).alias("id"), (F.month("l_shipdate") - 1).alias("bucket"), (F.col("l_suppkey") % 3).alias("fid")).distinct()
    return readers.check_gridded_profile(profile, 3, 12)


@query("SELECT row, col, value FROM (SELECT l_partkey % 100 AS row, l_suppkey % 50 AS col, sum(l_quantity) AS value, max(l_linenumber) AS kind FROM lineitem GROUP BY 1, 2) WHERE kind IN (5, 6)")
def src_20_masked_raster(spark, d):
    px = load(spark, d, "lineitem").groupBy((F.col("l_partkey") % 100).alias("row"), (F.col("l_suppkey") % 50).alias("col"))
    return regrid.masked_raster(px.agg(F.sum("l_quantity").alias("value")), px.agg(F.max("l_linenumber").alias("value")), [5, 6])


@query("SELECT CAST(year(l_shipdate) AS INTEGER) AS Year, CAST(month(l_shipdate) AS INTEGER) AS Mon, CAST(day(l_shipdate) AS INTEGER) AS Day, CAST(dayofyear(l_shipdate) AS INTEGER) AS JDay, 0 AS Hr, " + ", ".join(f"sum(CASE WHEN l_suppkey % 4 = {k} THEN l_quantity END) AS L_{k:07d}" for k in range(4)) + " FROM lineitem GROUP BY 1, 2, 3, 4")
def snk_08_wide_links(spark, d):
    links = load(spark, d, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("ts"), (F.col("l_suppkey") % 4).alias("link"), F.col("l_quantity").alias("value"))
    return roads.wide_links(links, [0, 1, 2, 3])


@query("SELECT l_partkey AS fid, l_suppkey AS link, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def snk_10_repeated_keys(spark, d):
    return roads.repeated_keys(load(spark, d, "lineitem").select(F.col("l_partkey").alias("fid"), F.col("l_suppkey").alias("link")))


@query(with_views("SELECT fid, printf('POLYGON ((%.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f))', lon_min, lat_min, lon_max, lat_min, lon_max, lat_max, lon_min, lat_max, lon_min, lat_min) AS wkt, p0, p1, p2, p3 FROM cells JOIN (SELECT fid, " + ", ".join(f"sum(CASE WHEN pollutant = {k} THEN flux END) AS p{k}" for k in range(4)) + " FROM flux GROUP BY 1) USING (fid)", "cells", "flux"))
def snk_12_cell_polygons(spark, d):
    f = flux(spark, d).groupBy("fid", F.concat(F.lit("p"), "pollutant").alias("variable")).agg(F.sum("flux").alias("value"))
    return sinks.cell_polygons(f, cells(spark), ["p0", "p1", "p2", "p3"])


@query("SELECT src_fid, dst_fid, CAST(row_number() OVER (PARTITION BY dst_fid ORDER BY src_fid) - 1 AS INTEGER) AS number FROM (SELECT DISTINCT l_partkey AS src_fid, l_partkey % 97 AS dst_fid FROM lineitem)")
def win_04_numbered_contributions(spark, d):
    w = load(spark, d, "lineitem").select(F.col("l_partkey").alias("src_fid"), (F.col("l_partkey") % 97).alias("dst_fid")).distinct()
    return stats.number_contributions(w)


@query("SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def srt_03_top_by_group(spark, d):
    o = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return stats.top_k(o, 3, ["o_custkey"], F.desc("o_totalprice"), F.col("o_orderkey"))


# Grids on which points lie, features of several parts ----------------------------------------------


@query(with_views("""SELECT row_i * 37 + col_i AS fid, CASE row_i WHEN 0 THEN -87.5 WHEN 18 THEN 87.5 ELSE -90.0 + 10 * row_i END::DOUBLE AS lat, CASE col_i WHEN 0 THEN -177.5 WHEN 36 THEN 177.5 ELSE -180.0 + 10 * col_i END::DOUBLE AS lon, count(*) AS n, CAST(count(*) AS BIGINT) AS n_inside
 FROM (SELECT CAST(floor((lat + 95) / 10) AS BIGINT) AS row_i, CAST(floor((lon + 185) / 10) AS BIGINT) AS col_i FROM points) GROUP BY row_i, col_i""", "points"))
def grd_03_half_end_cells(spark, d):
    at = points(spark, d).withColumns({"row_i": F.floor((F.col("lat") + 95) / 10).cast("int"), "col_i": F.floor((F.col("lon") + 185) / 10).cast("int")})
    c = grid.global_half_end_cells(spark, 10.0, 10.0).withColumnsRenamed({"lat": "c_lat", "lon": "c_lon"})
    inside = F.col("lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("lon").between(F.col("lon_min"), F.col("lon_max"))
    return at.join(c, ["row_i", "col_i"]).groupBy("fid", F.col("c_lat").alias("lat"), F.col("c_lon").alias("lon")).agg(F.count("*").alias("n"), F.count_if(inside).alias("n_inside"))


_NEST = {"centre_lat": 20.0, "centre_lon": 10.0, "west": -60.0, "south": -40.0, "inc_rlat": 5.0, "inc_rlon": 5.0}


@query(with_views("""SELECT row_i * 30 + col_i AS fid, n, round(degrees(asin(sin(radians(20)) * cos(y) * cos(x) + cos(radians(20)) * sin(y))), 6) AS lat, round(10 + degrees(atan2(cos(y) * sin(x), cos(radians(20)) * cos(y) * cos(x) - sin(radians(20)) * sin(y))), 6) AS lon
 FROM (SELECT row_i, col_i, count(*) AS n, radians(-50.0::DOUBLE + 2.5 * col_i) AS x, radians(-35.0::DOUBLE + 2.5 * row_i) AS y FROM (SELECT CAST(floor((rlat + 36.25) / 2.5) AS BIGINT) AS row_i, CAST(floor((rlon + 51.25) / 2.5) AS BIGINT) AS col_i FROM
 (SELECT degrees(asin(cos(radians(20)) * sin(b) - sin(radians(20)) * cos(b) * cos(a))) AS rlat, degrees(atan2(cos(b) * sin(a), cos(radians(20)) * cos(b) * cos(a) + sin(radians(20)) * sin(b))) AS rlon FROM (SELECT radians(lon - 10) AS a, radians(lat) AS b FROM points)))
 WHERE row_i BETWEEN 0 AND 19 AND col_i BETWEEN 0 AND 29 GROUP BY 1, 2)""", "points"))
def grd_05_points_in_nested_cells(spark, d):
    """Points by the nested cell whose native box holds them; other points lie outside the nest."""
    rlon, rlat = grid.lonlat_to_rotated(F.col("lon"), F.col("lat"), _NEST["centre_lon"], _NEST["centre_lat"])
    at = points(spark, d).select(F.floor((rlat + 36.25) / 2.5).cast("int").alias("row_i"), F.floor((rlon + 51.25) / 2.5).cast("int").alias("col_i"))
    nest = grid.nested_rotated_cells(spark, _NEST, 2, 3, 2, 20, 30)
    return at.groupBy("row_i", "col_i").agg(F.count("*").alias("n")).join(nest, ["row_i", "col_i"]).select("fid", "n", r("lat").alias("lat"), r("lon").alias("lon"))


@query(with_views("SELECT pollutant, count(*) AS n, count(*) AS n_stations, round(min(lat), 2) AS lat FROM points WHERE abs(lat) <= 60 GROUP BY 1", "points"))
def grd_09_stations(spark, d):
    """Points as stations; those whose latitude, read as 1.5 times itself, is none drop out."""
    p = points(spark, d).withColumn("high", F.col("lat") * 1.5)
    return grid.stations(p, "high").groupBy("pollutant").agg(F.count("*").alias("n"), F.count_distinct("station").alias("n_stations"), r(F.min("lat"), 2).alias("lat"))


_CELL = (("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max"))
_CELL_M2 = f"({_lhuilier(_CELL[0], _CELL[1], _CELL[2])} + {_lhuilier(_CELL[0], _CELL[2], _CELL[3])}) * 40589641.0"


@query(with_views(f"SELECT nationkey AS feature_id, round(sum({_CELL_M2}) / 1e3, 3) AS area_1000km2 FROM cells WHERE fid IN (SELECT fid FROM flux WHERE inventory = 'A') GROUP BY 1", "cells", "flux"))
def grd_14_area_of_parts(spark, d):
    """Countries as features of many parts: their cells with emissions of one inventory, each a ring of corners."""
    emitting = flux(spark, d).where("inventory = 'A'").select("fid").distinct()
    parts = cells(spark).join(emitting, "fid", "left_semi").select(F.col("nationkey").alias("feature_id"), grid.corner_ring(F.col("lon"), F.col("lat"), 5.0, 5.0).alias("ring"))
    return grid.feature_area(parts).select("feature_id", r(F.col("area_m2") / 1e9, 3).alias("area_1000km2"))


@query(with_views(f"SELECT fid, round(sum(flux) / any_value({_CELL_M2}) * 1e3, 6) AS per_1000km2 FROM flux JOIN cells USING (fid) GROUP BY 1", "cells", "flux"))
def grd_15_flux_per_area(spark, d):
    total = flux(spark, d).groupBy("fid").agg(F.sum("flux").alias("flux"))
    return total.join(grid.with_cell_area(cells(spark)), "fid").select("fid", r(F.col("flux") / F.col("cell_area_m2") * 1e9).alias("per_1000km2"))


@query("SELECT p_partkey AS id, 'C' || p_size AS kind, x AS xmin, x + s AS xmax, y AS ymin, y + s AS ymax FROM (SELECT p_partkey, p_size, p_partkey * 7 % 300 - 150 AS x, p_partkey * 11 % 140 - 70 AS y, 1 + p_size % 5 AS s FROM part) WHERE x + s >= -20.5 AND x <= 40.5 AND y + s >= -10.5 AND y <= 50.5")
def src_16_layer_near_box(spark, d):
    k, s = F.col("p_partkey"), 1 + F.col("p_size") % 5
    x, y = (k * 7 % 300 - 150).cast("double"), (k * 11 % 140 - 70).cast("double")
    layer = load(spark, d, "part").select(k.alias("id"), F.concat(F.lit("C"), "p_size").alias("kind"), k.alias("other"), polygons.box(x, x + s, y, y + s).alias("ring"))
    return spatial.prepare_layer(layer, ["id", "kind"], -20.5, 40.5, -10.5, 50.5).select("id", "kind", *[F.col(c).cast("long").alias(c) for c in ("xmin", "xmax", "ymin", "ymax")])


@query(with_views("SELECT m.method, c.fid, k.fid AS owner FROM cells c JOIN coarse k ON k.fid = (c.row_i // 2) * 36 + c.col_i // 2 CROSS JOIN (VALUES ('centroid'), ('intersection')) m(method) WHERE k.fid IN (SELECT (l_partkey * 7 + l_suppkey) % 648 FROM lineitem)", "cells", "coarse"))
def jon_24_owner_by_method(spark, d):
    """Coarse cells with line items as a layer; fine cells take its name by both methods that know an outside."""
    c = F.col
    there = load(spark, d, "lineitem").select(((c("l_partkey") * 7 + c("l_suppkey")) % 648).alias("fid")).distinct()
    layer = cells(spark, COARSE).join(there, "fid", "left_semi").select(c("fid").alias("owner"), polygons.box(c("lon_min"), c("lon_max"), c("lat_min"), c("lat_max")).alias("ring"))
    found = [spatial.from_layer(cells(spark), layer, "owner", m).select(F.lit(m).alias("method"), "fid", "owner") for m in ("centroid", "intersection")]
    return found[0].unionByName(found[1]).where("owner IS NOT NULL")


# Selections, calendars and factors -----------------------------------------------------------------


@query(with_views("SELECT variable, fid, round(value, 6) AS value FROM field WHERE ts = (SELECT min(ts) FROM field)", "field"))
def flt_02_first_step(spark, d):
    f = field(spark, d)
    first = f.agg(F.min("ts").cast("string")).first()[0]
    return filters.select_time(f, first).select("variable", "fid", r("value").alias("value"))


@query(with_views("SELECT variable, count(*) AS n, round(sum(value), 4) AS total FROM field WHERE variable IN ('view', 'click') GROUP BY 1", "field"))
def flt_04_kept_variables(spark, d):
    return filters.keep_variables(field(spark, d), ["view", "click"]).groupBy("variable").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


_REGION_TOTALS = "SELECT r_name AS region, c_mktsegment AS pollutant, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"


@query(f"SELECT * FROM ({_REGION_TOTALS}) WHERE region IN ('EUROPE', 'ASIA')")
def flt_11_totals_of_listed_regions(spark, d):
    c, n, g = load(spark, d, "customer"), load(spark, d, "nation"), load(spark, d, "region")
    named = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(g, n["n_regionkey"] == g["r_regionkey"])
    totals = named.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("pollutant")).agg(r(F.sum("c_acctbal"), 2).alias("total"))
    return filters.select_regions(totals, filters.parse_regions(" EUROPE, ASIA,EUROPE "))


@query(with_views("SELECT variable, count(*) AS n, round(sum(CASE WHEN variable < 'm' THEN value ELSE 2 * value END), 4) AS total FROM field GROUP BY 1", "field"))
def set_01_first_dataset_wins(spark, d):
    f = field(spark, d)
    doubled = f.withColumn("value", 2 * F.col("value"))
    return filters.union_first(f.where("variable < 'm'"), doubled, doubled.withColumn("value", F.lit(0.0))).groupBy("variable").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query("""SELECT o_orderpriority AS country, CAST(CASE WHEN h.day IS NOT NULL THEN 6 ELSE isodow(o_orderdate) - 1 END AS INTEGER) AS weekday_i, count(*) AS n FROM orders
 LEFT JOIN (SELECT DISTINCT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_custkey % 9 = 0) h ON p = o_orderpriority AND h.day = CAST(o_orderdate AS DATE) GROUP BY 1, 2""")
def tmp_04_holidays_are_sundays(spark, d):
    """Orders by weekday; a country's holidays are the days on which some customers ordered there."""
    o = load(spark, d, "orders").select(F.col("o_orderpriority").alias("country"), F.col("o_orderdate").cast("timestamp").alias("local_ts"), "o_custkey")
    holidays = o.where("o_custkey % 9 = 0").select("country", F.to_date("local_ts").alias("date"))
    calendar = temporal.with_calendar(o.drop("o_custkey"), "local_ts")
    return temporal.holidays_as_sunday(calendar, holidays, "country").groupBy("country", "weekday_i").agg(F.count("*").alias("n"))


@query("""SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS run, (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = m) AS n FROM
 (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders), (SELECT max(o_orderdate) FROM orders)::TIMESTAMP, INTERVAL 1 MONTH)) AS m)""")
def tmp_11_monthly_runs(spark, d):
    """Runs that start on the first of each month of the orders, and the orders of each."""
    o = load(spark, d, "orders").select(F.trunc("o_orderdate", "MM").alias("sim_date"), F.to_date("o_orderdate").alias("day"))
    start, end = o.agg(F.min("sim_date").cast("string"), F.max("day").cast("string")).first()
    runs = temporal.start_dates(spark, start, end, "monthly")
    return runs.join(o, "sim_date", "left").groupBy((F.year("sim_date") * 100 + F.month("sim_date")).alias("run")).agg(F.count("day").alias("n"))


@query(with_views("SELECT pollutant, count(*) AS n, round(sum(flux * coalesce(factor, 1.0)), 4) AS flux FROM flux LEFT JOIN (SELECT CAST(s_suppkey % 3 AS INTEGER) AS pollutant, count(*) / 7.0::DOUBLE AS factor FROM supplier GROUP BY 1) USING (pollutant) GROUP BY 1", "flux"))
def rsc_04_one_region(spark, d):
    """Three of four pollutants have a factor; one region takes in all cells."""
    factor = load(spark, d, "supplier").groupBy((F.col("s_suppkey") % 3).cast("int").alias("pollutant")).agg((F.count("*") / 7).alias("factor")).withColumn("region_id", F.lit("all"))
    return rescale.apply_everywhere(flux(spark, d), factor, "pollutant").groupBy("pollutant").agg(F.count("*").alias("n"), r(F.sum("flux"), 4).alias("flux"))


@query("SELECT k AS id, round(f0, 6) AS ground, round(f0 + f1 + f2 + f3, 6) AS total, 4 AS n FROM (" + with_views("""SELECT k, sum(f) FILTER (lev = 0) AS f0, sum(f) FILTER (lev = 1) AS f1, sum(f) FILTER (lev = 2) AS f2, sum(f) FILTER (lev = 3) AS f3 FROM (SELECT k, lev, sum(weight * greatest(0, least(ltop, ttop) - greatest(lbot, tbot)) / (ltop - lbot)) / any_value(s) AS f FROM
 (SELECT s_suppkey AS k, unnest([[0, 50 + s_suppkey % 30, 1 + s_suppkey % 3], [50 + s_suppkey % 30, 400, 2], [400, 400 + s_suppkey % 50 * 20 + 10, 1.5]]) AS l, 4.5 + s_suppkey % 3 AS s FROM supplier) x, (VALUES (0, 0, 40), (1, 40, 120), (2, 120, 300), (3, 300, 600)) m(lev, tbot, ttop), LATERAL (SELECT l[1] AS lbot, l[2] AS ltop, l[3] AS weight) GROUP BY 1, 2) GROUP BY 1""") + ")")
def vrt_01_profiles_as_arrays(spark, d):
    """A profile file read, mapped to model levels and gathered as one array for each profile."""
    k = F.col("s_suppkey")
    tops, weights = F.concat_ws(",", 50 + k % 30, F.lit(400), 400 + k % 50 * 20 + 10), F.concat_ws(", ", 1 + k % 3, F.lit("2"), F.lit("1.5"))
    table = load(spark, d, "supplier").select(k.alias("ID"), tops.alias("layers"), weights.alias("weights"))
    levels = spark.createDataFrame([(i, b, t) for i, (b, t) in enumerate(zip([0.0, *TOPS[:-1]], TOPS))], "lev int, bottom double, top double")
    v = vertical.level_array(vertical.level_weights(readers.read_vertical_profiles(spark, as_csv(table, "vertical", sep=";")), levels))
    return v.select(F.col("id").cast("long").alias("id"), r(F.col("vfac")[0]).alias("ground"), r(F.aggregate("vfac", F.lit(0.0), lambda a, x: a + x)).alias("total"), F.size("vfac").alias("n"))


# Files and caches ----------------------------------------------------------------------------------


def cross_rows(spark: SparkSession, d: str) -> DataFrame:
    """A cross table of line items with some odd rows."""
    n = F.col("l_linenumber")
    own = {
        "ei": F.concat(F.lit("EI"), F.col("l_suppkey") % 7), "sector": F.col("l_linestatus"), "ref_year": F.when(F.col("l_partkey") % 13 == 0, "two").otherwise(F.year("l_shipdate").cast("string")),
        "active": F.when(F.col("l_quantity") > 10, "1").otherwise("0"), "pollutants": F.when(n % 3 == 0, "nox,co").when(n % 3 == 1, "nox, so2 co").otherwise("pm25"),
        "frequency": F.when(F.col("l_partkey") % 5 == 0, "weekly").otherwise("monthly"), "source_type": F.when(n == 7, "line").otherwise("area"),
    }
    return load(spark, d, "lineitem").select(*[own.get(c, F.lit("-")).alias(c) for c in checks.CROSS_COLUMNS])


@query("""SELECT ei, sector, ref_year, trim(p) AS pollutant, count(*) AS n FROM (SELECT 'EI' || l_suppkey % 7 AS ei, l_linestatus AS sector, CASE WHEN l_partkey % 13 = 0 THEN 'two' ELSE CAST(year(l_shipdate) AS VARCHAR) END AS ref_year,
 unnest(string_split_regex(CASE WHEN l_linenumber % 3 = 0 THEN 'nox,co' WHEN l_linenumber % 3 = 1 THEN 'nox, so2 co' ELSE 'pm25' END, '[,;\\s]+')) AS p FROM lineitem WHERE l_quantity > 10) GROUP BY 1, 2, 3, 4""")
def src_03_cross_table_file(spark, d):
    rows = readers.read_cross_table(spark, as_csv(cross_rows(spark, d), "cross", sep=";"))
    return rows.groupBy("ei", "sector", "ref_year", "pollutant").agg(F.count("*").alias("n"))


@query("""SELECT * FROM (SELECT 'EI' || l_suppkey % 7 AS ei, CASE WHEN l_linenumber = 7 THEN 'source_type' WHEN l_partkey % 5 = 0 THEN 'frequency' WHEN l_partkey % 13 = 0 THEN 'ref_year' END AS problem, count(*) AS n FROM lineitem GROUP BY 1, 2) WHERE problem IS NOT NULL""")
def chk_11_cross_table_errors(spark, d):
    return checks.cross_table_errors(cross_rows(spark, d)).groupBy("ei", "problem").agg(F.count("*").alias("n"))


@query("""SELECT 'P' || p AS id, CAST(k AS INTEGER) AS bucket, count(*) FILTER (h = k)::DOUBLE AS factor FROM (SELECT user_id % 40 AS p, hour(ts) AS h FROM events), range(24) t(k) WHERE p % 2 = 0 GROUP BY 1, 2""")
def src_04_profile_files(spark, d):
    """Hourly profiles from a file, those that are asked for; each must stand there once."""
    e = load(spark, d, "events").select(F.concat(F.lit("P"), F.col("user_id") % 40).alias("ID"), F.hour("ts").alias("h"))
    to = as_csv(e.groupBy("ID").pivot("h", list(range(24))).agg(F.count("ID")).na.fill(0), "profiles")
    wanted = [x[0] for x in e.select("ID").distinct().collect() if int(x[0][1:]) % 2 == 0]  # 20 at most
    return readers.read_profile(spark, to, wanted).join(spark.createDataFrame([(w,) for w in wanted], "id string"), "id", "left_semi")


@query(with_views("SELECT CAST(epoch(ts) // 3600 AS BIGINT) AS hour_no, variable, fid, round(CASE WHEN ts >= (SELECT date_trunc('day', max(ts)) FROM field) THEN 2 * value ELSE value END, 6) AS value FROM field", "field"))
def snk_01_replaced_steps(spark, d):
    """All steps written, then those of the last day again with other values."""
    f, to = field(spark, d), sinks.scratch(spark, "steps")
    sinks.write_steps(f, to)
    last = f.agg(F.date_trunc("day", F.max("ts")).alias("last"))
    sinks.write_steps(f.join(F.broadcast(last), F.col("ts") >= F.col("last")).drop("last").withColumn("value", 2 * F.col("value")), to)  # one row
    return spark.read.schema(f.schema).parquet(to).select(hour_no().alias("hour_no"), "variable", "fid", r("value").alias("value"))


@query("SELECT inventory, sector, pollutant, round(sum(flux), 4) AS flux, count(*) AS n FROM (" + with_views("SELECT * FROM flux", "flux") + ") GROUP BY 1, 2, 3")
def snk_05_kept_table(spark, d):
    """A cache's second reader gets what the first one made, whatever it would make itself."""
    to = f"{sinks.scratch(spark, 'proxies')}/{sinks.cache_name('A', {'kind': 'points', 'weight': 'capacity'})}"
    sinks.cached(spark, to, lambda: flux(spark, d))
    again = sinks.cached(spark, to, lambda: flux(spark, d).limit(0))
    return again.groupBy("inventory", "sector", "pollutant").agg(r(F.sum("flux"), 4).alias("flux"), F.count("*").alias("n"))


@query("SELECT DISTINCT 'no proxy for ' || b AS message FROM (SELECT p_brand AS b FROM part WHERE p_size < 30 UNION ALL SELECT p_type FROM part WHERE p_size > 20)")
def snk_07_kept_warnings(spark, d):
    """Warnings of two runs, some of them in both, each kept once."""
    p, to = load(spark, d, "part"), f"{sinks.scratch(spark, 'proxy')}/warnings"
    say = lambda c: F.concat(F.lit("no proxy for "), c).alias("message")
    sinks.stored_warnings(spark, to, p.where("p_size < 30").select(say("p_brand")))
    sinks.stored_warnings(spark, to, p.where("p_size BETWEEN 10 AND 29").select(say("p_brand")).union(p.where("p_size > 20").select(say("p_type"))))
    return sinks.stored_warnings(spark, to)


@query("SELECT CAST(l_linenumber - 1 AS INTEGER) AS lev, CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS DOUBLE) AS encoded_date, round(sum(l_quantity), 2) AS value FROM lineitem GROUP BY 1, 2")
def snk_11_output_by_level(spark, d):
    """One output for each level with its dates as numbers."""
    to = sinks.scratch(spark, "levels")
    f = load(spark, d, "lineitem").groupBy((F.col("l_linenumber") - 1).alias("lev"), F.to_timestamp(F.to_date("l_shipdate")).alias("ts")).agg(r(F.sum("l_quantity"), 2).alias("value"))
    sinks.write_levels(f, to)
    return spark.read.parquet(to).select("lev", "encoded_date", "value")


@query("SELECT c_custkey AS fid, c_mktsegment AS sector, c_acctbal AS value, CAST(rank() OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS line FROM customer")
def snk_13_ordered_debug_table(spark, d):
    """A debug table's lines as they stand in its files, one file after another."""
    to = sinks.scratch(spark, "debug")
    sinks.write_debug(load(spark, d, "customer").select(F.col("c_custkey").alias("fid"), F.col("c_mktsegment").alias("sector"), F.col("c_acctbal").alias("value")), to, "value", "fid")
    lines = spark.read.schema("fid long, sector string, value double").csv(to, header=True).select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    before = Window.partitionBy("file").orderBy("at")
    earlier = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    ahead = lines.groupBy("file").agg(F.count("*").alias("n")).select("file", F.coalesce(earlier, F.lit(0)).alias("ahead"))
    return lines.join(ahead, "file").select("fid", "sector", "value", (F.col("ahead") + F.row_number().over(before)).alias("line"))


# Checks --------------------------------------------------------------------------------------------


@query("SELECT p_brand AS profile, p_type AS species, count(*) AS n FROM part WHERE p_size % 7 < 4 GROUP BY 1, 2")
def chk_03_empty_expressions(spark, d):
    empty = F.when(F.col("p_size") % 7 == 0, None).when(F.col("p_size") % 7 == 1, "  ").when(F.col("p_size") % 7 == 2, "NaN").when(F.col("p_size") % 7 == 3, " null")
    rows = load(spark, d, "part").select(F.col("p_brand").alias("profile"), F.col("p_type").alias("species"), F.when(F.col("p_size") % 7 < 4, empty).otherwise(F.col("p_name")).alias("expr"))
    return speciation.incomplete(rows).groupBy("profile", "species").agg(F.count("*").alias("n"))


@query("SELECT * FROM (SELECT o_orderpriority AS variable, count(DISTINCT f) AS n, CAST(2592 AS BIGINT) AS g_n, count(DISTINCT f) FILTER (f < 2592) AS k FROM (SELECT o_orderpriority, CASE WHEN o_custkey % 50 = 0 AND o_orderpriority < '3' THEN 3000 + o_custkey ELSE o_orderkey * 7 % 2592 END AS f FROM orders) GROUP BY 1) WHERE n <> 2592 OR k <> 2592")
def chk_10_grids_of_a_cache(spark, d):
    """Cells of each cached variable against the grid; some hold ids beyond it."""
    odd = (F.col("o_custkey") % 50 == 0) & (F.col("o_orderpriority") < "3")
    table = load(spark, d, "orders").select(F.col("o_orderpriority").alias("variable"), F.when(odd, 3000 + F.col("o_custkey")).otherwise(F.col("o_orderkey") * 7 % 2592).alias("fid"))
    known = table.where("fid < 2592").groupBy("variable").agg(F.count_distinct("fid").alias("k"))
    return checks.grid_differences(table, cells(spark)).join(known, "variable")


@query("SELECT p_brand AS layer, p_type AS kind, count(*) AS n FROM (SELECT p_brand, CASE p_size % 4 WHEN 0 THEN 'Point' WHEN 1 THEN 'Polygon' WHEN 2 THEN 'LineString' END AS p_type FROM part) WHERE p_type IS NULL OR p_type <> 'Point' GROUP BY 1, 2")
def chk_12_other_geometries(spark, d):
    kind = F.when(F.col("p_size") % 4 == 0, "Point").when(F.col("p_size") % 4 == 1, "Polygon").when(F.col("p_size") % 4 == 2, "LineString")
    layer = load(spark, d, "part").select(F.col("p_brand").alias("layer"), kind.alias("kind"))
    return checks.other_geometries(layer).groupBy("layer", "kind").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT 'p' || l_partkey % 90 AS pollutant FROM lineitem WHERE l_partkey % 90 NOT IN (SELECT s_suppkey % 40 FROM supplier UNION SELECT 5 + s_nationkey FROM supplier)")
def chk_16_unused_inputs(spark, d):
    """Input pollutants that no expression names; p4 isn't named by p45."""
    inputs = load(spark, d, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey") % 90).alias("pollutant"))
    profiles = load(spark, d, "supplier").select(F.concat(F.lit("0.5 * p"), F.col("s_suppkey") % 40, F.lit(" + p"), 5 + F.col("s_nationkey")).alias("expr"))
    return speciation.unused_inputs(inputs, profiles)


@query("""SELECT 'v' || p_partkey AS variable, units, new_units, p_name || ' ' || suffix AS long_name FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'kmol.m-2.s-1' ELSE 'kg.m-2.s-1' END AS units FROM part) JOIN (VALUES ('kmol.m-2.s-1', 'mol.s-1', 'as gas'), ('kg.m-2.s-1', 'g.s-1', 'as aerosol')) t(units, new_units, suffix) USING (units)""")
def uni_07_unit_labels(spark, d):
    variables = load(spark, d, "part").select(F.concat(F.lit("v"), "p_partkey").alias("variable"), F.when(F.col("p_size") % 2 == 0, "kmol.m-2.s-1").otherwise("kg.m-2.s-1").alias("units"), F.col("p_name").alias("long_name"))
    labels = spark.createDataFrame([("kmol.m-2.s-1", "mol.s-1", "as gas"), ("kg.m-2.s-1", "g.s-1", "as aerosol")], "units string, new_units string, suffix string")
    return units.relabel(variables, labels)
