"""Hand-computed cases and edge cases of single operators."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflux.functions import arithmetic, parse_any_timestamp, parse_bool, parse_list
from gridflux.operators import checks, compare, filters, grid, masks, regrid, rescale, roads, runlog, spatial, speciation, stats, temporal, units, vertical
from gridflux.operators.points import fire_flux
from gridflux.operators.regrid import RegularGrid
from gridflux.sources import readers, sinks


def rows(df, *order):
    return [tuple(x) for x in (df.orderBy(*order) if order else df).collect()]


# Vertical


@pytest.mark.parametrize(
    ("layers", "weights", "expected"),
    [("300", "1", [1 / 3, 1 / 3]), ("100,300", "0.2,0.8", [0.2, 0.4]), ("100,200", "40,60", [0.4, 0.6]), ("200,300", "0,1", [0, 0])],
)
def test_vertical_profiles(spark, layers, weights, expected):
    p = spark.createDataFrame([("a", layers, weights)], "id string, layers string, weights string")
    levels = spark.createDataFrame([(0, 0.0, 100.0), (1, 100.0, 200.0)], "lev int, bottom double, top double")
    got = rows(vertical.level_weights(vertical.profile_layers(p), levels).select("lev", "factor"), "lev")
    assert [f for _, f in got] == pytest.approx(expected)


@pytest.mark.parametrize(("tops", "level", "expected"), [([100, 200], 1, [50, 50]), ([100, 400], 1, [25, 75]), ([100, 200, 300], 1, [50, 50, 0])])
def test_fire_weights(spark, tops, level, expected):
    w = spark.range(1).select(vertical.fire_weights(F.lit(level), tops)).first()[0]
    assert [100 * x for x in w] == pytest.approx(expected)
    half = spark.range(1).select(vertical.fire_weights(F.lit(level), tops, "50_top")).first()[0]
    assert sum(half) == pytest.approx(1) and half[level] == pytest.approx(0.5)


def test_fire_flux_keeps_mass(spark):
    fires = spark.createDataFrame([(1, "co", 50.0, 200.0)], "src_fid long, pollutant string, flux double, height double")
    area = lambda a, f: spark.createDataFrame([(f, a)], "fid long, area_m2 double")
    owners = spark.createDataFrame([(1, 7)], "src_fid long, dst_fid long")
    got = rows(fire_flux(fires, area(2.0, 1), owners, area(4.0, 7), [100, 200, 300], "uniform", F.col("height")), "lev")
    assert got == [(7, 0, "co", 12.5), (7, 1, "co", 12.5)]


def test_injection_level(spark):
    df = spark.createDataFrame([(h,) for h in (0.0, 40.0, 40.1, 599.0, 601.0, None)], "h double")
    got = [x[0] for x in df.select(vertical.injection_level(F.col("h"), [40, 120, 300, 600])).collect()]
    assert got == [0, 0, 1, 3, 0, 0]


def test_vertical_interpolation(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0], [10.0, 20.0, 0.0])], "z array<double>, v array<double>")
    at = lambda kind, **fill: [x[2] for x in rows(vertical.interpolate_linear(df, [0.5, 1.5, 3.0, 5.0], kind, **fill), "lev")]
    assert at("linear") == [10, 15, 10, 0]
    assert at("linear", below="extrapolate", above=-1) == [5, 15, 10, -1]
    assert at("previous") == [10, 10, 20, 0] and at("next") == [10, 20, 0, 0]


def test_cubic_interpolation_meets_its_points(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 2.0, 3.0], [0.0, 1.0, 8.0, 27.0])], "k long, z array<double>, v array<double>")
    got = [x[2] for x in rows(vertical.interpolate_spline(df, [0.0, 1.0, 2.5, 3.0], ["k"]), "lev")]
    assert got[0] == pytest.approx(0) and got[1] == pytest.approx(1) and got[3] == pytest.approx(27) and 8 < got[2] < 27


# Masks and rescaling


def test_mask_product(spark):
    a = spark.createDataFrame([("m", 1, 1.5), ("m", 2, 0.5), ("m", 3, 1.0)], "k string, fid long, factor double")
    b = spark.createDataFrame([("m", 1, 1.0), ("m", 2, 1.0), ("m", 3, 0.0)], "k string, fid long, factor double")
    assert rows(masks.mask_product(a, b, "k"), "fid") == [("m", 1, 1.5), ("m", 2, 0.5), ("m", 3, 0.0)]


def test_country_factors(spark):
    text = spark.createDataFrame([("m", "ESP 0.5, AND 0.2"), ("n", "2"), ("o", None), ("p", "ESP x")], "k string, t string")
    f = masks.parse_factors(text, "k", "t")
    cells = spark.createDataFrame([(0, "ESP"), (1, "FRA"), (2, "UNK")], "fid long, iso3 string")
    got = {(k, i): v for k, i, v in rows(masks.cell_factors(cells, f, "k"))}
    assert got[("m", 0)] == 0.5 and got[("m", 1)] == 1 and got[("n", 2)] == 2 and got[("o", 1)] == 1
    assert [x[0] for x in rows(masks.bad_factors(f).select("k"))] == ["p"]
    lost = compare.missing_codes(f.where("k = 'm' AND iso3 IS NOT NULL"), cells, "iso3")
    assert rows(lost) == [("AND",)]


def test_inclusion(spark):
    text = spark.createDataFrame([("a", "+ ESP FRA"), ("b", "- ESP"), ("c", "ESP"), ("d", None)], "k string, t string")
    f = masks.parse_inclusion(text, "k", "t")
    cells = spark.createDataFrame([(0, "ESP"), (1, "ITA")], "fid long, iso3 string")
    got = {(k, i): v for k, i, v in rows(masks.cell_factors(cells, f, "k"))}
    assert [got[(k, i)] for k in "abcd" for i in (0, 1)] == [1, 0, 0, 1, 1, 1, 1, 1]
    assert {k for k, in rows(f.where("ignored").select("k"))} == {"c"}


def test_codes(spark):
    df = spark.createDataFrame([(" esp\x00",), ("NAN",), ("ES",), (None,)], "c string")
    assert [x[0] for x in df.select(masks.normalize_code(F.col("c"), 3)).collect()] == ["ESP", None, None, None]


def test_totals_and_factors(spark):
    wide = spark.createDataFrame([("Barcelona", "t/year", 2.0, 3.0), ("Girona", "kg/year", 4.0, 5.0)], "region string, units string, co double, nox double")
    assert [x[2] for x in rows(rescale.read_totals(wide, ["region"]), "region", "pollutant")] == [2000, 3000, 4, 5]
    own = spark.createDataFrame([("B", "co", 10.0), ("B", "nox", 20.0), ("B", "so2", 40.0), ("G", "co", 30.0), ("G", "nox", 30.0), ("G", "so2", 0.0)], "region_id string, pollutant string, inventory_kg double")
    local = spark.createDataFrame([("B", "co", 20.0), ("G", "co", 0.0), ("B", "nox", None), ("G", "nox", 90.0)], "region_id string, pollutant string, total_kg double")
    got = [x[2] for x in rows(rescale.factors(own, local, ["region_id", "pollutant"]).select("region_id", "pollutant", "factor"), "region_id", "pollutant")]
    assert got == [2.0, None, None, 0.0, 3.0, None]


def test_regional_totals(spark):
    flux = spark.createDataFrame([(i, p, v) for p, vs in (("co", [1, 1, 1, 1]), ("nox", [1, 2, 3, 4])) for i, v in enumerate(map(float, vs))], "fid long, pollutant string, flux double")
    area = spark.createDataFrame([(i, 2.0) for i in range(4)], "fid long, area_m2 double")
    region = spark.createDataFrame([(0, "in"), (2, "in"), (1, "out"), (3, "out")], "fid long, region_id string")
    s = 31_536_000
    got = {(a, b): v for a, b, v in rows(rescale.inventory_totals(flux, area, region, rescale.period_seconds(F.lit("yearly"), F.lit(2020), F.lit(2)), "pollutant"))}
    assert got == {("in", "co"): 4 * s, ("in", "nox"): 8 * s, ("out", "co"): 4 * s, ("out", "nox"): 12 * s}


def test_one_region_everywhere(spark):
    flux = spark.createDataFrame([(1, "co", 2.0), (2, "nox", 2.0)], "fid long, pollutant string, flux double")
    f = spark.createDataFrame([("a", "co", 3.0)], "region_id string, pollutant string, factor double")
    assert [x[2] for x in rows(rescale.apply_everywhere(flux, f, "pollutant"), "fid")] == [6.0, 2.0]
    with pytest.raises(ValueError, match="one region"):
        rescale.apply_everywhere(flux, f.unionByName(f.withColumn("region_id", F.lit("b"))), "pollutant")


# Regridding


def test_points_proxy_shares(spark):
    src, dst = RegularGrid(0, 0, 1, 1, 4, 4), RegularGrid(0, 0, 0.5, 0.5, 8, 8)
    p = spark.createDataFrame([(0.25, 0.25, 1.0), (0.75, 0.75, 3.0), (0.1, 0.1, -1.0), (0.1, 0.1, None), (0.1, 0.1, float("nan"))], "lon double, lat double, weight double")
    assert rows(regrid.points_proxy(p, src, dst), "dst_fid") == [(0, 0, 0.25), (0, 9, 0.75)]


def test_owner_of_edges(spark):
    g = RegularGrid(0, 0, 1, 1, 2, 2)
    p = spark.createDataFrame([(0.0, 0.0), (1.0, 0.5), (2.0, 2.0), (2.1, 0.0), (None, 1.0)], "lon double, lat double")
    assert [x[2] for x in rows(regrid.owned_points(p, g))] == [0, 1, 3, None, None]


def test_conservative_keeps_mass(spark):
    src = grid.regular_cells(spark, 10, 10, 0.1, 0.1, 2, 2)
    w = regrid.conservative_weights(src, RegularGrid(10, 10, 1, 1, 2, 2))
    field = spark.createDataFrame([(i, float(i + 1)) for i in range(4)], "fid long, value double")
    got = rows(regrid.apply_weights(field, w))
    assert [g[0] for g in got] == [0] and got[0][1] == pytest.approx(10)
    odd = regrid.conservative_weights(grid.regular_cells(spark, 0, 0, 3.0, 7.0, 5, 5), RegularGrid(-2, -1, 1.7, 2.3, 30, 30))
    assert all(v == pytest.approx(1) for _, v in rows(odd.groupBy("src_fid").agg(F.sum("weight"))))


def test_nearest_neighbours_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    s, d = rng.uniform((-180, -90), (180, 90), (300, 2)), rng.uniform((-180, -90), (180, 90), (40, 2))
    frame = lambda a: spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(a)], "fid long, lon double, lat double")

    def xyz(a):
        e2 = (2 - 1 / 298.257223563) / 298.257223563
        lon, lat = np.radians(a.T)
        n = 6378137 / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        return np.stack([n * np.cos(lat) * np.cos(lon), n * np.cos(lat) * np.sin(lon), n * (1 - e2) * np.sin(lat)], 1)

    gaps = np.linalg.norm(xyz(d)[:, None] - xyz(s)[None], axis=2)
    want = {(j, i) for i in range(40) for j in np.argsort(gaps[i])[:4].tolist()}
    got = regrid.nearest_neighbours(frame(s), frame(d), 4)
    assert {(a, b) for a, b in rows(got.select("src_fid", "dst_fid"))} == want
    assert all(v == pytest.approx(1) for _, v in rows(got.groupBy("dst_fid").agg(F.sum("weight"))))


def test_lines_proxy_splits_by_length(spark):
    line = spark.sql("SELECT 1 AS link, 1.0D AS weight, array(named_struct('x', 0.25D, 'y', 0.25D), named_struct('x', 1.75D, 'y', 0.25D)) AS line")
    w = regrid.lines_proxy(line, RegularGrid(0, 0, 2, 2, 1, 1), RegularGrid(0, 0, 1, 1, 2, 2))
    assert [(a, b, round(c, 9)) for a, b, c in rows(w, "dst_fid")] == [(0, 0, 0.5), (0, 1, 0.5)]
    r = roads.road_weights(line, RegularGrid(0, 0, 1, 1, 2, 2))
    assert [(a, round(s, 9)) for a, s in rows(r.select("fid", "share"), "fid")] == [(0, 1.0), (1, 1.0)]


def test_priority_chain_prefers_first(spark):
    cells = grid.regular_cells(spark, 0, 0, 1, 1, 1, 2)
    proxy = spark.createDataFrame([(0, 5, 1.0)], "src_fid long, dst_fid long, weight double")
    w = regrid.priority_weights(cells, [proxy], RegularGrid(0, 0, 1, 1, 1, 2))
    assert rows(w, "src_fid") == [(0, 5, 1.0), (1, 1, 1.0)]


# Layers


def quadrants(spark):
    box = lambda x, y: [(x, y), (x + 0.5, y), (x + 0.5, y + 0.5), (x, y + 0.5)]
    data = [(n, box(x, y)) for n, x, y in (("A", 10.0, 10.0), ("B", 10.5, 10.0), ("C", 10.0, 10.5), ("D", 10.5, 10.5))]
    return spark.createDataFrame(data, "name string, ring array<struct<x:double,y:double>>")


@pytest.mark.parametrize("method", ["nearest", "centroid", "intersection"])
def test_quadrant_of_each_cell(spark, method):
    cells = grid.regular_cells(spark, 10, 10, 0.1, 0.1, 10, 10)
    got = {f: n for f, n in rows(spatial.from_layer(cells, quadrants(spark), "name", method).select("fid", "name"))}
    assert all(got[r * 10 + c] == "ABCD"[2 * (r >= 5) + (c >= 5)] for r in range(10) for c in range(10))


def test_region_cover(spark):
    cells = grid.regular_cells(spark, 10, 10, 0.1, 0.1, 10, 7)
    got = {n: (round(s, 6), c) for n, s, c in rows(spatial.covered_share(cells, quadrants(spark), "name"))}
    assert got == {"A": (1.0, True), "C": (1.0, True), "B": (0.4, False), "D": (0.4, False)}


# Grids


def test_cell_area(spark):
    c = grid.regular_cells(spark, 10.0, 10.0, 0.1, 0.1, 2, 1)
    got = [x[0] for x in rows(grid.with_cell_area(c).select("cell_area_m2"), F.desc("cell_area_m2"))]
    assert got == pytest.approx([1.21745930e8, 1.21708086e8], rel=1e-6)


def test_half_end_cells(spark):
    c = grid.global_half_end_cells(spark, 30.0, 60.0)
    assert c.count() == 7 * 7
    assert rows(grid.bbox(c).select("lat_min", "lat_max")) == [(-82.5, 82.5)]
    total = c.agg(F.sum((F.col("lon_max") - F.col("lon_min")) * (F.sin(F.radians("lat_max")) - F.sin(F.radians("lat_min"))))).first()[0]
    assert total == pytest.approx(720)


@pytest.mark.parametrize("name", ["rotated", "lcc", "mercator", "laea"])
def test_projection_round_trip(spark, name):
    there, back, args = {
        "rotated": (grid.lonlat_to_rotated, grid.rotated_to_lonlat, (10.0, 40.0)),
        "lcc": (grid.lonlat_to_lcc, grid.lcc_to_lonlat, (37.0, 43.0, 40.0, 5.0)),
        "mercator": (grid.lonlat_to_mercator, grid.mercator_to_lonlat, (20.0, -3.0)),
        "laea": (grid.lonlat_to_laea, grid.laea_to_lonlat, (52.0, 10.0)),
    }[name]
    p = spark.createDataFrame([(float(x), float(y)) for x in range(-60, 90, 15) for y in range(5, 80, 10)], "lon double, lat double")
    lon, lat = back(*there(F.col("lon"), F.col("lat"), *args), *args)
    worst = p.agg(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-6


def test_rotated_grids(spark):
    c = grid.rotated_cells(spark, 40.0, 10.0, -10.0, -5.0, 1.0, 1.0)
    assert c.count() == 11 * 21
    middle = rows(c.where("row_i = 5 AND col_i = 10").select("lon", "lat"))[0]
    assert middle == (pytest.approx(10), pytest.approx(40))
    parent = {"centre_lat": 40.0, "centre_lon": 10.0, "west": -10.0, "south": -5.0, "inc_rlat": 1.0, "inc_rlon": 1.0}
    assert grid.nested_rotated_cells(spark, parent, 2, 3, 3, 4, 4).agg(F.min("x"), F.max("y")).first() == (-8.0, -1.5)


# Fields


def series(spark, n, drop=()):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([("a", 1, start + timedelta(hours=k), float(k)) for k in range(n) if k not in drop], "variable string, fid long, ts timestamp, value double")


@pytest.mark.parametrize("h", [4, 8])
def test_rolling_mean(spark, h):
    got = [x[0] for x in rows(stats.rolling_mean(series(spark, 12), h).orderBy("ts").select("value"))]
    assert got == [None] * (h - 1) + [float(np.mean(range(k - h + 1, k))) for k in range(h - 1, 12)]
    gap = [x[0] for x in rows(stats.rolling_mean(series(spark, 12, drop=(2,)), 4).orderBy("ts").select("value"))]
    assert gap[4] is None


def test_daily_statistics(spark):
    assert stats.daily_statistic(series(spark, 72)).count() == 3
    assert stats.daily_statistic(series(spark, 25)).count() == 1
    odd = series(spark, 24).withColumn("value", F.when(F.hour("ts") == 3, float("nan")).otherwise(F.col("value")))
    assert math.isnan(stats.daily_statistic(odd, "mean", "alltsteps").first()["value"])
    assert stats.daily_statistic(odd, "nanmax", "withoutt0").first()["value"] == 23


def test_totals_leave_nan_out(spark):
    df = spark.createDataFrame([("NOx", v) for v in (1.0, 2.0, 3.0, 4.0, 5.0, float("nan"), None, 8.0)], "variable string, value double")
    assert rows(stats.totals(df)) == [("NOx", 23.0)]


def test_selection(spark):
    f = series(spark, 30)
    assert filters.select_time(f, "2024-01-01 05:00:00").count() == 1
    with pytest.raises(ValueError, match="no time step"):
        filters.select_time(f, "2025-01-01")
    assert filters.select_hours(f, 2, 3).count() == 25
    assert filters.last_time_step(f).first()["ts"] == datetime(2024, 1, 1)
    assert filters.parse_regions("A, B, A") == ["A", "B"] and filters.parse_regions("all") is None
    with pytest.raises(ValueError, match="combined"):
        filters.parse_regions("ALL, A")
    swap = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2030, 1, 1))], "old timestamp, new timestamp")
    assert filters.restamp(f, swap).first()["ts"] == datetime(2030, 1, 1)
    again = filters.union_first(f, f.withColumn("variable", F.lit("b")), f.withColumn("value", F.lit(9.0)))
    assert again.count() == 60 and again.where("value = 9 AND fid = 1").count() == 2


def test_identical_fields(spark):
    a = series(spark, 3).withColumn("value", F.when(F.hour("ts") == 1, float("nan")).otherwise(F.col("value")))
    assert compare.difference(a, a).where("NOT identical").count() == 0
    zero = a.withColumn("value", F.lit(0.0))
    assert rows(compare.count_odd(compare.percent_difference(zero, zero))) == [("a", 3, 0)]


# Time


def test_steps_keep_the_calendar(spark):
    got = [x[1] for x in rows(temporal.time_steps(spark, "2024-11-30", "monthly", 4), "step")]
    assert [t.month for t in got] == [11, 12, 1, 2]
    assert temporal.start_dates(spark, "2024-01-30", "2024-03-30", "monthly").count() == 3


def test_local_time_of_half_hour_zone(spark):
    cells = spark.createDataFrame([(1, "Asia/Kolkata"), (2, "Old/Name")], "fid long, tz string")
    alias = spark.createDataFrame([("Old/Name", "Europe/Madrid")], "tz string, zone string")
    got = rows(temporal.local_calendar(cells, temporal.time_steps(spark, "2024-07-01 20:00:00", "hourly", 1), alias).select("fid", "hour_i", "weekday_i"), "fid")
    assert got == [(1, 1, 1), (2, 22, 0)]


def test_rebalanced_week_keeps_the_month(spark):
    months = spark.createDataFrame([(2024, 2)], "year_i int, month_i int")
    profile = spark.createDataFrame([("p", d, 1.4 if d < 5 else 0.2) for d in range(7)], "id string, bucket int, factor double")
    counts = temporal.weekday_counts(months)
    got = temporal.rebalance_weekly(profile, counts).join(counts.withColumnRenamed("weekday_i", "bucket"), ["year_i", "month_i", "bucket"])
    assert got.agg(F.sum(F.col("factor") * F.col("n_days"))).first()[0] == pytest.approx(29)


def test_holiday_is_a_sunday(spark):
    c = spark.createDataFrame([("ES", datetime(2024, 1, 1, 5), 0), ("FR", datetime(2024, 1, 1, 5), 0)], "iso2 string, local_ts timestamp, weekday_i int")
    h = spark.sql("SELECT 'ES' AS iso2, DATE '2024-01-01' AS date")
    assert rows(temporal.holidays_as_sunday(c, h).select("iso2", "weekday_i"), "iso2") == [("ES", 6), ("FR", 0)]


def test_profile_severity(spark):
    p = spark.createDataFrame([("a", 0, 11.0)], "id string, bucket int, factor double")
    assert rows(temporal.profile_sums(p, 12.0, False)) == [("a", 11.0, "warning")] and rows(temporal.profile_sums(p, 7.0, True))[0][2] == "error"


# Species, units, expressions


def test_expressions_are_arithmetic_only(spark):
    with pytest.raises(ValueError, match="unknown name"):
        arithmetic("no2 + version", ["no2"])
    with pytest.raises(ValueError, match="not an arithmetic"):
        arithmetic("no2; drop", ["no2", "drop"])
    df = spark.createDataFrame([(2.0, 3.0)], "C double, pm25 double")
    assert df.select(arithmetic("2*C + pm25/(1+.5)", ["C", "pm25"])).first()[0] == pytest.approx(6)


def test_incomplete_speciation(spark):
    t = spark.createDataFrame([("p", "", "0"), ("q", "NaN", " "), ("units", "kmol", "kg"), ("r", None, "co")], "ID string, NO string, CO string")
    p = speciation.read_profiles(t)
    assert {(a, b) for a, b in rows(speciation.incomplete(p).select("profile", "species"))} == {("p", "NO"), ("q", "NO"), ("q", "CO"), ("r", "NO")}
    assert rows(speciation.unused_inputs(spark.createDataFrame([("co",), ("c",)], "pollutant string"), p)) == [("c",)]


def test_units(spark):
    df = spark.createDataFrame([(1.0, "kmol.m-2.s-1"), (1.0, "kg.m-2.s-1"), (1.0, "furlong")], "v double, u string")
    assert [x[0] for x in df.select(units.molar_per_area(F.col("v"), F.col("u"))).collect()] == [1000, 1, None]
    assert spark.range(1).select(units.mass_to_flux(F.lit(365 * 86400.0), "kt", F.lit(2.0))).first()[0] == pytest.approx(5e5)


def test_parsers(spark):
    df = spark.createDataFrame([("20240102", "Yes", "1, 2,x"), ("2024-01-02 03:00:00", "0", ""), ("nothing", None, "7")], "d string, b string, l string")
    got = rows(df.select(parse_any_timestamp(F.col("d")), parse_bool(F.col("b")), parse_list(F.col("l"))))
    assert got[0] == (datetime(2024, 1, 2), True, [1.0, 2.0, None]) and got[1][0].hour == 3 and got[2][:2] == (None, False)


# Logs, sources, sinks


def test_speedup(spark):
    log = spark.createDataFrame([("s", "t", p, v) for p, v in ((1, 10.0), (1, 14.0), (2, 5.0), (2, 7.0))], "section string, subsection string, processes int, value double")
    mean = runlog.aggregate_replications(log.withColumn("inlier", F.lit(True)))
    got = rows(runlog.speedup(mean, "section", "subsection").where("processes = 2").select("value", "speedup", "efficiency"))
    assert got == [(6.0, 2.0, 1.0)]


@pytest.mark.parametrize(("method", "limit"), [("iqr", 1.5), ("mad", 3.5), ("zscore", 1.5)])
def test_outliers(spark, method, limit):
    log = spark.createDataFrame([("s", "t", 1, v) for v in (1.0, 1.1, 0.9, 1.0, 99.0)], "section string, subsection string, processes int, value double")
    assert rows(runlog.inliers(log, method, limit).where("NOT inlier").select("value")) == [(99.0,)]


def test_readers_and_caches(spark, tmp_path):
    log = tmp_path / "run_4_b"
    log.mkdir()
    (log / "times.csv").write_text("section,subsection,0,1,min,mean,max\ninit,grid,1,2,1,1.5,2\n")
    got = readers.read_logs(spark, f"{tmp_path}/run_*/times.csv", r"run_(\d+)_(\w)/").select("processes", "replication", "mean").first()
    assert tuple(got) == (4, "b", "1.5")
    (tmp_path / "inv.txt").write_text("# a\n# b\nES;2019;F;NOx;1.05;2.05;Mg;3.5\nES;2019;F;NOx;x;2.05;Mg;\n")
    text = readers.read_text_inventory(spark, str(tmp_path / "inv.txt"))
    assert readers.unread_rows(text).count() == 1
    text = text.where("EMISSION IS NOT NULL")
    assert text.count() == 1
    fix = spark.createDataFrame([(1.05, 2.05, 9.0, 8.0)], "bad_lon double, bad_lat double, lon double, lat double")
    assert tuple(readers.fix_coordinates(text, fix).select("LONGITUDE", "LATITUDE").first()) == (9.0, 8.0)
    with pytest.raises(ValueError, match="repeated"):
        readers.long_profile(spark.createDataFrame([("a", 1.0), ("a", 2.0)], "ID string, x double"))
    made = []

    def make(missing):
        made.extend(sorted(x[0] for x in missing.collect()))
        return missing.withColumn("flux", F.lit(1.0))

    want = spark.createDataFrame([("co",), ("nox",)], "pollutant string")
    assert sinks.cached_fields(spark, f"{tmp_path}/cache", want.limit(1), make).count() == 1
    assert sinks.cached_fields(spark, f"{tmp_path}/cache", want, make).count() == 2 and made == ["co", "nox"]
    assert len(sinks.cache_name("F", {"a": 1})) == 16
    field = series(spark, 3)
    sinks.write_steps(field, f"{tmp_path}/steps")
    sinks.write_steps(field.where("value = 1").withColumn("value", F.lit(7.0)), f"{tmp_path}/steps")
    assert sorted(x[0] for x in spark.read.parquet(f"{tmp_path}/steps").select("value").collect()) == [0.0, 2.0, 7.0]
    m = spark.createDataFrame([("w",), ("w",)], "message string")
    sinks.stored_warnings(spark, f"{tmp_path}/warn", m)
    assert sinks.stored_warnings(spark, f"{tmp_path}/warn", m).count() == 1


def test_checks(spark):
    cross = spark.createDataFrame([("area", "yearly", "2019"), ("line", "yearly", "2019"), ("area", "weekly", "2019"), ("area", "daily", "x")], "source_type string, frequency string, ref_year string")
    cross = cross.withColumns({c: F.lit("") for c in checks.CROSS_COLUMNS if c not in cross.columns})
    assert sorted(x[0] for x in checks.cross_table_errors(cross).select("problem").collect()) == ["frequency", "ref_year", "source_type"]
    layer = spark.createDataFrame([("Point",), ("LineString",), (None,)], "kind string")
    assert checks.other_geometries(layer).count() == 2
    cells = grid.regular_cells(spark, 0, 0, 1, 1, 2, 2)
    table = cells.select(F.lit("a").alias("variable"), "fid").unionByName(cells.limit(3).select(F.lit("b").alias("variable"), "fid"))
    assert [x[0] for x in checks.grid_differences(table, cells).collect()] == ["b"]
    moved = cells.select(F.lit("c").alias("variable"), F.when(F.col("fid") == 1, 99).otherwise(F.col("fid")).alias("fid"))
    inner = cells.where("fid > 0").select(F.lit("d").alias("variable"), "fid")
    assert sorted(x[0] for x in checks.grid_differences(table.unionByName(moved).unionByName(inner), cells).collect()) == ["b", "c", "d"]


def test_stacks_are_read_by_header(spark, tmp_path):
    from gridflux.sources import readers

    (tmp_path / "nox.csv").write_text("Lon,Lat,Emis,Alt_Injection\n2.0,41.0,5.0,100.0\n")
    row = readers.read_stacks(spark, f"{tmp_path}/nox.csv").first()
    assert (row.Lon, row.Lat, row.Emis, row.Alt_Injection, row.pollutant) == (2.0, 41.0, 5.0, 100.0, "nox")


def test_a_half_written_cache_is_made_again(spark, tmp_path):
    from gridflux.sources import sinks

    (tmp_path / "c").mkdir()
    assert sinks.cached(spark, f"{tmp_path}/c", lambda: spark.range(3)).count() == 3
    assert sinks.cached(spark, f"{tmp_path}/c", lambda: spark.range(9)).count() == 3
