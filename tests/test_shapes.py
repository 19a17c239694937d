"""Signed rings, clipping, projected targets and nearest neighbours against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridflux.operators import nearest, polygons, regrid, spatial, temporal
from gridflux.operators.grid import regular_cells
from gridflux.plans import jobs

RINGS = "name string, rings array<array<struct<x:double,y:double>>>"


def square(x0, y0, side, back=False):
    ring = [(x0, y0), (x0 + side, y0), (x0 + side, y0 + side), (x0, y0 + side)]
    return ring[::-1] if back else ring


def layer(spark, rows):
    return polygons.rings(spark.createDataFrame(rows, RINGS))


@pytest.mark.parametrize("back", [False, True])
def test_holes_are_left_out(spark, back):
    shape = layer(spark, [("a", [square(0.0, 0.0, 4.0), [*square(1.0, 1.0, 2.0, back), (1.0, 1.0) if not back else (1.0, 3.0)]]), ("a", [square(6.0, 6.0, 1.0, back)]), ("b", None), ("c", [[(0.0, 0.0), (1.0, 1.0)]])])
    cells = regular_cells(spark, 0.0, 0.0, 10.0, 10.0, 1, 1)
    assert [(r.name, r.overlap) for r in spatial.overlaps(cells, shape, "name").collect()] == [("a", 13.0)]
    fine = spatial.overlaps(regular_cells(spark, 0.0, 0.0, 0.5, 0.5, 20, 20), shape, "name").agg(F.sum("overlap")).first()[0]
    assert fine == pytest.approx(13.0)
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.5, 2.0), (3, 6.5, 6.5), (4, 5.0, 5.0)], "fid long, lon double, lat double")
    assert {r.fid: r.name for r in spatial.centroid_join(points, shape, "name").collect()} == {1: None, 2: "a", 3: "a", 4: None}
    assert {r.fid: round(r.distance, 6) for r in spatial.nearest_join(points, shape, "name").collect()} == {1: 1.0, 2: 0.0, 3: 0.0, 4: round(math.sqrt(2), 6)}
    assert spatial.covered_share(cells, shape, "name").first()["covered"]


def test_nearest_across_the_seam(spark):
    shape = layer(spark, [("west", [square(-180.0, -1.0, 0.2)]), ("east", [square(150.0, -1.0, 10.0)])])
    points = spark.createDataFrame([(1, 179.9, -0.9)], "fid long, lon double, lat double")
    near, planar = spatial.nearest_join(points, shape, "name").first(), spatial.nearest_join(points, shape, "name", None).first()
    assert (near["name"], round(near["distance"], 6)) == ("west", 0.1)
    assert (planar["name"], round(planar["distance"], 6)) == ("east", 19.9)


def slow_area(ring, x0, x1, y0, y1, n=400):
    """Area of a ring within a box by counting crossings along many lines."""
    total = 0.0
    for k in range(n):
        y = y0 + (k + 0.5) * (y1 - y0) / n
        cuts = sorted(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, ring[1:] + ring[:1]) if (a[1] <= y) != (b[1] <= y))
        total += sum(max(0.0, min(b, x1) - max(a, x0)) for a, b in zip(cuts[::2], cuts[1::2])) * (y1 - y0) / n
    return total


def test_concave_rings_in_several_pieces():
    rng = random.Random(5)
    comb = [(0.0, 0.0), (9.0, 0.0), (9.0, 5.0), (8.0, 5.0), (8.0, 1.0), (5.0, 1.0), (5.0, 5.0), (4.0, 5.0), (4.0, 1.0), (1.0, 1.0), (1.0, 5.0), (0.0, 5.0)]
    star = [(r * math.cos(a), r * math.sin(a)) for k in range(14) for a, r in [(k * math.pi / 7, rng.uniform(1, 6))]]
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    for ring in (comb, comb[::-1], star):
        boxes = [(x, x + rng.uniform(0.5, 6), y, y + rng.uniform(0.5, 6)) for x, y in ((rng.uniform(-7, 8), rng.uniform(-7, 5)) for _ in range(20))]
        as_ring = lambda pts: [{"x": x, "y": y} for x, y in pts]
        windows = pa.array([as_ring([(a, c), (b, c), (b, d), (a, d)][:: rng.choice((1, -1))]) for a, b, c, d in boxes], kind)
        left, area, whole = polygons.clip_rings(pa.array([as_ring(ring)] * len(boxes), kind), windows)
        want = [slow_area(ring, *b) for b in boxes]
        assert np.allclose(area, want, atol=0.06) and np.allclose(whole, slow_area(ring, -20, 20, -20, 20, 8000), atol=0.05)
        again = polygons.clip_rings(left, windows)[1]  # what is left stays as it is
        assert np.allclose(again, area)


GRIDS = {
    "rotated": regrid.ProjectedGrid.rotated(46.0, 12.0, -18.0, -16.0, 1.6, 2.4),
    "lambert": regrid.ProjectedGrid.lambert(35.0, 55.0, 45.0, 178.0, 20, 18, 150_000.0, 150_000.0, -1_500_000.0, -1_350_000.0),
    "south": regrid.ProjectedGrid.lambert(-35.0, -55.0, -45.0, -60.0, 12, 12, 250_000.0, 250_000.0, -1_500_000.0, -1_500_000.0),
    "mercator": regrid.ProjectedGrid.mercator(20.0, -100.0, 15, 15, 200_000.0, 200_000.0, -1_500_000.0, 500_000.0),
    "azimuthal": regrid.ProjectedGrid.azimuthal(52.0, 10.0, 20, 20, 200_000.0, 200_000.0, -2_000_000.0, -2_000_000.0),
}


@pytest.mark.parametrize("name", sorted(GRIDS))
def test_projected_targets_share_out_covered_cells(spark, name):
    """Cells within the grid are dealt out whole, none is dealt more than once, and each target's own cells
    get the area that the target has."""
    grid = GRIDS[name]
    src = regular_cells(spark, -90.0, -180.0, 2.5, 2.5, 72, 144)
    weights = regrid.overlap_weights(src, grid)
    total = weights.groupBy("src_fid").agg(F.sum("weight").alias("w"))
    corners = [grid.owner(F.col(x), F.col(y)) for x in ("lon_min", "lon", "lon_max") for y in ("lat_min", "lat", "lat_max")]
    rows_, cols = [F.floor(c / grid.n_x) for c in corners], [c % grid.n_x for c in corners]
    well_inside = F.lit(True)
    for row, col in zip(rows_, cols):
        well_inside &= row.between(1, grid.n_y - 2) & col.between(1, grid.n_x - 2)
    got = src.withColumn("inside", F.coalesce(well_inside, F.lit(False))).join(total.withColumnRenamed("src_fid", "fid"), "fid", "left").select("inside", F.coalesce("w", F.lit(0.0)).alias("w")).collect()
    inside = [r.w for r in got if r.inside]
    assert len(inside) > 20 and max(abs(w - 1) for w in inside) < 1e-9 and max(r.w for r in got) < 1 + 1e-9
    area = F.expr("radians(lon_max - lon_min) * (sin(radians(lat_max)) - sin(radians(lat_min)))")
    reached = weights.join(src.select(F.col("fid").alias("src_fid"), area.alias("a")), "src_fid").groupBy("dst_fid").agg(F.sum(F.col("weight") * F.col("a")).alias("got")).withColumnRenamed("dst_fid", "fid")
    own = polygons.shoelace(regrid.equal_area_ring(F.transform("ring", lambda p: F.struct((F.col("lon") + F.pmod(p["x"] - F.col("lon") + 180, F.lit(360.0)) - 180).alias("x"), p["y"].alias("y"))))) / regrid.EARTH_RADIUS_M**2
    both = grid.cells(spark).select("fid", own.alias("own")).join(reached, "fid", "left").collect()
    assert max(abs((r.got or 0.0) / r.own - 1) for r in both) < 1e-6


def test_polygons_proxy_deals_by_weight_and_area(spark):
    src, dst = regrid.RegularGrid(0.0, 0.0, 10.0, 10.0, 1, 2), regrid.RegularGrid(0.0, 0.0, 10.0, 5.0, 1, 4)
    shape = layer(spark, [("3", [square(1.0, 0.0, 2.0)]), ("1", [square(6.0, 0.0, 2.0), square(6.5, 0.5, 1.0)]), ("5", [square(19.0, 0.0, 2.0)]), ("0", [square(12.0, 0.0, 1.0)])]).withColumn("weight", F.col("name").cast("double"))
    got = {(r.src_fid, r.dst_fid): r.weight for r in regrid.polygons_proxy(shape, src, dst).collect()}
    s = lambda a, b: math.sin(math.radians(b)) - math.sin(math.radians(a))
    a, b = 3 * 2 * s(0, 2), 2 * s(0, 2) - s(0.5, 1.5)
    assert got == {(0, 0): pytest.approx(a / (a + b)), (0, 1): pytest.approx(b / (a + b)), (1, 3): pytest.approx(1.0)}


def test_few_candidates_for_each_point(spark):
    """Candidates grow with the points, near or far from the sources, and hold every nearest one."""
    rng = np.random.default_rng(1)

    def count(n):
        src = np.concatenate([rng.normal(0, 1, (n // 2, 2)), rng.uniform(-100, 100, (n // 2, 2))])
        dst = np.concatenate([rng.uniform(-100, 100, (n // 2, 2)), rng.normal(500, 1, (n // 2, 2))])  # half of them far from all
        frame = lambda a, *names: spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(a)], f"{names[0]} long, {names[1]} double, {names[2]} double")
        s = frame(src, "s", "lo_x", "lo_y").withColumns({"hi_x": F.col("lo_x"), "hi_y": F.col("lo_y")})
        pairs = nearest.candidates(frame(dst, "p", "x", "y"), s, "xy", 3, ["s"]).select("p", "s").toPandas()
        for p in range(0, n, max(1, n // 40)):
            best = np.argsort(((src - dst[p]) ** 2).sum(1))[:3]
            assert set(best) <= set(pairs["s"][pairs["p"] == p])
        return len(pairs)

    small, large = count(400), count(4000)
    assert large < 15 * small and large < 4000 * 200


def test_many_points_have_few_candidates(spark):
    """Tiles of points shrink on beside few sources, and what counts as equally near stays."""
    place = lambda seed: F.rand(seed) * 200 - 100
    s = spark.range(200).select(F.col("id").alias("s"), place(1).alias("lo_x"), place(2).alias("lo_y")).withColumns({"hi_x": F.col("lo_x"), "hi_y": F.col("lo_y")})
    p = spark.range(40_000).select(F.col("id").alias("p"), place(3).alias("x"), place(4).alias("y"))
    assert nearest.candidates(p, s, "xy", 3, ["s"]).count() < 20 * 40_000
    two = spark.createDataFrame([(9, 0.2, 0.0), (3, 0.5, 0.0)], "s long, lo_x double, lo_y double").withColumns({"hi_x": F.col("lo_x"), "hi_y": F.col("lo_y")})
    one = spark.createDataFrame([(1, 0.0, 0.0)], "p long, x double, y double")
    assert [r.s for r in nearest.candidates(one, two, "xy", 1, ["s"]).collect()] == [9]
    assert sorted(r.s for r in nearest.candidates(one, two, "xy", 1, ["s"], least=1.0).collect()) == [3, 9]


def test_nearest_polygons_of_odd_rings(spark):
    """Rings of different lengths, one with a corner twice, against plain distances; a point without a place has none."""
    rng = np.random.default_rng(8)
    shapes = {f"n{k}": [(float(x), float(y)) for x, y in rng.uniform(-60, 60, 2) + 5 * np.stack([np.cos(a), np.sin(a)], 1)] for k in range(8) for a in [np.sort(rng.uniform(0, 2 * np.pi, 3 + 4 * k))]}
    shapes["n3"].insert(2, shapes["n3"][2])
    shape = spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in c]) for n, c in shapes.items()], f"name string, ring {polygons.RING}")
    at = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-80, 80, (300, 2)))]

    def plain(ring, x, y):
        odd, best = False, math.inf
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            long = (bx - ax) ** 2 + (by - ay) ** 2
            t = min(max(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / long, 0), 1) if long else 0
            best = min(best, math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y))
            odd ^= (ay <= y) != (by <= y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
        return 0.0 if odd else best

    got = {r.fid: (r.name, r.distance) for r in spatial.nearest_join(spark.createDataFrame([*at, (-1, None, 0.0)], "fid long, lon double, lat double"), shape, "name").collect()}
    assert got.pop(-1)[1] is None
    want = {k: min((round(plain(c, x, y), 9), n) for n, c in shapes.items()) for k, x, y in at}
    assert {k: n for k, (n, _) in got.items()} == {k: n for k, (_, n) in want.items()}
    assert all(got[k][1] == pytest.approx(d, abs=2e-9) for k, (d, _) in want.items())


def test_station_weights_are_dealt_once(spark):
    """A small field comes to the stations' weights, which stay where they are for the sum."""
    src = spark.range(50).select(F.col("id").alias("fid"), (F.col("id") * 7.0 - 170).alias("lon"), (F.col("id") * 3.0 - 80).alias("lat"))
    stations = spark.range(30).select(F.col("id").alias("station"), (F.col("id") * 11.0 - 160).alias("lon"), (F.col("id") * 5.0 - 70).alias("lat"))
    field = src.select(F.lit("a").alias("pollutant"), "fid", F.col("lon").alias("value"))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jobs.interpolate(field, src, None, stations, "pollutant")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(src_fid" not in plan and "hashpartitioning(pollutant" not in plan
        assert out.count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_hourly_ids_of_odd_texts(spark):
    """Keys in several rows and without one, unknown names, empty and null texts; days aren't sorted by key and weekday."""
    texts = [(1, "weekday=A"), (1, " Saturday = B , weekend=C"), (2, "H"), (3, None), (None, "sunday=S"), (4, ""), (5, "someday=X, monday=M"), (6, "monday=1,monday=2")]
    out = temporal.parse_hourly_id(spark.createDataFrame(texts, "k long, t string"), "k", "t")
    want = {(1, d, i) for d, i in enumerate("AAAAABC")} | {(2, d, "H") for d in range(7)} | {(None, 6, "S")} | {(4, d, "") for d in range(7)} | {(5, -1, "X"), (5, 0, "M"), (6, 0, "2")}
    assert {tuple(r) for r in out.collect()} == want and out.count() == len(want)
    assert dict(out.dtypes) == {"k": "bigint", "weekday_i": "int", "id": "string"}
    assert "weekday_i" not in "".join(x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort" in x)
