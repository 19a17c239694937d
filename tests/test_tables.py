"""Splines, pruned reads, caches that are written half-way, fire fields, and jobs of a cross table."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflux.operators import checks, regrid, vertical
from gridflux.plans import jobs
from gridflux.sources import readers, sinks


def piecewise(z, v, x, k):
    """The spline's pieces by their conditions: values at the sites, smooth joints, and (cubic) the first and last
    two pieces one polynomial; for the quadratic, joints at the midpoints."""
    n = len(z)
    if k == 3:
        joints = z[2:-2]
    elif k == 2:
        joints = ((z[1:] + z[:-1]) / 2)[1:-1]
    else:
        joints = z[1:-1]
    edges = np.r_[z[0], joints, z[-1]]
    pieces = len(edges) - 1
    rows, right = [], []
    for zi, vi in zip(z, v):
        p = min(max(np.searchsorted(edges, zi, "right") - 1, 0), pieces - 1)
        row = np.zeros(pieces * (k + 1))
        row[p * (k + 1) : (p + 1) * (k + 1)] = [zi**d for d in range(k + 1)]
        rows.append(row)
        right.append(vi)
    for p, e in enumerate(joints):
        for order in range(k):
            own = [np.prod([d - q for q in range(order)]) * e ** max(d - order, 0) if d >= order else 0.0 for d in range(k + 1)]
            row = np.zeros(pieces * (k + 1))
            row[p * (k + 1) : (p + 1) * (k + 1)], row[(p + 1) * (k + 1) : (p + 2) * (k + 1)] = own, -np.array(own)
            rows.append(row)
            right.append(0.0)
    c = np.linalg.solve(np.array(rows), np.array(right)).reshape(pieces, k + 1)
    at = np.clip(np.searchsorted(edges, x, "right") - 1, 0, pieces - 1)
    assert len(rows) == pieces * (k + 1) and n >= k + 1
    return (c[at] * np.asarray(x)[:, None] ** np.arange(k + 1)).sum(1)


@pytest.mark.parametrize("kind,k", [("slinear", 1), ("quadratic", 2), ("cubic", 3)])
@pytest.mark.parametrize("n", [4, 5, 7])
def test_splines_meet_their_conditions(kind, k, n):
    rng = np.random.default_rng(n)
    z = np.cumsum(rng.uniform(0.4, 1.5, (6, n)), 1)
    v = rng.normal(0, 2, (6, n))
    x = np.linspace(z.min() - 0.5, z.max() + 0.5, 23)
    got = vertical.spline_values(z, v, np.broadcast_to(x, (6, 23)), kind)
    for row in range(6):
        assert np.allclose(got[row], piecewise(z[row], v[row], x, k), atol=1e-6)


def test_spline_columns_of_many_lengths(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0, 5.0], [z**3 for z in (1.0, 2.0, 3.0, 4.0, 5.0)]), (2, [1.0, 2.0], [1.0, 3.0]), (3, [2.0], [7.0]), (4, [], []), (5, [0.0, 1.0, 3.0], [0.0, 1.0, 9.0])]
    df = spark.createDataFrame(rows, "k int, z array<double>, v array<double>")
    read = lambda **how: {(r.k, r.lev): None if r.value is None else round(r.value, 6) for r in vertical.interpolate_spline(df, [0.5, 2.5, 6.0], ["k"], **how).collect()}
    near, out, filled = read(), read(below="extrapolate", above="extrapolate"), read(below=-1.0, above=-2.0)
    assert [near[1, i] for i in range(3)] == [1.0, 15.625, 125.0] and [out[1, i] for i in range(3)] == [0.125, 15.625, 216.0]
    assert [filled[1, i] for i in range(3)] == [-1.0, 15.625, -2.0] and [out[2, i] for i in range(3)] == [0.0, 4.0, 11.0]
    assert near[3, 0] == near[3, 2] == 7.0 and near[4, 1] is None and out[5, 1] == 6.25
    steps = vertical.interpolate_spline(df.where("k = 1"), [1.9, 2.0, 4.5], ["k"], "zero").collect()
    assert [r.value for r in sorted(steps, key=lambda r: r.lev)] == [1.0, 8.0, 64.0]


def test_wanted_partitions_reach_the_scan(spark, tmp_path):
    keys = ["inventory", "sector", "pollutant", "period"]
    rows = [(i, s, p, m, 1, 2.0) for i in "AB" for s in ("x", "y") for p in ("co", "nox") for m in ("01", "02")]
    spark.createDataFrame(rows, readers.INVENTORY).write.partitionBy(*keys).parquet(f"{tmp_path}/inv")
    wanted = spark.createDataFrame([("A", "x", "co", "01"), ("A", "x", "co", "02"), ("B", "y", "nox", "02"), ("B", "y", "nox", "02")], ", ".join(f"{k} string" for k in keys))
    found = readers.read_inventory(spark, f"{tmp_path}/inv", wanted)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((((" in plan and "Join" not in plan
    with pytest.raises(FileNotFoundError, match="A.*x.*co.*03"):
        readers.read_inventory(spark, f"{tmp_path}/inv", spark.createDataFrame([("A", "x", "co", "03")], wanted.schema))


def test_a_cache_written_half_way_is_made_again(spark, tmp_path):
    path, asked = f"{tmp_path}/cache", []

    def make(missing, broken=False):
        asked.append(sorted(r[0] for r in missing.collect()))
        return missing.withColumn("value", F.when(F.col("pollutant") == "nox", F.raise_error(F.lit("lost"))).otherwise(1.0) if broken else F.lit(2.0))

    want = spark.createDataFrame([("co",), ("nox",)], "pollutant string")
    with pytest.raises(Exception, match="lost"):
        sinks.cached_fields(spark, path, want, lambda m: make(m, True))
    spark.createDataFrame([("co", "old", 1.0)], "pollutant string, run string, value double").write.partitionBy("pollutant", "run").mode("append").parquet(f"{path}/data")  # as a lost run leaves it
    assert sorted(tuple(r) for r in sinks.cached_fields(spark, path, want, make).select("pollutant", "value").collect()) == [("co", 2.0), ("nox", 2.0)]
    more = spark.createDataFrame([("co",), ("pm",)], "pollutant string")
    assert sorted(tuple(r) for r in sinks.cached_fields(spark, path, more, make).select("pollutant", "value").collect()) == [("co", 2.0), ("pm", 2.0)]
    assert asked == [["co", "nox"], ["co", "nox"], ["pm"]]


def test_fire_field_with_its_heights(spark, tmp_path):
    rows = [("2024-07-01 00:00:00", 1, "co", 5.0, "20240701"), ("2024-07-01 00:00:00", 1, "nox", 6.0, "20240701"), ("2024-07-01 00:00:00", 1, "apt", 300.0, "20240701"), ("2024-07-01 00:00:00", 2, "co", 7.0, "20240701"), ("2024-07-02 00:00:00", 1, "co", 8.0, "20240702"), ("2024-07-02 00:00:00", 1, "nox", 8.0, "20240702")]
    table = spark.createDataFrame(rows, "ts string, src_fid long, variable string, value double, day string").withColumn("ts", F.to_timestamp("ts"))
    table.write.partitionBy("day").parquet(f"{tmp_path}/fire")
    got = readers.read_fire_field(spark, f"{tmp_path}/fire", ["co", "nox"], "apt", ["20240701"])
    assert sorted((r.src_fid, r.pollutant, r.flux, r.height) for r in got.collect()) == [(1, "co", 5.0, 300.0), (1, "nox", 6.0, 300.0), (2, "co", 7.0, None)]
    with pytest.raises(FileNotFoundError, match="20240702.*apt"):  # the height variable of the second day is missing
        readers.read_fire_field(spark, f"{tmp_path}/fire", ["co", "nox"], "apt", ["20240701", "20240702"])


def test_cross_table_rows_go_to_their_jobs(spark):
    cross = spark.createDataFrame([("a", "area", "yearly", "co"), ("s", "point", "monthly", "co"), ("f", "point", "daily", "nox")], "ei string, source_type string, frequency string, pollutant string")
    seen = {}

    def job(name):
        def run(rows):
            seen[name] = sorted(r.ei for r in rows.collect())
            return rows.select(F.lit("2024-07-01").cast("timestamp").alias("ts"), F.lit(0).alias("lev"), F.lit(1).cast("long").alias("fid"), F.col("pollutant").alias("species"), F.lit(1.5).alias("value"))

        return run

    all_jobs = {k: job(k) for k in ("area", "stack", "fire_daily", "fire_hourly")}
    out = jobs.combine(cross, all_jobs)
    assert sorted((r.species, r.value) for r in out.collect()) == [("co", 3.0), ("nox", 1.5)]
    assert seen == {"area": ["a"], "stack": ["s"], "fire_daily": ["f"]}
    with pytest.raises(ValueError, match="fire_daily"):
        jobs.combine(cross, {k: all_jobs[k] for k in ("area", "stack")})
    with pytest.raises(ValueError, match="None"):
        jobs.combine(cross.withColumn("source_type", F.lit("line")), all_jobs)


def test_variables_without_field_or_bounds(spark):
    field = spark.createDataFrame([("a", 1.0), ("c", 1.0)], "variable string, value double").withColumns({"fid": F.lit(1), "lev": F.lit(0)})
    limits = {"min_abs": -1.0, "min_lower": 0.0, "min_upper": 2.0, "max_lower": 0.5, "max_upper": 2.0, "max_abs": 3.0}
    bounds = spark.createDataFrame([("a",), ("b",)], "variable string").withColumns({k: F.lit(v) for k, v in limits.items()})
    assert {r.variable: r.status for r in checks.bounds_report(field, bounds).collect()} == {"a": "ok", "b": "missing", "c": "unbounded"}
    cells = spark.range(3).withColumnRenamed("id", "fid")
    assert [tuple(r) for r in checks.grid_differences(field.where("false"), cells).collect()] == [(None, 0, 3)]


def test_vertical_profiles_need_lists_of_one_length(spark, tmp_path):
    (tmp_path / "good.csv").write_text("ID;layers;weights\nV1;10, 50;1, 3\n")
    got = [tuple(r) for r in readers.read_vertical_profiles(spark, str(tmp_path / "good.csv")).select("id", "bottom", "top", "weight").orderBy("layer").collect()]
    assert got == [("V1", 0.0, 10.0, 1.0), ("V1", 10.0, 50.0, 3.0)]
    for row in ("V2;10,50;1", "V2;10,fifty;1,2", "V2;;"):
        (tmp_path / "bad.csv").write_text(f"ID;layers;weights\nV1;10;1\n{row}\n")
        with pytest.raises(ValueError, match="V2"):
            readers.read_vertical_profiles(spark, str(tmp_path / "bad.csv"))


def test_speciation_cells_need_an_expression(spark, tmp_path):
    head = "ID,NO,PM\nunits,mol,g\nshort_description,a,b\n"
    (tmp_path / "good.csv").write_text(head + "P1,0.9*nox,0\n,,\n")
    assert {(r.profile, r.species, r.expr, r.units) for r in readers.read_speciation(spark, str(tmp_path / "good.csv")).collect()} == {("P1", "NO", "0.9*nox", "mol"), ("P1", "PM", "0", "g")}
    (tmp_path / "bad.csv").write_text(head + "P1,0.9*nox,0\nP2,nan,0\n")
    with pytest.raises(ValueError, match="P2.*NO"):
        readers.read_speciation(spark, str(tmp_path / "bad.csv"))


def test_roads_take_mass_rates_only(spark):
    field = spark.createDataFrame([], "pollutant string, ts timestamp, lev int, fid long, value double")
    lines = spark.createDataFrame([], "link int, weight double, line array<struct<x:double,y:double>>")
    assert jobs.grid_to_roads(field, lines, regrid.RegularGrid(0.0, 0.0, 1.0, 1.0, 2, 2), {"nox": "kg.s-1"}).count() == 0
    with pytest.raises(ValueError, match="co"):
        jobs.grid_to_roads(field, lines, regrid.RegularGrid(0.0, 0.0, 1.0, 1.0, 2, 2), {"nox": "kg/s", "co": "mol/s"})


def test_levels_by_own_heights_and_kinds(spark):
    field = spark.createDataFrame([(f, k, float((k + f) ** 2)) for f in (0, 1) for k in range(5)], "fid long, lev int, value double")
    shared = spark.createDataFrame([(k, 10.0 * k) for k in range(5)], "lev int, height double")
    own = spark.createDataFrame([(f, k, 10.0 * (k + f)) for f in (0, 1) for k in range(5)], "fid long, lev int, height double")
    values = lambda h, kind: {r.fid: r.value for r in jobs.interpolate_levels(field, h, [25.0], ["fid"], kind).collect()}
    assert values(shared, "linear") == {0: pytest.approx(6.5), 1: pytest.approx(12.5)}
    assert values(own, "linear") == {0: pytest.approx(6.5), 1: pytest.approx(6.5)}
    assert values(own, "cubic") == {0: pytest.approx(6.25), 1: pytest.approx(6.25)}
    with pytest.raises(ValueError):
        jobs.interpolate(field, shared, None, shared, "fid", "lev")


def test_lines_through_a_corner_leave_no_crumbs(spark):
    line = spark.createDataFrame([(1, 1.0, [(2.0, 4.0), (8.3, 6.1)])], "link int, weight double, line array<struct<x:double,y:double>>")
    cut = regrid.cut_segments(regrid.segments(line), regrid.RegularGrid(0.0, 0.0, 5.0, 5.0, 2, 2), "fid")
    assert sorted(r.fid for r in cut.collect()) == [0, 3]


def test_an_hour_in_several_files_is_summed(spark, tmp_path):
    from gridflux import streaming

    kinds = "ts timestamp, src_fid long, pollutant string, flux double, part string"
    weights = spark.createDataFrame([(1, 7, 0.5), (2, 7, 1.0)], "src_fid long, dst_fid long, weight double")
    species = spark.createDataFrame([("co", "CO", 2.0)], "pollutant string, species string, fr double")

    def arrive(part, hour, flux):
        rows = spark.sql(f"SELECT TIMESTAMP '2020-01-01 0{hour}:10:00' AS ts, id AS src_fid, 'co' AS pollutant, {flux}D AS flux, '{part}' AS part FROM range(1, 3)")
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        fires = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))  # each file is a batch of its own
        streaming.write_hours(fires, weights, species, str(tmp_path / "out"), str(tmp_path / "state"), "part").awaitTermination()
        return {(r["ts"].hour, r["fid"], r["species"]): r["value"] for r in streaming.read_hours(spark, str(tmp_path / "out"), "part").collect()}

    arrive("north", 1, 1.0)
    arrive("south", 1, 10.0)
    arrive("north", 2, 4.0)
    assert run() == {(1, 7, "CO"): 33.0, (2, 7, "CO"): 12.0}
    arrive("north", 1, 2.0)  # arrives again and replaces its own part only
    assert run() == {(1, 7, "CO"): 36.0, (2, 7, "CO"): 12.0}


def test_unknown_units_are_rejected(spark):
    from gridflux.operators import units

    labels = spark.createDataFrame([("kg", "g", "as aerosol")], "units string, new_units string, suffix string")
    variables = spark.createDataFrame([("a", "kg", "dust"), ("b", "furlong", "odd"), ("c", None, "none")], "variable string, units string, long_name string")
    assert [tuple(r) for r in units.relabel(variables.where("variable = 'a'"), labels).collect()] == [("a", "kg", "g", "dust as aerosol")]
    with pytest.raises(ValueError, match="furlong"):
        units.relabel(variables, labels)
    with pytest.raises(ValueError, match="None"):
        units.relabel(variables.where("variable = 'c'"), labels)
