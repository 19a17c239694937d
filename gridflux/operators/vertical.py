"""Vertical allocation and interpolation (VRT)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def profile_layers(profiles: DataFrame) -> DataFrame:
    """SRC-06. Delimited lists ``layers`` (tops) and ``weights`` as rows id, layer, bottom, top, weight.

    Lists of different lengths leave a null in their row.
    """
    parse = lambda c: F.transform(F.split(F.regexp_replace(c, r"[\[\]\s]", ""), ","), lambda v: v.try_cast("double"))
    rows = profiles.select("id", F.posexplode(F.arrays_zip(parse("layers").alias("top"), parse("weights").alias("weight"))).alias("layer", "v")).select("id", "layer", "v.top", "v.weight")
    return rows.withColumn("bottom", F.lag("top", 1, 0.0).over(Window.partitionBy("id").orderBy("layer")))


def level_weights(layers: DataFrame, levels: DataFrame) -> DataFrame:
    """VRT-01. Share of each profile in each model level (lev, bottom, top) by overlap; what lies above
    the model top is lost, never scaled up. The scale is the profile's whole weight."""
    m = levels.select("lev", F.col("bottom").alias("b"), F.col("top").alias("t"))
    shared = F.greatest(F.lit(0.0), F.least("top", "t") - F.greatest("bottom", "b"))
    total = layers.groupBy("id").agg(F.sum("weight").alias("scale"))
    parts = layers.crossJoin(F.broadcast(m)).withColumn("part", F.col("weight") * F.try_divide(shared, F.col("top") - F.col("bottom")))  # a few levels
    return parts.groupBy("id", "lev").agg(F.sum("part").alias("part")).join(total, "id").select("id", "lev", (F.col("part") / F.col("scale")).alias("factor"))


def level_array(weights: DataFrame) -> DataFrame:
    """VRT-01. Weights of each profile as one array in the order of levels."""
    return weights.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("lev", "factor"))), lambda x: x["factor"]).alias("vfac"))


def to_levels(flux: DataFrame, n_levels: int, value: str = "value") -> DataFrame:
    """VRT-02, VRT-03. Surface values spread by ``vfac``; without a profile all stays in level 0. Zero
    rows are dropped."""
    ground = F.array(F.lit(1.0), *[F.lit(0.0)] * (n_levels - 1))
    spread = flux.select(*[c for c in flux.columns if c != "vfac"], F.posexplode(F.coalesce("vfac", ground)).alias("lev", "_f"))
    return spread.withColumn(value, F.col(value) * F.col("_f")).drop("_f").where(F.col(value) != 0)


def injection_level(height: Column, tops: list[float]) -> Column:
    """VRT-04, VRT-05. First level whose top reaches the height; above the model top level 0."""
    reach = F.array_position(F.transform(F.array(*[F.lit(float(t)) for t in tops]), lambda t: height <= t), True)
    return F.greatest(F.coalesce(reach, F.lit(0)) - 1, F.lit(0)).cast("int")


def above_top(height: Column, tops: list[float]) -> Column:
    """VRT-04. Whether a height lies above the model top, for a warning count."""
    return height > float(tops[-1])


def fire_weights(top_level: Column, tops: list[float], approach: str = "uniform") -> Column:
    """VRT-06. Weights of levels 0 to the top level, 0 above: by thickness (``uniform``), or half in the
    top level and the rest below by thickness (``50_top``)."""
    t = F.array(*[F.lit(float(v)) for v in tops])
    thick = lambda i: F.get(t, i) - F.when(i > 0, F.get(t, i - 1)).otherwise(0.0)
    levels = F.sequence(F.lit(0), F.lit(len(tops) - 1))
    if approach == "uniform":
        return F.transform(levels, lambda i: F.when(i <= top_level, thick(i) / F.get(t, top_level)).otherwise(0.0))
    if approach != "50_top":
        raise ValueError(f"unknown approach {approach}")
    below = F.get(t, top_level - 1)
    share = lambda i: F.when(i == top_level, F.when(top_level == 0, 1.0).otherwise(0.5)).when(i < top_level, 0.5 * thick(i) / below).otherwise(0.0)
    return F.transform(levels, share)


def interpolate_linear(columns: DataFrame, heights: list[float], kind: str = "linear", below: str | float | None = None, above: str | float | None = None) -> DataFrame:
    """VRT-08. Values at new heights from columns of arrays ``z`` (ascending) and ``v``.

    kind: linear, nearest, previous or next. Outside: None takes the nearest value, a number that
    number, ``extrapolate`` the line through the two outermost points.
    """
    new = F.array(*[F.lit(float(h)) for h in heights])
    n = F.size("z")
    z, v = (lambda i: F.get("z", i)), (lambda i: F.get("v", i))

    def between(h: Column) -> Column:
        at = F.greatest(F.least(F.size(F.filter("z", lambda q: q <= h)), n - 1), F.lit(1)) - 1
        t = F.coalesce(F.try_divide(h - z(at), z(at + 1) - z(at)), F.lit(0.0))
        if kind == "linear":
            return v(at) + t * (v(at + 1) - v(at))
        if kind == "nearest":
            return F.when(t <= 0.5, v(at)).otherwise(v(at + 1))
        return F.when(t >= 1, v(at + 1)).otherwise(v(at)) if kind == "previous" else F.when(t <= 0, v(at)).otherwise(v(at + 1))

    def edge(h: Column, fill: str | float | None, first: bool) -> Column:
        i, j = (F.lit(0), F.lit(1)) if first else (n - 2, n - 1)
        if fill is None:
            return v(F.lit(0) if first else n - 1)
        if fill == "extrapolate":
            return v(i) + (h - z(i)) * (v(j) - v(i)) / (z(j) - z(i))
        return F.lit(float(fill))

    value = lambda h: F.when(n == 1, v(F.lit(0))).when(h < z(F.lit(0)), edge(h, below, True)).when(h > z(n - 1), edge(h, above, False)).otherwise(between(h))
    return columns.select(*[c for c in columns.columns if c not in ("z", "v")], F.posexplode(F.transform(new, lambda h: F.struct(h.alias("height"), value(h).alias("value")))).alias("lev", "p")).select("*", "p.*").drop("p")


#: Degree of each spline kind (fixed values).
DEGREES = {"zero": 0, "slinear": 1, "quadratic": 2, "cubic": 3}


def spline_knots(z: np.ndarray, k: int) -> np.ndarray:
    """Knots of interpolating splines of degree ``k``, a row for each row of sites ``z``: ends repeated, inside
    the sites themselves without the second and last but one (cubic: not-a-knot), or for the even
    degree the midpoints without the first and last."""
    inner = (z[:, 1:] + z[:, :-1])[:, 1:-1] / 2 if k == 2 else z[:, (k + 1) // 2 : z.shape[1] - (k + 1) // 2]
    return np.concatenate([np.repeat(z[:, :1], k + 1, 1), inner, np.repeat(z[:, -1:], k + 1, 1)], 1)


def spline_basis(knots: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Values of all B-splines of degree ``k`` at ``x`` (rows, places), by the triangular recursion over each
    place's own span; beyond the ends the outermost pieces go on."""
    n = knots.shape[1] - k - 1
    span = np.clip((knots[:, None, k : n + 1] <= x[:, :, None]).sum(2) - 1 + k, k, n - 1)
    at = lambda i: np.take_along_axis(knots, i, 1)
    values = [np.ones_like(x)]
    for d in range(1, k + 1):
        up, carried = [], np.zeros_like(x)
        for j in range(d):
            right, left = at(span + j + 1), at(span + j + 1 - d)
            share = values[j] / (right - left)
            up.append(carried + (right - x) * share)
            carried = (x - left) * share
        values = [*up, carried]
    out = np.zeros((*x.shape, n))
    for j, v in enumerate(values):
        np.put_along_axis(out, (span - k + j)[:, :, None], v[:, :, None], 2)
    return out


def spline_values(z: np.ndarray, v: np.ndarray, x: np.ndarray, kind: str) -> np.ndarray:
    """Interpolating splines of columns with equally many sites, all at once, at ``x``; less sites than the kind
    needs lower its degree."""
    k = min(DEGREES[kind], z.shape[1] - 1)
    if k == 0:
        return np.take_along_axis(v, np.clip((z[:, None, :] <= x[:, :, None]).sum(2) - 1, 0, None), 1)
    knots = spline_knots(z, k)
    weights = np.linalg.solve(spline_basis(knots, z, k), v[:, :, None])
    return (spline_basis(knots, x, k) @ weights)[:, :, 0]


def interpolate_spline(columns: DataFrame, heights: list[float], keys: list[str], kind: str = "cubic", below: str | float | None = None, above: str | float | None = None) -> DataFrame:
    """VRT-08. Interpolating B-splines (zero, slinear, quadratic, cubic) of columns of arrays ``z`` (ascending) and
    ``v`` at new heights: lev, value. Outside: None takes the nearest value, a number that number,
    ``extrapolate`` the outermost piece. Columns of equal length are solved together."""
    kinds = dict(columns.dtypes)

    def fill(out: np.ndarray, where: np.ndarray, nearest: np.ndarray, how: str | float | None) -> np.ndarray:
        return out if how == "extrapolate" else np.where(where, nearest[:, None] if how is None else float(how), out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values, size = np.empty(len(b), object), b["z"].map(len).to_numpy()
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                if n == 0:
                    values[rows] = [[None] * len(heights)] * len(rows)
                    continue
                z, v = (np.stack(b[c].to_numpy()[rows]).astype(float) for c in ("z", "v"))
                x = np.broadcast_to(np.array(heights, float), (len(rows), len(heights)))
                out = spline_values(z, v, x, kind)
                out = fill(fill(out, x < z[:, :1], v[:, 0], below), x > z[:, -1:], v[:, -1], above)
                values[rows] = [r.tolist() for r in out]
            yield b[keys].assign(values=values)

    out = columns.mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", values array<double>")
    return out.select(*keys, F.posexplode("values").alias("lev", "value"))


def columns_of(field: DataFrame, heights: DataFrame, *by: str) -> DataFrame:
    """VRT-09. Heights joined to values on (by, lev), gathered as arrays z and v in ascending height."""
    return gathered(field.join(heights.select(*by, "lev", "height"), [*by, "lev"]), *by)


def gathered(tall: DataFrame, *by: str) -> DataFrame:
    """Rows (by, height, value) as one row each with arrays z and v in ascending height."""
    pairs = F.array_sort(F.collect_list(F.struct("height", "value")))
    return tall.groupBy(*by).agg(pairs.alias("p")).select(*by, F.transform("p", lambda x: x["height"]).alias("z"), F.transform("p", lambda x: x["value"]).alias("v"))
