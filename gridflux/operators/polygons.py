"""Polygons as signed rings, and areas of what they share with convex cells.

A layer has a row for each ring: the feature's attributes, ``ring`` (array of (x, y)) and ``sign``, 1 for
a shell and -1 for a hole; a layer without ``sign`` holds shells only. A feature may have any number of
parts. Rings are simple, but need not be convex. What a half-plane cuts off a ring leaves one closed line
even where several pieces remain: the pieces are joined along the cut, there and back, so signed areas
stay right and cuts can follow one another (source cell, then destination cell).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"
#: Vertices of one step: rings of a batch are clipped together, padded to one length.
STEP = 1 << 18


def signed(layer: DataFrame) -> DataFrame:
    return layer if "sign" in layer.columns else layer.withColumn("sign", F.lit(1))


def rings(parts: DataFrame, column: str = "rings") -> DataFrame:
    """SRC-16. One row for each ring of the parts (``rings``: the shell, then its holes), last corners that
    repeat the first left out; nulls and rings of less than three corners are dropped."""
    rows = parts.select(*[c for c in parts.columns if c != column], F.posexplode(column).alias("_at", "ring"))
    closed = (F.size("ring") > 1) & (F.element_at("ring", 1) == F.element_at("ring", -1))
    rows = rows.withColumn("ring", F.when(closed, F.slice("ring", 1, F.size("ring") - 1)).otherwise(F.col("ring")))
    return rows.where(F.size("ring") >= 3).withColumn("sign", F.when(F.col("_at") == 0, 1).otherwise(-1)).drop("_at")


def with_bounds(layer: DataFrame) -> DataFrame:
    """xmin, xmax, ymin and ymax of each ring."""
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    return layer.withColumns({"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)})


def box(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """A rectangle's ring, counter-clockwise."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def shoelace(ring: Column) -> Column:
    """Planar area of a ring, without sign."""
    at = lambda k: F.get(ring, k % F.size(ring))
    return F.abs(F.aggregate(F.sequence(F.lit(0), F.size(ring) - 1), F.lit(0.0), lambda s, k: s + at(k)["x"] * at(k + 1)["y"] - at(k + 1)["x"] * at(k)["y"])) / 2


def shifted(layer: DataFrame, period: float = 360.0) -> DataFrame:
    """The rings and their copies one period to the west and to the east, for layers and points on
    different sides of the seam."""
    rows = layer.withColumn("_shift", F.explode(F.array(*map(F.lit, (-period, 0.0, period)))))
    moved = F.transform("ring", lambda p: F.struct((p["x"] + F.col("_shift")).alias("x"), p["y"].alias("y")))
    return rows.withColumn("ring", moved).drop("_shift")


# ------------------------------------------------------------------ clipping, many rings at once


def _padded(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x and y of the rings, a row each, filled up to the longest; and their numbers of corners."""
    n = np.asarray(rings.value_lengths()).astype(np.int64)
    flat = rings.flatten()
    x, y = (np.asarray(c) for c in flat.flatten())
    width = max(1, int(n.max(initial=0)))
    inside = np.arange(width) < n[:, None]
    out = np.zeros((2, len(n), width))
    out[0][inside], out[1][inside] = x, y
    return out[0], out[1], n


def _areas(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Signed areas, counter-clockwise ones positive; taken from the first corner, for large coordinates."""
    k = np.arange(x.shape[1])
    after = np.where(k + 1 < n[:, None], k + 1, 0)
    dx, dy = x - x[:, :1], y - y[:, :1]
    cross = dx * np.take_along_axis(dy, after, 1) - np.take_along_axis(dx, after, 1) * dy
    return np.where(k < n[:, None], cross, 0).sum(1) / 2


def _cut(x: np.ndarray, y: np.ndarray, n: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What of each ring lies where ``side``, known at its corners and linear between them, is not negative."""
    k = np.arange(x.shape[1])
    here = k < n[:, None]
    after = np.where(k + 1 < n[:, None], k + 1, 0)
    x_after, y_after, side_after = (np.take_along_axis(v, after, 1) for v in (x, y, side))
    kept = here & (side >= 0)
    crossed = here & ((side >= 0) != (side_after >= 0))
    t = side / np.where(crossed, side - side_after, 1)
    corners = np.stack([x, x + t * (x_after - x)], 2).reshape(len(x), -1), np.stack([y, y + t * (y_after - y)], 2).reshape(len(x), -1)
    chosen = np.stack([kept, crossed], 2).reshape(len(x), -1)
    left = chosen.sum(1)
    row, _ = np.nonzero(chosen)
    place = (np.cumsum(chosen, 1) - 1)[chosen]
    out = np.zeros((2, len(x), max(1, int(left.max(initial=0)))))
    out[0][row, place], out[1][row, place] = corners[0][chosen], corners[1][chosen]
    return out[0], out[1], left


def clip_rings(rings: pa.Array, windows: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Each ring within its convex window: the ring left, its area and the whole ring's area, both positive
    however the rings turn."""
    x, y, n = _padded(rings)
    wx, wy, wn = _padded(windows)
    turn = np.where(_areas(wx, wy, wn) < 0, -1.0, 1.0)
    whole = _areas(x, y, n)
    for k in range(wx.shape[1]):
        a, b = k % np.maximum(wn, 1), (k + 1) % np.maximum(wn, 1)  # a window with fewer corners is cut by some twice
        rows = np.arange(len(x))
        ax, ay, bx, by = wx[rows, a], wy[rows, a], wx[rows, b], wy[rows, b]
        side = turn[:, None] * ((bx - ax)[:, None] * (y - ay[:, None]) - (by - ay)[:, None] * (x - ax[:, None]))
        x, y, n = _cut(x, y, n, side)
    area = _areas(x, y, n) * np.where(whole < 0, -1.0, 1.0)
    inside = np.arange(x.shape[1]) < n[:, None]
    corners = pa.StructArray.from_arrays([pa.array(x[inside]), pa.array(y[inside])], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), corners), np.maximum(area, 0.0), np.abs(whole)


def _steps(rings: pa.Array) -> tuple[list[int], list[int]]:
    """Starts and numbers of rows of steps: until the rows' number times the longest ring reaches ``STEP``; a
    ring is never split."""
    sizes = np.maximum(np.asarray(rings.value_lengths().fill_null(0)), 4).astype(np.int64)
    starts, counts, at = [], [], 0
    while at < len(sizes):
        widest = np.maximum.accumulate(sizes[at : at + STEP])
        starts.append(at)
        counts.append(max(1, int(np.searchsorted(widest * np.arange(1, len(widest) + 1), STEP, "right"))))
        at += counts[-1]
    return starts, counts


def line_and_side(rings: pa.Array, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planar distance of each point to its ring's line (NaN without a corner), and whether the ring holds it:
    ray casting, lower and left borders count as inside."""
    ax, ay, n = _padded(rings)
    k = np.arange(ax.shape[1])
    here = k < n[:, None]
    after = np.where(k + 1 < n[:, None], k + 1, 0)
    bx, by = np.take_along_axis(ax, after, 1), np.take_along_axis(ay, after, 1)
    x, y, dx, dy = x[:, None], y[:, None], bx - ax, by - ay
    long = dx * dx + dy * dy
    with np.errstate(invalid="ignore", divide="ignore"):
        t = np.clip(np.where(long > 0, ((x - ax) * dx + (y - ay) * dy) / np.where(long > 0, long, 1), 0), 0, 1)
        gap = np.sqrt((ax + t * dx - x) ** 2 + (ay + t * dy - y) ** 2)
        crosses = here & ((ay <= y) != (by <= y)) & (x < ax + (y - ay) * (dx / np.where(dy != 0, dy, 1)))
    least = np.where(here, gap, np.inf).min(1, initial=np.inf)
    return np.where(np.isinf(least), np.nan, least), crosses.sum(1) % 2 == 1


def beside(ring: str, x: str, y: str) -> Column:
    """line: a point's distance to a ring's line (null without a place or a corner), and inside: whether the ring holds it."""

    @F.arrow_udf("struct<line:double,inside:boolean>")
    def found(ring: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        parts = [line_and_side(ring.slice(at, n), *(v.slice(at, n).to_numpy(zero_copy_only=False) for v in (x, y))) for at, n in zip(*_steps(ring), strict=True)]
        line, inside = (np.concatenate([p[i] for p in parts] or [np.empty(0, kind)]) for i, kind in ((0, float), (1, bool)))
        return pa.StructArray.from_arrays([pa.array(line, pa.float64(), mask=np.isnan(line)), pa.array(inside, pa.bool_())], ["line", "inside"])

    return found(ring, x, y)


def clipped(pairs: DataFrame, ring: str = "ring", window: str = "window", area: str = "area", whole: str | None = None) -> DataFrame:
    """The pairs, ``ring`` cut to the convex ``window`` of its row, with the area left (of a shell or a hole,
    never negative) and, where named, the whole ring's; ``window`` goes."""
    kept = [c for c in pairs.columns if c not in (ring, window)]
    names = [*kept, ring, area, *([whole] if whole else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in map(batch.slice, *_steps(batch[ring])):
                left, found, total = clip_rings(part[ring], part[window])
                columns = [*(part[c] for c in kept), left, pa.array(found), *([pa.array(total)] if whole else [])]
                yield pa.RecordBatch.from_arrays(columns, names)

    types = dict(pairs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), f"`{ring}` {RING}", f"`{area}` double", *([f"`{whole}` double"] if whole else [])])
    return pairs.mapInArrow(run, schema)


# ------------------------------------------------------------------ tiles


def tile_size(boxes: DataFrame, xmin: str = "xmin", xmax: str = "xmax", ymin: str = "ymin", ymax: str = "ymax", target: int = 128) -> float:
    """Side of square tiles that hold about ``target`` of the boxes where these are spread evenly, and not
    under the boxes' mean extent, so a box reaches few tiles. One aggregate of the boxes."""
    c = F.col
    row = boxes.agg(F.count("*").alias("n"), (F.max(xmax) - F.min(xmin)).alias("w"), (F.max(ymax) - F.min(ymin)).alias("h"), F.avg(F.greatest(c(xmax) - c(xmin), c(ymax) - c(ymin))).alias("mean")).first()
    if not row["n"]:
        return 1.0
    return max(((row["w"] or 0) * (row["h"] or 0) * target / row["n"]) ** 0.5, row["mean"] or 0, 1e-9)


def tiles(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def touching(a: DataFrame, b: DataFrame, tile: float) -> DataFrame:
    """Pairs whose bounds touch, each once: ``a`` and ``b`` meet in a tile and pair up in their first common one.
    Bounds are xmin, xmax, ymin and ymax of ``a``, and the same with ``c`` before them of ``b``."""
    ta = a.withColumn("_tx", F.explode(tiles(F.col("xmin"), F.col("xmax"), tile))).withColumn("_ty", F.explode(tiles(F.col("ymin"), F.col("ymax"), tile)))
    tb = b.withColumn("_tx", F.explode(tiles(F.col("cxmin"), F.col("cxmax"), tile))).withColumn("_ty", F.explode(tiles(F.col("cymin"), F.col("cymax"), tile)))
    touch = (F.col("xmax") >= F.col("cxmin")) & (F.col("xmin") <= F.col("cxmax")) & (F.col("ymax") >= F.col("cymin")) & (F.col("ymin") <= F.col("cymax"))
    first = (F.col("_tx") == F.floor(F.greatest("xmin", "cxmin") / tile)) & (F.col("_ty") == F.floor(F.greatest("ymin", "cymin") / tile))
    return ta.join(tb, ["_tx", "_ty"]).where(touch & first).drop("_tx", "_ty")
