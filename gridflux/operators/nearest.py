"""The nearest of many boxes or points by a pyramid of counted tiles (JON-01, JON-06).

Points and sources are counted in tiles whose side shrinks by ``FAN`` from level to level. Going down,
each tile of points keeps only those source tiles whose nearest possible distance doesn't exceed the
distance within which k sources lie for certain: the farthest corner of the best tiles, by their counts
and bounds. So no tile ever holds what is left over, a far point costs as many candidates as a near one,
and rows grow with the number of points. Levels of sources follow from their number; below them, tiles of
points shrink on beside single sources as long as they hold ``MANY`` points on average, so the
more points there are, the fewer candidates each has. Points themselves only meet their tile's final list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridflux.sources import sinks

FAN, FEW, DEEPEST, MANY = 4, 16, 8, 32


def _bounds(axes: str, prefix: str, low: dict, high: dict) -> list[Column]:
    return [*(F.min(low[a]).alias(f"{prefix}lo_{a}") for a in axes), *(F.max(high[a]).alias(f"{prefix}hi_{a}") for a in axes)]


def _depth(tiles: DataFrame, axes: str) -> int:
    """The first level where a source finds ``FEW`` sources in its tile on average, from the deepest tiles."""
    finest = tiles.groupBy(*tiles.columns).agg(F.count("*").alias("n")).withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(DEEPEST))))
    up = [F.floor(F.col(f"t{DEEPEST}_{a}") / F.pow(F.lit(float(FAN)), DEEPEST - F.col("level"))).alias(a) for a in axes]
    crowd = finest.groupBy("level", *up).agg(F.sum("n").alias("n")).groupBy("level").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("mean"))
    return min([r["level"] for r in crowd.collect() if r["mean"] <= FEW], default=DEEPEST)


def _point_depth(points: DataFrame, tiles: dict[int, list[Column]], least: int) -> int:
    """The last level whose tiles hold ``MANY`` points on average, by a count that is close enough; ``least`` at least."""
    n = points.agg(F.count("*").alias("n"), *(F.approx_count_distinct(F.xxhash64(*t)).alias(f"n{k}") for k, t in tiles.items())).first()
    return max([k for k in tiles if n[f"n{k}"] * MANY <= n["n"]], default=least)


def candidates(points: DataFrame, sources: DataFrame, axes: str, k: int, keep: list[str], least: float = 0.0, together: str | None = None) -> DataFrame:
    """Pairs of points and sources among which every point finds its ``k`` nearest sources, and all within ``least``.

    ``points``: a column for each of ``axes``, and what else it has. ``sources``: ``lo_`` and ``hi_`` columns of
    each axis, and ``keep``. A tile of points and its source tiles meet by equality. Pairs of equal ``together``,
    a column of points, come in one partition. Sources and final lists are written once; points are only read.
    """
    sources = sinks.stored(sources.select(*dict.fromkeys([*keep, *(f"{e}_{a}" for e in ("lo", "hi") for a in axes)])).withColumn("_s", F.monotonically_increasing_id()), "sources")
    ends = lambda rows, low, high: rows.agg(*(F.min(low[a]).alias(f"lo_{a}") for a in axes), *(F.max(high[a]).alias(f"hi_{a}") for a in axes)).first()
    at, lows, highs = ({a: F.col(f"{e}{a}") for a in axes} for e in ("", "lo_", "hi_"))
    both = [ends(points, at, at), ends(sources, lows, highs)]
    edge = lambda name, pick: pick([e[name] for e in both if e[name] is not None], default=0.0)
    origin = {a: edge(f"lo_{a}", min) for a in axes}
    span = max([edge(f"hi_{a}", max) - origin[a] for a in axes] + [1e-9]) * (1 + 1e-9)

    def tile(at: dict, level: int) -> list[Column]:
        side = span / FAN**level
        return [F.greatest(F.lit(0), F.least(F.lit(FAN**level - 1), F.floor((at[a] - origin[a]) / side))).cast("long").alias(f"t{level}_{a}") for a in axes]

    middle = {a: (F.col(f"lo_{a}") + F.col(f"hi_{a}")) / 2 for a in axes}
    depth = _depth(sources.select(*tile(middle, DEEPEST)), axes)
    finest = _point_depth(points, {n: tile(at, n) for n in range(depth + 1, DEEPEST + 1)}, depth)
    names = {x: [f"{x}{a}" for a in axes] for x in "sp"}
    bounds = {x: [f"{x}{e}_{a}" for e in ("lo", "hi") for a in axes] for x in "sp"}

    def leaves(rows: DataFrame, prefix: str, low: dict, high: dict, level: int) -> DataFrame:
        """Occupied tiles of the last level, with their counts and the bounds of what they hold."""
        here = [c.alias(n) for c, n in zip(tile(low if low is high else middle, level), names[prefix], strict=True)]
        return rows.select("*", *here).groupBy(*names[prefix]).agg(F.count("*").alias(f"{prefix}n"), *_bounds(axes, prefix, low, high))

    def level(rows: DataFrame, prefix: str, up: int) -> DataFrame:
        """The tiles ``up`` levels above."""
        keys = [F.floor(F.col(n) / FAN**up).cast("long").alias(n) for n in names[prefix]]
        low, high = ({a: F.col(f"{prefix}{e}_{a}") for a in axes} for e in ("lo", "hi"))
        return rows.groupBy(*keys).agg(F.sum(f"{prefix}n").alias(f"{prefix}n"), *_bounds(axes, prefix, low, high))

    def pruned(pairs: DataFrame, ids: list[str]) -> DataFrame:
        """What can be among the k nearest, or within ``least``, of anything in its tile of points."""
        gap = {a: F.greatest(F.col(f"slo_{a}") - F.col(f"phi_{a}"), F.col(f"plo_{a}") - F.col(f"shi_{a}"), F.lit(0.0)) for a in axes}
        reach = {a: F.greatest(F.col(f"shi_{a}") - F.col(f"plo_{a}"), F.col(f"phi_{a}") - F.col(f"slo_{a}")) for a in axes}
        length = lambda d: F.sqrt(sum((d[a] * d[a] for a in axes), F.lit(0.0)))
        own = Window.partitionBy(*names["p"])
        pairs = pairs.withColumns({"near": length(gap), "far": length(reach)})
        pairs = pairs.withColumn("held", F.sum("sn").over(own.orderBy("far", *ids).rowsBetween(Window.unboundedPreceding, 0)))
        certain = F.min(F.when(F.col("held") >= k, F.col("far"))).over(own)  # null where there are fewer than k in all
        # a billionth more, also in the sources' unit: distances may be compared to nine decimals
        fits = F.col("near") <= F.greatest(F.col("certain"), F.lit(least)) * (1 + 1e-9) + 1e-9
        return pairs.withColumn("certain", certain).where(F.col("certain").isNull() | fits).drop("near", "far", "held", "certain")

    s_leaves = leaves(sources, "s", lows, highs, depth)
    p_leaves = sinks.stored(leaves(points, "p", at, at, finest), "tiles")
    upper = lambda rows, x: rows.withColumns({f"{x}up_{a}": F.floor(F.col(f"{x}{a}") / FAN).cast("long") for a in axes})
    # the roots of both pyramids; names of a level's tiles: s and p with the axis
    pairs = sources.sparkSession.range(1).select(*(F.lit(0).cast("long").alias(n) for x in "sp" for n in names[x]))
    for step in range(1, finest + 1):
        pairs = pairs.withColumnsRenamed({f"p{a}": f"pup_{a}" for a in axes})
        if step <= depth:
            pairs = pairs.withColumnsRenamed({f"s{a}": f"sup_{a}" for a in axes}).join(upper(level(s_leaves, "s", depth - step), "s"), [f"sup_{a}" for a in axes])
        pairs = pairs.join(upper(level(p_leaves, "p", finest - step), "p"), [f"pup_{a}" for a in axes])
        pairs = pruned(pairs, names["s"] if step <= depth else ["_s"])
        if step == depth:  # from now on single sources
            one = sources.select("_s", F.lit(1).cast("long").alias("sn"), *(c.alias(n) for c, n in zip(tile(middle, depth), names["s"], strict=True)), *(F.col(f"{e}_{a}").alias(f"s{e}_{a}") for e in ("lo", "hi") for a in axes))
            pairs = pruned(pairs.select(*names["p"], *bounds["p"], *names["s"]).join(one, names["s"]), ["_s"])
        pairs = pairs.select(*names["p"], *(names["s"] if step < depth else ["_s", "sn", *bounds["s"]]))
    lists = sinks.stored(pairs.groupBy(*names["p"]).agg(F.collect_list("_s").alias("_near")), "lists")
    p_side = points.select("*", *(c.alias(n) for c, n in zip(tile(at, finest), names["p"], strict=True)))
    light = sinks.is_small(lists) and sinks.is_small(sources)
    beside = F.broadcast if light else (lambda rows: rows)
    if light and together:  # neither join moves the points again
        p_side = p_side.repartition(together)
    found = p_side.join(beside(lists), names["p"]).withColumn("_s", F.explode("_near")).drop("_near", *names["p"])
    found = found.join(beside(sources.select("_s", *keep)), "_s").drop("_s")
    return found.repartition(together) if together and not light else found
