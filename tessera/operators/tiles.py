"""Overlapping tiles of one volume: shifts by correlation, positions by least squares, fusion.

A tile's true position is its nominal one plus an error. What two tiles show of their overlap
tells the difference of both errors, block by block along z, so a task holds a block
of one overlap. Positions of all tiles follow from these links; the links, some a
tile, and the tiles themselves come to the driver, voxels never.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import roots

AXES = ("z", "y", "x")


def shift_between(a: np.ndarray, b: np.ndarray, reach: tuple[int, ...], least: float = 0.3) -> tuple[tuple[int, ...], float]:
    """The s, within reach, at which a[g] = b[g + s] correlates best, and the correlation there; missing voxels are NaN.

    Sums over all pairs of known voxels come from Fourier transforms, for every shift at once. Shifts that leave fewer than
    ``least`` of the most pairs, or three, are out, so are those where either side is flat; without any it is no shift and 0.
    """
    known, padded = [np.isfinite(x) for x in (a, b)], tuple(n + r for n, r in zip(a.shape, reach))
    mean = [x[k].mean() if k.any() else 0.0 for x, k in zip((a, b), known)]
    x, y = (np.where(k, v - m, 0.0) for v, k, m in zip((a, b), known, mean))
    f = [np.fft.rfftn(v, padded) for v in (x, x * x, known[0].astype(float))]
    g = [np.fft.rfftn(v, padded) for v in (y, y * y, known[1].astype(float))]
    span = np.ix_(*(np.arange(-min(r, n - 1), min(r, n - 1) + 1) for r, n in zip(reach, a.shape)))

    def sums(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.fft.irfftn(np.conj(p) * q, padded)[span]

    n = np.round(sums(f[2], g[2]))
    m = np.maximum(n, 1)
    sa, sb = sums(f[0], g[2]), sums(f[2], g[0])
    va, vb = sums(f[1], g[2]) - sa * sa / m, sums(f[2], g[1]) - sb * sb / m
    flat = (va <= 1e-9 * (x * x).sum()) | (vb <= 1e-9 * (y * y).sum())
    ok = (n >= max(3, least * n.max())) & ~flat
    if not ok.any():
        return (0,) * a.ndim, 0.0
    r = np.where(ok, np.round((sums(f[0], g[0]) - sa * sb / m) / np.sqrt(np.where(ok, va * vb, 1)), 9), -2)
    far = sum(s.astype(float) ** 2 for s in span)
    at = min(map(tuple, np.argwhere(r == r.max()).tolist()), key=lambda k: (far[k], k))
    return tuple(int(s.ravel()[k]) for s, k in zip(span, at)), float(np.clip(r.max(), -1, 1))


def overlaps(placed: DataFrame, size: dict[str, int]) -> DataFrame:
    """``placed(tile, z, y, x)``, nominal corners -> ``(one, two, lo_z, hi_z, ...)``, pairs of tiles whose boxes meet and where, in nominal places.

    Tiles meet by the cells of a grid as wide as a tile, so there is no cross join. Repeated tiles count once.
    """
    cells = placed.dropDuplicates(["tile"])
    for a in AXES:
        cells = cells.withColumn(f"c{a}", F.explode(F.expr(f"sequence(cast(floor({a} / {size[a]}) as long), cast(floor(({a} + {size[a]} - 1) / {size[a]}) as long))")))
    names = [f"c{a}" for a in AXES]
    one = cells.select(F.col("tile").alias("one"), *names, *(F.col(a).alias(f"{a}1") for a in AXES))
    two = cells.select(F.col("tile").alias("two"), *names, *(F.col(a).alias(f"{a}2") for a in AXES))
    met = one.join(two, names).where("one < two").drop(*names).distinct()
    box = [x for a in AXES for x in (F.greatest(f"{a}1", f"{a}2").cast("long").alias(f"lo_{a}"), (F.least(f"{a}1", f"{a}2") + size[a]).cast("long").alias(f"hi_{a}"))]
    return met.select("one", "two", *box).where(" and ".join(f"lo_{a} < hi_{a}" for a in AXES))


def links(voxels: DataFrame, placed: DataFrame, size: dict[str, int], reach: dict[str, int], block: int = 64) -> DataFrame:
    """``voxels(tile, z, y, x, v)``, places within their tile -> ``(one, two, s_z, s_y, s_x, r, blocks)``.

    ``s`` is the error of tile one less that of tile two, ``r`` the mean correlation of the blocks that
    agree on it. A pair's shift is the one that has most correlation over its blocks of ``block`` planes. Voxels of unknown tiles
    and null values count for nothing.
    """
    pairs = overlaps(placed, size)
    sides = pairs.select(F.col("one").alias("tile"), "*", F.lit(0).alias("side")).unionByName(pairs.select(F.col("two").alias("tile"), "*", F.lit(1).alias("side")))
    corner = placed.dropDuplicates(["tile"]).select("tile", *(F.col(a).alias(f"p{a}") for a in AXES))
    there = voxels.where("v is not null").join(corner, "tile").select("tile", "v", *((F.col(a) + F.col(f"p{a}")).cast("long").alias(f"g{a}") for a in AXES))
    # what lies in the nominal overlap, and as far around it as a shift can reach
    inside = there.join(sides, "tile").where(" and ".join(f"g{a} >= lo_{a} - {reach[a]} and g{a} < hi_{a} + {reach[a]}" for a in AXES))
    own, r = F.col("gz") - F.col("lo_z"), reach["z"]
    most = F.floor((F.col("hi_z") - F.col("lo_z") - 1) / block)
    clamped = lambda x: F.greatest(F.lit(0), F.least(most, F.floor(x / block))).cast("long")
    among = F.sequence(clamped(own - r), clamped(own + r))
    dealt = inside.withColumn("part", F.explode(among))

    def seen(f: pd.DataFrame) -> pd.DataFrame:
        head = f.iloc[0]
        lo, hi = f[["gz", "gy", "gx"]].min(), f[["gz", "gy", "gx"]].max()
        both = np.full((2, *(hi - lo + 1)), np.nan)
        both[(f["side"], *(f[c] - lo[c] for c in lo.index))] = f["v"]
        s, r = shift_between(both[0], both[1], tuple(reach[a] for a in AXES))
        return pd.DataFrame({"one": [head["one"]], "two": [head["two"]], "s_z": [s[0]], "s_y": [s[1]], "s_x": [s[2]], "r": [r]})

    tile = placed.schema["tile"].dataType.simpleString()
    each = dealt.groupBy("one", "two", "part").applyInPandas(seen, f"one {tile}, two {tile}, s_z long, s_y long, s_x long, r double")
    votes = each.groupBy("one", "two", "s_z", "s_y", "s_x").agg(F.sum(F.greatest("r", F.lit(0.0))).alias("weight"), F.avg("r").alias("r"), F.count("*").alias("blocks"))
    order = F.struct("weight", *(-F.abs(F.col(f"s_{a}")) for a in AXES), *(F.col(f"s_{a}") for a in AXES))
    best = votes.groupBy("one", "two").agg(F.max_by(F.struct("s_z", "s_y", "s_x", "r", "blocks"), order).alias("best"))
    return best.select("one", "two", "best.*")


def solved(found: list[tuple], tiles: list, tolerance: float = 1.5) -> tuple[dict, list[tuple]]:
    """Errors of all tiles by least squares from links (one, two, s, weight), and the links in use.

    As long as a link is off by more than ``tolerance`` and its tiles hold together without it, the worst one is dropped.
    The first tile of each connected part stays where it is.
    """
    at = {t: k for k, t in enumerate(tiles)}
    use = list(found)
    while True:
        errors = np.zeros((len(tiles), len(AXES)))
        if not use:
            return {t: errors[k] for t, k in at.items()}, use
        one, two = (np.array([at[x[k]] for x in use]) for k in (0, 1))
        s, w = np.array([x[2] for x in use], float), np.sqrt(np.array([x[3] for x in use], float))
        node, root = roots(one, two)
        fixed = np.unique(root)
        rows = np.zeros((len(use) + len(fixed), len(tiles)))
        rows[np.arange(len(use)), one], rows[np.arange(len(use)), two] = w, -w
        rows[len(use) + np.arange(len(fixed)), fixed] = 1.0
        errors = np.linalg.lstsq(rows, np.vstack([s * w[:, None], np.zeros((len(fixed), len(AXES)))]), rcond=None)[0]
        off = np.abs(errors[one] - errors[two] - s).max(axis=1)
        for k in np.argsort(-off):
            if off[k] <= tolerance:
                return {t: errors[i] for t, i in at.items()}, use
            rest = np.delete(np.arange(len(use)), k)
            if len(rest) and len(np.unique(roots(one[rest], two[rest])[1])) == len(fixed) and len(np.unique(np.concatenate([one[rest], two[rest]]))) == len(node):
                use.pop(int(k))
                break
        else:
            return {t: errors[i] for t, i in at.items()}, use


def positions(spark: SparkSession, found: DataFrame, placed: DataFrame, least: float = 0.7, most: float = 1.0, tolerance: float = 1.5) -> DataFrame:
    """``(tile, z, y, x)``, true corners in whole voxels, from links whose correlation is from ``least`` to ``most``; tiles without a link stay."""
    rows = sorted(placed.dropDuplicates(["tile"]).select("tile", *AXES).collect())
    kept = found.where(F.col("r").between(least, most + 1e-9)).orderBy("one", "two").collect()
    errors, _ = solved([(r["one"], r["two"], (r["s_z"], r["s_y"], r["s_x"]), r["r"]) for r in kept], [r["tile"] for r in rows], tolerance)
    tile = placed.schema["tile"].dataType.simpleString()
    return spark.createDataFrame([(r["tile"], *(int(r[a] + round(float(e))) for a, e in zip(AXES, errors[r["tile"]]))) for r in rows], f"tile {tile}, z long, y long, x long")


def fused(voxels: DataFrame, placed: DataFrame, size: dict[str, int]) -> DataFrame:
    """``(z, y, x, v)`` of the whole volume: where tiles overlap, means that count less towards a tile's sides."""
    corner = placed.select("tile", *(F.col(a).alias(f"p{a}") for a in AXES))
    weight = F.lit(1.0)
    for a in AXES:
        weight = weight * F.least(F.col(a) + 1, size[a] - F.col(a))
    there = voxels.where("v is not null").join(corner, "tile").select(*((F.col(a) + F.col(f"p{a}")).cast("long").alias(a) for a in AXES), "v", weight.alias("w"))
    return there.groupBy(*AXES).agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("v"))
