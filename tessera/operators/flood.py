"""Parting at waists over blocks: the same regions as ``kernels.seeded`` of the whole, while no task holds more than a block.

Flooding is a forest of least edges. Inside a block a region joins its neighbour
over its least edge, unless that edge leaves the block; what is left are
the regions that wait for a neighbour block, no more than the block has voxels on its
faces. These meet in blocks eight times as long, where most of the faces lie inside, and so
on up to one block, which gets the edges across at most eight pieces an axis.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import components as graph_components
from ..runtime import cut
from . import kernels
from .blocks import halo_join

AXES = ("z", "y", "x")
#: How much longer blocks get from one round to the next.
GROWTH = 8
#: Of a voxel: its region (``node``) and number (``a``). Of a link: two nodes of one region. Of an edge: its order
#: (``level, a, b``), the regions at its ends, -1 for one beyond the block, and whether they have a seed.
VOXEL, LINK, EDGE = range(3)
ROWS = "kind int, node long, other long, level double, a long, b long, seed boolean, to_seed boolean"


def _rows(kind: int, node: np.ndarray, other=-1, level=0.0, a=-1, b=-1, seed=False, to_seed=False) -> pd.DataFrame:
    n = len(node)
    full = lambda x, t: np.broadcast_to(np.asarray(x, t), n)
    return pd.DataFrame({"kind": np.full(n, kind, np.int32), "node": node, "other": full(other, np.int64), "level": full(level, float), "a": full(a, np.int64), "b": full(b, np.int64), "seed": full(seed, bool), "to_seed": full(to_seed, bool)})


def _left(up: np.ndarray, seeded: np.ndarray, name: np.ndarray, ea: np.ndarray, eb: np.ndarray, order: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pd.DataFrame:
    """Edges that are still open, by the names of their regions; of several between two regions the least. The last node is the outside."""
    outside = len(up) - 1
    ra, rb = up[ea], up[eb]
    out = rb == outside
    live = np.flatnonzero(out | ((ra != rb) & ~(seeded[ra] & seeded[rb])))
    ra, rb, out = ra[live], rb[live], out[live]
    # edges outwards are all different
    pair = np.stack([np.where(out, -1 - live, np.minimum(ra, rb)), np.maximum(ra, rb)], axis=1)
    keep = np.sort(np.unique(pair, axis=0, return_index=True)[1])
    e, ra, rb, out = live[keep], ra[keep], rb[keep], out[keep]
    level, a, b = (x[e] for x in order)
    return _rows(EDGE, name[ra], np.where(out, -1, name[rb]), level, a, b, seeded[ra], ~out & seeded[rb])


def _block(full: dict[str, int], least: float, r: int):
    """A block with its margin to its voxels' regions, and what is open at its faces."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        d, first, _ = kernels.dense(rows, "f", 0.0)
        core = kernels.dense(rows, "is_core", False)[0]
        if not core.any():
            return _rows(VOXEL, np.zeros(0, np.int64))
        z, y, x = np.ogrid[tuple(slice(lo, lo + n) for lo, n in zip(first, d.shape))]
        number = ((z * full["y"] + y) * full["x"] + x).ravel()
        at, outside = np.arange(d.size).reshape(d.shape), d.size
        inside = np.append(core.ravel(), False)
        a, b, level = [], [], []
        for k in range(3):
            here, there = kernels.shifted(d, tuple(int(k == j) for j in range(3)))
            both = (d[here] > 0) & (d[there] > 0) & (core[here] | core[there])
            a.append(at[here][both])
            b.append(at[there][both])
            level.append(np.maximum(-d[here][both], -d[there][both]))
        a, b, level = (np.concatenate(v) for v in (a, b, level))
        by = np.lexsort((b, a, level))
        a, b, level = a[by], b[by], level[by]
        ea = np.where(inside[a], a, b)
        eb = np.where(inside[a] & inside[b], b, outside)
        peak = kernels.peaks(d, least, r)
        seeds = np.where(peak & core, kernels.components(peak & core, True), 0).ravel()
        up, on = np.arange(d.size + 1), np.flatnonzero(seeds)
        if len(on):
            _, start, which = np.unique(seeds[on], return_index=True, return_inverse=True)
            up[on] = on[start[which]]
        seeded = np.zeros(d.size + 1, bool)
        seeded[up[on]] = seeded[outside] = True
        up = kernels.joined(up, seeded, ea, eb, outside)
        own = np.flatnonzero(core)
        lowest = np.full(d.size + 1, outside)
        np.minimum.at(lowest, up[own], own)
        name = np.append(number, -1)[lowest]
        parts = [_rows(VOXEL, name[up[own]], a=number[own]), _left(up, seeded, name, ea, eb, (level, number[a], number[b]))]
        # a seed may go on in the next block: both sides name the voxel where they meet
        for o in np.ndindex(3, 3, 3):
            here, there = kernels.shifted(d, tuple(k - 1 for k in o))
            meet = peak[here] & core[here] & peak[there] & ~core[there]
            if meet.any():
                p, q = at[here][meet], at[there][meet]
                parts += [_rows(LINK, name[up[p]], number[p]), _rows(LINK, name[up[p]], number[q])]
        return pd.concat(parts)

    return run


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Open edges of several blocks, joined as far as none of them leads out of all of these."""
    level, a, b = (rows[c].to_numpy() for c in ("level", "a", "b"))
    by = np.lexsort((b, a, level))
    level, a, b = level[by], a[by], b[by]
    node, other, seed, to_seed = (rows[c].to_numpy()[by] for c in ("node", "other", "seed", "to_seed"))
    # the two halves of an edge lie side by side
    second = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
    first = np.flatnonzero(second) - 1
    other, to_seed = other.copy(), to_seed.copy()
    other[first], to_seed[first] = node[first + 1], seed[first + 1]
    level, a, b, node, other, seed, to_seed = (v[~second] for v in (level, a, b, node, other, seed, to_seed))
    names = np.unique(np.concatenate([node, other[other >= 0]]))
    outside = len(names)
    ea, eb = np.searchsorted(names, node), np.where(other < 0, outside, np.searchsorted(names, other))
    seeded = np.zeros(outside + 1, bool)
    seeded[ea[seed]] = seeded[eb[to_seed]] = seeded[outside] = True
    up = kernels.joined(np.arange(outside + 1), seeded, ea, eb, outside)
    lowest = np.full(outside + 1, outside)
    np.minimum.at(lowest, up, np.arange(outside + 1))
    name = np.append(names, -1)[lowest]
    moved = np.flatnonzero(name[up[:outside]] != names)
    return pd.concat([_rows(LINK, names[moved], name[up[moved]]), _left(up, seeded, name, ea, eb, (level, a, b))])


def parted(depth: DataFrame, full: dict[str, int], size: dict[str, int], least: float = 0.5, r: int = 1) -> DataFrame:
    """``depth(z, y, x, f)`` of an object's voxels with their distances to background -> ``(z, y, x, region)``.

    Seeds are peaks of the distance, above ``least`` and not exceeded within ``r``, that touch over faces, edges or corners; the other voxels join them by
    flooding downwards over faces, and what no seed reaches is a region of its own. Regions are named after the number of their first voxel
    in ``full``; they depend neither on ``size``, that of the blocks, nor on the partitions.
    """
    dealt = halo_join(depth.select(*AXES, "f"), full, size, r + 1)
    out = cut(dealt.groupBy("at_block").applyInPandas(_block(full, least, r), ROWS))
    links, open_ = [out.where(F.col("kind") == LINK)], out.where(F.col("kind") == EDGE)
    place = lambda n: {"z": F.expr(f"{n} div {full['y'] * full['x']}"), "y": F.expr(f"({n} div {full['x']}) % {full['y']}"), "x": F.expr(f"{n} % {full['x']}")}
    at = place("node")
    while any(size[k] < full[k] for k in AXES):
        size = {k: size[k] * GROWTH for k in AXES}
        met = cut(open_.groupBy(*(F.floor(at[k] / size[k]).alias(f"_{k}") for k in AXES)).applyInPandas(_meet, ROWS))
        links.append(met.where(F.col("kind") == LINK))
        open_ = met.where(F.col("kind") == EDGE)
    one = links[0]
    for more in links[1:]:
        one = one.unionByName(more)
    roots = graph_components(one.select(F.col("node").alias("src"), F.col("other").alias("dst"))).withColumnRenamed("node", "_node")
    voxels = out.where(F.col("kind") == VOXEL).select("node", "a")
    named = voxels.join(roots, voxels["node"] == roots["_node"], "left").select("a", F.coalesce("root", "node").alias("region"))
    return named.select(*(c.alias(k) for k, c in place("a").items()), "region")
