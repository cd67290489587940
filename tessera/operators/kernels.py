"""Numpy kernels for halo blocks: filters, distances, watershed, tensors.

A kernel sees one block as dense arrays, its margin included, and returns
rows for the core. Blocks are groups of ``applyInPandas`` keyed by the number
that ``blocks.halo_join`` gave, so a task holds one block at a time, whose
size the block grid bounds.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from itertools import groupby, product
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import halo_join

AXES = ("z", "y", "x")


def gaussian_weights(sigma: float, truncate: float = 4.0) -> np.ndarray:
    r = int(truncate * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / max(sigma, 1e-12)) ** 2)
    return w / w.sum()


def gaussian(a: np.ndarray, sigma: tuple[float, ...]) -> np.ndarray:
    """Separable Gaussian; the array is mirrored at its ends, the end value included."""
    out = a.astype(float)
    for axis, s in enumerate(sigma):
        if s > 0:
            w = gaussian_weights(s)
            r = len(w) // 2
            padded = np.pad(out, [(r, r) if k == axis else (0, 0) for k in range(out.ndim)], mode="symmetric")
            out = sum(wk * np.take(padded, range(k, k + out.shape[axis]), axis=axis) for k, wk in enumerate(w))
    return out


def edt1(f: np.ndarray, step: float) -> np.ndarray:
    """Least of f(j) + (step (i - j))^2 for each i along the last axis.

    Lower envelopes of parabolas, all lines of the array at once; time and
    memory grow with the array.
    """
    n = f.shape[-1]
    lines = f.reshape(-1, n)
    m = len(lines)
    row = np.arange(m)
    at = np.zeros((m, n), np.int64)  # parabolas of the envelope
    low = np.full((m, n + 1), np.inf)  # where each one begins to be the lowest
    top = np.full(m, -1)
    for q in range(n):
        todo = row[np.isfinite(lines[:, q])]
        while len(todo):
            t = top[todo]
            empty = t < 0
            p = at[todo, np.maximum(t, 0)]
            with np.errstate(invalid="ignore", divide="ignore"):
                cross = ((lines[todo, q] - lines[todo, p]) / (step * step) + q * q - p * p) / (2.0 * (q - p))
            cross = np.where(empty, -np.inf, cross)
            behind = ~empty & (cross <= low[todo, np.maximum(t, 0)])
            done = todo[~behind]
            top[done] += 1
            at[done, top[done]] = q
            low[done, top[done]] = cross[~behind]
            todo = todo[behind]
            top[todo] -= 1
    out, here = np.full((m, n), np.inf), np.zeros(m, np.int64)
    low[row, np.maximum(top, 0) + 1] = np.inf
    some = top >= 0
    for i in range(n):
        while True:
            on = some & (here < top)
            on[on] = low[row[on], here[on] + 1] < i
            if not on.any():
                break
            here[on] += 1
        j = at[row, here]
        out[some, i] = lines[row[some], j[some]] + (step * (i - j[some])) ** 2
    return out.reshape(f.shape)


def distance(mask: np.ndarray, spacing: tuple[float, ...], axes: tuple[int, ...] | None = None) -> np.ndarray:
    """Euclidean distance of each true voxel to the nearest false one along some axes (all by default); infinite without one."""
    f = np.where(mask, np.inf, 0.0)
    for k in range(mask.ndim) if axes is None else axes:
        f = np.moveaxis(edt1(np.moveaxis(f, k, -1), spacing[k]), -1, k)
    return np.sqrt(f)


def distance_in_planes(mask: np.ndarray, dy: float = 1.0, dx: float = 1.0) -> np.ndarray:
    """Euclidean distance of each true voxel to the nearest false one in its plane; infinite without one."""
    return distance(mask, (1.0, dy, dx), (2, 1))


def shifted(a: np.ndarray, offset: tuple[int, ...]) -> tuple[tuple[slice, ...], tuple[slice, ...]]:
    """Where voxels lie that have a neighbour at an offset, and where those neighbours lie."""
    here = tuple(slice(max(0, -o), max(0, s - max(0, o))) for o, s in zip(offset, a.shape))
    there = tuple(slice(max(0, o), max(0, s + min(0, o))) for o, s in zip(offset, a.shape))
    return here, there


def nearest_labels(labels: np.ndarray, reach: float, spacing: tuple[float, ...], near: list[tuple[int, ...]] | None = None) -> np.ndarray:
    """Background within ``reach``, or where ``near`` is given at these offsets, takes the label of the nearest object, of equally near ones the smaller; voxels may be longer along an axis."""
    r = [int(reach / s) for s in spacing]
    square = lambda o: round(sum((d * s) ** 2 for d, s in zip(o, spacing)), 9)
    near = [o for o in product(*(range(-k, k + 1) for k in r)) if square(o) <= reach * reach + 1e-9] if near is None else near
    offsets = sorted((square(o), o) for o in near if square(o) > 0)
    out = labels.copy()
    none = np.iinfo(np.int64).max
    for _, ring in groupby(offsets, lambda x: x[0]):
        best = np.full(labels.shape, none, np.int64)
        for _, o in ring:
            here, there = shifted(labels, o)
            seen = labels[there]
            best[here] = np.minimum(best[here], np.where(seen > 0, seen, none))
        take = (out == 0) & (best < none)
        out[take] = best[take]
    return out


def ranked(a: np.ndarray, offsets: list[tuple[int, ...]], how: str) -> np.ndarray:
    """min, max or median over a neighbourhood; neighbours outside the array do not count. Time grows with the offsets, memory with the array (median: with both)."""
    if how in ("min", "max"):
        fold = np.minimum if how == "min" else np.maximum
        out = a.copy() if tuple([0] * a.ndim) in offsets else np.full(a.shape, a.max() if how == "min" else a.min(), a.dtype)
        for o in offsets:
            here, there = shifted(a, o)
            out[here] = fold(out[here], a[there])
        return out
    stack = np.full((len(offsets), *a.shape), np.nan)
    for k, o in enumerate(offsets):
        here, there = shifted(a, o)
        stack[(k, *here)] = a[there]
    return np.nanmedian(stack, axis=0)


def joined(up: np.ndarray, seeded: np.ndarray, a: np.ndarray, b: np.ndarray, outside: int = -1) -> np.ndarray:
    """``up`` of each node once every region without a seed has joined its neighbour over its least edge, round by round.

    Edges from ``a`` to ``b`` come in their order, least first. The node ``outside``, a seeded one, stands for all that
    is not looked at: a region whose least edge leads there stays as it is, since what it would join is not known.
    """
    up = up.copy()
    node = np.arange(len(up))
    while True:
        ra, rb = up[a], up[b]
        live = (ra != rb) & ~(seeded[ra] & seeded[rb])
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        best = np.full(len(up), len(a), np.int64)
        edge = np.arange(len(a))
        np.minimum.at(best, ra, edge)
        np.minimum.at(best, rb, edge)
        joins = np.flatnonzero((best < len(a)) & ~seeded)
        e = best[joins]
        other = np.where(ra[e] == joins, rb[e], ra[e])
        joins, other = joins[other != outside], other[other != outside]
        if not len(joins):
            return up
        to = node.copy()
        to[joins] = other
        # two regions that chose each other: the one that comes first stays
        mutual = joins[(to[other] == joins) & (joins < other)]
        to[mutual] = mutual
        while (to != to[to]).any():
            to = to[to]
        up = to[up]


def watershed(image: np.ndarray, seeds: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Flooding from seeds: each voxel joins the seed that it reaches over the lowest pass; faces connect.

    This is the spanning forest of least passes, a pass being the greater of
    two neighbours' values, equal ones in the order of their places. All
    regions without a seed join their least neighbour at once, round by round, so the
    number of rounds grows with the logarithm of the voxels. What no seed
    reaches stays 0.
    """
    seeds = np.where(mask, seeds, 0)
    number = np.arange(mask.size).reshape(mask.shape)
    a, b, level = [], [], []
    for k in range(mask.ndim):
        here, there = shifted(mask, tuple(int(k == j) for j in range(mask.ndim)))
        both = mask[here] & mask[there]
        a.append(number[here][both])
        b.append(number[there][both])
        level.append(np.maximum(image[here][both], image[there][both]))
    a, b, level = (np.concatenate(x) for x in (a, b, level))
    order = np.lexsort((b, a, level))
    a, b = a[order], b[order]
    # voxels of one seed are one region from the start, wherever they lie
    flat, up = seeds.ravel(), np.arange(mask.size)
    on = np.flatnonzero(flat)
    if len(on):
        _, first, which = np.unique(flat[on], return_index=True, return_inverse=True)
        up[on] = on[first[which]]
    seeded = np.zeros(mask.size, bool)
    seeded[up[on]] = True
    up = joined(up, seeded, a, b)
    out = np.where(seeded[up], flat[up], 0)
    return out.reshape(mask.shape).astype(seeds.dtype)


def compact_watershed(image: np.ndarray, seeds: np.ndarray, mask: np.ndarray, compactness: float, spacing: tuple[float, ...]) -> np.ndarray:
    """Flooding in the order of value plus ``compactness`` times the distance from the seed's own voxel, then age; faces connect.

    The order depends on the way taken, so voxels come one by one from a heap.
    """
    out, heap, age = np.zeros(seeds.shape, seeds.dtype), [], 0
    for p in zip(*(x.tolist() for x in np.nonzero(np.where(mask, seeds, 0)))):
        heapq.heappush(heap, (float(image[p]), age, p, p))
        age += 1
    steps = [tuple(s * int(k == j) for j in range(image.ndim)) for k in range(image.ndim) for s in (-1, 1)]
    while heap:
        _, _, p, source = heapq.heappop(heap)
        if out[p] and p != source:
            continue
        out[p] = seeds[source]
        for o in steps:
            q = tuple(x + d for x, d in zip(p, o))
            if all(0 <= x < n for x, n in zip(q, image.shape)) and mask[q] and not out[q] and not seeds[q]:
                far = sum(((x - y) * s) ** 2 for x, y, s in zip(q, source, spacing)) ** 0.5
                heapq.heappush(heap, (float(image[q]) + compactness * far, age, q, source))
                age += 1
    return out


def flooded(image: np.ndarray, seeds: np.ndarray, mask: np.ndarray | None = None, invert: bool = False, edt: bool = False, compactness: float = 0.0, spacing: tuple[float, ...] | None = None, negative: np.ndarray | None = None, post: np.ndarray | None = None) -> np.ndarray:
    """Marker watershed with its options.

    ``invert`` floods from high values, ``edt`` floods the distance of non-zero
    values to zero ones; where ``negative`` is false stands a seed of its own, one above
    the largest; ``post`` removes what lies outside of it.
    """
    spacing = spacing or (1.0,) * image.ndim
    seeds = seeds.astype(np.int64)
    if negative is not None:
        seeds = np.where(negative, seeds, seeds.max(initial=0) + 1)
    image = -image.astype(float) if invert else image.astype(float)
    image = distance(image != 0, spacing) if edt else image
    mask = np.ones(image.shape, bool) if mask is None else mask
    out = compact_watershed(image, seeds, mask, compactness, spacing) if compactness else watershed(image, seeds, mask)
    return out if post is None else np.where(post, out, 0)


def components(mask: np.ndarray, full: bool = False) -> np.ndarray:
    """Components of a mask, numbered by their first voxel; faces connect, or corners too."""
    ids = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    near = [o for o in np.ndindex(*(3,) * mask.ndim) if o > (1,) * mask.ndim and (full or sum(k != 1 for k in o) == 1)]
    pairs = []
    for o in near:
        a = tuple(slice(max(0, 1 - k), s - max(0, k - 1)) for k, s in zip(o, mask.shape))
        b = tuple(slice(max(0, k - 1), s - max(0, 1 - k)) for k, s in zip(o, mask.shape))
        both = mask[a] & mask[b]
        pairs.append(np.stack([ids[a][both], ids[b][both]], axis=1))
    up = np.arange(mask.size + 1)
    edges = np.concatenate(pairs) if pairs else np.zeros((0, 2), int)
    while len(edges):
        r = up[edges]
        r = r[r[:, 0] != r[:, 1]]
        if not len(r):
            break
        np.minimum.at(up, r.max(axis=1), r.min(axis=1))
        while (up != up[up]).any():
            up = up[up]
    root = up[ids]
    return np.unique(root, return_inverse=True)[1].reshape(mask.shape) + (0 if (root == 0).any() else 1)


def filled(mask: np.ndarray) -> np.ndarray:
    """Holes filled: background that does not reach the array's border."""
    c = components(~mask)
    outside = set()
    for axis in range(mask.ndim):
        for k in (0, -1):
            outside.update(np.unique(np.take(c, k, axis=axis)).tolist())
    return mask | ((c > 0) & ~np.isin(c, list(outside)))


def structure_tensor(a: np.ndarray, sigma: float, rho: float) -> np.ndarray:
    """Eigenvalues (ascending, last axis) of the smoothed outer product of gradients."""
    g = np.gradient(gaussian(a, (sigma,) * 3))
    t = np.empty((*a.shape, 3, 3))
    for i in range(3):
        for j in range(3):
            t[..., i, j] = gaussian(g[i] * g[j], (rho,) * 3)
    return np.linalg.eigvalsh(t)


def dense(rows: pd.DataFrame, value: str, fill: float = 0) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """A block's rows as an array, its first coordinates, and the rows' places in it."""
    first = np.array([rows[a].min() for a in AXES])
    shape = tuple(int(rows[a].max() - lo + 1) for a, lo in zip(AXES, first))
    at = tuple((rows[a].to_numpy() - lo) for a, lo in zip(AXES, first))
    out = np.full(shape, fill, dtype=rows[value].to_numpy().dtype)
    out[at] = rows[value].to_numpy()
    return out, first, at


def by_block(vox: DataFrame, full: dict[str, int], size: dict[str, int], margin: int, kernel: Callable[..., np.ndarray], value: str | tuple[str, ...] = "v", to: str = "out", kind: str = "double") -> DataFrame:
    """Apply an array kernel to each block with its margin; cores come back as (z, y, x, to).

    With several values the kernel gets an array for each of them.
    """
    values = (value,) if isinstance(value, str) else value

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [dense(rows, v) for v in values]
        out = rows[[*AXES]].assign(**{to: kernel(*(a for a, _, _ in arrays))[arrays[0][2]]})
        return out[rows["is_core"].to_numpy()]

    h = halo_join(vox.select(*AXES, *values), full, size, margin)
    return h.groupBy("at_block").applyInPandas(run, f"z long, y long, x long, {to} {kind}")


def regions_by_block(vox: DataFrame, full: dict[str, int], size: dict[str, int], margin: int, kernel: Callable[..., np.ndarray], value: str | tuple[str, ...] = "v", share: float = 0.5) -> DataFrame:
    """Segment each block with its margin and stitch the regions: ``(z, y, x, region)``.

    A region is named after its block and number, so no names collide. Where
    the margins of blocks overlap every voxel has a region from each of them; two
    regions are one if they share at least ``share`` of the smaller one's
    part of the overlap. Regions come out as the least name of what they are one with; 0 is none.
    """
    from ..runtime import components as closure
    from ..runtime import cut

    values = (value,) if isinstance(value, str) else value

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [dense(rows, v) for v in values]
        out = kernel(*(a for a, _, _ in arrays))[arrays[0][2]].astype(np.int64)
        name = np.where(out > 0, rows["at_block"].to_numpy() * (1 << 32) + out, 0)
        return rows[[*AXES, "is_core"]].assign(region=name)[out > 0]

    h = halo_join(vox.select(*AXES, *values), full, size, margin)
    named = cut(h.groupBy("at_block").applyInPandas(run, "z long, y long, x long, is_core boolean, region long"))
    # voxels that several blocks have seen: a handful of names each, one a block
    shared = named.groupBy(*AXES).agg(F.collect_list("region").alias("regions")).where("size(regions) > 1")
    pairs = shared.select(F.explode("regions").alias("a"), "regions").select("a", F.explode("regions").alias("b"))
    n = cut(pairs.groupBy("a", "b").agg(F.count("*").alias("n")))
    own = n.where("a = b").select(F.col("a").alias("node"), F.col("n").alias("own"))
    met = n.where("a < b").join(own.toDF("a", "own_a"), "a").join(own.toDF("b", "own_b"), "b").where(F.col("n") >= share * F.least("own_a", "own_b"))
    root = closure(met.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    core = named.where("is_core").join(root, named["region"] == root["node"], "left").select(*AXES, F.coalesce("root", "region").alias("region"))
    return vox.select(*AXES).join(core, list(AXES), "left").select(*AXES, F.coalesce("region", F.lit(0).cast("long")).alias("region"))


def margin_of(sigma: float) -> int:
    """The margin at which a block's Gaussian equals that of the whole volume inside."""
    return int(ceil(4 * sigma + 0.5))


def peaks(a: np.ndarray, threshold: float, r: int = 1) -> np.ndarray:
    """Voxels above the threshold and no smaller than any around; of equal neighbours the first."""
    best = np.full(a.shape, -np.inf)
    padded = np.pad(a, r, constant_values=-np.inf)
    for o in np.ndindex(*(2 * r + 1,) * a.ndim):
        if o != (r,) * a.ndim:
            v = padded[tuple(slice(k, k + s) for k, s in zip(o, a.shape))]
            # an equal neighbour that comes earlier wins
            best = np.maximum(best, np.where(o < (r,) * a.ndim, np.nextafter(v, np.inf), v))
    return (a > threshold) & (a >= best)


def normalised(a: np.ndarray, lo: float = 1.0, hi: float = 1.01, ends: tuple[float, float] | None = None) -> np.ndarray:
    """Values brought from ``ends``, their own if not given, to the range from ``lo`` to ``hi``; all equal ones to ``lo``."""
    least, most = ends or (float(a.min()), float(a.max()))
    return lo + (a - least) * ((hi - lo) / (most - least) if most > least else 0.0)


def seeds_of(data: np.ndarray, mask: np.ndarray, spacing: tuple[float, ...], above: float | None = None, dog: tuple[float, float] | None = None, threshold: float | None = None, peak: tuple[int, float] | None = None, flood: float | None = None, ends: tuple[float, float] | None = None) -> np.ndarray:
    """Seeds of objects, step by step as far as each is asked for.

    The distance of a mask to its outside; set to zero ``above`` a bound; times the
    normalised difference of two Gaussians of the data (``dog``, in
    micrometres); cut at ``threshold``, or at its peaks in a window over a least height; components
    of what is left are numbered, and may flood the distance down to ``flood``. In a block the difference is
    normalised by the extremes of the whole volume, ``ends``, so that seeds do not depend on the grid of blocks.
    """
    edt = distance(mask, spacing)
    edt = np.where(np.isfinite(edt), edt, sum(n * s for n, s in zip(mask.shape, spacing)))  # nothing outside: as far as can be
    if above is not None:
        edt = np.where(edt > above, 0, edt)
    if dog:
        one, two = (gaussian(data, tuple(s / v for v in spacing)) for s in dog)
        edt = edt * normalised(one - two, ends=ends)
    on = mask
    if threshold is not None:
        on = edt > threshold
    if peak:
        on = peaks(edt, peak[1], peak[0])
    out = components(on)
    return out if flood is None else watershed(-edt, out, edt > flood)


def difference_ends(vox: DataFrame, full: dict[str, int], size: dict[str, int], dog: tuple[float, float], spacing: tuple[float, ...]) -> tuple[float, float] | None:
    """Least and greatest difference of two Gaussians of a whole volume, from blocks; None without voxels."""
    def kernel(a: np.ndarray) -> np.ndarray:
        one, two = (gaussian(a, tuple(s / v for v in spacing)) for s in dog)
        return one - two

    found = by_block(vox, full, size, margin_of(max(dog) / min(spacing)), kernel, to="difference").agg(F.min("difference"), F.max("difference")).first()
    return None if found[0] is None else (found[0], found[1])


def log_blobs(a: np.ndarray, sigmas: tuple[float, ...], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Blobs as peaks over place and scale of the scale-normalised negative Laplacian of Gaussians: (response at the peaks, 0 elsewhere; sigma there).

    A peak is above the threshold and no smaller than any neighbour in place
    or scale; of equal ones the first in scale, then place, is taken. A blob's radius is its
    sigma times the root of the number of dimensions.
    """
    space = []
    for s in sigmas:
        g = gaussian(a, (s,) * a.ndim)
        wide = np.pad(g, 1, mode="symmetric")
        middle = (slice(1, -1),) * a.ndim
        lap = sum(wide[tuple(slice(1 + d, (-1 + d) or None) if j == k else m for j, m in enumerate(middle))] for k in range(a.ndim) for d in (-1, 1)) - 2 * a.ndim * g
        space.append(-(s**2) * lap)
    on = peaks(np.stack(space), threshold)
    response = np.where(on, np.stack(space), 0).max(axis=0)
    sigma = np.where(on.any(axis=0), np.array(sigmas)[np.where(on, np.stack(space), -np.inf).argmax(axis=0)], 0.0)
    return response, sigma


def seeded(mask: np.ndarray, step: tuple[float, float] = (1.0, 1.0), least: float = 0.5, r: int = 1) -> np.ndarray:
    """Objects of a mask parted at their waists: peaks of the distance to background, flooded downwards; what no peak reaches is an object of its own."""
    d = distance_in_planes(np.pad(mask, [(0, 0), (1, 1), (1, 1)]), *step)[:, 1:-1, 1:-1]
    out = watershed(-d, components(peaks(d, least, r), True), mask)
    alone = components(mask & (out == 0))
    return np.where(alone > 0, out.max(initial=0) + alone, out)
