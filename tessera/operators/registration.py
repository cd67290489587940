"""Rigid and affine registration by mutual information.

A step tries many transforms at once: all voxels of the fixed volume, under each of
them, share themselves out between the eight moving voxels around the place that they come
to, block by block, and the sums are the joint histogram of each transform. The histograms, of a
bounded number of bins, come to the driver, which goes to the best transform and halves the step
where none is better. Coarse levels come first. Up to ``alone`` voxels one task
takes all steps.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product
from math import cos, sin

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

AXES = ("z", "y", "x")
ALONE = 2_000_000
#: Voxels, at most, of a block along each axis where a volume is more than one task's: a block has a megabyte.
SIDE = 64
_BLOCK = "kz long, ky long, kx long, first array<long>, shape array<long>, bins binary"
#: First steps of turns (radians), shifts (voxels of the level), logarithms of scales, and shears.
STEPS = np.array([0.08] * 3 + [2.0] * 3 + [0.05] * 3 + [0.05] * 3)


def matrix(p: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The 3 x 4 matrix of up to twelve parameters: turns about z, y, x, shifts, logarithms of scales, shears; all about a centre."""
    p = np.concatenate([p, np.zeros(12 - len(p))])
    turn = np.eye(3)
    for (i, j), angle in zip(((1, 2), (0, 2), (0, 1)), p[:3]):
        one = np.eye(3)
        one[i, i] = one[j, j] = cos(angle)
        one[i, j], one[j, i] = -sin(angle), sin(angle)
        turn = turn @ one
    shear = np.eye(3)
    shear[0, 1], shear[0, 2], shear[1, 2] = p[9:12]
    m = turn @ np.diag(np.exp(p[6:9])) @ shear
    return np.hstack([m, (centre - m @ centre + p[3:6])[:, None]])


def information(joint: np.ndarray) -> float:
    """Mutual information of a joint histogram, in nats; 0 if it is empty."""
    total = joint.sum()
    if not total:
        return 0.0
    p = joint / total
    a, b = p.sum(axis=1, keepdims=True), p.sum(axis=0, keepdims=True)
    on = p > 0
    return float((p[on] * np.log(p[on] / (a @ b)[on])).sum())


def search(scores: Callable[[list[np.ndarray]], list[float]], start: np.ndarray, step: np.ndarray, least: float, rounds: int = 60) -> tuple[np.ndarray, float]:
    """The parameters of best score: steps either way along each of them, and along all that helped at once, halved where none does."""
    best, k = start.copy(), len(start)
    top = scores([best])[0]
    size = 1.0
    for _ in range(rounds):
        if size < least:
            break
        each = [best + s * size * step * np.eye(k)[j] for j in range(k) for s in (1, -1)]
        got = np.array(scores(each))
        gain = got - top
        both = sum(((each[i] - best) for j in range(k) for i in [max((2 * j, 2 * j + 1), key=lambda i: gain[i])] if gain[i] > 1e-9), np.zeros(k))
        lead = int(got.argmax())
        tries = [each[lead], best + both, best + both / 2]
        found = [got[lead], *scores(tries[1:])] if both.any() else [got[lead]]
        at = int(np.argmax(found))
        if found[at] > top + 1e-9:
            best, top = tries[at], found[at]
        else:
            size /= 2
    return best, top


def _bins(v: np.ndarray, lo: float, hi: float, bins: int) -> np.ndarray:
    return np.clip(((v - lo) / ((hi - lo) or 1.0) * bins).astype(np.int64), 0, bins - 1)


def joint_in_one_task(places: np.ndarray, own: np.ndarray, moving: np.ndarray, m: np.ndarray, bins: int) -> np.ndarray:
    """Joint histogram of one transform: ``places`` (n, 3) with their bins, and the bins of a dense moving volume, -1 where it has none."""
    at = np.ascontiguousarray((places @ m[:, :3].T + m[:, 3]).T)
    first = np.floor(at).astype(np.int64)
    rest = at - first
    inside = [[(q >= 0) & (q < n) for q in (f, f + 1)] for f, n in zip(first, moving.shape)]
    # where all places lie on voxels along an axis, the upper ones have no share
    upper = [(0, 1) if r.any() else (0,) for r in rest]
    steps = (moving.shape[1] * moving.shape[2], moving.shape[2], 1)
    flat, out = moving.ravel(), np.zeros(bins * bins)
    for corner in product(*upper):
        ok = np.flatnonzero(np.logical_and.reduce([i[c] for i, c in zip(inside, corner)]))
        if not len(ok):
            continue
        b = flat[sum((f[ok] + c) * s for f, c, s in zip(first, corner, steps))]
        w = np.multiply.reduce([r[ok] if c else 1 - r[ok] for r, c in zip(rest, corner)])
        seen = b >= 0
        out += np.bincount(own[ok][seen] * bins + b[seen], w[seen], bins * bins)
    return out.reshape(bins, bins)


def _corners(at: list[Column]) -> Column:
    """The eight places around one that lies between them, with the share of each."""
    low = [F.floor(a) for a in at]
    out = []
    for corner in product((0, 1), repeat=3):
        w = F.lit(1.0)
        for a, lo, c in zip(at, low, corner):
            w = w * ((a - lo) if c else (1 - (a - lo)))
        out.append(F.struct(*((lo + c).cast("long").alias(f"q{n}") for lo, c, n in zip(low, corner, AXES)), w.alias("w")))
    return F.array(*out)


def _mapped(m: np.ndarray) -> list[Column]:
    return [sum((F.col(a) * float(m[i, j]) for j, a in enumerate(AXES)), F.lit(float(m[i, 3]))) for i in range(3)]


def coarser(voxels: DataFrame, by: int) -> DataFrame:
    """Means of cubes ``by`` voxels wide."""
    if by == 1:
        return voxels.select(*AXES, "v")
    return voxels.groupBy(*(F.floor(F.col(a) / by).cast("long").alias(a) for a in AXES)).agg(F.avg("v").alias("v"))


def _packed(t: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    """Blocks of a volume, a row each: number along each axis, first place, shape, and the bins of the values, -1 where there are none."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at = rows[[*AXES]].to_numpy()
        first = at.min(axis=0)
        out = np.full(at.max(axis=0) - first + 1, -1, np.int32)
        out[tuple((at - first).T)] = _bins(rows["v"].to_numpy(float), lo, hi, bins)
        return pd.DataFrame({**{f"k{a}": [n] for a, n in zip(AXES, key)}, "first": [first.tolist()], "shape": [list(out.shape)], "bins": [out.tobytes()]})

    places = t.select(*(F.col(a).cast("long").alias(a) for a in AXES), F.col("v").cast("double").alias("v"))
    number = [F.floor(F.col(a) / SIDE).cast("long").alias(f"k{a}") for a in AXES]
    return places.groupBy(*number).applyInPandas(run, _BLOCK)


def _unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    return np.array(row.first), np.frombuffer(row.bins, np.int32).reshape(row.shape)


def _meetings(first: np.ndarray, shape: np.ndarray, ms: list[np.ndarray]) -> dict[tuple[int, ...], list[int]]:
    """The blocks that a box comes to, with the transforms that bring it there."""
    out: dict[tuple[int, ...], list[int]] = {}
    corners = first + np.array(list(product((0, 1), repeat=3))) * (shape - 1)
    for k, m in enumerate(ms):
        at = corners @ m[:, :3].T + m[:, 3]
        # the eight voxels around each place; what rounding leaves out has a share of that size
        lo, hi = np.floor(at.min(axis=0)).astype(int) // SIDE, np.ceil(at.max(axis=0)).astype(int) // SIDE
        for block in product(*(range(a, b + 1) for a, b in zip(lo.tolist(), hi.tolist()))):
            out.setdefault(block, []).append(k)
    return out


def _scorer(fixed: DataFrame, moving: DataFrame, ends: list[tuple[float, float]], bins: int) -> Callable[[list[np.ndarray]], list[np.ndarray]]:
    """Joint histograms of several transforms by one pass over pairs of blocks.

    A histogram is a sum over moving voxels, so each pair of a fixed block and a moving
    one that it comes to is counted on its own. Blocks are written once, in four bytes a voxel; a round
    sends each fixed block to the few moving ones around its place, whatever the number of transforms.
    """
    own, other = cut(_packed(fixed, *ends[0], bins)), cut(_packed(moving, *ends[1], bins))
    keys = [f"k{a}" for a in AXES]

    def joints(ms: list[np.ndarray]) -> list[np.ndarray]:
        def sent(frames):
            for f in frames:
                for row in f.itertuples():
                    met = _meetings(np.array(row.first), np.array(row.shape), ms)
                    for at in range(0, len(met), 8):
                        part = list(met.items())[at : at + 8]
                        yield pd.DataFrame({**{n: [b[i] for b, _ in part] for i, n in enumerate(keys)}, "first": [row.first] * len(part), "shape": [row.shape] * len(part), "bins": [row.bins] * len(part), "ks": [k for _, k in part]})

        def count(here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
            out: dict[int, np.ndarray] = {}
            for there_row in there.itertuples():
                lo, dense = _unpacked(there_row)
                for row in here.itertuples():
                    first, own_bins = _unpacked(row)
                    at = np.nonzero(own_bins >= 0)
                    places, i = np.stack(at, axis=1) + first, own_bins[at]
                    for k in row.ks:
                        out[k] = out.get(k, 0) + joint_in_one_task(places, i, dense, np.hstack([ms[k][:, :3], (ms[k][:, 3] - lo)[:, None]]), bins).ravel()
            return pd.DataFrame({"k": pd.Series(list(out), dtype="int32"), "w": pd.Series([w.tolist() for w in out.values()], dtype=object)})

        def added(frames):
            out: dict[int, np.ndarray] = {}
            for f in frames:
                for k, w in zip(f["k"], f["w"]):
                    out[k] = out.get(k, 0) + np.asarray(w)
            for k, w in out.items():
                on = np.flatnonzero(w)
                yield pd.DataFrame({"k": k, "cell": on, "w": w[on]})

        pairs = own.mapInPandas(sent, f"{_BLOCK}, ks array<int>").groupBy(*keys).cogroup(other.groupBy(*keys)).applyInPandas(count, "k int, w array<double>")
        out = [np.zeros(bins * bins) for _ in ms]
        for r in pairs.mapInPandas(added, "k int, cell long, w double").groupBy("k", "cell").agg(F.sum("w").alias("w")).collect():
            out[r["k"]][r["cell"]] = r["w"]
        return [j.reshape(bins, bins) for j in out]

    return joints


def registered(fixed: DataFrame, moving: DataFrame, kind: str = "affine", levels: tuple[int, ...] = (4, 2, 1), bins: int = 32, least: float = 1 / 16, alone: int = ALONE) -> tuple[np.ndarray, float]:
    """The 3 x 4 matrix that takes places (z, y, x) of the fixed volume to those of the moving one, and the mutual information there.

    ``fixed`` and ``moving`` are ``(z, y, x, v)``, a row a voxel; null values take no part. ``kind`` is shift, rigid or affine. A
    transform counts only if it keeps half of the overlap that it began with. An empty volume gives the identity and 0.
    """
    use = {"shift": [3, 4, 5], "rigid": [*range(6)], "affine": [*range(12)]}[kind]
    p, top = np.zeros(12), 0.0
    for level, by in enumerate(levels):
        one, two = (cut(coarser(t.where("v is not null and z is not null and y is not null and x is not null"), by)) for t in (fixed, moving))
        facts = [t.agg(F.count("*"), F.min("v").cast("double"), F.max("v").cast("double"), *(e for a in AXES for e in (F.min(a), F.max(a)))).first() for t in (one, two)]
        if not all(f[0] for f in facts):
            return matrix(np.zeros(12), np.zeros(3)), 0.0
        centre = np.array([(facts[0][3 + 2 * k] + facts[0][4 + 2 * k]) / 2 for k in range(3)], float)
        ends = [(f[1], f[2]) for f in facts]
        if level:
            p[3:6] *= levels[level - 1] / by
        step = STEPS / (1 if level == 0 else 4)

        def climb(joints: Callable[[list[np.ndarray]], list[np.ndarray]], start=p, step=step, centre=centre) -> tuple[np.ndarray, float]:
            whole = []

            def scores(tries: list[np.ndarray]) -> list[float]:
                got = joints([matrix(np.bincount(use, t, 12), centre) for t in tries])
                whole.extend([got[0].sum()] if not whole else [])
                return [information(j) if j.sum() >= 0.5 * whole[0] else -1.0 for j in got]

            found, value = search(scores, start[use], step[use], least)
            return np.bincount(use, found, 12), value

        if facts[0][0] + facts[1][0] <= alone:
            p, top = _climbed_in_one_task(one, two, facts[1], ends, bins, climb)
        else:
            p, top = climb(_scorer(one, two, ends, bins))
    m = matrix(p, centre)
    # from places of the last level to those of voxels, both of which are counted from the middle of a cube
    m[:, 3] = m[:, 3] * levels[-1] + (m[:, :3] @ np.full(3, -1.0) + 1.0) * (levels[-1] - 1) / 2
    return m, top


def _climbed_in_one_task(one: DataFrame, two: DataFrame, facts, ends, bins: int, climb: Callable) -> tuple[np.ndarray, float]:
    lo = np.array([facts[3 + 2 * k] for k in range(3)])
    shape = tuple(int(facts[4 + 2 * k] - facts[3 + 2 * k]) + 1 for k in range(3))

    def run(frames):
        f = pd.concat(list(frames))
        a, b = f[f["side"] == 0], f[f["side"] == 1]
        places, own = a[[*AXES]].to_numpy(float), _bins(a["v"].to_numpy(), *ends[0], bins)
        dense = np.full(shape, -1)
        dense[tuple((b[[*AXES]].to_numpy() - lo).T)] = _bins(b["v"].to_numpy(), *ends[1], bins)

        def joints(ms: list[np.ndarray]) -> list[np.ndarray]:
            return [joint_in_one_task(places, own, dense, np.hstack([m[:, :3], (m[:, 3] - lo)[:, None]]), bins) for m in ms]

        found, value = climb(joints)
        yield pd.DataFrame({"p": [found.tolist()], "top": [value]})

    both = one.select(*(F.col(a).cast("long").alias(a) for a in AXES), F.col("v").cast("double").alias("v"), F.lit(0).alias("side")).unionByName(two.select(*(F.col(a).cast("long").alias(a) for a in AXES), F.col("v").cast("double").alias("v"), F.lit(1).alias("side")))
    r = both.coalesce(1).mapInPandas(run, "p array<double>, top double").first()
    return np.array(r["p"]), r["top"]


def resampled(fixed: DataFrame, moving: DataFrame, m: np.ndarray, order: int = 1, value: str = "v") -> DataFrame:
    """``fixed(z, y, x)`` places with the moving ``value`` that a transform brings there; order 1 for intensities, 0 for labels.

    Places whose neighbours the moving volume has not all got take the mean of those it has; without any they are left out, as
    are empty slices with them.
    """
    other = moving.where(F.col(value).isNotNull()).select(*(F.col(a).cast("long").alias(f"q{a}") for a in AXES), value)
    here = fixed.select(*(F.col(a).cast("long").alias(a) for a in AXES))
    if order == 0:
        near = here.select(*AXES, *(F.floor(c + 0.5).cast("long").alias(f"q{a}") for a, c in zip(AXES, _mapped(m))))
        return near.join(other, [f"q{a}" for a in AXES]).select(*AXES, value)
    spread = here.select(*AXES, F.inline(_corners(_mapped(m)))).where("w > 0")
    met = spread.join(other, [f"q{a}" for a in AXES])
    return met.groupBy(*AXES).agg((F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias(value))
