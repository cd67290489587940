"""Separable transforms line by line: a pass an axis, and no task holds more than lines of one axis.

A pass deals voxels by their line, which is as long as the volume along one
axis, sorts them there, and works on many lines at once with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import edt1

#: Voxels worked on at a time, besides the line at hand.
VOXELS = 500_000


def _by_line(kernel: Callable[[np.ndarray], np.ndarray]):
    """``kernel`` over the lines of batches whose rows are (p, q, at, f) in order; gaps in a line are infinite, which no row gets back."""

    def worked(p: np.ndarray, q: np.ndarray, at: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
        ends = np.append(starts[1:], len(p))
        first, length = at[starts], at[ends - 1] - at[starts] + 1
        out = np.empty(len(f))
        for n in np.unique(length):
            which = np.flatnonzero(length == n)
            step = max(1, VOXELS // int(n))
            for lo in range(0, len(which), step):
                some = which[lo : lo + step]
                row = np.repeat(np.arange(len(some)), ends[some] - starts[some])
                rows = np.concatenate([np.arange(starts[k], ends[k]) for k in some])
                lines = np.full((len(some), n), np.inf)
                place = row, at[rows] - np.repeat(first[some], ends[some] - starts[some])
                lines[place] = f[rows]
                out[rows] = kernel(lines)[place]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (p, q, at, out)], ["p", "q", "at", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            if not len(b):
                continue
            new = [b.column(k).to_numpy() for k in range(4)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) < VOXELS:
                continue
            p, q = held[0], held[1]
            whole = int(np.flatnonzero((p != p[-1]) | (q != q[-1]))[-1]) + 1 if p[0] != p[-1] or q[0] != q[-1] else 0
            if whole:  # the last line may go on in the next batch
                yield worked(*(x[:whole] for x in held))
                held = [x[whole:] for x in held]
        if held is not None:
            yield worked(*held)

    return run


def along(voxels: DataFrame, axis: str, kernel: Callable[[np.ndarray], np.ndarray], value: str = "f") -> DataFrame:
    """``voxels(z, y, x, value)`` with ``kernel`` applied to the array (lines, places along ``axis``) of ``value``.

    A line's places that have no voxel are infinite in the array. Lines of equal length are one array, some at a time.
    """
    p, q = (a for a in "zyx" if a != axis)
    rows = voxels.select(F.col(p).cast("long").alias("p"), F.col(q).cast("long").alias("q"), F.col(axis).cast("long").alias("at"), F.col(value).cast("double").alias("f"))
    dealt = rows.repartition("p", "q").sortWithinPartitions("p", "q", "at")
    out = dealt.mapInArrow(_by_line(kernel), "p long, q long, at long, f double")
    return out.select(*(F.col({p: "p", q: "q", axis: "at"}[a]).alias(a) for a in "zyx"), F.col("f").alias(value))


def distances(voxels: DataFrame, spacing: dict[str, float], mask: str = "mask") -> DataFrame:
    """``voxels(z, y, x, mask)`` -> ``(z, y, x, distance)`` of each true voxel to the nearest false one, along the axes of ``spacing``.

    Exact: squared distances go from axis to axis by lower envelopes. Voxels with none to be near to are left out, so are those whose mask is
    false or null; a null one is near to nothing. An empty table gives no rows.
    """
    known = voxels.where(F.col(mask).isNotNull()).select("z", "y", "x", F.when(F.col(mask), F.lit(float("inf"))).otherwise(0.0).alias("f"))
    for axis in sorted(spacing, key="xyz".index):
        known = along(known, axis, lambda lines, step=float(spacing[axis]): edt1(lines, step))
    return known.where((F.col("f") > 0) & (F.col("f") < float("inf"))).select("z", "y", "x", F.sqrt("f").alias("distance"))
