"""Bias fields by sharpened histograms and B-splines of growing resolution.

Log intensities are the true ones plus a smooth field, and the field blurs their
histogram. A round takes the histogram of what is left after the field so far, sharpens it
by Wiener deconvolution with a Gaussian, which tells what each intensity is expected to
have been, and adds a B-spline fitted to the differences. Each level doubles the
spans of the spline. A round is two passes over the voxels: both yield partial sums, of as
many numbers as there are bins or control points, so the driver holds the field and never
a voxel. Up to ``alone`` voxels one task makes all rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product
from math import log, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import stored

#: Voxels, at most, that one task fits on its own.
ALONE = 1_000_000
#: Rows worked on at a time.
ROWS = 200_000
AXES = ("z", "y", "x")


def spline(at: np.ndarray, spans: int) -> tuple[np.ndarray, np.ndarray]:
    """Of places from 0 to 1 along an axis: the first of four control points and the weights of all four."""
    t = at * spans
    i = np.clip(np.floor(t).astype(np.int64), 0, spans - 1)
    u = t - i
    return i, np.stack([(1 - u) ** 3, 3 * u**3 - 6 * u**2 + 4, -3 * u**3 + 3 * u**2 + 3 * u + 1, u**3]) / 6


def _corners(places: list[np.ndarray], spans: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number and weight of each of the 64 control points around each place."""
    (i, a), (j, b), (k, c) = (spline(p, s) for p, s in zip(places, spans))
    shape = [s + 3 for s in spans]
    for p, q, r in product(range(4), repeat=3):
        yield ((i + p) * shape[1] + j + q) * shape[2] + k + r, a[p] * b[q] * c[r]


def valued(points: np.ndarray, places: list[np.ndarray], spans: tuple[int, ...]) -> np.ndarray:
    """The spline of some control points at some places."""
    out = np.zeros(len(places[0]))
    for at, w in _corners(places, spans):
        out += w * points[at]
    return out


def fit_sums(places: list[np.ndarray], rest: np.ndarray, spans: tuple[int, ...]) -> np.ndarray:
    """For each control point the two sums whose quotient fits scattered values: what each value would want it to be, and how much it counts."""
    n = int(np.prod([s + 3 for s in spans]))
    square = np.prod([(spline(p, s)[1] ** 2).sum(axis=0) for p, s in zip(places, spans)], axis=0)
    out = np.zeros((2, n))
    for at, w in _corners(places, spans):
        out += np.bincount(at, w**3 * rest / square, n), np.bincount(at, w**2, n)
    return out


def sharpened(counts: np.ndarray, lo: float, hi: float, width: float, noise: float) -> np.ndarray:
    """What each bin's log intensity is expected to have been before a blur of full width ``width`` at half its height."""
    bins, step = len(counts), (hi - lo) / (len(counts) - 1)
    n = 1 << (2 * bins - 1).bit_length()
    lead = (n - bins) // 2
    v = np.zeros(n)
    v[lead : lead + bins] = counts
    sigma = max(width / sqrt(8 * log(2)) / step, 1e-6)
    k = np.minimum(np.arange(n), n - np.arange(n))
    blur = np.exp(-0.5 * (k / sigma) ** 2) / (sigma * sqrt(2 * pi))
    blur = np.fft.fft(blur / blur.sum())
    true = np.clip(np.fft.ifft(np.fft.fft(v) * np.conj(blur) / (np.abs(blur) ** 2 + noise)).real, 0, None)
    place = lo + (np.arange(n) - lead) * step
    top, base = (np.fft.ifft(np.fft.fft(x) * blur).real for x in (true * place, true))
    found = np.where(base > 1e-9 * max(base.max(), 1e-300), top / np.where(base > 0, base, 1), place)
    return found[lead : lead + bins]


def refined(points: np.ndarray, spans: tuple[int, ...]) -> np.ndarray:
    """The control points of the same spline on twice the spans along each axis."""
    c = points.reshape([s + 3 for s in spans])
    for axis in range(c.ndim):
        c = np.moveaxis(c, axis, 0)
        out = np.empty((2 * len(c) - 3, *c.shape[1:]))
        out[::2] = (c[:-1] + c[1:]) / 2
        out[1::2] = (c[:-2] + 6 * c[1:-1] + c[2:]) / 8
        c = np.moveaxis(out, 0, axis)
    return c.ravel()


@dataclass
class Field:
    """A log bias field over a volume of some size: one spline, into which those of all rounds are merged, and the last of these."""

    size: tuple[int, ...]
    spans: tuple[int, ...] = (1, 1, 1)
    points: np.ndarray = field(default_factory=lambda: np.zeros(64))
    last: np.ndarray = field(default_factory=lambda: np.zeros(64))
    rounds: list[float] = field(default_factory=list)

    def places(self, coordinates: list[np.ndarray]) -> list[np.ndarray]:
        return [(np.asarray(c, float) + 0.5) / n for c, n in zip(coordinates, self.size)]

    def at(self, coordinates: list[np.ndarray]) -> np.ndarray:
        return valued(self.points, self.places(coordinates), self.spans)

    def add(self, points: np.ndarray) -> None:
        self.points, self.last = self.points + points, points

    def finer(self) -> None:
        self.points, self.spans = refined(self.points, self.spans), tuple(2 * s for s in self.spans)


def histogram_sums(model: Field, coordinates: list[np.ndarray], v: np.ndarray, lo: float, hi: float, bins: int) -> np.ndarray:
    """Counts of bins, each value shared out between two; then number, sum and sum of squares of the last spline's factors; then least and greatest value."""
    u = v - model.at(coordinates)
    t = np.clip((u - lo) / (hi - lo) * (bins - 1), 0, bins - 1)
    i = np.minimum(t.astype(np.int64), bins - 2)
    counts = np.bincount(i, 1 - (t - i), bins) + np.bincount(i + 1, t - i, bins)
    e = np.exp(valued(model.last, model.places(coordinates), model.spans)) if model.last.any() else np.ones(len(u))
    return np.concatenate([counts, [len(e), e.sum(), (e * e).sum(), u.min(initial=np.inf), u.max(initial=-np.inf)]])


def rest_sums(model: Field, coordinates: list[np.ndarray], v: np.ndarray, lo: float, hi: float, want: np.ndarray) -> np.ndarray:
    u = v - model.at(coordinates)
    expected = np.interp(u, np.linspace(lo, hi, len(want)), want)
    return fit_sums(model.places(coordinates), u - expected, model.spans)


def _rounds(model: Field, lo: float, hi: float, summed: Callable, levels: int, rounds: int, tolerance: float, bins: int, width: float, noise: float) -> Field:
    """All levels; ``summed(f, *parameters)`` adds up what a function of model, coordinates and values yields, extremes kept apart."""
    if not hi > lo:
        return model
    for level in range(levels):
        if level:
            model.finer()
        model.last = np.zeros(len(model.points))
        for turn in range(rounds + 1):
            got = summed(histogram_sums, model, lo, hi, bins)
            n, s, ss, lo_, hi_ = got[bins:]
            if turn:  # how much the last spline varies, relative to its mean
                model.rounds.append(float(np.sqrt(max(ss / n - (s / n) ** 2, 0)) / (s / n)))
                if turn == rounds or model.rounds[-1] < tolerance:
                    break
            if not hi_ > lo_:
                return model
            if (lo_, hi_) != (lo, hi):
                lo, hi = lo_, hi_
                got = summed(histogram_sums, model, lo, hi, bins)
            top, base = summed(rest_sums, model, lo, hi, sharpened(got[:bins], lo, hi, width, noise))
            points = np.divide(top, base, out=np.zeros_like(top), where=base > 0)
            model.add(points)
            # a spline stays between its control points, which bounds what is left without a pass
            lo, hi = lo - float(points.max()), hi - float(points.min())
    return model


def _added(rows: list[np.ndarray], bins: int | None) -> np.ndarray:
    total = np.sum(rows, axis=0)
    if bins is not None:
        total[-2], total[-1] = min(r[-2] for r in rows), max(r[-1] for r in rows)
    return total


def fit(voxels: DataFrame, size: dict[str, int], value: str = "v", levels: int = 4, points: dict[str, int] | None = None, rounds: int = 50, tolerance: float = 1e-3, bins: int = 200, width: float = 0.15, noise: float = 0.01, alone: int = ALONE) -> Field:
    """The log bias field of ``voxels(z, y, x, value)``, over a volume of ``size``; values that are null or not above 0 take no part.

    ``points`` control points an axis, 5 unless given and 4 at least, on the first of ``levels``. Rounds of a level end when the last spline
    varies by less than ``tolerance``. What a mask leaves out is filtered by the caller. Without voxels, or with all alike, the field is 0.
    """
    spans = tuple(max(1, (points or {}).get(a, 5) - 3) for a in AXES)
    extent = tuple(int(size[a]) for a in AXES)
    begin = Field(extent, spans, np.zeros(int(np.prod([k + 3 for k in spans]))))
    logs = stored(voxels.where(F.col(value) > 0).select(*AXES, F.log(F.col(value).cast("double")).alias("l")).where("z is not null and y is not null and x is not null"))
    n, lo, hi = logs.agg(F.count("*"), F.min("l"), F.max("l")).first()
    options = (levels, rounds, tolerance, bins, width, noise)
    if n <= alone:

        def run(frames):
            held = [f for f in frames if len(f)]
            if held:
                f = pd.concat(held)
                where, v = [f[a].to_numpy() for a in AXES], f["l"].to_numpy()

                def summed(work, model, *parameters):
                    parts = [work(model, [c[k : k + ROWS] for c in where], v[k : k + ROWS], *parameters) for k in range(0, len(v), ROWS)]
                    return _added(parts, bins if work.__name__ == "histogram_sums" else None)

                m = _rounds(begin, lo, hi, summed, *options)
                yield pd.DataFrame({"spans": [list(m.spans)], "points": [m.points.tolist()], "rounds": [m.rounds]})

        found = logs.coalesce(1).mapInPandas(run, "spans array<int>, points array<double>, rounds array<double>").first()
        return Field(extent, tuple(found["spans"]), np.array(found["points"]), rounds=list(found["rounds"])) if found else begin

    def summed(work, model, *parameters):
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for b in batches:
                if len(b):
                    rows.append(work(model, [b.column(k).to_numpy() for k in range(3)], b.column(3).to_numpy(), *parameters))
                    rows = [_added(rows, bins if work.__name__ == "histogram_sums" else None)]
            for r in rows:
                yield pa.RecordBatch.from_arrays([pa.array([r.ravel()])], ["sums"])

        # a row a task, of as many numbers as there are bins or control points; added up where they are, by place
        got = logs.mapInArrow(partial, "sums array<double>").select(F.posexplode("sums").alias("k", "x"))
        kept = got.groupBy("k").agg(F.sum("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        out = np.zeros(len(kept))
        for r in kept:
            out[r["k"]] = r["s"]
        if work.__name__ == "histogram_sums":
            out[-2], out[-1] = next(r["lo"] for r in kept if r["k"] == bins + 3), next(r["hi"] for r in kept if r["k"] == bins + 4)
            return out
        return out.reshape(2, -1)

    return _rounds(begin, lo, hi, summed, *options) if n else begin


def biased(voxels: DataFrame, model: Field, size: dict[str, int] | None = None, value: str = "v") -> DataFrame:
    """Voxels with their ``bias`` and ``corrected``, value over bias; at another resolution if ``size`` says so, since the field goes by places from end to end.

    Null values stay null; further columns stay; nothing is shuffled.
    """
    here = Field(tuple(int(size[a]) for a in AXES), model.spans, model.points) if size else model

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bias = np.exp(here.at([b.column(b.schema.get_field_index(a)).to_numpy(zero_copy_only=False) for a in AXES])) if len(b) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bias)], [*b.schema.names, "bias"])

    kept = voxels.drop("bias", "corrected")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(add, f"{schema}, bias double").withColumn("corrected", F.col(value) / F.col("bias"))
