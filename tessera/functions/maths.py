"""Scalar and aggregate expressions, all built from the engine's own functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_spread(n: Column, ab: Column, a: Column, b: Column) -> Column:
    """``n * ab - a * b`` of sums as a double; products of integer sums are decimals, since they outgrow a long."""
    wide = F.lit(1).cast("decimal(1,0)")
    return (wide * n * ab - wide * a * b).cast("double")


def exact_sum(x: Column) -> Column:
    """The sum of longs as a decimal, from the sums of their upper and lower halves, neither of which outgrows a long."""
    half = lambda c: F.sum(c).cast("decimal(20,0)")
    return half(F.shiftright(x, 32)) * F.lit(1 << 32).cast("decimal(10,0)") + half(x.bitwiseAND(F.lit((1 << 32) - 1)))


def variance(name: str) -> Column:
    """Population variance of an integer column from exact sums."""
    n, x = F.count(name), F.col(name)
    return F.try_divide(exact_spread(n, F.sum(x * x), F.sum(x), F.sum(x)), n * n.cast("double"))


def sd(name: str) -> Column:
    return F.sqrt(variance(name))


def anisotropy(a: Column, b: Column, c: Column) -> Column:
    """Fractional anisotropy of three eigenvalues; null if all are zero."""
    m = (a + b + c) / 3
    return F.try_divide(F.lit(math.sqrt(1.5)) * F.sqrt((a - m) ** 2 + (b - m) ** 2 + (c - m) ** 2), F.sqrt(a * a + b * b + c * c))


def axis_length(eig: Column) -> Column:
    return 4 * F.sqrt(F.greatest(eig, F.lit(0.0)))


def one_digit(x: Column) -> Column:
    """Rounded to one significant digit, halves to even."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.bround(x / p, 0) * p)


def stretch(v: Column, lo: Column, hi: Column) -> Column:
    """Percentile stretch, kept within [0, 1]."""
    return F.least(F.greatest((v - lo) / (hi - lo + 2.220446049250313e-16), F.lit(0.0)), F.lit(1.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def rotation(z: float, y: float, x: float) -> list[list[float]]:
    """Rz Ry Rx from degrees; tiny entries are zero."""
    cz, sz, cy, sy, cx, sx = (f(math.radians(a)) for a in (z, y, x) for f in (math.cos, math.sin))
    rz = [[cz, -sz, 0], [sz, cz, 0], [0, 0, 1]]
    ry = [[cy, 0, sy], [0, 1, 0], [-sy, 0, cy]]
    rx = [[1, 0, 0], [0, cx, -sx], [0, sx, cx]]
    mul = lambda a, b: [[sum(a[i][k] * b[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    return [[0.0 if abs(v) < 1e-12 else v for v in row] for row in mul(mul(rz, ry), rx)]


def affine(translate: tuple[float, float, float], angles: tuple[float, float, float], spacing: tuple[float, float, float]) -> list[list[float]]:
    """The 4 x 4 matrix translation . rotation . scale."""
    r = rotation(*angles)
    return [[r[i][j] * spacing[j] for j in range(3)] + [translate[i]] for i in range(3)] + [[0.0, 0.0, 0.0, 1.0]]


def rodrigues(vector: tuple[Column, Column, Column], axis: tuple[float, float, float], theta: float | Column) -> list[Column]:
    """Vectors (x, y, z) turned by an angle about a unit axis."""
    c, s = F.cos(theta) if isinstance(theta, Column) else F.lit(math.cos(theta)), F.sin(theta) if isinstance(theta, Column) else F.lit(math.sin(theta))
    (x, y, z), (a, b, d) = vector, axis
    cross = (b * z - d * y, d * x - a * z, a * y - b * x)
    dot = a * x + b * y + d * z
    return [v * c + w * s + k * dot * (1 - c) for v, w, k in zip(vector, cross, axis)]


def scaling(elsize: dict[str, float], axes: str = "xyz") -> list[list[float]]:
    """The 4 x 4 matrix that only scales."""
    return [[elsize.get(a, 1.0) if i == j else 0.0 for j in range(4)] if i < 3 else [0.0, 0.0, 0.0, 1.0] for i, a in enumerate((*axes, ""))]


def oriented(elsize: dict[str, float], dims: dict[str, int], angles: dict[str, float]) -> dict[str, list[float]]:
    """Spacing, origin and direction (x, y, z) of a volume turned by angles in radians.

    The origin follows the turn about y and is known for quarter turns; for other angles it is 0.
    """
    size = [elsize.get(a, 1.0) for a in "xyz"]
    extent = [dims.get(a, 1) * s for a, s in zip("xyz", size)]
    y = angles.get("y", 0.0)
    corner = {0.0: [0.0, 0.0, 0.0], math.pi / 2: [extent[2], 0.0, 0.0], math.pi: [extent[0], 0.0, extent[2]], -math.pi / 2: [extent[2], 0.0, extent[0]]}
    turn = rotation(*(math.degrees(angles.get(a, 0.0)) for a in "zyx"))
    return {"spacing": size, "origin": corner.get(y, [0.0, 0.0, 0.0]), "direction": [v for row in turn for v in row]}


def sampling_grid(extents: tuple[float, ...]) -> tuple[list[float], list[int]]:
    """Anisotropy of objects with median extents, and the grid along each axis: 1 where they are over 1.5 times shorter than the longest, else 2."""
    ratio = [max(extents) / e for e in extents]
    return ratio, [1 if r > 1.5 else 2 for r in ratio]


def transformed(matrix: list[list[float]], *coordinates: str) -> list[Column]:
    """Coordinates after an affine transform, as three linear expressions."""
    return [sum((F.lit(m) * F.col(c) for m, c in zip(row, coordinates)), F.lit(row[3])) for row in matrix[:3]]
