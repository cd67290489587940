"""Neighbourhoods on sparse voxel tables, by offsets and equi-joins.

A stencil turns each voxel to rows for the voxels that see it, which meet by
key in one grouping with a partial aggregate, so it needs one shuffle and no
join; its cost is the number of offsets. Larger radii go to ``kernels``.
"""

from __future__ import annotations

from itertools import product
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("z", "y", "x")


def square(r: int) -> list[tuple[int, int, int]]:
    return [(0, dy, dx) for dy, dx in product(range(-r, r + 1), repeat=2)]


def disk(r: int) -> list[tuple[int, int, int]]:
    return [o for o in square(r) if o[1] ** 2 + o[2] ** 2 <= r * r]


def cube(r: int) -> list[tuple[int, int, int]]:
    return list(product(range(-r, r + 1), repeat=3))


def ball(r: float) -> list[tuple[int, int, int]]:
    k = int(r)
    return [o for o in product(range(-k, k + 1), repeat=3) if sum(d * d for d in o) <= r * r]


def cross() -> list[tuple[int, int, int]]:
    """The voxel and its six face neighbours."""
    return ball(1)


def ellipsoid(planes: int, diameter: int) -> list[tuple[int, int, int]]:
    """A disk in the centre plane and smaller ones in the planes beside it."""
    out = [(0, dy, dx) for _, dy, dx in disk(diameter // 2)]
    for i in range(1, planes // 2 + 1):
        out += [(s * i, dy, dx) for s in (-1, 1) for _, dy, dx in disk(diameter // (3 + i - 1))]
    return sorted(out)


def odd_extent(micrometres: float, elsize: float) -> int:
    """The voxels that a physical distance reaches to both sides of a voxel, and that voxel: always odd."""
    return 2 * ceil(micrometres / elsize) + 1


def physical(distance: float, elsize: dict[str, float]) -> list[tuple[int, int, int]]:
    """The ellipsoid of a physical distance, of voxels of one size in the plane."""
    return ellipsoid(odd_extent(distance, elsize["z"]), odd_extent(distance, elsize["y"]))


def spread(vox: DataFrame, offsets: list[tuple[int, int, int]], *carry: str) -> DataFrame:
    """A row for each voxel and offset, keyed by the voxel that sees it there."""
    steps = F.array(*(F.struct(*(F.lit(d).cast("long").alias(f"d{a}") for a, d in zip(KEY, o))) for o in offsets))
    out = vox.select(*KEY, *carry, F.explode(steps).alias("o"))
    return out.select(*((F.col(a) - F.col(f"o.d{a}")).alias(a) for a in KEY), *carry, F.expr("o.dz = 0 and o.dy = 0 and o.dx = 0").alias("own"))


def stencil(vox: DataFrame, offsets: list[tuple[int, int, int]], value: str, keep: tuple[str, ...] = (), **aggregates: Column) -> DataFrame:
    """Aggregates over each voxel's neighbourhood; neighbours outside the table do not count.

    The voxel's own columns named by ``keep`` come out of the same grouping.
    """
    near = spread(vox, offsets, *dict.fromkeys((value, *keep)))
    own = [F.max(F.when(F.col("own"), F.col(k))).alias(f"_{k}") for k in keep]
    out = near.groupBy(*KEY).agg(F.max("own").alias("own"), *own, *(c.alias(n) for n, c in aggregates.items()))
    return out.where("own").drop("own").withColumnsRenamed({f"_{k}": k for k in keep})


def erode(vox: DataFrame, offsets: list[tuple[int, int, int]], mask: str = "mask") -> DataFrame:
    """True where all neighbours inside the volume are true."""
    return stencil(vox, offsets, mask, **{mask: F.min(mask)})


def dilate(vox: DataFrame, offsets: list[tuple[int, int, int]], mask: str = "mask") -> DataFrame:
    return stencil(vox, offsets, mask, **{mask: F.max(mask)})


def opening(vox: DataFrame, offsets: list[tuple[int, int, int]], value: str = "v") -> DataFrame:
    """Grey opening: the greatest of the least values around."""
    return stencil(stencil(vox, offsets, value, **{value: F.min(value)}), offsets, value, **{value: F.max(value)})


def local_maxima(vox: DataFrame, offsets: list[tuple[int, int, int]], threshold: float) -> DataFrame:
    """Voxels above the threshold and above all around; of equal ones the first in (z, y, x) is taken."""
    rank = F.struct(F.col("v"), -F.col("z"), -F.col("y"), -F.col("x"))
    ranked = vox.select(*KEY, "v", rank.alias("rank"))
    near = spread(ranked, offsets, "v", "rank").groupBy(*KEY).agg(F.max("rank").alias("top"), F.max(F.when(F.col("own"), F.col("rank"))).alias("mine"))
    return near.where(F.col("mine").isNotNull() & (F.col("top") == F.col("mine")) & (F.col("mine.v") > threshold)).select(*KEY, F.col("mine.v").alias("v"))


def boundaries(vox: DataFrame, offsets: list[tuple[int, int, int]], label: str = "label") -> DataFrame:
    """Voxels of an object that have a neighbour of another object or background."""
    near = spread(vox, offsets, label).groupBy(*KEY).agg(F.min(label).alias("lo"), F.max(label).alias("hi"), F.max(F.when(F.col("own"), F.col(label))).alias(label))
    return near.where(F.col(label).isNotNull() & (F.col(label) > 0)).select(*KEY, label, (F.col("lo") != F.col("hi")).alias("boundary"))


def sauvola(vox: DataFrame, r: int, k: float, dynamic: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """Local threshold m (1 + k (s / R - 1)) over a square in the plane."""
    out = stencil(vox, square(r), "v", ("v", *keep), n=F.count("*"), s1=F.sum("v"), s2=F.sum(F.col("v") * F.col("v")))
    mean = F.col("s1") / F.col("n")
    sd = F.sqrt((F.col("n") * F.col("s2") - F.col("s1") * F.col("s1")) / (F.col("n") * F.col("n").cast("double")))
    return out.select(*KEY, "v", *keep, (mean * (1 + F.lit(k) * (sd / dynamic - 1))).alias("threshold")).withColumn("mask", F.col("v") > F.col("threshold"))


def shift_planes(vox: DataFrame, n: int, value: str = "v") -> DataFrame:
    """Values moved by n planes along z; planes that come free hold zero."""
    w = Window.partitionBy("y", "x").orderBy("z")
    return vox.withColumn(value, F.lag(value, n, 0).over(w) if n >= 0 else F.lead(value, -n, 0).over(w))


def downsample(vox: DataFrame, factors: dict[str, int], how: str = "mean", value: str = "v", by: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of voxels to one: the mean, with blocks at the edge filled up by zeros, or the maximum."""
    keys = [F.expr(f"{a} div {factors[a]}").alias(a) for a in KEY]
    n = factors["z"] * factors["y"] * factors["x"]
    return vox.groupBy(*by, *keys).agg((F.sum(value) / n if how == "mean" else F.max(value)).alias(value))


def upsample(vox: DataFrame, low: DataFrame, factors: dict[str, int], value: str) -> DataFrame:
    """Each voxel with the value of the coarse voxel that it lies in."""
    keyed = vox
    for a in KEY:
        keyed = keyed.withColumn(f"_{a}", F.expr(f"{a} div {factors[a]}"))
    return keyed.join(low.select(*(F.col(a).alias(f"_{a}") for a in KEY), value), [f"_{a}" for a in KEY], "left").drop(*(f"_{a}" for a in KEY))


def expand_labels(vox: DataFrame, r: float, label: str = "label") -> DataFrame:
    """Background within distance r of an object takes the label of the nearest one, ties to the smaller label."""
    steps = [o for o in ball(r)]
    far = F.array(*(F.struct(*(F.lit(d).cast("long").alias(f"d{a}") for a, d in zip(KEY, o)), F.lit(sum(d * d for d in o)).cast("long").alias("d2")) for o in steps))
    seen = vox.where(f"{label} > 0").select(*KEY, label, F.explode(far).alias("o"))
    best = seen.groupBy(*((F.col(a) + F.col(f"o.d{a}")).alias(a) for a in KEY)).agg(F.min(F.struct("o.d2", label)).alias("near"))
    return vox.join(best, list(KEY), "left").withColumn(label, F.when(F.col(label) > 0, F.col(label)).otherwise(F.coalesce(F.col(f"near.{label}"), F.lit(0).cast("long")))).drop("near")


def upsample_linear(low: DataFrame, axis: str, factor: int, value: str = "v") -> DataFrame:
    """Linear interpolation along one axis between the centres of coarse voxels; ends are held.

    Each coarse value goes, weighted, to the fine voxels between its
    neighbours' centres, where two weighted values meet. Axes one after
    another give the trilinear field.
    """
    others = [a for a in KEY if a != axis]
    ends = low.agg(F.max(axis).alias("_last"))
    steps = F.explode(F.sequence(F.col(axis) * factor - factor, F.col(axis) * factor + 2 * factor - 1))
    fine = low.join(ends).select(*others, axis, value, "_last", steps.alias("_f"))
    place = (F.col("_f") + 0.5) / factor - 0.5
    place = F.least(F.greatest(place, F.lit(0.0)), F.col("_last").cast("double"))
    w = 1 - F.abs(place - F.col(axis))
    fine = fine.where((F.col("_f") >= 0) & (F.col("_f") < (F.col("_last") + 1) * factor)).withColumn("_w", w).where("_w > 0")
    return fine.groupBy(*others, F.col("_f").alias(axis)).agg(F.sum(F.col("_w") * F.col(value)).alias(value))


def grid(spark, dims: dict[str, int]) -> DataFrame:
    """All places of a volume; made where they are needed, plane by plane."""
    z = spark.range(dims["z"]).withColumnRenamed("id", "z")
    return z.select("z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(dims["y"] - 1).cast("long"))).alias("y")).select("z", "y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(dims["x"] - 1).cast("long"))).alias("x"))


def resample(vox: DataFrame, dims: dict[str, int], matrix: list[list[float]], value: str = "v", order: int = 0) -> DataFrame:
    """Values at the places that an affine transform sends a new grid to: of the nearest voxel, or (order 1) trilinear; 0 outside.

    Every new voxel asks for one place, or for the eight around it, and meets
    the old ones in one join.
    """
    from ..functions.maths import transformed

    at = grid(vox.sparkSession, dims).select(*KEY, *(c.alias(f"_{a}") for a, c in zip(KEY, transformed(matrix, *KEY))))
    old = vox.select(*(F.col(a).alias(f"_i{a}") for a in KEY), F.col(value).alias("_old"))
    zero = F.lit(0).cast(vox.schema[value].dataType)
    if order == 0:
        asked = at.select(*KEY, *(F.floor(F.col(f"_{a}") + 0.5).alias(f"_i{a}") for a in KEY))
        return asked.join(old, [f"_i{a}" for a in KEY], "left").select(*KEY, F.coalesce("_old", zero).alias(value))
    corners = F.array(*(F.struct(*(F.lit(d).alias(f"d{a}") for a, d in zip(KEY, o))) for o in product((0, 1), repeat=3)))
    asked = at.select(*KEY, *(F.col(f"_{a}") for a in KEY), F.explode(corners).alias("o"))
    part = lambda a: F.col(f"_{a}") - F.floor(f"_{a}")
    weight = F.lit(1.0)
    for a in KEY:
        weight = weight * F.when(F.col(f"o.d{a}") == 1, part(a)).otherwise(1 - part(a))
    asked = asked.select(*KEY, weight.alias("_w"), *((F.floor(f"_{a}") + F.col(f"o.d{a}")).alias(f"_i{a}") for a in KEY))
    met = asked.where("_w > 0").join(old, [f"_i{a}" for a in KEY], "left")
    return met.groupBy(*KEY).agg(F.sum(F.col("_w") * F.coalesce("_old", zero)).alias(value))


def augmented(vox: DataFrame, dims: dict[str, int], order: str = "zyx", flips: str = "", factor: float = 1.0, add: float = 0.0) -> DataFrame:
    """Axes put in another order, some turned around, values scaled and moved: a sample for training out of another one."""
    turned = {a: F.lit(dims[a] - 1) - F.col(a) if a in flips else F.col(a) for a in KEY}
    return vox.withColumns({**{a: turned[b] for a, b in zip(KEY, order)}, "v": F.col("v") * factor + add})


def random_turn(seed: int) -> tuple[str, str]:
    """An order of axes and the axes to turn around, drawn by a seed."""
    from random import Random

    r = Random(seed)
    return "".join(r.sample(KEY, 3)), "".join(a for a in KEY if r.random() < 0.5)


def noise(key: str, sd: float, seed: int = 0) -> Column:
    """Normal noise drawn from a digest of a key, so that it is the same in every run and on every machine."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    part = lambda k: (F.conv(F.substring(digest, k, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return sd * F.sqrt(-2 * F.log(part(1))) * F.cos(2 * 3.141592653589793 * part(9))


def add_noise(vox: DataFrame, key: str, sd: float = 0.001, seed: int = 0, value: str = "v") -> DataFrame:
    """Noise on all voxels that are not 0."""
    return vox.withColumn(value, F.when(F.col(value) != 0, F.col(value) + noise(key, sd, seed)).otherwise(F.col(value).cast("double")))


def low_window(centre: float, high_size: float, high_n: int, low_size: float, low_n: int, margin: float) -> tuple[int, int, int, int]:
    """(start, stop, pad before, pad after) of the window of a coarse axis that holds a fine volume about a centre."""
    extent = high_size * high_n / 2 / low_size + margin
    first, last = int(centre - extent), int(centre + extent)
    return max(0, first), min(low_n, last), max(0, -first), max(0, last - low_n)
