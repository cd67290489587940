"""Block grids with margins, halo reads, seams, splitting and merging."""

from __future__ import annotations

from itertools import product
from math import prod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


def bounds(full: int, size: int, margin: int = 0, shift: bool = False, truncate: str = "dataset") -> list[tuple[int, int, int, int]]:
    """(core start, core stop, start, stop with margin) of each block along one axis.

    ``shift`` moves a last block that would stick out inwards; ``truncate``
    clips to the dataset, to the dataset with its margin, or not at all.
    """
    out = []
    for start in range(0, full, size):
        stop = start + size
        if shift and stop > full:
            start, stop = max(0, full - size), full
        low, high = start - margin, stop + margin
        if truncate == "dataset":
            stop, low, high = min(stop, full), max(0, low), min(full, high)
        elif truncate == "margin":
            stop, low, high = min(stop, full), max(-margin, low), min(full + margin, high)
        out.append((start, stop, low, high))
    return out


def grid(spark: SparkSession, full: dict[str, int], size: dict[str, int], margin: dict[str, int], shift: bool = False, truncate: str = "dataset") -> DataFrame:
    """The ``blocks`` table, in the order y, z, x, slowest first; a row a block, so it is as small as the grid."""
    each = {a: bounds(full[a], size[a], margin.get(a, 0), shift, truncate) for a in AXES}
    rows = []
    for k, (y, z, x) in enumerate(product(each["y"], each["z"], each["x"])):
        of = {"z": z, "y": y, "x": x}
        rows.append((k, f"B{k:05d}", *(b for a in AXES for b in of[a])))
    names = ", ".join(f"{a}0 long, {a}1 long, {a}_lo long, {a}_hi long" for a in AXES)
    return spark.createDataFrame(rows, f"block int, id string, {names}")


def grid_of(dims: DataFrame, size: dict[str, int], margin: dict[str, int]) -> DataFrame:
    """The same grid from a one-row table of extents (z, y, x), without a row to the driver."""
    out = dims
    for a in AXES:
        out = out.withColumn(f"{a}0", F.explode(F.sequence(F.lit(0).cast("long"), F.col(a) - 1, F.lit(size[a]).cast("long"))))
    for a in AXES:
        m = margin.get(a, 0)
        out = out.withColumn(f"{a}1", F.least(F.col(f"{a}0") + size[a], F.col(a)))
        out = out.withColumn(f"{a}_lo", F.greatest(F.col(f"{a}0") - m, F.lit(0).cast("long"))).withColumn(f"{a}_hi", F.least(F.col(f"{a}0") + size[a] + m, F.col(a)))
    count = lambda a: F.expr(f"ceil({a} / {size[a]})").cast("long")
    at = lambda a: F.expr(f"{a}0 div {size[a]}")
    number = (at("y") * count("z") + at("z")) * count("x") + at("x")
    return out.select(number.alias("block"), *(f"{a}{k}" for a in AXES for k in ("0", "1", "_lo", "_hi")))


def halo_join(vox: DataFrame, full: dict[str, int], size: dict[str, int], margin: int) -> DataFrame:
    """Each voxel once for every block whose box with margin holds it, with ``at_block`` and ``is_core``.

    The range condition becomes arithmetic: along an axis only the blocks of
    ``coordinate - margin`` up to ``coordinate + margin`` qualify, so a voxel
    is copied to the few candidates without a join, and no shuffle happens.
    Keep blocks much larger than margins: that is what bounds the copies.
    """
    out = vox
    for a in AXES:
        last = max(0, -(-full[a] // size[a]) - 1)
        lo = F.greatest(F.expr(f"({a} - {margin}) div {size[a]}"), F.lit(0).cast("long"))
        hi = F.least(F.expr(f"({a} + {margin}) div {size[a]}"), F.lit(last).cast("long"))
        out = out.withColumn(f"_{a}", F.explode(F.sequence(lo, hi)))
    n = {a: -(-full[a] // size[a]) for a in AXES}
    core = F.lit(True)
    for a in AXES:
        core = core & (F.col(f"_{a}") == F.expr(f"{a} div {size[a]}"))
    number = (F.col("_y") * n["z"] + F.col("_z")) * n["x"] + F.col("_x")
    return out.withColumn("at_block", number).withColumn("is_core", core).drop(*(f"_{a}" for a in AXES))


def merge(haloed: DataFrame) -> DataFrame:
    """Cores tile the volume exactly, so merging is dropping the margins."""
    return haloed.where("is_core").drop("is_core")


def count(full: dict[str, int], size: dict[str, int]) -> int:
    return prod(-(-full[a] // size[a]) for a in AXES)


def seams(spark: SparkSession, full: dict[str, int], size: dict[str, int]) -> DataFrame:
    """(axis, seam, line, block_lo, block_hi): neighbouring blocks along y and x; and the quads (axis 0) by their first block."""
    n = {a: -(-full[a] // size[a]) for a in AXES}
    of = lambda z, y, x: (y * n["z"] + z) * n["x"] + x
    rows = []
    for z, y, x in product(range(n["z"]), range(n["y"]), range(n["x"])):
        if y + 1 < n["y"]:
            rows.append((1, y, of(z, y, x), of(z, y + 1, x)))
        if x + 1 < n["x"]:
            rows.append((2, x, of(z, y, x), of(z, y, x + 1)))
        if y + 1 < n["y"] and x + 1 < n["x"]:
            rows.append((0, y * (n["x"] - 1) + x, of(z, y, x), of(z, y + 1, x + 1)))
    return spark.createDataFrame(rows, "axis int, seam long, block_lo long, block_hi long")


def split_weighted(vox: DataFrame, weights: DataFrame, by: tuple[str, ...] = ("z", "y", "x")) -> DataFrame:
    """Output volumes as weighted sums of channels over the number of channels.

    ``weights(volume, c, w)`` is a small table by design and is broadcast by
    the planner where it is under its limit.
    """
    n = weights.groupBy("volume").agg(F.count("*").alias("n"))
    joined = vox.join(weights.join(n, "volume"), "c")
    return joined.groupBy("volume", *by).agg((F.sum(F.col("w") * F.col("v")) / F.first("n")).alias("v"))
