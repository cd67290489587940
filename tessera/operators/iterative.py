"""Components, hole filling and seam repair over blocks.

Blocks are labelled on their own by a numpy union-find. What touches across
block faces gives a graph of labels, far smaller than the volume, whose
components come from star contraction; one join then carries them back. So
the number of rounds depends on how many blocks an object spans, not on its
diameter in voxels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import components as graph_components
from ..runtime import cut
from ..runtime import numbered as in_order
from ..sources.voxels import dims
from . import kernels
from .blocks import halo_join
from .flood import parted
from .lines import distances
from .stencil import KEY, ball, cross, spread


def _in_blocks(mask: DataFrame, size: dict[str, int], full: bool) -> DataFrame:
    """(z, y, x, id): labels within each block, made distinct by the block's number."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        a, _, at = kernels.dense(rows.assign(on=True), "on", False)
        first = rows.assign(c=kernels.components(a, full)[at])
        # a label is the least voxel number of its component, so no numbering has to be agreed on
        first["id"] = first.groupby("c")["voxel"].transform("min")
        return first[[*KEY, "id"]]

    block = F.struct(*(F.expr(f"{a} div {size[a]}").alias(a) for a in KEY))
    return mask.select(*KEY, "voxel", block.alias("b")).groupBy("b").applyInPandas(run, "z long, y long, x long, id long")


def components(mask: DataFrame, full_size: dict[str, int], block: dict[str, int], full: bool = False, planes: bool = False) -> DataFrame:
    """``mask(z, y, x)`` of true voxels -> ``(z, y, x, component)``, named after its first voxel.

    Faces connect; with ``full`` edges and corners do too; with ``planes``
    only voxels of one plane.
    """
    block = {**block, "z": 1} if planes else block
    number = (F.col("z") * full_size["y"] + F.col("y")) * full_size["x"] + F.col("x")
    return _stitched(cut(_in_blocks(mask.select(*KEY).withColumn("voxel", number), block, full)), block, full, planes)


def _stitched(inner: DataFrame, block: dict[str, int], full: bool = False, planes: bool = False) -> DataFrame:
    """``inner(z, y, x, id)``, the components of each block by their first voxels, joined where they touch across blocks."""
    steps = [o for o in ((dz, dy, dx) for dz in (-1, 0, 1) for dy in (-1, 0, 1) for dx in (-1, 0, 1)) if o > (0, 0, 0) and (full or sum(d != 0 for d in o) == 1) and not (planes and o[0])]
    faces = F.lit(False)
    for a in KEY[planes:]:
        faces = faces | (F.col(a) % block[a] == 0) | (F.col(a) % block[a] == block[a] - 1)
    skin = inner.where(faces)
    meet = spread(skin, [(0, 0, 0), *steps], "id").groupBy(*KEY).agg(F.max(F.when(F.col("own"), F.col("id"))).alias("dst"), F.collect_set("id").alias("near"))
    edges = meet.where("dst is not null").select(F.explode("near").alias("src"), "dst").where("src != dst")
    roots = graph_components(edges)
    return inner.join(roots, inner["id"] == roots["node"], "left").select(*KEY, F.coalesce("root", "id").alias("component"))


def without_small(parts: DataFrame, least: int) -> DataFrame:
    n = parts.groupBy("component").count().where(F.col("count") >= least).select("component")
    return parts.join(n, "component", "left_semi")


def numbered(parts: DataFrame) -> DataFrame:
    """Components numbered from 1 in the order of their first voxels."""
    order = in_order(parts.select("component").distinct(), "label", "component").withColumn("label", F.col("label").cast("int"))
    return parts.join(order, "component").drop("component")


def fill_holes_2d(mask: DataFrame, full_size: dict[str, int], block: dict[str, int], value: str = "mask") -> DataFrame:
    """Holes of each plane filled: background whose component does not reach the plane's border.

    Planes are labelled block by block, so none has to fit into one task.
    """
    back = components(mask.where(~F.col(value)), full_size, block, planes=True)
    edge = (F.col("y") == 0) | (F.col("y") == full_size["y"] - 1) | (F.col("x") == 0) | (F.col("x") == full_size["x"] - 1)
    holes = back.join(back.where(edge).select("component").distinct(), "component", "left_anti").select(*KEY, F.lit(True).alias("_hole"))
    return mask.select(*KEY, value).join(holes, list(KEY), "left").select(*KEY, (F.col(value) | F.coalesce("_hole", F.lit(False))).alias(value))


def zip_touching(labels: DataFrame, seam: str, at: int, least: int = 1) -> DataFrame:
    """Merge labels that touch across a seam in at least so many places: ``(label, merged)``.

    It merges what meets; it does not segment anew.
    """
    others = [k for k in KEY if k != seam]
    a = labels.where((F.col(seam) == at - 1) & (F.col("label") > 0)).select(*others, F.col("label").alias("src"))
    b = labels.where((F.col(seam) == at) & (F.col("label") > 0)).select(*others, F.col("label").alias("dst"))
    edges = a.join(b, others).where("src != dst").groupBy("src", "dst").count().where(F.col("count") >= least).select("src", "dst")
    return graph_components(edges).select(F.col("node").alias("label"), F.col("root").alias("merged"))


def fill_holes(mask: DataFrame, full_size: dict[str, int], block: dict[str, int], value: str = "mask") -> DataFrame:
    """Holes of a volume filled: background whose component, over faces, does not reach the volume's border. Block by block."""
    back = components(mask.where(~F.col(value)), full_size, block)
    edge = F.lit(False)
    for a in KEY:
        edge = edge | (F.col(a) == 0) | (F.col(a) == full_size[a] - 1)
    holes = back.join(back.where(edge).select("component").distinct(), "component", "left_anti").select(*KEY, F.lit(True).alias("_hole"))
    return mask.select(*KEY, value).join(holes, list(KEY), "left").select(*KEY, (F.col(value) | F.coalesce("_hole", F.lit(False))).alias(value))


def fill_label_holes(labels: DataFrame, full_size: dict[str, int], block: dict[str, int]) -> DataFrame:
    """``labels(z, y, x, label)`` with the holes of objects filled, plane by plane: background that touches one label only, and no border."""
    back = cut(components(labels.where("label = 0"), full_size, block, planes=True))
    edge = (F.col("y") == 0) | (F.col("y") == full_size["y"] - 1) | (F.col("x") == 0) | (F.col("x") == full_size["x"] - 1)
    beside = spread(labels.where("label > 0"), [(0, 0, 1), (0, 0, -1), (0, 1, 0), (0, -1, 0)], "label").select(*KEY, "label")
    one = back.join(beside, list(KEY)).groupBy("component").agg(F.min("label").alias("_fill"), F.max("label").alias("_hi")).where("_fill = _hi").drop("_hi")
    holes = back.join(one, "component").join(back.where(edge).select("component").distinct(), "component", "left_anti").select(*KEY, "_fill")
    return labels.select(*KEY, "label").join(holes, list(KEY), "left").select(*KEY, F.coalesce("_fill", "label").alias("label"))


def strips(labels: DataFrame, seam: str, at: int, margin: int, most: int, least: int = 3) -> DataFrame:
    """``(label, n)``: of each label that touches a seam the margins that a strip must have on both sides to hold it whole.

    Strips grow from ``least`` margins to ``most``; what fits into none has no row.
    """
    far = F.greatest(F.max(F.col(seam)) - at + 1, F.lit(at) - F.min(F.col(seam)))
    touches = F.bool_or(F.col(seam).isin(at - 1, at))
    g = labels.where("label > 0").groupBy("label").agg(far.alias("far"), touches.alias("touches")).where("touches")
    return g.select("label", F.greatest(F.ceil(F.col("far") / margin), F.lit(least)).cast("int").alias("n")).where(F.col("n") <= most)


def margins_that_fit(size: dict[str, int], margin: int, cap: int = 10) -> int:
    """How many margins a strip may have on each side in blocks of a size; under 2 a seam is left alone."""
    return min(cap, min(size.values()) // margin) if margin else 0


def zip_watershed(labels: DataFrame, seam: str, at: int, margin: int, most: int = 1, least: int = 1, spacing: tuple[float, float] = (1.0, 1.0), side: int = 64) -> DataFrame:
    """Segment anew what touches a seam: ``(z, y, x, label)`` of the strip of ``most`` margins on both sides.

    Only labels that touch the seam and fit into a strip of ``least`` up to ``most``
    margins as a whole are flagged; their voxels are parted by distance peaks
    and flooding, as ``kernels.seeded`` does, over blocks of at most ``side`` voxels an
    axis, so no task holds a whole seam, nor a whole group of labels that touch each other.
    New labels are negative numbers of the first voxel, so they meet no
    old one and need no running maximum; all other voxels keep theirs.
    """
    full = dims(labels)
    reach = most * margin
    strip = labels.where((F.col(seam) >= at - reach) & (F.col(seam) < at + reach)).select(*KEY, "label")
    flagged = strips(labels, seam, at, margin, most, least).select("label", F.lit(True).alias("flag"))
    # background, one label of many voxels, is never flagged and stays out of the join
    named = strip.where("label > 0").join(flagged, "label", "left").select(*KEY, "label", F.coalesce("flag", F.lit(False)).alias("flag"))
    marked = cut(named.unionByName(strip.where("label <= 0 or label is null").withColumn("flag", F.lit(False))))
    # whatever is not flagged, or not there at all, is background; of it only what touches flagged voxels in the plane can be the nearest
    ring = spread(marked.where("flag").select(*KEY), [o for o in cross() if o[0] == 0]).groupBy(*KEY).agg(F.max("own").alias("mask"))
    depth = distances(ring, {"y": spacing[0], "x": spacing[1]}).withColumnRenamed("distance", "f")
    # a narrow strip is not cut lengthwise
    size = {**dict.fromkeys(KEY, side), seam: full[seam] if 2 * reach <= side else side}
    new = parted(depth, full, size).select(*KEY, (-F.col("region") - 1).alias("label"))
    return marked.where("not flag").select(*KEY, "label").unionByName(new)


def _cores(rows: DataFrame, full: dict[str, int], size: dict[str, int], times: int) -> DataFrame:
    """``rows(z, y, x, on)`` -> (z, y, x, id): what is left of the true ones after erosions by the cross, and its components in each block.

    A voxel may come twice, it is true if it is so once. Neighbours without a row do not count.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("on")
        on, first, _ = kernels.dense(rows, "on", False)
        core = kernels.dense(rows, "is_core", False)[0]
        here = kernels.dense(rows.assign(here=True), "here", False)[0]
        for _ in range(times):
            on = kernels.ranked(on | ~here, cross(), "min")
        on &= core
        z, y, x = (k + lo for k, lo in zip(np.nonzero(on), first))
        number = (z * full["y"] + y) * full["x"] + x
        _, start, which = np.unique(kernels.components(on)[on], return_index=True, return_inverse=True)
        return pd.DataFrame({"z": z, "y": y, "x": x, "id": number[start[which]]})

    return halo_join(rows, full, size, times).groupBy("at_block").applyInPandas(run, "z long, y long, x long, id long")


def _grown(parts: DataFrame, within: DataFrame, full: dict[str, int], size: dict[str, int], reach: float) -> DataFrame:
    """``parts(z, y, x, component)`` grown by ``reach`` into voxels of ``within``, each to the nearest, ties to the smaller name."""
    offsets = ball(reach)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # voxels of parts come twice; their label is the greater
        rows = rows.sort_values("label")
        labels, first, _ = kernels.dense(rows, "label", 0)
        core = kernels.dense(rows, "is_core", False)[0]
        out = kernels.nearest_labels(labels, reach, (1.0, 1.0, 1.0), offsets)
        on = core & (out > 0)
        z, y, x = (k + lo for k, lo in zip(np.nonzero(on), first))
        return pd.DataFrame({"z": z, "y": y, "x": x, "component": out[on] - 1})

    rows = within.select(*KEY, F.lit(0).cast("long").alias("label")).unionByName(parts.select(*KEY, (F.col("component") + 1).alias("label")))
    return halo_join(rows, full, size, int(reach)).groupBy("at_block").applyInPandas(run, "z long, y long, x long, component long")


def split_large(mask: DataFrame, full: dict[str, int], block: dict[str, int], passes: list[tuple[int, float]], least: int = 3, reach: float = 3**0.5, side: int = 64) -> DataFrame:
    """``mask(z, y, x, mask)`` -> (z, y, x, component): components parted where they are thin, one pass after another.

    In each pass components of so many voxels or more are eroded (by the cross, as
    often as the pass says), labelled again, parts under ``least`` voxels
    dropped, and the others grown back by ``reach`` within the old one; new parts are named after
    their first voxel, so they meet no old name. Blocks of fewer than ``side`` voxels along an axis
    are worked on together; erosion and growth see their margins, and no voxel is sent once a neighbour.
    """
    size = {a: n * max(1, side // n) for a, n in block.items()}
    off = F.lit(False).alias("on")
    on = F.lit(True).alias("on")
    parts = cut(_stitched(cut(_cores(mask.where("mask").select(*KEY, on), full, size, 0)), size))
    for large_from, times in passes:
        n = parts.groupBy("component").count().where(F.col("count") >= large_from).select("component", F.lit(True).alias("large"))
        parts = cut(parts.join(n, "component", "left"))
        large, small = parts.where("large"), parts.where("large is null")
        cores = cut(_cores(mask.select(*KEY, off).unionByName(large.select(*KEY, on)), full, size, int(times)))
        split = without_small(cut(_stitched(cores, size)), least)
        parts = cut(_grown(split, large, full, size, reach).unionByName(small.select(*KEY, "component")))
    return parts
