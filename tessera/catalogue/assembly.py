"""Volumes put together from tiles, and brought to one another."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import kernels, registration, tiles
from ..sources.voxels import dims
from .registry import volume

#: True corners (y, x) of four tiles of 16 by 13 voxels, and how far off their nominal ones are.
CORNERS, ERRORS = ((0, 0), (0, 7), (9, 0), (9, 7)), ((0, 0), (1, -2), (-2, 1), (1, 1))


@volume("SELECT z, y, x, v::DOUBLE AS v FROM vox")
def tiles_fused(vox: DataFrame) -> DataFrame:
    """The volume cut into overlapping tiles whose corners are noted down wrongly, its tiles put back by what they show, and fused."""
    spark, full = vox.sparkSession, dims(vox)
    size, cut_out, noted = {"z": full["z"], "y": 16, "x": 13}, None, []
    for k, ((y, x), (ey, ex)) in enumerate(zip(CORNERS, ERRORS)):
        part = vox.where(F.col("y").between(y, y + 15) & F.col("x").between(x, x + 12)).select(F.lit(k).alias("tile"), "z", (F.col("y") - y).alias("y"), (F.col("x") - x).alias("x"), F.col("v").cast("double").alias("v"))
        cut_out = part if cut_out is None else cut_out.unionByName(part)
        noted.append((k, 0, y + ey, x + ex))
    placed = spark.createDataFrame(noted, "tile int, z long, y long, x long")
    found = tiles.links(cut_out, placed, size, {"z": 0, "y": 3, "x": 3})
    back = tiles.fused(cut_out, tiles.positions(spark, found, placed), size)
    return back.select("z", "y", "x", F.round("v", 6).alias("v"))


@volume("SELECT a.z, a.y, a.x, round(b.v::DOUBLE, 4) AS v FROM vox a JOIN vox b ON b.z = a.z AND b.y = a.y AND b.x = a.x WHERE a.y + 2 <= 24 AND a.x - 1 >= 0")
def registered_volume(vox: DataFrame) -> DataFrame:
    """The volume beside an inverted copy that is shifted by two rows and a column: what is smooth in both tells the shift, in whole voxels, and the copy is resampled."""
    fixed = vox.select("z", "y", "x", "v")
    moving = fixed.select("z", (F.col("y") + 2).alias("y"), (F.col("x") - 1).alias("x"), (30000 - F.col("v")).alias("v")).where("y <= 24 and x >= 0")
    one, two = (kernels.by_block(t, dims(vox), {"z": 8, "y": 25, "x": 20}, 8, lambda a: kernels.gaussian(a, (0, 2.0, 2.0)), to="s").select("z", "y", "x", F.col("s").alias("v")) for t in (fixed, moving))
    found, _ = registration.registered(one.where("y between 5 and 19 and x between 5 and 14"), two, "shift", levels=(1,), bins=8, least=1 / 4)
    return registration.resampled(fixed, moving, np.round(found)).select("z", "y", "x", F.round(30000 - F.col("v"), 4).alias("v"))
