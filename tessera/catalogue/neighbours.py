"""Stencils: medians, morphology, maxima, local thresholds, resampling, distances, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import kernels, stencil
from ..sources.voxels import dims
from .registry import tables, volume

SQ = "d(k) AS (VALUES (-1), (0), (1)), sq AS (SELECT a.k AS dy, b.k AS dx FROM d a, d b), six(dz, dy, dx) AS (VALUES (0,0,0), (1,0,0), (-1,0,0), (0,1,0), (0,-1,0), (0,0,1), (0,0,-1))"
AROUND = "FROM vox a, sq JOIN vox b ON b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx"
BLOCK = {"z": 8, "y": 12, "x": 20}
FACES = "FROM vox a, six JOIN vox b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx"


@volume(f", {SQ} SELECT a.event_id, median(b.v) AS med {AROUND} GROUP BY a.event_id")
def median_inplane(vox: DataFrame) -> DataFrame:
    return stencil.stencil(vox, stencil.square(1), "v", ("event_id",), med=F.median("v")).select("event_id", "med")


@volume(f", {SQ} SELECT a.z, a.y, a.x, median(b.v) AS med {AROUND} GROUP BY ALL")
def median_blocks(vox: DataFrame) -> DataFrame:
    """The same filter as a kernel on halo blocks: voxels are copied for margins only, whatever the window."""
    return kernels.by_block(vox, dims(vox), BLOCK, 1, lambda a: kernels.ranked(a, stencil.square(1), "median"), to="med")


@volume(f", {SQ}, ero AS (SELECT a.z, a.y, a.x, min(b.v) AS v {AROUND} GROUP BY ALL) SELECT a.z, a.y, a.x, max(b.v) AS v FROM ero a, sq JOIN ero b ON b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL")
def opening_blocks(vox: DataFrame) -> DataFrame:
    return kernels.by_block(vox, dims(vox), BLOCK, 2, lambda a: kernels.ranked(kernels.ranked(a, stencil.square(1), "min"), stencil.square(1), "max"), to="v", kind="long")


FOOT = stencil.physical(2.0, {"z": 2.0, "y": 1.0, "x": 1.0})
FOOT_SQL = "foot(dz, dy, dx) AS (VALUES " + ", ".join(str(o) for o in FOOT) + ")"


@volume(f", {FOOT_SQL} SELECT z, count(*) AS n FROM (SELECT a.z, a.event_id, min(b.v) AS m FROM vox a, foot JOIN vox b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL) WHERE m > 60 GROUP BY z")
def erode_physical(vox: DataFrame) -> DataFrame:
    """Erosion by a distance in micrometres, with voxels twice as long along z."""
    out = kernels.by_block(vox.withColumn("on", F.col("v") > 60), dims(vox), BLOCK, 2, lambda a: kernels.ranked(a, FOOT, "min"), value="on", to="mask", kind="boolean")
    return out.where("mask").groupBy("z").agg(F.count("*").alias("n"))


@volume(""", o AS (SELECT a.k AS dz, b.k AS dy, c.k AS dx, round((2.0 * a.k)^2 + b.k^2 + c.k^2, 6) AS d FROM (VALUES (-1), (0), (1)) a(k), (SELECT unnest(range(-2, 3)) AS k) b, (SELECT unnest(range(-2, 3)) AS k) c WHERE (2.0 * a.k)^2 + b.k^2 + c.k^2 <= 6.25),
 n AS (SELECT a.event_id, min(struct_pack(d := d, l := b.label)) AS m FROM vox a, o JOIN vox b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx WHERE b.label > 0 AND a.label = 0 GROUP BY a.event_id)
 SELECT z, y, x, CASE WHEN label > 0 THEN label ELSE coalesce(m.l, 0) END AS label FROM vox LEFT JOIN n USING (event_id)""")
def expand_anisotropic(vox: DataFrame) -> DataFrame:
    """Labels grown by 2.5 micrometres where voxels are twice as long along z."""
    return kernels.by_block(vox, dims(vox), BLOCK, 2, lambda a: kernels.nearest_labels(a, 2.5, (2.0, 1.0, 1.0)), value="label", to="label", kind="long")


@volume(""", o AS (SELECT a.k AS dz, b.k AS dy, c.k AS dx, sqrt((2.0 * a.k)^2 + b.k^2 + c.k^2) AS d FROM (VALUES (-1), (0), (1)) a(k), (SELECT unnest(range(-3, 4)) AS k) b, (SELECT unnest(range(-3, 4)) AS k) c WHERE (2.0 * a.k)^2 + b.k^2 + c.k^2 <= 9)
 SELECT a.z, a.y, a.x, round(least(3.0, coalesce(min(d) FILTER (WHERE b.v <= 900), 3.0)), 6) AS distance FROM vox a, o JOIN vox b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx WHERE a.v > 900 GROUP BY ALL""")
def distance_within(vox: DataFrame) -> DataFrame:
    """Distances in all three directions up to a reach, exact over blocks whose margin is that reach."""
    out = kernels.by_block(vox.withColumn("on", F.col("v") > 900), dims(vox), BLOCK, 3, lambda a: np.round(np.minimum(kernels.distance(a, (2.0, 1.0, 1.0)), 3.0), 6), value="on", to="distance")
    return out.where("distance > 0")


@volume(f", {SQ} SELECT a.z, count(*) AS n FROM (SELECT a.event_id, min(b.v) AS m {FACES} GROUP BY a.event_id) g JOIN vox a USING (event_id) WHERE m > 600 GROUP BY a.z")
def erode(vox: DataFrame) -> DataFrame:
    e = stencil.erode(vox.withColumn("mask", F.col("v") > 600), stencil.cross())
    return e.where("mask").groupBy("z").agg(F.count("*").alias("n"))


@volume(f", {SQ} SELECT a.z, count(*) AS n FROM (SELECT a.event_id, max(b.v) AS m {FACES} GROUP BY a.event_id) g JOIN vox a USING (event_id) WHERE m > 20000 GROUP BY a.z")
def dilate(vox: DataFrame) -> DataFrame:
    e = stencil.dilate(vox.withColumn("mask", F.col("v") > 20000), stencil.cross())
    return e.where("mask").groupBy("z").agg(F.count("*").alias("n"))


@volume(f", {SQ}, ero AS (SELECT a.z, a.y, a.x, min(b.v) AS v {AROUND} GROUP BY ALL) SELECT a.z, a.y, a.x, max(b.v) AS v FROM ero a, sq JOIN ero b ON b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL")
def grey_opening(vox: DataFrame) -> DataFrame:
    return stencil.opening(vox, stencil.square(1))


@volume(f", {SQ} SELECT a.z, a.y, a.x, a.v FROM vox a WHERE a.v > 10000 AND NOT EXISTS (SELECT 1 FROM sq JOIN vox b ON b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx WHERE b.v > a.v OR (b.v = a.v AND (b.y, b.x) < (a.y, a.x)))")
def local_maxima(vox: DataFrame) -> DataFrame:
    return stencil.local_maxima(vox, stencil.square(1), 10000)


@volume(f", {SQ} SELECT label, count(*) FILTER (WHERE b) AS n_boundary, count(*) FILTER (WHERE NOT b) AS n_inner FROM (SELECT a.event_id, a.label, bool_or(b.label <> a.label) AS b {FACES} WHERE a.label > 0 GROUP BY ALL) GROUP BY label")
def label_boundaries(vox: DataFrame) -> DataFrame:
    return stencil.boundaries(vox, stencil.cross()).groupBy("label").agg(F.count_if("boundary").alias("n_boundary"), F.count_if(~F.col("boundary")).alias("n_inner"))


@volume(f""", {SQ}, s AS (SELECT a.event_id, a.v, count(*) AS n, sum(b.v)::BIGINT AS s1, sum(b.v * b.v)::BIGINT AS s2 {AROUND} GROUP BY ALL)
 SELECT event_id, round(s1 / n * (1 + 0.25 * (sqrt((n * s2 - s1 * s1) / (n * n::DOUBLE)) / 5000 - 1)), 4) AS threshold FROM s""")
def sauvola(vox: DataFrame) -> DataFrame:
    return stencil.sauvola(vox, 1, 0.25, 5000.0, ("event_id",)).select("event_id", F.round("threshold", 4).alias("threshold"))


@volume("SELECT event_id, lag(v, 2, 0) OVER (PARTITION BY y, x ORDER BY z) AS v FROM vox")
def shift_planes(vox: DataFrame) -> DataFrame:
    return stencil.shift_planes(vox, 2).select("event_id", "v")


@volume("SELECT b.event_id, coalesce(a.v, 0) AS v FROM vox b LEFT JOIN vox a ON a.y = b.y AND a.x = b.x AND a.z = b.z - b.x % 3")
def shift_columns(vox: DataFrame) -> DataFrame:
    moved = vox.select((F.col("z") + F.col("x") % 3).alias("z"), "y", "x", F.col("v").alias("m"))
    return vox.join(moved, ["z", "y", "x"], "left").select("event_id", F.coalesce("m", F.lit(0).cast("long")).alias("v"))


@volume("SELECT y, x, coalesce(min(z) FILTER (WHERE v > 12000), 0) AS first_z FROM vox GROUP BY y, x")
def first_plane(vox: DataFrame) -> DataFrame:
    return vox.groupBy("y", "x").agg(F.coalesce(F.min(F.when(F.col("v") > 12000, F.col("z"))), F.lit(0).cast("long")).alias("first_z"))


@volume("SELECT z // 2 AS z, y // 4 AS y, x // 3 AS x, round(sum(v) / 24, 6) AS v FROM vox GROUP BY ALL")
def downsample_mean(vox: DataFrame) -> DataFrame:
    return stencil.downsample(vox, {"z": 2, "y": 4, "x": 3}).withColumn("v", F.round("v", 6))


@volume("SELECT z // 2 AS z, y // 4 AS y, x // 3 AS x, max(v > 20000) AS mask FROM vox GROUP BY ALL")
def downsample_mask(vox: DataFrame) -> DataFrame:
    return stencil.downsample(vox.withColumn("mask", F.col("v") > 20000), {"z": 2, "y": 4, "x": 3}, "max", "mask")


@volume(", l AS (SELECT z // 2 AS z, y // 4 AS y, x // 3 AS x, max(v) AS low FROM vox GROUP BY ALL) SELECT event_id, low FROM vox a JOIN l ON l.z = a.z // 2 AND l.y = a.y // 4 AND l.x = a.x // 3")
def upsample_nearest(vox: DataFrame) -> DataFrame:
    f = {"z": 2, "y": 4, "x": 3}
    return stencil.upsample(vox, stencil.downsample(vox, f, "max").withColumnRenamed("v", "low"), f, "low").select("event_id", "low")


@volume(""", o AS (SELECT a.k AS dz, b.k AS dy, c.k AS dx FROM (VALUES (-1), (0), (1)) a(k), (VALUES (-1), (0), (1)) b(k), (VALUES (-1), (0), (1)) c(k) WHERE a.k*a.k + b.k*b.k + c.k*c.k <= 2),
 n AS (SELECT a.event_id, min(struct_pack(d := dz*dz + dy*dy + dx*dx, l := b.label)) AS m FROM vox a, o JOIN vox b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx WHERE b.label > 0 AND a.label = 0 GROUP BY a.event_id)
 SELECT event_id, CASE WHEN label > 0 THEN label ELSE coalesce(m.l, 0) END AS label FROM vox LEFT JOIN n USING (event_id)""")
def expand_labels(vox: DataFrame) -> DataFrame:
    return stencil.expand_labels(vox, 1.5).select("event_id", "label")


@volume(", p(k, v) AS (VALUES (1, 3), (2, 7)) SELECT a.event_id, coalesce(k, 0) AS point FROM vox a LEFT JOIN p ON a.y = k AND a.x = p.v")
def points_to_labels(vox: DataFrame) -> DataFrame:
    p = vox.sparkSession.createDataFrame([(1, 3, 1), (2, 7, 2)], "y long, x long, point int")
    return vox.join(p, ["y", "x"], "left").select("event_id", F.coalesce("point", F.lit(0)).alias("point"))


@tables("SELECT p_partkey, CAST(2 * ceil(p_size / 0.7) + 1 AS BIGINT) AS extent FROM part")
def physical_extent(read) -> DataFrame:
    """Voxels of 0.7 micrometres that a footprint of a size in micrometres spans."""
    return read("part").select("p_partkey", (2 * F.ceil(F.col("p_size") / 0.7) + 1).alias("extent"))


@volume("SELECT a.label AS label_lo, b.label AS label_hi, count(*) AS n FROM vox a JOIN vox b ON a.z = b.z AND a.y = b.y AND b.x = a.x + 1 WHERE a.x = 9 AND a.label > 0 AND b.label > 0 GROUP BY ALL")
def seam_contacts(vox: DataFrame) -> DataFrame:
    a = vox.where("x = 9 and label > 0").select("z", "y", F.col("label").alias("label_lo"))
    b = vox.where("x = 10 and label > 0").select("z", "y", F.col("label").alias("label_hi"))
    return a.join(b, ["z", "y"]).groupBy("label_lo", "label_hi").agg(F.count("*").alias("n"))
