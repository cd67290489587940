"""Turning, resampling, augmenting, noise, drawing, and what follows from extents."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import objects, profile, stencil
from ..sources.voxels import dims
from .registry import tables, volume


@volume("SELECT event_id, round(x * cos(0.3::DOUBLE) - y * sin(0.3::DOUBLE), 6) AS x2, round(y * cos(0.3::DOUBLE) + x * sin(0.3::DOUBLE), 6) AS y2, round(z::DOUBLE, 6) AS z2 FROM vox")
def turned_about_an_axis(vox: DataFrame) -> DataFrame:
    x, y, z = maths.rodrigues(tuple(F.col(a).cast("double") for a in "xyz"), (0.0, 0.0, 1.0), 0.3)
    return vox.select("event_id", F.round(x, 6).alias("x2"), F.round(y, 6).alias("y2"), F.round(z, 6).alias("z2"))


@volume("SELECT axis, round(spacing, 6) AS spacing, round(origin, 6) AS origin, scale FROM (SELECT max(z) + 1 AS nz FROM vox), LATERAL (VALUES ('x', 0.5::DOUBLE, nz * 2.0::DOUBLE, 0.5::DOUBLE), ('y', 0.25::DOUBLE, 0.0::DOUBLE, 0.25::DOUBLE), ('z', 2.0::DOUBLE, 0.0::DOUBLE, 2.0::DOUBLE)) t(axis, spacing, origin, scale)")
def oriented_volume(vox: DataFrame) -> DataFrame:
    """Spacing and origin of a volume after a quarter turn about y, and its scaling matrix."""
    size = {"x": 0.5, "y": 0.25, "z": 2.0}
    p, m = maths.oriented(size, dims(vox), {"y": math.pi / 2}), maths.scaling(size)
    rows = [(a, p["spacing"][k], p["origin"][k], m[k][k]) for k, a in enumerate("xyz")]
    return vox.sparkSession.createDataFrame(rows, "axis string, spacing double, origin double, scale double")


SPACED = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.25, 0.0, 0.5], [0.0, 0.0, 2.0, 0.0]]


@volume(""", g AS (SELECT z, y, x FROM (SELECT DISTINCT z FROM vox), (SELECT unnest(range(0, 20)) AS y), (SELECT unnest(range(0, 10)) AS x))
 SELECT g.z, g.y, g.x, coalesce(vox.label, 0) AS label FROM g LEFT JOIN vox ON vox.z = g.z AND vox.y = CAST(floor(1.25 * g.y + 0.5 + 0.5) AS BIGINT) AND vox.x = CAST(floor(2.0 * g.x + 0.5) AS BIGINT)""")
def resample_labels(vox: DataFrame) -> DataFrame:
    """Labels on a grid of another spacing, of the nearest voxel."""
    return stencil.resample(vox, {"z": dims(vox)["z"], "y": 20, "x": 10}, SPACED, "label")


@volume(""", g AS (SELECT z, y, x, 1.25::DOUBLE * y + 0.5 AS py FROM (SELECT DISTINCT z FROM vox), (SELECT unnest(range(0, 20)) AS y), (SELECT unnest(range(0, 10)) AS x))
 SELECT g.z, g.y, g.x, round((1 - (py - floor(py))) * coalesce(a.v, 0) + (py - floor(py)) * coalesce(b.v, 0), 6) AS v FROM g LEFT JOIN vox a ON a.z = g.z AND a.x = 2 * g.x AND a.y = CAST(floor(py) AS BIGINT) LEFT JOIN vox b ON b.z = g.z AND b.x = 2 * g.x AND b.y = CAST(floor(py) AS BIGINT) + 1""")
def resample_values(vox: DataFrame) -> DataFrame:
    """Values on the same grid, trilinear."""
    return stencil.resample(vox, {"z": dims(vox)["z"], "y": 20, "x": 10}, SPACED, "v", 1).withColumn("v", F.round("v", 6))


ORDER, FLIPS = stencil.random_turn(5)
LAST = {"z": "(SELECT max(z) FROM vox)", "y": "24", "x": "19"}
TURNED = ", ".join(f"{LAST[b]} - {b} AS {a}2" if b in FLIPS else f"{b} AS {a}2" for a, b in zip("zyx", ORDER))


@volume(f"SELECT event_id, {TURNED}, round(v * 1.5::DOUBLE + 2, 6) AS v FROM vox")
def augmented_sample(vox: DataFrame) -> DataFrame:
    """Axes in a drawn order, some turned around, values scaled and moved."""
    a = stencil.augmented(vox, dims(vox), ORDER, FLIPS, 1.5, 2.0)
    return a.select("event_id", *(F.col(k).alias(f"{k}2") for k in "zyx"), F.round("v", 6).alias("v"))


@volume(""", d AS (SELECT event_id, v, md5(event_id::VARCHAR || ':3') AS h FROM vox), u AS (SELECT event_id, v, (('0x' || substr(h, 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS a, (('0x' || substr(h, 9, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS b FROM d)
 SELECT event_id, round(CASE WHEN v <> 0 THEN v + 0.5::DOUBLE * sqrt(-2 * ln(a)) * cos(2 * 3.141592653589793::DOUBLE * b) ELSE v END, 6) AS v FROM u""")
def noisy(vox: DataFrame) -> DataFrame:
    return stencil.add_noise(vox, "event_id", 0.5, 3).select("event_id", F.round("v", 6).alias("v"))


@tables("SELECT vec_id FROM embeddings ORDER BY md5(vec_id::VARCHAR || ':1'), vec_id LIMIT 50")
def drawn_rows(read) -> DataFrame:
    """Fifty rows without replacement."""
    return profile.drawn(read("embeddings").select("vec_id"), "vec_id", 50, 1)


@tables("SELECT vec_id, round(m, 6) AS m FROM (SELECT vec_id, embedding[1]::DOUBLE AS m FROM embeddings) WHERE m > (SELECT quantile_cont(embedding[1]::DOUBLE, 0.99) FROM embeddings) ORDER BY md5(vec_id::VARCHAR || ':2'), vec_id LIMIT 1")
def drawn_root(read) -> DataFrame:
    """A row drawn from those above a marker's 0.99 quantile."""
    m = read("embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("m"))
    above = m.join(m.agg(F.percentile("m", 0.99).alias("q"))).where("m > q")
    return profile.drawn(above, "vec_id", 1, 2).select("vec_id", F.round("m", 6).alias("m"))


@volume(""", e AS (SELECT max(z) - min(z) + 1 AS ez, max(y) - min(y) + 1 AS ey, max(x) - min(x) + 1 AS ex FROM vox WHERE label <> 0 GROUP BY label), m AS (SELECT median(ez) AS mz, median(ey) AS my, median(ex) AS mx FROM e)
 SELECT axis, round(greatest(mz, my, mx) / e, 6) AS anisotropy, CASE WHEN greatest(mz, my, mx) / e > 1.5 THEN 1 ELSE 2 END AS grid FROM m, LATERAL (VALUES ('z', mz), ('y', my), ('x', mx)) t(axis, e)""")
def sampling_grid(vox: DataFrame) -> DataFrame:
    """Anisotropy of objects from their median extents, and the sampling grid that follows."""
    r = objects.regions(vox).agg(*(F.median(F.col(f"bbox_{a}1") - F.col(f"bbox_{a}0")).alias(a) for a in "zyx")).first()
    ratio, grid = maths.sampling_grid(tuple(r))
    return vox.sparkSession.createDataFrame([(a, round(q, 6), g) for a, q, g in zip("zyx", ratio, grid)], "axis string, anisotropy double, grid int")


@volume(""", o AS (SELECT block, coalesce(sum(m) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS add FROM (SELECT block, max(label) AS m FROM vox GROUP BY block))
 SELECT label + add AS label, min(y) || ' ' || min(x) || ' ' || max(y) || ' ' || max(x) AS polygon FROM vox JOIN o USING (block) WHERE label <> 0 GROUP BY block, label, add""")
def merged_polygons(vox: DataFrame) -> DataFrame:
    """Outlines of the objects of all blocks, with labels that differ from block to block."""
    p = objects.relabel_blocks(vox).where("label <> 0").groupBy("block", "label").agg(*(f(a).alias(f"{n}{a}") for n, f in (("lo", F.min), ("hi", F.max)) for a in "yx"))
    return p.select("label", F.concat_ws(" ", *(F.col(c).cast("string") for c in ("loy", "lox", "hiy", "hix"))).alias("polygon"))


@tables("SELECT s_suppkey, CAST(greatest(0, trunc(c - e)) AS BIGINT) AS start, CAST(least(50, trunc(c + e)) AS BIGINT) AS stop, CAST(greatest(0, -trunc(c - e)) AS BIGINT) AS pad_lo, CAST(greatest(0, trunc(c + e) - 50) AS BIGINT) AS pad_hi FROM (SELECT s_suppkey, (s_suppkey % 50)::DOUBLE AS c, 0.5::DOUBLE * 40 / 2 / 2.0 + 3 AS e FROM supplier)")
def low_windows(read) -> DataFrame:
    """Windows of a coarse axis of 50 voxels that hold a fine volume, with what has to be padded."""
    spark, ids = read("supplier").sparkSession, read("supplier").select("s_suppkey", (F.col("s_suppkey") % 50).alias("k"))
    windows = [(k, *stencil.low_window(float(k), 0.5, 40, 2.0, 50, 3)) for k in range(50)]
    return ids.join(spark.createDataFrame(windows, "k long, start long, stop long, pad_lo long, pad_hi long"), "k").drop("k")


@tables("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_known FROM embeddings")
def diffusion_time(read) -> DataFrame:
    """Diffusion pseudotime along the neighbour graph; every node has one, from 0 at the root to 1."""
    v = read("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    n = profile.knn(v, 5)
    t = profile.diffusion_pseudotime(n.select(F.col("id").alias("src"), F.col("other").alias("dst")), 0, 3)
    return t.agg(F.count("*").alias("n"), F.count_if(F.col("time").between(0, 1)).alias("n_known"))
