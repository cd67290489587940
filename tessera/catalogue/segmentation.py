"""Kernels on halo blocks and iterative operators."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import iterative, kernels, lines
from ..sources.voxels import dims
from .registry import volume

SIZE = {"z": 4, "y": 10, "x": 10}
BLOCK = {"z": 10, "y": 25, "x": 20}
#: Least voxel number of each component, spread over faces until nothing changes.
CLOSURE = """, p AS (SELECT event_id AS n, z, y, x FROM vox WHERE v > 3000),
 f AS (SELECT a.n AS u, b.n AS w FROM p a JOIN p b ON b.z = a.z AND b.y = a.y AND b.x = a.x + 1 UNION ALL SELECT a.n, b.n FROM p a JOIN p b ON b.z = a.z AND b.y = a.y + 1 AND b.x = a.x UNION ALL SELECT a.n, b.n FROM p a JOIN p b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x),
 e AS (SELECT u, w FROM f UNION ALL SELECT w, u FROM f),
 cc(n, component) USING KEY (n) AS (SELECT n, n FROM p UNION SELECT e.w, min(cc.component) FROM cc JOIN e ON e.u = cc.n JOIN recurring.cc AS old ON old.n = e.w WHERE cc.component < old.component GROUP BY e.w)"""


def _parts(vox: DataFrame) -> DataFrame:
    return iterative.components(vox.where("v > 3000"), dims(vox), SIZE)


@volume(CLOSURE + " SELECT z, y, x, component FROM cc JOIN p USING (n)")
def connected_components(vox: DataFrame) -> DataFrame:
    return _parts(vox)


@volume(CLOSURE + " SELECT component, count(*) AS n FROM cc GROUP BY component HAVING count(*) >= 5")
def small_components_removed(vox: DataFrame) -> DataFrame:
    return iterative.without_small(_parts(vox), 5).groupBy("component").agg(F.count("*").alias("n"))


@volume(CLOSURE + " SELECT label, count(*) AS n FROM (SELECT CAST(dense_rank() OVER (ORDER BY component) AS INTEGER) AS label FROM cc) GROUP BY label")
def components_numbered(vox: DataFrame) -> DataFrame:
    return iterative.numbered(_parts(vox)).groupBy("label").agg(F.count("*").alias("n"))


@volume(""", m AS (SELECT event_id AS n, z, y, x, v > 900 AS mask FROM vox), bg AS (SELECT * FROM m WHERE NOT mask),
 reach AS (SELECT n FROM bg WHERE y = 0 OR y = 24 OR x = 0 OR x = 19 UNION SELECT b.n FROM reach JOIN bg a ON a.n = reach.n JOIN bg b ON a.z = b.z AND abs(a.y - b.y) + abs(a.x - b.x) = 1)
 SELECT z, y, x, mask OR n NOT IN (SELECT n FROM reach) AS mask FROM m""")
def fill_holes(vox: DataFrame) -> DataFrame:
    return iterative.fill_holes_2d(vox.withColumn("mask", F.col("v") > 900), dims(vox), SIZE)


@volume(""", m AS (SELECT event_id AS n, z, y, x, v > 900 AS mask FROM vox), bg AS (SELECT * FROM m WHERE NOT mask),
 reach AS (SELECT n FROM bg WHERE y = 0 OR y = 24 OR x = 0 OR x = 19 OR z = 0 OR z = (SELECT max(z) FROM vox) UNION SELECT b.n FROM reach JOIN bg a ON a.n = reach.n JOIN bg b ON b.z BETWEEN a.z - 1 AND a.z + 1 AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1)
 SELECT z, y, x, mask OR n NOT IN (SELECT n FROM reach) AS mask FROM m""")
def fill_holes_3d(vox: DataFrame) -> DataFrame:
    return iterative.fill_holes(vox.withColumn("mask", F.col("v") > 900), dims(vox), SIZE)


@volume(""", bg AS (SELECT event_id AS n, z, y, x FROM vox WHERE label = 0),
 f AS (SELECT a.n AS u, b.n AS w FROM bg a JOIN bg b ON b.z = a.z AND b.y = a.y AND b.x = a.x + 1 UNION ALL SELECT a.n, b.n FROM bg a JOIN bg b ON b.z = a.z AND b.y = a.y + 1 AND b.x = a.x), e AS (SELECT u, w FROM f UNION ALL SELECT w, u FROM f),
 cc(n, component) USING KEY (n) AS (SELECT n, n FROM bg UNION SELECT e.w, min(cc.component) FROM cc JOIN e ON e.u = cc.n JOIN recurring.cc AS old ON old.n = e.w WHERE cc.component < old.component GROUP BY e.w),
 bd AS (SELECT DISTINCT component FROM cc JOIN bg USING (n) WHERE y = 0 OR y = 24 OR x = 0 OR x = 19),
 nb AS (SELECT component, min(v.label) AS lo, max(v.label) AS hi FROM cc JOIN bg USING (n) JOIN vox v ON v.z = bg.z AND abs(v.y - bg.y) + abs(v.x - bg.x) = 1 AND v.label > 0 GROUP BY component),
 pq AS (SELECT quantile_cont(v, 0.01) AS p0, quantile_cont(v, 0.998) AS p1 FROM vox)
 SELECT vox.z, vox.y, vox.x, CASE WHEN lo = hi AND component NOT IN (SELECT component FROM bd) THEN lo ELSE label END AS label, round(least(greatest((v - p0) / (p1 - p0 + 2.220446049250313e-16), 0.0), 1.0), 6) AS raw FROM vox JOIN pq ON true LEFT JOIN cc ON cc.n = vox.event_id LEFT JOIN nb USING (component)""")
def training_pairs(vox: DataFrame) -> DataFrame:
    """Raw values brought to 0 to 1 by percentiles beside labels whose holes are filled, as pairs for training are taken."""
    labels = iterative.fill_label_holes(vox.select("z", "y", "x", "label"), dims(vox), SIZE)
    ends = vox.agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.998))).alias("p"))
    raw = vox.join(ends).select("z", "y", "x", F.round(maths.stretch(F.col("v"), F.col("p")[0], F.col("p")[1]), 6).alias("raw"))
    return labels.join(raw, ["z", "y", "x"])


@volume(""", t AS (SELECT a.label AS u, b.label AS w FROM vox a JOIN vox b ON a.z = b.z AND a.y = b.y AND b.x = a.x + 1 WHERE a.x = 9 AND a.label > 0 AND b.label > 0 GROUP BY ALL HAVING count(*) >= 8),
 e AS (SELECT u, w FROM t UNION SELECT w, u FROM t), r AS (SELECT u, u AS w FROM e UNION SELECT r.u, e.w FROM r JOIN e ON e.u = r.w) SELECT u AS label, min(w) AS merged FROM r GROUP BY u""")
def zip_touching(vox: DataFrame) -> DataFrame:
    return iterative.zip_touching(vox, "x", 10, 8)


@volume(""", m AS (SELECT z, y, x, v > 900 AS mask FROM vox)
 SELECT a.z, a.y, a.x, round(min(sqrt((2.0 * (a.y - b.y))^2 + (a.x - b.x)^2)), 6) AS distance FROM m a JOIN m b ON a.z = b.z AND NOT b.mask WHERE a.mask GROUP BY ALL""")
def distance_transform(vox: DataFrame) -> DataFrame:
    """In planes, line by line."""
    m = vox.select("z", "y", "x", (F.col("v") > 900).alias("mask"))
    return lines.distances(m, {"y": 2.0, "x": 1.0}).withColumn("distance", F.round("distance", 6))


@volume(""", m AS (SELECT z, y, x, v > 600 AS mask FROM vox), near(dz, dy, dx, d) AS (SELECT i, j, k, sqrt(9.0 * i * i + 4.0 * j * j + k * k) FROM (SELECT unnest(range(-4, 5)) AS i), (SELECT unnest(range(-6, 7)) AS j), (SELECT unnest(range(-12, 13)) AS k) WHERE 9.0 * i * i + 4.0 * j * j + k * k <= 144)
 SELECT a.z, a.y, a.x, round(min(d), 6) AS distance FROM m a, near JOIN m b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx AND NOT b.mask WHERE a.mask GROUP BY ALL""")
def distance_volume(vox: DataFrame) -> DataFrame:
    """Distances to background up to 12 in three directions, voxels being longer along z and y."""
    m = vox.select("z", "y", "x", (F.col("v") > 600).alias("mask"))
    return lines.distances(m, {"z": 3.0, "y": 2.0, "x": 1.0}).where("distance <= 12").withColumn("distance", F.round("distance", 6))


def _weights(sigma: float) -> str:
    w = kernels.gaussian_weights(sigma)
    return ", ".join(f"({k - len(w) // 2}, {float(x)!r}::DOUBLE)" for k, x in enumerate(w))


def mirrored(axis: str, last: str, c: str = "p") -> str:
    """SQL of the place that a coordinate beyond an end stands for: mirrored, the end value included, as often as it takes."""
    period = f"(2 * ({last} + 1))"
    place = f"((({c}.{axis} + k) % {period} + {period}) % {period})"
    return f"least({place}, {period} - 1 - {place})"


def smooth_sql(name: str, sigma: dict[str, float], source: str = "vox", value: str = "v", last: dict[str, str] | None = None) -> str:
    """Common table expressions of a separable Gaussian, one an axis; the last one is called ``name`` with the value ``s``."""
    last = last or {"z": "(SELECT max(z) FROM vox)", "y": "24", "x": "19"}
    out, parts = source, []
    for a, s in sigma.items():
        others = [k for k in "zyx" if k != a]
        here = f"{name}_{a}" if a != list(sigma)[-1] else name
        rows = f"SELECT q.{others[0]}, q.{others[1]}, p.{a}, sum(g * q.{value}) AS s FROM (SELECT DISTINCT {a} FROM vox) p, (VALUES {_weights(s)}) w(k, g) JOIN {out} q ON q.{a} = {mirrored(a, last[a])} GROUP BY ALL"
        parts.append(f"{here} AS ({rows})")
        out, value = here, "s"
    return ", ".join(parts)


@volume(f", {smooth_sql('sm', {'x': 1.0, 'y': 1.0})} SELECT z, y, x, round(s, 4) AS smooth FROM sm")
def gaussian_inplane(vox: DataFrame) -> DataFrame:
    """A Gaussian in planes, line by line."""
    out = vox.select("z", "y", "x", F.col("v").alias("f"))
    for axis in ("x", "y"):
        out = lines.along(out, axis, lambda a: kernels.gaussian(a, (0.0, 1.0)))
    return out.select("z", "y", "x", F.round("f", 4).alias("smooth"))


@volume(f", {smooth_sql('sm', {'x': 0.7, 'y': 0.7, 'z': 0.7})} SELECT z, y, x, round(s, 4) AS out FROM sm")
def gaussian_blocks(vox: DataFrame) -> DataFrame:
    """Over halo blocks; equal to the whole volume's."""
    return kernels.by_block(vox, dims(vox), {"z": 10, "y": 10, "x": 10}, kernels.margin_of(0.7), lambda a: np.round(kernels.gaussian(a, (0.7, 0.7, 0.7)), 4))


@volume(f", {smooth_sql('s1', {'x': 0.5, 'y': 0.5, 'z': 0.5})}, {smooth_sql('s2', {'x': 1.2, 'y': 1.2, 'z': 1.2})} SELECT z, y, x, round(s1.s - s2.s, 3) + 0.0 AS dog FROM s1 JOIN s2 USING (z, y, x)")
def difference_of_gaussians(vox: DataFrame) -> DataFrame:
    return kernels.by_block(vox, dims(vox), {"z": 10, "y": 10, "x": 10}, kernels.margin_of(1.2), lambda a: np.round(kernels.gaussian(a, (0.5,) * 3) - kernels.gaussian(a, (1.2,) * 3), 3) + 0.0, to="dog")


@volume()
def structure_tensor(vox: DataFrame) -> DataFrame:
    """Planarity from the eigenvalues of the structure tensor; a test compares blocks with the whole volume."""
    return kernels.by_block(vox, dims(vox), BLOCK, kernels.margin_of(1.6) + 2, planarity, to="planarity")


def planarity(a: np.ndarray) -> np.ndarray:
    e = kernels.structure_tensor(a, 0.6, 1.0)
    return (e[..., 2] - e[..., 1]) / (e[..., 2] + 1e-12)


def bright_regions(a: np.ndarray) -> np.ndarray:
    return kernels.flooded(a, kernels.components(a > 12000), a > 500, invert=True)


@volume()
def watershed(vox: DataFrame) -> DataFrame:
    """Flooding from bright voxels over blocks with margins, stitched where they overlap; regions have names of their own over all blocks."""
    return kernels.regions_by_block(vox, dims(vox), BLOCK, 3, bright_regions)


@volume(", m AS (SELECT z, y, x, event_id, v > 500 AS mask FROM vox) SELECT z, count(*) FILTER (WHERE mask) AS n_mask FROM m GROUP BY z")
def watershed_stays_in_its_mask(vox: DataFrame) -> DataFrame:
    """Every voxel of the mask belongs to the negative seed's region or another one, and none outside of it."""
    full = dims(vox)
    negative = lambda a: kernels.flooded(a, kernels.components(a > 12000), a > 500, invert=True, negative=a > 600)
    post = lambda a: kernels.flooded(a, np.where(a > 12000, 1, 2), invert=True, post=a > 500)
    regions = kernels.by_block(vox, full, BLOCK, 0, lambda a: np.where(negative(a) > 0, post(a), 0), to="region", kind="long")
    seeds = kernels.by_block(vox, full, BLOCK, 0, post, to="region", kind="long")
    return seeds.join(regions.withColumnRenamed("region", "again"), ["z", "y", "x"]).groupBy("z").agg(F.count_if(F.col("region") > 0).alias("n_mask"))


@volume()
def seeds(vox: DataFrame) -> DataFrame:
    """Seeds as segmentation takes them: distance to background times a difference of Gaussians, its peaks numbered, flooded downhill."""
    spacing = (2.0, 1.0, 1.0)
    ends = kernels.difference_ends(vox, dims(vox), BLOCK, (1.0, 2.0), spacing)
    find = lambda a: kernels.seeds_of(a, a > 900, spacing, above=8.0, dog=(1.0, 2.0), peak=(1, 0.5), flood=0.5, ends=ends)
    return kernels.regions_by_block(vox, dims(vox), BLOCK, kernels.margin_of(2.0), find)


SIGMAS = tuple(float(s) for s in np.linspace(0.8, 1.7, 10))


@volume()
def blobs(vox: DataFrame) -> DataFrame:
    """Blobs with their radii: peaks over place and ten scales of the Laplacian of Gaussians."""
    find = lambda k: lambda a: kernels.log_blobs(a.astype(float), SIGMAS, 1000.0)[k]
    margin = kernels.margin_of(max(SIGMAS)) + 2
    response = kernels.by_block(vox, dims(vox), BLOCK, margin, find(0), to="response").where("response > 0")
    sigma = kernels.by_block(vox, dims(vox), BLOCK, margin, find(1), to="sigma").where("sigma > 0")
    return response.join(sigma, ["z", "y", "x"]).withColumn("radius", F.col("sigma") * math.sqrt(3))


@volume()
def iterative_split(vox: DataFrame) -> DataFrame:
    """Large components eroded, labelled again, grown back, at one size after another."""
    parts = iterative.split_large(vox.select("z", "y", "x", (F.col("v") > 800).alias("mask")), dims(vox), SIZE, [(200, 1), (100, 1)])
    return parts.groupBy("component").agg(F.count("*").alias("n"))
