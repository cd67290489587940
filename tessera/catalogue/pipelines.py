"""Whole dataflows: the configured step runner, registered columns, stacked volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import objects
from ..plans import steps
from ..sources import sinks
from .registry import volume


@steps.column("elongation")
def elongation(features: DataFrame) -> DataFrame:
    return features.withColumn("elongation", (F.col("bbox_z1") - F.col("bbox_z0")).cast("double") / (F.col("bbox_x1") - F.col("bbox_x0")))


@volume("SELECT label, area, round((z1 - z0)::DOUBLE / (x1 - x0), 6) AS elongation FROM (SELECT label, count(*) AS area, min(z) AS z0, max(z) + 1 AS z1, min(x) AS x0, max(x) + 1 AS x1 FROM vox WHERE label <> 0 GROUP BY label)")
def user_columns(vox: DataFrame) -> DataFrame:
    f = steps.with_columns(objects.regions(vox), ["elongation"])
    return f.select("label", "area", F.round("elongation", 6).alias("elongation"))


@volume(""", m AS (SELECT z, y, x, v > 900 AS a, NOT v > 20000 AS b FROM vox) SELECT z, count(*) FILTER (WHERE a AND b) AS n FROM m GROUP BY z""")
def step_masks(vox: DataFrame) -> DataFrame:
    out = steps.run({"mean": vox}, {"mask_nucl": {"input": "mean", "threshold": 900}, "mask_memb": {"input": "mean", "threshold": 20000}, "combine_seeds": {"inputs": ["mask_nucl", "~mask_memb"]}})
    return out["combine_seeds"].groupBy("z").agg(F.count_if("mask").alias("n"))


@volume("SELECT label, count(*) AS n FROM vox WHERE label IN (SELECT label FROM vox WHERE label <> 0 GROUP BY label HAVING count(*) BETWEEN 50 AND 90) AND label NOT IN (SELECT label FROM vox WHERE y = 0 OR y = 24) GROUP BY label")
def step_filters(vox: DataFrame) -> DataFrame:
    out = steps.run({"labels": vox}, {"filter_labels": {"input": "labels", "min_size": 50, "max_size": 90, "border": {"y": (0, 25)}}})
    return out["filter_labels"].where("label <> 0").groupBy("label").agg(F.count("*").alias("n"))


@volume("SELECT volume, count(*) AS n, sum(v)::BIGINT AS total FROM (SELECT 'data' AS volume, v FROM vox WHERE c = 4 UNION ALL SELECT 'zero', 0 FROM vox WHERE c = 2 UNION ALL SELECT 'half', v // 2 FROM vox WHERE c = 4) GROUP BY volume")
def stacked_volumes(vox: DataFrame) -> DataFrame:
    four = vox.where("c = 4").select("z", "y", "x", "v")
    s = sinks.stacked({"data": four, "zero": sinks.template(vox.where("c = 2").select("z", "y", "x", "v")), "half": four.withColumn("v", F.expr("v div 2"))})
    return s.groupBy("volume").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@volume("SELECT c, count(*) AS n, sum(v)::BIGINT AS total FROM (SELECT CASE WHEN c = 4 THEN 0 ELSE 1 END AS c, v FROM vox WHERE c IN (4, 2)) GROUP BY c")
def channel_subset(vox: DataFrame) -> DataFrame:
    return sinks.channels(vox, [4, 2]).groupBy("c").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


FLOW = """
prep_median: {input: vox, filter: {type: median, sigma: 3, blocksize: {z: 8, y: 12, x: 20}}}
mask_bright: {input: prep_median, threshold: 3000}
mask_raw: {input: vox, threshold: 200}
combine_both: {inputs: [mask_bright, mask_raw]}
"""


@volume(""", d(k) AS (VALUES (-1), (0), (1)), m AS (SELECT a.event_id, median(b.v) AS med FROM vox a, d p, d q JOIN vox b ON b.z = a.z AND b.y = a.y + p.k AND b.x = a.x + q.k GROUP BY a.event_id)
 SELECT z, count(*) FILTER (WHERE med > 3000 AND v > 200) AS n FROM vox JOIN m USING (event_id) GROUP BY z""")
def step_file(vox: DataFrame) -> DataFrame:
    """Steps from a YAML text: a median, two masks, and what both hold."""
    out = steps.run_file({"vox": vox.select("z", "y", "x", "v")}, FLOW)["combine_both"]
    return out.groupBy("z").agg(F.count_if("mask").alias("n"))


SEGMENTS = """
mask_cells: {input: vox, threshold: 900}
seed_cells: {input: vox, mask: mask_cells, threshold: 0.5, blocksize: {z: 10, y: 25, x: 20}, blockmargin: 3}
segment_cells: {input: vox, seeds: seed_cells, mask: mask_cells, invert: true, blocksize: {z: 10, y: 25, x: 20}, blockmargin: 3}
filter_cells: {input: segment_cells, min_size: 1}
"""


@volume("SELECT z, count(*) FILTER (WHERE v > 900) AS n FROM vox GROUP BY z")
def step_segments(vox: DataFrame) -> DataFrame:
    """A whole segmentation by steps: mask, seeds, flooding, filter. Every voxel of the mask ends up with a label."""
    out = steps.run_file({"vox": vox.select("z", "y", "x", "v")}, SEGMENTS)["filter_cells"]
    return out.groupBy("z").agg(F.count_if(F.col("label") > 0).alias("n"))


@steps.aggregate("spread")
def _spread():
    return F.max("v") - F.min("v")


@volume("SELECT label, max(v) - min(v) AS spread FROM vox WHERE label <> 0 GROUP BY label")
def user_aggregates(vox: DataFrame) -> DataFrame:
    """An aggregate that a user has registered by name."""
    return steps.with_aggregates(vox, ["spread"])
