"""Scans, block grids, halos, seams, splitting and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naming
from ..operators import blocks
from ..sources.voxels import box, dims
from .registry import volume

SIZE, MARGIN = {"z": 10, "y": 10, "x": 10}, 2
FULL = "dim AS (SELECT max(z) + 1 AS fz, max(y) + 1 AS fy, max(x) + 1 AS fx FROM vox)"


@volume("SELECT x, y, z, v FROM vox WHERE z >= 0 AND z < 2 AND y >= 5 AND y < 15 AND x >= 3 AND x < 17")
def voxel_slice(vox: DataFrame) -> DataFrame:
    return vox.where(box(z=(0, 2), y=(5, 15), x=(3, 17))).select("x", "y", "z", "v")


@volume("SELECT y, x, v FROM vox WHERE c = 4 AND z = 1")
def channel_plane(vox: DataFrame) -> DataFrame:
    return vox.where("c = 4 and z = 1").select("y", "x", "v")


@volume("SELECT c, max(z) + 1 AS nz, max(y) + 1 AS ny, max(x) + 1 AS nx, count(*) AS n, max(v) AS vmax FROM vox GROUP BY c")
def volume_info(vox: DataFrame) -> DataFrame:
    return vox.groupBy("c").agg((F.max("z") + 1).alias("nz"), (F.max("y") + 1).alias("ny"), (F.max("x") + 1).alias("nx"), F.count("*").alias("n"), F.max("v").alias("vmax"))


@volume("SELECT block, min(x) AS x0, min(y) AS y0, min(z) AS z0, block || ';;(' || min(x) || ', ' || min(y) || ', ' || min(z) || ')' AS line FROM vox GROUP BY block")
def tile_offsets(vox: DataFrame) -> DataFrame:
    g = vox.groupBy("block").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.min("z").alias("z0"))
    return g.withColumn("line", F.format_string("%d;;(%d, %d, %d)", "block", "x0", "y0", "z0"))


@volume(f""", {FULL},
 ys AS (SELECT unnest(range(0, fy, 10)) AS y0 FROM dim), zs AS (SELECT unnest(range(0, fz, 10)) AS z0 FROM dim), xs AS (SELECT unnest(range(0, fx, 10)) AS x0 FROM dim)
 SELECT row_number() OVER (ORDER BY y0, z0, x0) - 1 AS block, z0, least(z0 + 10, fz) AS z1, greatest(z0 - 2, 0) AS z_lo, least(z0 + 12, fz) AS z_hi,
  y0, least(y0 + 10, fy) AS y1, greatest(y0 - 2, 0) AS y_lo, least(y0 + 12, fy) AS y_hi, x0, least(x0 + 10, fx) AS x1, greatest(x0 - 2, 0) AS x_lo, least(x0 + 12, fx) AS x_hi
 FROM ys, zs, xs, dim""")
def block_grid(vox: DataFrame) -> DataFrame:
    return blocks.grid_of(vox.agg(*((F.max(a) + 1).alias(a) for a in "zyx")), SIZE, dict.fromkeys("zyx", MARGIN))


@volume(f""", {FULL}, g AS (SELECT unnest(range(0, fy, 10)) AS s, fy FROM dim)
 SELECT CASE WHEN s + 10 > fy THEN greatest(0, fy - 10) ELSE s END AS y0, least(s + 10, fy) AS y1,
  greatest(0, 2 - CASE WHEN s + 10 > fy THEN greatest(0, fy - 10) ELSE s END) AS pad_before, greatest(0, least(s + 10, fy) + 2 - fy) AS pad_after FROM g""")
def block_shift(vox: DataFrame) -> DataFrame:
    full = dims(vox)["y"]
    rows = [(a, z, max(0, -lo), max(0, hi - full)) for a, z, lo, hi in blocks.bounds(full, 10, MARGIN, shift=True, truncate="none")]
    return vox.sparkSession.createDataFrame(rows, "y0 long, y1 long, pad_before long, pad_after long")


GRID = f"""{FULL}, b AS (SELECT z0, y0, x0, (y0 // 10 * ((fz + 9) // 10) + z0 // 10) * ((fx + 9) // 10) + x0 // 10 AS at_block
  FROM dim, (SELECT unnest(range(0, fz, 10)) AS z0 FROM dim), (SELECT unnest(range(0, fy, 10)) AS y0 FROM dim), (SELECT unnest(range(0, fx, 10)) AS x0 FROM dim))"""


@volume(f""", {GRID} SELECT at_block, count(*) AS n, sum(v)::BIGINT AS total,
 count(*) FILTER (WHERE z >= z0 AND z < z0 + 10 AND y >= y0 AND y < y0 + 10 AND x >= x0 AND x < x0 + 10) AS n_core
 FROM vox, b WHERE z >= z0 - 2 AND z < z0 + 12 AND y >= y0 - 2 AND y < y0 + 12 AND x >= x0 - 2 AND x < x0 + 12 GROUP BY at_block""")
def halo_read(vox: DataFrame) -> DataFrame:
    h = blocks.halo_join(vox.select("z", "y", "x", "v"), dims(vox), SIZE, MARGIN)
    return h.groupBy("at_block").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.sum(F.col("is_core").cast("long")).alias("n_core"))


@volume("SELECT z, count(*) AS n, sum(v)::BIGINT AS total, count(DISTINCT (y, x)) AS places FROM vox GROUP BY z")
def core_merge(vox: DataFrame) -> DataFrame:
    whole = blocks.merge(blocks.halo_join(vox.select("z", "y", "x", "v"), dims(vox), SIZE, MARGIN))
    return whole.groupBy("z").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.count_distinct("y", "x").alias("places"))


@volume(""", w(volume, c, w) AS (VALUES ('mean', 0, 1.0), ('mean', 2, 1.0), ('mean', 4, 1.0), ('memb', 3, 0.5), ('memb', 4, 2.0))
 SELECT volume, z // 2 AS z, y // 5 AS y, x // 5 AS x, round(sum(w::DOUBLE * v) / max(n), 6) AS v FROM vox JOIN w USING (c) JOIN (SELECT volume, count(*) AS n FROM w GROUP BY volume) USING (volume)
 GROUP BY ALL""")
def split_weighted(vox: DataFrame) -> DataFrame:
    w = vox.sparkSession.createDataFrame([("mean", 0, 1.0), ("mean", 2, 1.0), ("mean", 4, 1.0), ("memb", 3, 0.5), ("memb", 4, 2.0)], "volume string, c int, w double")
    coarse = vox.select("c", "v", F.expr("z div 2").alias("z"), F.expr("y div 5").alias("y"), F.expr("x div 5").alias("x"))
    return blocks.split_weighted(coarse, w).withColumn("v", F.round("v", 6))


@volume(f""", {GRID} SELECT 1 AS axis, a.y0 // 10 AS seam, a.at_block AS block_lo, b.at_block AS block_hi FROM b a JOIN b ON b.y0 = a.y0 + 10 AND b.z0 = a.z0 AND b.x0 = a.x0
 UNION ALL SELECT 2, a.x0 // 10, a.at_block, b.at_block FROM b a JOIN b ON b.x0 = a.x0 + 10 AND b.z0 = a.z0 AND b.y0 = a.y0
 UNION ALL SELECT 0, a.y0 // 10 * ((fx + 9) // 10 - 1) + a.x0 // 10, a.at_block, b.at_block FROM dim, b a JOIN b ON b.y0 = a.y0 + 10 AND b.x0 = a.x0 + 10 AND b.z0 = a.z0""")
def seam_pairs(vox: DataFrame) -> DataFrame:
    return blocks.seams(vox.sparkSession, dims(vox), SIZE)


@volume(f", {FULL} SELECT ((fz + 9) // 10) * ((fy + 9) // 10) * ((fx + 9) // 10) AS n_blocks FROM dim")
def block_count(vox: DataFrame) -> DataFrame:
    return vox.agg(F.expr("((max(z) + 10) div 10) * ((max(y) + 10) div 10) * ((max(x) + 10) div 10)").alias("n_blocks"))


@volume("SELECT event_id // ((n + 6) // 7) AS part, min(event_id) AS first, max(event_id) + 1 AS stop FROM vox, (SELECT count(*) AS n FROM vox) GROUP BY ALL")
def row_ranges(vox: DataFrame) -> DataFrame:
    n = vox.agg(F.expr("(count(*) + 6) div 7").alias("step"))
    return vox.join(n).groupBy(F.expr("event_id div step").alias("part")).agg(F.min("event_id").alias("first"), (F.max("event_id") + 1).alias("stop"))


@volume("""SELECT block, 'vol_' || lpad(min(x)::VARCHAR, 5, '0') || '-' || lpad((max(x) + 1)::VARCHAR, 5, '0') || '_' || lpad(min(y)::VARCHAR, 5, '0') || '-' || lpad((max(y) + 1)::VARCHAR, 5, '0') || '_' || lpad(min(z)::VARCHAR, 5, '0') || '-' || lpad((max(z) + 1)::VARCHAR, 5, '0') || '.h5' AS name,
 min(x) AS x0, max(x) + 1 AS x1, min(y) AS y0, max(y) + 1 AS y1, min(z) AS z0, max(z) + 1 AS z1 FROM vox GROUP BY block""")
def filename_coordinates(vox: DataFrame) -> DataFrame:
    g = vox.groupBy("block").agg(*(e.alias(a + s) for a in "xyz" for e, s in ((F.min(a), "0"), (F.max(a) + 1, "1"))))
    named = g.select("block", naming.block_name("vol", *(f"{a}{s}" for a in "xyz" for s in "01")).alias("name"))
    return named.select("*", *naming.coordinates("name"))


@volume("""SELECT block, min(x) - 5 AS x0, max(x) + 1 - 5 AS x1, min(y) AS y0, max(y) + 1 AS y1, min(z) + 2 AS z0, max(z) + 1 + 2 AS z1, 'run_00001-00002_vol' AS stem FROM vox GROUP BY block""")
def filename_offsets(vox: DataFrame) -> DataFrame:
    """The last three ranges count although stem and folder hold others, less the block's offset."""
    g = vox.groupBy("block").agg(*(e.alias(a + s) for a in "xyz" for e, s in ((F.min(a), "0"), (F.max(a) + 1, "1"))))
    named = g.select("block", F.concat(F.lit("/data/00009-00010/"), naming.block_name("run_00001-00002_vol", *(f"{a}{s}" for a in "xyz" for s in "01"))).alias("name"))
    return named.select("block", *naming.coordinates("name", (5, 0, -2)), naming.stem("name").alias("stem"))


@volume("SELECT v FROM vox, (SELECT max(z) + 1 AS n FROM vox) WHERE z = n // 2 AND c = 2")
def centre_plane(vox: DataFrame) -> DataFrame:
    return vox.join(vox.agg((F.max("z") + 1).alias("n"))).where("z = n div 2 and c = 2").select("v")


@volume("""SELECT axis, count(*) AS n, sum(v)::BIGINT AS total FROM (
 SELECT 'z' AS axis, v FROM vox, (SELECT max(z) + 1 AS n FROM vox) WHERE z = n // 2 UNION ALL
 SELECT 'y', v FROM vox, (SELECT max(y) + 1 AS n FROM vox) WHERE y = n // 2 UNION ALL
 SELECT 'x', v FROM vox, (SELECT max(x) + 1 AS n FROM vox) WHERE x = n // 2) GROUP BY axis""")
def centre_planes(vox: DataFrame) -> DataFrame:
    n = vox.agg(*((F.max(a) + 1).alias(f"n{a}") for a in "zyx"))
    hit = F.explode(F.filter(F.array(*(F.when(F.expr(f"{a} = n{a} div 2"), F.lit(a)) for a in "zyx")), lambda a: a.isNotNull()))
    return vox.join(n).select("v", hit.alias("axis")).groupBy("axis").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


COLUMNS = ", ".join(f"CAST(max(CASE WHEN x = {k} THEN v END) AS BIGINT) AS x{k}" for k in range(20))


@volume(f"SELECT z, y, {COLUMNS} FROM vox GROUP BY z, y")
def voxel_matrix(vox: DataFrame) -> DataFrame:
    p = vox.groupBy("z", "y").pivot("x", list(range(20))).agg(F.first("v"))
    return p.toDF("z", "y", *(f"x{k}" for k in range(20)))


@volume("SELECT event_id, v FROM vox WHERE block IN (SELECT block FROM vox GROUP BY block HAVING count(*) > 700)")
def parts_with_enough_rows(vox: DataFrame) -> DataFrame:
    enough = vox.groupBy("block").count().where("count > 700").select("block")
    return vox.join(enough, "block", "left_semi").select("event_id", "v")


@volume("SELECT z, 24 - y AS y, 19 - x AS x, v FROM vox UNION ALL SELECT z, y, -1, 0 FROM vox WHERE x = 0")
def pad_and_flip(vox: DataFrame) -> DataFrame:
    flipped = vox.select("z", (24 - F.col("y")).alias("y"), (19 - F.col("x")).alias("x"), "v")
    return flipped.unionByName(vox.where("x = 0").select("z", "y", F.lit(-1).cast("long").alias("x"), F.lit(0).cast("long").alias("v")))


@volume("""SELECT level, count(*) AS n, sum(v)::BIGINT AS total FROM (SELECT unnest([0, 1, 2]) AS level) l JOIN vox ON y % (1 << level) = 0 AND x % (1 << level) = 0 GROUP BY level""")
def pyramid_levels(vox: DataFrame) -> DataFrame:
    level = F.explode(F.filter(F.array(*(F.when(F.expr(f"y % {1 << k} = 0 and x % {1 << k} = 0"), F.lit(k)) for k in range(3))), lambda k: k.isNotNull()))
    return vox.select("v", level.alias("level")).groupBy("level").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@volume("""SELECT event_id, round(0.5::DOUBLE * z - 2.0 * y + 10, 6) AS z2, round(x::DOUBLE, 6) AS x2 FROM vox""")
def linear_transform(vox: DataFrame) -> DataFrame:
    from ..functions.maths import transformed

    m = [[0.5, -2.0, 0.0, 10.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]]
    z, _, x = transformed(m, "z", "y", "x")
    return vox.select("event_id", F.round(z, 6).alias("z2"), F.round(x, 6).alias("x2"))
