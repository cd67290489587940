"""Feature tables by named sets and compartments, resampling, and further label work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import blocks, features, iterative, kernels, objects, profile, stencil
from ..sources.voxels import box, dims
from .labels import INERTIA, REG
from .registry import tables, volume
from .segmentation import smooth_sql

BLOCK = {"z": 10, "y": 25, "x": 20}


def _plain(df: DataFrame, digits: int = 5) -> DataFrame:
    """Names without dashes and doubles rounded."""
    df = df.toDF(*(c.replace("-", "_") for c in df.columns))
    return df.withColumns({c: F.round(c, digits) for c, k in df.dtypes if k == "double"})


@volume("SELECT label, count(*) AS area, round(avg(z), 5) AS centroid_0, round(avg(y), 5) AS centroid_1, round(avg(x), 5) AS centroid_2 FROM vox WHERE label <> 0 GROUP BY label")
def feature_set_minimal(vox: DataFrame) -> DataFrame:
    return _plain(features.morphology(vox, "minimal"))


MOMENTS = ", ".join(f"sum(CAST(pow(z, {i}) AS BIGINT) * CAST(pow(y, {j}) AS BIGINT) * CAST(pow(x, {k}) AS BIGINT))::BIGINT AS moments_{16 * i + 4 * j + k}" for i in range(4) for j in range(4) for k in range(4))
MAXIMAL = f"""{INERTIA}, {REG}, dd(d) AS (VALUES (-1), (0), (1)), cells AS (SELECT DISTINCT label, 2*z+a.d AS z, 2*y+b.d AS y, 2*x+c.d AS x, CASE WHEN (abs(a.d)+abs(b.d)+abs(c.d)) % 2 = 1 THEN 1 ELSE -1 END AS s FROM vox, dd a, dd b, dd c WHERE label <> 0),
 eu AS (SELECT label, sum(s)::BIGINT AS euler_number FROM cells GROUP BY label), mo AS (SELECT label, {MOMENTS} FROM vox WHERE label <> 0 GROUP BY label), ei AS (SELECT label, greatest(eig0, 0) AS e0, greatest(eig1, 0) AS e1, greatest(eig2, 0) AS e2, (greatest(eig0, 0) + greatest(eig1, 0) + greatest(eig2, 0)) / 3 AS em FROM eig)
 SELECT label, area, bbox_z0 AS bbox_0, bbox_y0 AS bbox_1, bbox_x0 AS bbox_2, bbox_z1 AS bbox_3, bbox_y1 AS bbox_4, bbox_x1 AS bbox_5, round(centroid_z, 5) AS centroid_0, round(centroid_y, 5) AS centroid_1, round(centroid_x, 5) AS centroid_2,
 round(pow(6 * area / 3.141592653589793, 1.0 / 3), 5) AS equivalent_diameter, round(area / ((bbox_z1 - bbox_z0) * (bbox_y1 - bbox_y0) * (bbox_x1 - bbox_x0)), 5) AS extent, euler_number, mo.* EXCLUDE (label),
 round(e0, 5) AS inertia_tensor_eigvals_0, round(e1, 5) AS inertia_tensor_eigvals_1, round(e2, 5) AS inertia_tensor_eigvals_2, round(4 * sqrt(e0), 5) AS major_axis_length, round(4 * sqrt(e2), 5) AS minor_axis_length,
 round(sqrt(1.5) * sqrt((e0 - em)^2 + (e1 - em)^2 + (e2 - em)^2) / nullif(sqrt(e0 * e0 + e1 * e1 + e2 * e2), 0), 5) AS fractional_anisotropy FROM reg JOIN ei USING (label) JOIN eu USING (label) JOIN mo USING (label)"""


@volume(MAXIMAL)
def feature_set_maximal(vox: DataFrame) -> DataFrame:
    return _plain(features.morphology(vox, "maximal"))


@volume(""", b AS (SELECT DISTINCT label FROM vox WHERE label <> 0 AND (y = 0 OR y = 24)), f AS (SELECT label, count(*) AS area_full, round(avg(z), 5) AS centroid_0_full, round(avg(y), 5) AS centroid_1_full, round(avg(x), 5) AS centroid_2_full, round(avg(v), 5) AS mean_intensity_full FROM vox WHERE label <> 0 GROUP BY label),
 n AS (SELECT label, count(*) AS area_nucl, round(avg(z), 5) AS centroid_0_nucl, round(avg(y), 5) AS centroid_1_nucl, round(avg(x), 5) AS centroid_2_nucl, round(avg(v), 5) AS mean_intensity_nucl FROM vox WHERE label <> 0 AND v < 3000 GROUP BY label)
 SELECT * FROM f JOIN n USING (label) WHERE label NOT IN (SELECT label FROM b) AND area_full BETWEEN 60 AND 95""")
def cell_table(vox: DataFrame) -> DataFrame:
    return _plain(features.cells(vox, {"full": "true", "nucl": "v < 3000"}, {"y": (0, 25)}, {"area_full": (60, 95)}))


@volume("SELECT label, centroid_0_full, area_full FROM (SELECT label, round(avg(z), 5) AS centroid_0_full, count(*) AS area_full FROM vox WHERE label <> 0 GROUP BY label)")
def feature_columns(vox: DataFrame) -> DataFrame:
    m = features.with_suffix(features.select_columns(features.morphology(vox, "minimal"), ["area", "centroid"]), "full")
    return _plain(m).select("label", "centroid_0_full", "area_full")


@volume("SELECT event_id, z < 2 AND y >= 5 AND y < 15 AND x >= 3 AND x < 17 AS inside FROM vox")
def inside_box(vox: DataFrame) -> DataFrame:
    return vox.select("event_id", box(z=(0, 2), y=(5, 15), x=(3, 17)).alias("inside"))


@volume("SELECT a.event_id, coalesce(m.v > 20000, false) AS masked FROM vox a LEFT JOIN vox m ON m.z = a.z AND m.y = a.y AND m.x = a.x + 1")
def mask_column(vox: DataFrame) -> DataFrame:
    m = vox.select("z", "y", (F.col("x") - 1).alias("x"), (F.col("v") > 20000).alias("m"))
    return vox.join(m, ["z", "y", "x"], "left").select("event_id", F.coalesce("m", F.lit(False)).alias("masked"))


@volume(""", l AS (SELECT x // 4 AS k, avg(v) AS m FROM vox GROUP BY ALL), t AS (SELECT x, least(greatest((x + 0.5::DOUBLE) / 4 - 0.5, 0), 4) AS p FROM (SELECT DISTINCT x FROM vox))
 SELECT x, round(a.m + (b.m - a.m) * (p - floor(p)), 3) AS v FROM t JOIN l a ON a.k = CAST(floor(p) AS BIGINT) JOIN l b ON b.k = least(CAST(floor(p) AS BIGINT) + 1, 4)""")
def upsample_linear(vox: DataFrame) -> DataFrame:
    low = vox.groupBy(F.expr("x div 4").alias("x")).agg(F.avg("v").alias("v")).withColumns({"z": F.lit(0).cast("long"), "y": F.lit(0).cast("long")})
    return stencil.upsample_linear(low, "x", 4).select("x", F.round("v", 3).alias("v"))


@volume("SELECT z, round(1 + 4 * (m - lo) / (hi - lo), 5) AS bias FROM (SELECT z, avg(v) AS m FROM vox GROUP BY z), (SELECT min(m) AS lo, max(m) AS hi FROM (SELECT avg(v) AS m FROM vox GROUP BY z))")
def bias_rescaled(vox: DataFrame) -> DataFrame:
    m = vox.groupBy("z").agg(F.avg("v").alias("m"))
    return m.join(m.agg(F.min("m").alias("lo"), F.max("m").alias("hi"))).select("z", F.round(1 + 4 * (F.col("m") - F.col("lo")) / (F.col("hi") - F.col("lo")), 5).alias("bias"))


@volume("SELECT label, count(*) FILTER (WHERE z = 3) AS below, count(*) FILTER (WHERE z = 4) AS above FROM vox WHERE label <> 0 AND z IN (3, 4) GROUP BY label")
def seam_label_sets(vox: DataFrame) -> DataFrame:
    return vox.where("label <> 0 and z in (3, 4)").groupBy("label").agg(F.count_if(F.col("z") == 3).alias("below"), F.count_if(F.col("z") == 4).alias("above"))


@volume("SELECT seam, seam % 2 AS wave FROM (SELECT unnest(range(0, (SELECT (max(y) + 10) // 10 - 1 FROM vox))) AS seam)")
def seam_waves(vox: DataFrame) -> DataFrame:
    s = blocks.seams(vox.sparkSession, dims(vox), {"z": 10, "y": 10, "x": 10}).where("axis = 1").select("seam").distinct()
    return s.withColumn("wave", F.col("seam") % 2)


@volume()
def zip_watershed(vox: DataFrame) -> DataFrame:
    """Labels along the middle seam that fit into a strip of one to two margins, segmented anew; all planes."""
    return iterative.zip_watershed(vox, "x", 10, 3, most=2)


@volume("SELECT label, CAST(greatest(ceil(greatest(max(x) - 9, 10 - min(x)) / 2.0), 1) AS INTEGER) AS n FROM vox WHERE label > 0 GROUP BY label HAVING bool_or(x IN (9, 10)) AND greatest(ceil(greatest(max(x) - 9, 10 - min(x)) / 2.0), 1) <= 4")
def zip_strips(vox: DataFrame) -> DataFrame:
    """How many margins of 2 a strip along the middle seam needs for each label that touches it."""
    return iterative.strips(vox, "x", 10, 2, iterative.margins_that_fit({"y": 25, "x": 8}, 2), least=1)


@volume("SELECT a.z, count(*) FILTER (WHERE label > 0) AS n_labelled, count(*) AS n FROM vox a WHERE x BETWEEN 4 AND 15 GROUP BY a.z")
def zip_covers(vox: DataFrame) -> DataFrame:
    """Zipping changes labels, but neither which voxels have one nor the strip."""
    z = iterative.zip_watershed(vox, "x", 10, 3, most=2)
    return z.groupBy("z").agg(F.count_if(F.col("label") != 0).alias("n_labelled"), F.count("*").alias("n"))


@volume()
def split_by_distance(vox: DataFrame) -> DataFrame:
    """Objects of a mask parted at their waists over blocks with margins, stitched where they overlap."""
    return kernels.regions_by_block(vox, dims(vox), BLOCK, 3, lambda a: kernels.seeded(a > 900))


@volume("SELECT z, y, x FROM vox WHERE v > 900")
def split_covers(vox: DataFrame) -> DataFrame:
    """Parting objects leaves no voxel of the mask out and takes none in."""
    return kernels.regions_by_block(vox, dims(vox), BLOCK, 3, lambda a: kernels.seeded(a > 900)).where("region > 0").select("z", "y", "x")


@volume("SELECT label, CAST(row_number() OVER (ORDER BY (label * 7919) % 1009, label) AS INTEGER) AS sequential FROM (SELECT DISTINCT label FROM vox WHERE label <> 0)")
def relabel_shuffled(vox: DataFrame) -> DataFrame:
    return objects.sequential(vox.withColumn("k", F.col("label") * 7919 % 1009), order=F.expr("struct(label * 7919 % 1009, label)"))


@volume("SELECT z, (z + 1) * 2.0::DOUBLE AS depth, CAST(round_even(z / 3.0, 0) AS BIGINT) AS level FROM vox GROUP BY z")
def plane_depths(vox: DataFrame) -> DataFrame:
    return vox.select("z").distinct().select("z", ((F.col("z") + 1) * 2.0).alias("depth"), F.rint(F.col("z") / 3.0).cast("long").alias("level"))


@volume("""SELECT c, round(min(m), 5) AS lo, round(max(m), 5) AS hi, max(n) AS n_max FROM (SELECT c, z, avg(v) AS m, count(*) AS n FROM vox GROUP BY c, z) GROUP BY c""")
def channel_ranges(vox: DataFrame) -> DataFrame:
    p = vox.groupBy("c", "z").agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    return p.groupBy("c").agg(F.round(F.min("m"), 5).alias("lo"), F.round(F.max("m"), 5).alias("hi"), F.max("n").alias("n_max"))


@volume(""", s AS (SELECT c, x, median(v) AS m FROM vox WHERE v >= 500 GROUP BY c, x) SELECT c, round(regr_slope(m, x), 5) AS slope FROM s GROUP BY c""")
def shading_slopes(vox: DataFrame) -> DataFrame:
    p = vox.where("v >= 500").groupBy("c", "x").agg(F.median("v").alias("m"))
    return p.groupBy("c").agg(F.round(F.regr_slope("m", "x"), 5).alias("slope"))


@volume("SELECT z, count(*) FILTER (WHERE v < 500) AS n_masked, round(avg(v) FILTER (WHERE v >= 500), 5) AS mean, round(median(v) FILTER (WHERE v >= 500), 5) AS median FROM vox GROUP BY z")
def masked_profiles(vox: DataFrame) -> DataFrame:
    on = F.when(F.col("v") >= 500, F.col("v"))
    return vox.groupBy("z").agg(F.count_if(F.col("v") < 500).alias("n_masked"), F.round(F.avg(on), 5).alias("mean"), F.round(F.median(on), 5).alias("median"))


@volume("SELECT part, count(*) AS n, round(avg(d), 5) AS mean_distance FROM (SELECT CASE WHEN z % 2 = 0 THEN 'even' ELSE 'odd' END AS part, sqrt((y - 12)^2 + (x - 10)^2) AS d FROM vox) GROUP BY part")
def distance_to_centre(vox: DataFrame) -> DataFrame:
    d = F.sqrt((F.col("y") - 12) ** 2 + (F.col("x") - 10) ** 2)
    return vox.groupBy(F.when(F.col("z") % 2 == 0, "even").otherwise("odd").alias("part")).agg(F.count("*").alias("n"), F.round(F.avg(d), 5).alias("mean_distance"))


@volume(f", {smooth_sql('sm', {'x': 2.0, 'y': 2.0})} SELECT vox.z, vox.y, vox.x, round(sm.s, 4) AS bias, round(coalesce(v / nullif(sm.s, 0), 0), 6) AS corrected FROM vox JOIN sm USING (z, y, x)")
def bias_corrected(vox: DataFrame) -> DataFrame:
    """Values over a smooth field: a Gaussian of each plane, over blocks with its margin, in place of external bias estimation."""
    smooth = kernels.by_block(vox, dims(vox), {"z": 10, "y": 12, "x": 20}, kernels.margin_of(2.0), lambda a: kernels.gaussian(a, (0, 2.0, 2.0)), to="bias")
    out = vox.select("z", "y", "x", "v").join(smooth, ["z", "y", "x"]).withColumn("corrected", F.coalesce(F.try_divide("v", "bias"), F.lit(0.0)))
    return out.select("z", "y", "x", F.round("bias", 4).alias("bias"), F.round("corrected", 6).alias("corrected"))


@volume(""", h AS (SELECT z, least(63, CAST(floor((v - lo) * 64.0 / (hi - lo)) AS INTEGER)) AS bin, count(*) AS n FROM vox, (SELECT min(v) AS lo, max(v) AS hi FROM vox) GROUP BY ALL) SELECT z, bin, n FROM h""")
def plane_histograms(vox: DataFrame) -> DataFrame:
    ends = vox.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = F.least(F.lit(63), F.floor((F.col("v") - F.col("lo")) * 64.0 / (F.col("hi") - F.col("lo"))).cast("int"))
    return vox.join(ends).groupBy("z", at.alias("bin")).agg(F.count("*").alias("n"))


@volume("SELECT block, round(quantile_cont(v, 0.01), 5) AS p0, round(quantile_cont(v, 0.998), 5) AS p1 FROM vox GROUP BY block")
def block_percentiles(vox: DataFrame) -> DataFrame:
    p = vox.groupBy("block").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.998))).alias("p"))
    return p.select("block", F.round(F.col("p")[0], 5).alias("p0"), F.round(F.col("p")[1], 5).alias("p1"))


E1 = "WITH e AS (SELECT vec_id, label, embedding[1]::DOUBLE AS m1 FROM embeddings)"


@tables(E1 + " SELECT vec_id, round(CASE WHEN m1 >= 0 THEN (pow(m1 + 1, 0.5) - 1) / 0.5 ELSE -(pow(1 - m1, 1.5) - 1) / 1.5 END, 6) AS m1 FROM e")
def power_transform(read) -> DataFrame:
    m = read("embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("m1"))
    return m.select("vec_id", F.round(profile.yeo_johnson(F.col("m1"), 0.5), 6).alias("m1"))


@tables(E1 + " SELECT vec_id, round((l - a) / s, 5) AS m1 FROM (SELECT vec_id, ln(1 + abs(m1)) AS l FROM e), (SELECT avg(ln(1 + abs(m1))) AS a, stddev_pop(ln(1 + abs(m1))) AS s FROM e)")
def scale_log(read) -> DataFrame:
    m = read("embeddings").select("vec_id", F.abs(F.col("embedding")[0].cast("double")).alias("m1"))
    return profile.scaled(m, ["m1"], "log").withColumn("m1", F.round("m1", 5))


@tables("SELECT label, CAST(count(*) AS BIGINT) AS n, round(avg(embedding[1]::DOUBLE), 6) AS mean FROM embeddings GROUP BY label HAVING count(*) > 10 ORDER BY label")
def cluster_sizes(read) -> DataFrame:
    e = read("embeddings")
    return e.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(F.col("embedding")[0].cast("double")), 6).alias("mean")).where("n > 10").orderBy("label")


KNN5 = """WITH RECURSIVE e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.id, b.id AS other, sqrt(greatest(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 0)) AS distance FROM e a JOIN e b ON a.id <> b.id),
 k AS MATERIALIZED (SELECT id, other FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, other) AS rank FROM d) WHERE rank <= 5), g AS MATERIALIZED (SELECT id AS u, other AS w FROM k UNION SELECT other, id FROM k)"""


@tables(KNN5 + """, bfs(node, steps) USING KEY (node) AS (SELECT 0::BIGINT, 0 UNION SELECT g.w, min(bfs.steps) + 1 FROM bfs JOIN g ON g.u = bfs.node LEFT JOIN recurring.bfs AS old ON old.node = g.w WHERE old.node IS NULL GROUP BY g.w) SELECT node, CAST(steps AS INTEGER) AS steps FROM bfs""")
def pseudotime(read) -> DataFrame:
    v = read("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    n = profile.knn(v, 5)
    return profile.pseudotime(n.select(F.col("id").alias("src"), F.col("other").alias("dst")), 0)


@tables()
def regress(read) -> DataFrame:
    """A linear model of one marker from the others, fitted on even ids, applied to all; odd ids are held out."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    e = read("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    rows = e.select("vec_id", F.col("e")[0].alias("label"), array_to_vector(F.slice("e", 2, 20)).alias("features"))
    model = LinearRegression(maxIter=10, regParam=0.01).fit(rows.where("vec_id % 2 = 0"))
    return model.transform(rows).select("vec_id", "label", "prediction", (F.col("vec_id") % 2 != 0).alias("held_out"))


@tables("SELECT p_partkey, round(CASE WHEN x = 0 THEN 0 ELSE round_even(x / pow(10, floor(log10(abs(x)))), 0) * pow(10, floor(log10(abs(x)))) END, 6) AS one_digit FROM (SELECT p_partkey, p_retailprice * 1.0 AS x FROM part)")
def one_digit(read) -> DataFrame:
    return read("part").select("p_partkey", F.round(maths.one_digit(F.col("p_retailprice")), 6).alias("one_digit"))


@tables("SELECT n_regionkey, count(*) AS n, string_agg(n_name, '|' ORDER BY n_name) AS files FROM nation GROUP BY n_regionkey")
def sorted_files(read) -> DataFrame:
    g = read("nation").groupBy("n_regionkey").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("n_name")), "|").alias("files"))
    return g
