"""Masks, thresholds, histograms, profiles, and correction of intensities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import correct
from .registry import volume


@volume("SELECT z, count(*) FILTER (WHERE v > 3000) AS n_on FROM vox GROUP BY z")
def threshold_mask(vox: DataFrame) -> DataFrame:
    return vox.groupBy("z").agg(F.count_if(F.col("v") > 3000).alias("n_on"))


@volume("SELECT CASE WHEN v >= 40000 THEN 0 WHEN v > 12000 THEN 3 WHEN v > 4000 AND v < 40000 THEN 2 WHEN v < 1000 THEN 1 ELSE 0 END AS class, count(*) AS n FROM vox GROUP BY ALL")
def classes4(vox: DataFrame) -> DataFrame:
    return vox.groupBy(correct.classes(F.col("v"), 1000, 4000, 12000, 40000).alias("class")).agg(F.count("*").alias("n"))


@volume("SELECT z // 2 AS z, y // 2 AS y, x // 2 AS x, bool_or(v >= 30000) AS clipped FROM vox GROUP BY ALL")
def clipped_any(vox: DataFrame) -> DataFrame:
    return vox.groupBy(*(F.expr(f"{a} div 2").alias(a) for a in "zyx")).agg(F.bool_or(F.col("v") >= 30000).alias("clipped"))


MEAN = "mn AS (SELECT z, y, x // 2 AS x, CAST(floor(avg(v)) AS BIGINT) AS m FROM vox GROUP BY ALL), md AS (SELECT z, median(m) AS med FROM mn GROUP BY z)"


def _two_channels(vox: DataFrame) -> DataFrame:
    """The view has one channel a voxel, so voxels side by side stand for the two channels of one place."""
    return vox.withColumn("x", F.expr("x div 2"))


@volume("SELECT z, y, x, CAST(floor(avg(v)) AS BIGINT) AS m FROM vox GROUP BY z, y, x")
def channel_means(vox: DataFrame) -> DataFrame:
    return correct.channel_mean(vox)


@volume(f", {MEAN} SELECT z, round(med, 6) AS med, round(greatest(1000.0, med / 3), 6) AS threshold FROM md")
def slice_thresholds(vox: DataFrame) -> DataFrame:
    return correct.slice_thresholds(correct.channel_mean(_two_channels(vox)), 1000.0, 3).select("z", F.round("med", 6).alias("med"), F.round("threshold", 6).alias("threshold"))


@volume(f", {MEAN} SELECT z, count(*) FILTER (WHERE m > greatest(1000.0, med / 3)) AS n_mask FROM mn JOIN md USING (z) GROUP BY z")
def slice_mask(vox: DataFrame) -> DataFrame:
    mean = correct.channel_mean(_two_channels(vox))
    return mean.join(correct.slice_thresholds(mean, 1000.0, 3), "z").groupBy("z").agg(F.count_if(F.col("m") > F.col("threshold")).alias("n_mask"))


@volume("SELECT z FROM vox GROUP BY z HAVING count(*) FILTER (WHERE c = 1) > 105")
def empty_planes(vox: DataFrame) -> DataFrame:
    return vox.groupBy("z").agg(F.count_if(F.col("c") == 1).alias("n")).where("n > 105").select("z")


@volume("SELECT z, CAST(row_number() OVER (ORDER BY z) - 1 AS BIGINT) AS new_z FROM (SELECT z FROM vox GROUP BY z HAVING count(*) FILTER (WHERE c = 1) <= 105)")
def drop_planes(vox: DataFrame) -> DataFrame:
    kept = vox.groupBy("z").agg(F.count_if(F.col("c") == 1).alias("n")).where("n <= 105").select("z")
    return kept.withColumn("new_z", F.row_number().over(Window.orderBy("z")).cast("long") - 1)


@volume("SELECT least(255, CAST(floor((v - lo) * 256.0 / (hi - lo)) AS INTEGER)) AS bin, count(*) AS n FROM vox, (SELECT min(v) AS lo, max(v) AS hi FROM vox) GROUP BY ALL")
def histogram256(vox: DataFrame) -> DataFrame:
    return correct.histogram(vox)


@volume(""", h AS (SELECT least(255, CAST(floor((v - lo) * 256.0 / (hi - lo)) AS INTEGER)) AS bin, count(*) AS n FROM vox, (SELECT min(v) AS lo, max(v) AS hi FROM vox) GROUP BY ALL),
 w AS (SELECT bin, sum(n) OVER (ORDER BY bin)::BIGINT AS n1, sum(n * bin) OVER (ORDER BY bin)::BIGINT AS s1, sum(n) OVER ()::BIGINT AS nn, sum(n * bin) OVER ()::BIGINT AS ss FROM h)
 SELECT bin FROM w WHERE nn > n1 ORDER BY (n1::DOUBLE * (nn - n1)) * (s1::DOUBLE / n1 - (ss - s1)::DOUBLE / (nn - n1))^2 DESC, bin LIMIT 1""")
def otsu(vox: DataFrame) -> DataFrame:
    return correct.otsu_bin(correct.histogram(vox))


@volume("SELECT CASE WHEN x IS NOT NULL THEN 'x' WHEN y IS NOT NULL THEN 'y' ELSE 'z' END AS axis, coalesce(x, y, z) AS at, count(*) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median FROM vox WHERE v >= 1000 GROUP BY GROUPING SETS ((z), (y), (x))")
def axis_profiles(vox: DataFrame) -> DataFrame:
    g = correct.axis_profiles(vox.where("v >= 1000"))
    return g.select("axis", "at", "n", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


@volume("SELECT c, z, x, round(median(v), 6) AS profile FROM vox WHERE v >= 500 GROUP BY c, z, x")
def shading_profile(vox: DataFrame) -> DataFrame:
    return correct.shading_profile(vox, 500, "x").withColumn("profile", F.round("profile", 6))


@volume(""", m AS (SELECT z, median(v) AS med FROM vox GROUP BY z), q AS (SELECT quantile_cont(med, 0.8) AS q FROM m) SELECT z, round(med, 6) AS med FROM m, q WHERE med > q""")
def select_planes(vox: DataFrame) -> DataFrame:
    return correct.select_planes(vox.groupBy("z").agg(F.median("v").alias("med")), 0.8).select("z", F.round("med", 6).alias("med"))


@volume(""", p AS (SELECT z, x, avg(v) AS m FROM vox GROUP BY z, x), l AS (SELECT z, m AS last FROM p WHERE x = 19) SELECT x, round(avg(m / last), 6) AS norm_mean FROM p JOIN l USING (z) GROUP BY x""")
def normalize_profile(vox: DataFrame) -> DataFrame:
    p = vox.groupBy("z", "x").agg(F.avg("v").alias("m"))
    return correct.normalize_profile(p).withColumn("norm_mean", F.round("norm_mean", 6))


@volume(""", p AS (SELECT x, median(v) AS m FROM vox GROUP BY x) SELECT round(regr_slope(m, x), 5) AS slope, round(regr_intercept(m, x), 4) AS intercept FROM p""")
def polyfit1(vox: DataFrame) -> DataFrame:
    k = correct.polyfit(vox.groupBy("x").agg(F.median("v").alias("m")), "x", "m", 1)
    return vox.sparkSession.createDataFrame([(round(k[1], 5), round(k[0], 4))], "slope double, intercept double")


@volume("SELECT z, round(avg(v), 6) AS mean, round(sqrt((count(*)*sum(v*v)::BIGINT-sum(v)::BIGINT*sum(v)::BIGINT)/(count(*)*count(*)::DOUBLE)), 5) AS sd FROM vox GROUP BY z")
def plane_stats(vox: DataFrame) -> DataFrame:
    return correct.plane_stats(vox).select("z", F.round("mean", 6).alias("mean"), F.round("sd", 5).alias("sd"))


PLANES = ", s AS (SELECT z, avg(v) AS m, sqrt((count(*)*sum(v*v)::BIGINT-sum(v)::BIGINT*sum(v)::BIGINT)/(count(*)*count(*)::DOUBLE)) AS sd FROM vox GROUP BY z), r AS (SELECT m AS rm, sd AS rs FROM s ORDER BY m DESC, z LIMIT 1)"


@volume(PLANES + " SELECT event_id, round(rm + rs * (v - m) / nullif(sd, 0), 4) AS v FROM vox JOIN s USING (z), r")
def attenuation(vox: DataFrame) -> DataFrame:
    return correct.attenuation(vox).select("event_id", F.round("corrected", 4).alias("v"))


@volume(""", l AS (SELECT z // 4 AS z, y // 5 AS y, x // 5 AS x, sum(v) / 100 AS bias FROM vox GROUP BY ALL) SELECT event_id, round(coalesce(v / nullif(bias, 0), 0), 6) AS corrected FROM vox JOIN l ON l.z = vox.z // 4 AND l.y = vox.y // 5 AND l.x = vox.x // 5""")
def bias_division(vox: DataFrame) -> DataFrame:
    return correct.divide_by_bias(vox, {"z": 4, "y": 5, "x": 5}).select("event_id", F.round("corrected", 6).alias("corrected"))


@volume(""", fx AS (SELECT x, avg(v) / (SELECT max(m) FROM (SELECT avg(v) AS m FROM vox GROUP BY x)) AS px FROM vox GROUP BY x), fy AS (SELECT y, avg(v) / (SELECT max(m) FROM (SELECT avg(v) AS m FROM vox GROUP BY y)) AS py FROM vox GROUP BY y)
 SELECT event_id, round(v / (px * py), 5) AS flat FROM vox JOIN fx USING (x) JOIN fy USING (y)""")
def shading_apply(vox: DataFrame) -> DataFrame:
    return correct.apply_shading(vox).select("event_id", F.round("flat", 5).alias("flat"))


@volume("SELECT event_id, round((v - lo)::DOUBLE / (hi - lo), 6) AS minmax, round(10.0 + 5.0 * (v - lo)::DOUBLE / (hi - lo), 6) AS ranged FROM vox, (SELECT min(v) AS lo, max(v) AS hi FROM vox)")
def minmax(vox: DataFrame) -> DataFrame:
    ends = vox.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    part = (F.col("v") - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo"))
    return vox.join(ends).select("event_id", F.round(part, 6).alias("minmax"), F.round(10.0 + 5.0 * part, 6).alias("ranged"))


@volume("SELECT event_id, round(least(greatest((v - p0) / (p1 - p0 + 2.220446049250313e-16), 0.0), 1.0), 6) AS v FROM vox, (SELECT quantile_cont(v, 0.01) AS p0, quantile_cont(v, 0.998) AS p1 FROM vox)")
def percentile_stretch(vox: DataFrame) -> DataFrame:
    ends = vox.agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.998))).alias("p"))
    return vox.join(ends).select("event_id", F.round(maths.stretch(F.col("v"), F.col("p")[0], F.col("p")[1]), 6).alias("v"))


@volume("SELECT event_id, round((v - m) / coalesce(nullif(s, 0), 1e-12), 5) AS z_score FROM vox, (SELECT avg(v) AS m, sqrt((count(*)*sum(v*v)::BIGINT-sum(v)::BIGINT*sum(v)::BIGINT)/(count(*)*(count(*)-1)::DOUBLE)) AS s FROM vox)")
def zscore(vox: DataFrame) -> DataFrame:
    n, v = F.count("*"), F.col("v")
    s = vox.agg(F.avg("v").alias("m"), F.sqrt(maths.exact_spread(n, F.sum(v * v), F.sum("v"), F.sum("v")) / (n * (n - 1).cast("double"))).alias("s"))
    return vox.join(s).select("event_id", F.round((v - F.col("m")) / F.coalesce(F.expr("nullif(s, 0)"), F.lit(1e-12)), 5).alias("z_score"))


@volume("SELECT z, round(avg(v) / (1 + exp(-(5.0 - z))), 5) AS weighted FROM vox GROUP BY z")
def sigmoid_weighting(vox: DataFrame) -> DataFrame:
    return vox.groupBy("z").agg(F.avg("v").alias("m")).select("z", F.round(F.col("m") * maths.sigmoid(5.0 - F.col("z")), 5).alias("weighted"))


@volume("SELECT min(z) AS z0, max(z) + 1 AS z1, greatest(min(y) - 3, 0) AS y0, least(max(y) + 4, 25) AS y1, min(x) AS x0, max(x) + 1 AS x1 FROM vox WHERE v > 45000")
def foreground_box(vox: DataFrame) -> DataFrame:
    zero, full = F.lit(0).cast("long"), F.lit(25).cast("long")
    return vox.where("v > 45000").agg(F.min("z").alias("z0"), (F.max("z") + 1).alias("z1"), F.greatest(F.min("y") - 3, zero).alias("y0"), F.least(F.max("y") + 4, full).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))


@volume(""", q AS (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM vox) SELECT round(round_even(lo / pow(10.0, floor(log10(abs(lo)))), 0) * pow(10.0, floor(log10(abs(lo)))), 6) AS lo, round(round_even(hi / pow(10.0, floor(log10(abs(hi)))), 0) * pow(10.0, floor(log10(abs(hi)))), 6) AS hi FROM q""")
def display_limits(vox: DataFrame) -> DataFrame:
    p = vox.agg(F.percentile("v", F.array(F.lit(0.05), F.lit(0.95))).alias("p"))
    return p.select(*(F.round(maths.one_digit(F.col("p")[k]), 6).alias(n) for k, n in enumerate(("lo", "hi"))))


@volume("SELECT max(z) FILTER (WHERE m = top) AS z FROM (SELECT z, avg(v) AS m FROM vox GROUP BY z), (SELECT max(m) AS top FROM (SELECT avg(v) AS m FROM vox GROUP BY z))")
def reference_plane(vox: DataFrame) -> DataFrame:
    return vox.groupBy("z").agg(F.avg("v").alias("m")).agg(F.max_by("z", F.struct(F.col("m"), -F.col("z"))).alias("z"))


@volume("SELECT event_id, v FROM vox ORDER BY v DESC, event_id LIMIT 25")
def brightest(vox: DataFrame) -> DataFrame:
    return vox.select("event_id", "v").orderBy(F.desc("v"), "event_id").limit(25)
