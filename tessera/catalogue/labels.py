"""Objects: regions and moments, label maps and sets, contingency and scores, compartments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import objects
from .registry import volume

BOX = {"y": (0, 25), "x": (0, 20)}
REG = "reg AS (SELECT label, count(*) AS area, avg(z) AS centroid_z, avg(y) AS centroid_y, avg(x) AS centroid_x, min(z) AS bbox_z0, min(y) AS bbox_y0, min(x) AS bbox_x0, max(z) + 1 AS bbox_z1, max(y) + 1 AS bbox_y1, max(x) + 1 AS bbox_x1 FROM vox WHERE label <> 0 GROUP BY label)"
CENTROIDS = ("centroid_z", "centroid_y", "centroid_x")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@volume("SELECT block, label, count(*) AS area, round(avg(z), 6) AS centroid_z, round(avg(y), 6) AS centroid_y, round(avg(x), 6) AS centroid_x, min(z) AS bbox_z0, min(y) AS bbox_y0, min(x) AS bbox_x0, max(z) + 1 AS bbox_z1, max(y) + 1 AS bbox_y1, max(x) + 1 AS bbox_x1 FROM vox WHERE label <> 0 GROUP BY block, label")
def regionprops_minimal(vox: DataFrame) -> DataFrame:
    return rounded(objects.regions(vox, ("block", "label")), *CENTROIDS)


@volume(f", {REG} SELECT label, area, round(pow(6 * area / 3.141592653589793, 1.0 / 3), 6) AS equivalent_diameter, round(area / ((bbox_z1 - bbox_z0) * (bbox_y1 - bbox_y0) * (bbox_x1 - bbox_x0)), 6) AS extent FROM reg")
def regionprops_medium(vox: DataFrame) -> DataFrame:
    return rounded(objects.shape(objects.regions(vox)).select("label", "area", "equivalent_diameter", "extent"), "equivalent_diameter", "extent")


INERTIA = """, s AS (SELECT label, count(*) n, sum(z)::BIGINT sz, sum(y)::BIGINT sy, sum(x)::BIGINT sx, sum(z*z)::BIGINT szz, sum(y*y)::BIGINT syy, sum(x*x)::BIGINT sxx, sum(z*y)::BIGINT szy, sum(z*x)::BIGINT szx, sum(y*x)::BIGINT syx FROM vox WHERE label <> 0 GROUP BY label),
 m AS (SELECT label, (n*szz-sz*sz)/(n*n::DOUBLE) zz, (n*syy-sy*sy)/(n*n::DOUBLE) yy, (n*sxx-sx*sx)/(n*n::DOUBLE) xx, -(n*szy-sz*sy)/(n*n::DOUBLE) d, -(n*szx-sz*sx)/(n*n::DOUBLE) e, -(n*syx-sy*sx)/(n*n::DOUBLE) f FROM s),
 t AS (SELECT label, yy+xx a, zz+xx b, zz+yy c, d, e, f, 2*(zz+yy+xx)/3 q FROM m),
 p AS (SELECT *, sqrt(((a-q)*(a-q)+(b-q)*(b-q)+(c-q)*(c-q)+2*(d*d+e*e+f*f))/6) p FROM t),
 r AS (SELECT *, acos(CASE WHEN p > 1e-12 THEN least(1.0, greatest(-1.0, ((a-q)*((b-q)*(c-q)-f*f)-d*(d*(c-q)-f*e)+e*(d*f-(b-q)*e))/(2*p*p*p))) ELSE 1.0 END)/3 phi FROM p),
 g AS (SELECT label, q+2*p*cos(phi) eig0, q+2*p*cos(phi+2.0943951023931953) eig2, q FROM r),
 eig AS (SELECT label, eig0, 3*q-eig0-eig2 AS eig1, eig2 FROM g)"""


@volume(INERTIA + """ SELECT label, round(eig0, 5) AS eig0, round(eig1, 5) AS eig1, round(eig2, 5) AS eig2,
 round(4*sqrt(greatest(eig0, 0)), 5) AS major_axis_length, round(4*sqrt(greatest(eig2, 0)), 5) AS minor_axis_length,
 round(sqrt(1.5)*sqrt((eig0-(eig0+eig1+eig2)/3)^2+(eig1-(eig0+eig1+eig2)/3)^2+(eig2-(eig0+eig1+eig2)/3)^2)/nullif(sqrt(eig0*eig0+eig1*eig1+eig2*eig2), 0), 5) AS fractional_anisotropy FROM eig""")
def inertia_fa(vox: DataFrame) -> DataFrame:
    e = objects.inertia(vox)
    e = e.withColumn("major_axis_length", maths.axis_length(F.col("eig0"))).withColumn("minor_axis_length", maths.axis_length(F.col("eig2")))
    e = e.withColumn("fractional_anisotropy", maths.anisotropy(F.col("eig0"), F.col("eig1"), F.col("eig2")))
    return e.select("label", *(F.round(c, 5).alias(c) for c in e.columns if c != "label"))


@volume("SELECT label, i, j, k, sum(CAST(pow(z, i) AS BIGINT) * CAST(pow(y, j) AS BIGINT) * CAST(pow(x, k) AS BIGINT))::BIGINT AS value FROM vox, (SELECT unnest([0,1,2,3])::INTEGER AS i), (SELECT unnest([0,1,2,3])::INTEGER AS j), (SELECT unnest([0,1,2,3])::INTEGER AS k) WHERE label <> 0 GROUP BY label, i, j, k")
def moments_raw(vox: DataFrame) -> DataFrame:
    return objects.moments(vox)


@volume(""", c AS (SELECT label, avg(z) mz, avg(y) my, avg(x) mx, count(*) n FROM vox WHERE label <> 0 GROUP BY label)
 SELECT label, round(sum((z-mz)^2), 5) AS mu200, round(sum((y-my)^2), 5) AS mu020, round(sum((x-mx)^2), 5) AS mu002, round(sum((z-mz)*(y-my)), 5) + 0.0 AS mu110, round(sum((z-mz)^2) / pow(max(n), 5.0 / 3), 6) AS nu200 FROM vox JOIN c USING (label) GROUP BY label""")
def moments_central(vox: DataFrame) -> DataFrame:
    s = vox.where("label <> 0").groupBy("label").agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a}") for a in "zyx"), *(F.sum(F.col(a) * F.col(b)).alias(f"s{a}{b}") for a, b in ("zz", "yy", "xx", "zy")))
    mu = lambda a, b: maths.exact_spread(F.col("n"), F.col(f"s{a}{b}"), F.col(f"s{a}"), F.col(f"s{b}")) / F.col("n")
    return s.select("label", F.round(mu("z", "z"), 5).alias("mu200"), F.round(mu("y", "y"), 5).alias("mu020"), F.round(mu("x", "x"), 5).alias("mu002"), (F.round(mu("z", "y"), 5) + 0.0).alias("mu110"), F.round(mu("z", "z") / F.pow("n", F.lit(5.0 / 3)), 6).alias("nu200"))


@volume(""", d(d) AS (VALUES (-1), (0), (1)), cells AS (SELECT DISTINCT label, 2*z+a.d AS z, 2*y+b.d AS y, 2*x+c.d AS x, CASE WHEN (abs(a.d)+abs(b.d)+abs(c.d)) % 2 = 1 THEN 1 ELSE -1 END AS s FROM vox, d a, d b, d c WHERE label <> 0)
 SELECT label, sum(s)::BIGINT AS euler_number FROM cells GROUP BY label""")
def euler_number(vox: DataFrame) -> DataFrame:
    return objects.euler_number(vox)


@volume("SELECT label, c, min(v) AS min_intensity, max(v) AS max_intensity, round(avg(v), 6) AS mean_intensity, round(median(v), 6) AS median_intensity, round((count(*)*sum(v*v)::BIGINT-sum(v)::BIGINT*sum(v)::BIGINT)/(count(*)*count(*)::DOUBLE), 4) AS variance, round(quantile_cont(v, 0.95), 6) AS quantile95, round(sum(z*v)::DOUBLE/nullif(sum(v), 0), 6) AS weighted_centroid_z, round(sum(y*v)::DOUBLE/nullif(sum(v), 0), 6) AS weighted_centroid_y, round(sum(x*v)::DOUBLE/nullif(sum(v), 0), 6) AS weighted_centroid_x FROM vox WHERE label <> 0 GROUP BY label, c")
def intensity_features(vox: DataFrame) -> DataFrame:
    f = objects.intensities(vox, ("label", "c"))
    return rounded(f, *(c for c in f.columns if c not in ("label", "c", "min_intensity", "max_intensity", "variance"))).withColumn("variance", F.round("variance", 4))


BORDER = "SELECT DISTINCT label FROM vox WHERE label <> 0 AND (y = 0 OR y = 24 OR x = 0 OR x = 19)"


@volume(BORDER)
def border_labels(vox: DataFrame) -> DataFrame:
    return objects.border_labels(vox, BOX)


@volume(f"SELECT label, count(*) AS area FROM vox WHERE label <> 0 AND label NOT IN ({BORDER}) GROUP BY label")
def drop_border(vox: DataFrame) -> DataFrame:
    inner = vox.join(objects.border_labels(vox, BOX), "label", "left_anti")
    return inner.where("label <> 0").groupBy("label").agg(F.count("*").alias("area"))


@volume("SELECT label, count(*) AS area, count(*) * 0.5::DOUBLE AS volume_um FROM vox WHERE label <> 0 GROUP BY label HAVING count(*) >= 70 AND count(*) <= 90")
def size_filter(vox: DataFrame) -> DataFrame:
    return vox.where("label <> 0").groupBy("label").agg(F.count("*").alias("area")).where("area >= 70 and area <= 90").withColumn("volume_um", F.col("area") * 0.5)


@volume("SELECT CASE WHEN n < 70 THEN 'small' WHEN n >= 85 THEN 'large' ELSE 'medium' END AS bucket, count(*) AS n_labels, sum(n)::BIGINT AS n_voxels FROM (SELECT label, count(*) AS n FROM vox WHERE label <> 0 GROUP BY label) GROUP BY bucket")
def size_buckets(vox: DataFrame) -> DataFrame:
    n = vox.where("label <> 0").groupBy("label").agg(F.count("*").alias("n"))
    return n.groupBy(F.when(F.col("n") < 70, "small").when(F.col("n") >= 85, "large").otherwise("medium").alias("bucket")).agg(F.count("*").alias("n_labels"), F.sum("n").alias("n_voxels"))


@volume("SELECT label, count(*) AS area FROM vox WHERE label <> 0 AND label NOT IN (SELECT label FROM vox WHERE v > 30000 GROUP BY label HAVING count(*) > 2) GROUP BY label")
def delete_by_mask(vox: DataFrame) -> DataFrame:
    hit = vox.where("v > 30000").groupBy("label").count().where("count > 2").select("label")
    return vox.where("label <> 0").join(hit, "label", "left_anti").groupBy("label").agg(F.count("*").alias("area"))


@volume("SELECT DISTINCT label FROM vox WHERE label <> 0 AND z % 9 = 0 AND (y = 0 OR y = 24) AND (x = 0 OR x = 19)")
def corner_labels(vox: DataFrame) -> DataFrame:
    return vox.where("label <> 0 and z % 9 = 0 and y in (0, 24) and x in (0, 19)").select("label").distinct()


@volume("SELECT event_id, CASE WHEN label = 0 THEN 0 ELSE CASE WHEN label % 3 = 0 THEN 0 ELSE label // 2 END END AS value FROM vox")
def forward_map(vox: DataFrame) -> DataFrame:
    m = vox.where("label <> 0 and label % 3 <> 0").select("label", F.expr("label div 2").alias("value")).distinct()
    return objects.forward_map(vox.select("event_id", "label"), m).select("event_id", "value")


@volume("SELECT n AS label, CASE WHEN EXISTS (SELECT 1 FROM vox WHERE label = n) AND n <> 0 THEN n ELSE 0 END AS value FROM (SELECT unnest(range(0, (SELECT max(label) + 1 FROM vox))) AS n)")
def identity_map(vox: DataFrame) -> DataFrame:
    every = vox.agg(F.max("label").alias("m")).select(F.explode(F.sequence(F.lit(0).cast("long"), "m")).alias("label"))
    have = vox.where("label <> 0").select("label", F.col("label").alias("value")).distinct()
    return every.join(have, "label", "left").select("label", F.coalesce("value", F.lit(0).cast("long")).alias("value"))


@volume("SELECT b.block, count(*) AS n, min(CASE WHEN scattered > 0 THEN scattered + off END) AS lo, max(CASE WHEN scattered > 0 THEN scattered + off END) AS hi FROM vox JOIN (SELECT block, coalesce(sum(m) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM (SELECT block, max(scattered) AS m FROM vox GROUP BY block)) b ON vox.block = b.block GROUP BY b.block")
def relabel_blocks(vox: DataFrame) -> DataFrame:
    r = objects.relabel_blocks(vox.select("block", "scattered"), label="scattered").withColumn("s", F.expr("nullif(scattered, 0)"))
    return r.groupBy("block").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))


@volume("SELECT label, CAST(row_number() OVER (ORDER BY label) AS INTEGER) AS sequential FROM (SELECT DISTINCT label FROM vox WHERE label <> 0)")
def relabel_sequential(vox: DataFrame) -> DataFrame:
    return objects.sequential(vox)


@volume("SELECT block, max(label) AS maxlabel, count(DISTINCT label) AS n_labels FROM vox GROUP BY block")
def max_labels(vox: DataFrame) -> DataFrame:
    return vox.groupBy("block").agg(F.max("label").alias("maxlabel"), F.count_distinct("label").alias("n_labels"))


@volume("SELECT DISTINCT label FROM vox WHERE label <> 0")
def unique_labels(vox: DataFrame) -> DataFrame:
    return vox.select("label").distinct().where("label <> 0")


@volume("SELECT c, string_agg(DISTINCT label::VARCHAR, ' ' ORDER BY label::VARCHAR) AS labels FROM vox WHERE label <> 0 GROUP BY c")
def label_sets(vox: DataFrame) -> DataFrame:
    s = vox.where("label <> 0").groupBy("c").agg(F.sort_array(F.collect_set(F.col("label").cast("string"))).alias("s"))
    return s.select("c", F.array_join("s", " ").alias("labels"))


@volume("""SELECT CASE WHEN label = 0 THEN 'background' WHEN v > 9000 THEN 'memb' WHEN v < 2000 THEN 'nucl' ELSE 'csol' END AS compartment, count(*) AS n, count(DISTINCT label) AS n_labels FROM vox GROUP BY ALL""")
def compartments(vox: DataFrame) -> DataFrame:
    c = F.when(F.col("label") == 0, "background").when(F.col("v") > 9000, "memb").when(F.col("v") < 2000, "nucl").otherwise("csol")
    return vox.groupBy(c.alias("compartment")).agg(F.count("*").alias("n"), F.count_distinct("label").alias("n_labels"))


COMPS = """, f AS (SELECT label, count(*) AS area_full FROM vox WHERE label <> 0 GROUP BY label), m AS (SELECT label, count(*) AS area_memb FROM vox WHERE label <> 0 AND v > 20000 GROUP BY label),
 n AS (SELECT label, count(*) AS area_nucl FROM vox WHERE label <> 0 AND v < 100 GROUP BY label)"""


def _compartment_tables(vox: DataFrame) -> list[DataFrame]:
    of = lambda where, name: vox.where(f"label <> 0 and {where}").groupBy("label").agg(F.count("*").alias(name))
    return [of("true", "area_full"), of("v > 20000", "area_memb"), of("v < 100", "area_nucl")]


@volume(COMPS + " SELECT * FROM f JOIN m USING (label) JOIN n USING (label)")
def compartments_join(vox: DataFrame) -> DataFrame:
    f, m, n = _compartment_tables(vox)
    return f.join(m, "label").join(n, "label")


@volume(COMPS + " SELECT label, area_full, area_memb, area_nucl FROM f FULL JOIN m USING (label) FULL JOIN n USING (label)")
def compartments_outer(vox: DataFrame) -> DataFrame:
    f, m, n = _compartment_tables(vox)
    return f.join(m, "label", "full").join(n, "label", "full")


@volume("SELECT label, min(z) + 10 * min(block // 6) AS dataset_z, round(avg(y) - 10 * (min(y) // 10), 6) AS block_y FROM vox WHERE label <> 0 GROUP BY label")
def dataset_coordinates(vox: DataFrame) -> DataFrame:
    g = vox.where("label <> 0").groupBy("label").agg(F.min("z").alias("z"), F.min(F.expr("block div 6")).alias("bz"), F.avg("y").alias("y"), F.min("y").alias("y0"))
    return g.select("label", (F.col("z") + 10 * F.col("bz")).alias("dataset_z"), F.round(F.col("y") - 10 * F.expr("y0 div 10"), 6).alias("block_y"))


@volume(INERTIA + """, n AS (SELECT label, avg(z) nz, avg(y) ny, avg(x) nx FROM vox WHERE label <> 0 AND v < 1000 GROUP BY label), f AS (SELECT label, avg(z) fz, avg(y) fy, avg(x) fx FROM vox WHERE label <> 0 GROUP BY label)
 SELECT label, round(sqrt((2*(fz-nz))^2+(fy-ny)^2+(fx-nx)^2)/nullif(4*sqrt(greatest(eig0, 0)), 0), 5) AS polarity FROM f JOIN eig USING (label) FULL JOIN n USING (label)""")
def polarity(vox: DataFrame) -> DataFrame:
    full = objects.regions(vox).join(objects.inertia(vox), "label").withColumn("major_axis_length", maths.axis_length(F.col("eig0")))
    p = objects.polarity(full, objects.regions(vox.where("v < 1000")), {"z": 2.0})
    return p.select("label", F.round("polarity", 5).alias("polarity"))


@volume(f", {REG}, d AS (SELECT z // 2 AS z, y // 5 AS y, x // 5 AS x, max(v) AS dist FROM vox GROUP BY ALL) SELECT label, dist FROM reg JOIN d ON d.z = CAST(trunc(centroid_z / 2) AS BIGINT) AND d.y = CAST(trunc(centroid_y / 5) AS BIGINT) AND d.x = CAST(trunc(centroid_x / 5) AS BIGINT)")
def distance_lookup(vox: DataFrame) -> DataFrame:
    d = vox.groupBy(F.expr("z div 2").alias("z"), F.expr("y div 5").alias("y"), F.expr("x div 5").alias("x")).agg(F.max("v").alias("dist"))
    at = objects.regions(vox).select("label", *((F.col(f"centroid_{a}") / n).cast("long").alias(a) for a, n in (("z", 2), ("y", 5), ("x", 5))))
    return at.join(d, ["z", "y", "x"]).select("label", "dist")


@volume("""SELECT event_id, CASE WHEN label = 0 THEN 0 ELSE CAST(floor((a - lo) * 65535.0 / (hi - lo)) AS BIGINT) END AS value FROM vox LEFT JOIN (SELECT label, count(*) AS a FROM vox WHERE label <> 0 GROUP BY label) USING (label), (SELECT least(0, min(a)) AS lo, max(a) AS hi FROM (SELECT count(*) AS a FROM vox WHERE label <> 0 GROUP BY label))""")
def backproject_normalised(vox: DataFrame) -> DataFrame:
    areas = vox.where("label <> 0").groupBy("label").agg(F.count("*").alias("a"))
    ends = areas.agg(F.least(F.lit(0).cast("long"), F.min("a")).alias("lo"), F.max("a").alias("hi"))
    m = areas.join(ends).select("label", F.floor((F.col("a") - F.col("lo")) * 65535.0 / (F.col("hi") - F.col("lo"))).cast("long").alias("value"))
    return objects.forward_map(vox.select("event_id", "label"), m).select("event_id", "value")


CONT = """, pr AS (SELECT label, truth, count(*) AS n FROM vox WHERE label <> 0 AND truth <> 0 GROUP BY ALL), sn AS (SELECT label, count(*) AS ns FROM vox WHERE label <> 0 GROUP BY label), tn AS (SELECT truth, count(*) AS nt FROM vox WHERE truth <> 0 GROUP BY truth),
 ct AS (SELECT label, truth, n, ns, nt, 2 * n / (ns + nt) AS dice, n / (ns + nt - n) AS jaccard FROM pr JOIN sn USING (label) JOIN tn USING (truth)),
 mt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, truth) AS k FROM ct) WHERE k = 1), seg AS (SELECT truth, coalesce(k, 0)::BIGINT AS segments FROM tn LEFT JOIN (SELECT truth, count(*) AS k FROM mt GROUP BY truth) USING (truth))"""


@volume(CONT + " SELECT label, truth, n, ns AS n_seg, nt AS n_truth, round(dice, 6) AS dice, round(jaccard, 6) AS jaccard FROM ct")
def contingency(vox: DataFrame) -> DataFrame:
    return rounded(objects.contingency(vox), "dice", "jaccard")


@volume(CONT + " SELECT label, truth, n, round(dice, 6) AS dice, round(jaccard, 6) AS jaccard FROM mt")
def main_truth(vox: DataFrame) -> DataFrame:
    return rounded(objects.main_truth(objects.contingency(vox)), "dice", "jaccard")


@volume(CONT + """, g AS (SELECT sum((segments > 0)::INT)::BIGINT AS tp, sum(greatest(segments - 1, 0))::BIGINT AS fp, sum((segments = 0)::INT)::BIGINT AS fn, sum((segments > 1)::INT)::BIGINT AS oversegmented, sum((segments = 0)::INT)::BIGINT AS undersegmented FROM seg),
 h AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r FROM g)
 SELECT tp, fp, fn, oversegmented, undersegmented, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) AS f1, round(coalesce(3.25 * p * r / nullif(2.25 * p + r, 0), 0.0), 6) AS f_weighted FROM h""")
def detection_scores(vox: DataFrame) -> DataFrame:
    return rounded(objects.detection(objects.matches(vox)), "precision", "recall", "f1", "f_weighted")


@volume("SELECT count(*) FILTER (WHERE label > 0 AND scattered % 2 = 1) AS tp, count(*) FILTER (WHERE label > 0 AND scattered % 2 <> 1) AS fp, count(*) FILTER (WHERE label = 0 AND scattered % 2 = 1) AS fn, count(*) FILTER (WHERE label = 0 AND scattered % 2 <> 1) AS tn, round(count(*) FILTER (WHERE label > 0 AND scattered % 2 = 1) / nullif(count(*) FILTER (WHERE scattered % 2 = 1), 0), 6) AS sensitivity FROM vox")
def sensitivity_specificity(vox: DataFrame) -> DataFrame:
    c = vox.agg(*(F.count_if(F.expr(e)).alias(n) for n, e in (("tp", "label > 0 and scattered % 2 = 1"), ("fp", "label > 0 and scattered % 2 <> 1"), ("fn", "label = 0 and scattered % 2 = 1"), ("tn", "label = 0 and scattered % 2 <> 1"))))
    return c.withColumn("sensitivity", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 6))


@volume("SELECT a.z AS z, a.label AS label, b.label AS next_label, count(*) AS n FROM vox a JOIN vox b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x WHERE a.label <> 0 AND b.label <> 0 GROUP BY ALL")
def consecutive_planes(vox: DataFrame) -> DataFrame:
    a = vox.where("label <> 0").select("z", "y", "x", "label")
    b = vox.where("label <> 0").select((F.col("z") - 1).alias("z"), "y", "x", F.col("label").alias("next_label"))
    return a.join(b, ["z", "y", "x"]).groupBy("z", "label", "next_label").agg(F.count("*").alias("n"))


@volume("SELECT (label + 1) // 2 AS merged, count(*) AS n, sum(v)::BIGINT AS total FROM vox WHERE label <> 0 GROUP BY ALL")
def merge_labels(vox: DataFrame) -> DataFrame:
    m = vox.where("label <> 0").select("label", F.expr("(label + 1) div 2").alias("value")).distinct()
    return objects.forward_map(vox, m).where("value <> 0").groupBy(F.col("value").alias("merged")).agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@volume("SELECT label, round(avg(v), 6) AS mean FROM vox WHERE label <> 0 GROUP BY label HAVING avg(v) BETWEEN 4000 AND 6000")
def threshold_filter(vox: DataFrame) -> DataFrame:
    m = vox.where("label <> 0").groupBy("label").agg(F.avg("v").alias("mean"))
    return rounded(m.where("mean is not null and not isnan(mean) and mean between 4000 and 6000"), "mean")


@volume("SELECT label, count(*) AS volume, min(v) AS lo, max(v) AS hi FROM vox WHERE label <> 0 GROUP BY label HAVING count(*) > 60 AND count(*) < 90 AND min(v) <> 0 AND max(v) <> 65535")
def cell_filter(vox: DataFrame) -> DataFrame:
    g = vox.where("label <> 0").groupBy("label").agg(F.count("*").alias("volume"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    return g.where("volume > 60 and volume < 90 and not (lo = 0 or hi = 65535)")


@volume("SELECT label FROM (SELECT DISTINCT label FROM vox WHERE v > 30000 INTERSECT SELECT DISTINCT label FROM vox WHERE x = 0) WHERE label <> 0 UNION (SELECT DISTINCT label FROM vox WHERE y = 0 AND z = 0 EXCEPT SELECT 0)")
def label_set_algebra(vox: DataFrame) -> DataFrame:
    of = lambda e: vox.where(e).select("label").distinct()
    both = of("v > 30000").intersect(of("x = 0")).where("label <> 0")
    return both.union(of("y = 0 and z = 0").where("label <> 0")).distinct()
