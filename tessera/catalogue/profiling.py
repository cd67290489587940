"""Profiles of objects, over ``embeddings`` and per-label features."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, profile
from ..runtime import shared_folder
from .registry import tables, volume

E4 = "WITH e AS (SELECT vec_id, label, embedding[1]::DOUBLE AS m1, embedding[2]::DOUBLE AS m2, embedding[3]::DOUBLE AS m3 FROM embeddings)"
MARKERS = ["m1", "m2", "m3"]


def _markers(read) -> DataFrame:
    return read("embeddings").select("vec_id", "label", *(F.col("embedding")[k].cast("double").alias(f"m{k + 1}") for k in range(3)))


def _vectors(read) -> DataFrame:
    return read("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label")


def _rounded(df: DataFrame, n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in MARKERS})


@tables(E4 + " SELECT label, round(median(m1), 6) AS m1, round(median(m2), 6) AS m2, round(median(m3), 6) AS m3 FROM e GROUP BY label")
def cluster_medians(read) -> DataFrame:
    return _markers(read).groupBy("label").agg(*(F.round(F.median(c), 6).alias(c) for c in MARKERS))


@tables(E4 + " SELECT 'm1' AS a, 'm2' AS b, round(corr(m1, m2), 5) AS r FROM e UNION ALL SELECT 'm1', 'm3', round(corr(m1, m3), 5) FROM e UNION ALL SELECT 'm2', 'm3', round(corr(m2, m3), 5) FROM e")
def feature_correlation(read) -> DataFrame:
    pairs = [("m1", "m2"), ("m1", "m3"), ("m2", "m3")]
    r = _markers(read).agg(*(F.round(F.corr(a, b), 5).alias(f"{a}{b}") for a, b in pairs))
    return r.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}{b}").alias("r")) for a, b in pairs))))


@tables(E4 + " SELECT vec_id, label, round((m1 - a1) / nullif(s1, 0), 5) AS m1, round((m2 - a2) / nullif(s2, 0), 5) AS m2, round((m3 - a3) / nullif(s3, 0), 5) AS m3 FROM e, (SELECT avg(m1) AS a1, stddev_pop(m1) AS s1, avg(m2) AS a2, stddev_pop(m2) AS s2, avg(m3) AS a3, stddev_pop(m3) AS s3 FROM e)")
def scale_standard(read) -> DataFrame:
    return _rounded(profile.scaled(_markers(read), MARKERS, "standard"), 5)


@tables(E4 + " SELECT vec_id, label, round((m1 - a1) / nullif(b1 - a1, 0), 6) AS m1, round((m2 - a2) / nullif(b2 - a2, 0), 6) AS m2, round((m3 - a3) / nullif(b3 - a3, 0), 6) AS m3 FROM e, (SELECT min(m1) AS a1, max(m1) AS b1, min(m2) AS a2, max(m2) AS b2, min(m3) AS a3, max(m3) AS b3 FROM e)")
def scale_minmax(read) -> DataFrame:
    return _rounded(profile.scaled(_markers(read), MARKERS, "minmax"))


@tables(E4 + ", p AS (SELECT vec_id, label, abs(m1) AS m1, abs(m2) AS m2, abs(m3) AS m3 FROM e) SELECT vec_id, label, round(m1 / (m1 + m2 + m3), 6) AS m1, round(m2 / (m1 + m2 + m3), 6) AS m2, round(m3 / (m1 + m2 + m3), 6) AS m3 FROM p")
def scale_rows(read) -> DataFrame:
    return _rounded(profile.scaled(_markers(read).withColumns({c: F.abs(c) for c in MARKERS}), MARKERS, "row"))


@tables("""WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.id, b.id AS other, sqrt(greatest(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 0)) AS distance FROM e a JOIN e b ON a.id <> b.id),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY distance, other) AS INTEGER) AS rank FROM d) SELECT id, rank, other, round(distance, 6) AS distance FROM r WHERE rank <= 5""")
def knn_exact(read) -> DataFrame:
    return profile.knn(_vectors(read), 5).withColumn("distance", F.round("distance", 6))


@tables()
def knn_communities(read) -> DataFrame:
    n = profile.knn(_vectors(read), 5)
    return profile.communities(n.select(F.col("id").alias("src"), F.col("other").alias("dst")))


@tables()
def pca3(read) -> DataFrame:
    return profile.pca(_vectors(read)).select("id", *(F.round(F.col("pc")[k], 6).alias(f"pc{k}") for k in range(3)))


@tables()
def classify(read) -> DataFrame:
    """One-vs-rest linear classifiers of the label, fitted on even ids, applied to all; odd ids are held out."""
    from pyspark.ml.classification import LinearSVC, OneVsRest
    from pyspark.ml.functions import array_to_vector

    rows = _vectors(read).select("id", array_to_vector("v").alias("features"), F.col("label").cast("double").alias("label"))
    model = OneVsRest(classifier=LinearSVC(maxIter=10, regParam=0.01)).fit(rows.where("id % 2 = 0"))
    return model.transform(rows).select("id", "label", "prediction", (F.col("id") % 2 != 0).alias("held_out"))


@tables(E4 + " SELECT vec_id, CASE WHEN label IN (1, 3) THEN 1.0 ELSE round(abs(m1), 6) END AS value FROM e")
def predict_except(read) -> DataFrame:
    return _markers(read).select("vec_id", F.when(F.col("label").isin(1, 3), 1.0).otherwise(F.round(F.abs("m1"), 6)).alias("value"))


@tables(E4 + " SELECT vec_id, round(m1, 6) AS m1 FROM e WHERE m1 > (SELECT quantile_cont(m1, 0.99) FROM e)")
def above_quantile(read) -> DataFrame:
    m = _markers(read)
    return m.join(m.agg(F.percentile("m1", 0.99).alias("q"))).where("m1 > q").select("vec_id", F.round("m1", 6).alias("m1"))


@volume("SELECT c, name, round(value, 6) AS value FROM (SELECT c, avg(v) AS mean, median(v) AS median, max(v)::DOUBLE AS top FROM vox GROUP BY c) UNPIVOT (value FOR name IN (mean, median, top))")
def features_long(vox: DataFrame) -> DataFrame:
    w = vox.groupBy("c").agg(F.avg("v").alias("mean"), F.median("v").alias("median"), F.max("v").cast("double").alias("top"))
    return w.unpivot("c", ["mean", "median", "top"], "name", "value").withColumn("value", F.round("value", 6))


@tables("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), m AS (SELECT k, avg(v[k]) AS m FROM e, (SELECT unnest(range(1, 65)) AS k) WHERE vec_id % 2 = 0 GROUP BY k)
 SELECT vec_id, round(sum((v[k] - m) * (v[k] - m)), 6) AS square FROM e, m WHERE vec_id % 2 = 1 GROUP BY vec_id""")
def embedded_rows(read) -> DataFrame:
    """The test rows on all components fitted on the training rows, kept and loaded: a turn, so squared lengths are those from the training mean."""
    v, path = _vectors(read), f"{shared_folder(read('embeddings').sparkSession)}/tessera-{uuid.uuid4().hex}"
    profile.keep_model(v.sparkSession, path, profile.fit_pca(v.where("id % 2 = 0"), 64))
    out = profile.embed(v.where("id % 2 = 1"), profile.kept_model(v.sparkSession, path))
    return out.select(F.col("id").alias("vec_id"), F.round(F.aggregate("pc", F.lit(0.0), lambda s, x: s + x * x), 6).alias("square"))


@tables("""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.vec_id, b.label, b.vec_id AS other, list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM e a JOIN e b ON a.vec_id % 2 = 1 AND b.vec_id % 2 = 0)
 SELECT vec_id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, other) AS k FROM d) WHERE k = 1""")
def predicted_from_embedding(read) -> DataFrame:
    """Test rows embedded by the training rows' components, and predicted by the nearest training row there."""
    v = _vectors(read)
    train, test = v.where("id % 2 = 0"), v.where("id % 2 = 1")
    model = profile.fit_pca(train, 64)
    places = [profile.embed(t, model).select("id", F.col("pc").alias("v")) for t in (test, train)]
    near = profile.knn(places[0], 1, among=places[1])
    return near.join(train.select(F.col("id").alias("other"), "label"), "other").select(F.col("id").alias("vec_id"), F.col("label").alias("predicted"))


@tables(E4 + """, f AS (SELECT * FROM e WHERE m1 BETWEEN -0.15 AND 0.15), s AS (SELECT avg(m1) AS a1, stddev_pop(m1) AS s1, avg(m2) AS a2, stddev_pop(m2) AS s2, avg(m3) AS a3, stddev_pop(m3) AS s3 FROM f),
 n AS (SELECT vec_id, label, (m1 - a1) / s1 AS m1, (m2 - a2) / s2 AS m2, (m3 - a3) / s3 AS m3 FROM f, s), d AS (SELECT * FROM n ORDER BY md5(vec_id::VARCHAR || ':4'), vec_id LIMIT 100)
 SELECT vec_id, label, round(m1, 5) AS m1, round(m2, 5) AS m2, round(m3, 5) AS m3 FROM d WHERE m2 < 1.1""")
def sampled_profiles(read) -> DataFrame:
    """The data of a profile: bounded, normalised, a hundred rows drawn, and those beyond a place of the map left out."""
    kept = features.bounded(_markers(read), {"m1": (-0.15, 0.15)})
    rows = profile.drawn(profile.scaled(kept, MARKERS, "standard"), "vec_id", 100, 4)
    return _rounded(rows.where("m2 < 1.1"), 5)
