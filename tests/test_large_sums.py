"""Sums and products over volumes so large that longs do not hold them."""

import math

from pyspark.sql import functions as F

from tessera.catalogue import intensity
from tessera.operators import features, objects


def test_zscore_where_products_of_sums_outgrow_a_long(spark):
    v = [1_200_000_000, 1_100_000_000, 1_300_000_000]
    t = spark.createDataFrame(list(enumerate(v)), "event_id long, v long")
    assert [r.z_score for r in intensity.zscore(t).orderBy("event_id").collect()] == [0.0, -1.0, 1.0]


def test_inertia_and_variance_where_products_outgrow_a_long(spark):
    far = 1_200_000_000
    t = spark.createDataFrame([(far + k, 0, 0, far + 2 * k, 1) for k in (-1, 0, 1)], "z long, y long, x long, v long, label long")
    assert objects.intensities(t).first().variance == 8 / 3
    assert math.isclose(objects.inertia(t).first().eig0, 2 / 3)


def test_moments_that_outgrow_a_long_are_exact_decimals(spark):
    places = [(100_000 + k, 24 + k, 19 + k) for k in range(3)]
    t = spark.createDataFrame([(*p, 1) for p in places], "z long, y long, x long, label long")
    found = objects.moments(t)
    assert dict(found.dtypes)["value"] == "decimal(38,0)"
    assert {(r.i, r.j, r.k): int(r.value) for r in found.collect()} == {(i, j, k): sum(z**i * y**j * x**k for z, y, x in places) for i in range(4) for j in range(4) for k in range(4)}
    assert sum(z**3 * y**3 * x**3 for z, y, x in places) > 2**63
    assert dict(objects.moments(t.withColumn("z", F.col("z") - 100_000)).dtypes)["value"] == "bigint"


def test_the_maximal_set_where_moments_outgrow_a_long(spark):
    places = [(100_000 + k, 24 + k, 19 + k) for k in range(3)]
    t = spark.createDataFrame([(*p, 1) for p in places], "z long, y long, x long, label long")
    wide = features.morphology(t, "maximal").first()
    assert int(wide["moments-63"]) == sum(z**3 * y**3 * x**3 for z, y, x in places)


def test_the_maximal_set_where_sums_of_squares_outgrow_a_long(spark):
    """Keys shifted so far that a square still fits into a long, but not the sum of an object's squares."""
    far, n = 1_200_000_000, 9
    places = [(far + k, 24 - k, k) for k in range(n)]
    assert sum(z * z for z, _, _ in places) > 2**63 > far * far
    wide = features.morphology(spark.createDataFrame([(*p, 1) for p in places], "z long, y long, x long, label long"), "maximal").first()
    assert int(wide["moments-63"]) == sum(z**3 * y**3 * x**3 for z, y, x in places)
    assert math.isclose(wide["inertia_tensor_eigvals-0"], 3 * (n * n - 1) / 12, rel_tol=1e-6) and abs(wide["inertia_tensor_eigvals-2"]) < 1e-6
    below = spark.createDataFrame([(-far - k, 0, 0, 1) for k in range(n)], "z long, y long, x long, label long")
    assert math.isclose(objects.inertia(below).first().eig0, (n * n - 1) / 12, rel_tol=1e-6)
