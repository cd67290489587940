"""Transforms line by line against whole arrays."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import kernels, lines


def table(spark, array, name):
    z, y, x = np.indices(array.shape)
    return spark.createDataFrame(pd.DataFrame({"z": z.ravel(), "y": y.ravel(), "x": x.ravel(), name: array.ravel()}))


@pytest.mark.parametrize("shape, voxels", [((5, 9, 14), 500_000), ((3, 7, 11), 4), ((1, 1, 6), 10)])
@pytest.mark.parametrize("spacing", [{"z": 3.0, "y": 1.5, "x": 1.0}, {"y": 2.0, "x": 1.0}])
def test_distances_equal_whole_arrays(spark, monkeypatch, shape, voxels, spacing):
    monkeypatch.setattr(lines, "VOXELS", voxels)
    mask = np.random.default_rng(7).random(shape) < 0.85
    got = {(r.z, r.y, r.x): r.distance for r in lines.distances(table(spark, mask, "mask").repartition(3), spacing).collect()}
    axes = tuple("zyx".index(a) for a in spacing)
    want = kernels.distance(mask, tuple(spacing.get(a, 1.0) for a in "zyx"), axes)
    assert got == {p: pytest.approx(want[p]) for p in map(tuple, np.argwhere(mask & np.isfinite(want)).tolist())}


def test_gaps_and_nulls_are_near_to_nothing(spark):
    rows = [(0, 0, 0, True), (0, 0, 2, True), (0, 0, 7, False), (0, 0, 9, None), (0, 3, 0, True), (1, 0, 7, True)]
    t = spark.createDataFrame(rows, "z long, y long, x long, mask boolean").withColumn("f", F.lit(5))
    got = sorted((r.z, r.y, r.x, r.distance) for r in lines.distances(t, {"x": 2.0}).collect())
    assert got == [(0, 0, 0, 14.0), (0, 0, 2, 10.0)]
    assert lines.distances(t.where("false"), {"x": 1.0}).count() == 0


def test_no_task_needs_a_plane(spark):
    t = table(spark, np.ones((2, 3, 4), bool), "mask")
    plan = lines.distances(t, {"y": 1.0, "x": 1.0})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(p#") == 2 and "FlatMapGroups" not in plan


def test_seeds_do_not_depend_on_the_grid_of_blocks(spark):
    r = np.random.default_rng(12)
    shape = (6, 26, 30)
    data = kernels.gaussian(r.normal(size=shape), (1, 2, 2)) * 1000 * np.linspace(0.3, 2, shape[2])
    mask = r.random(shape) < 0.9
    full, spacing, dog = dict(zip("zyx", shape)), (1.0, 1.0, 1.0), (0.5, 1.0)
    vox = table(spark, data, "v").join(table(spark, mask, "mask"), ["z", "y", "x"])
    size = {"z": 6, "y": 13, "x": 10}
    ends = kernels.difference_ends(vox, full, size, dog, spacing)
    one, two = (kernels.gaussian(data, (s,) * 3) for s in dog)
    assert ends == pytest.approx(((one - two).min(), (one - two).max()))
    found = lambda v, m, **more: (kernels.seeds_of(v, m, spacing, dog=dog, threshold=1.005, **more) > 0).astype(int)
    whole = found(data, mask)
    for given, same in ((ends, True), (None, False)):
        got = np.zeros(shape, int)
        for x in kernels.by_block(vox, full, size, 5, lambda v, m, e=given: found(v, m, ends=e), ("v", "mask"), kind="long").collect():
            got[x.z, x.y, x.x] = x.out
        assert (got == whole).all() == same
