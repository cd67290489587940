"""Splitting of large components over blocks equals that of the whole, in few groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql.group import GroupedData

from tessera.operators import iterative, kernels, stencil


def named(mask):
    """Components of an array by the number of their first voxel, -1 outside."""
    c = kernels.components(mask)
    out = np.full(mask.shape, -1)
    out[mask] = pd.Series(np.flatnonzero(mask)).groupby(c[mask]).transform("min")
    return out


def dropped(parts, least):
    which, n = np.unique(parts[parts >= 0], return_counts=True)
    return np.where(np.isin(parts, which[n >= least]), parts, -1)


def whole(mask, here, passes, least=3, reach=3**0.5):
    parts = named(mask & here)
    for large_from, times in passes:
        large = dropped(parts, large_from) >= 0
        core = large
        for _ in range(times):
            core = kernels.ranked(core | ~here, stencil.cross(), "min")
        split = dropped(named(core & here), least)
        best, far = np.full(mask.shape, -1), np.full(mask.shape, 99)
        for o in sorted(stencil.ball(reach), key=lambda o: sum(d * d for d in o)):
            at, there = kernels.shifted(split, o)
            d, seen = sum(k * k for k in o), split[there]
            take = (seen >= 0) & ((d < far[at]) | ((d == far[at]) & (seen < best[at])))
            best[at], far[at] = np.where(take, seen, best[at]), np.where(take, d, far[at])
        parts = np.where(large, best, parts)
    return parts


def table(spark, mask, here):
    z, y, x = np.nonzero(here)
    return spark.createDataFrame(pd.DataFrame({"z": z, "y": y, "x": x, "mask": mask[here]}))


@pytest.mark.parametrize("side", [1, 7, 64])
def test_split_over_blocks_equals_the_whole(spark, side):
    r = np.random.default_rng(5)
    for shape, dense, gaps in (((9, 14, 12), 0.75, 0.0), ((8, 11, 13), 0.9, 0.05)):
        mask, here = r.random(shape) < dense, r.random(shape) >= gaps
        passes = [(60, 1), (30, 2), (20, 1)]
        got = np.full(shape, -1)
        for p in iterative.split_large(table(spark, mask, here), dict(zip("zyx", shape)), {"z": 4, "y": 3, "x": 5}, passes, side=side).collect():
            got[p.z, p.y, p.x] = p.component
        want = whole(mask, here, passes)
        assert len(np.unique(want)) > 3 and (got == want).all()


def test_small_blocks_are_worked_on_together(spark, monkeypatch):
    from tessera.catalogue import segmentation

    most, plain = [0], GroupedData.applyInPandas

    def counted(self, func, schema):
        most[0] = max(most[0], self.count().count())
        return plain(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", counted)
    v = np.random.default_rng(6).integers(0, 4000, (64, 25, 20))
    z, y, x = np.indices(v.shape)
    vox = spark.createDataFrame(pd.DataFrame({"z": z.ravel(), "y": y.ravel(), "x": x.ravel(), "v": v.ravel()}))
    want = whole(v > 800, np.ones(v.shape, bool), [(200, 1), (100, 1)])
    ids, n = np.unique(want[want >= 0], return_counts=True)
    assert {(r.component, r.n) for r in segmentation.iterative_split(vox).collect()} == set(zip(ids.tolist(), n.tolist()))
    assert 0 < most[0] <= 4
