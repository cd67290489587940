"""Parting over blocks gives the regions of the whole, and no task gets a whole seam."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from tessera.operators import flood, iterative, kernels


def rows(spark, mask, **columns):
    z, y, x = np.nonzero(mask)
    return spark.createDataFrame(pd.DataFrame({"z": z, "y": y, "x": x, **{k: v[mask] for k, v in columns.items()}}))


def first_numbers(mask, regions):
    """Regions of an array by the number of their first voxel."""
    return pd.Series(np.arange(mask.size)[mask.ravel()]).groupby(regions[mask]).transform("min").to_numpy()


@pytest.fixture
def largest(monkeypatch):
    """The largest group that any grouping of pandas has had."""
    seen, plain = [0], GroupedData.applyInPandas

    def counted(self, func, schema):
        seen[0] = max(seen[0], self.count().agg(F.max("count")).first()[0] or 0)
        return plain(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", counted)
    return seen


@pytest.mark.parametrize("size", [(3, 4, 5), (4, 4, 20), (1, 2, 2), (64, 64, 64)])
def test_parted_equals_the_whole(spark, size):
    r = np.random.default_rng(1)
    for shape, dense in (((9, 11, 13), 0.8), ((5, 20, 9), 0.97), ((6, 8, 12), 0.5)):
        mask, step = r.random(shape) < dense, (2.0, 0.7) if size[2] == 20 else (1.0, 1.0)
        d = kernels.distance_in_planes(np.pad(mask, [(0, 0), (1, 1), (1, 1)]), *step)[:, 1:-1, 1:-1]
        got = np.full(shape, -1)
        for p in flood.parted(rows(spark, mask, f=d), dict(zip("zyx", shape)), dict(zip("zyx", size))).collect():
            got[p.z, p.y, p.x] = p.region
        assert (got[mask] == first_numbers(mask, kernels.seeded(mask, step))).all() and (got[~mask] == -1).all()


def test_parted_of_nothing(spark):
    none = spark.createDataFrame([], "z long, y long, x long, f double")
    assert flood.parted(none, dict.fromkeys("zyx", 9), dict.fromkeys("zyx", 4)).count() == 0


@pytest.mark.parametrize("seam", ["x", "y", "z"])
def test_a_seam_of_packed_labels_is_not_one_task(spark, largest, seam):
    """Labels that touch each other all along a seam: the regions of the whole strip, from blocks."""
    shape = tuple(8 if a == seam else 240 if a == ("x" if seam == "z" else "z") else 9 for a in "zyx")
    z, y, x = np.indices(shape)
    label = 1 + z // 4 + 100 * (y // 4) + 10_000 * (x // 4)
    label[np.random.default_rng(2).random(shape) < 0.15] = 0
    t = rows(spark, np.ones(shape, bool), label=label.astype(np.int64)).repartition(3)
    got = np.zeros(shape, np.int64)
    for p in iterative.zip_watershed(t, seam, 4, 4, **({"side": 16} if "side" in iterative.zip_watershed.__annotations__ else {})).collect():
        got[p.z, p.y, p.x] = p.label
    mask = label > 0
    assert (got[mask] == -first_numbers(mask, kernels.seeded(mask)) - 1).all() and (got[~mask] == 0).all()
    assert 0 < largest[0] <= mask.sum() / 4


def test_covers_of_a_long_seam(spark, largest):
    """The registered query over packed labels of many planes: its SQL's rows, and no group that is the whole strip."""
    from tessera.catalogue import tables

    mask = np.ones((200, 25, 20), bool)
    z, y, x = np.indices(mask.shape)
    label = np.where(np.random.default_rng(3).random(mask.shape) < 0.2, 0, 1 + x // 5 + 4 * (y // 5) + 20 * (z // 4)).astype(np.int64)
    got = {r.z: (r.n_labelled, r.n) for r in tables.zip_covers(rows(spark, mask, label=label).repartition(4)).collect()}
    assert got == {k: (int((label[k, :, 4:16] > 0).sum()), 25 * 12) for k in range(200)}
    assert 0 < largest[0] <= (label[:, :, 5:15] > 0).sum() / 2
