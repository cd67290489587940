"""A moved volume is moved back."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import kernels, registration


def smooth(shape, seed):
    return kernels.gaussian(np.random.default_rng(seed).normal(size=shape), (1.5, 2, 2)) * 1000


def sampled(a, at):
    """Values of an array between its voxels, NaN outside of it."""
    first = np.floor(at).astype(int)
    out, weight = np.zeros(len(at)), np.zeros(len(at))
    for corner in np.ndindex(2, 2, 2):
        q = first + corner
        w = np.prod(np.where(corner, at - first, 1 - (at - first)), axis=1)
        ok = ((q >= 0) & (q < a.shape)).all(axis=1)
        out[ok] += w[ok] * a[tuple(q[ok].T)]
        weight += np.where(ok, w, 0)
    return np.where(weight > 0.999, out, np.nan)


def table(spark, a):
    z, y, x = (c.ravel() for c in np.indices(a.shape))
    f = pd.DataFrame({"z": z, "y": y, "x": x, "v": a.ravel()})
    return spark.createDataFrame(f[np.isfinite(f["v"])])


def moved(shape, p, seed=0):
    """A fixed volume, and what it is seen as through a transform: moving[m(g)] = fixed[g], by sampling with the inverse; values turned round too."""
    fixed = smooth(shape, seed)
    m = registration.matrix(np.array(p), (np.array(shape) - 1) / 2)
    g = np.stack([c.ravel() for c in np.indices(shape)], 1).astype(float)
    back = (g - m[:, 3]) @ np.linalg.inv(m[:, :3]).T
    return fixed, 500 - sampled(fixed, back).reshape(shape), m


def off(found, true, shape):
    """How far apart both take the voxels of a volume, at most."""
    g = np.stack([c.ravel() for c in np.indices(shape)], 1)
    d = (g @ found[:, :3].T + found[:, 3]) - (g @ true[:, :3].T + true[:, 3])
    return np.linalg.norm(d, axis=1).max()


@pytest.mark.parametrize("kind, p", [("rigid", [0.12, 0.03, -0.05, 0.7, -2.5, 3.2]), ("affine", [0.08, 0, 0.02, 0, 2, -1.5, 0, 0.06, -0.05, 0, 0.02, 0.06])])
def test_a_moved_volume_is_moved_back(spark, kind, p):
    shape = (16, 40, 44)
    fixed, moving, true = moved(shape, p)
    one, two = table(spark, fixed), table(spark, moving)
    found, top = registration.registered(one, two, kind, levels=(2, 1))
    assert top > 0.5 and off(found, true, shape) < 1.0 < off(np.hstack([np.eye(3), np.zeros((3, 1))]), true, shape)
    back = registration.resampled(one, two, found).toPandas()
    assert np.corrcoef(back["v"], fixed[back["z"], back["y"], back["x"]])[0, 1] < -0.95


def test_steps_over_all_tasks_score_as_one_task_does(spark):
    shape = (4, 12, 14)
    fixed, moving, _ = moved(shape, [0.05, 0, 0, 0, 1, -1])
    moving = np.where(np.isnan(moving), 0, moving)
    one, two = table(spark, fixed), table(spark, moving)
    ends = [(float(a.min()), float(a.max())) for a in (fixed, moving)]
    ms = [registration.matrix(np.array(q), np.array([1.5, 5.5, 6.5])) for q in ([0.0], [0.05, 0, 0, 0, 1, -1], [0, 0.1, 0, 0.3, 0.4, 0.5, 0.1])]
    far = registration._scorer(one, two, ends, 8)(ms)
    places = np.stack([c.ravel() for c in np.indices(shape)], 1).astype(float)
    own, dense = registration._bins(fixed.ravel(), *ends[0], 8), registration._bins(moving, *ends[1], 8)
    for m, j in zip(ms, far):
        assert np.allclose(j, registration.joint_in_one_task(places, own, dense, m, 8))
    assert registration.registered(one, two, "shift", levels=(1,), alone=0, least=0.6)[0].shape == (3, 4)


def test_pairs_of_small_blocks_score_as_one_task_does(spark, monkeypatch):
    """Also where blocks are cut below zero, and where a block comes to places that the moving volume has not got."""
    monkeypatch.setattr(registration, "SIDE", 4)
    shape, away = (5, 12, 14), np.array([-3, -7, 40])
    fixed, moving, _ = moved(shape, [0.05, 0, 0, 0, 1, -1])
    moving = np.where(np.isnan(moving), 0, moving)
    one, two = (table(spark, a).select(*((F.col(n) + int(d)).alias(n) for n, d in zip("zyx", away)), "v") for a in (fixed, moving))
    ends = [(float(a.min()), float(a.max())) for a in (fixed, moving)]
    ms = [registration.matrix(np.array(q), np.array([2.0, 5.5, 6.5]) + away) for q in ([0.0], [0, 0, 0, 0, 2, -1], [0.05, 0.1, 0, 0.3, 0.4, 30.0], [0, 0.1, 0, 0.3, 0.4, 0.5, 0.1])]
    joints = registration._scorer(one, two, ends, 8)(ms)
    places = np.stack([c.ravel() for c in np.indices(shape)], 1) + away
    own, dense = registration._bins(fixed.ravel(), *ends[0], 8), registration._bins(moving, *ends[1], 8)
    for m, j in zip(ms, joints):
        assert np.allclose(j, registration.joint_in_one_task(places, own, dense, np.hstack([m[:, :3], (m[:, 3] - away)[:, None]]), 8))
    met = registration._meetings(np.array([0, 0, 0]), np.array([4, 4, 4]), [registration.matrix(np.array([0, 0, 0, 0.5, 0.5, 0.5]), np.zeros(3))] * 9)
    assert set(met) == set(np.ndindex(2, 2, 2)) and all(k == [*range(9)] for k in met.values())


def test_labels_take_the_nearest_and_nothing_gives_the_identity(spark):
    labels = spark.createDataFrame([(0, 0, 0, 5), (0, 0, 1, 7)], "z long, y long, x long, label long")
    places = spark.createDataFrame([(0, 0, k) for k in range(4)], "z long, y long, x long")
    m = np.hstack([np.eye(3), [[0], [0], [-1.4]]])
    assert {r.x: r.label for r in registration.resampled(places, labels, m, 0, "label").collect()} == {1: 5, 2: 7}
    none = spark.createDataFrame([], "z long, y long, x long, v double")
    found, top = registration.registered(none, none)
    assert top == 0 and np.allclose(found, np.hstack([np.eye(3), np.zeros((3, 1))]))


def test_information_against_its_definition():
    joint = np.array([[3.0, 1.0], [0.0, 4.0]])
    p = joint / 8
    want = sum(p[i, j] * np.log(p[i, j] / (p[i].sum() * p[:, j].sum())) for i in range(2) for j in range(2) if p[i, j])
    assert registration.information(joint) == pytest.approx(want) and registration.information(np.zeros((2, 2))) == 0
