"""Tiles of a made volume, with known errors of their positions, are put back."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import kernels, tiles

SIZE = {"z": 14, "y": 30, "x": 32}


def cut_up(seed=0, noise=0.0):
    """Tiles of a smooth random volume in a grid of two by three, their nominal corners, and the true ones."""
    r = np.random.default_rng(seed)
    whole = kernels.gaussian(r.normal(size=(24, 64, 90)), (1, 1.5, 1.5)) * 1000
    placed, true, rows = [], {}, []
    for k, (y, x) in enumerate((y, x) for y in (4, 26) for x in (4, 28, 52)):
        nominal = np.array((5, y, x))
        error = r.integers(-2, 3, 3) * (k > 0)
        placed.append((k, *map(int, nominal)))
        true[k] = tuple(int(v) for v in nominal + error)
        z0, y0, x0 = true[k]
        part = whole[z0 : z0 + SIZE["z"], y0 : y0 + SIZE["y"], x0 : x0 + SIZE["x"]]
        part = part + r.normal(0, noise, part.shape) if noise else part
        z, y, x = np.indices(part.shape)
        rows.append(pd.DataFrame({"tile": k, "z": z.ravel(), "y": y.ravel(), "x": x.ravel(), "v": part.ravel()}))
    return whole, pd.concat(rows), placed, true


@pytest.mark.parametrize("noise, block", [(0.0, 64), (30.0, 8)])
def test_tiles_are_put_back(spark, noise, block):
    whole, rows, placed, true = cut_up(3, noise)
    vox = spark.createDataFrame(rows)
    at = spark.createDataFrame(placed, "tile long, z long, y long, x long")
    found = tiles.links(vox, at, SIZE, {"z": 4, "y": 4, "x": 4}, block).cache()
    assert found.count() == 11
    got = tiles.positions(spark, found, at)
    assert {r.tile: (r.z, r.y, r.x) for r in got.collect()} == true
    out = tiles.fused(vox, got, SIZE).toPandas()
    back = whole[out["z"], out["y"], out["x"]]
    assert np.abs(out["v"] - back).max() < (1e-6 if not noise else 6 * noise) and np.corrcoef(out["v"], back)[0, 1] > 0.9


def test_a_wrong_link_is_dropped():
    e = {0: (0, 0, 0), 1: (1, -2, 0), 2: (0, 3, 1), 3: (-1, 0, 2), 4: (7, 7, 7)}
    pairs = [(0, 1), (0, 2), (1, 3), (2, 3), (0, 3), (1, 2)]
    right = [(a, b, tuple(p - q for p, q in zip(e[a], e[b])), 1.0) for a, b in pairs]
    wrong = [x if k != 4 else (0, 3, (9, 9, 9), 0.8) for k, x in enumerate(right)]
    for found, n in ((right, 6), (wrong, 5)):
        got, use = tiles.solved(found, [0, 1, 2, 3, 4])
        assert len(use) == n and all(np.allclose(got[k], e[k]) for k in range(4)) and not got[4].any()
    assert tiles.solved([], [1])[0][1].tolist() == [0, 0, 0]


def test_tiles_without_links_or_values_stay(spark):
    at = spark.createDataFrame([(1, 0, 0, 0), (2, 0, 0, 3), (2, 0, 0, 3), (9, 0, 0, 500)], "tile long, z long, y long, x long")
    size = {"z": 1, "y": 1, "x": 5}
    vox = spark.createDataFrame([(1, 0, 0, k, 7.0) for k in range(5)] + [(2, 0, 0, 0, None), (3, 0, 0, 0, 1.0)], "tile long, z long, y long, x long, v double")
    found = tiles.links(vox, at, size, {"z": 1, "y": 1, "x": 1})
    assert {(r.tile, r.x) for r in tiles.positions(spark, found, at).collect()} == {(1, 0), (2, 3), (9, 500)}
    assert tiles.overlaps(at, size).count() == 1 and tiles.links(vox.where("false"), at, size, {"z": 1, "y": 1, "x": 1}).count() == 0


def test_shifts_in_either_direction():
    whole = np.random.default_rng(5).normal(size=(12, 20, 24))
    for s in ((0, 0, 0), (2, -3, 1), (-1, 4, -4)):
        a = whole[4:10, 5:15, 5:19]
        b = whole[tuple(slice(lo - k, hi - k) for lo, hi, k in zip((4, 5, 5), (10, 15, 19), s))]
        assert tiles.shift_between(a, b, (3, 5, 5)) == (s, pytest.approx(1))
    assert tiles.shift_between(np.full((2, 3, 3), np.nan), np.ones((2, 3, 3)), (1, 1, 1)) == ((0, 0, 0), 0.0)
