"""Kernels, iterative operators and tables against small cases with known answers."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import maths, naming
from tessera.operators import blocks, correct, equalize, iterative, kernels, objects, profile, stencil
from tessera.runtime import components


def table(spark, array, name="v"):
    z, y, x = np.indices(array.shape)
    return spark.createDataFrame(pd.DataFrame({"z": z.ravel(), "y": y.ravel(), "x": x.ravel(), name: array.ravel()}))


def array(df, shape, name):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.z, r.y, r.x] = r[name]
    return out


def test_tiny_cube(spark):
    v = np.arange(64).reshape(4, 4, 4)
    t = table(spark, v).withColumn("label", F.when(F.col("z") < 2, 1).otherwise(2).cast("long"))
    one, two = objects.regions(t).orderBy("label").collect()
    assert (one.area, one.centroid_z, one.centroid_y, one.centroid_x) == (32, 0.5, 1.5, 1.5)
    assert [two[f"bbox_{a}"] for a in ("z0", "z1", "y0", "y1", "x0", "x1")] == [2, 4, 0, 4, 0, 4]
    means = [r.mean_intensity for r in objects.intensities(t).orderBy("label").collect()]
    assert means == [15.5, 47.5]


def test_inertia_against_numpy(spark):
    r = np.random.default_rng(0)
    mask = r.random((6, 7, 8)) < 0.4
    t = table(spark, mask.astype(int), "label")
    got = objects.inertia(t).first()
    p = np.argwhere(mask).astype(float)
    p -= p.mean(axis=0)
    m = p.T @ p / len(p)
    want = np.linalg.eigvalsh(np.trace(m) * np.eye(3) - m)[::-1]
    assert np.allclose([got.eig0, got.eig1, got.eig2], want)


def test_equal_eigenvalues_and_a_single_voxel(spark):
    t = spark.createDataFrame([(0.0, 0.0, 0.0), (2.0, 2.0, 2.0)], "a double, b double, c double")
    got = t.select(maths.anisotropy(F.col("a"), F.col("b"), F.col("c")).alias("fa")).collect()
    assert got[0].fa is None and got[1].fa == pytest.approx(0)
    one = table(spark, np.ones((1, 1, 1), int), "label")
    assert objects.inertia(one).first().eig0 == pytest.approx(0)


def test_euler_numbers(spark):
    box = np.zeros((5, 5, 5), int)
    box[1:4, 1:4, 1:4] = 1
    hollow = box.copy()
    hollow[2, 2, 2] = 0
    ring = np.zeros((3, 5, 5), int)
    ring[1, 1:4, 1:4] = 1
    ring[1, 2, 2] = 0
    for a, want in ((box, 1), (hollow, 2), (ring, 0)):
        assert objects.euler_number(table(spark, a, "label")).first().euler_number == want


def test_ragged_grid():
    assert [b[0] for b in blocks.bounds(25, 10)] == [0, 10, 20]
    assert [b[2:] for b in blocks.bounds(25, 10, 2)] == [(0, 12), (8, 22), (18, 25)]
    assert blocks.bounds(25, 10, shift=True)[-1][:2] == (15, 25)
    assert blocks.bounds(25, 10, 2, truncate="margin")[0][2] == -2


@pytest.mark.parametrize("size", [3, 4, 7])
def test_components_do_not_depend_on_blocks(spark, size):
    r = np.random.default_rng(1)
    mask = r.random((6, 9, 10)) < 0.35
    t = table(spark, mask.astype(int)).where("v = 1")
    got = iterative.components(t, {"z": 6, "y": 9, "x": 10}, dict.fromkeys("zyx", size))
    want = kernels.components(mask)
    pairs = {(want[x.z, x.y, x.x], x.component) for x in got.collect()}
    assert len(pairs) == want.max() == len({b for _, b in pairs})


def test_corners_connect_only_if_asked(spark):
    a = np.zeros((2, 2, 2), bool)
    a[0, 0, 0] = a[1, 1, 1] = True
    assert kernels.components(a).max() == 2 and kernels.components(a, True).max() == 1
    t = table(spark, a.astype(int)).where("v = 1")
    n = [iterative.components(t, dict.fromkeys("zyx", 2), dict.fromkeys("zyx", 1), full).select("component").distinct().count() for full in (False, True)]
    assert n == [2, 1]


def test_graph_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "src long, dst long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100
    assert components(chain.where("false")).count() == 0


def test_fill_and_erode_and_dilate(spark):
    ring = np.zeros((1, 7, 7), bool)
    ring[0, 1:6, 1:6] = True
    ring[0, 2:5, 2:5] = False
    t = table(spark, ring, "mask")
    for size in (2, 3, 7):
        got = array(iterative.fill_holes_2d(t, {"z": 1, "y": 7, "x": 7}, dict.fromkeys("zyx", size)), ring.shape, "mask")
        assert got.sum() == 25 and (got[0] == kernels.filled(ring[0])).all()
    e = array(stencil.erode(t, stencil.disk(1)), ring.shape, "mask")
    d = array(stencil.dilate(t, stencil.disk(1)), ring.shape, "mask")
    assert (e <= ring).all() and (ring <= d).all() and e.sum() == 0


def test_gaussian_over_blocks_equals_the_whole(spark):
    a = np.random.default_rng(2).integers(0, 100, (9, 11, 12))
    m = kernels.margin_of(0.8)
    got = kernels.by_block(table(spark, a), dict(zip("zyx", a.shape)), {"z": 5, "y": 4, "x": 6}, m, lambda b: kernels.gaussian(b, (0.8,) * 3))
    assert np.allclose(array(got, a.shape, "out"), kernels.gaussian(a, (0.8,) * 3))


def test_distance_and_watershed():
    m = np.ones((1, 5, 9), bool)
    m[0, 2, 4] = False
    y, x = np.indices((5, 9))
    assert np.allclose(kernels.distance_in_planes(m, 2, 1)[0], np.hypot(2 * (y - 2), x - 4))
    image = np.array([[[0, 1, 2, 1, 0]]])
    seeds = np.array([[[1, 0, 0, 0, 2]]])
    w = kernels.watershed(image, seeds, np.ones_like(image, bool))
    assert set(w.ravel()) == {1, 2} and w[0, 0, 1] == 1 and w[0, 0, 3] == 2


def test_truth_and_segments(spark):
    t = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 2), (3, 2), (0, 3)], "label long, truth long")
    s = objects.detection(objects.matches(t)).first()
    assert (s.tp, s.fp, s.fn, s.oversegmented, s.undersegmented) == (2, 1, 1, 1, 1)
    assert s.precision == s.recall == pytest.approx(2 / 3)
    for r in objects.contingency(t).collect():
        assert r.jaccard == pytest.approx(r.dice / (2 - r.dice))


def test_otsu_parts_two_modes(spark):
    v = [100 + k % 7 for k in range(600)] + [900 + k % 7 for k in range(400)]
    hist = correct.histogram(spark.createDataFrame([(x,) for x in v], "v long"))
    cut = 100 + (correct.otsu_bin(hist).first().bin + 1) * 806 / 256
    assert 106 < cut <= 900


def test_no_noise_pixels(spark):
    p = spark.createDataFrame([("a", 50), ("a", 80)], "s string, v long")
    r = equalize.segment_metrics(p, ("s",), 10, 40, 70, 100).first()
    assert (r.noise_sd, r.cnr, r.snr, r.contrast) == (0.0, 0.0, None, 1.6)


def test_forward_map_keeps_background_and_takes_the_last_row(spark):
    vox = spark.createDataFrame([(0,), (1,), (2,)], "label long")
    m = spark.createDataFrame([(0, 9, 0), (1, 5, 0), (1, 6, 1)], "label long, value long, seq int")
    assert sorted((r.label, r.value) for r in objects.forward_map(vox, m).collect()) == [(0, 0), (1, 6), (2, 0)]


def test_polynomial_is_recovered(spark):
    pts = spark.createDataFrame([(float(x), 2 + 3 * x - 0.5 * x * x + 0.01 * x**3) for x in range(20)], "x double, y double")
    assert np.allclose(correct.polyfit(pts, "x", "y", 3), [2, 3, -0.5, 0.01], atol=1e-6)


def test_relabelled_blocks_share_no_label(spark):
    vox = spark.createDataFrame([(b, l) for b in range(3) for l in (0, 1, 2)], "block int, label long")
    got = objects.relabel_blocks(vox).where("label > 0")
    assert got.count() == got.select("label").distinct().count() == 6
    assert objects.relabel_blocks(vox).where("label = 0").count() == 3


def test_names_and_bounds(spark):
    from tessera.plans import steps

    assert naming.filled("a_{c:03d}_{d}", c=4) == "a_004_{d}"
    assert steps.parsed_bound("np.inf") == math.inf and steps.parsed_bound("-np.inf") == -math.inf
    with pytest.raises(ValueError):
        steps.parsed_bound("__import__('os')")
    with pytest.raises(ValueError):
        steps.run({}, {"unknown": {}})
    assert len(steps.grid(a=[1, 2], b=[3, 4, 5])) == 6


def test_rotation_is_orthogonal():
    r = np.array(maths.rotation(30, 40, 50))
    assert np.allclose(r @ r.T, np.eye(3))
    assert np.allclose(np.array(maths.affine((1, 2, 3), (0, 0, 0), (2, 2, 2))), [[2, 0, 0, 1], [0, 2, 0, 2], [0, 0, 2, 3], [0, 0, 0, 1]])


def test_communities_and_neighbours(spark):
    two = [(a, b) for base in (0, 10) for a in range(base, base + 5) for b in range(a + 1, base + 5)]
    got = {r.node: r.community for r in profile.communities(spark.createDataFrame(two, "src long, dst long")).collect()}
    assert len({got[i] for i in range(5)}) == 1 and len({got[i] for i in range(10, 15)}) == 1 and got[0] != got[10]
    x = np.random.default_rng(3).normal(size=(50, 4))
    v = spark.createDataFrame([(i, x[i].tolist()) for i in range(50)], "id long, v array<double>")
    d = np.linalg.norm(x[:, None] - x, axis=2)
    np.fill_diagonal(d, np.inf)
    for r in profile.knn(v, 3, block=20).collect():
        assert r.other == np.argsort(d[r.id])[r["rank"] - 1]


def test_communities_in_one_task_and_over_all(spark):
    r = np.random.default_rng(5)
    edges = {(int(a), int(b)) for base in (0, 12, 24) for a, b in r.integers(base, base + 12, (50, 2)) if a < b} | {(3, 15), (20, 30)}
    e = spark.createDataFrame(sorted(edges), "src long, dst long")
    one = {r.node: r.community for r in profile.communities(e).collect()}
    far = {r.node: r.community for r in profile.communities(e, alone=0).collect()}
    assert one == far and 2 <= len(set(one.values())) <= 5
    names = profile.numbered_communities(profile.communities(e)).collect()
    assert {r.cluster for r in names} == {str(k + 1) for k in range(len(set(one.values())))}
    finer = {r.community for r in profile.communities(e, resolution=4.0).collect()}
    assert len(finer) > len(set(one.values()))


def test_diffusion_map_against_numpy(spark):
    r = np.random.default_rng(6)
    edges = sorted({(i, i + 1) for i in range(24)} | {(int(a), int(b)) for a, b in r.integers(0, 25, (16, 2)) if 0 < b - a < 9})
    n = 25
    a = np.zeros((n, n))
    for i, j in edges:
        a[i, j] = a[j, i] = 1
    d = a.sum(axis=1)
    w, v = np.linalg.eigh(a / np.sqrt(d[:, None] * d))
    order = np.argsort(-w)[1:3]
    want = v[:, order] / np.sqrt(d)[:, None] * w[order] / 1.0
    want *= np.sign(want[np.abs(want).argmax(axis=0), range(2)])
    got = {x.node: x.dc for x in profile.diffusion_map(spark.createDataFrame(edges, "src long, dst long"), 2, tolerance=1e-6).collect()}
    assert np.allclose([got[i] for i in range(n)], want, atol=0.03)
    time = {x.node: x.time for x in profile.diffusion_pseudotime(spark.createDataFrame([*edges, (40, 41)], "src long, dst long"), 0, 2).collect()}
    assert time[0] == 0 and time[41] == 0 and max(time.values()) == 1 and time[24] > time[4]


def test_steps_go_on_to_the_last_node(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)], "src long, dst long")
    assert {r.node: r.steps for r in profile.pseudotime(chain, 0).collect()} == {i: i for i in range(71)}


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], "id long, v array<double>, x double, y double")
    assert profile.pca(empty).count() == 0 and profile.communities(empty.selectExpr("id as src", "id as dst")).count() == 0
    assert correct.polyfit(empty, "x", "y", 2) == [0.0, 0.0, 0.0]
    two = spark.createDataFrame([(1.0, 5.0), (2.0, 7.0), (2.0, 7.0)], "x double, y double")
    assert np.allclose(correct.polyfit(two, "x", "y", 3), [3, 2, 0, 0])


def test_extent_of_a_distance():
    assert [stencil.odd_extent(*x) for x in ((3, 1), (5, 1), (2.5, 1), (0, 1), (3, 2))] == [7, 11, 7, 1, 5]


def test_the_last_ranges_of_a_name_count(spark):
    names = ["vol_00001-00002_00003-00004_00005-00006.h5", "/a/00009-00010/run_00007-00008_00001-00002_00003-00004_00005-00006.h5", "none.h5"]
    got = spark.createDataFrame([(n,) for n in names], "name string").select(*naming.coordinates("name", (1, 0, -1)), naming.stem("name").alias("stem")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 4, 6, 7, "vol"), (0, 1, 3, 4, 6, 7, "run_00007-00008"), (None,) * 6 + ("none",)]


def test_mean_of_channels(spark):
    rows = [(0, 0, x, c, v) for x, vs in enumerate([(1, 2), (5, 5), (7, 10)]) for c, v in enumerate(vs)]
    got = correct.channel_mean(spark.createDataFrame(rows, "z int, y int, x int, c int, v long")).collect()
    assert {r.x: r.m for r in got} == {0: 1, 1: 5, 2: 8}


def test_regions_over_blocks_are_those_of_the_whole(spark):
    """Flooded blocks, stitched, against the whole volume at once."""
    r = np.random.default_rng(7)
    z, y, x = np.indices((6, 24, 30))
    centres = [(3, 4, 4), (3, 5, 15), (2, 18, 6), (3, 17, 24), (3, 11, 14)]
    a = np.max([900 - 150 * np.sqrt((z - c) ** 2 + (y - d) ** 2 + (x - e) ** 2) for c, d, e in centres], axis=0).clip(0).astype(int)
    kernel = lambda b: kernels.flooded(b, kernels.components(b > 700), b > 100, invert=True)
    whole = kernel(a)
    got = array(kernels.regions_by_block(table(spark, a), dict(zip("zyx", a.shape)), {"z": 6, "y": 10, "x": 10}, 5, kernel), a.shape, "region")
    assert ((got > 0) == (whole > 0)).all()
    pairs = {(p, q) for p, q in zip(whole.ravel().tolist(), got.ravel().tolist()) if p}
    assert len(pairs) == len(centres) == len({q for _, q in pairs})


def test_flooding_options():
    image = np.array([[[5, 1, 4, 0, 6, 2, 2]]])
    seeds = np.array([[[0, 1, 0, 0, 0, 2, 0]]])
    on = np.ones_like(image, bool)
    assert kernels.flooded(image, seeds).ravel().tolist() == [1, 1, 1, 1, 1, 2, 2]
    negative = np.array([[[True, True, True, False, True, True, True]]])
    assert kernels.flooded(image, seeds, negative=negative).ravel().tolist() == [1, 1, 1, 3, 3, 2, 2]
    assert kernels.flooded(image, seeds, post=image > 1).ravel().tolist() == [1, 0, 1, 0, 1, 2, 2]
    flat = np.zeros((1, 1, 9))
    two = np.array([[[1, 0, 0, 0, 0, 0, 0, 0, 2]]])
    assert kernels.flooded(flat, two, compactness=1.0).ravel().tolist() == [1] * 5 + [2] * 4
    assert kernels.flooded(image, seeds, on & (image != 4)).ravel().tolist() == [1, 1, 0, 2, 2, 2, 2]
    holes = np.array([[[0, 1, 1, 1, 0, 1, 0]]])
    assert kernels.flooded(holes, seeds, edt=True, spacing=(1.0, 1.0, 2.0)).shape == (1, 1, 7)


def test_seeds_and_blobs():
    y, x = np.indices((21, 41))
    mask = (((y - 10) ** 2 + (x - 10) ** 2 <= 64) | ((y - 10) ** 2 + (x - 30) ** 2 <= 64) | ((abs(y - 10) < 2) & (x > 10) & (x < 30)))[None]
    data = np.where(mask, 100.0, 0.0)
    for options in ({"threshold": 4.0}, {"peak": (1, 4.0)}, {"threshold": 4.0, "dog": (1.0, 2.0)}):
        s = kernels.seeds_of(data, mask, (1.0, 1.0, 1.0), **options)
        assert s[0, 10, 10] != s[0, 10, 30] and s[0, 10, 10] and s[0, 10, 30] and s[0, 10, 20] == 0
    full = kernels.seeds_of(data, mask, (1.0, 1.0, 1.0), threshold=4.0, flood=0.0)
    assert (full[mask] > 0).all() and set(np.unique(full)) == {0, 1, 2}
    assert kernels.seeds_of(data, mask, (1.0, 1.0, 1.0), above=4.0, threshold=0.0)[0, 10, 10] == 0
    z, y, x = np.indices((21, 21, 41))
    a = sum(1000 * np.exp(-((z - 10) ** 2 + (y - 10) ** 2 + (x - c) ** 2) / (2 * s * s)) for c, s in ((10, 1.5), (30, 2.5)))
    response, sigma = kernels.log_blobs(a, (1.0, 1.5, 2.0, 2.5, 3.0), 100.0)
    assert {tuple(p) for p in np.argwhere(response)} == {(10, 10, 10), (10, 10, 30)}
    assert sigma[10, 10, 10] == 1.5 and sigma[10, 10, 30] == 2.0


def test_floods_follow_the_lowest_pass():
    r = np.random.default_rng(8)
    for _ in range(8):
        image, mask = r.permutation(6 * 7 * 5).reshape(6, 7, 5).astype(float), r.random((6, 7, 5)) < 0.85
        seeds = np.zeros(image.shape, int)
        for k in range(1, 5):
            seeds[tuple(r.integers(0, n) for n in image.shape)] = k
        got = kernels.watershed(image, seeds, mask)
        levels = np.sort(image[mask])
        best = np.full(image.shape, np.inf)
        reach = {k: np.full(image.shape, np.inf) for k in range(1, 5)}
        for level in levels:
            part = kernels.components(mask & (image <= level))
            for k, low in reach.items():
                names = np.unique(part[(seeds == k) & mask & (part > 0)])
                low[np.isin(part, names) & (part > 0) & np.isinf(low)] = level
        best = np.minimum.reduce(list(reach.values()))
        for p in map(tuple, np.argwhere(mask & (seeds == 0))):
            assert (got[p] == 0) == np.isinf(best[p]) and (got[p] == 0 or reach[got[p]][p] == best[p])


def test_distances_against_all_pairs():
    r = np.random.default_rng(9)
    for shape, dense in (((3, 7, 9), 0.4), ((1, 12, 12), 0.95), ((4, 4, 4), 1.0)):
        mask, spacing = r.random(shape) < dense, (2.0, 1.0, 0.7)
        off = np.argwhere(~mask)
        want = [np.inf if not len(off) else np.sqrt((((off - p) * spacing) ** 2).sum(axis=1).min()) for p in np.argwhere(mask)]
        assert np.allclose(kernels.distance(mask, spacing)[mask], want)


def test_numbers_in_order_over_ranges(spark):
    from tessera.runtime import numbered

    df = spark.createDataFrame([((k * 7919) % 1009,) for k in range(1009)], "k long").repartition(7)
    assert all(r.n == r.k + 1 for r in numbered(df, "n", "k").collect())
    assert numbered(df.where("false"), "n", "k").count() == 0


def test_strips_grow_with_labels(spark):
    a = np.zeros((1, 3, 40), int)
    a[0, 0, 19:22], a[0, 1, 12:21], a[0, 2, 2:38] = 1, 2, 3
    got = {r.label: r.n for r in iterative.strips(table(spark, a, "label"), "x", 20, 2, 8).collect()}
    assert got == {1: 3, 2: 4} and iterative.margins_that_fit({"y": 640, "x": 640}, 64) == 10 and iterative.margins_that_fit({"y": 100}, 64) == 1


def test_empty_block(spark):
    empty = spark.createDataFrame([], "z long, y long, x long, v long, label long, block long")
    assert objects.regions(empty).count() == 0
    assert objects.relabel_blocks(empty).count() == 0
    assert iterative.components(empty, dict.fromkeys("zyx", 4), dict.fromkeys("zyx", 2)).count() == 0


def test_seam_is_segmented_anew(spark):
    """An object cut in two by a seam becomes one; what only lies near the seam stays."""
    a = np.zeros((1, 7, 12), int)
    a[0, 1:6, 3:6], a[0, 1:6, 6:9], a[0, 0, 0] = 1, 2, 7
    got = array(iterative.zip_watershed(table(spark, a, "label"), "x", 6, 5), a.shape, "label")
    assert len(np.unique(got[0, 1:6, 3:9])) == 1 and got[0, 3, 3] < 0
    assert (got[a == 0] == 0).all()


def test_waist_parts_an_object():
    y, x = np.indices((15, 29))
    mask = (((y - 7) ** 2 + (x - 7) ** 2 <= 36) | ((y - 7) ** 2 + (x - 21) ** 2 <= 36) | ((y == 7) & (x > 7) & (x < 21)))[None]
    parts = kernels.seeded(mask, least=3.0)
    assert parts[0, 7, 7] != parts[0, 7, 21] and (parts[mask] > 0).all() and (parts[~mask] == 0).all()


def test_linear_upsampling_of_a_ramp(spark):
    low = spark.createDataFrame([(0, 0, k, float(k)) for k in range(5)], "z long, y long, x long, v double")
    got = [r.v for r in stencil.upsample_linear(low, "x", 2).orderBy("x").collect()]
    assert np.allclose(got, np.clip((np.arange(10) + 0.5) / 2 - 0.5, 0, 4))


def test_pseudotime_counts_steps(spark):
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (0, 3), (8, 9)], "src long, dst long")
    assert {r.node: r.steps for r in profile.pseudotime(e, 0).collect()} == {0: 0, 1: 1, 2: 2, 3: 1}


def test_iterative_split_reaches_all_planes(spark):
    from tessera.catalogue import segmentation

    a = np.zeros((14, 9, 9), np.int64)
    a[1:3, 2:4, 2:4] = a[6:10, 2:5, 2:5] = a[11:14, 6:8, 6:8] = 1000
    z, y, x = np.indices(a.shape)
    vox = spark.createDataFrame(pd.DataFrame({"z": z.ravel(), "y": y.ravel(), "x": x.ravel(), "v": a.ravel()}))
    number = np.arange(a.size).reshape(a.shape)
    want = {(number[1, 2, 2], 8), (number[6, 2, 2], 36), (number[11, 6, 6], 12)}
    assert {(r.component, r.n) for r in segmentation.iterative_split(vox).collect()} == want


def test_tensors_over_blocks_equal_the_whole(spark):
    from tessera.catalogue import segmentation

    a = np.random.default_rng(10).integers(0, 900, (7, 25, 20))
    got = kernels.by_block(table(spark, a), dict(zip("zyx", a.shape)), {"z": 4, "y": 9, "x": 12}, kernels.margin_of(1.6) + 2, segmentation.planarity)
    assert np.allclose(array(got, a.shape, "out"), segmentation.planarity(a), atol=1e-6)


def test_components_of_most_variance(spark):
    x = np.random.default_rng(11).normal(size=(300, 6)) * [5, 3, 2, 1, 1, 1] + 7
    v = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "id long, v array<double>").repartition(5)
    w = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[2][:3].T
    w = w * np.sign(w[np.abs(w).argmax(axis=0), range(3)])
    got = {r.id: r.pc for r in profile.pca(v).collect()}
    assert np.allclose([got[k] for k in range(300)], (x - x.mean(axis=0)) @ w)


def test_split_reaches_thin_parts(spark):
    a = np.zeros((3, 9, 24), bool)
    a[:, 1:8, 1:9] = a[:, 1:8, 15:23] = a[1, 4, 9:15] = True
    parts = iterative.split_large(table(spark, a, "mask"), dict(zip("zyx", a.shape)), {"z": 3, "y": 5, "x": 7}, [(50, 1)])
    got = array(parts.withColumn("component", F.col("component") + 1), a.shape, "component")
    assert got[1, 4, 4] != got[1, 4, 19] and got[1, 4, 4] and got[1, 4, 19] and not got[~a].any()
    whole = iterative.split_large(table(spark, a, "mask"), dict(zip("zyx", a.shape)), {"z": 3, "y": 5, "x": 7}, [])
    assert whole.select("component").distinct().count() == 1


def test_resampling_and_turning(spark):
    a = np.arange(2 * 3 * 4).reshape(2, 3, 4)
    t = table(spark, a)
    same = [[1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0]]
    for order in (0, 1):
        assert (array(stencil.resample(t, {"z": 2, "y": 3, "x": 4}, same, order=order), a.shape, "v") == a).all()
    half = [[1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 0.5, 0]]
    fine = array(stencil.resample(t, {"z": 2, "y": 3, "x": 7}, half, order=1), (2, 3, 7), "v")
    assert np.allclose(fine[..., ::2], a) and np.allclose(fine[..., 1::2], (a[..., 1:] + a[..., :-1]) / 2)
    turned = array(stencil.augmented(t, {"z": 2, "y": 3, "x": 4}, "xyz", "x"), (4, 3, 2), "v")
    assert (turned == a[:, :, ::-1].transpose(2, 1, 0)).all()
    x, y, z = (spark.range(1).select(*maths.rodrigues((F.lit(1.0), F.lit(0.0), F.lit(0.0)), (0.0, 0.0, 1.0), math.pi / 2)).first())
    assert np.allclose([x, y, z], [0, 1, 0])


def test_layouts():
    from tessera.plans import layout

    assert layout.block_size({"z": 5, "y": 9}, {"y": 4}, {"z": 2}) == {"z": 2, "y": 4} and layout.block_margin({"z": 2}) == {"z": 0}
    assert layout.defaults({"z": 9, "y": 2000, "x": 3000}) == ({"z": 9, "y": 640, "x": 640}, {"z": 0, "y": 64, "x": 64})
    assert layout.declared("zyxc", {"z": 3, "y": 4, "x": 5}, 2, "zc") == {"z": 3, "c": 2}
    assert layout.flat(layout.parameters("a: {b: 1}\nc: [2]")) == {"a.b": "1", "c": "[2]"} and layout.parameters("") == {}


def test_folders_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from tessera import runtime

    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda k: None), master="spark://host:7077", setCheckpointDir=lambda p: None)
    with pytest.raises(RuntimeError):
        runtime.shared_folder(SimpleNamespace(sparkContext=sc))
    kept = runtime.stored(spark.range(5))
    path = runtime._STORED[-1]
    runtime.clear(spark)
    import os

    assert not os.path.exists(path.removeprefix("file:")) and kept is not None


def test_holes_of_one_label_are_filled(spark):
    a = np.zeros((1, 7, 14), int)
    a[0, 1:6, 1:6], a[0, 1:6, 7:12] = 1, 2
    a[0, 3, 3] = a[0, 3, 9] = 0
    a[0, 2, 6], a[0, 4, 6], a[0, 3, 12] = 1, 2, 2
    a[0, 3, 11] = 0
    got = array(iterative.fill_label_holes(table(spark, a, "label"), dict(zip("zyx", a.shape)), dict.fromkeys("zyx", 4)), a.shape, "label")
    want = a.copy()
    want[0, 3, 3], want[0, 3, 9], want[0, 3, 11] = 1, 2, 2
    assert (got == want).all() and got[0, 3, 6] == 0
