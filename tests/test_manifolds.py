"""Eigenvectors, communities, branches, layouts and bias fields against numpy and made cases."""

import numpy as np
import oracle
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera import catalogue
from tessera.operators import biasfield, graphs, near, profile, umap


def edges_of(spark, pairs, weights=None):
    rows = [(int(a), int(b), float(w)) for (a, b), w in zip(pairs, weights if weights is not None else [1.0] * len(pairs))]
    return spark.createDataFrame(rows, "src long, dst long, weight double")


def chain_with_bridges(n, seed):
    r = np.random.default_rng(seed)
    return sorted({(i, i + 1) for i in range(n - 1)} | {(int(a), int(b)) for a, b in r.integers(0, n, (n // 2, 2)) if 0 < b - a < 9})


def times_by_hand(pairs, root, k):
    """Pseudotime of a connected graph from all of its eigenvectors."""
    nodes = sorted({i for p in pairs for i in p})
    at = {i: j for j, i in enumerate(nodes)}
    a = np.zeros((len(nodes), len(nodes)))
    for i, j in pairs:
        a[at[i], at[j]] = a[at[j], at[i]] = 1
    d = a.sum(axis=1)
    w, v = np.linalg.eigh(a / np.sqrt(d[:, None] * d))
    w, v = w[::-1][1 : k + 1], v[:, ::-1][:, 1 : k + 1]
    far = np.sqrt((((v - v[at[root]]) * w / (1 - w)) ** 2).sum(axis=1))
    return dict(zip(nodes, far / far.max()))


@pytest.mark.parametrize("alone", [10**6, 0])
def test_diffusion_pseudotime_equals_numpy(spark, alone):
    pairs = chain_with_bridges(18, 3)
    e = edges_of(spark, [*pairs, (90, 91), (91, 92)]).drop("weight")
    got = {r.node: r.time for r in graphs.diffusion_pseudotime(e, 0, 2, alone=alone).collect()}
    want = times_by_hand(pairs, 0, 2) | {90: 0, 91: 0, 92: 0}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-5) for i in want)


def test_diffusion_values_of_the_tables_equal_numpy(spark):
    x = {r.vec_id: r.embedding for r in spark.read.parquet(f"{oracle.DATA}/embeddings.parquet").collect()}
    ids, m = sorted(x), np.array([x[i] for i in sorted(x)], float)
    d = ((m[:, None] - m) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    pairs = {(i, ids[j]) for i, row in zip(ids, d) for j in np.lexsort((ids, row))[:5]}
    want = times_by_hand(pairs, 0, 3)
    got = {r.node: r.time for r in catalogue.queries()["diffusion_values"](spark, oracle.DATA).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-4


def test_what_does_not_converge_says_so(spark):
    with pytest.raises(graphs.NotConverged):
        graphs.lanczos(lambda v: np.arange(200.0) / 200 * v, np.eye(200)[0], 3, 5, 1e-9)
    with pytest.raises(Exception, match="rounds"):
        graphs.diffusion_map(edges_of(spark, chain_with_bridges(60, 1)), 3, rounds=5).collect()


def test_diffusion_map_in_one_task_and_over_all(spark):
    e = edges_of(spark, chain_with_bridges(14, 5))
    one, far = ({r.node: r.dc for r in graphs.diffusion_map(e, 2, alone=a).collect()} for a in (10**6, 0))
    assert all(np.allclose(one[i], far[i], atol=1e-5) for i in range(14))
    two = graphs.diffusion_map(edges_of(spark, [(1, 2)]), 3).collect()
    assert sorted(r.node for r in two) == [1, 2] and all(len(r.dc) == 3 and r.dc[1:] == [0, 0] for r in two)
    assert graphs.diffusion_map(edges_of(spark, [])).count() == 0


@pytest.mark.parametrize("alone", [10**6, 0])
def test_steps_from_a_root(spark, alone):
    e = edges_of(spark, [(0, 1), (1, 2), (2, 1), (5, 6), (3, 3)]).unionByName(spark.createDataFrame([(None, 1, 1.0)], "src long, dst long, weight double"))
    assert {r.node: r.steps for r in graphs.pseudotime(e, 0, alone).collect()} == {0: 0, 1: 1, 2: 2}
    assert graphs.pseudotime(e, 77, alone).count() == 0


# communities


def modularity(pairs, label):
    k = {}
    for a, b in pairs:
        k[a], k[b] = k.get(a, 0) + 1, k.get(b, 0) + 1
    m = 2 * len(pairs)
    held = {}
    for i, n in k.items():
        held[label[i]] = held.get(label[i], 0) + n
    return 2 * sum(label[a] == label[b] for a, b in pairs) / m - sum(n * n for n in held.values()) / m / m


def are_connected(pairs, label):
    up = {i: i for i in label}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        if label[a] == label[b]:
            up[top(a)] = top(b)
    return len({top(i) for i in label}) == len(set(label.values()))


def planted(groups, size, inside, across, seed):
    r = np.random.default_rng(seed)
    out = set()
    for i in range(groups * size):
        for j in range(i + 1, groups * size):
            if r.random() < (inside if i // size == j // size else across):
                out.add((i, j))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_leiden_is_connected_and_no_worse_than_moves_alone(spark, seed):
    pairs = planted(6, 20, 0.25, 0.02, seed)
    src, dst = np.array([*pairs, *((b, a) for a, b in pairs)]).T
    nodes, old = profile._settled(src, dst, 1.0, 2)
    got = {r.node: r.community for r in graphs.leiden(edges_of(spark, pairs)).collect()}
    assert are_connected(pairs, got) and modularity(pairs, got) >= modularity(pairs, dict(zip(nodes, old))) - 1e-9
    assert all(min(i for i in got if got[i] == c) == c for c in got.values())


def test_leiden_finds_planted_groups_and_weights_count(spark):
    pairs = planted(4, 15, 0.7, 0.02, 9)
    got = {r.node: r.community for r in graphs.leiden(edges_of(spark, pairs)).collect()}
    assert {frozenset(i for i in got if got[i] == c) for c in got.values()} == {frozenset(range(15 * g, 15 * g + 15)) for g in range(4)}
    square = [(0, 1), (1, 2), (2, 3), (3, 0)]
    for heavy in (0, 1):
        w = [5.0 if k % 2 == heavy else 1.0 for k in range(4)]
        got = {r.node: r.community for r in graphs.leiden(edges_of(spark, square, w)).collect()}
        assert got[0] == (got[1] if heavy == 0 else got[3]) and len(set(got.values())) == 2
    assert graphs.leiden(edges_of(spark, [])).count() == 0


def test_leiden_over_all_tasks(spark):
    pairs = planted(3, 6, 0.9, 0.03, 2)
    got = {r.node: r.community for r in graphs.leiden(edges_of(spark, pairs), alone=20, patience=1).collect()}
    assert are_connected(pairs, got) and modularity(pairs, got) > 0.5 and len(set(got.values())) == 3


def test_a_level_keeps_what_single_nodes_cannot_improve():
    """Two cliques held together by moves of single nodes come apart on the level of parts."""
    pairs = [(a, b) for base in (0, 6) for a in range(base, base + 6) for b in range(a + 1, base + 6)] + [(0, 6)]
    src, dst = np.array(sorted([*pairs, *((b, a) for a, b in pairs)])).T
    w, k = np.ones(len(src)), np.bincount(src).astype(float)
    label = graphs._leiden(src, dst, w, k, np.zeros(12, int), 1.0, 2)
    assert len(set(label[:6])) == 1 and len(set(label[6:])) == 1 and label[0] != label[6]


# branches


def fork(seed=0, n=40):
    r = np.random.default_rng(seed)
    stem = [(s, 0.0) for s in np.linspace(0, 1, n)]
    arms = [(1 + s * 0.8, side * s * 0.6) for side in (1, -1) for s in np.linspace(0.03, 1, n)]
    x = np.array(stem + arms) + r.normal(0, 0.01, (3 * n, 2))
    d = np.linalg.norm(x[:, None] - x, axis=2)
    np.fill_diagonal(d, np.inf)
    pairs = sorted({(min(i, int(j)), max(i, int(j))) for i in range(3 * n) for j in np.argsort(d[i])[:5]})
    return pairs, [d[p] for p in pairs], np.repeat([0, 1, 2], n), np.array([s for s, _ in stem + arms])


def test_a_fork_has_three_branches(spark):
    pairs, lengths, true, along = fork()
    got = graphs.branches(edges_of(spark, [*pairs, (900, 901)], [*lengths, 1.0]), 0, 50).toPandas().set_index("node")
    assert tuple(got.loc[900]) == (0, 0)
    got = got.drop([900, 901]).sort_index()
    assert got["time"][0] == 0 and np.corrcoef(got["time"], along)[0, 1] > 0.98
    table = pd.crosstab(true, got["branch"].to_numpy()).to_numpy()
    assert table.shape == (3, 3) and table.max(axis=1).sum() >= 0.9 * len(true) and sorted(table.argmax(axis=1)) == [0, 1, 2] and table[0].argmax() == 0


def test_a_line_has_one_branch(spark):
    got = graphs.branches(edges_of(spark, [(i, i + 1) for i in range(40)]), 0, 20).toPandas()
    assert (got["branch"] == 1).all() and got.sort_values("node")["time"].is_monotonic_increasing
    assert {(r.time, r.branch) for r in graphs.branches(edges_of(spark, [(1, 2)]), 7).collect()} == {(0.0, 0)}


def test_distances_in_one_task_and_over_all(spark):
    pairs, lengths, *_ = fork(3, 8)
    e = edges_of(spark, [*pairs, (700, 701), (0, 1)], [*lengths, 1.0, 99.0])
    one, far = ({r.node: r.d for r in graphs.distances(e, [0, 5, 700], a).collect()} for a in (10**6, 0))
    n, d = 24, np.full((24, 24), np.inf)
    for (a, b), w in zip(pairs, lengths):
        d[a, b] = d[b, a] = w
    np.fill_diagonal(d, 0)
    for k in range(n):
        d = np.minimum(d, d[:, [k]] + d[[k]])
    for i in range(n):
        assert one[i] == pytest.approx([d[i, 0], d[i, 5], np.inf]) and far[i] == pytest.approx(one[i])
    assert one[701] == far[701] == [np.inf, np.inf, 1.0]


# neighbours


def recall(x, rows, k):
    d = np.linalg.norm(x[:, None] - x, axis=2)
    np.fill_diagonal(d, np.inf)
    least = np.sort(d, axis=1)[:, k - 1]
    assert all(r.distance == pytest.approx(d[r.id, r.other]) for r in rows)
    return np.mean([d[r.id, r.other] <= least[r.id] + 1e-9 for r in rows])


def test_neighbours_without_all_pairs(spark):
    x, _ = clusters(5, 12, 50)
    got = near.neighbours(table_of(spark, x), 6, block=60).collect()
    assert len(got) == 600 * 6 and len({(r.id, r.other) for r in got}) == len(got) and recall(x, got, 6) >= 0.95
    x = np.array([r.embedding for r in spark.read.parquet(f"{oracle.DATA}/embeddings.parquet").orderBy("vec_id").collect()], float)
    assert recall(x, catalogue.queries()["knn_graph"](spark, oracle.DATA).collect(), 5) >= 0.8


def test_neighbours_of_copies_and_of_few_rows(spark):
    x = np.concatenate([np.tile([1.0, 2.0], (150, 1)), np.random.default_rng(6).normal(size=(60, 2))])
    got = near.neighbours(table_of(spark, x), 3, block=40).collect()
    assert len(got) == 210 * 3 and all(r.distance == 0 for r in got if r.id < 150) and all(r.id != r.other for r in got)
    few = near.neighbours(table_of(spark, x[150:153]).unionByName(spark.createDataFrame([(9, None)], "id long, v array<double>")), 5).collect()
    assert sorted((r.id, r["rank"]) for r in few) == [(i, k) for i in range(3) for k in (1, 2)]
    assert near.neighbours(table_of(spark, x[:0]), 3).count() == near.neighbours(table_of(spark, x[:1]), 3).count() == 0


# layouts


def clusters(seed=1, k=4, per=40, width=12):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(k, width)) * 5
    return np.concatenate([r.normal(size=(per, width)) + c for c in centre]), np.repeat(range(k), per)


def table_of(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")


def kept_neighbours(places, label, k=10):
    d = np.linalg.norm(places[:, None] - places, axis=2)
    np.fill_diagonal(d, np.inf)
    return (label[np.argsort(d, axis=1)[:, :k]] == label[:, None]).mean()


@pytest.mark.parametrize("alone, epochs", [(10**6, 200), (0, 12)])
def test_layout_keeps_neighbours(spark, alone, epochs):
    x, label = clusters()
    v = table_of(spark, x)
    found = profile.knn(v, 10)
    got = {r.node: r.place for r in umap.umap(v, found, epochs=epochs, alone=alone).collect()}
    places = np.array([got[i] for i in range(len(x))])
    assert places.shape == (len(x), 2) and np.isfinite(places).all() and kept_neighbours(places, label) >= 0.9
    assert got == {r.node: r.place for r in umap.umap(v, found, epochs=epochs, alone=alone).collect()}


def test_new_rows_are_placed_among_their_own(spark):
    x, label = clusters(2)
    v = table_of(spark, x)
    train, test = v.where("id % 2 = 0"), v.where("id % 2 = 1")
    layout = umap.umap(train, profile.knn(train, 8), epochs=150)
    home = {r.node: np.array(r.place) for r in layout.collect()}
    for r in umap.placed(profile.knn(test, 5, among=train), layout).collect():
        assert label[min(home, key=lambda i: np.linalg.norm(home[i] - r.place))] == label[r.node]


def test_memberships_against_plain_python(spark):
    d = np.array([[0.0, 1.0, 2.0, 4.0], [0.5, 0.5, 0.5, 0.5], [0.0, 0.0, 0.0, 0.0]])
    known = np.ones((3, 4), bool)
    rho, sigma = umap.smooth(d, known)
    assert rho.tolist() == [1.0, 0.5, 0.0] and np.exp(-np.maximum(d[0] - 1, 0) / sigma[0]).sum() == pytest.approx(2)
    a, b = umap.curve(0.1)
    assert (a, b) == pytest.approx((1.577, 0.895), abs=2e-3)
    given = spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, 3, 2.0), (2, 1, 1, 1.0)], "id long, rank int, other long, distance double")
    g = {(r.src, r.dst): r.weight for r in umap.fuzzy_graph(given).collect()}
    assert g[1, 2] == g[2, 1] == pytest.approx(1) and g[1, 3] == g[3, 1] <= 1 and len(g) == 4


def test_rows_far_along_an_axis_are_left_out(spark):
    x, _ = clusters(3, 3, 20)
    v = table_of(spark, x)
    find = lambda rows: profile.knn(rows, 5)
    whole = {r.node: r.place[0] for r in umap.umap(v, find(v), epochs=50).collect()}
    kept, layout = umap.without_far(v, find, 2.0, epochs=50)
    ids = {r.id for r in kept.collect()}
    assert ids == {i for i, a in whole.items() if a < 2.0} == {r.node for r in layout.collect()} and 0 < len(ids) < len(x)
    none = table_of(spark, x[:0])
    assert umap.umap(none, profile.knn(none, 3)).count() == 0


# bias fields


def shaded(size=(6, 24, 32), seed=0):
    r = np.random.default_rng(seed)
    z, y, x = np.meshgrid(*map(np.arange, size), indexing="ij")
    bias = np.exp(0.5 * np.sin(np.pi * x / size[2]) + 0.4 * np.cos(np.pi * y / size[1]) + 0.1 * z / size[0])
    true = np.where(np.sin(x * 0.9) * np.cos(y * 1.1) + np.sin(z) > 0, 1000.0, 300.0) * np.exp(r.normal(0, 0.03, size))
    return pd.DataFrame({"z": z.ravel(), "y": y.ravel(), "x": x.ravel(), "v": (true * bias).ravel(), "true": bias.ravel()}), dict(zip("zyx", size))


def off(found, true):
    q = np.asarray(found) / np.asarray(true)
    return float(np.sqrt(((q / q.mean() - 1) ** 2).mean()))


def smoothed(f, size, sigma):
    a = f["v"].to_numpy().reshape(size)
    for axis in range(3):
        k = np.exp(-0.5 * (np.arange(-3 * sigma, 3 * sigma + 1) / sigma) ** 2)
        p = np.pad(a, [(3 * sigma,) * 2 if i == axis else (0, 0) for i in range(3)], mode="edge")
        a = np.apply_along_axis(lambda q: np.convolve(q, k / k.sum(), "valid"), axis, p)
    return a.ravel()


def test_a_known_field_is_found_again(spark):
    f, size = shaded()
    vox = spark.createDataFrame(f)
    model = biasfield.fit(vox, size, levels=2, rounds=20)
    got = biasfield.biased(vox, model).orderBy("z", "y", "x").toPandas()
    best = min(off(smoothed(f, tuple(size.values()), s), f["true"]) for s in (2, 4, 6, 8))
    assert off(got["bias"], got["true"]) < 0.04 < 0.5 * best
    assert np.allclose(got["corrected"], got["v"] / got["bias"])


def test_passes_over_all_tasks_give_the_same_field(spark):
    f, size = shaded((3, 16, 20), 1)
    vox = spark.createDataFrame(f).repartition(3).withColumn("bias", F.lit("kept name"))
    one, far = (biasfield.fit(vox, size, levels=2, points={"z": 4}, rounds=3, alone=a) for a in (10**6, 0))
    assert one.spans == far.spans == (2, 4, 4) and np.allclose(one.points, far.points, atol=1e-6)
    high = spark.createDataFrame(f.assign(y=2 * f["y"], x=2 * f["x"]))
    wide = biasfield.biased(high, one, {"z": 3, "y": 32, "x": 40}).toPandas()["bias"]
    assert np.abs(np.log(wide.to_numpy() / biasfield.biased(spark.createDataFrame(f), one).toPandas()["bias"].to_numpy())).max() < 0.15


def test_splines_stay_the_same_on_twice_the_spans():
    r = np.random.default_rng(4)
    points, places = r.normal(size=4 * 5 * 6), [r.random(200) for _ in range(3)]
    assert np.allclose(biasfield.valued(points, places, (1, 2, 3)), biasfield.valued(biasfield.refined(points, (1, 2, 3)), places, (2, 4, 6)))
    assert np.allclose(biasfield.valued(np.ones(120), places, (1, 2, 3)), 1)


def test_nothing_to_fit(spark):
    f, size = shaded((2, 4, 4))
    vox = spark.createDataFrame(f)
    flat = vox.withColumn("v", F.lit(7.0)).unionByName(vox.withColumn("v", F.lit(None).cast("double"))).unionByName(vox.withColumn("v", F.lit(0.0)))
    for rows in (vox.where("false"), flat):
        model = biasfield.fit(rows, size)
        got = biasfield.biased(rows, model).collect()
        assert all(r.bias == pytest.approx(1) for r in got) and len(got) == rows.count()


# exact neighbours at size


def test_exact_neighbours_far_from_the_origin_and_of_copies(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 8)).round(3)
    x[50:90] = x[7]
    for far, block in ((0.0, 64), (1e8, None)):
        moved = x + far
        d = np.sqrt(((moved[:, None] - moved) ** 2).sum(axis=2))
        np.fill_diagonal(d, np.inf)
        want = {i: [int(j) for j in np.lexsort((np.arange(300), d[i]))[:5]] for i in range(300)}
        got = {}
        for row in profile.knn(table_of(spark, moved), 5, block).orderBy("id", "rank").collect():
            got.setdefault(row.id, []).append(row.other)
            assert row.distance == d[row.id, row.other]
        assert got == want


def test_a_row_is_sent_a_few_times_however_many_there_are():
    assert profile.BLOCK >= 32_768 >= 16 * profile.TILE
    r = np.random.default_rng(6)
    p, q = r.normal(size=(1100, 4)), r.normal(size=(2500, 4))
    i, j, d = profile._near(p, np.arange(1100), q, np.arange(5000, 7500), 3)
    want = np.sqrt(((p[:, None] - q) ** 2).sum(axis=2))
    assert (np.bincount(i) == 3).all() and np.allclose(d.reshape(1100, 3), np.sort(want, axis=1)[:, :3])


def test_a_layout_of_many_parts_keeps_neighbours_in_few_rounds(spark, monkeypatch):
    x, label = clusters()
    v, rounds = table_of(spark, x), []
    graph = umap.fuzzy_graph(profile.knn(v, 10))
    start = profile.pca(v, 2).selectExpr("id as node", "transform(pc, x -> x) as place")
    moving = umap._moving
    monkeypatch.setattr(umap, "_moving", lambda *how: (rounds.append(how[1:3]), moving(*how))[1])
    got = {r.node: r.place for r in umap.layout(graph, start, 200, alone=0, part=60).collect()}
    places = np.array([got[i] for i in range(len(x))])
    assert len(rounds) == umap.ROUNDS and [k for lo, hi in rounds for k in range(lo, hi)] == list(range(200))
    assert np.isfinite(places).all() and kept_neighbours(places, label) >= 0.9


@pytest.mark.parametrize("find", [profile.communities, graphs.leiden])
def test_communities_of_a_middling_graph_take_the_driver_no_rounds(spark, monkeypatch, find):
    def rounds(*_):
        raise AssertionError("rounds over all tasks")

    monkeypatch.setattr(profile, "modularity", rounds)
    monkeypatch.setattr(graphs, "_moved_over_all", rounds)
    # 60,000 groups of four nodes, each linked with all of its own: 720,000 edges in both directions
    edges = spark.range(60_000).selectExpr("explode(array(struct(0, 1), struct(0, 2), struct(0, 3), struct(1, 2), struct(1, 3), struct(2, 3))) as e", "4 * id as id").selectExpr("id + e.col1 as src", "id + e.col2 as dst")
    found = find(edges)
    assert found.where("community div 4 != node div 4").count() == 0 and found.count() == 240_000
