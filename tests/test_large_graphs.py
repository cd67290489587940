"""Graphs over many rows: what is read once, and steps over all tasks held against those of one."""

import numpy as np
from pyspark.sql import functions as F

from tessera.catalogue import manifolds
from tessera.catalogue.registry import QUERIES
from tessera.operators import graphs, near, umap
from tessera.runtime import shared_folder

DATA = "/root/testdata/sf0.001"


def test_both_resolutions_read_one_written_graph(spark, monkeypatch):
    got, leiden = [], manifolds.graphs.leiden
    monkeypatch.setattr(manifolds.graphs, "leiden", lambda g, r: (got.append(g._jdf.queryExecution().toString()), leiden(g, r))[1])
    QUERIES["leiden_communities"](spark, DATA)
    assert len(got) == 2 and not any("CoGroup" in p for p in got)


def test_a_layout_of_more_than_200_000_edges_takes_no_rounds_over_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(umap, "_moving", None)
    n, k = 3000, 70
    g = spark.range(n * k).select((F.col("id") % n).alias("src"), ((F.col("id") % n + 1 + F.expr(f"id div {n}")) % n).alias("dst"), F.lit(0.5).alias("weight"))
    start = spark.range(n).select(F.col("id").alias("node"), F.array(F.sin("id"), F.cos("id")).alias("place"))
    assert umap.layout(g, start, 1, part=100).count() == n


def test_forces_in_pieces_are_those_of_one_piece(monkeypatch):
    r = np.random.default_rng(0)
    at, x, w = np.sort(r.integers(0, 50, 900)), r.normal(size=(50, 2)), r.random(900)
    y = x[r.integers(0, 50, 900)]
    whole = umap._forces(x, at, y, w, x, np.random.default_rng(1), 1.5, 0.9)
    monkeypatch.setattr(umap, "SOME", 7)
    assert (umap._forces(x, at, y, w, x, np.random.default_rng(1), 1.5, 0.9) == whole).all()


def test_graphs_of_more_than_200_000_edges_take_no_rounds_over_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(graphs, "_eigen_over_all", None)
    n, k = 3000, 40
    g = spark.range(n * k).select((F.col("id") % n).alias("src"), F.pmod(F.xxhash64("id"), F.lit(n)).alias("dst"))
    assert g.count() * 2 > 230_000
    found = graphs.diffusion_pseudotime(g, 0, 3).agg(F.count("*").alias("n"), F.max("time").alias("top")).first()
    assert (found.n, round(found.top, 9)) == (n, 1.0)


def test_branches_find_neighbours_once(spark, monkeypatch):
    got, real = [], graphs.distances
    monkeypatch.setattr(graphs, "distances", lambda e, s, alone: (got.append(e._jdf.queryExecution().toString()), real(e, s, alone))[1])
    QUERIES["trajectory_branches"](spark, DATA)
    assert len(got) == 2 and not any("CoGroup" in p for p in got)


def test_cells_of_the_approximate_search_are_written_without_vectors(spark, monkeypatch):
    written, real = [], near.cut
    monkeypatch.setattr(near, "cut", lambda df: (written.append(df.columns), real(df))[1])
    rows = spark.range(60).select("id", F.array(F.sin("id"), F.cos("id")).alias("v"))
    assert near.neighbours(rows, 3, trees=4, block=16, rounds=1).count() == 180
    assert [c for c in written if "tree" in c] == [["id", "tree", "code"]]


def test_halves_do_not_follow_from_the_ones_before():
    node = np.arange(10_000)
    same = [(h := graphs._half(node, turn))[1:] == h[:-1] for turn in range(0, 40, 2)]
    assert all(0.45 < (a != b).mean() < 0.55 for a, b in zip(same, same[1:]))


def test_rounds_over_all_tasks_are_those_of_one_and_write_no_table_each(spark, monkeypatch):
    r = np.random.default_rng(3)
    a, b = r.integers(0, 60, (2, 240))
    pairs = sorted({(int(i), int(j)) for i, j in zip([*a, *b], [*b, *a]) if i != j and (i < 30) == (j < 30)})
    at, to = np.array(pairs).T
    k, total = np.bincount(at).astype(float), float(len(at))
    want = graphs._moved(at, to, np.ones(len(at)), k, np.arange(60), total, 1.0, 2)
    level = spark.createDataFrame([(*p, 1.0) for p in pairs], "src long, dst long, weight double")
    strength = spark.createDataFrame([(i, float(x)) for i, x in enumerate(k)], "node long, k double")
    cuts, cut = [], graphs.cut
    monkeypatch.setattr(graphs, "cut", lambda df: (cuts.append(1), cut(df))[1])
    shared_folder(spark)
    got = graphs._moved_over_all(level, strength, strength.select("node", F.col("node").alias("community")), total, 1.0, 2)
    assert {x.node: x.community for x in got.collect()} == dict(enumerate(want)) and len(set(want)) > 1
    assert len(cuts) == 1


def test_communities_are_refined_alike_by_joins(spark):
    pairs = [(a, b) for base in (0, 5) for a in range(base, base + 5) for b in range(base, base + 5) if a != b]
    inside = spark.createDataFrame([(*p, 1.0, p[0] // 5) for p in pairs], "src long, dst long, weight double, community long")
    strength = spark.createDataFrame([(i, 4.0) for i in range(10)], "node long, k double")
    label = strength.selectExpr("node", "node div 5 as community")
    shared_folder(spark)
    for parts in (graphs._refined_over_all(inside, strength, label, 40.0, 1.0, 10), graphs._refined_by_joins(inside, strength, label, 40.0, 1.0)):
        got = {r.node: r.part for r in parts.collect()}
        assert len(got) == 10 and len(set(got.values())) < 10 and all(a // 5 == b // 5 for a, b in got.items())
