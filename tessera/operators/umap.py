"""Layouts of neighbour graphs: fuzzy weights, edges that pull and drawn nodes that push, places for new rows.

Neighbours come from ``profile.knn``. Up to ``alone`` edges one task makes all
epochs with numpy. Beyond that the epochs are made in some rounds, each one join, which brings the places of both
ends together, and one grouping into parts dealt anew each time: a node is pulled by all
its edges, of which those that end in other parts end where the round began, and pushed by nodes
drawn from its part. Where there is more than a part no task sees all places.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import GRAPH, cut

#: Nodes, about, in a part of an epoch, and pushes a pull.
PART, PUSHES = 20_000, 5
#: Edges whose forces are made at a time.
SOME = 4096
#: Rounds, at most, in which the epochs are made where there are several parts.
ROUNDS = 20


def smooth(d: np.ndarray, known: np.ndarray, rounds: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ascending distances: that to the nearest other place, and the width at which all memberships add up to log2 of their number.

    A bisection for all rows at once; ``known`` tells which places of a row are in use.
    """
    far = np.where(known & (d > 0), d, np.inf)
    rho = np.where(np.isfinite(far.min(axis=1)), far.min(axis=1), 0.0)
    want = np.log2(np.maximum(known.sum(axis=1), 1))
    lo, hi, mid = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    beyond = np.maximum(d - rho[:, None], 0)
    for _ in range(rounds):
        got = np.where(known, np.exp(-beyond / mid[:, None]), 0).sum(axis=1)
        over = got > want
        hi, lo = np.where(over, mid, hi), np.where(over, lo, mid)
        mid = np.where(np.isinf(hi), mid * 2, (lo + hi) / 2)
    mean = np.where(known, d, 0).sum(axis=1) / np.maximum(known.sum(axis=1), 1)
    return rho, np.maximum(mid, 1e-3 * mean)


def _memberships(near: DataFrame) -> DataFrame:
    """``near(id, rank, other, distance)`` -> ``(src, dst, weight)``, how strongly each row's neighbours belong to it."""
    lists = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("distance", "other"))).alias("near"))

    def weigh(frames):
        for f in frames:
            if len(f):
                n = f["near"].map(len).to_numpy()
                d, known = np.zeros((len(f), n.max())), np.arange(n.max()) < n[:, None]
                d[known] = [x["distance"] for row in f["near"] for x in row]
                other = np.array([x["other"] for row in f["near"] for x in row], np.int64)
                rho, sigma = smooth(d, known)
                w = np.exp(-np.maximum(d - rho[:, None], 0) / np.maximum(sigma[:, None], 1e-300))
                yield pd.DataFrame({"src": np.repeat(f["id"].to_numpy(), n), "dst": other, "weight": w[known]})

    return lists.mapInPandas(weigh, "src long, dst long, weight double")


def fuzzy_graph(near: DataFrame) -> DataFrame:
    """``near(id, rank, other, distance)`` -> ``(src, dst, weight)`` in both directions: the fuzzy union a + b - ab of both ends' memberships.

    A row has no more neighbours than were asked for, so its list is small. Rows without neighbours do not appear.
    """
    one = _memberships(near)
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")).where("src != dst")
    return both.groupBy("src", "dst").agg((1 - F.exp(F.sum(F.log1p(-F.least("weight", F.lit(1 - 1e-16)))))).alias("weight"))


def curve(min_dist: float = 0.1, spread: float = 1.0) -> tuple[float, float]:
    """a and b of 1 / (1 + a d^2b), by least squares next to a membership that is 1 up to ``min_dist`` and falls off exponentially."""
    d = np.linspace(0, 3 * spread, 300)
    want = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    p = np.array([0.0, 0.0])  # logarithms of both, so that they stay positive

    def at(p):
        return 1 / (1 + np.exp(p[0]) * d ** (2 * np.exp(p[1])))

    damp = 1e-2
    for _ in range(100):
        f = at(p)
        j = np.stack([(at(p + e) - f) / 1e-6 for e in np.eye(2) * 1e-6], 1)
        step = np.linalg.solve(j.T @ j + damp * np.eye(2), j.T @ (want - f))
        better = ((at(p + step) - want) ** 2).sum() < ((f - want) ** 2).sum()
        p, damp = (p + step, damp / 3) if better else (p, damp * 5)
    return float(np.exp(p[0])), float(np.exp(p[1]))


def _forces(x: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray, others: np.ndarray, r: np.random.Generator, a: float, b: float) -> np.ndarray:
    """What moves the nodes at ``x``: pulls by the ends ``y`` of edges of node ``at``, as likely as their weight, and pushes by drawn others."""
    on = r.random(len(at)) < weight
    at, y = at[on], y[on]
    drawn = [r.integers(0, len(others), len(at)) for _ in range(PUSHES)]
    moves = np.empty((x.shape[1], PUSHES + 1, len(at)))
    columns, ends = np.ascontiguousarray(x.T), [np.ascontiguousarray(y.T), *[np.ascontiguousarray(others.T)] * PUSHES]
    for lo in range(0, len(at), SOME):  # pieces that stay in a core's cache
        part = slice(lo, lo + SOME)
        here = [c[at[part]] for c in columns]
        for k, end in enumerate(ends):
            diff = [h - c[drawn[k - 1][part] if k else part] for h, c in zip(here, end)]
            d2 = sum(d**2 for d in diff)
            if k:
                force = np.where(d2 > 0, 2 * b / ((0.001 + d2) * (1 + a * d2**b)), 0)
            else:
                force = np.where(d2 > 0, -2 * a * b * np.maximum(d2, 1e-12) ** (b - 1) / (1 + a * d2**b), 0)
            for m, d in zip(moves, diff):
                m[k, part] = np.clip(force * d, -4, 4)
    at = np.tile(at, PUSHES + 1)
    return np.stack([np.bincount(at, m.ravel(), len(x)) for m in moves], axis=1)


def _stepped(x: np.ndarray, move: np.ndarray, pulls: np.ndarray, rate: float) -> np.ndarray:
    """Places after an epoch. All edges of a node count at once here, so that a node of many would overshoot; its step is that of one pull, times their root."""
    return x + rate * move / np.sqrt(np.maximum(pulls, 1))[:, None]


def _moving(seed: int, first: int, last: int, epochs: int, a: float, b: float):
    """Some epochs of a part: its nodes, and the edges that begin there with the places where they end. Ends in the part move along, others wait for the next round."""

    def moved(key: tuple, mine: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("node")
        nodes, x = mine["node"].to_numpy(), np.stack(mine["place"].to_numpy())
        if len(ends):
            ends = ends.sort_values(["src", "dst"])
            at, y, weight = np.searchsorted(nodes, ends["src"].to_numpy()), np.stack(ends["to"].to_numpy()), ends["weight"].to_numpy()
            dst = ends["dst"].to_numpy()
            own = np.minimum(np.searchsorted(nodes, dst), len(nodes) - 1)
            here, pulls = nodes[own] == dst, np.bincount(at, weight, len(x))
            for epoch in range(first, last):
                y[here] = x[own[here]]
                x = _stepped(x, _forces(x, at, y, weight, x, np.random.default_rng((seed, epoch, key[0])), a, b), pulls, 1 - epoch / epochs)
        return pd.DataFrame({"node": nodes, "place": [*x]})

    return moved


def layout(graph: DataFrame, start: DataFrame, epochs: int = 300, min_dist: float = 0.1, seed: int = 42, alone: int = GRAPH, part: int = PART) -> DataFrame:
    """``graph(src, dst, weight)``, both directions, and ``start(node, place)`` -> ``(node, place)`` after ``epochs``.

    The rate falls to 0 over the epochs. Draws follow from the seed, the epoch and the part, so a task run again
    makes the same moves. Nodes without an edge stay where they start; nodes that ``start`` does not have are left out.
    """
    a, b = curve(min_dist)
    places = cut(start.select(F.col("node").cast("long").alias("node"), F.col("place").cast("array<double>").alias("place")))
    edges = graph.join(places.select(F.col("node").alias("src")).hint("merge"), "src", "left_semi").join(places.select(F.col("node").alias("dst")).hint("merge"), "dst", "left_semi")
    edges = cut(edges.select("src", "dst", "weight"))
    if edges.count() <= alone:
        return _in_one_layout(edges, places, epochs, a, b, seed)
    n = max(1, ceil(places.count() / part))
    # the rounds do not depend on the rows, so neither does what the driver keeps of them; sorted joins send it no table
    rounds = 1 if n == 1 else min(epochs, ROUNDS)
    for turn in range(rounds):
        first, last = epochs * turn // rounds, epochs * (turn + 1) // rounds
        dealt = places.withColumn("part", F.pmod(F.xxhash64("node", F.lit(seed + turn)), F.lit(n)).cast("long"))
        ends = places.select(F.col("node").alias("dst"), F.col("place").alias("to")).hint("merge")
        pulls = edges.join(ends, "dst").select(F.pmod(F.xxhash64(F.col("src"), F.lit(seed + turn)), F.lit(n)).cast("long").alias("part"), "src", "dst", "to", "weight")
        places = cut(dealt.groupBy("part").cogroup(pulls.groupBy("part")).applyInPandas(_moving(seed, first, last, epochs, a, b), "node long, place array<double>"))
    return places


def _in_one_layout(edges: DataFrame, places: DataFrame, epochs: int, a: float, b: float, seed: int) -> DataFrame:
    rows = edges.withColumn("place", F.lit(None).cast("array<double>")).unionByName(places.select(F.col("node").alias("src"), F.lit(None).cast("long").alias("dst"), F.lit(None).cast("double").alias("weight"), "place"))

    def run(frames):
        held = [f for f in frames if len(f)]
        if held:
            f = pd.concat(held)
            own, e = f[f["place"].notna()].sort_values("src"), f[f["place"].isna()].sort_values(["src", "dst"])
            nodes, x = own["src"].to_numpy(), np.stack(own["place"].to_numpy())
            at, to = (np.searchsorted(nodes, e[c].to_numpy().astype(np.int64)) for c in ("src", "dst"))
            weight, r = e["weight"].to_numpy(float), np.random.default_rng(seed)
            pulls = np.bincount(at, weight, len(x)) if len(at) else np.zeros(len(x))
            for epoch in range(epochs if len(at) else 0):
                x = _stepped(x, _forces(x, at, x[to], weight, x, r, a, b), pulls, 1 - epoch / epochs)
            yield pd.DataFrame({"node": nodes, "place": [*x]})

    return rows.coalesce(1).mapInPandas(run, "node long, place array<double>")


def placed(near: DataFrame, places: DataFrame) -> DataFrame:
    """New rows in a fixed layout: ``near(id, rank, other, distance)`` among laid out rows and ``places(node, place)`` -> ``(node, place)``.

    Each is put at the mean of its neighbours' places, weighted by their memberships; the layout
    itself stays as it is. Rows none of whose neighbours has a place are left out.
    """
    w = _memberships(near).join(places.select(F.col("node").alias("dst"), "place"), "dst")
    each = w.select("src", "weight", F.posexplode("place").alias("k", "x")).groupBy("src", "k").agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x"))
    return each.groupBy(F.col("src").alias("node")).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("place"))


def umap(vectors: DataFrame, near: DataFrame, components: int = 2, epochs: int = 300, min_dist: float = 0.1, seed: int = 42, alone: int = GRAPH) -> DataFrame:
    """``vectors(id, v)`` and their neighbours ``near`` -> ``(node, place)``: a layout that starts from the first principal components, ten wide.

    A little noise that follows from the id parts equal rows. No rows give no rows.
    """
    from .profile import pca

    first = cut(pca(vectors.select("id", "v"), components).select(F.col("id").alias("node"), "pc"))
    wide = first.agg(F.max(F.array_max(F.transform("pc", F.abs)))).first()[0] or 1.0
    noise = lambda x, k: x * (10.0 / wide) + (F.pmod(F.xxhash64("node", k, F.lit(seed)), F.lit(1_000_003)) / 1_000_003 - 0.5) * 1e-3
    start = first.select("node", F.transform("pc", noise).alias("place"))
    return layout(fuzzy_graph(near), start, epochs, min_dist, seed, alone)


def without_far(vectors: DataFrame, near: Callable[[DataFrame], DataFrame], most: float, axis: int = 0, **how) -> tuple[DataFrame, DataFrame]:
    """Rows whose place along an axis of their own layout is below ``most``, and a layout of these alone.

    ``near(rows)`` finds the neighbours of rows among themselves; ``how`` goes to ``umap``.
    """
    first = umap(vectors, near(vectors), **how)
    kept = cut(vectors.join(first.where(F.col("place")[axis] < most).select(F.col("node").alias("id")), "id", "left_semi"))
    return kept, cut(umap(kept, near(kept), **how))
