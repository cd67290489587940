"""Graphs of neighbours: eigenvectors of the walk, pseudotime, communities, branches.

Edges are ``(src, dst)`` of longs, with a ``weight`` if there is one; they count in both
directions, the largest weight of repeated ones, and those with a null end, of a node with
itself, or without a positive weight are left out. Up to ``alone`` edges one task does the
whole work with numpy, since a Spark job a step would take longer than the work;
beyond that a step is a join and a grouping over all edges.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import GRAPH, WALK, components, cut, roots

Edges = tuple[np.ndarray, np.ndarray, np.ndarray]


def weighted(edges: DataFrame) -> DataFrame:
    """Both directions of each edge, once, with its weight (1 if there is none)."""
    w = F.col("weight") if "weight" in edges.columns else F.lit(1.0)
    e = edges.select("src", "dst", w.cast("double").alias("weight")).where("src != dst and weight > 0")
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both.groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def _in_one_task(both: DataFrame, work: Callable[..., pd.DataFrame], schema: str) -> DataFrame:
    """``work(nodes, at, to, weight)``, at and to being places in the nodes, in order."""

    def run(frames):
        held = [f for f in frames if len(f)]
        if held:
            f = pd.concat(held).sort_values(["src", "dst"])
            nodes, at = np.unique(f["src"].to_numpy(), return_inverse=True)
            yield work(nodes, at, np.searchsorted(nodes, f["dst"].to_numpy()), f["weight"].to_numpy())

    return both.coalesce(1).mapInPandas(run, schema)


# eigenvectors of the random walk


class NotConverged(RuntimeError):
    """Eigenvectors were not found to the tolerance asked for within the rounds allowed."""


def _ritz(alpha: list[float], beta: list[float], k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest values and vectors of the tridiagonal matrix of a Krylov space, and the largest residual of these."""
    m = len(alpha)
    t = np.diag(alpha) + np.diag(beta[: m - 1], 1) + np.diag(beta[: m - 1], -1)
    values, s = np.linalg.eigh(t)
    values, s = values[::-1][:k], s[:, ::-1][:, :k]
    return values, s, float(np.abs(beta[m - 1] * s[-1]).max())


def lanczos(product: Callable[[np.ndarray], np.ndarray], known: np.ndarray, k: int, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and unit eigenvectors of a symmetric product besides a known unit vector; fewer if there are no more.

    Each new direction is made orthogonal to all before it, twice. It ends when
    the residuals of all values asked for are below the tolerance.
    """
    n = len(known)
    q = np.random.default_rng(1).normal(size=n)
    # memory is taken row by row as the basis grows, which a round does not copy
    room, alpha, beta = np.empty((max(1, min(rounds, n)), n)), [], []
    while True:
        basis = room[: len(alpha)]
        for _ in range(2):
            q = q - known * (known @ q) - basis.T @ (basis @ q)
        length = float(np.linalg.norm(q))
        if alpha:
            beta.append(length)
            values, s, off = _ritz(alpha, beta, k)
            if len(alpha) >= n - 1 or length < 1e-13 or len(alpha) > k and off < tolerance:
                return values, basis.T @ s
            if len(alpha) >= rounds:
                raise NotConverged(f"{k} eigenvectors of {n} nodes, residual {off:.2g} after {rounds} rounds")
        elif length < 1e-13:
            return np.zeros(0), np.zeros((n, 0))
        last = room[len(alpha)]
        last[:] = q / length
        q = product(last)
        alpha.append(float(last @ q))


def _walk(at: np.ndarray, to: np.ndarray, weight: np.ndarray, n: int, k: int, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a graph in one task: the roots of the degrees, and eigenvalues and vectors of the symmetric walk, k of them, zeros where there are fewer."""
    r = np.sqrt(np.bincount(at, weight, n))
    values, v = lanczos(lambda x: np.bincount(at, weight * (x / r)[to], n) / r, r / np.linalg.norm(r), k, rounds, tolerance)
    full, all_values = np.zeros((n, k)), np.zeros(k)
    full[:, : len(values)], all_values[: len(values)] = v, values
    return r, all_values, full


def _eigen_over_all(both: DataFrame, k: int, rounds: int, tolerance: float) -> tuple[DataFrame, np.ndarray]:
    """``(node, r, v)`` and the eigenvalues, with a join and two groupings over the edges a round.

    ``basis`` grows by a number a round, and comes to the driver as sums only.
    """
    degree = cut(both.groupBy(F.col("src").alias("node")).agg(F.sqrt(F.sum("weight")).alias("r")))
    norm = float(np.sqrt(degree.agg(F.sum(F.col("r") * F.col("r"))).first()[0] or 0.0))
    n, known = degree.count(), F.col("r") / (norm or 1.0)
    state = degree.select("node", "r", F.array().cast("array<double>").alias("basis"), (F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1_000_003)) / 1_000_003 - 0.5).alias("w"))
    alpha, beta = [], []
    while n:
        m, along = len(alpha), []
        for _ in range(2):
            dots = state.agg(F.sum(F.col("w") * known), *(F.sum(F.col("w") * F.col("basis")[j]) for j in range(m))).first()
            less = F.aggregate(F.zip_with("basis", F.array(*map(F.lit, dots[1:])).cast("array<double>"), lambda a, b: a * b), F.col("w") - known * dots[0], lambda s, x: s - x)
            state, along = state.select("node", "r", "basis", less.alias("w")), [*along, dots[-1]]
        state = cut(state)
        length = float(np.sqrt(state.agg(F.sum(F.col("w") * F.col("w"))).first()[0]))
        if alpha:
            alpha[-1] += sum(along)
            beta.append(length)
            values, s, off = _ritz(alpha, beta, k)
            if m >= n - 1 or length < 1e-13 or m > k and off < tolerance:
                break
            if m >= rounds:
                raise NotConverged(f"{k} eigenvectors of {n} nodes, residual {off:.2g} after {rounds} rounds")
        elif length < 1e-13:
            values, s = np.zeros(0), np.zeros((0, 0))
            break
        state = state.select("node", "r", F.array_append("basis", F.col("w") / length).alias("basis"))
        last = F.element_at("basis", -1) / F.col("r")
        walked = both.join(state.select(F.col("node").alias("dst"), last.alias("u")), "dst").groupBy(F.col("src").alias("node")).agg(F.sum(F.col("weight") * F.col("u")).alias("w"))
        state = state.join(walked, "node").select("node", "r", "basis", (F.col("w") / F.col("r")).alias("w"))
        alpha.append(0.0)
    else:
        values, s = np.zeros(0), np.zeros((0, 0))
    mix = [F.aggregate(F.zip_with("basis", F.array(*map(F.lit, s[:, j].tolist())), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) for j in range(len(values))]
    v = F.array(*mix, *(F.lit(0.0) for _ in range(k - len(values))))
    return state.select("node", "r", v.alias("v")), np.concatenate([values, np.zeros(k - len(values))])


def _signed(v: np.ndarray) -> np.ndarray:
    """Columns with their largest entry positive, the first of several."""
    return v * np.where(v[np.abs(np.round(v, 9)).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0) if len(v) else v


def diffusion_map(edges: DataFrame, k: int = 5, rounds: int = 300, tolerance: float = 1e-7, alone: int = WALK) -> DataFrame:
    """``(node, dc)``: the ``k`` leading non-trivial eigenvectors of the random walk on a graph, each times its eigenvalue.

    Eigenvectors of the symmetric walk D^-1/2 A D^-1/2 by Lanczos steps, over the roots of the
    degrees. Signs are such that the largest entry is positive. Where ``rounds`` do not
    reach the tolerance it raises ``NotConverged``. Of an eigenvalue that occurs several
    times, as in a graph of several parts, one vector is found; where there are fewer vectors than ``k``
    the rest is 0. No edges give no rows.
    """
    both = cut(weighted(edges))
    if both.count() <= alone:

        def work(nodes, at, to, weight):
            r, values, v = _walk(at, to, weight, len(nodes), k, rounds, tolerance)
            return pd.DataFrame({"node": nodes, "dc": [*_signed(v / r[:, None] * values)]})

        return _in_one_task(both, work, "node long, dc array<double>")
    found, values = _eigen_over_all(both, k, rounds, tolerance)
    dc = found.select("node", *((F.col("v")[j] / F.col("r") * float(values[j])).alias(f"d{j}") for j in range(k)))
    sign = dc.agg(*(F.max_by(F.signum(f"d{j}"), F.struct(F.round(F.abs(F.col(f"d{j}")), 9), -F.col("node"))).alias(f"s{j}") for j in range(k))).first()
    return dc.select("node", F.array(*(F.col(f"d{j}") * float(sign[f"s{j}"] or 1.0) for j in range(k))).alias("dc"))


def _reached(at: np.ndarray, to: np.ndarray, n: int, root: int) -> np.ndarray:
    """Steps from the root, -1 where it does not reach."""
    steps = np.full(n, -1)
    steps[root] = turn = 0
    while True:
        front = to[(steps[at] == turn) & (steps[to] < 0)]
        if not len(front):
            return steps
        turn += 1
        steps[front] = turn


def pseudotime(edges: DataFrame, root: int, alone: int = WALK) -> DataFrame:
    """``(node, steps)``: the least number of edges from the root; unreached nodes are absent, as is all if the root has no edge."""
    both = cut(weighted(edges))
    if both.count() <= alone:

        def work(nodes, at, to, weight):
            k = np.searchsorted(nodes, root)
            if k == len(nodes) or nodes[k] != root:
                return pd.DataFrame({"node": [], "steps": []})
            steps = _reached(at, to, len(nodes), k)
            return pd.DataFrame({"node": nodes[steps >= 0], "steps": steps[steps >= 0]})

        return _in_one_task(both, work, "node long, steps int")
    seen = front = cut(both.where(F.col("src") == root).select(F.col("src").alias("node"), F.lit(0).alias("steps")).distinct())
    step = 0
    while front.limit(1).count():
        step += 1
        front = cut(both.join(front, both["src"] == front["node"]).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("steps", F.lit(step)))
        seen = seen.unionByName(front)
    return seen


def diffusion_pseudotime(edges: DataFrame, root: int, k: int = 5, rounds: int = 300, tolerance: float = 1e-7, alone: int = WALK) -> DataFrame:
    """``(node, time)``: diffusion distance from the root over the largest one; 0 for nodes that the root does not reach.

    The distance sums walks of all lengths: eigenvectors of the symmetric walk on the
    root's part of the graph, each weighted by value / (1 - value).
    """
    both = cut(weighted(edges))

    def weights(values: np.ndarray) -> np.ndarray:
        return values / np.maximum(1 - values, 1e-12)

    if both.count() <= alone:

        def work(nodes, at, to, weight):
            time, k0 = np.zeros(len(nodes)), np.searchsorted(nodes, root)
            if k0 < len(nodes) and nodes[k0] == root:
                inside = _reached(at, to, len(nodes), k0) >= 0
                place = np.cumsum(inside) - 1
                e = inside[at]
                _, values, v = _walk(place[at[e]], place[to[e]], weight[e], int(inside.sum()), k, rounds, tolerance)
                far = np.sqrt((((v - v[place[k0]]) * weights(values)) ** 2).sum(axis=1))
                time[inside] = far / far.max() if far.max() else far
            return pd.DataFrame({"node": nodes, "time": time})

        return _in_one_task(both, work, "node long, time double")
    nodes = both.select(F.col("src").alias("node")).distinct()
    part = cut(components(both))
    own = part.join(part.where(F.col("node") == root).select("root"), "root").select("node")
    inside = cut(both.join(own, both["src"] == own["node"]).select("src", "dst", "weight"))
    found, values = _eigen_over_all(inside, k, rounds, tolerance)
    found = cut(found)
    start = (found.where(F.col("node") == root).first() or {"v": [0.0] * k})["v"]
    square = sum((F.pow((F.col("v")[j] - start[j]) * float(w), F.lit(2)) for j, w in enumerate(weights(values))), F.lit(0.0))
    far = cut(found.select("node", F.sqrt(square).alias("d")))
    top = far.agg(F.max("d")).first()[0] or 1.0
    return nodes.join(far, "node", "left").select("node", F.coalesce(F.col("d") / top, F.lit(0.0)).alias("time"))


# communities


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Numbers as good as drawn, of whole numbers and a seed."""
    h = (x.astype(np.int64).view(np.uint64) + np.uint64(seed * 0x9E3779B9 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def _half(node: np.ndarray, turn: int) -> np.ndarray:
    """Whether a node may move in a round: each half in one of two rounds, halves drawn anew for each pair.

    Two neighbours that stay in one half for long chase each other, so no half may follow from the one before.
    """
    return (_mixed(node, turn // 2) & np.uint64(1)).astype(np.int64) == turn % 2


def _links(at: np.ndarray, near: np.ndarray, weight: np.ndarray, n: int) -> Edges:
    """(node, community, weight) of what links each node with each community around it."""
    pair, back = np.unique(at * n + near, return_inverse=True)
    return pair // n, pair % n, np.bincount(back, weight, len(pair))


def _best(node: np.ndarray, gain: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Of each node the row of largest gain, ties to the smaller name."""
    order = np.lexsort((name, -gain, node))
    return order[np.concatenate([[True], node[order][1:] != node[order][:-1]])] if len(node) else order


def _moved(at, to, weight, k, label, total, resolution: float, patience: int) -> np.ndarray:
    """Moves of nodes, half of them a round, to the community that gains most, or out of one that has nothing for them."""
    n = len(k)
    inner = np.bincount(at, weight, n)  # strengths without loops, for the quality of what the moves can change

    def quality(x: np.ndarray) -> float:
        return weight[x[at] == x[to]].sum() / total - resolution * (np.bincount(x, k, n) ** 2).sum() / total / total

    best, top, worse, turn = label, quality(label), 0, 0
    while worse < 2 * patience and inner.any():
        turn += 1
        held = np.bincount(label, k, n)
        node, near, w = _links(at, label[to], weight, n)
        gain = w - resolution * k[node] * (held[near] - np.where(near == label[node], k[node], 0)) / total
        stay = -resolution * k * (held[label] - k) / total
        own = near == label[node]
        stay[node[own]] = gain[own]
        empty = np.flatnonzero(held == 0)  # a node may take its own name if nobody has it
        node, near, gain = np.concatenate([node, empty]), np.concatenate([near, empty]), np.concatenate([gain, np.zeros(len(empty))])
        lead = _best(node, gain, near)
        goes = (gain[lead] > stay[node[lead]] + 1e-12) & _half(node[lead], turn)
        label = label.copy()
        label[node[lead][goes]] = near[lead][goes]
        now = quality(label)
        best, top, worse = (label, now, 0) if now > top + 1e-12 else (best, top, worse + 1)
    return best


def _refined(at, to, weight, k, label, total, resolution: float, name: np.ndarray | None = None) -> np.ndarray:
    """Communities parted anew: nodes on their own join a neighbour of their community, and only those that stay put take them in.

    A part grows by nodes that are linked with it and loses none, so it is connected.
    """
    n = len(k)
    name = np.arange(n) if name is None else name
    part, idle, turn = np.arange(n), 0, 0
    inside = label[at] == label[to]
    at, to, weight = at[inside], to[inside], weight[inside]
    while idle < 4 and len(at):
        turn += 1
        alone = np.bincount(part, minlength=n)[part] == 1
        mover = alone & _half(name, turn)
        ok = mover[at] & ~mover[to]
        node, near, w = _links(at[ok], part[to[ok]], weight[ok], n)
        gain = w - resolution * k[node] * np.bincount(part, k, n)[near] / total
        lead = _best(node, gain, near)
        lead = lead[gain[lead] > 1e-12]
        part = part.copy()
        part[node[lead]] = near[lead]
        idle = 0 if len(lead) else idle + 1
    return part


def _leiden(at: np.ndarray, to: np.ndarray, weight: np.ndarray, k: np.ndarray, label: np.ndarray, resolution: float, patience: int) -> np.ndarray:
    """Moves, refinement and aggregation, level by level, until refined parts are the communities."""
    total, up = float(k.sum()), np.arange(len(k))
    while True:
        label = _moved(at, to, weight, k, label, total, resolution, patience)
        part = _refined(at, to, weight, k, label, total, resolution)
        name, place = np.unique(part, return_inverse=True)
        if len(name) == len(k):
            return label[up]
        up = place[up]
        k, same = np.bincount(place, k), place[at] != place[to]
        at, to, weight = _links(place[at[same]], place[to[same]], weight[same], len(name))
        label = np.unique(label[name], return_inverse=True)[1]


def _connected(at: np.ndarray, to: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Communities named by their least node, those in several parts as one a part."""
    inside = label[at] == label[to]
    out = np.arange(len(label))
    node, root = roots(at[inside], to[inside])
    out[node] = root
    return out


def leiden(edges: DataFrame, resolution: float = 1.0, patience: int = 2, alone: int = GRAPH) -> DataFrame:
    """Communities ``(node, community)`` by moves, refinement and aggregation; each is connected and named after its least node.

    On each level nodes move to the community that raises modularity most; communities are then parted anew from single
    nodes, inside of each; and the parts are the nodes of the next level, which starts from the communities. The higher the
    ``resolution``, the smaller the communities. Levels of up to ``alone`` edges are one task's; in a larger one nodes move in blocks, a
    job a round, and communities are parted each in one task. No edges give no rows.
    """
    both = cut(weighted(edges))
    if both.count() <= alone:

        def work(nodes, at, to, weight):
            label = _leiden(at, to, weight, np.bincount(at, weight, len(nodes)), np.arange(len(nodes)), resolution, patience)
            return pd.DataFrame({"node": nodes, "community": nodes[_connected(at, to, label)]})

        return _in_one_task(both, work, "node long, community long")
    strength = cut(both.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k")))
    total = strength.agg(F.sum("k")).first()[0]
    level, start, up = both, strength.select("node", F.col("node").alias("community")), strength.select("node", F.col("node").alias("part"))
    while True:
        label = _moved_over_all(level, strength, start, total, resolution, patience)
        inside = cut(_inside(level, label))
        part = _refined_over_all(inside, strength, label, total, resolution, alone)
        before, after = strength.count(), part.select("part").distinct().count()
        if after == before:
            label = label.select("node").join(components(inside).hint("merge"), "node", "left").select("node", F.coalesce("root", "node").alias("community"))
            break
        up = cut(up.withColumnRenamed("part", "node_").join(part.withColumnRenamed("node", "node_").hint("merge"), "node_").select("node", "part"))
        start = cut(part.join(label.hint("merge"), "node").groupBy(F.col("part").alias("node")).agg(F.min("community").alias("community")))
        strength = cut(strength.join(part.hint("merge"), "node").groupBy(F.col("part").alias("node")).agg(F.sum("k").alias("k")))
        ends = level.join(part.select(F.col("node").alias("src"), F.col("part").alias("p")).hint("merge"), "src").join(part.select(F.col("node").alias("dst"), F.col("part").alias("q")).hint("merge"), "dst")
        level = cut(ends.where("p != q").groupBy(F.col("p").alias("src"), F.col("q").alias("dst")).agg(F.sum("weight").alias("weight")))
        if level.count() <= alone:
            label = _last_levels(level, strength, start, resolution, patience)
            break
    # a community in several parts was one a part: none of its edges is lost, and chance would give fewer
    whole = cut(up.join(label.withColumnRenamed("node", "part").hint("merge"), "part").select("node", "community"))
    name = whole.groupBy("community").agg(F.min("node").alias("name"))
    return whole.join(name.hint("merge"), "community").select("node", F.col("name").alias("community"))


def _inside(level: DataFrame, label: DataFrame) -> DataFrame:
    """Edges inside of communities, with these."""
    one, two = (label.select(F.col("node").alias(end), F.col("community").alias(c)).hint("merge") for end, c in (("src", "c"), ("dst", "d")))
    return level.join(one, "src").join(two, "dst").where("c = d").select("src", "dst", "weight", F.col("c").alias("community"))


def _last_levels(level: DataFrame, strength: DataFrame, start: DataFrame, resolution: float, patience: int) -> DataFrame:
    """The levels of one task, from the communities that the levels before have found; a community in several parts is one a part."""
    rows = strength.join(start, "node").select(F.col("node").alias("src"), F.lit(None).cast("long").alias("dst"), F.col("k").alias("weight"), "community")
    rows = rows.unionByName(level.withColumn("community", F.lit(None).cast("long")))

    def run(frames):
        held = [f for f in frames if len(f)]
        if held:
            f = pd.concat(held)
            own = f[f["dst"].isna()].sort_values("src")
            e = f[f["dst"].notna()].sort_values(["src", "dst"])
            nodes, k = own["src"].to_numpy().astype(np.int64), own["weight"].to_numpy()
            label = np.unique(own["community"].to_numpy(), return_inverse=True)[1]
            at, to = (np.searchsorted(nodes, e[c].to_numpy().astype(np.int64)) for c in ("src", "dst"))
            found = _leiden(at, to, e["weight"].to_numpy(), k, label, resolution, patience)
            yield pd.DataFrame({"node": nodes, "community": nodes[_connected(at, to, found)]})

    return rows.coalesce(1).mapInPandas(run, "node long, community long")


def _block(me: int, nodes: np.ndarray, k: np.ndarray, src: np.ndarray, dst: np.ndarray, q: np.ndarray, weight: np.ndarray) -> dict:
    """Nodes of a part of a level, in order, their strengths, and the edges that begin at them.

    The nodes where edges end stand by part ``q`` and in order, so that ``to`` points into what the parts tell one after
    another. Edges go both ways: what a part is to be told by another is what that one has edges from, in the same order.
    """
    at, order = np.searchsorted(nodes, src), np.lexsort((dst, q))
    new = np.ones(len(order), bool)
    new[1:] = dst[order][1:] != dst[order][:-1]
    to = np.empty(len(order), np.int64)
    to[order] = np.cumsum(new) - 1
    pair = np.unique(q * len(nodes) + at)
    send = {int(o): (pair[pair // len(nodes) == o] % len(nodes)).astype(np.int32) for o in np.unique(q)}
    return {"me": me, "nodes": nodes, "k": k, "weight": weight, "at": at.astype(np.int32), "to": to.astype(np.int32), "send": send}


def _ask(b: dict, label: np.ndarray, parts: int):
    """What a block's nodes add to their communities, for the parts that add these up; names of nodes are asked for too, since they may be free."""
    name, place = np.unique(np.concatenate([label, b["nodes"]]), return_inverse=True)
    adds = np.bincount(place[: len(label)], b["k"], len(name))
    owner = (_mixed(name) % np.uint64(parts)).astype(np.int64)
    for o in np.unique(owner):
        yield int(o), (name[owner == o], adds[owner == o])


def _tell(b: dict, label: np.ndarray, answers: list) -> tuple[np.ndarray, np.ndarray, dict]:
    """Of a block's nodes: strengths of their communities, whether their own names are free, and what other parts are told."""
    name, held = (np.concatenate(x) for x in zip(*answers))
    order = np.argsort(name)
    name, held = name[order], held[order]
    mine = held[np.searchsorted(name, label)]
    return mine, held[np.searchsorted(name, b["nodes"])] == 0, {q: (label[i], mine[i]) for q, i in b["send"].items()}


def _block_moved(b: dict, label: np.ndarray, mine: np.ndarray, free: np.ndarray, told: list, total: float, resolution: float, turn: int) -> tuple[np.ndarray, float, float]:
    """A round of ``_moved``: labels after it; before it, the weight inside communities and the sum of strengths times those of their communities."""
    nodes, k, at, to, weight = (b[x] for x in ("nodes", "k", "at", "to", "weight"))
    ends, held = (np.concatenate(x) for x in zip(*told)) if told else (np.zeros(0, np.int64), np.zeros(0))
    name, first, place = np.unique(ends, return_index=True, return_inverse=True)
    inner = weight[label[at] == ends[to]].sum()
    node, near, w = _links(at.astype(np.int64), place[to], weight, max(1, len(name)))
    held, near = held[first][near], name[near]
    own = near == label[node]
    gain = w - resolution * k[node] * (held - np.where(own, k[node], 0)) / total
    stay = -resolution * k * (mine - k) / total
    stay[node[own]] = gain[own]
    alone = np.flatnonzero(free)
    node, near, gain = np.concatenate([node, alone]), np.concatenate([near, nodes[alone]]), np.concatenate([gain, np.zeros(len(alone))])
    lead = _best(node, gain, near)
    goes = (gain[lead] > stay[node[lead]] + 1e-12) & _half(nodes[node[lead]], turn)
    new = label.copy()
    new[node[lead][goes]] = near[lead][goes]
    return new, float(inner), float((k * mine).sum())


def _blocks(level: DataFrame, strength: DataFrame, label: DataFrame, parts: int):
    """A ``_block`` and the labels of its nodes a partition, or None, as many partitions as parts at least."""
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    no = F.lit(None).cast("long")
    rows = level.select(part("src").alias("p"), "src", "dst", part("dst").alias("q"), "weight", no.alias("community"))
    rows = rows.unionByName(strength.join(label.hint("merge"), "node").select(part("node").alias("p"), F.col("node").alias("src"), no.alias("dst"), F.lit(None).cast("int").alias("q"), F.col("k").alias("weight"), "community"))

    def packed(key: tuple, t: pa.Table) -> pa.Table:
        is_node = pc.is_null(t["dst"])
        own, e = t.filter(is_node).sort_by("src"), t.filter(pc.invert(is_node)).sort_by([("src", "ascending"), ("dst", "ascending")])
        nodes, k, label = (own[c].to_numpy() for c in ("src", "weight", "community"))
        block = _block(key[0].as_py(), nodes, k, *(e[c].to_numpy().astype(np.int64) for c in ("src", "dst", "q")), e["weight"].to_numpy())
        return pa.table({"p": [key[0].as_py()], "block": [pickle.dumps((block, label))]}, pa.schema([("p", pa.int32()), ("block", pa.binary())]))

    held = rows.groupBy("p").applyInArrow(packed, "p int, block binary").rdd.map(tuple).partitionBy(parts, int)
    return held.mapPartitions(lambda it: [next((pickle.loads(block) for _, block in it), None)])


def _moved_over_all(level: DataFrame, strength: DataFrame, label: DataFrame, total: float, resolution: float, patience: int) -> DataFrame:
    """The rounds of ``_moved`` over blocks of edges that stay where they are, a job a round.

    In a round strengths of communities are added up, each by the part that its name falls to, and sent back; parts tell
    each other the communities of the nodes where edges end; and nodes move. The driver sees two sums a part. All edges of a node are in one block.
    """
    m, sc = level.count(), level.sparkSession.sparkContext
    parts = max(2, min(64, ceil(m / 500_000)), ceil(m / GRAPH))
    blocks = _blocks(level, strength, label, parts)
    blocks.checkpoint()
    state = blocks.map(lambda b: b and (b[1], 0.0, 0.0)).persist(StorageLevel.MEMORY_AND_DISK)
    # what is asked and told needs no edges, what moves needs no lists of what to tell
    light, heavy = (blocks.map(lambda b, no=no: b and {x: y for x, y in b[0].items() if x not in no}).persist(StorageLevel.MEMORY_AND_DISK) for no in (("weight", "at", "to"), ("send",)))

    def whole(messages):
        """All that came to a partition, as one element."""
        return messages.partitionBy(parts, int).mapPartitions(lambda it: [[x for _, x in it]])

    def asked(x):
        b, now = x
        return [(o, (b["me"], *rest)) for o, rest in _ask(b, now[0], parts)] if b else []

    def answered(messages):
        if messages:
            name, place = np.unique(np.concatenate([x[1] for x in messages]), return_inverse=True)
            held, lo = np.bincount(place, np.concatenate([x[2] for x in messages]), len(name)), 0
            for p, names, _ in messages:
                yield p, (names, held[place[lo : lo + len(names)]])
                lo += len(names)

    def told(x):
        (b, now), answers = x
        if b:
            mine, free, out = _tell(b, now[0], answers)
            yield b["me"], (-1, now[0], mine, free)
            yield from ((q, (b["me"], *what)) for q, what in out.items())

    def turned(turn: int):
        def moved(x):
            b, messages = x
            if b:
                (_, *own), *ends = sorted(messages, key=lambda m: m[0])
                return _block_moved(b, *own, [m[1:] for m in ends], total, resolution, turn)

        return moved

    best, top, worse, turn = state, -np.inf, 0, 0
    while True:
        turn += 1
        both = light.zip(state)
        answers = whole(whole(both.flatMap(asked)).flatMap(answered))
        messages = whole(both.zip(answers).flatMap(told))
        new = heavy.zip(messages).map(turned(turn)).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % 8 == 0:
            new.checkpoint()
        sums = new.map(lambda x: x and x[1:]).filter(bool).collect()
        now = sum(x[0] for x in sums) / total - resolution * sum(x[1] for x in sums) / total / total
        old, (best, top, worse) = {state, best}, (state, now, 0) if now > top + 1e-12 else (best, top, worse + 1)
        state = new
        if worse >= 2 * patience:
            break
        for x in old - {best}:
            x.unpersist()
    names = light.zip(best).filter(lambda x: x[0]).map(lambda x: (x[0]["nodes"].tobytes(), x[1][0].tobytes()))

    def rows(frames):
        for f in frames:
            for node, community in zip(f["node"], f["community"]):
                yield pd.DataFrame({"node": np.frombuffer(node, np.int64), "community": np.frombuffer(community, np.int64)})

    found = cut(level.sparkSession.createDataFrame(names, "node binary, community binary", verifySchema=False).mapInPandas(rows, "node long, community long"))
    for x in (state, best, light, heavy):
        x.unpersist()
    return found


def _refined_over_all(inside: DataFrame, strength: DataFrame, label: DataFrame, total: float, resolution: float, alone: int) -> DataFrame:
    """``_refined`` of each community in one task: ``(node, part)``; by joins if one has more than ``alone`` edges."""
    m, most = inside.groupBy("community").count().agg(F.sum("count"), F.max("count")).first()
    if (most or 0) > max(alone, 100_000):
        return _refined_by_joins(inside, strength, label, total, resolution)
    rows = strength.join(label.hint("merge"), "node").select(F.col("node").alias("src"), F.lit(None).cast("long").alias("dst"), F.col("k").alias("weight"), "community").unionByName(inside)

    def parted(frames):
        held = [t for t in frames if len(t)]
        if held:
            f = pd.concat(held)
            own, e = f[f["dst"].isna()].sort_values("src"), f[f["dst"].notna()].sort_values(["src", "dst"])
            nodes = own["src"].to_numpy().astype(np.int64)
            at, to = (np.searchsorted(nodes, e[c].to_numpy().astype(np.int64)) for c in ("src", "dst"))
            part = _refined(at, to, e["weight"].to_numpy(), own["weight"].to_numpy(), np.zeros(len(nodes), int), total, resolution, nodes)
            yield pd.DataFrame({"node": nodes, "part": nodes[part]})

    return cut(rows.repartition(max(2, ceil((m or 0) / 100_000)), "community").mapInPandas(parted, "node long, part long"))


def _refined_by_joins(inside: DataFrame, strength: DataFrame, label: DataFrame, total: float, resolution: float) -> DataFrame:
    """The rounds of ``_refined`` as joins."""
    part, idle, turn = cut(label.select("node", F.col("node").alias("part"))), 0, 0
    while idle < 4:
        turn += 1
        half = F.pmod(F.xxhash64("node", F.lit(turn // 2)), F.lit(2)) == turn % 2
        held = part.join(strength.hint("merge"), "node").groupBy("part").agg(F.sum("k").alias("held"), F.count("*").alias("n"))
        now = part.join(held.hint("merge"), "part").select("node", "part", "held", ((F.col("n") == 1) & half).alias("mover"))
        links = inside.join(now.where("mover").select(F.col("node").alias("src")).hint("merge"), "src").join(now.where("not mover").select(F.col("node").alias("dst"), "part", "held").hint("merge"), "dst")
        gains = links.groupBy(F.col("src").alias("node"), "part").agg(F.sum("weight").alias("w"), F.first("held").alias("held")).join(strength.hint("merge"), "node")
        gain = F.col("w") - resolution * F.col("k") * F.col("held") / total
        to = gains.withColumn("gain", gain).where("gain > 1e-12").groupBy("node").agg((-F.max(F.struct("gain", (-F.col("part")).alias("name")))["name"]).alias("new"))
        new = cut(part.join(to.hint("merge"), "node", "left").select("node", F.coalesce("new", "part").alias("part"), F.col("new").isNotNull().alias("went")))
        idle = 0 if new.where("went").limit(1).count() else idle + 1
        part = new.select("node", "part")
    return part


# branches of a trajectory


def distances(edges: DataFrame, sources: list[int], alone: int = WALK) -> DataFrame:
    """``(node, d)``: length of the shortest way from each source, the weights of edges being lengths; infinite where there is none.

    The number of sources is bounded by the caller; a round lengthens all ways by one edge.
    """
    lengths = weighted(edges).drop("weight").distinct()
    if "weight" in edges.columns:
        own = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"))
        ends = own.unionByName(own.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")).where("src != dst and weight > 0")
        both = cut(ends.groupBy("src", "dst").agg(F.min("weight").alias("weight")))
    else:
        both = cut(lengths.withColumn("weight", F.lit(1.0)))
    if both.count() <= alone:

        def work(nodes, at, to, weight):
            d = np.full((len(nodes), len(sources)), np.inf)
            for j, s in enumerate(sources):
                d[nodes == s, j] = 0
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            some = max(1, min(16, 16_000_000 // max(1, len(at))))
            for lo in range(0, len(sources), some):  # some sources at a time, so that edges times sources stay small
                part = d[:, lo : lo + some]
                while True:
                    new = np.minimum(part, np.minimum.reduceat(part[to] + weight[:, None], first))
                    if (new == part).all():
                        break
                    part = new
                d[:, lo : lo + some] = part
            return pd.DataFrame({"node": nodes, "d": [*d]})

        return _in_one_task(both, work, "node long, d array<double>")
    far, n = F.lit(float("inf")), len(sources)
    state = cut(both.select(F.col("src").alias("node")).distinct().select("node", F.array(*(F.when(F.col("node") == s, 0.0).otherwise(far) for s in sources)).alias("d")))
    before = None
    while True:
        reached = F.aggregate("d", F.lit(0.0), lambda s, x: s + F.when(x == far, 1e12).otherwise(x))
        now = state.agg(F.sum(reached)).first()[0]
        if now == before:
            return state
        before = now
        step = both.join(state.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.array(*(F.min(F.col("d")[j] + F.col("weight")) for j in range(n))).alias("e"))
        state = cut(state.join(step, "node").select("node", F.zip_with("d", "e", lambda a, b: F.least(a, b)).alias("d")))


def _perspectives(d: np.ndarray, t: np.ndarray, times: np.ndarray, scale: float) -> np.ndarray:
    """Time of each row as the waypoints see it, from its distance to each and from their times; near ones count more."""
    sign = np.where(t[:, None] < times, -1.0, 1.0)
    sign[:, 0] = 1.0  # nothing is before the root
    weight = np.exp(-0.5 * (d / scale) ** 2) + 1e-12
    return (weight * (times + sign * d)).sum(axis=1) / weight.sum(axis=1)


def branch_model(d: np.ndarray, rounds: int = 20) -> dict:
    """Times of the waypoints round by round, and how strongly each belongs to either branch, from the distances between all of them.

    Two waypoints disagree by as much as the way between them is longer than their times are apart: ways between branches go back to
    where these part. The eigenvector of the lowest value of that matrix has one sign on either branch.
    """
    scale = float(d.std() * 0.5) or 1.0
    t, history = d[:, 0], [d[:, 0]]
    for _ in range(rounds):
        new = _perspectives(d, t, t, scale)
        history.append(new)
        still = np.abs(new - t).max() <= 1e-4 * max(float(t.max()), 1e-12)
        t = new
        if still:
            break
    apart = np.clip(d - np.abs(t[:, None] - t), 0, None)
    values, vectors = np.linalg.eigh(apart)
    side = vectors[:, 0] * np.sign(vectors[np.argmax(np.where(np.abs(vectors[:, 0]) > 0.2 * np.abs(vectors[:, 0]).max(), t, -1)), 0])
    cross = np.outer(np.clip(side, 0, None), np.clip(-side, 0, None))
    cross[apart < 0.1 * max(float(t.max()), 1e-12)] = 0
    if not cross.any():
        return {"history": history, "scale": scale, "side": np.zeros(len(t)), "fork": np.inf}
    meet = ((t[:, None] + t - d) / 2).ravel()
    order = np.argsort(meet)
    share = np.cumsum(cross.ravel()[order])
    fork = float(meet[order][np.searchsorted(share, share[-1] / 2)])
    return {"history": history, "scale": scale, "side": np.where(t > fork, side, 0.0), "fork": fork}


def branches(edges: DataFrame, root: int, waypoints: int = 250, alone: int = WALK) -> DataFrame:
    """``(node, time, branch)`` of a trajectory that parts once: branch 1 before the fork, 2 and 3 after it, 2 that of the latest waypoint.

    Weights of edges are lengths. Waypoints, ``waypoints`` at most and the root among them, are drawn
    by a digest of the nodes that the root reaches; only distances between waypoints come to the driver. All is
    branch 1 if no two waypoints disagree by a tenth of the whole time. Nodes that the root does not reach have time 0
    and branch 0. A root without edges reaches nothing.
    """
    edges = cut(edges)  # read three times
    nodes = cut(weighted(edges).select(F.col("src").alias("node")).distinct())
    reached = cut(distances(edges, [root], alone)).where(F.col("d")[0] < float("inf"))
    drawn = reached.where(F.col("node") != root).orderBy(F.md5(F.col("node").cast("string")), "node").limit(waypoints - 1)
    points = [root, *(r["node"] for r in drawn.select("node").collect())]
    far = cut(distances(edges, points, alone)).join(reached.select("node"), "node")
    rows = {r["node"]: r["d"] for r in far.where(F.col("node").isin(points)).collect()}
    if root not in rows:
        return nodes.select("node", F.lit(0.0).alias("time"), F.lit(0).alias("branch"))
    model = branch_model(np.array([rows[p] for p in points]))

    def placed(frames):
        for f in frames:
            if len(f):
                d = np.stack(f["d"].to_numpy())
                t = d[:, 0]
                for times in model["history"]:
                    t = _perspectives(d, t, times, model["scale"])
                vote = (np.exp(-0.5 * (d / (model["scale"] / 4)) ** 2) * model["side"]).sum(axis=1)
                t[f["node"].to_numpy() == root] = 0.0
                yield pd.DataFrame({"node": f["node"], "time": t, "branch": np.where((t <= model["fork"]) | (vote == 0), 1, np.where(vote > 0, 2, 3))})

    found = far.mapInPandas(placed, "node long, time double, branch int")
    return nodes.join(found, "node", "left").select("node", F.coalesce("time", F.lit(0.0)).alias("time"), F.coalesce("branch", F.lit(0)).alias("branch"))
