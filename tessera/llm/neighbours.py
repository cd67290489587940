"""Nearest neighbours through a hash-prefix forest.

Each tree is a sorted array of long hash strings, one bit for the side of
each of ``BITS`` random hyperplanes. A query descends every tree to its
longest common prefix, and then ascends all trees together, one bit a step,
until the rows below the reached nodes are enough candidates. Prefixes are of
variable length, and no bucket has a cap. Largest inner products become
nearest directions by one more coordinate that brings all rows to one length.

Rows are dealt to shards by a hash-prefix tree of their own, whose prefixes
are as long as it takes to have about ``SHARD`` rows below each (judged on at
most about ``SAMPLE`` rows; every row is indexed). A query visits the shards
whose prefixes it misses by the least margins. How many shards, and in a
shard how many candidates, is measured: some queries are compared with all
rows, and both grow until the recall reaches ``REACHED`` and ``TARGET``.

Copies of a vector are one row of the index and one query. Products of
candidates only choose; what is reported is summed anew, component by
component, so that equal vectors have equal scores wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

BITS, TREES, SHARD, BLOCK = 32, 48, 8192, 4096
#: Rows, at most about, on which the prefixes of shards are judged.
SAMPLE = 100_000
#: Share of the true neighbours of ``ASKED`` queries that the visited shards must hold.
REACHED = 0.98
#: Recall to be reached in a shard on ``ASKED`` of its queries, the count of candidates to begin with, and by what it grows.
TARGET, ASKED, LEAST, GROWTH = 0.95, 64, 100, 1.3


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with one more coordinate, all of length ``top`` squared."""
    return np.hstack([x, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))[:, None]])


def coded(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    bits = len(planes)
    return (x @ planes.T > 0) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


class Forest:
    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 5):
        high = lifted(x, float(np.einsum("ij,ij->i", x, x).max()))
        self.planes = np.random.default_rng(seed).normal(size=(trees, bits, high.shape[1]))
        self.bits, self.codes, self.rows = bits, [], []
        for p in self.planes:
            code = coded(high, p)
            order = np.argsort(code, kind="stable")
            self.codes.append(code[order])
            self.rows.append(order)

    def candidates(self, q: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query the rows below its nodes, once the nodes of all trees hold ``enough``."""
        high = np.hstack([q, np.zeros((len(q), 1))])
        codes = [coded(high, p) for p in self.planes]
        lo = np.zeros((len(self.planes), len(q)), np.int64)
        hi = lo.copy()
        todo = np.arange(len(q))
        for shift in range(self.bits + 1):
            for t, code in enumerate(codes):
                prefix = code[todo] >> shift
                lo[t, todo] = np.searchsorted(self.codes[t], prefix << shift)
                hi[t, todo] = np.searchsorted(self.codes[t], (prefix + 1) << shift)
            todo = todo[(hi - lo).sum(axis=0)[todo] < enough]
            if not len(todo):
                break
        for k in range(len(q)):
            yield np.unique(np.concatenate([self.rows[t][lo[t, k] : hi[t, k]] for t in range(len(codes))]))


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, summed from the first component to the last."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * q[:, j]
    return out


def nearest(x: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): the ``k`` best of the distinct rows of one shard for each query, and those that equal the last one."""
    forest, length = Forest(x), np.sqrt(np.einsum("ij,ij->i", x, x).max())

    def best(v: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= k:
            return rows
        score = x[rows] @ v
        # equal vectors may differ in their last bits here, so rows that come this close stay
        slack = 8 * len(v) * np.finfo(float).eps * length * np.sqrt(v @ v)
        return rows[score >= np.partition(score, -k)[-k] - slack]

    asked = np.unique(np.linspace(0, len(q) - 1, ASKED).astype(int))
    every, most = np.arange(len(x)), len(forest.planes) * len(x)
    enough = min(max(LEAST, 4 * k), most)
    if enough < most:
        true = [best(q[i], every) for i in asked]
        while enough < most:
            hit = sum(int(np.isin(t, rows).sum()) for t, rows in zip(true, forest.candidates(q[asked], enough)))
            if hit >= TARGET * sum(map(len, true)):
                break
            enough = min(most, int(enough * GROWTH) + 1)
    found = [best(v, rows) for v, rows in zip(q, forest.candidates(q, enough))]
    at, rows = np.repeat(np.arange(len(q)), list(map(len, found))), np.concatenate(found)
    return at, rows, exact(x[rows], q[at])


class Router:
    """The hash-prefix tree that deals vectors of one length to shards."""

    def __init__(self, sample: np.ndarray, dim: int, rows: int, top: float, shard: int, seed: int = 3):
        self.top, self.planes = top, np.random.default_rng(seed).normal(size=(BITS, dim + 1))
        code = np.sort(coded(lifted(sample, top), self.planes)) if len(sample) else np.zeros(0, np.int64)
        share = rows / max(1, len(code))
        self.leaves: list[tuple[int, int]] = []  # (prefix, bits), in the order of prefixes
        self.parts: list[int] = []
        stack = [(0, 0)]
        while stack:
            prefix, depth = stack.pop()
            shift = BITS - depth
            n = share * (np.searchsorted(code, (prefix + 1) << shift) - np.searchsorted(code, prefix << shift))
            if n > shard and depth < BITS:
                stack += [(prefix << 1 | 1, depth + 1), (prefix << 1, depth + 1)]
            else:
                self.leaves.append((prefix, depth))
                self.parts.append(max(1, int(np.ceil(n / shard))))  # more than one only where hash strings end
        self.first = np.array([p << (BITS - d) for p, d in self.leaves])
        bit = np.arange(BITS)
        depth = np.array([d for _, d in self.leaves])[:, None]
        on = (self.first[:, None] >> (BITS - 1 - bit)) & 1
        self.zero, self.one = ((on == 0) & (bit < depth)).astype(float), ((on == 1) & (bit < depth)).astype(float)

    def shards(self, x: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, coded(lifted(x, self.top), self.planes), side="right") - 1

    def order(self, q: np.ndarray) -> np.ndarray:
        """All shards in the order of the margins by which each query misses their prefixes."""
        side = np.hstack([q, np.zeros((len(q), 1))]) @ self.planes.T / np.maximum(np.sqrt(np.einsum("ij,ij->i", q, q)), 1e-300)[:, None]
        cost = np.where(side > 0, side * side, 0) @ self.zero.T + np.where(side > 0, 0, side * side) @ self.one.T
        return np.argsort(cost, axis=1, kind="stable")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is neither null nor zero and has only finite components."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), fine.alias("ok"))
    # a zero has one sign, so that equal vectors are equal bit by bit
    return rows.where("ok and vec_id is not null and exists(v, x -> x != 0)").select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))


def _local(k: int):
    """Of the copies of a vector in one batch the least ids, so that a very common vector is few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids: dict[bytes, set[int]] = {}
            values, offsets = b.column("v").flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(b.column("v").value_lengths().to_numpy())])
            for i, (a, z) in zip(b.column("vec_id").to_pylist(), zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                ids.setdefault(values[a:z].tobytes(), set()).add(i)
            vectors = pa.array([np.frombuffer(v) for v in ids], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([vectors, pa.array([sorted(x)[:k] for x in ids.values()], pa.list_(pa.int64()))], ["v", "ids"])

    return run


def distinct(rows: DataFrame, k: int) -> DataFrame:
    """``rows(vec_id, v)`` -> ``(v, ids)``: each vector once, with the ``k`` least of its ids."""
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k)
    return rows.mapInArrow(_local(k), "v array<double>, ids array<long>").groupBy("v").agg(ids.alias("ids"))


def _routers(rows: DataFrame, shard: int) -> dict[int, Router]:
    """A router for each length of vectors."""
    n = F.size("v").alias("n")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    sizes = {r["n"]: (r["rows"], r["top"]) for r in rows.groupBy(n).agg(F.count("*").alias("rows"), F.max(square).alias("top")).collect()}
    total = sum(r for r, _ in sizes.values())
    drawn: dict[int, list[np.ndarray]] = {}
    if any(r > shard for r, _ in sizes.values()):
        sample = rows.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < F.lit(min(1.0, SAMPLE / total) * (1 << 30))).select("v").limit(2 * SAMPLE)
        for v in sample.toArrow().column("v"):
            v = np.asarray(v.values)
            drawn.setdefault(len(v), []).append(v)
    return {d: Router(np.array(drawn.get(d, np.zeros((0, d)))), d, r, top * (1 + 1e-12), shard) for d, (r, top) in sizes.items()}


def _probes(rows: DataFrame, asked: dict[int, np.ndarray], routers: dict[int, Router], k: int) -> int:
    """How many shards a query must visit so that ``REACHED`` of the true neighbours of the asked queries are in them."""

    def true(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            size = b.column("v").value_lengths().to_numpy()
            for d in np.unique(size).tolist():
                if d in asked:
                    x = matrix(b.column("v").filter(pa.array(size == d)))
                    score, shard = x @ asked[d].T, np.repeat(routers[d].shards(x)[:, None], len(asked[d]), axis=1)
                    if d in held:
                        score, shard = np.concatenate([held[d][0], score]), np.concatenate([held[d][1], shard])
                    top = np.argsort(-score, axis=0, kind="stable")[:k]
                    held[d] = np.take_along_axis(score, top, 0), np.take_along_axis(shard, top, 0)
        for d, (score, shard) in held.items():
            which = np.repeat(np.arange(score.shape[1])[None, :], len(score), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(score.size, d, np.int32)), pa.array(which.ravel().astype(np.int32)), pa.array(score.ravel()), pa.array(shard.ravel().astype(np.int64))], ["n", "q", "score", "shard"])

    best = F.slice(F.sort_array(F.collect_list(F.struct("score", "shard")), asc=False), 1, k)
    found = rows.select("v").mapInArrow(true, "n int, q int, score double, shard long").groupBy("n", "q").agg(best.alias("best"))
    rank = {d: np.argsort(routers[d].order(q), axis=1) for d, q in asked.items()}
    need = sorted(int(rank[r["n"]][r["q"], s["shard"]]) + 1 for r in found.collect() for s in r["best"])
    return need[int(np.ceil(REACHED * len(need))) - 1] if need else 1


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``vectors``, ``queries`` (vec_id, embedding) -> (query_id, rank, vec_id, score).

    The ``k`` rows found with the largest inner products, ties to the smaller
    vec_id; a query's own row is none of them. Unusable vectors (null, zero,
    with null or non-finite components) and null ids take no part. Vectors of
    another length than a query's are none of its candidates. Rows with one id and one
    vector count as one; if one id has several vectors, each is a row, and a query of its
    own. Without vectors or queries there are no rows. Other columns are ignored.
    """
    x, asked = cut(distinct(usable(vectors), k + 1)), cut(usable(queries).distinct())
    one_each = cut(asked.select("v").distinct().withColumn("q", F.monotonically_increasing_id()))
    routers = _routers(x, shard)
    some: dict[int, list[np.ndarray]] = {}
    for v in one_each.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(ASKED).toArrow().column("v"):
        some.setdefault(len(v), []).append(np.asarray(v.values))
    sharded = {d: np.array(v) for d, v in some.items() if d in routers and len(routers[d].leaves) > 1}
    probes = _probes(x, sharded, routers, k + 1) if sharded else max((len(r.leaves) for r in routers.values()), default=1)

    def dealing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("v").value_lengths().to_numpy()
            shards, parts = np.zeros(len(b), np.int64), np.ones(len(b), np.int32)
            for d in np.unique(size).tolist():
                mine = np.flatnonzero(size == d)
                shards[mine] = routers[d].shards(matrix(b.column("v").take(pa.array(mine))))
                parts[mine] = np.array(routers[d].parts, np.int32)[shards[mine]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size.astype(np.int32)), pa.array(shards), pa.array(parts)], [*b.schema.names, "n", "shard", "parts"])

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("v").value_lengths().to_numpy()
            for at in range(0, len(b), 64):
                for d in np.unique(size[at : at + 64]).tolist():
                    if d in routers:
                        mine = at + np.flatnonzero(size[at : at + 64] == d)
                        goes = routers[d].order(matrix(b.column("v").take(pa.array(mine))))[:, :probes]
                        part = b.take(pa.array(np.repeat(mine, goes.shape[1])))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(part), d, np.int32)), pa.array(goes.ravel()), pa.array(np.array(routers[d].parts, np.int32)[goes.ravel()])], [*part.schema.names, "n", "shard", "parts"])

    cell = ["n", "shard", "part", "block"]
    rows = x.mapInArrow(dealing, "v array<double>, ids array<long>, n int, shard long, parts int")
    asks = one_each.mapInArrow(visiting, "v array<double>, q long, n int, shard long, parts int")
    visits = asks.groupBy("n", "shard").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).join(visits, ["n", "shard"]).select("v", "ids", "n", "shard", "part", every("blocks").alias("block"))
    right = asks.join(visits, ["n", "shard"]).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).select("v", "q", "n", "shard", every("parts").alias("part"), "block")

    def one(rows: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("q", pa.int64()), ("shard", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64()), ("same", pa.bool_())])
        if not len(rows) or not len(asked):
            return schema.empty_table()
        v, w, ids = matrix(rows.column("v")), matrix(asked.column("v")), rows.column("ids").combine_chunks()
        at, row, score = nearest(v, w, k + 1)
        same = (v[row] == w[at]).all(axis=1)
        offset, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        many = offset[row + 1] - offset[row]
        each = np.repeat(np.arange(len(row)), many)
        vec = flat[np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + offset[row][each]]
        order = np.lexsort((vec, -score[each], at[each]))
        place = np.arange(len(order)) - np.searchsorted(at[each][order], at[each][order])
        keep = order[place <= k]
        pick = each[keep]
        number = asked.column("q").to_numpy()
        return pa.table([pa.array(number[at[pick]]), pa.array(np.full(len(pick), rows.column("shard")[0].as_py(), np.int64)), pa.array(score[pick]), pa.array(vec[keep]), pa.array(same[pick])], schema=schema)

    tasks = max(1, min(sum(sum(r.parts) for r in routers.values()), 4 * vectors.sparkSession.sparkContext.defaultParallelism))
    dealt = [t.repartition(tasks, *cell).groupBy(*cell) for t in (left, right)]
    found = dealt[0].cogroup(dealt[1]).applyInArrow(one, "q long, shard long, score double, vec_id long, same boolean")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score", "same"))), 1, k + 1)
    if probes > 64:  # the results of 64 shards at a time, so that no list grows with the number of shards
        found = found.groupBy("q", F.expr("shard div 64").alias("g")).agg(best.alias("best")).select("q", F.inline("best"))
    listed = found.groupBy("q").agg(best.alias("best"))
    # each query leaves out its own row, and takes the first k of the others
    own = asked.join(one_each, "v").select(F.col("vec_id").alias("query_id"), "q").join(listed, "q")
    others = F.slice(F.filter("best", lambda b: ~(b["same"] & (b["vec_id"] == F.col("query_id")))), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("rank", "b"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
