"""Exact top-k search by tiles of matrix products.

Queries and rows are dealt to blocks of bounded size. A tile is a block of
queries and a block of rows, one task's work: its product is made some
queries at a time, and of each query's scores a partial selection keeps the k
best. A tree over the blocks of rows then merges a bounded number of lists at a time.
Components are integers, so products are exact: in floating point as long as no
sum can leave the range of exact ones, else in integers.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

#: Bytes of vectors in a block, scores of a tile held at a time, and lists merged at a time.
BLOCK_BYTES, SCORES, FAN = 32_000_000, 4_000_000, 32
LEAST = np.iinfo(np.int64).min


def scaled(embedding: Column | str, by: int = 1024) -> Column:
    """Each component, as a double, times ``by``, rounded down; beyond the range of longs it is the end of that range."""
    return F.transform(F.col(embedding) if isinstance(embedding, str) else embedding, lambda x: F.floor(x.cast("double") * by))


def whole(embedding: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    return F.col(embedding).isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer rows with integer rows, exact; beyond the range of longs they are the end of that range."""
    most = q.shape[1] * max(abs(int(q.max(initial=0))), abs(int(q.min(initial=0)))) * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if most < 1 << 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    wide = q.astype(object) @ x.astype(object).T
    return np.clip(wide, LEAST, -LEAST - 1).astype(np.int64)


def selected(score: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the k best scores of each query, in any order; ``ids`` ascend, and rows with the query's own id are out."""
    n = len(ids)
    lo, hi = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
    if n and int(np.abs(score).max(initial=0)) < (1 << 61) // n:
        # score and place in one number: no ties, so the k-th best splits each row in one pass
        key = score * n + np.arange(n - 1, -1, -1)
        for i in np.flatnonzero(hi > lo):
            key[i, lo[i] : hi[i]] = LEAST
        at = np.argpartition(key, n - k, axis=1)[:, n - k :] if k < n else np.broadcast_to(np.arange(n), key.shape)
        row, column = np.nonzero(np.take_along_axis(key, at, 1) > LEAST)
        return row, at[row, column]
    rows, found = [], []
    for i in range(len(score)):
        other = np.r_[0 : lo[i], hi[i] : n]
        best = other[np.argsort(~score[i, other], kind="stable")[:k]]  # ~ turns the order round without leaving the range
        rows.append(np.full(len(best), i))
        found.append(best)
    return np.concatenate(rows), np.concatenate(found)


def _matrices(t: pa.Table) -> dict[int, tuple[np.ndarray, pa.Table]]:
    """Vectors of each length, and their rows, by ascending id."""
    t = t.take(pc.sort_indices(t, [("id", "ascending")]))
    size = pc.list_value_length(t.column("v")).to_numpy()
    out = {}
    for n in np.unique(size):
        part = t.filter(pa.array(size == n))
        out[int(n)] = part.column("v").combine_chunks().flatten().to_numpy().reshape(len(part), n), part
    return out


def _tile(k: int):
    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        queries, rows = _matrices(left), _matrices(right)
        out = [pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "same", "block", "turned", "vec_id")})]
        for n, (q, own) in queries.items():
            if n not in rows:
                continue
            x, among = rows[n]
            ids, asked, same = among.column("id").to_numpy(), own.column("id").to_numpy(), own.column("same").to_numpy()
            step = max(1, SCORES // len(ids))
            for at in range(0, len(q), step):
                score = product(q[at : at + step], x)
                i, j = selected(score, asked[at : at + step], ids, k)
                out.append(pa.table({"query_id": asked[at + i], "same": same[at + i], "block": np.full(len(i), key[1].as_py(), np.int64), "turned": ~score[i, j], "vec_id": ids[j]}))
        return pa.concat_tables(out)

    return tile


def search(rows: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """``rows(vec_id, v)`` and ``queries(vec_id, v)``, v of longs -> ``(query_id, rank, vec_id, score)``: each query's k rows of largest inner product, exactly.

    Ties go to the smaller id. A query has all rows but those of its own id for candidates,
    all of them if they are fewer than k; vectors of different lengths are not
    compared. Rows without an id, without a vector, or with null components take no part. Repeated rows
    are found as often as they stand there; repeated queries are one, and different vectors
    under one id have a list each. Other columns are ignored; an empty table on either side gives no rows.
    """
    def held(t: DataFrame) -> DataFrame:
        some = t.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()))
        return some.select(F.col("vec_id").cast("long").alias("id"), F.col("v").cast("array<long>").alias("v"))

    # written once, so that numbers of rows, and with them blocks, are the same in each attempt
    x = cut(held(rows))
    q = cut(held(queries).distinct())
    sizes = [t.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first() for t in (q, x)]
    n_q, n_x = (max(1, ceil(n * max(d, 1) * 8 / block_bytes)) for n, d in sizes)
    own = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = q.select("id", "v", F.xxhash64("v").alias("same"), own(n_q).alias("a")).select("*", every(n_x).alias("b"))
    right = x.select("id", "v", own(n_x).alias("b")).select("*", every(n_q).alias("a"))
    best = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(_tile(k), "query_id long, same long, block long, turned long, vec_id long")
    listed = F.slice(F.sort_array(F.collect_list(F.struct("turned", "vec_id"))), 1, k).alias("best")
    lists, node = best.groupBy("query_id", "same", "block").agg(listed), n_x
    while node > 1:
        node = ceil(node / fan)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
        lists = lists.groupBy("query_id", "same", F.floor(F.col("block") / fan).alias("block")).agg(merged)
    ranked = lists.select("query_id", F.posexplode("best").alias("rank", "x"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.bitwise_not(F.col("x.turned")).alias("score"))
