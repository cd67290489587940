"""What operators need of the session: checkpoints, numbering, and closures of graphs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Edges, at most, that one task closes on its own; more are contracted by steps over all tasks first.
REMAINDER = 200_000
#: Edges, at most, of a graph whose communities one task finds: about 0.45 GB of arrays while it runs, and the table itself.
GRAPH = 2_000_000
#: Edges, at most, of a graph whose steps, ways or eigenvectors one task finds: ends and weights are 24 bytes an edge.
WALK = 5_000_000
_STORED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset a folder of our own, which a local master alone may use."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="tessera-")
        sc.setCheckpointDir(folder)
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there.

    Spark removes the files once nothing refers to them if the session was
    started with ``spark.cleaner.referenceTracking.cleanCheckpoints``; else they stay
    until the folder is cleared.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it again.

    For wide tables, of which later steps read some columns. The files stay
    until ``clear``, since the result may be read at any time.
    """
    path = f"{shared_folder(df.sparkSession)}/tessera-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete what ``stored`` has written for this driver; to be called once the results that read it are written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)


def numbered(rows: DataFrame, to: str, *order: Column | str) -> DataFrame:
    """Rows with their number from 1 in some order, in column ``to``, without one task that sees them all.

    Ranges of the order go to partitions, written once so that a lost task
    finds the same rows again; each is numbered on its own, and the counts of
    the ranges before it, a number a partition, are added.
    """
    ranged = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before, total = {}, 0
    for part, n in sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect()):
        before[part], total = total, total + n
    offset = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))[F.col("_part")] if before else F.lit(0)
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn(to, place.cast("long") + offset.cast("long")).drop("_part")


def roots(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some edges, in order, and the least node that each is connected with."""
    nodes, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = at[: len(src)], at[len(src) :]
    up = np.arange(len(nodes))
    while True:
        ra, rb = up[a], up[b]
        open_ = ra != rb
        if not open_.any():
            return nodes, nodes[up]
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up != up[up]).any():
            up = up[up]


def _closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if len(b)]
    if held:
        node, root = roots(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` of longs -> ``(node, root)``, root the least node reachable.

    Large-star and small-star steps alternate until ``REMAINDER`` edges are
    left at most, which one task closes, or until the edges stay as they
    are; every step groups by one end with a map-side minimum, and joins that
    one value back, so no neighbour list is ever gathered in one task. Nulls
    and loops are dropped; nodes without an edge do not appear; an empty table
    gives an empty table.
    """
    e = cut(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"), F.expr("src is null or dst is null").alias("bad"))
        .where("not bad and u != v")
        .select("u", "v")
        .distinct()
    )
    before = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] <= REMAINDER:
            return e.coalesce(1).mapInArrow(_closing, "node long, root long")
        if state == before:
            break
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        e = cut(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
    tops = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(tops)
