"""Graphs and layouts of profiles over ``embeddings``, and fitted bias fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import biasfield, graphs, near, profile, umap
from ..runtime import cut
from ..sources.voxels import dims
from .profiling import _vectors
from .registry import tables, volume


def _edges(vectors: DataFrame, k: int) -> DataFrame:
    found = profile.knn(vectors, k)
    return found.select(F.col("id").alias("src"), F.col("other").alias("dst"), F.col("distance").alias("weight"))


@tables()
def diffusion_values(read) -> DataFrame:
    """Diffusion pseudotime of every row along its neighbour graph, from row 0 on."""
    t = graphs.diffusion_pseudotime(_edges(_vectors(read), 5).drop("weight"), 0, 3)
    return t.select("node", F.round("time", 6).alias("time"))


@tables()
def knn_graph(read) -> DataFrame:
    """About five neighbours of every row, without all pairs."""
    return near.neighbours(_vectors(read), 5, trees=12, block=64, rounds=3).withColumn("distance", F.round("distance", 6))


@tables()
def leiden_communities(read) -> DataFrame:
    """Connected communities of the fuzzy neighbour graph at two resolutions, named by their least row."""
    g = cut(umap.fuzzy_graph(profile.knn(_vectors(read), 5)))  # both resolutions read it
    one, two = (graphs.leiden(g, r).withColumnRenamed("community", f"leiden_{r:.2f}".replace(".", "_")) for r in (0.4, 0.8))
    return one.join(two, "node")


@tables()
def trajectory_branches(read) -> DataFrame:
    """Time from row 0 along the neighbour graph, its edges as long as their ends are apart, and the branch of each row."""
    found = graphs.branches(_edges(_vectors(read), 5), 0, 50)
    return found.select("node", F.round("time", 6).alias("time"), "branch")


@tables()
def umap_layout(read) -> DataFrame:
    """A layout of all rows in two dimensions."""
    v = _vectors(read)
    return umap.umap(v, profile.knn(v, 15)).select("node", F.round(F.col("place")[0], 6).alias("a"), F.round(F.col("place")[1], 6).alias("b"))


@tables()
def umap_placed(read) -> DataFrame:
    """Odd rows placed in the layout of the even ones, those far along its first axis left out and the layout made anew."""
    v = _vectors(read)
    train, test = v.where("id % 2 = 0"), v.where("id % 2 = 1")
    kept, layout = umap.without_far(train, lambda rows: profile.knn(rows, 5), 8.0)
    found = umap.placed(profile.knn(test, 5, among=kept), layout)
    return found.select("node", F.round(F.col("place")[0], 6).alias("a"), F.round(F.col("place")[1], 6).alias("b"))


@volume()
def bias_field(vox: DataFrame) -> DataFrame:
    """All voxels over a smooth field that is fitted to the sharpened histogram of their logarithms."""
    size, one = dims(vox), vox.select("z", "y", "x", "v")
    model = biasfield.fit(one, size, levels=2, points={"z": 4, "y": 5, "x": 5}, rounds=8)
    return biasfield.biased(one, model).select("z", "y", "x", "v", F.round("bias", 6).alias("bias"), F.round("corrected", 4).alias("corrected"))
