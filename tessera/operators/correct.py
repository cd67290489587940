"""Thresholds, profiles and corrections of intensities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maths import sd
from .stencil import downsample, upsample


def classes(v: Column, noise: float, tissue: float, signal: float, clip: float) -> Column:
    """noise 1, tissue 2, signal 3, all else and clipped 0; the last that holds wins."""
    return F.when(v >= clip, 0).when(v > signal, 3).when((v > tissue) & (v < clip), 2).when(v < noise, 1).otherwise(0)


def channel_mean(vox: DataFrame) -> DataFrame:
    """Mean of the channels at each place, truncated to an integer."""
    return vox.groupBy("z", "y", "x").agg(F.floor(F.avg("v")).cast("long").alias("m"))


def slice_thresholds(mean: DataFrame, least: float, factor: float) -> DataFrame:
    """Of each plane the larger of a constant and its median over a factor."""
    return mean.groupBy("z").agg(F.median("m").alias("med")).withColumn("threshold", F.greatest(F.lit(least), F.col("med") / factor))


def histogram(vox: DataFrame, bins: int = 256, v: str = "v") -> DataFrame:
    """Counts of equal bins from least to greatest value, the last one closed."""
    ends = vox.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    at = F.least(F.lit(bins - 1), F.floor((F.col(v) - F.col("lo")) * float(bins) / (F.col("hi") - F.col("lo"))).cast("int"))
    return vox.join(ends).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def otsu_bin(hist: DataFrame) -> DataFrame:
    """The bin after which the variance between both classes is largest; the histogram is a few hundred rows."""
    w, every = Window.orderBy("bin"), Window.partitionBy()
    h = hist.select("bin", F.sum("n").over(w).alias("n1"), F.sum(F.col("n") * F.col("bin")).over(w).alias("s1"), F.sum("n").over(every).alias("nn"), F.sum(F.col("n") * F.col("bin")).over(every).alias("ss")).where("nn > n1")
    between = F.col("n1").cast("double") * (F.col("nn") - F.col("n1")) * F.pow(F.col("s1").cast("double") / F.col("n1") - (F.col("ss") - F.col("s1")).cast("double") / (F.col("nn") - F.col("n1")), F.lit(2))
    return h.agg(F.max_by("bin", F.struct(between, -F.col("bin"))).alias("bin"))


def axis_profiles(vox: DataFrame) -> DataFrame:
    """Profiles along all three axes in one pass."""
    g = vox.groupingSets([[F.col("z")], [F.col("y")], [F.col("x")]], F.col("z"), F.col("y"), F.col("x")).agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.median("v").alias("median"))
    return g.select(F.when(F.col("x").isNotNull(), "x").when(F.col("y").isNotNull(), "y").otherwise("z").alias("axis"), F.coalesce("x", "y", "z").alias("at"), "n", "mean", "median")


def shading_profile(vox: DataFrame, noise: int, axis: str) -> DataFrame:
    return vox.where(F.col("v") >= noise).groupBy("c", "z", axis).agg(F.median("v").alias("profile"))


def select_planes(medians: DataFrame, q: float) -> DataFrame:
    return medians.join(medians.agg(F.percentile("med", q).alias("_q"))).where("med > _q").drop("_q")


def normalize_profile(profile: DataFrame) -> DataFrame:
    """Each plane over its last value, then the mean over planes."""
    last = profile.groupBy("z").agg(F.max_by("m", "x").alias("last"))
    return profile.join(last, "z").groupBy("x").agg(F.avg(F.try_divide(F.col("m"), F.col("last"))).alias("norm_mean"))


def polyfit(points: DataFrame, x: str, y: str, order: int) -> list[float]:
    """Least-squares coefficients, lowest first; sums of powers of the centred abscissa come to the driver.

    With fewer different points than coefficients those of the highest order are 0, without points all are.
    """
    order, asked = min(order, points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x).distinct().limit(order + 1).count() - 1), order
    if order < 0:
        return [0.0] * (asked + 1)
    mid = points.agg(F.avg(x), F.stddev_pop(x)).first()
    m, s = mid[0] or 0.0, mid[1] or 1.0
    t = (F.col(x) - m) / s
    sums = points.agg(*(F.sum(F.pow(t, F.lit(k))).alias(f"p{k}") for k in range(2 * order + 1)), *(F.sum(F.pow(t, F.lit(k)) * F.col(y)).alias(f"q{k}") for k in range(order + 1))).first()
    a = np.array([[sums[f"p{i + j}"] for j in range(order + 1)] for i in range(order + 1)])
    c = np.linalg.solve(a, np.array([sums[f"q{i}"] for i in range(order + 1)]))
    found = np.polynomial.Polynomial(c)(np.polynomial.Polynomial([-m / s, 1 / s])).coef.tolist()
    return found + [0.0] * (asked + 1 - len(found))


def plane_stats(vox: DataFrame) -> DataFrame:
    return vox.groupBy("z").agg(F.avg("v").alias("mean"), sd("v").alias("sd"))


def attenuation(vox: DataFrame) -> DataFrame:
    """Every plane brought to mean and deviation of the brightest one (the first of several)."""
    s = plane_stats(vox)
    ref = s.agg(F.max_by(F.struct("mean", "sd"), F.struct(F.col("mean"), -F.col("z"))).alias("r"))
    return vox.join(s, "z").join(ref).withColumn("corrected", F.col("r.mean") + F.col("r.sd") * F.try_divide(F.col("v") - F.col("mean"), F.col("sd"))).drop("mean", "sd", "r")


def divide_by_bias(vox: DataFrame, factors: dict[str, int]) -> DataFrame:
    """Values over a bias field estimated on a coarse grid; 0 where that is 0."""
    low = downsample(vox, factors).withColumnRenamed("v", "bias")
    return upsample(vox, low, factors, "bias").withColumn("corrected", F.coalesce(F.try_divide(F.col("v"), F.col("bias")), F.lit(0.0)))


def apply_shading(vox: DataFrame) -> DataFrame:
    """Values over the product of the profiles along x and y, each relative to its maximum."""
    out = vox
    for a in ("x", "y"):
        p = vox.groupBy(a).agg(F.avg("v").alias("m"))
        out = out.join(p.join(p.agg(F.max("m").alias("top"))).select(a, (F.col("m") / F.col("top")).alias(f"p{a}")), a)
    return out.withColumn("flat", F.try_divide(F.col("v"), F.col("px") * F.col("py"))).drop("px", "py")
