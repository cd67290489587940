"""Metrics that compare staining over samples: contrast, noise, their spread by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maths import sd
from .correct import classes


def quantile_metrics(pixels: DataFrame, by: tuple[str, ...], q: tuple[float, float], where: Column | None = None) -> DataFrame:
    """Background and foreground as two quantiles of the pixels, and their ratio."""
    p = pixels if where is None else pixels.where(where)
    g = p.groupBy(*by).agg(F.percentile("v", F.array(*map(F.lit, q))).alias("p"))
    return g.select(*by, F.col("p")[0].alias("background"), F.col("p")[1].alias("foreground"), F.try_divide(F.col("p")[1], F.col("p")[0]).alias("contrast"))


def segment_metrics(pixels: DataFrame, by: tuple[str, ...], noise: float, tissue: float, signal: float, clip: float) -> DataFrame:
    """Background and foreground as means of their classes, noise as the deviation of its class.

    Contrast is foreground over background. A sample without noise pixels has
    a deviation of 0, a contrast to noise of 0 and no signal to noise.
    """
    k = pixels.withColumn("k", classes(F.col("v"), noise, tissue, signal, clip))
    k = k.withColumn("noise", F.when(F.col("k") == 1, F.col("v")))
    g = k.groupBy(*by).agg(F.avg(F.when(F.col("k") == 2, F.col("v"))).alias("background"), F.avg(F.when(F.col("k") == 3, F.col("v"))).alias("foreground"), F.coalesce(sd("noise"), F.lit(0.0)).alias("noise_sd"))
    return g.select("*", F.try_divide(F.col("foreground"), F.col("background")).alias("contrast"), F.try_divide(F.col("foreground"), F.col("noise_sd")).alias("snr"), F.when(F.col("noise_sd") == 0, 0.0).otherwise(F.try_divide(F.col("foreground") - F.col("background"), F.col("noise_sd"))).alias("cnr"))


def group_stats(metrics: DataFrame, by: tuple[str, ...], names: tuple[str, ...]) -> DataFrame:
    """Mean and sample deviation of each metric."""
    return metrics.groupBy(*by).agg(*(e.alias(f"{n}_{k}") for n in names for k, e in (("mean", F.avg(n)), ("sd", F.stddev_samp(n)))))
