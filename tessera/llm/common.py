"""Helpers that all operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark's own reader so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(folds: int, out: int) -> Column:
    """Whether crc32 of ``doc_id`` as text, modulo the folds, is ``out``; a null id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == out, F.lit(False))
