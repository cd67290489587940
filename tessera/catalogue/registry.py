"""Queries register here under their function's name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.voxels import VOX, voxels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def volume(sql: str | None = None):
    """A query over the voxel view; ``sql`` follows the view's common table expression."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(voxels(spark, sf_dir))
        if sql:
            SQL[f.__name__] = f"WITH RECURSIVE {VOX} {sql}"
        return f

    return add


def tables(sql: str | None = None):
    """A query over other tables: it gets ``read(name)``."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
