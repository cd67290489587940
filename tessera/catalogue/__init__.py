"""All registered queries of the engine and the SQL that they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import assembly, formats, geometry, grids, intensity, labels, manifolds, neighbours, pipelines, profiling, samples, segmentation, tables  # noqa: F401
from .registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
