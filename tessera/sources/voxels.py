"""Volumes as long tables: one row a voxel, integer coordinates, integer values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Volume:
    """Metadata of a volume: axis letters, voxel size in micrometres, extent."""

    name: str
    axes: str = "zyxct"
    elsize: dict[str, float] = field(default_factory=dict)
    dims: dict[str, int] = field(default_factory=dict)
    dtype: str = "uint16"

    def size(self, axis: str) -> float:
        """Voxel size along an axis; 1 where it is not known."""
        return self.elsize.get(axis, 1.0)

    def slices(self, **given: tuple[int, int]) -> dict[str, tuple[int, int]]:
        """Start and stop of every axis; a stop of 0 means the end."""
        return {a: (given.get(a, (0, 0))[0], given.get(a, (0, 0))[1] or self.dims.get(a, 1)) for a in self.axes}

    def shape(self, **given: tuple[int, int]) -> tuple[int, ...]:
        return tuple(z - a for a, z in self.slices(**given).values())

    def without(self, axis: str) -> Volume:
        """The metadata once an axis is gone."""
        drop = lambda d: {k: v for k, v in d.items() if k != axis}
        return Volume(self.name, self.axes.replace(axis, ""), drop(self.elsize), drop(self.dims), self.dtype)


def default_axes(rank: int) -> str:
    """Axis letters of an array of which only the rank is known."""
    return {2: "yx", 3: "zyx", 4: "zyxc"}.get(rank, "zyxct"[:rank])


def box(**bounds: tuple[int, int]) -> Column:
    """Inside a hyper-rectangle, stops exclusive. Filters on plain columns reach the scan."""
    inside = F.lit(True)
    for axis, (start, stop) in bounds.items():
        inside = inside & (F.col(axis) >= start) & (F.col(axis) < stop)
    return inside


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table seen as a volume of planes of 25 x 20 voxels.

    ``label`` are compact objects of 4 x 5 x 5 voxels with holes, ``scattered``
    objects spread over the volume, ``truth`` compact objects moved by one
    voxel; 0 is background. ``block`` numbers the blocks of 10 x 10 x 10.
    """
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = e.select(
        "event_id",
        (F.col("event_id") % 20).alias("x"),
        F.expr("(event_id div 20) % 25").alias("y"),
        F.expr("event_id div 500").alias("z"),
        F.round(F.col("value") * 100).cast("long").alias("v"),
        F.expr("case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end").cast("int").alias("c"),
        F.expr("case when event_type = 'error' then 0L else 1 + user_id end").alias("scattered"),
    )
    compact = F.expr("1 + x div 5 + 4 * (y div 5) + 20 * (z div 4)")
    return out.select(
        "*",
        F.when(F.col("c") == 1, F.lit(0).cast("long")).otherwise(compact).alias("label"),
        F.expr("1 + (x + 1) div 5 + 5 * (y div 5) + 30 * (z div 4)").alias("truth"),
        F.expr("6 * (z div 10) + 2 * (y div 10) + x div 10").alias("block"),
    )


#: The same view in SQL, as a common table expression.
VOX = """vox AS (SELECT event_id, x, y, z, v, c, scattered,
  CASE WHEN c = 1 THEN 0 ELSE 1 + x // 5 + 4 * (y // 5) + 20 * (z // 4) END AS label,
  1 + (x + 1) // 5 + 5 * (y // 5) + 30 * (z // 4) AS truth,
  6 * (z // 10) + 2 * (y // 10) + x // 10 AS block
  FROM (SELECT event_id, event_id % 20 AS x, (event_id // 20) % 25 AS y, event_id // 500 AS z,
    CAST(round(value * 100) AS BIGINT) AS v,
    CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS INTEGER) AS c,
    CASE WHEN event_type = 'error' THEN 0 ELSE 1 + user_id END AS scattered FROM events))"""


def dims(vox: DataFrame) -> dict[str, int]:
    """Extent along z, y and x: one row to the driver."""
    row = vox.agg(*(F.max(a).alias(a) for a in "zyx")).first()
    return {a: (row[a] + 1 if row[a] is not None else 0) for a in "zyx"}
