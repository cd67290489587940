"""Readers of the formats that need no library: tables, label sets, metadata, raw arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed order in which parts of a path tell its format.
FORMATS = ((".h5", "h5"), (".nii", "nii"), (".dm3", "dm3"), (".tif", "tif"), (".ims", "ims"), (".bdv", "bdv"), (".czi", "czi"), (".lif", "lif"))


def sniff(path: str) -> str:
    """The format that a path's text tells; ``tifs`` for a folder, ``dat`` for none."""
    for mark, name in FORMATS:
        if mark in path:
            return name
    return "tifs" if path.endswith("/") else "dat"


def format_of(path: str) -> Column:
    """The same as a column."""
    out = F.when(F.endswith(F.col(path), F.lit("/")), "tifs").otherwise("dat")
    for mark, name in reversed(FORMATS):
        out = F.when(F.contains(F.col(path), F.lit(mark)), name).otherwise(out)
    return out


def imaris_metadata(ext_min: str, ext_max: str, n: str) -> tuple[Column, Column]:
    """World origin and voxel sizes (arrays along z, y, x) from extents and dimensions."""
    return F.col(ext_min), F.zip_with(F.zip_with(ext_max, ext_min, lambda b, a: b - a), n, lambda d, k: F.try_divide(d, k))


def micrometres(*metres: str) -> list[Column]:
    return [F.col(c) * 1e6 for c in metres]


def label_sets(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``key: l1 l2 …`` -> ``(key, label)``."""
    line = F.split("value", ":", 2)
    rows = spark.read.text(path).where(F.contains("value", F.lit(":")))
    labels = F.filter(F.split(F.trim(line[1]), r"\s+"), lambda x: x != "")
    return rows.select(F.trim(line[0]).alias("key"), F.explode(labels.cast("array<long>")).alias("label"))


def feature_tables(spark: SparkSession, path: str, schema: str, least: int = 0) -> DataFrame:
    """All CSV files of a folder with their name, without files of ``least`` rows or fewer."""
    rows = spark.read.schema(schema).option("header", True).csv(path).withColumn("file", F.col("_metadata.file_name"))
    enough = rows.groupBy("file").count().where(F.col("count") > least).select("file")
    return rows.join(enough, "file", "left_semi")


def stratified(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``<species>/<antibody>/`` with both as columns; ``primaries`` is a species of its own."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    parts = F.split("path", "/")
    return files.select("path", "length", F.element_at(parts, -3).alias("species"), F.element_at(parts, -2).alias("antibody"), F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("sample_id"))


def ome_metadata(xml: DataFrame, column: str = "xml") -> DataFrame:
    """OME-XML -> a row a series: name, axis order, dtype, extents and voxel sizes."""
    schema = "Image array<struct<_Name:string, Pixels:struct<_DimensionOrder:string,_Type:string,_SizeX:long,_SizeY:long,_SizeZ:long,_SizeC:long,_SizeT:long,_PhysicalSizeX:double,_PhysicalSizeY:double,_PhysicalSizeZ:double>>>"
    images = xml.select(F.explode(F.from_xml(F.col(column), schema)["Image"]).alias("i"))
    return images.select(F.col("i._Name").alias("name"), F.col("i.Pixels._DimensionOrder").alias("order"), F.col("i.Pixels._Type").alias("dtype"), *(F.col(f"i.Pixels._Size{a}").alias(f"n{a.lower()}") for a in "XYZCT"), *(F.coalesce(F.col(f"i.Pixels._PhysicalSize{a}"), F.lit(1.0)).alias(f"d{a.lower()}") for a in "XYZ"))


class _Plane(InputPartition):
    def __init__(self, path: str, z: int):
        self.path, self.z = path, z


class _Reader(DataSourceReader):
    def __init__(self, path: str, planes: tuple[int, int]):
        self.path, self.planes = path, planes

    def partitions(self):
        import numpy as np

        n = np.load(self.path, mmap_mode="r").shape[0]
        lo, hi = self.planes
        return [_Plane(self.path, z) for z in range(lo, min(hi or n, n))]

    def read(self, part: _Plane):
        import numpy as np
        import pyarrow as pa

        a = np.asarray(np.load(part.path, mmap_mode="r")[part.z])
        y, x = np.indices(a.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(a.size, part.z, np.int64)), pa.array(y.ravel()), pa.array(x.ravel()), pa.array(a.ravel().astype(np.int64))], ["z", "y", "x", "v"])


class ArraySource(DataSource):
    """``spark.read.format("tessera_array").load(path)``: a .npy volume on a file system that all machines share.

    One partition a plane; only its bytes are read. Options ``z0`` and ``z1``
    bound the planes, so a slice does not touch the rest.
    """

    @classmethod
    def name(cls) -> str:
        return "tessera_array"

    def schema(self) -> str:
        return "z long, y long, x long, v long"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], (int(self.options.get("z0", 0)), int(self.options.get("z1", 0))))


def imaris_spacing(ext_min: list[float], ext_max: list[float], dims: list[int]) -> list[float]:
    """Voxel sizes from extents, with 1 for channel and time."""
    return [(b - a) / n for a, b, n in zip(ext_min, ext_max, dims)] + [1.0, 1.0]


def bdv_name(timepoint: int, channel: int, level: int) -> str:
    return f"t{timepoint:05d}/s{channel:02d}/{level}/cells"


def block_number(path: str) -> int | None:
    """The number in ``…_B00012…``."""
    m = re.search(r"_B(\d{5})", path)
    return int(m[1]) if m else None
