"""Files of all formats written and read again, metadata, layouts, and parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks
from ..plans import layout
from ..runtime import shared_folder
from ..sources import codecs, files, hdf5, sinks
from ..sources.voxels import Volume, default_axes, dims
from .registry import tables, volume


def folder(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/tessera-{uuid.uuid4().hex}"


ALL = "SELECT z, y, x, v::DOUBLE AS v FROM vox"


@volume(ALL)
def nifti_files(vox: DataFrame) -> DataFrame:
    """Blocks as NIfTI files and back; names say where a block lies."""
    return codecs.decoded(codecs.encoded(vox, "nii"))


@volume(ALL)
def tiff_files(vox: DataFrame) -> DataFrame:
    return codecs.decoded(codecs.encoded(vox, "tif"))


@volume(ALL)
def tiff_planes(vox: DataFrame) -> DataFrame:
    """A file a plane."""
    return codecs.decoded(codecs.encoded(vox, "tif", by="z"))


@volume(ALL)
def hdf5_files(vox: DataFrame) -> DataFrame:
    """Blocks as HDF5 files of compressed chunks, and read again chunk by chunk."""
    return codecs.decoded(codecs.encoded(vox, "h5"))


@volume(ALL)
def czi_files(vox: DataFrame) -> DataFrame:
    """Blocks as CZI files of a subblock a plane, and read again."""
    return codecs.decoded(codecs.encoded(vox, "czi"))


@volume("SELECT z, y, x, (v % 60000)::DOUBLE AS v FROM vox")
def lif_files(vox: DataFrame) -> DataFrame:
    """Blocks as LIF files of 16-bit values."""
    return codecs.decoded(codecs.encoded(vox.withColumn("v", F.col("v") % 60000), "lif", dtype="u2"))


@volume(ALL)
def dm3_planes(vox: DataFrame) -> DataFrame:
    """A folder of micrographs, one a plane."""
    return codecs.decoded(codecs.encoded(vox, "dm3", by="z"))


@volume("""SELECT block, max(z) - min(z) + 1 AS nz, max(y) - min(y) + 1 AS ny, max(x) - min(x) + 1 AS nx, min(z) * 2.0::DOUBLE AS z0, 2.0::DOUBLE AS dz, 2 AS levels, sum(v)::BIGINT AS total, sum(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 0)::BIGINT AS total1, max(y) - min(y) + 1 AS bdv_y FROM vox GROUP BY block""")
def imaris_files(vox: DataFrame) -> DataFrame:
    """Blocks as Imaris files of two resolution levels, and as BigDataViewer files; dimensions, origin, sizes and data out of these."""

    def run(rows):
        import numpy as np
        import pandas as pd

        from ..operators.kernels import dense

        a, first, _ = dense(rows, "v")
        a, n = a.astype("i4"), dict(zip("zyx", a.shape))
        size = {"z": 2.0, "y": 1.0, "x": 1.0}
        ends = {f"ExtM{e}{k}": str(size[c] * (f + m)) for k, (c, f) in enumerate(zip("xyz", first[::-1])) for e, m in (("in", 0), ("ax", n[c]))}
        level = lambda d: {"TimePoint 0": {"Channel 0": {"Data": d}}}
        tree = {"DataSet": {"ResolutionLevel 0": level(a), "ResolutionLevel 1": level(a[:, ::2, ::2])}, "DataSetInfo": {"Image": {}}}
        f = hdf5.File.of(hdf5.Writer((2, 8, 8)).file(tree, {"/DataSetInfo/Image": {**{c.upper(): str(n[c]) for c in "zyx"}, **ends}}))
        p = hdf5.imaris_props(f)
        b = hdf5.bdv_props(hdf5.File.of(hdf5.Writer((2, 8, 8)).file({"t00000": {"s00": {"0": {"cells": a}}}})))
        total = [int(f.array(hdf5.imaris_path(k)).sum(dtype=np.int64)) for k in (0, 1)]
        return pd.DataFrame([(int(rows["block"].iloc[0]), *(p["dims"][c] for c in "zyx"), p["origin"]["z"], p["elsize"]["z"], p["levels"], *total, b["y"])])

    return vox.select("block", "z", "y", "x", "v").groupBy("block").applyInPandas(run, "block long, nz long, ny long, nx long, z0 double, dz double, levels int, total long, total1 long, bdv_y long")


@volume("SELECT z, y, x, floor((v - lo) * (255.0::DOUBLE / (hi - lo))) AS v FROM vox JOIN (SELECT z, min(v) AS lo, max(v) AS hi FROM vox GROUP BY z) USING (z)")
def png_planes(vox: DataFrame) -> DataFrame:
    """Planes as grey pictures, each stretched from its least to its greatest value, and read again."""
    return codecs.decoded(codecs.encoded(vox, "png", by="z"))


@volume("SELECT block, z, y, x, CASE WHEN block = 0 THEN 0 ELSE v END AS v FROM vox")
def block_files(vox: DataFrame) -> DataFrame:
    """A volume written by block, of which one block is replaced."""
    rows, path = vox.select("block", "z", "y", "x", "v"), folder(vox)
    sinks.write_volume(rows, path)
    sinks.write_blocks(sinks.template(rows.where("block = 0")), path)
    return vox.sparkSession.read.parquet(path).select(F.col("block").cast("long").alias("block"), "z", "y", "x", "v")


@volume("SELECT reslev, y, x, count(*) AS n, sum(v)::BIGINT AS total FROM (SELECT unnest([0, 1, 2])::INTEGER AS reslev) l, LATERAL (SELECT y // (1 << reslev) AS y, x // (1 << reslev) AS x, v FROM vox WHERE y % (1 << reslev) = 0 AND x % (1 << reslev) = 0) GROUP BY ALL")
def pyramid_files(vox: DataFrame) -> DataFrame:
    path = folder(vox)
    sinks.write_pyramid(vox.select("z", "y", "x", "v"), path, 3)
    return vox.sparkSession.read.parquet(path).groupBy("reslev", "y", "x").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@volume("SELECT event_id, 0::BIGINT AS v FROM vox")
def zero_template(vox: DataFrame) -> DataFrame:
    return sinks.template(vox).select("event_id", "v")


@volume("SELECT DISTINCT c::VARCHAR AS key, label FROM vox WHERE label <> 0")
def label_set_files(vox: DataFrame) -> DataFrame:
    path = folder(vox)
    sinks.write_label_sets(vox.where("label <> 0").select(F.col("c").alias("key"), "label"), path)
    return files.label_sets(vox.sparkSession, path)


@volume("SELECT block, label, count(*) AS area, min(v) AS least FROM vox WHERE label <> 0 GROUP BY block, label")
def feature_files(vox: DataFrame) -> DataFrame:
    """A CSV a block, merged to one table, whose parts are dropped."""
    parts, out = folder(vox), folder(vox)
    sinks.write_features(vox.where("label <> 0").groupBy("block", "label").agg(F.count("*").alias("area"), F.min("v").alias("least")), parts)
    read = lambda spark, path: spark.read.schema("label long, area long, least long, block long").option("header", True).csv(path)
    return sinks.merged_files(vox.sparkSession, parts, out, read, sinks.write_features).select("block", "label", "area", "least")


@volume("SELECT c, count(*) AS n, sum(v)::BIGINT AS total FROM (SELECT c, v FROM vox UNION ALL SELECT 9, 0 FROM vox WHERE c = (SELECT min(c) FROM vox)) GROUP BY c")
def appended_channel(vox: DataFrame) -> DataFrame:
    return sinks.with_channel(vox.select("z", "y", "x", "c", "v"), 9).groupBy("c").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@volume("SELECT c, CASE c WHEN 0 THEN 'membrane' WHEN 2 THEN 'nucleus' ELSE 'chan' || c END AS name, CASE c % 6 WHEN 0 THEN '1 0 0' WHEN 1 THEN '0 1 0' WHEN 2 THEN '0 0 1' WHEN 3 THEN '1 1 0' WHEN 4 THEN '1 0 1' ELSE '0 1 1' END AS colour, 'BaseColor' AS mode, min(v) AS lo, max(v) AS hi FROM vox GROUP BY c")
def channel_display(vox: DataFrame) -> DataFrame:
    return sinks.display(vox, {0: "membrane", 2: "nucleus"})


@volume("""SELECT axis, n, size, 0::BIGINT AS start, n AS stop FROM (SELECT max(z) + 1 AS nz, max(y) + 1 AS ny, max(x) + 1 AS nx FROM vox), LATERAL (VALUES ('z', nz, 2.0::DOUBLE), ('y', ny, 0.5::DOUBLE), ('x', nx, 1.0::DOUBLE)) t(axis, n, size)""")
def volume_props(vox: DataFrame) -> DataFrame:
    """Axes, extents, voxel sizes and default slices of a volume without its channel axis."""
    v = Volume("vox", default_axes(4), {"z": 2.0, "y": 0.5, "c": 1.0}, {**dims(vox), "c": 5}).without("c")
    rows = [(a, v.dims[a], v.size(a), *v.slices()[a]) for a in v.axes]
    return vox.sparkSession.createDataFrame(rows, "axis string, n long, size double, start long, stop long")


@tables("SELECT p_partkey, CASE WHEN k = 0 THEN 'h5' WHEN k = 1 THEN 'nii' WHEN k = 2 THEN 'dm3' WHEN k = 3 THEN 'tif' WHEN k = 4 THEN 'ims' WHEN k = 5 THEN 'bdv' WHEN k = 6 THEN 'czi' WHEN k = 7 THEN 'lif' WHEN k = 8 THEN 'tifs' ELSE 'dat' END AS format FROM (SELECT p_partkey, p_partkey % 10 AS k FROM part)")
def path_formats(read) -> DataFrame:
    ends = F.array(*map(F.lit, (".h5/a/b", ".nii.gz", ".dm3", ".tif", ".ims", ".bdv", ".czi", ".lif", "/", "")))
    p = read("part").select("p_partkey", F.concat(F.lit("dir/v"), F.col("p_partkey").cast("string"), F.element_at(ends, (F.col("p_partkey") % 10 + 1).cast("int"))).alias("path"))
    return p.select("p_partkey", files.format_of("path").alias("format"))


@tables("SELECT s_suppkey, s_suppkey * 0.5::DOUBLE AS z0, round((100.0::DOUBLE - s_suppkey * 0.5) / (s_nationkey + 1), 6) AS dz, round((s_suppkey + 7) * 1e-6 * 1e6, 6) AS um FROM supplier")
def imaris_props(read) -> DataFrame:
    """World origin and voxel size from extents, and metres as micrometres."""
    s = read("supplier").select("s_suppkey", F.array(F.col("s_suppkey") * 0.5).alias("lo"), F.array(F.lit(100.0)).alias("hi"), F.array(F.col("s_nationkey") + 1).alias("n"), ((F.col("s_suppkey") + 7) * 1e-6).alias("m"))
    origin, size = files.imaris_metadata("lo", "hi", "n")
    return s.select("s_suppkey", origin[0].alias("z0"), F.round(size[0], 6).alias("dz"), F.round(files.micrometres("m")[0], 6).alias("um"))


@tables("SELECT n_name AS name, 'XYZCT' AS \"order\", 'uint16' AS dtype, (n_nationkey + 1)::BIGINT AS nx, (n_regionkey + 2)::BIGINT AS nz, 0.5::DOUBLE AS dx, 1.0::DOUBLE AS dz FROM nation")
def ome_props(read) -> DataFrame:
    xml = F.format_string('<OME><Image Name="%s"><Pixels DimensionOrder="XYZCT" Type="uint16" SizeX="%d" SizeY="5" SizeZ="%d" SizeC="2" SizeT="1" PhysicalSizeX="0.5"/></Image></OME>', "n_name", F.col("n_nationkey") + 1, F.col("n_regionkey") + 2)
    return files.ome_metadata(read("nation").select(xml.alias("xml"))).select("name", "order", "dtype", "nx", "nz", "dx", "dz")


PARAMETERS = "segmentation:\n  blocksize: {z: 10, y: 20}\n  steps:\n    seed: {threshold: 0.5, window: [1, 3, 3]}\nname: demo\n"


@tables("SELECT * FROM (VALUES ('name', 'demo'), ('segmentation.blocksize.y', '25'), ('segmentation.blocksize.z', '10'), ('segmentation.steps.seed.threshold', '0.5'), ('segmentation.steps.seed.window', '[1, 3, 3]')) t(name, value)")
def parameter_files(read) -> DataFrame:
    """A YAML file, merged with a later run's parameters, logged, and loaded from the log."""
    spark = read("region").sparkSession
    tree, path = sinks.merged_runs([layout.parameters(PARAMETERS), {"segmentation": {"blocksize": {"y": 25}}}]), folder(read("region"))
    sinks.log_run(spark, path, "segment", layout.flat(tree))
    sinks.log_run(spark, path, "other", {"name": "not this"})
    return spark.createDataFrame(sorted(sinks.last_run(spark, path, "segment").items()), "name string, value string")


@tables("SELECT 'species' || n_regionkey AS species, 'ab' || (n_nationkey % 2) AS antibody, count(*) AS n FROM nation GROUP BY ALL")
def species_folders(read) -> DataFrame:
    """Files in folders of species and antibody."""
    n, path = read("nation"), folder(read("nation"))
    for region in range(5):
        for ab in range(2):
            some = n.where(f"n_regionkey = {region} and n_nationkey % 2 = {ab}").select("n_name")
            some.coalesce(1).write.text(f"{path}/species{region}/ab{ab}")
    found = files.stratified(n.sparkSession, path).where(~F.startswith("sample_id", F.lit("_")) & ~F.startswith("sample_id", F.lit("."))).select("species", "antibody").distinct()
    return found.join(n.select(F.concat(F.lit("species"), F.col("n_regionkey")).alias("species"), F.concat(F.lit("ab"), F.col("n_nationkey") % 2).alias("antibody")), ["species", "antibody"]).groupBy("species", "antibody").agg(F.count("*").alias("n"))


@tables("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'grid' WHEN 1 THEN 'stacks' WHEN 2 THEN 'blockfiles' ELSE 'stacks' END AS mode FROM part")
def input_modes(read) -> DataFrame:
    names = F.array(*map(F.lit, ("set.ims", "{f}.czi", "blocks_B{b:05d}.h5", "stack_{f}.h5")))
    p = read("part").select("p_partkey", F.element_at(names, (F.col("p_partkey") % 4 + 1).cast("int")).alias("path"), (F.col("p_partkey") % 4 == 2).alias("info"))
    return p.select("p_partkey", layout.input_mode("path", "info").alias("mode"))


@volume("SELECT axis, fullsize, blocksize, margin, legacy FROM (SELECT max(z) + 1 AS nz, max(y) + 1 AS ny FROM vox), LATERAL (VALUES ('z', nz, nz, 0::BIGINT, nz), ('y', ny, 10::BIGINT, 2::BIGINT, 640::BIGINT), ('x', 18::BIGINT, 8::BIGINT, 3::BIGINT, 640::BIGINT)) t(axis, fullsize, blocksize, margin, legacy)")
def dataset_layout(vox: DataFrame) -> DataFrame:
    """Sizes of dataset, block and margin: argument before attribute before file."""
    extents = vox.groupBy("block").agg(*((F.max(a) + 1).alias(a) for a in "zyx"))
    full = layout.full_size(extents, {"x": 19}, {"x": 18})
    size = layout.block_size(full, {"y": 10, "x": 9}, {"x": 8})
    margin, (legacy, _) = layout.block_margin(size, {"y": 1, "x": 3}, {"y": 2}), layout.defaults(full)
    rows = [(a, n, size[a], margin[a], legacy[a]) for a, n in layout.declared("zyxc", full, keep="zyx").items()]
    return vox.sparkSession.createDataFrame(rows, "axis string, fullsize long, blocksize long, margin long, legacy long")


@volume(""", b AS (SELECT unnest(range(0, (SELECT max(y) + 1 FROM vox), 10)) AS y0), z AS (SELECT max(z) + 1 AS nz, max(y) + 1 AS ny, max(x) + 1 AS nx FROM vox)
 SELECT CAST(y0 // 10 AS INTEGER) AS block, 'z 0-' || nz || ' y ' || greatest(y0 - 2, 0) || '-' || least(y0 + 12, ny) || ' x 0-' || nx AS padded, 'z 0-' || nz || ' y ' || y0 || '-' || least(y0 + 10, ny) || ' x 0-' || nx AS unpadded FROM b, z""")
def block_report(vox: DataFrame) -> DataFrame:
    """Slices of all blocks, kept in a table and loaded from there."""
    full, path = dims(vox), folder(vox)
    layout.keep_blocks(blocks.grid(vox.sparkSession, full, {**full, "y": 10}, {"y": 2}), path, blocksize=10)
    return layout.described(layout.kept_blocks(vox.sparkSession, path))


@volume("SELECT volume, z, round(sum(w * v) / n, 6) AS v FROM (VALUES ('mean', 0, 1.0::DOUBLE, 5), ('mean', 1, 1.0::DOUBLE, 5), ('mean', 2, 1.0::DOUBLE, 5), ('mean', 3, 1.0::DOUBLE, 5), ('mean', 4, 1.0::DOUBLE, 5), ('memb', 1, 0.5::DOUBLE, 2), ('memb', 3, 2.0::DOUBLE, 2)) t(volume, c, w, n) JOIN vox USING (c) GROUP BY volume, z, n")
def volume_defaults(vox: DataFrame) -> DataFrame:
    """Output volumes: all channels with weight 1, unless said otherwise."""
    w = layout.weights(vox.sparkSession, {"mean": {}, "memb": {"idxs": [1, 3], "weights": [0.5, 2]}}, 5, "uint16")
    return blocks.split_weighted(vox, w.drop("dtype"), ("z",)).withColumn("v", F.round("v", 6))
