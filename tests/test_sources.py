"""Readers, writers and the stream of blocks."""

import numpy as np
from pyspark.sql import functions as F

from tessera.sources import codecs, files, sinks
from tessera.sources.voxels import Volume, box, default_axes, voxels
from tessera.streaming import blocks as stream

DATA = "/root/testdata/sf0.001"


def test_volume_metadata():
    v = Volume("a", elsize={"z": 2.0}, dims={"z": 10, "y": 20, "x": 30, "c": 1, "t": 1})
    assert v.size("z") == 2.0 and v.size("x") == 1.0
    assert v.slices(y=(5, 0))["y"] == (5, 20) and v.shape(x=(3, 9)) == (10, 20, 6, 1, 1)
    assert v.without("c").axes == "zyxt" and default_axes(4) == "zyxc"


def test_format_of_a_path():
    assert [files.sniff(p) for p in ("a.h5/d", "b.nii.gz", "c.ims", "dir/", "x")] == ["h5", "nii", "ims", "tifs", "dat"]


def test_array_source_reads_only_its_planes(spark, tmp_path):
    a = np.arange(60).reshape(3, 4, 5)
    np.save(tmp_path / "a.npy", a)
    spark.dataSource.register(files.ArraySource)
    df = spark.read.format("tessera_array").option("z0", 1).option("z1", 3).load(str(tmp_path / "a.npy"))
    got = {(r.z, r.y, r.x): r.v for r in df.collect()}
    assert len(got) == 40 and all(a[k] == v for k, v in got.items())


def test_blocks_are_replaced_alone(spark, tmp_path):
    vox = voxels(spark, DATA).select("block", "z", "y", "x", "v", "label")
    path = str(tmp_path / "vol")
    sinks.write_volume(vox, path)
    first = vox.agg(F.min("block")).first()[0]
    sinks.write_blocks(vox.where(F.col("block") == first).withColumn("v", F.lit(0).cast("long")), path)
    back = spark.read.parquet(path)
    assert back.count() == vox.count()
    assert back.where(F.col("block") == first).agg(F.max("v")).first()[0] == 0
    assert back.where(F.col("block") != first).agg(F.sum("v")).first()[0] == vox.where(F.col("block") != first).agg(F.sum("v")).first()[0]


def test_stream_equals_batch(spark, tmp_path):
    vox = voxels(spark, DATA).select("block", "z", "y", "x", "v", "label")
    halves = vox.randomSplit([0.5, 0.5], seed=1)
    for half in halves:
        half.repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        assert stream.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {tuple(r) for r in stream.followed(spark, str(tmp_path / "out")).collect()}
    assert got == {tuple(r) for r in stream.statistics(vox).collect()}


def test_label_sets_round_trip(spark, tmp_path):
    s = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "key string, label long")
    sinks.write_label_sets(s, str(tmp_path / "ls"))
    assert {tuple(r) for r in files.label_sets(spark, str(tmp_path / "ls")).collect()} == {("a", 1), ("a", 3), ("b", 2)}


def test_features_pyramid_and_runs(spark, tmp_path):
    vox = voxels(spark, DATA)
    sinks.write_features(vox.groupBy("block", "label").count(), str(tmp_path / "f"))
    n = files.feature_tables(spark, str(tmp_path / "f"), "label long, count long", 10).count()
    assert 0 < n <= vox.select("block", "label").distinct().count()
    sinks.write_pyramid(vox.select("z", "y", "x", "v"), str(tmp_path / "p"), 2)
    assert spark.read.parquet(str(tmp_path / "p")).where("reslev = 1").agg(F.max("x")).first()[0] == 9
    sinks.log_run(spark, str(tmp_path / "runs"), "segment", {"sigma": 1})
    assert sinks.last_run(spark, str(tmp_path / "runs"), "segment") == {"sigma": "1"}
    assert sinks.merged_runs([{"a": {"x": 1}, "b": 1}, {"a": {"y": 2}, "b": 3}]) == {"a": {"x": 1, "y": 2}, "b": 3}


def test_ome_metadata(spark):
    xml = '<OME><Image Name="s0"><Pixels DimensionOrder="XYZCT" Type="uint16" SizeX="4" SizeY="5" SizeZ="6" SizeC="2" SizeT="1" PhysicalSizeX="0.5"/></Image><Image Name="s1"><Pixels DimensionOrder="XYZCT" Type="uint8" SizeX="1" SizeY="1" SizeZ="1" SizeC="1" SizeT="1"/></Image></OME>'
    rows = files.ome_metadata(spark.createDataFrame([(xml,)], "xml string")).orderBy("name").collect()
    assert [(r.name, r.nz, r.dx, r.dy) for r in rows] == [("s0", 6, 0.5, 1.0), ("s1", 1, 1.0, 1.0)]


def test_hdf5_round_trip(spark, tmp_path):
    from tessera.sources import hdf5

    r = np.random.default_rng(3)
    a, many = r.integers(-900, 900, (9, 21, 17)).astype("i2"), {f"set {k:03d}": np.full((2, 2, 2), k, "u2") for k in range(300)}
    tree = {"group": {"inner": {"data": a, "flat": np.arange(5.0)}, "empty": {}}, "many": many, "half": (a[:1] > 0).astype("u1"), "real": a.astype("f4") / 7}
    attributes = {"/group": {"size": np.array([2.0, 0.5]), "n": 7}, "/group/inner/data": {"label": "zyx"}}
    for chunk in (None, (4, 8, 8), (1, 2, 3)):
        f = hdf5.File.of(hdf5.Writer(chunk).file(tree, attributes))
        assert f.names() == ["group", "half", "many", "real"] and f.names("/group") == ["empty", "inner"] and f.names("/group/empty") == []
        assert (f.array("/group/inner/data") == a).all() and (f.array("group/inner/flat") == np.arange(5)).all() and (f.array("/real") == tree["real"]).all()
        assert len(f.names("/many")) == 300 and (f.array("/many/set 217") == 217).all()
        assert f.attributes("/group")["n"] == 7 and f.attributes("/group")["size"].tolist() == [2.0, 0.5] and f.attributes("/group/inner/data") == {"label": "zyx"}
        assert len(f.dataset("/group/inner/data").parts) == {None: 1, (4, 8, 8): 27, (1, 2, 3): 9 * 11 * 6}[chunk]
    (tmp_path / "v.h5").write_bytes(codecs.to_hdf5(a, "/a/b", (4, 8, 8), [2.0, 1.0, 1.0], "zyx"))
    spark.dataSource.register(hdf5.Hdf5Source)
    read = spark.read.format("tessera_hdf5").option("dataset", "/a/b").option("z0", 3).option("z1", 6).option("x1", 8)
    df = read.load(str(tmp_path / "v.h5"))
    got = {(x.z, x.y, x.x): x.v for x in df.collect()}
    assert len(got) == 3 * 21 * 8 and all(a[k] == v for k, v in got.items()) and df.rdd.getNumPartitions() == 2 * 3 * 1
    for bad in (b"no file at all" * 20, hdf5.MAGIC + bytes(200)):
        with np.testing.assert_raises(ValueError):
            hdf5.File.of(bad).names()


def test_hdf5_new_style_groups():
    """Object headers of version 2 with compact links, put together by hand."""
    import struct

    from tessera.sources import hdf5

    data = np.arange(6, dtype="<u2")
    out = bytearray(48)
    at = len(out)
    out += data.tobytes() + bytes(4)

    def header(*messages: tuple[int, bytes]) -> int:
        body = b"".join(struct.pack("<BHB", k, len(d), 0) + d for k, d in messages)
        where = len(out)
        out.extend(b"OHDR" + bytes([2, 0, len(body)]) + body + bytes(4))
        return where

    space = struct.pack("<BBBBQQ", 2, 2, 0, 1, 2, 3)
    leaf = header((1, space), (3, struct.pack("<BBBBIHH", 0x10, 0, 0, 0, 2, 0, 16)), (8, struct.pack("<BBQQ", 3, 1, at, 12)))
    root = header((6, bytes([1, 0, 4]) + b"leaf" + struct.pack("<Q", leaf)))
    out[:48] = hdf5.MAGIC + bytes([2, 8, 8, 0]) + struct.pack("<QQQQ", 0, hdf5.NOWHERE, len(out), root) + bytes(4)
    f = hdf5.File.of(bytes(out))
    assert f.names() == ["leaf"] and f.array("leaf").tolist() == [[0, 1, 2], [3, 4, 5]]


def test_nifti_and_tiff_round_trip(spark, tmp_path):
    a = np.arange(2 * 3 * 4, dtype="u2").reshape(2, 3, 4)
    back, size = codecs.nifti(codecs.to_nifti(a.T, {"x": 0.5, "z": 2.0}))
    assert (back == a.T).all() and size == {"x": 0.5, "y": 1.0, "z": 2.0}
    for kind in ("u1", "u2", "i4", "f4", "f8"):
        assert (codecs.tiff(codecs.to_tiff(a.astype(kind))) == a).all()
    assert codecs.tiff(codecs.to_tiff(a[0] > 5)).dtype == np.uint8
    (tmp_path / "v.nii").write_bytes(codecs.to_nifti(a.T, {}))
    (tmp_path / "v.tif").write_bytes(codecs.to_tiff(a))
    for name in ("v.nii", "v.tif"):
        got = {(r.z, r.y, r.x): r.v for r in codecs.read(spark, str(tmp_path / name)).collect()}
        assert len(got) == a.size and all(a[k] == v for k, v in got.items())


def test_files_of_microscopes():
    from tessera.sources import microscopes

    a = np.random.default_rng(6).integers(0, 60000, (2, 3, 5, 7)).astype("u2")
    reader = lambda raw: lambda at, n: raw[at : at + n]
    raw = microscopes.to_czi(a)
    tiles = microscopes.czi_tiles(reader(raw))
    assert len(tiles) == 6 and all((t.array(reader(raw)) == a[t.at["C"], t.at["Z"]]).all() for t in tiles)
    raw = microscopes.to_lif(a, "cells", {"x": 5e-7, "z": 2e-6})
    (name, size, tiles), = microscopes.lif_images(reader(raw))
    assert name == "cells" and np.allclose([size["x"], size["z"]], [5e-7, 2e-6]) and len(tiles) == 6
    assert all((t.array(reader(raw)) == a[t.at["c"], t.at["z"]]).all() for t in tiles)
    for kind in ("u2", "i4", "f4", "u1"):
        raw = microscopes.to_dm3(a[0, 0].astype(kind), 0.25)
        tile, size = microscopes.dm3_image(reader(raw))
        assert (tile.array(reader(raw)) == a[0, 0].astype(kind)).all() and size == {"x": 0.25, "y": 0.25}
    for f in (microscopes.czi_tiles, microscopes.lif_images, microscopes.dm3_tags):
        with np.testing.assert_raises(ValueError):
            f(reader(b"something else altogether " * 9))


def test_planes_are_read_alone(spark, tmp_path):
    a = np.random.default_rng(4).integers(0, 999, (5, 6, 7)).astype("u2")
    (tmp_path / "v.nii").write_bytes(codecs.to_nifti(a.T, {}))
    (tmp_path / "v.tif").write_bytes(codecs.to_tiff(a))
    spark.dataSource.register(codecs.PlaneSource)
    for name in ("v.nii", "v.tif"):
        df = spark.read.format("tessera_planes").option("z0", 1).option("z1", 4).load(str(tmp_path / name))
        got = {(r.z, r.y, r.x): r.v for r in df.collect()}
        assert len(got) == 3 * 42 and all(a[k] == v for k, v in got.items()) and df.rdd.getNumPartitions() == 3


def test_folder_of_planes_and_png(spark, tmp_path):
    a = np.arange(24, dtype="u2").reshape(2, 3, 4)
    for k, plane in enumerate(a):
        (tmp_path / f"p{k}.tif").write_bytes(codecs.to_tiff(plane))
    got = {(r.z, r.y, r.x): r.v for r in codecs.read(spark, str(tmp_path), planes=True).collect()}
    assert all(a[k] == v for k, v in got.items()) and len(got) == 24
    png = codecs.to_png(a[0])
    assert png[:8] == b"\x89PNG\r\n\x1a\n" and b"IEND" in png


def test_slices_reach_the_scan(spark, tmp_path):
    """A hyper-rectangle is pushed to Parquet, blocks are pruned, and unused columns are not read."""
    path = str(tmp_path / "vol")
    sinks.write_volume(voxels(spark, DATA).select("block", "z", "y", "x", "v", "label"), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    plan = spark.read.parquet(path).where(box(z=(0, 1), y=(2, 9)) & F.col("block").isin(0, 1)).select("v")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed, pruned, schema = (plan[plan.index(k) :].split("]")[0] if k != "ReadSchema" else plan[plan.index(k) :] for k in ("PushedFilters", "PartitionFilters", "ReadSchema"))
    assert "GreaterThanOrEqual(z,0)" in pushed and "LessThan(y,9)" in pushed and "block" in pruned
    assert "label" not in schema and "v:bigint" in schema


def test_stencils_shuffle_once(spark):
    from tessera.operators import stencil

    plan = stencil.stencil(voxels(spark, DATA), stencil.square(1), "v", m=F.max("v"))._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    full = stencil.stencil(voxels(spark, DATA), stencil.square(1), "v", m=F.max("v"))._jdf.queryExecution().executedPlan().toString()
    assert full.count("Exchange hashpartitioning") == 1


def test_halo_reads_do_not_shuffle(spark):
    from tessera.operators import blocks

    h = blocks.halo_join(voxels(spark, DATA), {"z": 2, "y": 25, "x": 20}, dict.fromkeys("zyx", 10), 2)
    assert "Exchange" not in h._jdf.queryExecution().executedPlan().toString()
