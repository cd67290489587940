"""Binary volumes without foreign libraries: NIfTI, TIFF, PNG planes, HDF5.

Files come through Spark's ``binaryFile`` source, so any store works, and are
decoded one file a task; a folder of planes is decoded plane by plane. Large
files on a shared file system go through ``PlaneSource``, one plane a partition.
"""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import unpack
from .microscopes import czi_tiles, dm3_image, lif_images, to_czi, to_dm3, to_lif

# NIfTI-1 data types, TIFF field sizes and sample formats.
NIFTI = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II"}
SAMPLE = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


def nifti(raw: bytes) -> tuple[np.ndarray, dict[str, float]]:
    """Array with axes x y z t c (as many as there are) and voxel sizes, of a .nii or .nii.gz file."""
    raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    end = "<" if struct.unpack("<i", raw[:4])[0] == 348 else ">"
    dim = struct.unpack(end + "8h", raw[40:56])
    kind, = struct.unpack(end + "h", raw[70:72])
    size = struct.unpack(end + "8f", raw[76:108])
    offset, slope, inter = struct.unpack(end + "3f", raw[108:120])
    shape = dim[1 : 1 + dim[0]]
    a = np.frombuffer(raw, end + NIFTI[kind], int(np.prod(shape)), int(offset)).reshape(shape, order="F")
    a = a * slope + inter if slope and (slope, inter) != (1.0, 0.0) else a
    return a, dict(zip("xyztc", map(float, size[1 : 1 + dim[0]])))


def to_nifti(a: np.ndarray, elsize: dict[str, float]) -> bytes:
    """A file with a scaling-only transform; booleans become bytes, half floats floats."""
    a = a.astype("u1") if a.dtype == bool else a.astype("f4") if a.dtype == np.float16 else a
    kind = next(k for k, v in NIFTI.items() if np.dtype(v) == a.dtype)
    sizes = [float(elsize.get(k, 1.0)) for k in "xyztc"[: a.ndim]]
    h = bytearray(352)
    struct.pack_into("<i", h, 0, 348)
    struct.pack_into("<8h", h, 40, a.ndim, *a.shape, *[1] * (7 - a.ndim))
    struct.pack_into("<2h", h, 70, kind, a.dtype.itemsize * 8)
    struct.pack_into("<8f", h, 76, 1.0, *sizes, *[1.0] * (7 - a.ndim))
    struct.pack_into("<3f", h, 108, 352.0, 1.0, 0.0)
    struct.pack_into("<2h", h, 252, 0, 2)
    for k in range(3):
        row = [0.0] * 4
        row[k] = sizes[k] if k < len(sizes) else 1.0
        struct.pack_into("<4f", h, 280 + 16 * k, *row)
    h[344:348] = b"n+1\0"
    return bytes(h) + np.asfortranarray(a).tobytes(order="F")


@dataclass(frozen=True)
class Page:
    """One page of a TIFF: its size and type, where its strips or tiles are and how large, and how these are packed."""

    height: int
    width: int
    kind: str
    strips: tuple[tuple[int, int], ...]
    how: int = 1
    predictor: int = 1
    block: tuple[int, int] | None = None
    padded: bool = False

    def array(self, read: Callable[[int, int], bytes]) -> np.ndarray:
        kind, (high, wide) = np.dtype(self.kind), self.block or (self.height, self.width)
        across, out = -(-self.width // wide), np.zeros((self.height, self.width), kind)
        for k, (at, n) in enumerate(self.strips):
            y, x = k // across * high, k % across * wide
            rows = high if self.padded else min(high, self.height - y)
            a = np.frombuffer(unpack.UNPACK[self.how](read(at, n)), kind, rows * wide).reshape(rows, wide)
            a = unpack.summed(a) if self.predictor == 2 else a
            out[y : y + rows, x : x + wide] = a[: self.height - y, : self.width - x]
        return out


def tiff_pages(read: Callable[[int, int], bytes]) -> list[Page]:
    """The pages of a TIFF of one sample a pixel, in strips or tiles, from its directories alone; ``read(offset, n)`` gives bytes."""
    head = read(0, 8)
    end = "<" if head[:2] == b"II" else ">"
    at, = struct.unpack(end + "I", head[4:8])
    pages = []
    while at:
        n, = struct.unpack(end + "H", read(at, 2))
        entries = read(at + 2, 12 * n + 4)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(end + "HHI", entries, 12 * k)
            if kind in FIELD:
                form = f"{end}{FIELD[kind] * count}"
                size = struct.calcsize(form)
                value = entries[12 * k + 8 : 12 * k + 8 + size] if size <= 4 else read(struct.unpack_from(end + "I", entries, 12 * k + 8)[0], size)
                tags[tag] = struct.unpack(form, value)
        how = tags.get(259, (1,))[0]
        predictor = tags.get(317, (1,))[0]
        if how not in unpack.UNPACK or predictor not in (1, 2) or tags.get(277, (1,))[0] != 1:
            raise ValueError("this TIFF compression, predictor or number of samples is not supported")
        width, height = tags[256][0], tags[257][0]
        kind = np.dtype(end + SAMPLE[tags.get(339, (1,))[0], tags.get(258, (1,))[0]])
        tiles = 324 in tags
        strips = tuple(zip(tags[324], tags[325])) if tiles else tuple(zip(tags[273], tags.get(279, (width * height * kind.itemsize,))))
        block = (tags[323][0], tags[322][0]) if tiles else (min(tags.get(278, (height,))[0], height), width)
        pages.append(Page(height, width, kind.str, strips, how, predictor, block, tiles))
        at, = struct.unpack_from(end + "I", entries, 12 * n)
    return pages


def tiff(raw: bytes) -> np.ndarray:
    """Pages of a TIFF as one array, page by page."""
    read = lambda at, n: raw[at : at + n]
    return np.stack([p.array(read) for p in tiff_pages(read)])


def nifti_planes(read: Callable[[int, int], bytes]) -> list[Page]:
    """The planes along z of an uncompressed NIfTI file of three dimensions, as pages."""
    head = read(0, 352)
    end = "<" if struct.unpack("<i", head[:4])[0] == 348 else ">"
    dim = struct.unpack(end + "8h", head[40:56])
    kind = np.dtype(end + NIFTI[struct.unpack(end + "h", head[70:72])[0]])
    offset, slope, inter = struct.unpack(end + "3f", head[108:120])
    if dim[0] > 3 and any(n > 1 for n in dim[4 : 1 + dim[0]]) or slope and (slope, inter) != (1.0, 0.0):
        raise ValueError("only plain volumes are read plane by plane")
    x, y, z = dim[1:4]
    size = x * y * kind.itemsize
    return [Page(y, x, kind.str, ((int(offset) + k * size, size),)) for k in range(max(1, z))]


def _reading(path: str) -> Callable[[int, int], bytes]:
    f = open(path, "rb")

    def read(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    return read


class _PagePart(InputPartition):
    def __init__(self, z: int, page: Page):
        self.z, self.page = z, page


class _PageReader(DataSourceReader):
    def __init__(self, path: str, planes: tuple[int, int]):
        self.path, self.planes = path, planes

    def partitions(self):
        read, (lo, hi) = _reading(self.path), self.planes
        pages = nifti_planes(read) if self.path.endswith(".nii") else tiff_pages(read)
        return [_PagePart(z, p) for z, p in enumerate(pages) if lo <= z < (hi or len(pages))]

    def read(self, part: _PagePart):
        a = part.page.array(_reading(self.path))
        y, x = np.indices(a.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(a.size, part.z)), pa.array(y.ravel()), pa.array(x.ravel()), pa.array(a.ravel().astype(float))], ["z", "y", "x", "v"])


class PlaneSource(DataSource):
    """``spark.read.format("tessera_planes").load(path)``: a TIFF or an uncompressed .nii on a file system that all machines share.

    One partition a plane, of which only its bytes are read; options ``z0``
    and ``z1`` bound the planes. Files elsewhere, and .nii.gz, go through ``read``, one file a task.
    """

    @classmethod
    def name(cls) -> str:
        return "tessera_planes"

    def schema(self) -> str:
        return "z long, y long, x long, v double"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options["path"], (int(self.options.get("z0", 0)), int(self.options.get("z1", 0))))


def to_tiff(a: np.ndarray) -> bytes:
    """An uncompressed TIFF, a page for each plane."""
    a = a.astype("u1") if a.dtype == bool else a
    a = a if a.ndim > 2 else a[None]
    form, bits = next(k for k, v in SAMPLE.items() if np.dtype(v) == a.dtype)
    out = bytearray(b"II*\0" + struct.pack("<I", 8))
    for k, page in enumerate(a):
        start = len(out)
        tags = [(256, 4, page.shape[1]), (257, 4, page.shape[0]), (258, 3, bits), (259, 3, 1), (262, 3, 1), (273, 4, start + 2 + 12 * 10 + 4), (277, 3, 1), (278, 4, page.shape[0]), (279, 4, page.nbytes), (339, 3, form)]
        data = page.astype(page.dtype.newbyteorder("<")).tobytes()
        after = start + 2 + 12 * len(tags) + 4 + len(data)
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHI", t, f, 1) + struct.pack("<I", v) for t, f, v in tags)
        out += struct.pack("<I", after if k + 1 < len(a) else 0) + data
    return bytes(out)


def to_png(plane: np.ndarray) -> bytes:
    """A grey PNG of one plane, stretched from its least to its greatest value."""
    lo, hi = float(plane.min()), float(plane.max())
    grey = ((plane - lo) * (255 / (hi - lo) if hi > lo else 0)).astype("u1")

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    rows = b"".join(b"\0" + r.tobytes() for r in grey)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", *grey.shape[::-1], 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def png(raw: bytes) -> np.ndarray:
    """A grey PNG of 8 or 16 bits, filtered in any way, not interlaced; its transparency, if any, is left out."""
    at, data, head = 8, [], (0, 0, 8, 0, 0, 0, 0)
    while at < len(raw):
        n, name = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + n]
        head = struct.unpack(">IIBBBBB", body) if name == b"IHDR" else head
        data += [body] if name == b"IDAT" else []
        at += 12 + n
    width, height, bits, colour, _, _, interlaced = head
    if bits not in (8, 16) or colour not in (0, 4) or interlaced:
        raise ValueError("only grey PNG files of 8 or 16 bits that are not interlaced are read")
    step = bits // 8 * (1 + colour // 4)
    rows = np.frombuffer(zlib.decompress(b"".join(data)), "u1").reshape(height, width * step + 1)
    return unpack.unfiltered(rows, step).view(f">u{bits // 8}").reshape(height, width, -1)[:, :, 0].astype(f"u{bits // 8}")


def hdf5(raw: bytes, dataset: str = "/data") -> np.ndarray:
    """A dataset of an HDF5 file that is in memory; files on a shared file system are read chunk by chunk by ``hdf5.Hdf5Source``."""
    from .hdf5 import File

    return File.of(raw).array(dataset)


def to_hdf5(a: np.ndarray, dataset: str = "/data", chunk: tuple[int, ...] | None = None, elsize: list[float] | None = None, axes: str = "") -> bytes:
    """A file with one dataset in nested groups, in compressed chunks if their shape is given, with voxel sizes and axis letters as attributes."""
    from .hdf5 import Writer

    tree: object = a
    for name in reversed([n for n in dataset.split("/") if n]):
        tree = {name: tree}
    own = {k: v for k, v in (("element_size_um", np.array(elsize, float) if elsize else None), ("DIMENSION_LABELS", axes or None)) if v is not None}
    return Writer(chunk).file(tree, {dataset: own})


def tiled(raw: bytes, path: str, channel: int = 0) -> np.ndarray:
    """One channel (z, y, x) of the first image of a CZI, LIF or DM3 file; tiles of a CZI plane are laid side by side."""
    read = lambda at, n: raw[at : at + n]
    if path.endswith(".dm3"):
        return dm3_image(read)[0].array(read)[None]
    tiles = czi_tiles(read) if path.endswith(".czi") else lif_images(read)[0][2]
    tiles = [t for t in tiles if t.at.get("C", t.at.get("c", 0)) == channel]
    at = [(t.at.get("Z", t.at.get("z", 0)), t.at.get("Y", 0), t.at.get("X", 0)) for t in tiles]
    first = np.min(at, axis=0)
    shape = np.max([(z + 1, y + t.height, x + t.width) for t, (z, y, x) in zip(tiles, at)], axis=0) - first
    out = np.zeros(shape, tiles[0].kind)
    for t, (z, y, x) in zip(tiles, np.array(at) - first):
        out[z, y : y + t.height, x : x + t.width] = t.array(read)
    return out


def _decoding(axes: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, plane, raw in zip(*(b.column(c).to_pylist() for c in ("path", "plane", "content"))):
                a = nifti(raw)[0] if ".nii" in path else tiled(raw, path) if path[-4:] in (".czi", ".lif", ".dm3") else png(raw)[None] if ".png" in path else hdf5(raw) if ".h5" in path else tiff(raw)
                order = {k: i for i, k in enumerate("xyztc" if ".nii" in path else "zyx")}
                a = np.moveaxis(a.reshape(a.shape + (1,) * (3 - a.ndim)), [order[k] for k in axes], range(3))
                for z, page in enumerate(a):
                    y, x = np.indices(page.shape)
                    n = page.size
                    yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array(np.full(n, z if plane is None else plane)), pa.array(y.ravel()), pa.array(x.ravel()), pa.array(page.ravel().astype(float))], ["path", "z", "y", "x", "v"])

    return run


def encoded(vox: DataFrame, kind: str, by: str = "block", dtype: str = "i4") -> DataFrame:
    """Voxels (z, y, x, v, ``by``) as files ``(path, content)``, one a block or plane, named after what they cover."""

    def run(rows):
        import pandas as pd

        from ..operators.kernels import dense

        a, first, _ = dense(rows, "v")
        a = a.astype(dtype)
        raw = to_nifti(a.T, {}) if kind == "nii" else to_png(a[0]) if kind == "png" else to_hdf5(a, chunk=(4, 8, 8)) if kind == "h5" else to_czi(a[None]) if kind == "czi" else to_lif(a[None]) if kind == "lif" else to_dm3(a[0]) if kind == "dm3" else to_tiff(a)
        ends = [f"{lo:05d}-{lo + n:05d}" for lo, n in zip(first[::-1], a.shape[::-1])]
        return pd.DataFrame({"path": [f"vol_{'_'.join(ends)}.{kind}"], "content": [raw]})

    return vox.select(*dict.fromkeys(("z", "y", "x", "v", by))).groupBy(by).applyInPandas(run, "path string, content binary")


def decoded(files: DataFrame) -> DataFrame:
    """Files ``(path, content)`` whose names tell what they cover, as voxels (z, y, x, v) of the whole."""
    from ..functions.naming import coordinates

    rows = files.select("path", F.lit(None).cast("long").alias("plane"), "content").mapInArrow(_decoding("zyx"), "path string, z long, y long, x long, v double")
    at = dict(zip(("x", "x1", "y", "y1", "z", "z1"), coordinates("path")))
    return rows.select(*((F.col(a) + at[a]).alias(a) for a in "zyx"), "v")


def read(spark: SparkSession, path: str, planes: bool = False) -> DataFrame:
    """NIfTI or TIFF files as voxels (path, z, y, x, v); with ``planes`` each file is a plane, in the order of names."""
    f = spark.read.format("binaryFile").load(path).select("path", "content")
    if planes:
        # a number a file, from their names only
        order = f.select("path").withColumn("plane", F.row_number().over(Window.orderBy("path")).cast("long") - 1)
        f = f.join(order, "path")
    else:
        f = f.withColumn("plane", F.lit(None).cast("long"))
    return f.select("path", "plane", "content").mapInArrow(_decoding("zyx"), "path string, z long, y long, x long, v double")
