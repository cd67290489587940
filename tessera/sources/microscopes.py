"""Files of microscopes without a library: CZI, LIF and DM3, as far as they are uncompressed.

Each reader takes ``read(offset, n)`` and gives where the pixels of each plane
are before any of them is read, so a plane can be a partition. The writers make the
smallest files that the readers take, for tests and for passing volumes on.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass
from xml.etree import ElementTree

import numpy as np

Read = Callable[[int, int], bytes]
# Fixed values of the formats: pixel types of CZI, data types of DM3 tags and of its images.
CZI_PIXELS = {0: "u1", 1: "u2", 2: "f4", 12: "i4"}
DM3_TAGS = {2: "i2", 3: "i4", 4: "u2", 5: "u4", 6: "f4", 7: "f8", 8: "u1", 9: "u1", 10: "i1", 11: "i8", 12: "u8"}
DM3_IMAGES = {1: "i2", 2: "f4", 6: "u1", 7: "i4", 9: "i1", 10: "u2", 11: "u4", 12: "f8"}


@dataclass(frozen=True)
class Tile:
    """Pixels of one plane or part of one: their place along all axes, their size in the plane, and where they are."""

    at: dict[str, int]
    height: int
    width: int
    kind: str
    offset: int

    def array(self, read: Read) -> np.ndarray:
        n = self.height * self.width * np.dtype(self.kind).itemsize
        return np.frombuffer(read(self.offset, n), np.dtype(self.kind)).reshape(self.height, self.width)


def czi_tiles(read: Read) -> list[Tile]:
    """The full-resolution subblocks of a CZI file, from its directory; ``at`` has the letters of the file (X Y Z C T S M)."""
    if read(0, 10) != b"ZISRAWFILE":
        raise ValueError("not a CZI file")
    directory = struct.unpack("<q", read(32 + 52, 8))[0]
    head = read(directory, 64)
    if head[:15] != b"ZISRAWDIRECTORY":
        raise ValueError("a CZI file without a directory")
    (n,), size = struct.unpack("<i", read(directory + 32, 4)), struct.unpack("<q", head[24:32])[0]
    entries, k, out = read(directory + 32 + 128, size - 128), 0, []
    for _ in range(n):
        pixel, where, _, compression, pyramid = struct.unpack_from("<iqiiB", entries, k + 2)
        dims, = struct.unpack_from("<i", entries, k + 28)
        axes = {}
        for d in range(dims):
            name, start, length, _, stored = struct.unpack_from("<4siifi", entries, k + 32 + 20 * d)
            axes[name.rstrip(b"\0").decode()] = (start, length, stored or length)
        k += 32 + 20 * dims
        if pyramid and any(length != stored for _, length, stored in axes.values()):
            continue
        if compression:
            raise ValueError("compressed CZI files are not supported")
        meta, _, _ = struct.unpack("<iiq", read(where + 32, 16))
        data = where + 32 + max(256, 16 + 32 + 20 * dims) + meta
        out.append(Tile({a: s for a, (s, _, _) in axes.items()}, axes["Y"][2], axes["X"][2], CZI_PIXELS[pixel], data))
    return out


def to_czi(a: np.ndarray) -> bytes:
    """A CZI file of one subblock for each plane of an array (c, z, y, x)."""
    kind = next(k for k, v in CZI_PIXELS.items() if np.dtype(v) == a.dtype)
    out, entries = bytearray(32 + 512), b""
    for c in range(a.shape[0]):
        for z in range(a.shape[1]):
            where = len(out)
            axes = (("X", 0, a.shape[3]), ("Y", 0, a.shape[2]), ("C", c, 1), ("Z", z, 1))
            entry = b"DV" + struct.pack("<iqiiB5xi", kind, where, 0, 0, 0, len(axes)) + b"".join(struct.pack("<4siifi", n.encode(), s, m, float(s), m) for n, s, m in axes)
            body = struct.pack("<iiq", 0, 0, a[c, z].nbytes) + entry
            body += bytes(max(0, 256 - len(body))) + np.ascontiguousarray(a[c, z]).tobytes()
            out += struct.pack("<16sqq", b"ZISRAWSUBBLOCK", len(body), len(body)) + body
            entries += entry
    where = len(out)
    body = struct.pack("<i124x", a.shape[0] * a.shape[1]) + entries
    out += struct.pack("<16sqq", b"ZISRAWDIRECTORY", len(body), len(body)) + body
    out[:32] = struct.pack("<16sqq", b"ZISRAWFILE", 512, 512)
    struct.pack_into("<ii", out, 32, 1, 0)
    struct.pack_into("<q", out, 32 + 52, where)
    return bytes(out)


def lif_images(read: Read) -> list[tuple[str, dict[str, float], list[Tile]]]:
    """Of each image of a LIF file its name, voxel sizes in metres, and its planes."""
    test, _, mark, chars = struct.unpack("<iiBi", read(0, 13))
    if test != 0x70 or mark != 0x2A:
        raise ValueError("not a LIF file")
    root, at, blocks = ElementTree.fromstring(read(13, 2 * chars).decode("utf-16-le")), 13 + 2 * chars, {}
    new = int(root.get("Version", "1")) >= 2
    while len(head := read(at, 9)) == 9:
        size = struct.unpack("<q", read(at + 9, 8))[0] if new else struct.unpack("<i", read(at + 9, 4))[0]
        name_at = at + 9 + (8 if new else 4) + 1
        chars = struct.unpack("<i", read(name_at, 4))[0]
        blocks[read(name_at + 4, 2 * chars).decode("utf-16-le")] = name_at + 4 + 2 * chars
        at = name_at + 4 + 2 * chars + size
    out = []
    for element in root.iter("Element"):
        image, memory = element.find("Data/Image/ImageDescription"), element.find("Memory")
        if image is None or memory is None:
            continue
        dims = {"xyzt"[int(d.get("DimID")) - 1]: (int(d.get("NumberOfElements")), int(d.get("BytesInc")), float(d.get("Length", "0"))) for d in image.iter("DimensionDescription") if 1 <= int(d.get("DimID")) <= 4}
        channels = [(int(c.get("BytesInc")), int(c.get("Resolution"))) for c in image.iter("ChannelDescription")]
        start, tiles = blocks[memory.get("MemoryBlockID")], []
        for t in range(dims.get("t", (1, 0, 0))[0]):
            for c, (inc, bits) in enumerate(channels):
                for z in range(dims.get("z", (1, 0, 0))[0]):
                    where = start + inc + z * dims.get("z", (1, 0, 0))[1] + t * dims.get("t", (1, 0, 0))[1]
                    tiles.append(Tile({"t": t, "c": c, "z": z}, dims["y"][0], dims["x"][0], "u1" if bits <= 8 else "u2", where))
        size = {a: (length / (n - 1) if n > 1 else 0.0) for a, (n, _, length) in dims.items() if a != "t"}
        out.append((element.get("Name", ""), size, tiles))
    return out


def to_lif(a: np.ndarray, name: str = "image", elsize: dict[str, float] | None = None) -> bytes:
    """A LIF file of one image, an array (c, z, y, x) of bytes or 16-bit values; voxel sizes in metres."""
    size, n = a.itemsize, dict(zip("czyx", a.shape))
    inc = {"x": size, "y": size * n["x"], "z": size * n["x"] * n["y"]}
    dims = "".join(f'<DimensionDescription DimID="{k + 1}" NumberOfElements="{n[d]}" Length="{(n[d] - 1) * (elsize or {}).get(d, 1e-6)!r}" BytesInc="{inc[d]}"/>' for k, d in enumerate("xyz"))
    channels = "".join(f'<ChannelDescription Resolution="{8 * size}" BytesInc="{c * size * n["x"] * n["y"] * n["z"]}"/>' for c in range(n["c"]))
    xml = f'<LMSDataContainerHeader Version="2"><Element Name="{name}"><Data><Image><ImageDescription><Channels>{channels}</Channels><Dimensions>{dims}</Dimensions></ImageDescription></Image></Data><Memory Size="{a.nbytes}" MemoryBlockID="MemBlock_1"/></Element></LMSDataContainerHeader>'
    text, block = xml.encode("utf-16-le"), "MemBlock_1".encode("utf-16-le")
    head = struct.pack("<iiBi", 0x70, len(text) + 5, 0x2A, len(xml)) + text
    return head + struct.pack("<iiBqBi", 0x70, len(block) + 14, 0x2A, a.nbytes, 0x2A, len(block) // 2) + block + np.ascontiguousarray(a).tobytes()


def dm3_tags(read: Read) -> dict[str, object]:
    """The tags of a DM3 file by their paths; arrays as (offset, length, type), structures as tuples."""
    version, _, little = struct.unpack(">3i", read(0, 12))
    if version != 3:
        raise ValueError("not a DM3 file")
    end, out = "<" if little else ">", {}
    at = 12

    def value(kind: int) -> object:
        nonlocal at
        kind_ = np.dtype(end + DM3_TAGS[kind])
        at += kind_.itemsize
        return np.frombuffer(read(at - kind_.itemsize, kind_.itemsize), kind_)[0].item()

    def group(path: str) -> None:
        nonlocal at
        n, = struct.unpack(">i", read(at + 2, 4))
        at += 6
        for k in range(n):
            kind, size = struct.unpack(">BH", read(at, 3))
            name = read(at + 3, size).decode("latin-1") or str(k)
            at += 3 + size
            if kind == 20:
                group(f"{path}/{name}")
                continue
            words, = struct.unpack(">i", read(at + 4, 4))
            info = struct.unpack(f">{words}i", read(at + 8, 4 * words))
            at += 8 + 4 * words
            if info[0] == 20:
                fields = [info[1]] if info[1] != 15 else list(info[5:-1:2])
                out[f"{path}/{name}"] = (at, info[-1], info[1])
                at += info[-1] * sum(np.dtype(DM3_TAGS[f]).itemsize for f in fields)
            elif info[0] == 15:
                out[f"{path}/{name}"] = tuple(value(f) for f in info[4::2])
            elif info[0] == 18:
                out[f"{path}/{name}"] = read(at, 2 * info[1]).decode("utf-16-le")
                at += 2 * info[1]
            else:
                out[f"{path}/{name}"] = value(info[0])

    group("")
    return out


def dm3_image(read: Read) -> tuple[Tile, dict[str, float]]:
    """The last image of a DM3 file, which is the micrograph, and its pixel sizes."""
    tags = dm3_tags(read)
    last = max(int(p.split("/")[2]) for p in tags if p.startswith("/ImageList/"))
    base = f"/ImageList/{last}/ImageData"
    offset = tags[f"{base}/Data"][0]
    little = struct.unpack(">i", read(8, 4))[0]
    kind = ("<" if little else ">") + DM3_IMAGES[tags[f"{base}/DataType"]]
    size = {a: float(tags.get(f"{base}/Calibrations/Dimension/{k}/Scale", 1.0)) for k, a in enumerate("xy")}
    return Tile({}, int(tags[f"{base}/Dimensions/1"]), int(tags[f"{base}/Dimensions/0"]), kind, offset), size


def to_dm3(a: np.ndarray, scale: float = 1.0) -> bytes:
    """A DM3 file of one micrograph, after the thumbnail that such files begin with."""
    image = next(k for k, v in DM3_IMAGES.items() if np.dtype(v) == a.dtype)
    code = {v: k for k, v in DM3_TAGS.items()}

    def tag(name: str, info: tuple[int, ...], data: bytes) -> bytes:
        return struct.pack(">BH", 21, len(name)) + name.encode() + b"%%%%" + struct.pack(f">i{len(info)}i", len(info), *info) + data

    def group(name: str, *members: bytes) -> bytes:
        return struct.pack(">BH", 20, len(name)) + name.encode() + struct.pack(">BBi", 1, 0, len(members)) + b"".join(members)

    def picture(b: np.ndarray, kind: int) -> bytes:
        b = np.ascontiguousarray(b)
        dims = group("Dimensions", *(tag("", (5,), struct.pack("<I", n)) for n in b.shape[::-1]))
        scales = group("Calibrations", group("Dimension", *(group("", tag("Scale", (6,), struct.pack("<f", scale)), tag("Units", (18, 2), "um".encode("utf-16-le"))) for _ in b.shape)))
        data = tag("Data", (20, code[b.dtype.str[1:]], b.size), b.astype(b.dtype.newbyteorder("<")).tobytes())
        return group("", group("ImageData", scales, data, tag("DataType", (3,), struct.pack("<i", kind)), dims, tag("Range", (15, 0, 2, 0, 6, 0, 6), struct.pack("<ff", 0, 1))))

    body = struct.pack(">BBi", 1, 0, 1) + group("ImageList", picture(np.zeros((2, 2), "u1"), 6), picture(a, image))
    return struct.pack(">3i", 3, len(body), 1) + body
