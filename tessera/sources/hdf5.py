"""HDF5 without a library: the classic file layout, as Imaris, BigDataViewer and default writers make it.

Read: superblocks 0 to 3, old and new object headers, groups as symbol tables
or as compact links, contiguous, compact and chunked (version 1 B-tree) datasets of
numbers, with shuffle and deflate; attributes of numbers and fixed strings. Written: the same in
its oldest form. What lies outside of that is refused by name.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the file format: signature, undefined address, message types.
MAGIC, NOWHERE = b"\x89HDF\r\n\x1a\n", (1 << 64) - 1
SPACE, TYPE, LINK, LAYOUT, FILTERS, ATTRIBUTE, MORE, TABLE = 1, 3, 6, 8, 11, 12, 16, 17
LEAF, INNER, CHUNKS = 4, 16, 32  # half the entries of symbol nodes, group nodes and chunk nodes


@dataclass
class Dataset:
    shape: tuple[int, ...]
    dtype: np.dtype
    chunk: tuple[int, ...]
    parts: list[tuple[tuple[int, ...], int, int, int]]  # (first place, address, bytes, filters left out)
    filters: list[int] = field(default_factory=list)


def _integer(raw: bytes) -> int:
    return int.from_bytes(raw, "little")


def _dtype(raw: bytes) -> np.dtype:
    kind, bits, size = raw[0] & 15, raw[1], _integer(raw[4:8])
    if kind == 8:  # an enumeration, such as truth values, is stored as its base
        return _dtype(raw[8:])
    if kind == 3:
        return np.dtype(f"S{size}")
    if kind in (0, 1):
        return np.dtype(f"{'>' if bits & 1 else '<'}{'f' if kind else 'i' if bits & 8 else 'u'}{size}")
    raise ValueError(f"HDF5 data of class {kind} are not supported")


def _shape(raw: bytes) -> tuple[int, ...]:
    at = 8 if raw[0] == 1 else 4
    return struct.unpack_from(f"<{raw[1]}Q", raw, at)


class File:
    """An open file: ``read(offset, n)`` gives its bytes, from wherever they are."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        head = read(0, 120)
        if head[:8] != MAGIC:
            raise ValueError("not an HDF5 file")
        if head[8] < 2:
            at = 24 if head[8] == 0 else 28
            self.root = _integer(head[at + 40 : at + 48])
        else:
            self.root = _integer(head[36:44])
        if (head[13], head[14]) != (8, 8) and head[8] < 2 or (head[9], head[10]) != (8, 8) and head[8] >= 2:
            raise ValueError("HDF5 files with short addresses are not supported")

    @classmethod
    def of(cls, raw: bytes) -> File:
        return cls(lambda at, n: raw[at : at + n])

    @classmethod
    def open(cls, path: str) -> File:
        f = open(path, "rb")

        def read(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)

        return cls(read)

    def messages(self, at: int) -> Iterator[tuple[int, bytes]]:
        """(type, data) of all messages of an object."""
        head = self.read(at, 16)
        new = head[:4] == b"OHDR"
        if new:
            flags, first = head[5], 6 + (16 if head[5] & 32 else 0) + (4 if head[5] & 16 else 0)
            size = 1 << (flags & 3)
            start = first + size
            todo = [(at + start, _integer(self.read(at + first, size)))]
            form, tracked = 4, 2 if flags & 4 else 0
        else:
            todo, form, tracked = [(at + 16, _integer(head[8:12]))], 8, 0
        while todo:
            at, n = todo.pop(0)
            block, k = self.read(at, n), 0
            while k + form + tracked <= n:
                kind, size = (block[k], _integer(block[k + 1 : k + 3])) if new else (_integer(block[k : k + 2]), _integer(block[k + 2 : k + 4]))
                data = block[k + form + tracked : k + form + tracked + size]
                k += form + tracked + size
                if kind == MORE:
                    where, length = struct.unpack_from("<QQ", data)
                    todo.append((where + 4, length - 8) if new else (where, length))
                elif kind:
                    yield kind, data

    def _tree(self, at: int, width: int) -> Iterator[tuple[bytes, int]]:
        """(key, child) of the leaves of a version 1 B-tree."""
        head = self.read(at, 24)
        if head[:4] != b"TREE":
            raise ValueError("a broken B-tree in an HDF5 file")
        level, n = head[5], _integer(head[6:8])
        body = self.read(at + 24, n * (width + 8))
        for k in range(n):
            key, child = body[k * (width + 8) : k * (width + 8) + width], _integer(body[k * (width + 8) + width : (k + 1) * (width + 8)])
            if level:
                yield from self._tree(child, width)
            else:
                yield key, child

    def children(self, at: int) -> dict[str, int]:
        """Addresses of a group's members by name."""
        out: dict[str, int] = {}
        for kind, data in self.messages(at):
            if kind == TABLE:
                tree, heap = struct.unpack_from("<QQ", data)
                size, _, names_at = struct.unpack_from("<QQQ", self.read(heap, 32), 8)
                names = self.read(names_at, size)
                for _, node in self._tree(tree, 8):
                    n = _integer(self.read(node + 6, 2))
                    entries = self.read(node + 8, 40 * n)
                    for k in range(n):
                        name, where = struct.unpack_from("<QQ", entries, 40 * k)
                        out[names[name : names.index(b"\0", name)].decode()] = where
            elif kind == LINK:
                flags, k = data[1], 2
                hard = not flags & 8 or data[k] == 0
                k += bool(flags & 8) + (8 if flags & 4 else 0) + bool(flags & 16)
                size = 1 << (flags & 3)
                n = _integer(data[k : k + size])
                if hard:
                    out[data[k + size : k + size + n].decode()] = _integer(data[k + size + n : k + size + n + 8])
        return out

    def find(self, path: str) -> int:
        at = self.root
        for name in filter(None, path.split("/")):
            members = self.children(at)
            if name not in members:
                raise KeyError(f"{name} of {path}")
            at = members[name]
        return at

    def names(self, path: str = "/") -> list[str]:
        return sorted(self.children(self.find(path)))

    def attributes(self, path: str = "/") -> dict[str, object]:
        """Numbers as arrays or scalars; strings, also arrays of single characters, as text."""
        out: dict[str, object] = {}
        for kind, data in self.messages(self.find(path)):
            if kind != ATTRIBUTE:
                continue
            version, (n, t, s) = data[0], struct.unpack_from("<3H", data, 2)
            pad = (lambda x: -(-x // 8) * 8) if version == 1 else (lambda x: x)
            at = 9 if version == 3 else 8
            name = data[at : at + n].split(b"\0")[0].decode()
            at += pad(n)
            dtype, at = _dtype(data[at : at + t]), at + pad(t)
            shape, at = _shape(data[at : at + s]), at + pad(s)
            a = np.frombuffer(data, dtype, int(np.prod(shape)), at).reshape(shape)
            out[name] = b"".join(a.ravel().tolist()).split(b"\0")[0].decode() if dtype.kind == "S" else a if shape else a[()]
        return out

    def dataset(self, path: str) -> Dataset:
        """Shape, type, chunks and where they are; no data are read."""
        got = dict(self.messages(self.find(path)))
        if LAYOUT not in got:
            raise KeyError(f"{path} is no dataset")
        shape, dtype, layout = _shape(got[SPACE]), _dtype(got[TYPE]), got[LAYOUT]
        if layout[0] != 3:
            raise ValueError(f"HDF5 layouts of version {layout[0]} are not supported")
        filters: list[int] = []
        if raw := got.get(FILTERS):
            at = 8 if raw[0] == 1 else 2
            for _ in range(raw[1]):
                number = _integer(raw[at : at + 2])
                named = raw[0] == 1 or number >= 256
                n = _integer(raw[at + 2 : at + 4]) if named else 0
                values = _integer(raw[at + 4 + 2 * named : at + 6 + 2 * named])
                at += 6 + 2 * named + (-(-n // 8) * 8 if raw[0] == 1 else n) + 4 * values + (4 if raw[0] == 1 and values % 2 else 0)
                filters.append(number)
        whole = int(np.prod(shape)) * dtype.itemsize
        if layout[1] == 1:
            return Dataset(shape, dtype, shape, [((0,) * len(shape), _integer(layout[2:10]), whole, 0)])
        if layout[1] == 0:
            raw = layout[4 : 4 + _integer(layout[2:4])]
            return Dataset(shape, dtype, shape, [((0,) * len(shape), -1, len(raw), 0)], [raw])  # the data themselves
        rank, tree = layout[2] - 1, _integer(layout[3:11])
        chunk = struct.unpack_from(f"<{rank}I", layout, 11)
        parts = []
        if tree != NOWHERE:
            for key, where in self._tree(tree, 8 + 8 * (rank + 1)):
                size, left_out = struct.unpack_from("<II", key)
                parts.append((struct.unpack_from(f"<{rank}Q", key, 8), where, size, left_out))
        return Dataset(shape, dtype, chunk, parts, filters)

    def part(self, d: Dataset, part: tuple[tuple[int, ...], int, int, int]) -> np.ndarray:
        """One chunk's values, without what sticks out of the dataset."""
        first, where, size, left_out = part
        if where == -1:
            return np.frombuffer(d.filters[0], d.dtype).reshape(d.shape)
        raw = self.read(where, size) if where != NOWHERE else bytes(size)
        for k in range(len(d.filters) - 1, -1, -1):
            if left_out >> k & 1:
                continue
            if d.filters[k] == 1:
                raw = zlib.decompress(raw)
            elif d.filters[k] == 2:
                raw = np.frombuffer(raw, np.uint8).reshape(d.dtype.itemsize, -1).T.tobytes()
            elif d.filters[k] == 3:
                raw = raw[:-4]
            else:
                raise ValueError(f"HDF5 filter {d.filters[k]} is not supported")
        a = np.frombuffer(raw, d.dtype).reshape(d.chunk)
        return a[tuple(slice(0, n - f) for n, f in zip(d.shape, first))]

    def array(self, path: str) -> np.ndarray:
        """A dataset as a whole; chunks that were never written are zero."""
        d = self.dataset(path)
        out = np.zeros(d.shape, d.dtype)
        for p in d.parts:
            a = self.part(d, p)
            out[tuple(slice(f, f + n) for f, n in zip(p[0], a.shape))] = a
        return out


def _message(kind: int, data: bytes) -> bytes:
    data += bytes(-len(data) % 8)
    return struct.pack("<HHB3x", kind, len(data), 0) + data


def _space(shape: tuple[int, ...]) -> bytes:
    return struct.pack(f"<BBBB4x{len(shape)}Q", 1, len(shape), 0, 0, *shape)


def _type(dtype: np.dtype) -> bytes:
    n = dtype.itemsize
    if dtype.kind == "S":
        return struct.pack("<BBBBI", 0x13, 0, 0, 0, n)
    if dtype.kind in "iub":
        return struct.pack("<BBBBIHH", 0x10, 8 if dtype.kind == "i" else 0, 0, 0, n, 0, 8 * n)
    high, low, bias = {2: (5, 10, 15), 4: (8, 23, 127), 8: (11, 52, 1023)}[n]
    return struct.pack("<BBBBIHHBBBBI", 0x11, 0x20, 8 * n - 1, 0, n, 0, 8 * n, low, high, 0, low, bias)


class Writer:
    """A file in memory: ``tree`` maps names to arrays or to further mappings; ``attributes`` maps paths to values."""

    def __init__(self, chunk: tuple[int, ...] | None = None, deflate: int = 4):
        self.out, self.chunk, self.deflate = bytearray(96), chunk, deflate

    def _put(self, data: bytes) -> int:
        self.out += bytes(-len(self.out) % 8)
        at = len(self.out)
        self.out += data
        return at

    def _header(self, messages: list[bytes]) -> int:
        body = b"".join(messages)
        return self._put(struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body)

    def _tree(self, kind: int, entries: list[tuple[bytes, int]], last: bytes, half: int) -> int:
        """A B-tree over (key, child), nodes of their full size."""
        level = 0
        while True:
            nodes = []
            for a in range(0, max(1, len(entries)), 2 * half):
                some = entries[a : a + 2 * half]
                after = entries[a + 2 * half][0] if a + 2 * half < len(entries) else last
                body = b"".join(k + struct.pack("<Q", c) for k, c in some) + after
                body += bytes(2 * half * (len(last) + 8) + len(last) - len(body))
                nodes.append((some[0][0] if some else last, self._put(b"TREE" + struct.pack("<BBHQQ", kind, level, len(some), NOWHERE, NOWHERE) + body)))
            if len(nodes) == 1:
                return nodes[0][1]
            entries, level = nodes, level + 1

    def _attributes(self, path: str, attributes: dict[str, dict]) -> list[bytes]:
        out = []
        for name, value in attributes.get(path, {}).items():
            a = np.frombuffer(value.encode(), "S1") if isinstance(value, str) else np.asarray(value)
            a = a.astype(a.dtype.newbyteorder("<"))
            parts = [name.encode() + b"\0", _type(a.dtype), _space(a.shape)]
            padded = b"".join(p + bytes(-len(p) % 8) for p in parts)
            out.append(_message(ATTRIBUTE, struct.pack("<BxHHH", 1, *map(len, parts)) + padded + a.tobytes()))
        return out

    def _array(self, a: np.ndarray, path: str, attributes: dict[str, dict]) -> int:
        a = np.ascontiguousarray(a.astype(a.dtype.newbyteorder("<")))
        head = [_message(SPACE, _space(a.shape)), _message(TYPE, _type(a.dtype))]
        if self.chunk is None or a.ndim != len(self.chunk):
            head.append(_message(LAYOUT, struct.pack("<BBQQ", 3, 1, self._put(a.tobytes()), a.nbytes)))
        else:
            entries = []
            for first in product(*(range(0, n, c) for n, c in zip(a.shape, self.chunk))):
                whole = np.zeros(self.chunk, a.dtype)
                some = a[tuple(slice(f, f + c) for f, c in zip(first, self.chunk))]
                whole[tuple(slice(0, n) for n in some.shape)] = some
                raw = zlib.compress(np.frombuffer(whole.tobytes(), np.uint8).reshape(-1, a.itemsize).T.tobytes(), self.deflate)
                entries.append((struct.pack(f"<II{a.ndim + 1}Q", len(raw), 0, *first, 0), self._put(raw)))
            last = struct.pack(f"<II{a.ndim + 1}Q", 0, 0, *(-(-n // c) * c for n, c in zip(a.shape, self.chunk)), 0)
            tree = self._tree(1, entries, last, CHUNKS)
            filters = struct.pack("<BB6x", 1, 2) + struct.pack("<HHHHI4x", 2, 0, 1, 1, a.itemsize) + struct.pack("<HHHHI4x", 1, 0, 1, 1, self.deflate)
            head += [_message(FILTERS, filters), _message(LAYOUT, struct.pack(f"<BBBQ{a.ndim + 1}I", 3, 2, a.ndim + 1, tree, *self.chunk, a.itemsize))]
        return self._header(head + self._attributes(path, attributes))

    def _group(self, tree: dict, path: str, attributes: dict[str, dict]) -> tuple[int, int, int]:
        at, names = {}, bytearray(8)
        for name in sorted(tree):
            below = f"{path}/{name}".replace("//", "/")
            at[name] = self._group(tree[name], below, attributes) if isinstance(tree[name], dict) else (self._array(tree[name], below, attributes), 0, 0)
        place = {}
        for name in at:
            place[name] = len(names)
            names += name.encode() + b"\0"
            names += bytes(-len(names) % 8)
        free = len(names)
        names += struct.pack("<QQ", 1, 16)
        heap = self._put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), free, 0))
        struct.pack_into("<Q", self.out, heap + 24, self._put(bytes(names)))
        nodes, listed = [], list(at)
        for k in range(0, max(1, len(listed)), 2 * LEAF):
            some = listed[k : k + 2 * LEAF]
            body = b"".join(struct.pack("<QQI4xQQ", place[n], at[n][0], 1 if at[n][1] else 0, at[n][1], at[n][2]) for n in some)
            node = self._put(b"SNOD" + struct.pack("<BxH", 1, len(some)) + body + bytes(40 * (2 * LEAF - len(some))))
            nodes.append((struct.pack("<Q", place[listed[k - 1]] if k else 0), node))
        last = struct.pack("<Q", place[listed[-1]] if listed else 0)
        b_tree = self._tree(0, nodes if listed else [], last, INNER)
        return self._header([_message(TABLE, struct.pack("<QQ", b_tree, heap)), *self._attributes(path, attributes)]), b_tree, heap

    def file(self, tree: dict, attributes: dict[str, dict] | None = None) -> bytes:
        root, b_tree, heap = self._group(tree, "/", attributes or {})
        head = MAGIC + struct.pack("<BBBBBBBBHHI", 0, 0, 0, 0, 0, 8, 8, 0, LEAF, INNER, 0) + struct.pack("<QQQQ", 0, NOWHERE, len(self.out), NOWHERE)
        self.out[:96] = head + struct.pack("<QQI4xQQ", 0, root, 1, b_tree, heap)
        return bytes(self.out)


def imaris_path(level: int = 0, time: int = 0, channel: int = 0) -> str:
    return f"/DataSet/ResolutionLevel {level}/TimePoint {time}/Channel {channel}/Data"


def imaris_props(f: File) -> dict[str, object]:
    """Dimensions along z, y, x, c and t, origin and voxel sizes of an Imaris file, and its resolution levels."""
    info = f.attributes("/DataSetInfo/Image")
    dims = {a: int(str(info[a.upper()])) for a in "zyx"}
    lo, hi = ({a: float(str(info[f"{end}{k}"])) for k, a in enumerate("xyz")} for end in ("ExtMin", "ExtMax"))
    levels = [n for n in f.names("/DataSet") if n.startswith("ResolutionLevel")]
    times = [n for n in f.names("/DataSet/ResolutionLevel 0") if n.startswith("TimePoint")]
    channels = [n for n in f.names("/DataSet/ResolutionLevel 0/TimePoint 0") if n.startswith("Channel")]
    return {"dims": {**dims, "c": len(channels), "t": len(times)}, "origin": lo, "elsize": {a: (hi[a] - lo[a]) / dims[a] for a in "zyx"}, "levels": len(levels)}


def bdv_props(f: File, level: int = 0) -> dict[str, int]:
    """Dimensions along z, y, x, c and t of a BigDataViewer file, from its groups."""
    times = [n for n in f.names() if n[:1] == "t" and n[1:].isdigit()]
    setups = [n for n in f.names(times[0]) if n[:1] == "s"]
    z, y, x = f.dataset(f"{times[0]}/{setups[0]}/{level}/cells").shape
    return {"z": z, "y": y, "x": x, "c": len(setups), "t": len(times)}


class _Chunk(InputPartition):
    def __init__(self, part):
        self.part = part


class _Reader(DataSourceReader):
    def __init__(self, path: str, dataset: str, box: list[tuple[int, int]]):
        self.path, self.dataset, self.box = path, dataset, box

    def partitions(self):
        d = File.open(self.path).dataset(self.dataset)
        inside = lambda p: all(f < (hi or n) and f + c > lo for f, c, n, (lo, hi) in zip(p[0], d.chunk, d.shape, self.box))
        return [_Chunk(p) for p in d.parts if inside(p)]

    def read(self, part: _Chunk):
        f = File.open(self.path)
        a = f.part(f.dataset(self.dataset), part.part)
        at = [i + first for i, first in zip(np.indices(a.shape), part.part[0])]
        keep = np.ones(a.shape, bool)
        for i, (lo, hi) in zip(at, self.box):
            keep &= (i >= lo) & (i < (hi or 1 << 62))
        yield pa.RecordBatch.from_arrays([*(pa.array(i[keep]) for i in at), pa.array(a[keep].astype(float))], ["z", "y", "x", "v"])


class Hdf5Source(DataSource):
    """``spark.read.format("tessera_hdf5").option("dataset", "/a/b").load(path)``: a volume of an HDF5 file on a file system that all machines share.

    One partition a chunk; chunks outside of the box of the options z0, z1,
    y0, y1, x0 and x1 are not read. For Imaris and BigDataViewer files the dataset is
    ``imaris_path(level, time, channel)`` or ``files.bdv_name``.
    """

    @classmethod
    def name(cls) -> str:
        return "tessera_hdf5"

    def schema(self) -> str:
        return "z long, y long, x long, v double"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["dataset"], [tuple(int(self.options.get(f"{a}{k}", 0)) for k in (0, 1)) for a in "zyx"])
