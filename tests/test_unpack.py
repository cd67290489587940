"""Packed strips, tiles and rows, from published examples and files put together by hand."""

import struct
import zlib

import numpy as np
import pytest

from tessera.sources import codecs, unpack


def bits_of(codes, widths):
    text = "".join(f"{c:0{w}b}" for c, w in zip(codes, widths))
    return bytes(int(text[k : k + 8].ljust(8, "0"), 2) for k in range(0, len(text), 8))


def lzw_by_hand(data):
    """Codes of the TIFF recommendation: clear first, a new entry a code, wider one code early."""
    table, codes, widths, w = {bytes([k]): k for k in range(256)}, [256], [9], b""
    n, width = 258, 9
    for k in range(len(data)):
        c = data[k : k + 1]
        if w + c in table:
            w += c
            continue
        codes.append(table[w])
        widths.append(width)
        table[w + c], n, w = n, n + 1, c
        if n + 1 > (1 << width) - 1 + 1 and width < 12:
            width += 1
        if n == 4094:
            codes.append(256)
            widths.append(width)
            table, n, width = {bytes([k]): k for k in range(256)}, 258, 9
    if w:
        codes.append(table[w])
        widths.append(width)
        n += 1
        if n + 1 > 1 << width and width < 12:
            width += 1
    return bits_of([*codes, 257], [*widths, width])


def test_published_examples():
    assert unpack.lzw(bits_of([256, 7, 258, 8, 8, 258, 6, 6, 257], [9] * 9)) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    packed = bytes.fromhex("FE AA 02 80 00 2A FD AA 03 80 00 2A 22 F7 AA")
    assert unpack.packbits(packed) == bytes.fromhex("AA AA AA 80 00 2A AA AA AA AA 80 00 2A 22" + " AA" * 10)
    assert unpack.packbits(b"\x80") == b"" and unpack.lzw(b"") == b""


@pytest.mark.parametrize("size", [1, 300, 30_000])
def test_lzw_of_longer_data(size):
    r = np.random.default_rng(size)
    data = (r.integers(0, 6, size) * r.integers(0, 2, size)).astype("u1").tobytes()
    assert unpack.lzw(lzw_by_hand(data)) == data


def tiff_by_hand(a, pack, how, predictor=1, rows=None, tile=None, end="<"):
    """A page in strips of ``rows`` rows or tiles (height, width), each packed."""
    kind = a.dtype.newbyteorder(end)
    if tile:
        padded = np.zeros([-(-n // t) * t for n, t in zip(a.shape, tile)], a.dtype)
        padded[: a.shape[0], : a.shape[1]] = a
        blocks = [padded[y : y + tile[0], x : x + tile[1]] for y in range(0, padded.shape[0], tile[0]) for x in range(0, padded.shape[1], tile[1])]
    else:
        blocks = [a[y : y + rows] for y in range(0, len(a), rows)]
    if predictor == 2:
        blocks = [np.diff(b, axis=1, prepend=np.zeros((len(b), 1), b.dtype)) for b in blocks]
    data = [pack(np.ascontiguousarray(b).astype(kind).tobytes()) for b in blocks]
    n = len(data)
    tags = {256: (4, [a.shape[1]]), 257: (4, [a.shape[0]]), 258: (3, [8 * a.dtype.itemsize]), 259: (3, [how]), 262: (3, [1]), 277: (3, [1]), 317: (3, [predictor]), 339: (3, [1])}
    at = 8
    starts = []
    for d in data:
        starts.append(at)
        at += len(d)
    more = {322: (4, [tile[1]]), 323: (4, [tile[0]]), 324: (4, starts), 325: (4, [*map(len, data)])} if tile else {273: (4, starts), 278: (4, [rows]), 279: (4, [*map(len, data)])}
    body, entries, extra = b"".join(data), b"", b""
    far = 8 + len(body)
    tags |= more
    directory = far + sum(4 * len(v) for f, v in tags.values() if f == 4 and len(v) > 1)
    for tag in sorted(tags):
        form, values = tags[tag]
        raw = struct.pack(f"{end}{len(values)}{'I' if form == 4 else 'H'}", *values)
        if len(raw) > 4:
            raw, extra = struct.pack(end + "I", far + len(extra)), extra + raw
        entries += struct.pack(end + "HHI", tag, form, len(values)) + raw.ljust(4, b"\0")
    assert directory == far + len(extra) and n
    return (b"II*\0" if end == "<" else b"MM\0*") + struct.pack(end + "I", directory) + body + extra + struct.pack(end + "H", len(tags)) + entries + struct.pack(end + "I", 0)


def zstd(data):
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


@pytest.mark.parametrize("pack, how", [(bytes, 1), (lzw_by_hand, 5), (zlib.compress, 8), (zlib.compress, 32946), (zstd, 50000)])
@pytest.mark.parametrize("more", [{"rows": 4}, {"rows": 7, "predictor": 2}, {"tile": (16, 16)}, {"tile": (16, 32), "predictor": 2, "end": ">"}])
def test_packed_tiffs(pack, how, more):
    r = np.random.default_rng(how)
    for kind in ("u1", "u2"):
        a = (np.add.outer(np.arange(21) * 9, np.arange(37) * 5) + r.integers(0, 40, (21, 37))).astype(kind)
        assert (codecs.tiff(tiff_by_hand(a, pack, how, **more))[0] == a).all()


def test_tiffs_that_are_not_read():
    a = np.zeros((2, 2), "u1")
    for how, predictor in ((7, 1), (1, 3)):
        with pytest.raises(ValueError, match="not supported"):
            codecs.tiff(tiff_by_hand(a, bytes, how, predictor, rows=2))


def png_by_hand(a, filters, colour=0, alpha=False):
    raw = (np.stack([a, np.full_like(a, 7)], 2) if alpha else a[:, :, None]).astype(a.dtype.newbyteorder(">"))
    lines = [np.frombuffer(np.ascontiguousarray(row).tobytes(), "u1").astype(int) for row in raw]
    step, out, above = a.dtype.itemsize * (1 + alpha), b"", np.zeros(len(lines[0]), int)
    for line, how in zip(lines, filters):
        left = np.concatenate([np.zeros(step, int), line[:-step]])
        corner = np.concatenate([np.zeros(step, int), above[:-step]])
        p = left + above - corner
        far = [abs(p - left), abs(p - above), abs(p - corner)]
        nearest = np.where((far[0] <= far[1]) & (far[0] <= far[2]), left, np.where(far[1] <= far[2], above, corner))
        guess = [0 * line, left, above, (left + above) // 2, nearest][how]
        out += bytes([how]) + ((line - guess) % 256).astype("u1").tobytes()
        above = line

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    packed = zlib.compress(out)
    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8 * a.dtype.itemsize, 4 if alpha else colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", packed[:20]) + chunk(b"IDAT", packed[20:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind, alpha", [("u1", False), ("u2", False), ("u1", True), ("u2", True)])
def test_filtered_pngs(kind, alpha):
    r = np.random.default_rng(3)
    a = r.integers(0, np.iinfo(kind).max, (15, 23)).astype(kind)
    got = codecs.png(png_by_hand(a, [*range(5)] * 3, alpha=alpha))
    assert got.dtype == kind and (got == a).all()
    with pytest.raises(ValueError, match="grey"):
        codecs.png(png_by_hand(a, [0] * 15, colour=2))
