"""What strips, tiles and rows of image files are packed with: TIFF compressions and predictors, PNG filters."""

from __future__ import annotations

import zlib

import numpy as np


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first, that grow one code early, as TIFF has them."""
    first = [bytes([k]) for k in range(256)] + [b"", b""]
    table, out, last, width, held, bits = list(first), [], b"", 9, 0, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, last, width = list(first), b"", 9
            continue
        if last:
            now = table[code] if code < len(table) else last + last[:1]
            table.append(last + now[:1])
        else:
            now = table[code]
        out.append(now)
        last = now
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return b"".join(out)


def packbits(data: bytes) -> bytes:
    """Runs: a count n below 128 stands before n + 1 bytes as they are, one above it before a byte that occurs 257 - n times."""
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            out.append(data[at + 1 : at + 2] * (257 - n) if n > 128 else b"")
            at += 2 if n > 128 else 1
    return b"".join(out)


def zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


# Numbers of TIFF compressions.
UNPACK = {1: bytes, 5: lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: packbits, 50000: zstd}


def summed(a: np.ndarray) -> np.ndarray:
    """Rows of differences as values, overflow included."""
    return np.cumsum(a.astype(a.dtype.newbyteorder("=")), axis=1, dtype=a.dtype.newbyteorder("="))


def unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """PNG rows, each with its filter in front, as bytes; ``step`` is how many bytes a pixel has."""
    out = np.zeros((len(rows), rows.shape[1] - 1), np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for y, row in enumerate(rows):
        how, line = row[0], row[1:]
        if how == 1:
            line = np.concatenate([np.cumsum(line[k::step], dtype=np.uint8)[:, None] for k in range(step)], axis=1).ravel() if len(line) else line
        elif how == 2:
            line = line + above
        elif how in (3, 4):
            line = _by_pixel(line.tolist(), above.tolist(), step, how)
        elif how:
            raise ValueError(f"filter {how} of a PNG row is not known")
        out[y] = above = line
    return out


def _by_pixel(line: list[int], above: list[int], step: int, how: int) -> np.ndarray:
    """Filters whose guess needs the pixel before: mean of left and above, or which of left, above and above left is nearest to their sum."""
    out = [0] * step + line
    above = [0] * step + above
    for k in range(step, len(out)):
        left, up, corner = out[k - step], above[k], above[k - step]
        if how == 3:
            guess = left + up >> 1
        else:
            to_left, to_up, to_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
            guess = left if to_left <= to_up and to_left <= to_corner else up if to_up <= to_corner else corner
        out[k] = out[k] + guess & 255
    return np.array(out[step:], np.uint8)
