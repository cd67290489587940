"""Names, paths and parameter templates, as string expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def block_name(stem: str, *coordinates: str, suffix: str = ".h5") -> Column:
    """``stem_xxxxx-XXXXX_yyyyy-YYYYY_zzzzz-ZZZZZ`` from six columns."""
    return F.format_string(f"{stem}_%05d-%05d_%05d-%05d_%05d-%05d{suffix}", *coordinates)


def coordinates(name: str, offset: tuple[int, int, int] = (0, 0, 0)) -> list[Column]:
    """x0, x1, y0, y1, z0 and z1 out of such a name, less a block's offset along x, y and z.

    The last three ranges of the file's name count, whatever its folders and stem hold.
    """
    tail = F.element_at(F.split(F.col(name), "/"), -1)
    runs = F.regexp_extract_all(tail, F.lit("([0-9]{5})-([0-9]{5})"), F.lit(0))
    return [(F.split(F.try_element_at(runs, F.lit(k - 3)), "-")[s].cast("long") - offset[k]).alias(f"{a}{s}") for k, a in enumerate("xyz") for s in (0, 1)]


def stem(name: str) -> Column:
    """What stands before the last three ranges of a name, without its folders and extension."""
    tail = F.regexp_replace(F.element_at(F.split(F.col(name), "/"), -1), r"\.[^./]*$", "")
    return F.regexp_replace(tail, r"_?[0-9]{5}-[0-9]{5}_[0-9]{5}-[0-9]{5}_[0-9]{5}-[0-9]{5}$", "")


def path_parts(path: str) -> dict[str, Column]:
    """Base, folder, file name, extension and the path inside an HDF5 file."""
    p = F.col(path)
    outer = F.regexp_extract(p, r"^(.*?\.h5)(?:/.*)?$", 1)
    outer = F.when(outer != "", outer).otherwise(p)
    return {
        "inner": F.regexp_extract(p, r"\.h5(/.*)$", 1),
        "folder": F.regexp_extract(outer, r"^(.*)/[^/]*$", 1),
        "file": F.regexp_extract(outer, r"([^/]*)$", 1),
        "base": F.regexp_replace(outer, r"\.[^./]*$", ""),
        "ext": F.regexp_extract(outer, r"(\.[^./]*)$", 1),
    }


def wildcard(template: str) -> Column:
    """Fields in braces to ``*``."""
    return F.regexp_replace(F.col(template), r"\{[^{}]+\}", "*")


def suffix(letter: str, column: str, width: int = 3) -> Column:
    return F.format_string(f"{letter}%0{width}d", column)


def filled(template: str, **known: object) -> str:
    """Known fields filled in, unknown ones kept as they are."""
    return re.sub(r"\{(\w+)(?::([^{}]*))?\}", lambda m: format(known[m[1]], m[2] or "") if m[1] in known else m[0], template)


def stratum(stem: str, prefixes: dict[str, str], default: str = "") -> Column:
    """The name of the first prefix that a stem starts with, whatever the case."""
    out = F.lit(default)
    for name, prefix in reversed(prefixes.items()):
        out = F.when(F.startswith(F.lower(F.col(stem)), F.lit(prefix.lower())), F.lit(name)).otherwise(out)
    return out
