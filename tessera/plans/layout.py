"""How a dataset is laid out: its size, blocks and margins, input mode, output volumes, from arguments, attributes and files."""

from __future__ import annotations

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Block size and margin where nothing else is said.
BLOCKSIZE, MARGIN = 640, 64


def input_mode(path: str, has_block_info: str = "false") -> Column:
    """``grid`` for one dataset, ``blockfiles`` for HDF5 files by number that hold block information, else ``stacks``."""
    p = F.col(path)
    many = F.contains(p, F.lit("{b")) | F.contains(p, F.lit("{f"))
    return F.when(~many, "grid").when(F.contains(p, F.lit(".h5")) & F.expr(has_block_info), "blockfiles").otherwise("stacks")


def full_size(extents: DataFrame, attribute: dict[str, int] | None = None, argument: dict[str, int] | None = None, axes: str = "zyx") -> dict[str, int]:
    """Of several inputs ``extents(z, y, x)`` the largest along each axis; an attribute overrides it, an argument both."""
    row = extents.agg(*(F.max(a).alias(a) for a in axes)).first()
    return {**{a: row[a] for a in axes if row[a] is not None}, **(attribute or {}), **(argument or {})}


def block_size(full: dict[str, int], attribute: dict[str, int] | None = None, argument: dict[str, int] | None = None) -> dict[str, int]:
    """The full size along each axis for which nothing else is said."""
    return {**full, **(attribute or {}), **(argument or {})}


def block_margin(size: dict[str, int], attribute: dict[str, int] | None = None, argument: dict[str, int] | None = None) -> dict[str, int]:
    """0 along each axis for which nothing else is said."""
    return {**dict.fromkeys(size, 0), **(attribute or {}), **(argument or {})}


def defaults(full: dict[str, int], params: dict | None = None) -> tuple[dict[str, int], dict[str, int]]:
    """Block size and margin of old parameter files: in the plane 640 and 64, whole along all other axes."""
    params = params or {}
    size = {a: params.get("blocksize", {}).get(a, BLOCKSIZE if a in "yx" else n) for a, n in full.items()}
    return size, {a: params.get("blockmargin", {}).get(a, MARGIN if a in "yx" else 0) for a in full}


def described(blocks: DataFrame) -> DataFrame:
    """Each block's slices with and without margins, as text."""
    text = lambda lo, hi: F.concat_ws(" ", *(F.format_string(f"{a} %d-%d", f"{a}{lo}", f"{a}{hi}") for a in "zyx"))
    return blocks.select("block", text("_lo", "_hi").alias("padded"), text("0", "1").alias("unpadded"))


def keep_blocks(blocks: DataFrame, path: str, **attributes: object) -> None:
    """Persist blocks with the attributes of what made them."""
    blocks.withColumns({k: F.lit(str(v)) for k, v in attributes.items()}).write.mode("overwrite").parquet(path)


def kept_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def weights(spark: SparkSession, volumes: dict[str, dict], channels: int, dtype: str) -> DataFrame:
    """``(volume, c, w, dtype)``: all channels with weight 1 and the input's type where a volume does not say."""
    rows = []
    for name, own in volumes.items():
        chosen = own.get("idxs", list(range(channels)))
        rows += [(name, c, float(w), own.get("dtype", dtype)) for c, w in zip(chosen, own.get("weights", [1] * len(chosen)))]
    return spark.createDataFrame(rows, "volume string, c int, w double, dtype string")


def declared(axes: str, full: dict[str, int], channels: int = 1, keep: str | None = None) -> dict[str, int]:
    """Axes and extents of a dataset declared on a block, on some of its axes only."""
    whole = {a: full.get(a, channels if a == "c" else 1) for a in axes}
    return {a: n for a, n in whole.items() if keep is None or a in keep}


def parameters(text: str) -> dict:
    """A YAML parameter file as nested mappings; only plain values are made."""
    return yaml.safe_load(text) or {}


def flat(tree: dict, above: str = "") -> dict[str, str]:
    """Nested mappings as one, keys joined by dots, values as text."""
    out: dict[str, str] = {}
    for k, v in tree.items():
        name = f"{above}.{k}" if above else str(k)
        out |= flat(v, name) if isinstance(v, dict) else {name: str(v)}
    return out
