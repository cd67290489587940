"""Feature tables: named sets, vector columns, compartments, and the whole query from voxels to cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import maths
from . import objects

AXES = ("z", "y", "x")
# The members of the named feature sets, without the label.
MORPHOLOGY = {
    "none": (),
    "minimal": ("area", "centroid"),
    "medium": ("area", "centroid", "bbox", "equivalent_diameter", "extent", "euler_number", "inertia_tensor_eigvals", "major_axis_length", "minor_axis_length", "fractional_anisotropy"),
    "maximal": ("area", "bbox", "centroid", "equivalent_diameter", "extent", "euler_number", "moments", "inertia_tensor_eigvals", "major_axis_length", "minor_axis_length", "fractional_anisotropy"),
}
INTENSITY = {
    "none": (),
    "minimal": ("mean_intensity",),
    "medium": ("mean_intensity", "weighted_centroid"),
    "maximal": ("min_intensity", "max_intensity", "mean_intensity", "median_intensity", "variance_intensity", "weighted_centroid"),
}
LENGTHS = {"centroid": 3, "dataset_centroid": 3, "weighted_centroid": 3, "bbox": 6, "dataset_bbox": 6, "inertia_tensor_eigvals": 3, "moments": 64}
DERIVED = ("major_axis_length", "minor_axis_length", "fractional_anisotropy")


def members(sets: dict[str, tuple[str, ...]], name: str, dataset: bool = False) -> list[str]:
    """Features of a set; with ``dataset`` centroid and bounding box also in coordinates of the dataset."""
    out = list(sets[name])
    if dataset:
        out += [f"dataset_{n}" for n in ("centroid", "bbox") if n in out]
    return out


def scalar_names(features: list[str], prefix: str = "", suffix: str = "") -> list[str]:
    """Column names with vectors spread out as -0, -1, …"""
    out = []
    for f in features:
        n = LENGTHS.get(f, 1)
        out += [f"{prefix}{f}{suffix}"] if n == 1 else [f"{prefix}{f}-{k}{suffix}" for k in range(n)]
    return out


def spread(df: DataFrame, vectors: list[str]) -> DataFrame:
    """Array columns to scalar ones in their places."""
    columns = []
    for c in df.columns:
        columns += [F.col(f"`{c}`")[k].alias(f"{c}-{k}") for k in range(LENGTHS[c])] if c in vectors else [F.col(f"`{c}`")]
    return df.select(*columns)


def morphology(vox: DataFrame, name: str, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """The features of a named set; what the set does not name is not computed."""
    want = members(MORPHOLOGY, name)
    props = objects.shape(objects.regions(vox, by))
    if any(n in want for n in ("inertia_tensor_eigvals", *DERIVED)):
        e = objects.inertia(vox, by)
        e = e.withColumns({f"eig{k}": F.greatest(F.col(f"eig{k}"), F.lit(0.0)) for k in range(3)})
        props = props.join(e, list(by))
        props = props.withColumn("major_axis_length", maths.axis_length(F.col("eig0"))).withColumn("minor_axis_length", maths.axis_length(F.col("eig2")))
        props = props.withColumn("fractional_anisotropy", maths.anisotropy(F.col("eig0"), F.col("eig1"), F.col("eig2"))).withColumn("inertia_tensor_eigvals", F.array("eig0", "eig1", "eig2"))
    if "euler_number" in want:
        props = props.join(objects.euler_number(vox), list(by))
    if "moments" in want:
        m = objects.moments(vox, 3, by)
        props = props.join(m.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "j", "k", "value"))), lambda s: s["value"]).alias("moments")), list(by))
    props = props.withColumn("centroid", F.array(*(f"centroid_{a}" for a in AXES))).withColumn("bbox", F.array(*(f"bbox_{a}{k}" for k in "01" for a in AXES)))
    return spread(props.select(*by, *want), [n for n in want if n in LENGTHS])


def with_suffix(df: DataFrame, compartment: str, keep: tuple[str, ...] = ("label",)) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").alias(f"{c}_{compartment}") for c in df.columns))


def select_columns(df: DataFrame, features: list[str] | None, keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """Columns of the named features, vectors as a whole; None takes all."""
    if features is None:
        return df
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c in keep or c.split("-")[0] in features))


def joined(tables: dict[str, DataFrame], outer: bool = False) -> DataFrame:
    """Compartments side by side by label: those in all of them, or in any with ``outer``."""
    out = None
    for name, t in tables.items():
        t = with_suffix(t, name)
        out = t if out is None else out.join(t, "label", "full" if outer else "inner")
    return out


def bounded(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose columns are numbers within closed bounds."""
    for c, (lo, hi) in bounds.items():
        x = F.col(f"`{c}`")
        df = df.where(x.isNotNull() & ~F.isnan(x.cast("double")) & (x >= lo) & (x <= hi))
    return df


def cells(vox: DataFrame, compartments: dict[str, str], box: dict[str, tuple[int, int]], bounds: dict[str, tuple[float, float]], name: str = "minimal") -> DataFrame:
    """The whole query: features of each compartment, without labels on the border of any, joined and bounded."""
    parts = {k: vox.where(e) for k, e in compartments.items()}
    border = None
    for p in parts.values():
        b = objects.border_labels(p, box)
        border = b if border is None else border.union(b)
    border = border.distinct()
    tables = {}
    for k, p in parts.items():
        f = morphology(p, name).join(objects.intensities(p).select("label", "mean_intensity"), "label")
        tables[k] = f.join(border, "label", "left_anti")
    return bounded(joined(tables), bounds)
