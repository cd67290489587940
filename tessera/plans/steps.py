"""Dataflows from configuration: named steps over named tables, run in their order."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import correct, iterative, kernels, objects, stencil
from ..sources.voxels import dims
from . import layout

KEY = ("z", "y", "x")
Step = Callable[[dict[str, DataFrame], dict], DataFrame]
STEPS: dict[str, Step] = {}
COLUMNS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def step(prefix: str):
    """Register the step that runs for configuration keys with this prefix."""

    def add(f: Step) -> Step:
        STEPS[prefix] = f
        return f

    return add


def column(name: str):
    """Register a user's function from features to features, to be asked for by name."""

    def add(f):
        COLUMNS[name] = f
        return f

    return add


AGGREGATES: dict[str, Callable[[], Column]] = {}


def aggregate(name: str):
    """Register a user's aggregate of an object's voxels: a function that gives a column expression or grouped pandas UDF applied to them."""

    def add(f):
        AGGREGATES[name] = f
        return f

    return add


def with_aggregates(vox: DataFrame, names: list[str], by: tuple[str, ...] = ("label",)) -> DataFrame:
    """Each object's values of the registered aggregates, in one grouping."""
    return vox.where("label <> 0").groupBy(*by).agg(*(AGGREGATES[n]().alias(n) for n in names))


def matching(functions: dict[str, Callable], key: str) -> Callable | None:
    """The first function, in their order, whose name a key begins with."""
    return next((f for name, f in functions.items() if key.startswith(name)), None)


def with_columns(features: DataFrame, names: list[str]) -> DataFrame:
    for n in names:
        features = features.transform(COLUMNS[n])
    return features


def _blocks(vox: DataFrame, par: dict) -> tuple[dict[str, int], dict[str, int], int]:
    full = dims(vox)
    return full, {a: par.get("blocksize", {}).get(a, layout.BLOCKSIZE) for a in KEY}, par.get("blockmargin", 0)


def _filtered(vox: DataFrame, p: dict) -> DataFrame:
    """median, gaussian or dog; over blocks whose margin holds the filter's reach. With ``inplane`` planes are filtered alone."""
    s = p.get("sigma", 1)
    if p["type"] == "median":
        margin, kernel = int(s) // 2, lambda a: kernels.ranked(a, stencil.square(int(s) // 2) if p.get("inplane", True) else stencil.cube(int(s) // 2), "median")
    elif p["type"] == "gaussian":
        margin, kernel = kernels.margin_of(s), lambda a: kernels.gaussian(a, (0 if p.get("inplane") else s, s, s))
    else:
        e = [p.get("elsize", {}).get(a, 1.0) for a in KEY]
        margin = kernels.margin_of(max(p["sigma1"], p["sigma2"]) / min(e))
        kernel = lambda a: kernels.gaussian(a, tuple(p["sigma1"] / x for x in e)) - kernels.gaussian(a, tuple(p["sigma2"] / x for x in e))
    full, size, _ = _blocks(vox, p)
    return kernels.by_block(vox, full, size, margin, kernel, to="v")


def _normed(vox: DataFrame, p: object) -> DataFrame:
    lo, hi = (p.get("perc", [0, 100]) if isinstance(p, dict) else [0, 100])
    ends = vox.agg(F.percentile("v", F.array(F.lit(lo / 100), F.lit(hi / 100))).alias("_p"))
    scaled = (F.col("v") - F.col("_p")[0]) / (F.col("_p")[1] - F.col("_p")[0] + 2.220446049250313e-16)
    return vox.join(ends).withColumn("v", F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))).drop("_p")


PREP: dict[str, Callable] = {
    "downsample": lambda vox, p: stencil.downsample(vox, p),
    "shift_planes": lambda vox, p: stencil.shift_planes(vox, p["n_planes"] if isinstance(p, dict) else p),
    "opening": lambda vox, p: stencil.opening(vox, stencil.disk(p)),
    "filter": _filtered,
    "norm": _normed,
}


@step("prep")
def prep(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """downsample, shift_planes, opening, filter and norm of a volume, in the order in which they are asked for."""
    out = tables[par["input"]]
    for key, p in par.items():
        f = matching(PREP, key)
        out = f(out, p) if f and p else out
    return out


def _otsu(vox: DataFrame) -> DataFrame:
    """A column ``threshold``: the upper end of the bin that parts two classes best."""
    bins = 256
    ends = vox.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    bin_ = correct.otsu_bin(correct.histogram(vox, bins))
    return vox.join(bin_.join(ends).select((F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("threshold")))


@step("mask")
def mask(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """threshold, otsu or sauvola (each makes a mask; several are joined by or), then size_filter_vx, fill, erode and dilate."""
    src = tables[par["input"]]
    tests = [F.col("v") > par["threshold"]] if "threshold" in par else []
    if par.get("otsu"):
        src = _otsu(src).withColumnRenamed("threshold", "_otsu")
        tests.append(F.col("v") > F.col("_otsu"))
    if k := par.get("sauvola"):
        src = stencil.sauvola(src, k["radius"], k["k"], k["dynamic"], ("_otsu",) if par.get("otsu") else ()).drop("mask")
        tests.append(F.col("v") > F.col("threshold"))
    on = tests[0] if tests else F.lit(True)
    for t in tests[1:]:
        on = on | t
    out = src.withColumn("mask", on).select(*KEY, "mask")
    if n := par.get("size_filter_vx"):
        full, size, _ = _blocks(out, par)
        kept = iterative.without_small(iterative.components(out.where("mask"), full, size), n).select(*KEY, F.lit(True).alias("_on"))
        out = out.join(kept, list(KEY), "left").select(*KEY, F.coalesce("_on", F.lit(False)).alias("mask"))
    if how := par.get("fill"):
        full, size, _ = _blocks(out, par)
        out = (iterative.fill_holes_2d if how == "2D" else iterative.fill_holes)(out, full, size)
    for name, f in (("erode", stencil.erode), ("dilate", stencil.dilate)):
        if r := par.get(name):
            out = f(out, stencil.disk(r))
    return out


@step("seed")
def seed(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """Seeds of a mask's objects (see ``kernels.seeds_of``), numbered over all blocks: (z, y, x, label)."""
    vox = tables[par["input"]].select(*KEY, "v").join(tables[par["mask"]].select(*KEY, "mask"), list(KEY))
    full, size, margin = _blocks(vox, par)
    spacing = tuple(par.get("elsize", {}).get(a, 1.0) for a in KEY)
    options = {k: tuple(par[k]) if isinstance(par[k], list) else par[k] for k in ("above", "dog", "threshold", "peak", "flood") if k in par}
    if options.get("dog"):
        options["ends"] = kernels.difference_ends(vox, full, size, options["dog"], spacing)
    found = kernels.regions_by_block(vox, full, size, margin, lambda v, m: kernels.seeds_of(v, m, spacing, **options), ("v", "mask"))
    return found.withColumnRenamed("region", "label")


@step("segment")
def segment(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """Marker watershed from seeds (see ``kernels.flooded``): (z, y, x, label). Masks are named by ``mask``, ``negative`` and ``post``."""
    vox, masks = tables[par["input"]].select(*KEY, "v").join(tables[par["seeds"]].select(*KEY, "label"), list(KEY)), [k for k in ("mask", "negative", "post") if k in par]
    for k in masks:
        vox = vox.join(tables[par[k]].select(*KEY, F.col("mask").alias(k)), list(KEY))
    full, size, margin = _blocks(vox, par)
    options = {k: par[k] for k in ("invert", "edt", "compactness") if k in par}
    spacing = tuple(par.get("elsize", {}).get(a, 1.0) for a in KEY)
    kernel = lambda v, label, *m: kernels.flooded(v, label, spacing=spacing, **dict(zip(masks, m)), **options)
    return kernels.by_block(vox, full, size, margin, kernel, ("v", "label", *masks), to="label", kind="long")


@step("iterative_split")
def resegment(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """Up to three passes (size, erosions) over the large components of a mask: (z, y, x, label)."""
    m = tables[par["mask"]].select(*KEY, "mask")
    full, size, _ = _blocks(m, par)
    parts = iterative.split_large(m, full, size, [tuple(p) for p in par["passes"][:3]])
    return m.select(*KEY).join(parts, list(KEY), "left").select(*KEY, F.coalesce(F.col("component") + 1, F.lit(0).cast("long")).alias("label"))


@step("combine")
def combine(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """Masks joined by and, some of them turned around."""
    out = None
    for name in par["inputs"]:
        m = tables[name.lstrip("~")].select("z", "y", "x", (~F.col("mask") if name[0] == "~" else F.col("mask")).alias("mask"))
        out = m if out is None else out.join(m.withColumnRenamed("mask", "_m"), ["z", "y", "x"]).withColumn("mask", F.col("mask") & F.col("_m")).drop("_m")
    return out


@step("filter")
def filters(tables: dict[str, DataFrame], par: dict) -> DataFrame:
    """Labels outside size bounds or on a border to background."""
    out = tables[par["input"]]
    n = out.where("label <> 0").groupBy("label").agg(F.count("*").alias("n"))
    n = n.where((F.col("n") >= par.get("min_size", 0)) & (F.col("n") <= par.get("max_size", 1 << 62)))
    if b := par.get("border"):
        n = n.join(objects.border_labels(out, b), "label", "left_anti")
    return objects.forward_map(out, n.select("label", F.col("label").alias("value"))).withColumn("label", F.col("value")).drop("value")


def run(tables: dict[str, DataFrame], config: dict[str, dict]) -> dict[str, DataFrame]:
    """Each key runs the first registered step whose prefix it has; its result is a table of that name."""
    out = dict(tables)
    for name, par in config.items():
        found = matching(STEPS, name)
        if found is None:
            raise ValueError(f"no step for {name}; known are {', '.join(STEPS)}")
        out[name] = found(out, par)
    return out


def run_file(tables: dict[str, DataFrame], text: str) -> dict[str, DataFrame]:
    """The same from a YAML text; its keys run in their order."""
    return run(tables, layout.parameters(text))


def grid(**lists: list) -> list[dict]:
    """All combinations of the listed parameters, the task list of a step."""
    return [dict(zip(lists, values)) for values in product(*lists.values())]


def parsed_bound(text: object) -> float:
    """A number or ±inf; nothing is evaluated."""
    t = str(text).strip().removeprefix("np.").replace("-np.", "-")
    return float(t)
