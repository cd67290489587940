"""Per-object features: regions, moments, intensities, labels and their maps."""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maths import exact_spread, exact_sum, variance
from ..runtime import numbered

AXES = ("z", "y", "x")
#: The first number, about, that a long does not hold.
LONG = 2.0**63


def regions(vox: DataFrame, by: tuple[str, ...] = ("label",), label: str = "label") -> DataFrame:
    """Area, centroid and bounding box of each object; background is no object."""
    return vox.where(F.col(label) != 0).groupBy(*by).agg(
        F.count("*").alias("area"),
        *(F.avg(a).alias(f"centroid_{a}") for a in AXES),
        *(F.min(a).alias(f"bbox_{a}0") for a in AXES),
        *((F.max(a) + 1).alias(f"bbox_{a}1") for a in AXES),
    )


def shape(props: DataFrame) -> DataFrame:
    """Equivalent diameter and extent from area and bounding box."""
    box = (F.col("bbox_z1") - F.col("bbox_z0")) * (F.col("bbox_y1") - F.col("bbox_y0")) * (F.col("bbox_x1") - F.col("bbox_x0"))
    return props.withColumn("equivalent_diameter", F.pow(6 * F.col("area") / F.lit(3.141592653589793), F.lit(1 / 3))).withColumn("extent", F.col("area") / box)


def inertia(vox: DataFrame, by: tuple[str, ...] = ("label",), label: str = "label") -> DataFrame:
    """Eigenvalues of the inertia tensor, descending, from sums of coordinates and their products.

    Integer sums stay exact, also where those of products outgrow a long; the symmetric 3 x 3 problem has a closed form,
    whose cosine's argument is kept within [-1, 1].
    """
    pairs = [("z", "z"), ("y", "y"), ("x", "x"), ("z", "y"), ("z", "x"), ("y", "x")]
    g = vox.where(F.col(label) != 0).groupBy(*by).agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a}") for a in AXES), *(exact_sum((F.col(a) * F.col(b)).cast("long")).alias(f"s{a}{b}") for a, b in pairs))
    for a, b in pairs:
        g = g.withColumn(f"m{a}{b}", exact_spread(F.col("n"), F.col(f"s{a}{b}"), F.col(f"s{a}"), F.col(f"s{b}")) / (F.col("n") * F.col("n").cast("double")))
    tr = F.col("mzz") + F.col("myy") + F.col("mxx")
    a, b, c = tr - F.col("mzz"), tr - F.col("myy"), tr - F.col("mxx")
    d, e, f = -F.col("mzy"), -F.col("mzx"), -F.col("myx")
    return eigen3(g.select(*by, a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"), e.alias("e"), f.alias("f"))).select(*by, "eig0", "eig1", "eig2")


def eigen3(rows: DataFrame) -> DataFrame:
    """Adds eig0 >= eig1 >= eig2 of the matrices [[a, d, e], [d, b, f], [e, f, c]]."""
    q = (F.col("a") + F.col("b") + F.col("c")) / 3
    out = rows.withColumn("q", q).withColumn("p", F.sqrt(((F.col("a") - F.col("q")) ** 2 + (F.col("b") - F.col("q")) ** 2 + (F.col("c") - F.col("q")) ** 2 + 2 * (F.col("d") ** 2 + F.col("e") ** 2 + F.col("f") ** 2)) / 6))
    p = F.col("p")
    a, b, c = F.col("a") - F.col("q"), F.col("b") - F.col("q"), F.col("c") - F.col("q")
    d, e, f = F.col("d"), F.col("e"), F.col("f")
    det = a * (b * c - f * f) - d * (d * c - f * e) + e * (d * f - b * e)
    r = F.when(p > 1e-12, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.try_divide(det, 2 * p * p * p)))).otherwise(F.lit(1.0))
    out = out.withColumn("phi", F.acos(r) / 3)
    big = F.col("q") + 2 * p * F.cos(F.col("phi"))
    small = F.col("q") + 2 * p * F.cos(F.col("phi") + F.lit(2.0943951023931953))
    out = out.withColumn("eig0", big).withColumn("eig2", small)
    return out.withColumn("eig1", 3 * F.col("q") - F.col("eig0") - F.col("eig2"))


def _bounds(inner: DataFrame, order: int, by: tuple[str, ...]) -> tuple[float, float, list[float]]:
    """What no moment of an object exceeds; and the number of voxels of the largest object with the largest coordinates: a row to the driver."""
    far = [F.abs(F.col(a).cast("double")) for a in AXES]
    each = F.pow(F.greatest(far[0], F.lit(1.0)) * F.greatest(far[1], F.lit(1.0)) * F.greatest(far[2], F.lit(1.0)), F.lit(order))
    g = inner.groupBy(*by).agg(F.sum(each).alias("top"), F.count("*").alias("n"), *(F.max(f).alias(a) for a, f in zip(AXES, far)))
    r = g.agg(F.max("top").alias("top"), F.max("n").alias("n"), *(F.max(a).alias(a) for a in AXES)).first()
    return (r["top"] or 0.0) * (1 + 1e-6), float(r["n"] or 0), [r[a] or 0.0 for a in AXES]


def moments(vox: DataFrame, order: int = 3, by: tuple[str, ...] = ("label",), label: str = "label") -> DataFrame:
    """Raw moments up to ``order`` a axis in long form: (…, i, j, k, value).

    Values are exact. They are longs where a long holds them all, and else decimals of 38 digits: the third
    powers of three large coordinates outgrow a long.
    """
    powers = [(i, j, k) for i in range(order + 1) for j in range(order + 1) for k in range(order + 1)]
    inner = vox.where(F.col(label) != 0)
    top, count, end = _bounds(inner, order, by)
    kind = "long" if top < LONG else "decimal(38,0)"

    def term(*n: int) -> Column:
        # most moments stay below a long even so, and are summed as such
        wide = kind != "long" and count * prod(max(e, 1.0) ** m for e, m in zip(end, n)) >= LONG
        x = F.lit(1).cast("decimal(38,0)" if wide else "long")
        for a, m in zip(AXES, n):
            for _ in range(m):
                x = (x * F.col(a)).cast("decimal(38,0)") if wide else x * F.col(a)
        return F.sum(x).cast(kind)

    g = inner.groupBy(*by).agg(*(term(*n).alias(f"m{''.join(map(str, n))}") for n in powers))
    rows = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k"), F.col(f"m{i}{j}{k}").alias("value")) for i, j, k in powers))
    return g.select(*by, F.inline(rows))


def intensities(vox: DataFrame, by: tuple[str, ...] = ("label",), label: str = "label", v: str = "v") -> DataFrame:
    """Least, greatest, mean, median, variance, 0.95 quantile and weighted centroid of the values."""
    x = F.col(v)
    # both quantiles come from one sorted histogram of a group's values
    g = vox.where(F.col(label) != 0).groupBy(*by).agg(
        F.min(x).alias("min_intensity"),
        F.max(x).alias("max_intensity"),
        F.avg(x).alias("mean_intensity"),
        F.percentile(x, F.array(F.lit(0.5), F.lit(0.95))).alias("_p"),
        variance(v).alias("variance"),
        *(F.try_divide(F.sum(F.col(a) * x).cast("double"), F.sum(x).cast("double")).alias(f"weighted_centroid_{a}") for a in AXES),
    )
    return g.withColumn("median_intensity", F.col("_p")[0]).withColumn("quantile95", F.col("_p")[1]).drop("_p")


def euler_number(vox: DataFrame, label: str = "label") -> DataFrame:
    """Euler number of each object for 26-connectivity: vertices - edges + faces - cells of the union of cubes.

    Each voxel emits the corners, edges and faces of its cube on a doubled
    lattice; distinct ones are counted once an object.
    """
    parts = [(dz, dy, dx) for dz in (-1, 0, 1) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    cells = F.array(*(F.struct(*(F.lit(d).cast("long").alias(f"d{a}") for a, d in zip(AXES, o)), F.lit((-1) ** (3 - sum(d != 0 for d in o))).cast("long").alias("sign")) for o in parts))
    faces = vox.where(F.col(label) != 0).select(label, *AXES, F.explode(cells).alias("o"))
    distinct = faces.groupBy(label, *((2 * F.col(a) + F.col(f"o.d{a}")).alias(a) for a in AXES)).agg(F.first("o.sign").alias("sign"))
    return distinct.groupBy(label).agg(F.sum("sign").alias("euler_number"))


def border_labels(vox: DataFrame, bounds: dict[str, tuple[int, int]], label: str = "label") -> DataFrame:
    """Labels on any face of a box."""
    face = F.lit(False)
    for a, (lo, hi) in bounds.items():
        face = face | (F.col(a) == lo) | (F.col(a) == hi - 1)
    return vox.where(face & (F.col(label) != 0)).select(label).distinct()


def forward_map(vox: DataFrame, mapping: DataFrame, label: str = "label", to: str = "value", default: Column | None = None) -> DataFrame:
    """Each voxel's value of its label; 0 for background and for labels without a row.

    Of several rows of a label the one with the largest ``seq`` counts, if
    there is such a column. The planner broadcasts a map under its limit and
    shuffles a larger one.
    """
    m = mapping
    if "seq" in m.columns:
        m = m.groupBy(label).agg(F.max_by(to, "seq").alias(to))
    zero = F.lit(0).cast(mapping.schema[to].dataType)
    return vox.join(m.select(F.col(label).alias("_l"), F.col(to).alias("_t")), F.col(label) == F.col("_l"), "left").withColumn(to, F.when(F.col(label) == 0, zero).otherwise(F.coalesce(F.col("_t"), default if default is not None else zero))).drop("_l", "_t")


def offsets(vox: DataFrame, by: str = "block", label: str = "label") -> DataFrame:
    """What to add to a block's labels so that they differ from those of all blocks before it."""
    top = vox.groupBy(by).agg(F.max(label).alias("maxlabel"))
    # a row a block: the one ordered pass runs over that small table
    w = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return top.withColumn("offset", F.coalesce(F.sum("maxlabel").over(w), F.lit(0).cast("long")))


def relabel_blocks(vox: DataFrame, by: str = "block", label: str = "label") -> DataFrame:
    return vox.join(offsets(vox, by, label).select(by, "offset"), by).withColumn(label, F.when(F.col(label) == 0, F.lit(0).cast("long")).otherwise(F.col(label) + F.col("offset"))).drop("offset")


def sequential(vox: DataFrame, label: str = "label", order: Column | None = None) -> DataFrame:
    """(label, sequential): labels numbered from 1 in their order, or in another."""
    labels = vox.where(F.col(label) != 0).select(label).distinct()
    return numbered(labels, "sequential", order if order is not None else F.col(label)).withColumn("sequential", F.col("sequential").cast("int"))


def contingency(vox: DataFrame, seg: str = "label", truth: str = "truth") -> DataFrame:
    """Voxel counts of each pair, and of its members on their own."""
    pair = vox.where(f"{seg} != 0 and {truth} != 0").groupBy(seg, truth).agg(F.count("*").alias("n"))
    s = vox.where(f"{seg} != 0").groupBy(seg).agg(F.count("*").alias("n_seg"))
    t = vox.where(f"{truth} != 0").groupBy(truth).agg(F.count("*").alias("n_truth"))
    both = pair.join(s, seg).join(t, truth)
    dice = 2 * F.col("n") / (F.col("n_seg") + F.col("n_truth"))
    return both.withColumn("dice", dice).withColumn("jaccard", F.col("n") / (F.col("n_seg") + F.col("n_truth") - F.col("n")))


def main_truth(pairs: DataFrame, seg: str = "label", truth: str = "truth") -> DataFrame:
    """Of each segment the truth that it shares most voxels with, ties to the smaller label."""
    return pairs.groupBy(seg).agg(F.max_by(F.struct(truth, "n", "dice", "jaccard"), F.struct(F.col("n"), -F.col(truth))).alias("b")).select(seg, "b.*")


def matches(vox: DataFrame, seg: str = "label", truth: str = "truth") -> DataFrame:
    """Of each truth how many segments have it as their main truth."""
    main = main_truth(contingency(vox, seg, truth), seg, truth)
    n = main.groupBy(truth).agg(F.count("*").alias("segments"))
    return vox.where(f"{truth} != 0").select(truth).distinct().join(n, truth, "left").select(truth, F.coalesce("segments", F.lit(0).cast("long")).alias("segments"))


def detection(per_truth: DataFrame, weight: float = 1.5) -> DataFrame:
    """True and false positives, misses, over- and undersegmented truths, precision, recall, F scores; one row."""
    n = F.col("segments")
    g = per_truth.agg(F.sum((n > 0).cast("long")).alias("tp"), F.sum(F.greatest(n - 1, F.lit(0).cast("long"))).alias("fp"), F.sum((n == 0).cast("long")).alias("fn"), F.sum((n > 1).cast("long")).alias("oversegmented"), F.sum((n == 0).cast("long")).alias("undersegmented"))
    g = g.withColumn("precision", F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))).withColumn("recall", F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0)))

    def score(w: float) -> Column:
        p, r = F.col("precision"), F.col("recall")
        return F.coalesce(F.try_divide((1 + w * w) * p * r, w * w * p + r), F.lit(0.0))

    return g.withColumn("f1", score(1.0)).withColumn("f_weighted", score(weight))


def polarity(full: DataFrame, nucl: DataFrame, elsize: dict[str, float]) -> DataFrame:
    """Distance between the centres of cell and nucleus over the cell's major axis; outer alignment by label."""
    a = full.select("label", *(F.col(f"centroid_{k}").alias(f"f{k}") for k in AXES), "major_axis_length")
    b = nucl.select("label", *(F.col(f"centroid_{k}").alias(f"n{k}") for k in AXES))
    d = sum(((F.col(f"f{k}") - F.col(f"n{k}")) * elsize.get(k, 1.0)) ** 2 for k in AXES)
    return a.join(b, "label", "full").select("label", F.try_divide(F.sqrt(d), F.col("major_axis_length")).alias("polarity"))
