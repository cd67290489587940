"""Equalization metrics over samples: ``lineitem`` rows are pixels of samples by supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naming
from ..operators import equalize
from .registry import tables

PX = "WITH px AS (SELECT l_returnflag AS species, l_linestatus AS antibody, l_suppkey AS sample, CAST(round(l_extendedprice * 100) AS BIGINT) AS v FROM lineitem)"
CLS = "CASE WHEN v >= 9000000 THEN 0 WHEN v > 6000000 THEN 3 WHEN v > 3000000 AND v < 9000000 THEN 2 WHEN v < 1000000 THEN 1 ELSE 0 END"
KEYS = ("species", "antibody", "sample")


def pixels(read) -> DataFrame:
    return read("lineitem").select(F.col("l_returnflag").alias("species"), F.col("l_linestatus").alias("antibody"), F.col("l_suppkey").alias("sample"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))


def rounded(df: DataFrame, n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, k in df.dtypes if k == "double"})


def _quantiles(where: str = "true") -> str:
    return f"{PX}, g AS (SELECT species, antibody, sample, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.99) AS f FROM px WHERE {where} GROUP BY ALL) SELECT species, antibody, sample, round(b, 6) AS background, round(f, 6) AS foreground, round(f / nullif(b, 0), 6) AS contrast FROM g"


@tables(_quantiles())
def eq_quantiles(read) -> DataFrame:
    return rounded(equalize.quantile_metrics(pixels(read), KEYS, (0.5, 0.99)))


@tables(_quantiles("v > 100000 AND v < 9000000"))
def eq_quantiles_unclipped(read) -> DataFrame:
    return rounded(equalize.quantile_metrics(pixels(read), KEYS, (0.5, 0.99), F.expr("v > 100000 and v < 9000000")))


@tables(_quantiles(f"({CLS}) >= 2"))
def eq_quantiles_masked(read) -> DataFrame:
    p = pixels(read)
    return rounded(equalize.quantile_metrics(p, KEYS, (0.5, 0.99), equalize.classes(F.col("v"), 1000000, 3000000, 6000000, 9000000) >= 2))


SEG = f"""{PX}, k AS (SELECT *, {CLS} AS k FROM px), g AS (SELECT species, antibody, sample, avg(v) FILTER (WHERE k = 2) AS b, avg(v) FILTER (WHERE k = 3) AS f,
 coalesce(sqrt((count(*) FILTER (WHERE k = 1) * sum(v * v) FILTER (WHERE k = 1)::BIGINT - sum(v) FILTER (WHERE k = 1)::BIGINT * sum(v) FILTER (WHERE k = 1)::BIGINT) / nullif(count(*) FILTER (WHERE k = 1) * (count(*) FILTER (WHERE k = 1))::DOUBLE, 0)), 0) AS sd FROM k GROUP BY ALL),
 mt AS (SELECT species, antibody, sample, b AS background, f AS foreground, sd AS noise_sd, f / nullif(b, 0) AS contrast, f / nullif(sd, 0) AS snr, CASE WHEN sd = 0 THEN 0 ELSE (f - b) / nullif(sd, 0) END AS cnr FROM g)"""


def _segments(read) -> DataFrame:
    return equalize.segment_metrics(pixels(read), KEYS, 1000000, 3000000, 6000000, 9000000)


@tables(SEG + " SELECT species, antibody, sample, round(background, 4) AS background, round(foreground, 4) AS foreground, round(noise_sd, 4) AS noise_sd, round(contrast, 4) AS contrast, round(snr, 4) AS snr, round(cnr, 4) AS cnr FROM mt")
def eq_segments(read) -> DataFrame:
    return rounded(_segments(read), 4)


@tables(SEG + " SELECT species, antibody, round(avg(contrast), 5) AS contrast_mean, round(stddev_samp(contrast), 5) AS contrast_sd, round(avg(cnr), 4) AS cnr_mean, round(stddev_samp(cnr), 4) AS cnr_sd FROM mt GROUP BY ALL")
def eq_group_stats(read) -> DataFrame:
    g = equalize.group_stats(_segments(read), ("species", "antibody"), ("contrast", "cnr"))
    return g.select("species", "antibody", *(F.round(c, 5 if "contrast" in c else 4).alias(c) for c in ("contrast_mean", "contrast_sd", "cnr_mean", "cnr_sd")))


@tables(SEG + " SELECT antibody, round(max(CASE WHEN species = 'A' THEN m END), 5) AS a, round(max(CASE WHEN species = 'N' THEN m END), 5) AS n, round(max(CASE WHEN species = 'R' THEN m END), 5) AS r FROM (SELECT species, antibody, avg(contrast) AS m FROM mt GROUP BY ALL) GROUP BY antibody")
def eq_by_species(read) -> DataFrame:
    p = _segments(read).groupBy("antibody").pivot("species", ["A", "N", "R"]).agg(F.round(F.avg("contrast"), 5))
    return p.toDF("antibody", "a", "n", "r")


@tables(SEG + " SELECT species, antibody, sample, round(contrast, 4) AS contrast FROM mt WHERE contrast IS NOT NULL ORDER BY contrast DESC, sample LIMIT 20")
def eq_best_samples(read) -> DataFrame:
    s = _segments(read).where("contrast is not null").orderBy(F.desc("contrast"), "sample").limit(20)
    return rounded(s.select(*KEYS, "contrast"), 4)


@tables("""SELECT s_suppkey, s_name, CASE WHEN lower(s_name) LIKE 'supplier#00000000%' THEN 'first' WHEN lower(s_name) LIKE 'supplier#0000000%' THEN 'second' ELSE 'rest' END AS stratum FROM supplier""")
def stratify_prefix(read) -> DataFrame:
    return read("supplier").select("s_suppkey", "s_name", naming.stratum("s_name", {"first": "SUPPLIER#00000000", "second": "supplier#0000000"}, "rest").alias("stratum"))


@tables("""SELECT s_suppkey, 'data' AS folder, s_name || '.h5' AS file, '/segm/labels' AS inner, '.h5' AS ext FROM supplier""")
def path_parts(read) -> DataFrame:
    p = read("supplier").select("s_suppkey", F.concat(F.lit("data/"), "s_name", F.lit(".h5/segm/labels")).alias("p"))
    of = naming.path_parts("p")
    return p.select("s_suppkey", *(of[k].alias(k) for k in ("folder", "file", "inner", "ext")))


@tables("""SELECT n_nationkey, 'C' || lpad(n_nationkey::VARCHAR, 3, '0') AS suffix, 'ds_*_' || n_name AS pattern, concat_ws('_', n_name, n_regionkey::VARCHAR) AS joined FROM nation""")
def name_templates(read) -> DataFrame:
    n = read("nation").withColumn("t", F.concat(F.lit("ds_{c:03d}_"), "n_name"))
    return n.select("n_nationkey", naming.suffix("C", "n_nationkey").alias("suffix"), naming.wildcard("t").alias("pattern"), F.concat_ws("_", "n_name", F.col("n_regionkey").cast("string")).alias("joined"))


@tables("""SELECT a.r_name AS norm, b.r_name AS markers, k AS neighbours, a.r_name || '-' || b.r_name || '-' || k AS run FROM region a, region b, (VALUES (10), (30)) t(k)""")
def parameter_grid(read) -> DataFrame:
    r = read("region").select("r_name")
    k = r.sparkSession.createDataFrame([(10,), (30,)], "neighbours int")
    # a grid of parameters, whose size the parameter lists fix
    g = r.select(F.col("r_name").alias("norm")).join(r.select(F.col("r_name").alias("markers"))).join(k)
    return g.withColumn("run", F.concat_ws("-", "norm", "markers", F.col("neighbours").cast("string")))


@tables("""SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ' ' ORDER BY o_orderpriority) AS keys, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def merged_maps(read) -> DataFrame:
    g = read("orders").groupBy("o_orderstatus").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("k"), F.count("*").alias("n"))
    return g.select("o_orderstatus", F.array_join("k", " ").alias("keys"), "n")


@tables("""SELECT p_size AS z, round(10.0 / (1 + p_size % 3), 6) AS elsize, CAST(round_even(20.0 / (10.0 / (1 + p_size % 3)), 0) AS INTEGER) AS factor FROM (SELECT DISTINCT p_size FROM part)""")
def downsample_factors(read) -> DataFrame:
    p = read("part").select(F.col("p_size").alias("z")).distinct().withColumn("elsize", 10.0 / (1 + F.col("z") % 3))
    return p.select("z", F.round("elsize", 6).alias("elsize"), F.rint(20.0 / F.col("elsize")).cast("int").alias("factor"))
