"""Writers: partitioned volumes, block overwrites, pyramids, feature tables, label sets, views."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_volume(vox: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder a block, so that a block is read and replaced alone. An existing target is an error unless asked otherwise."""
    vox.write.mode(mode).partitionBy("block").parquet(path)


def write_blocks(vox: DataFrame, path: str) -> None:
    """Replace the blocks that ``vox`` holds and leave all others."""
    vox.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block").parquet(path)


def write_pyramid(vox: DataFrame, path: str, levels: int) -> None:
    """Strided copies, level k with every 2^k-th row and column, as partitions ``reslev``."""
    hit = [F.when(F.expr(f"y % {1 << k} = 0 and x % {1 << k} = 0"), F.lit(k)) for k in range(levels)]
    every = vox.withColumn("reslev", F.explode(F.filter(F.array(*hit), lambda k: k.isNotNull())))
    every.withColumns({a: F.expr(f"{a} div (1 << reslev)") for a in "yx"}).write.mode("overwrite").partitionBy("reslev").parquet(path)


def write_features(features: DataFrame, path: str, by: tuple[str, ...] = ("block",)) -> None:
    features.write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)


def write_label_sets(sets: DataFrame, path: str) -> None:
    """``(key, label)`` -> lines ``key: l1 l2 …``."""
    g = sets.groupBy("key").agg(F.sort_array(F.collect_set("label")).alias("s"))
    g.select(F.concat(F.col("key").cast("string"), F.lit(": "), F.array_join(F.transform("s", lambda x: x.cast("string")), " ")).alias("value")).write.mode("overwrite").text(path)


def stacked(volumes: dict[str, DataFrame], column: str = "volume") -> DataFrame:
    """A virtual volume out of several: nothing is copied until it is read."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (v.withColumn(column, F.lit(k)) for k, v in volumes.items()))


def channels(vox: DataFrame, keep: list[int]) -> DataFrame:
    """Some channels, numbered anew by their place in the list."""
    new = F.create_map(*(F.lit(x) for k, c in enumerate(keep) for x in (c, k)))
    return vox.where(F.col("c").isin(keep)).withColumn("c", new[F.col("c")])


def with_channel(vox: DataFrame, number: int) -> DataFrame:
    """One more channel, empty, at the places of the first one."""
    least = vox.agg(F.min("c").alias("_c"))
    empty = vox.join(least).where("c = _c").drop("_c").withColumns({"c": F.lit(number).cast(vox.schema["c"].dataType), "v": F.lit(0).cast(vox.schema["v"].dataType)})
    return vox.unionByName(empty)


#: Display colours of channels, in turn.
COLOURS = ("1 0 0", "0 1 0", "0 0 1", "1 1 0", "1 0 1", "0 1 1")


def display(vox: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """A channel's name, colour, colour mode and range of values."""
    name = F.lit(None).cast("string")
    for c, n in (names or {}).items():
        name = F.when(F.col("c") == c, n).otherwise(name)
    colour = F.element_at(F.array(*map(F.lit, COLOURS)), F.pmod(F.col("c"), F.lit(len(COLOURS))).cast("int") + 1)
    g = vox.groupBy("c").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return g.select("c", F.coalesce(name, F.concat(F.lit("chan"), F.col("c").cast("string"))).alias("name"), colour.alias("colour"), F.lit("BaseColor").alias("mode"), "lo", "hi")


def merged_files(spark: SparkSession, parts: str, out: str, read: Callable[[SparkSession, str], DataFrame], write: Callable[[DataFrame, str], None]) -> DataFrame:
    """Apply a reader to the part files, write what it gives, and drop the parts once that is written."""
    write(read(spark, parts), out)
    path = spark._jvm.org.apache.hadoop.fs.Path(parts)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return read(spark, out)


def template(vox: DataFrame, value: str = "v") -> DataFrame:
    """The same places, all zero."""
    return vox.withColumn(value, F.lit(0).cast(vox.schema[value].dataType))


def merged_runs(runs: list[dict]) -> dict:
    """Parameter trees of several runs: mappings are united, of other values the last counts."""
    out: dict = {}
    for run in runs:
        for k, v in run.items():
            out[k] = merged_runs([out[k], v]) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def log_run(spark: SparkSession, path: str, step: str, params: dict) -> None:
    """Append a step's parameters to the table of runs."""
    rows = [(step, k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "step string, name string, value string").write.mode("append").parquet(path)


def last_run(spark: SparkSession, path: str, step: str) -> dict[str, str]:
    return {r.name: r.value for r in spark.read.parquet(path).where(F.col("step") == step).collect()}
