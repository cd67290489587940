"""New block files as a stream: per-block statistics kept up to date as files arrive.

It goes beyond the batch engine: files of voxels are picked up as they are
written, and counts, sums and extremes grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "block long, z long, y long, x long, v long, label long"


def arriving(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def statistics(vox: DataFrame) -> DataFrame:
    return vox.groupBy("block").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most"), F.max("label").alias("maxlabel"))


def follow(spark: SparkSession, path: str, out: str, checkpoint: str):
    """Start a query that writes the blocks which new files have changed to ``out``; stops once all files there are read.

    Statistics are kept by the stream's state store; the driver holds none. A
    batch that is run again replaces its own folder.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    q = statistics(arriving(spark, path)).writeStream.outputMode("update").foreachBatch(write)
    return q.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def followed(spark: SparkSession, out: str) -> DataFrame:
    """The latest statistics of each block."""
    rows = spark.read.parquet(out)
    names = [c for c in rows.columns if c not in ("block", "batch")]
    return rows.groupBy("block").agg(F.max_by(F.struct(*names), "batch").alias("s")).select("block", "s.*")
