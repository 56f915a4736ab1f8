"""Driver tables and the views this package derives from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def table_or(spark: SparkSession, path: str, fallback: str) -> DataFrame:
    """The Parquet table at ``path``, or at ``fallback`` if there is none."""
    return spark.read.parquet(path if exists(spark, path) else fallback)


TASK_ROWS = 16_384  # rows of a source table for one task


def spread(df: DataFrame, key: str, factor: int = 2) -> DataFrame:
    """Hash-spread a scan whose rows arrive in too few tasks. The scan's own
    number of partitions does not tell: splits are cut by bytes, but a row
    group goes to one of them whole, so the rows of each are counted (no
    column is read). Scans that are fine already are left alone: no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    r = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count(F.lit(1)).alias("parts")).first()
    rows = r["n"] or 0
    if not rows or (r["parts"] >= cores and r["most"] <= max(TASK_ROWS, rows / (cores * factor))):
        return df
    return df.repartition(max(cores * factor, -(-rows // TASK_ROWS)), key)
