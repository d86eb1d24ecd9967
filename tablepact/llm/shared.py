"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder spark.checkpoint.dir names; a local session without one gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read back; no executor holds it alone."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with ``ord``, a long in the order of keys, no two rows the same.

    It is the key itself if keys are whole numbers, none null and none repeated;
    else rows are numbered by key (null last), then text.
    """
    column = F.col(f"`{key}`")
    repeated = docs.groupBy(column.alias("k")).count().filter("count > 1 or k is null")
    if docs.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint") and repeated.isEmpty():
        return docs.withColumn("ord", column.cast("long"))
    order = docs.orderBy(column.asc_nulls_last(), F.col(f"`{text}`").asc_nulls_last())
    placed = cut(order.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_row").alias("_low"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = sizes.select("_part", (before - F.col("_low")).alias("_shift"))  # a row for each task
    return placed.join(shift, "_part").withColumn("ord", F.expr("_row + _shift")).drop("_part", "_row", "_shift")
