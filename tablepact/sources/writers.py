"""Sinks: layers by batch partition, and where snapshots of business tables lie."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.casts import ref

_SNAPSHOT = "snapshot="
BATCH = "batch"


# -------------------------------------------------------------------- layers


def overwrite(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Replace the dataset at a path, once its successor is there in full.

    Rows are written beside the dataset and switched in by renaming, so a write that
    fails leaves the earlier rows, and the frame may read from the path itself. Names of
    folders beside it begin with "_", so nobody reads them. A run that was stopped between
    its two renames is made good by the next. Renaming must be cheap and whole, as on
    HDFS; where a store copies instead, readers may meet the switch half done.
    """
    target, fs = _file_system(df.sparkSession, path.rstrip("/"))
    parent, name = target.getParent().toString(), target.getName()
    kept = fs.globStatus(_file_system(df.sparkSession, f"{parent}/_{name}.before-*")[0])
    if kept and not fs.exists(target):
        fs.rename(kept[0].getPath(), target)
    run = uuid.uuid4().hex
    beside, _ = _file_system(df.sparkSession, f"{parent}/_{name}.next-{run}")
    before, _ = _file_system(df.sparkSession, f"{parent}/_{name}.before-{run}")
    writer = df.write.partitionBy(*by) if by else df.write
    try:
        writer.parquet(beside.toString())
    except Exception:
        fs.delete(beside, True)
        raise
    if fs.exists(target) and not fs.rename(target, before):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(beside, target):
        fs.rename(before, target)
        raise OSError(f"{path} could not be replaced")
    fs.delete(before, True)


def evened(df: DataFrame, *by: str) -> DataFrame:
    """Rows regrouped for writing: files of the session's advisory size.

    Spark merges small groups and splits big ones, so neither a filter that
    leaves a few rows per task nor one hot partition value yields bad files.
    """
    return df.hint("rebalance", *[ref(c) for c in by])


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", even: bool = True
) -> None:
    """Write a frame that spans partitions; overwrite replaces only those it holds.

    Rows are regrouped by partition first, or every task would add a file to
    every partition; pass ``even=False`` if they arrive grouped already.
    """
    grouped = evened(df, *by) if even else df
    writer = grouped.write.mode(mode).partitionBy(*by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def batch_path(path: str, dt: str, hr: str | None = None) -> str:
    base = f"{path.rstrip('/')}/dt={dt}"
    return base if hr is None else f"{base}/hr={hr}"


def write_batch(
    df: DataFrame, path: str, dt: str, hr: str | None = None, mode: str = "overwrite"
) -> str:
    """Write one batch as its dt (and hr) partition and return its path.

    A retried batch replaces what its first try wrote, also when it now has no
    rows, which a dynamic partition overwrite would leave standing.
    """
    target = batch_path(path, dt, hr)
    if mode == "overwrite":
        overwrite(df, target)
    else:
        df.write.mode(mode).parquet(target)
    return target


def append_rejects(
    df: DataFrame, path: str, dt: str, hr: str | None = None, batch: str | None = None
) -> str:
    """Add rejects to their dt (and hr) partition.

    Under the name of their ``batch``, in a partition of its own, they are replaced as
    a unit: a retry adds nothing twice, and other batches of the hour stay. Without a
    name a retry adds them again. A partition holds named batches, or unnamed ones.
    """
    if batch is None:
        return write_batch(df, path, dt, hr, mode="append")
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"batch={batch!r} is no name for a folder")
    target = f"{batch_path(path, dt, hr)}/{BATCH}={batch}"
    overwrite(df, target)
    return target


def read_layer(
    spark: SparkSession, path: str, schema: StructType, by: Sequence[str] = ("dt",)
) -> DataFrame:
    """A partitioned layer; partition values are read as text, so "08" stays "08"."""
    full = StructType(list(schema.fields))
    for name in by:
        full = full.add(name, "string")
    return spark.read.schema(full).parquet(path)


# ----------------------------------------------------------------- snapshots


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def snapshot_path(root: str, snapshot: str) -> str:
    return f"{root.rstrip('/')}/{_SNAPSHOT}{snapshot}"


def _snapshots_holding(spark: SparkSession, root: str, entry: str) -> list[str]:
    pattern, fs = _file_system(spark, f"{root.rstrip('/')}/{_SNAPSHOT}*/{entry}")
    found = fs.globStatus(pattern) or []
    return sorted(s.getPath().getParent().getName()[len(_SNAPSHOT) :] for s in found)


class StaleBatch(ValueError):
    """A batch older than the newest snapshot cannot be merged on top of it."""
