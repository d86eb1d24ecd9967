"""Frames the queries start from: whole tables, with the irregularities (NULLs,
NaNs, text dates, re-keyed rows) that the generated tables lack."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from datetime import datetime, timezone
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType

from tablepact.sources.readers import read_source

MOMENT = datetime(2025, 11, 14, 8, 30, tzinfo=timezone.utc)
LOAD_DATE, LOAD_HOUR = "2025-11-14", "08"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the cluster names for checkpoints.

    Only a local session without that setting gets a folder on this machine, which
    is removed when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/tablepact/{label}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="workload-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions; the lowest priority counts as not given."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("acct_no"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )


def text_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as a text file would hold them, with some unreadable values."""
    pending = F.col("o_orderstatus") == "P"
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("txn_id"),
        F.when(pending, "n/a")
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("txn_day"),
        F.when(urgent, "n/a")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("txn_iso"),
        F.when(urgent, "free")
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("amount"),
        F.col("o_orderpriority").alias("priority"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A business table: every order with one row in force and one closed row."""
    orders = table(spark, sf_dir, "orders")

    def versions(amount: Column, start: str, end: str, current: bool) -> DataFrame:
        return orders.select(
            F.col("o_orderkey").alias("transaction_id"),
            amount.alias("amount"),
            F.col("o_orderstatus").alias("transaction_type"),
            F.lit(start).alias("effective_start_date"),
            F.lit(end).alias("effective_end_date"),
            F.lit(current).alias("is_current"),
        )

    price = F.col("o_totalprice")
    return versions(price, "2020-01-01", "9999-12-31", True).unionByName(
        versions(price - 1, "2019-01-01", "2020-01-01", False)
    )


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business table without history: one row per order."""
    current = history(spark, sf_dir).filter("is_current")
    return current.select("transaction_id", "amount", "transaction_type")


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next batch: lowest-priority orders come under a new id, pending ones
    with a new amount, urgent ones without an amount, the others as they were."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", -1 - F.col("o_orderkey"))
        .otherwise(F.col("o_orderkey"))
        .alias("transaction_id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1)
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        F.col("o_orderstatus").alias("transaction_type"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Dates and decimals as text, arrays as joined text: equal in any engine."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DateType, DecimalType)):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c, ",").alias(f.name)
        columns.append(c)
    return df.select(*columns)


def _noted(df: DataFrame) -> DataFrame:
    return df.withColumn("note", F.concat(F.lit("n"), F.col("transaction_id")))


def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch, its pending orders once more, and its finished ones without a key."""
    df = batch(spark, sf_dir)
    again = df.filter("transaction_type = 'P'").withColumn("amount", F.col("amount") + 2)
    keyless = df.filter("transaction_type = 'F'").withColumn(
        "transaction_id", F.lit(None).cast("bigint")
    )
    return df.unionByName(again).unionByName(keyless)


#: Files that loads read, by name: how their rows are made, and their format.
FIXTURES = {
    "business": (business, "parquet"),
    "business_noted": (lambda spark, sf_dir: _noted(business(spark, sf_dir)), "parquet"),
    "business_csv": (business, "csv"),
    "batch": (batch, "parquet"),
    "batch_csv": (batch, "csv"),
    "batch_repeated": (repeated_batch, "parquet"),
    "text": (text_transactions, "parquet"),
    "text_csv": (text_transactions, "csv"),
}
_WRITTEN: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The path of a fixture, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        build, fmt = FIXTURES[name]
        path = f"{scratch_path(spark, name)}.{fmt}"
        build(spark, sf_dir).write.option("header", True).format(fmt).save(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]
