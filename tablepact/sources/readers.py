"""Sources: parquet and CSV by path, flag or contract; tables that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..contract import Contract, ContractError
from ..functions.frames import empty_frame


def format_of(path: str) -> str:
    return "csv" if path.rstrip("/").lower().endswith(".csv") else "parquet"


def text_schema(columns: list[str]) -> StructType:
    """All-string schema of a CSV file whose header is known."""
    return StructType([StructField(c, StringType()) for c in columns])


def read_source(
    spark: SparkSession, path: str, fmt: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """A dataset in the given format, else in the one its path suffix implies.

    CSV files have a header and only string columns. ``columns`` names them in
    file order and saves Spark the read of the header; it must be the full list.
    """
    fmt = (fmt or format_of(path)).lower()
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if columns is not None:
            reader = reader.schema(text_schema(columns)).option("enforceSchema", False)
    return reader.load(path)


def read_by_contract(spark: SparkSession, contract: Contract) -> DataFrame:
    """The dataset a contract points at, in the format it names."""
    if not contract.source_path:
        raise ContractError(f"contract {contract.name!r} names no source path")
    return read_source(spark, contract.source_path, contract.source_format)


def read_if_exists(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """The parquet dataset at a path, or None if nothing is there.

    Only a missing path counts; any other failure is raised.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The parquet dataset at a path, or an empty frame of the same schema."""
    found = read_if_exists(spark, path, schema)
    return empty_frame(spark, schema) if found is None else found
