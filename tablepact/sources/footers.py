"""Row and null counts from the footers of parquet files, without reading a column.

The second version of Spark's parquet source answers COUNT from the statistics that
each file keeps. It is asked in a session of its own, so that the caller's settings stay
as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..functions.casts import ref


def plain_parquet(df: DataFrame) -> list[str] | None:
    """The paths a frame reads, if it is all rows of unpartitioned parquet files and nothing else."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.nodeName() != "LogicalRelation":
        return None
    relation = plan.relation()
    if not relation.getClass().getSimpleName() == "HadoopFsRelation":
        return None
    if "ParquetFileFormat" not in relation.fileFormat().getClass().getName() or relation.partitionSchema().size():
        return None
    roots = relation.location().rootPaths()
    return [roots.apply(i).toString() for i in range(roots.size())]


def counted(data_type: DataType) -> bool:
    """Footers count the nulls of columns that aren't nested."""
    return not isinstance(data_type, (ArrayType, MapType, StructType, VariantType))


def footer_counts(
    spark: SparkSession, paths: Sequence[str], schema: StructType, columns: Sequence[str]
) -> tuple[int, dict[str, int]] | None:
    """All rows, and the present values of each column; None where a file keeps no such counts."""
    if not all(counted(schema[c].dataType) for c in columns):
        raise ValueError("nested columns have no counts in footers")
    frame = footer_frame(spark, paths, schema, columns)
    try:
        row = frame.first()
    except Exception as e:
        if "statistics" not in str(e).lower():
            raise
        return None
    return row[0], dict(zip(columns, row[1:], strict=True))


def footer_frame(
    spark: SparkSession, paths: Sequence[str], schema: StructType, columns: Sequence[str]
) -> DataFrame:
    """One row of counts, planned so that footers answer it."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    wanted = StructType([schema[c] for c in columns])
    source = own.read.schema(wanted if columns else schema).parquet(*paths)
    present = [F.count(ref(c)).alias(f"c{i}") for i, c in enumerate(columns)]
    return source.agg(F.count(F.lit(1)).alias("rows"), *present)


def null_counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]] | None:
    """All rows, and the NULLs of those columns that footers count.

    None if the frame is anything but parquet files, or no footer tells.
    """
    paths = plain_parquet(df)
    known = [n for n in columns if paths and counted(df.schema[n].dataType)]
    found = footer_counts(df.sparkSession, paths, df.schema, known) if known else None
    if found is None:
        return None
    total, present = found
    return total, {n: total - present[n] for n in known}
