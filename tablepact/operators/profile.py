"""Column profiles: how many nulls and pattern failures each column holds.

One aggregate covers all columns; its single row is then turned into one row
per column inside Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import ref
from ..functions.frames import rows_frame
from ..sources.footers import null_counts
from .quality import Rule


def null_count(name: str) -> Column:
    """Nulls as rows minus present values."""
    return F.count(F.lit(1)) - F.count(ref(name))


def regex_failures(df: DataFrame, name: str, regex: str) -> Column:
    """Present values the pattern is not found in."""
    outcome = Rule(name, "regex", "", regex=regex).outcome(ref(name), df.schema[name].dataType)
    return F.count_if(~outcome)


def _by_column(df: DataFrame, metrics: Mapping[str, Column], count: str) -> DataFrame:
    names = list(metrics)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[metric.alias(f"m{i}") for i, metric in enumerate(metrics.values())],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("rows").alias("total_rows"),
            F.col(f"m{i}").alias(count),
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def profile_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, total_rows, null_rows), one row per column.

    Of a frame that is parquet files and nothing else, columns that aren't nested are
    counted at once from the files' footers; the others, and other frames, by one
    aggregate when the result is asked for.
    """
    names = list(columns) if columns is not None else df.columns
    found = null_counts(df, names)
    if found is None:
        return _by_column(df, {n: null_count(n) for n in names}, "null_rows")
    total, nulls = found
    rows = [{"column_name": n, "total_rows": total, "null_rows": nulls[n]} for n in nulls]
    counts = rows_frame(df.sparkSession, rows, "column_name string, total_rows bigint, null_rows bigint")
    rest = [n for n in names if n not in nulls]
    return counts.unionByName(_by_column(df, {n: null_count(n) for n in rest}, "null_rows")) if rest else counts


def profile_regex(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """(column_name, total_rows, failed_rows), one row per pattern."""
    metrics = {name: regex_failures(df, name, regex) for name, regex in patterns.items()}
    return _by_column(df, metrics, "failed_rows")
