"""Small frames without Python workers: a few driver-side rows, or none at all."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: str) -> DataFrame:
    """Rows of metadata (a contract's fields, a run's events) as a DataFrame."""
    text = json.dumps(list(rows))
    parsed = F.from_json(F.lit(text), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows; the optimiser knows it and drops the joins and unions above."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns).filter(F.lit(False))
