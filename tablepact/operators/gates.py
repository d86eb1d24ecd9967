"""Batch metrics, quality gates and reconciliation.

Metrics are plain aggregate columns. A pipeline hands them to ``observe`` on a
write it does anyway; a stand-alone gate runs them as one aggregate. Either way
all of them cost one pass together.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import ref
from ..functions.frames import rows_frame
from ..sources.footers import null_counts
from .quality import Resolver, Rule, invalid_flag, is_rejected, is_valid


class GateFailed(RuntimeError):
    """A batch missed a quality limit."""

    def __init__(self, gate: Gate) -> None:
        super().__init__(
            f"{gate.name}: {gate.value:.4f} is beyond the limit of {gate.threshold}"
        )
        self.gate = gate


@dataclass(frozen=True)
class Gate:
    name: str
    value: float
    threshold: float
    passed: bool

    def enforce(self) -> Gate:
        if not self.passed:
            raise GateFailed(self)
        return self


# ------------------------------------------------------------ metric columns


def row_metrics() -> list[Column]:
    """Counts of a tagged frame: all rows, valid rows, rejected rows."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_valid()).alias("valid_rows"),
        F.count_if(is_rejected()).alias("rejected_rows"),
    ]


def null_total(columns: Iterable[str], resolve: Resolver = ref) -> Column:
    """Nulls over all given columns, as one count."""
    per_row = sum((resolve(c).isNull().cast("int") for c in columns), F.lit(0))
    return F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0)).cast("bigint")


def invalid_total(df: DataFrame, rules: Sequence[Rule], combine: str = "any") -> Column:
    return F.count_if(invalid_flag(rules, df.schema, combine))


# -------------------------------------------------------- gates over metrics


def valid_ratio(total: int, valid: int, threshold: float = 0.95) -> Gate:
    """At least this share of rows is valid; an empty batch has ratio 0."""
    value = valid / total if total else 0.0
    return Gate("valid_ratio", value, threshold, value >= threshold)


def reject_pct(total: int, invalid: int, threshold: float = 0.05) -> Gate:
    """At most this share of rows is invalid; an empty batch passes."""
    value = invalid / max(total, 1)
    return Gate("reject_pct", value, threshold, value <= threshold)


def null_pct(total: int, nulls: int, threshold: float = 0.10) -> Gate:
    """Nulls over all contract columns per row, which may exceed 1."""
    value = nulls / max(total, 1)
    return Gate("null_pct", value, threshold, value <= threshold)


@dataclass(frozen=True)
class Reconciliation:
    source_rows: int
    curated_rows: int
    rejected_rows: int
    mismatch: bool
    pct_loss: float

    def details(self) -> dict[str, object]:
        return {
            "source_count": self.source_rows,
            "curated_count": self.curated_rows,
            "rejected_count": self.rejected_rows,
            "mismatch": self.mismatch,
            "pct_loss": f"{self.pct_loss}%" if self.source_rows else "0%",
        }


def reconcile(source: int, curated: int) -> Reconciliation:
    """Rows in against rows out; "rejected" is all that did not come out."""
    lost = source - curated
    pct = round(lost / source * 100, 2) if source else 0.0
    return Reconciliation(source, curated, lost, source != curated, pct)


# ------------------------------------------------------- one-row DataFrames


def _ratio(part: str, whole: Column) -> Column:
    return F.col(part).cast("double") / whole.cast("double")


def _gate_frame(metrics: DataFrame, value: Column, threshold: float, at_least: bool) -> DataFrame:
    limit = F.lit(float(threshold))
    passed = value >= limit if at_least else value <= limit
    return metrics.select(
        F.col("total_rows"),
        F.round(value, 6).alias("value"),
        limit.alias("threshold"),
        passed.alias("passed"),
    )


def gate_valid_ratio(tagged: DataFrame, threshold: float = 0.95) -> DataFrame:
    metrics = tagged.agg(*row_metrics())
    ratio = F.when(F.col("total_rows") > 0, _ratio("valid_rows", F.col("total_rows")))
    return _gate_frame(metrics, F.coalesce(ratio, F.lit(0.0)), threshold, at_least=True)


def gate_reject_pct(
    df: DataFrame, rules: Sequence[Rule], threshold: float = 0.05, combine: str = "any"
) -> DataFrame:
    metrics = df.agg(
        F.count(F.lit(1)).alias("total_rows"), invalid_total(df, rules, combine).alias("invalid")
    )
    return _gate_frame(
        metrics, _ratio("invalid", F.greatest("total_rows", F.lit(1))), threshold, at_least=False
    )


def gate_null_pct(df: DataFrame, columns: Iterable[str], threshold: float = 0.10) -> DataFrame:
    """Of a frame that is parquet files and nothing else, from the files' footers."""
    columns = list(columns)
    found = null_counts(df, columns)
    if found and set(found[1]) == set(columns):
        row = {"total_rows": found[0], "nulls": sum(found[1][c] for c in columns)}
        metrics = rows_frame(df.sparkSession, [row], "total_rows bigint, nulls bigint")
    else:
        metrics = df.agg(F.count(F.lit(1)).alias("total_rows"), null_total(columns).alias("nulls"))
    return _gate_frame(
        metrics, _ratio("nulls", F.greatest("total_rows", F.lit(1))), threshold, at_least=False
    )


def invalid_count(df: DataFrame, rules: Sequence[Rule], combine: str = "any") -> DataFrame:
    """One row: rows in total, rows that are invalid."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        invalid_total(df, rules, combine).alias("invalid_rows"),
    )


def rowcount_reconcile(tagged: DataFrame) -> DataFrame:
    """Reconciliation of a tagged frame in one aggregate."""
    lost = F.col("source_rows") - F.col("curated_rows")
    pct = F.when(
        F.col("source_rows") > 0, F.round(lost * F.lit(100.0) / F.col("source_rows"), 2)
    ).otherwise(0.0)
    counts = tagged.agg(
        F.count(F.lit(1)).alias("source_rows"), F.count_if(is_valid()).alias("curated_rows")
    )
    return counts.select(
        "source_rows",
        "curated_rows",
        lost.alias("rejected_rows"),
        (lost != 0).alias("mismatch"),
        pct.alias("pct_loss"),
    )
