"""Single-dataset loads: strict (dedupe and reject), lenient (measure only), and
by schema policy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..audit import AuditLog, audited
from ..contract import Contract
from ..functions.frames import empty_frame
from ..operators import gates, quality
from ..operators.dedupe import latest_per_key
from ..operators.mapping import add_missing_update_columns, compile_mapping, lenient_mapping
from ..operators.profile import null_count, regex_failures
from ..operators.schema import check_schema, diff_columns
from ..sources import writers
from ..sources.readers import read_by_contract, read_or_empty, read_source
from .result import LoadResult, log_ignored, watched

LAYER = "layer"
CURATED, REJECTS = "curated", "rejects"
ETL_RULES = ("not_null", "regex")


def _tagged(
    df: DataFrame, contract: Contract, null_policy: str, on_cast_error: str, all_reasons: bool
) -> DataFrame:
    mapping = compile_mapping(df.schema, contract, on_cast_error=on_cast_error)
    mapped = mapping.apply(df)
    rules = quality.applicable(quality.compile_rules(contract, ETL_RULES), mapping.names)
    return quality.tag_rows(mapped, rules, null_policy=null_policy, all_reasons=all_reasons)


def _log_diff(df: DataFrame, contract: Contract, log: AuditLog) -> None:
    log_ignored(contract, log)
    diff = diff_columns(df, contract)
    if diff.missing:
        log.error("schema_validation", "Source lacks contract columns", missing=diff.missing)
    if diff.extra:
        log.warn("schema_validation", "Source has columns outside the contract", extra=diff.extra)
    log.info("schema_validation", "Columns compared")


def _log_counts(result: LoadResult, source_rows: int, curated_rows: int) -> None:
    check = gates.reconcile(source_rows, curated_rows)
    result.metrics.update(check.details())
    report = result.log.warn if check.mismatch else result.log.info
    report("row_count_check", "Row counts compared", **check.details())


# -------------------------------------------------------------------- strict


def strict_tagged(
    df: DataFrame,
    contract: Contract,
    moment: datetime | None = None,
    *,
    null_policy: str = "reject",
    on_cast_error: str = "null",
    all_reasons: bool = False,
    null_keys: str = "keep",
) -> DataFrame:
    """Latest row per key, mapped, each with the first rule it fails.

    Rows without a key are all kept, for the rules to judge; ``null_keys="collapse"``
    takes them as one key.
    """
    dated = add_missing_update_columns(df, contract.update_columns, moment)
    latest = latest_per_key(
        dated, contract.id_columns, contract.update_columns, null_keys=null_keys
    )
    return _tagged(latest, contract, null_policy, on_cast_error, all_reasons)


def load_strict(
    spark: SparkSession,
    contract: Contract,
    output: str,
    moment: datetime,
    *,
    source: DataFrame | None = None,
    null_policy: str = "reject",
    on_cast_error: str = "null",
    all_reasons: bool = False,
    null_keys: str = "keep",
    audit: str = "",
) -> LoadResult:
    """Schema check, dedupe, mapping, rules; curated rows and rejects.

    Every source row is accounted for: it is curated, rejected, counted in
    ``duplicate_rows`` as one that a later row of its key replaces, or, if NULLs are
    to be dropped, counted in ``dropped_rows``.

    The deduplicated rows are shuffled once and written once, into
    ``layer=curated`` and ``layer=rejects`` under ``output``; see read_output.
    Without keys to deduplicate by nothing is shuffled and each layer is written
    by a pass of its own. Besides that only the source rows are counted, from
    file footers if parquet.
    """
    df = read_by_contract(spark, contract) if source is None else source
    with audited(spark, contract.name or "strict", audit, moment) as log:
        result = LoadResult(log=log)
        source_rows = df.count()
        log.info("read_input", "Source counted", row_count=source_rows)
        _log_diff(df, contract, log)
        deduped = bool(contract.id_columns and contract.update_columns)
        if not deduped:
            log.warn("dedupe", "Not deduplicated: no id or update columns")

        tagged = strict_tagged(
            df,
            contract,
            moment,
            null_policy=null_policy,
            on_cast_error=on_cast_error,
            all_reasons=all_reasons,
            null_keys=null_keys,
        )
        result.paths = {name: layer_path(output, name) for name in (CURATED, REJECTS)}
        observed, counts = watched(tagged, gates.row_metrics())
        kept = observed.filter(quality.is_valid() | quality.is_rejected())
        if deduped:
            layer = F.when(quality.is_valid(), CURATED).otherwise(REJECTS)
            by_layer = kept.withColumn(LAYER, layer)
            writers.overwrite(by_layer, output, [LAYER])
            metrics = counts.get
        else:
            writers.overwrite(kept.filter(quality.is_valid()), result.paths[CURATED])
            metrics = counts.get
            rejects = quality.rejected_rows(tagged)
            if not metrics["rejected_rows"]:
                rejects = empty_frame(spark, rejects.schema)
            writers.overwrite(writers.evened(rejects), result.paths[REJECTS])

        result.metrics["deduped_rows"] = metrics["total_rows"]
        result.metrics["duplicate_rows"] = source_rows - metrics["total_rows"]
        result.metrics["rule_rejects"] = metrics["rejected_rows"]
        result.metrics["dropped_rows"] = (
            metrics["total_rows"] - metrics["valid_rows"] - metrics["rejected_rows"]
        )
        log.info("write_output", "Curated and rejects written", path=output, **metrics)
        _log_counts(result, source_rows, metrics["valid_rows"])
        return result


def layer_path(output: str, layer: str) -> str:
    return f"{output.rstrip('/')}/{LAYER}={layer}"


def read_output(spark: SparkSession, output: str, layer: str, schema: StructType) -> DataFrame:
    """One layer of a strict load, given the schema of its tagged rows."""
    table = read_or_empty(spark, layer_path(output, layer), schema)
    return table if layer == REJECTS else table.drop(quality.ERROR_REASON, quality.ERROR_REASONS)


# ------------------------------------------------------------------- lenient


def lenient_frame(df: DataFrame, contract: Contract) -> DataFrame:
    """Every row, mapped as far as types allow."""
    return lenient_mapping(df, contract).apply(df)


def load_lenient(
    spark: SparkSession,
    contract: Contract,
    output: str,
    moment: datetime,
    *,
    source: DataFrame | None = None,
    audit: str = "",
) -> LoadResult:
    """Keep every row; count nulls and pattern failures while writing it."""
    df = read_by_contract(spark, contract) if source is None else source
    with audited(spark, contract.name or "lenient", audit, moment) as log:
        result = LoadResult(log=log)
        _log_diff(df, contract, log)
        mapped = lenient_frame(df, contract)
        present = [f for f in contract.fields if f.source in df.columns]
        checks = [("null_check", f.target, null_count(f.target)) for f in present]
        checks += [
            ("regex_check", f.target, regex_failures(mapped, f.target, f.regex))
            for f in present
            if f.regex
        ]
        metrics = [m.alias(f"c{i}") for i, (_, _, m) in enumerate(checks)]
        observed, counts = watched(mapped, [F.count(F.lit(1)).alias("rows"), *metrics])
        writers.overwrite(observed, output)

        found = counts.get
        for i, (stage, column, _) in enumerate(checks):
            failures = found[f"c{i}"]
            result.metrics[f"{stage}.{column}"] = failures
            if failures:
                log.warn(stage, f"Failed for {column}", count=failures)
        result.paths[CURATED] = output
        log.info("write_output", "Curated data written", path=output)
        # No step drops or adds a row, so one count stands for both sides.
        _log_counts(result, found["rows"], found["rows"])
        return result


# -------------------------------------------------------------------- policy


def policy_tagged(
    df: DataFrame,
    contract: Contract,
    *,
    null_policy: str = "reject",
    on_cast_error: str = "null",
    all_reasons: bool = False,
) -> DataFrame:
    """Mapped rows, each with the first rule it fails; nothing deduplicated."""
    return _tagged(df, contract, null_policy, on_cast_error, all_reasons)


def load_with_policy(
    spark: SparkSession,
    source: str | DataFrame,
    contract: Contract,
    curated: str,
    rejects: str,
    moment: datetime,
    *,
    on_schema_fail: str = "flag",
    null_policy: str = "reject",
    on_cast_error: str = "null",
    all_reasons: bool = False,
    audit: str = "",
) -> LoadResult:
    """Schema policy, mapping, rules; distinct rejects.

    One pass writes curated rows and counts; a second reads them only for rejects.
    Both outputs replace what an earlier run left, also with no rows.
    """
    df = read_source(spark, source) if isinstance(source, str) else source
    with audited(spark, contract.name or "policy", audit, moment) as log:
        result = LoadResult(log=log)
        log_ignored(contract, log)
        result.schema_ok, diff = True, diff_columns(df, contract)
        if contract.policy.check_schema:
            result.schema_ok, diff = check_schema(df, contract, on_schema_fail)
        if not contract.policy.check_schema:
            log.info("schema_validation", "Columns not checked, as the contract says")
        elif result.schema_ok:
            log.info("schema_validation", "Column policy met")
        else:
            log.warn(
                "schema_validation",
                "Column policy violated; going on",
                missing=diff.missing,
                extra=diff.extra,
            )
        tagged = policy_tagged(
            df,
            contract,
            null_policy=null_policy,
            on_cast_error=on_cast_error,
            all_reasons=all_reasons,
        )
        observed, counts = watched(tagged, gates.row_metrics())
        writers.overwrite(quality.valid_rows(observed), curated)
        metrics = counts.get
        result.metrics.update(metrics)
        result.paths[CURATED] = curated
        rejected = quality.rejected_rows(tagged).dropDuplicates()
        if not metrics["rejected_rows"]:
            rejected = empty_frame(spark, rejected.schema)
        writers.overwrite(rejected, rejects)
        result.paths[REJECTS] = rejects
        log.info("write_output", "Output written", **metrics)
        if contract.policy.check_row_count:
            _log_counts(result, metrics["total_rows"], metrics["valid_rows"])
        return result
