"""One query per operator family. Each takes (spark, sf_dir)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepact.audit import read_audit
from tablepact.contract import parse_contract
from tablepact.functions.casts import parse_date
from tablepact.functions.frames import rows_frame
from tablepact.operators import dedupe, gates, mapping, merge, profile, quality, schema
from tablepact.plans import (
    Layers,
    compact,
    layered_tagged,
    load_daily_scd2,
    load_hourly_scd2,
    load_lenient,
    load_scd1,
    load_strict,
    load_with_policy,
    read_business,
    read_output,
    strict_tagged,
)
from tablepact.sources import contracts, readers, tables, writers

from . import inputs
from .inputs import LOAD_DATE, LOAD_HOUR, MOMENT, plain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["transaction_id"]
TRACKED = ["amount", "transaction_type"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ----------------------------------------------------------------- contracts


def fields_contract(*fields: dict, **document):
    entries = [{"source_field": "-", "nullable": True, **f} for f in fields]
    return parse_contract({"dataset_name": "transactions", "fields": entries, **document})


def ds_document(*columns: dict, **ds) -> dict:
    entries = [
        {"tgt_nm": c["src_nm"], "src_dtype": "", "tgt_dtype": "", "nullable": True, **c}
        for c in columns
    ]
    return {"ds": {"nm": "transactions", "cols": entries, **ds}}


def ds_contract(*columns: dict, **ds):
    return parse_contract(ds_document(*columns, **ds))


def typed_contract(**document):
    """Transactions renamed and retyped, with one added column."""
    return fields_contract(
        {
            "source_field": "txn_id",
            "target_field": "transaction_id",
            "target_type": "bigint",
            "primary_key": True,
            "change_type": "renamed",
        },
        {
            "source_field": "acct_no",
            "target_field": "account_number",
            "target_type": "string",
            "change_type": "renamed",
        },
        {
            "source_field": "txn_date",
            "target_field": "transaction_date",
            "target_type": "date",
            "change_type": "renamed",
        },
        {
            "source_field": "amount",
            "target_field": "amount",
            "target_type": "decimal(12,2)",
            "constraints": {"min": 5000, "max": 450000.0},
            "change_type": "type_modified",
        },
        {
            "target_field": "transaction_type",
            "target_type": "string",
            "constraints": None,
            "change_type": "added",
        },
        **document,
    )


MERGE_FIELDS = (
    {
        "source_field": "transaction_id",
        "target_field": "transaction_id",
        "target_type": "bigint",
        "primary_key": True,
    },
    {
        "source_field": "amount",
        "target_field": "amount",
        "target_type": "double",
        "constraints": {"min": 5000, "max": 450000.0},
        "change_type": "type_modified",
    },
    {
        "source_field": "transaction_type",
        "target_field": "transaction_type",
        "target_type": "string",
        "allowed_values": ["O", "F", "P"],
    },
)


def merge_contract(*more: dict, **limits):
    """Batches of the business table, checked for amount and type."""
    return fields_contract(*MERGE_FIELDS, *more, thresholds=limits)


def rule_contract():
    """Rules of every kind over transactions, under their source names."""
    return parse_contract(
        {
            "ds": {
                "nm": "transactions",
                "cols": [
                    {
                        "src_nm": "priority",
                        "tgt_nm": "priority",
                        "nullable": False,
                        "regex": "^[1-4]-",
                    }
                ],
            }
        }
    )


def all_rules() -> list[quality.Rule]:
    bounds = fields_contract(
        {"target_field": "amount", "constraints": {"min": 5000, "max": 450000}},
        {"target_field": "status", "allowed_values": ["O", "F"]},
    )
    return quality.compile_rules(rule_contract()) + quality.compile_rules(bounds)


def tagged_transactions(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return quality.tag_rows(inputs.transactions(spark, sf_dir), all_rules(), **options)


def status_rule() -> list[quality.Rule]:
    return quality.compile_rules(
        fields_contract({"target_field": "status", "allowed_values": ["O", "F"]})
    )


# ------------------------------------------------------------------- sources


@query
def scan_parquet(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    # Some discounts are -0.0; adding zero makes them 0.0 everywhere.
    return lines.withColumn("l_discount", F.col("l_discount") + F.lit(0.0))


@query
def scan_csv_header(spark, sf_dir):
    path = inputs.scratch_path(spark, "customer") + ".csv"
    inputs.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return readers.read_source(spark, path)


@query
def scan_by_contract(spark, sf_dir):
    path = inputs.scratch_path(spark, "part")
    inputs.table(spark, sf_dir, "part").write.option("header", True).csv(path)
    contract = ds_contract({"src_nm": "p_partkey"}, format="csv", src_prefix=path)
    return readers.read_by_contract(spark, contract)


@query
def contract_fields_table(spark, sf_dir):
    """A contract generated from data, written, read back and normalised."""
    path = inputs.scratch_path(spark, "contract")
    document = schema.generate_contract(
        inputs.transactions(spark, sf_dir), "transactions", observe_nulls=True
    )
    contracts.save_document(spark, document, path)
    frame = schema.contract_frame(spark, contracts.load_contract(spark, path))
    return frame.select(
        "position", "source", "target", "source_type", "target_type", "nullable", "comment"
    )


@query
def contract_jsonl_parse(spark, sf_dir):
    """Mappings whose limits come from the data, written and parsed line by line."""
    path = inputs.scratch_path(spark, "mappings")
    limits = inputs.table(spark, sf_dir, "events").agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.min("event_type").alias("first"),
        F.max("event_type").alias("last"),
    )

    def line(source, target, change, type_name, constraints, allowed):
        values = [source, target, change, type_name, constraints, allowed]
        names = ("source_field", "target_field", "change_type", "target_type", "constraints", "allowed_values")
        return F.struct(
            *[
                (F.lit(v).cast("string") if v is None or isinstance(v, str) else v).alias(n)
                for v, n in zip(values, names)
            ]
        )

    lines = F.array(
        line("value", "value", "type_modified", "double", F.to_json(F.struct("min", "max")), None),
        line("event_type", "kind", "renamed", None, " ", F.to_json(F.array("first", "last"))),
        line("props", "payload", None, None, "{broken", "not json"),
    )
    limits.select(F.explode(lines).alias("l")).select(F.to_json("l")).write.text(path)
    return plain(contracts.read_mapping_lines(spark, path, on_bad_rule="ignore"))


@query
def read_or_empty(spark, sf_dir):
    customer = inputs.table(spark, sf_dir, "customer")
    path = inputs.scratch_path(spark, "customer")
    writers.overwrite(customer, path)
    there = readers.read_or_empty(spark, path, customer.schema)
    nowhere = readers.read_or_empty(spark, path + "-missing", customer.schema)
    return there.unionByName(nowhere)


# --------------------------------------------------------------------- sinks


@query
def sink_overwrite_roundtrip(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part")
    path = inputs.scratch_path(spark, "part")
    writers.overwrite(part.withColumn("p_size", F.col("p_size") + 1), path)
    writers.overwrite(part, path)
    return spark.read.schema(part.schema).parquet(path)


@query
def sink_dynamic_partition(spark, sf_dir):
    """All dates are written, then the last one is replaced by corrected values."""
    events = inputs.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    path = inputs.scratch_path(spark, "events")
    writers.write_partitions(events, path, ["dt"])
    last = events.agg(F.max("dt").alias("dt"))
    fixed = events.join(last, "dt", "left_semi").withColumn("value", F.col("value") + 1)
    writers.write_partitions(fixed, path, ["dt"])
    return writers.read_layer(spark, path, events.drop("dt").schema)


@query
def sink_raw_copy(spark, sf_dir):
    customer = inputs.table(spark, sf_dir, "customer")
    path = inputs.scratch_path(spark, "raw")
    writers.write_batch(customer, path, LOAD_DATE, LOAD_HOUR)
    return writers.read_layer(spark, path, customer.schema, ("dt", "hr"))


@query
def sink_append_rejects(spark, sf_dir):
    tagged = tagged_transactions(spark, sf_dir)
    rejects = quality.rejected_rows(tagged)
    path = inputs.scratch_path(spark, "rejects")
    writers.append_rejects(rejects, path, LOAD_DATE, LOAD_HOUR)
    writers.append_rejects(rejects, path, LOAD_DATE, LOAD_HOUR)
    return plain(writers.read_layer(spark, path, rejects.schema, ("dt", "hr")))


@query
def sink_append_retry(spark, sf_dir):
    """Two batches of one hour append their rejects, one of them twice."""
    rejects = quality.rejected_rows(tagged_transactions(spark, sf_dir))
    path = inputs.scratch_path(spark, "rejects")
    for batch, parity in (("first", 0), ("second", 1), ("first", 0)):
        part = rejects.filter(F.pmod("txn_id", F.lit(2)) == parity)
        writers.append_rejects(part, path, LOAD_DATE, LOAD_HOUR, batch)
    return plain(writers.read_layer(spark, path, rejects.schema, ("dt", "hr", writers.BATCH)))


@query
def sink_overwrite_own_input(spark, sf_dir):
    """A layer replaced by rows read from it: the new one is switched in when it is whole."""
    path = inputs.scratch_path(spark, "layer")
    writers.overwrite(inputs.transactions(spark, sf_dir), path)
    layer = spark.read.parquet(path)
    writers.overwrite(layer.filter("amount >= 5000").withColumn("amount", F.col("amount") * 2), path)
    return spark.read.parquet(path)


@query
def table_two_batches_at_once(spark, sf_dir):
    """Two batches opened on one snapshot: one is merged, the other refused and run again."""
    root = inputs.scratch_path(spark, "history")
    business, batch = inputs.business(spark, sf_dir), inputs.batch(spark, sf_dir)
    late = batch.withColumn("amount", F.col("amount") + 100)

    def opened(rows, snapshot):
        table = tables.open_table(spark, root, "scd2", KEYS, snapshot, merge.history_schema(rows.schema))
        fitted = table.fitted(rows, snapshot)
        return table, merge.scd2_changes(
            fitted, table.current(merge.keys_of(fitted, KEYS)), KEYS, TRACKED, snapshot, narrowed=True
        )

    for rows, snapshot in ((business, "2025-11-12"),):
        table, changes = opened(rows, snapshot)
        table.write(changes, snapshot)
    first, second = opened(batch, "2025-11-13"), opened(late, "2025-11-14")
    first[0].write(first[1], "2025-11-13")
    try:
        second[0].write(second[1], "2025-11-14")
        raise AssertionError("both batches were merged onto one snapshot")
    except writers.StaleBatch:
        table, changes = opened(late, "2025-11-14")
        table.write(changes, "2025-11-14")
    return plain(tables.read_table(spark, root).rows())


@query
def table_folded_key_range(spark, sf_dir):
    """One key range of a folded table, whose files are clustered by key."""
    root = inputs.scratch_path(spark, "newest")
    for snapshot, rows in (("1", inputs.business(spark, sf_dir)), ("2", inputs.batch(spark, sf_dir))):
        rows = merge.open_versions(rows, "2025-11-14")
        table = tables.open_table(spark, root, "scd2", KEYS, snapshot, rows.schema)
        changes = merge.scd2_changes(
            table.fitted(rows.drop(*merge.HISTORY), snapshot), table.current(), KEYS, TRACKED, f"2025-11-1{snapshot}"
        )
        table.write(changes, snapshot)
    tables.fold(spark, root, file_bytes=64 << 10)
    keys = inputs.batch(spark, sf_dir).select(*KEYS).filter("transaction_id between 1000 and 3000")
    return plain(tables.read_table(spark, root).current(keys, {KEYS[0]: (1000, 3000)}).drop(merge.OPENED))


@query
def sink_snapshot_swap(spark, sf_dir):
    """A table rewritten from its own rows: each state is a snapshot of its own."""
    business = inputs.business(spark, sf_dir)
    root = inputs.scratch_path(spark, "business")
    for day, rows in (("2025-11-13", business), ("2025-11-14", inputs.batch(spark, sf_dir))):
        table = tables.open_table(spark, root, "whole", KEYS, day, rows.schema)
        table.write(merge.scd1_merge(table.fitted(rows, day), table.rows(), KEYS), day)
    return tables.read_table(spark, root).rows()


# ------------------------------------------------------- schema and contracts


@query
def schema_profile(spark, sf_dir):
    typed = mapping.map_columns(inputs.transactions(spark, sf_dir), typed_contract())
    return schema.schema_profile(typed, count=True)


@query
def schema_annotated(spark, sf_dir):
    return schema.schema_annotated(inputs.table(spark, sf_dir, "embeddings"), count=True)


@query
def contract_generate(spark, sf_dir):
    """The three generated documents, read back through the contract loader."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    result = None
    for dialect in ("ds", "ds_bare", "dataset"):
        path = inputs.scratch_path(spark, dialect)
        document = schema.generate_contract(lines, "lines", dialect=dialect, observe_nulls=True)
        contracts.save_document(spark, document, path)
        frame = schema.contract_frame(spark, contracts.load_contract(spark, path))
        rows = frame.select(
            F.lit(dialect).alias("dialect"),
            *["source", "target", "source_type", "target_type", "nullable", "comment"],
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def drifted_contract(**ds):
    return ds_contract(
        {"src_nm": "o_orderkey"},
        {"src_nm": "o_custkey"},
        {"src_nm": "o_clerk"},
        {"src_nm": "O_ORDERSTATUS"},
        dq_rules={"allow_extra_columns": True, "allow_missing_columns": False},
        **ds,
    )


@query
def schema_diff(spark, sf_dir):
    return schema.schema_diff(inputs.table(spark, sf_dir, "orders"), drifted_contract(), count=True)


@query
def schema_policy(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    flagged = schema.schema_policy(orders, drifted_contract())
    return flagged.select("o_orderkey", "schema_ok", "missing_columns", "extra_columns")


# ------------------------------------------------------------------- mapping


@query
def map_rename(spark, sf_dir):
    """Two columns swap names while others pass through."""
    swap = fields_contract(
        {"source_field": "l_partkey", "target_field": "l_suppkey", "change_type": "renamed"},
        {"source_field": "l_suppkey", "target_field": "l_partkey", "change_type": "renamed"},
        {"source_field": "l_quantity", "target_field": "quantity", "change_type": "renamed"},
    )
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return mapping.map_columns(lines, swap)


@query
def map_cast(spark, sf_dir):
    contract = ds_contract(
        {"src_nm": "o_orderkey", "src_dtype": "bigint", "tgt_dtype": "string"},
        {"src_nm": "o_custkey", "src_dtype": "bigint", "tgt_dtype": "int"},
        {"src_nm": "o_totalprice", "src_dtype": "double", "tgt_dtype": "decimal(12,2)"},
        {"src_nm": "o_orderdate", "src_dtype": "timestamp", "tgt_dtype": "date"},
        {"src_nm": "o_orderpriority", "src_dtype": "string", "tgt_dtype": "double"},
    )
    return plain(mapping.map_columns(inputs.table(spark, sf_dir, "orders"), contract))


@query
def map_cast_family(spark, sf_dir):
    contract = ds_contract(
        {"src_nm": "txn_id", "src_dtype": "string", "tgt_dtype": "bigint"},
        {"src_nm": "txn_day", "src_dtype": "string", "tgt_dtype": "date", "src_fmt": "dd/MM/yyyy"},
        {"src_nm": "txn_iso", "src_dtype": "string", "tgt_dtype": "date"},
        {"src_nm": "amount", "src_dtype": "string", "tgt_dtype": "decimal(12,2)"},
    )
    return plain(mapping.map_columns(inputs.text_transactions(spark, sf_dir), contract))


@query
def map_cast_lenient(spark, sf_dir):
    """An unknown type and an impossible cast both end as text."""
    contract = ds_contract(
        {"src_nm": "txn_id", "tgt_nm": "id", "tgt_dtype": "string"},
        {"src_nm": "txn_date", "tgt_nm": "day", "tgt_dtype": "int"},
        {"src_nm": "amount", "tgt_dtype": "money"},
        {"src_nm": "status", "tgt_dtype": "int"},
        {"src_nm": "absent", "tgt_dtype": "int"},
    )
    source = inputs.transactions(spark, sf_dir).drop("priority")
    return plain(mapping.lenient_mapping(source, contract).apply(source))


@query
def parse_date_format(spark, sf_dir):
    source = inputs.text_transactions(spark, sf_dir)
    parsed = source.select(
        "txn_id",
        parse_date(F.col("txn_day"), "dd/MM/yyyy").alias("by_format"),
        parse_date(F.col("txn_iso")).alias("by_default"),
    )
    return plain(parsed)


@query
def map_add_column(spark, sf_dir):
    contract = fields_contract(
        {"target_field": "reviewed_on", "target_type": "date", "change_type": "added"},
        {
            "target_field": "is_large",
            "target_type": "boolean",
            "change_type": "added",
            "expr": "o_totalprice > 250000",
        },
    )
    return plain(mapping.map_columns(inputs.table(spark, sf_dir, "orders"), contract))


@query
def map_typed_projection(spark, sf_dir):
    source = inputs.transactions(spark, sf_dir)
    return plain(mapping.map_columns(source, typed_contract(), keep_extra=False, missing="raise"))


# ------------------------------------------------------------------- quality


def _rejects(df: DataFrame, contract, **options) -> DataFrame:
    tagged = quality.tag_rows(df, quality.compile_rules(contract), **options)
    return plain(quality.rejected_rows(tagged))


@query
def dq_not_null(spark, sf_dir):
    rule = ds_contract({"src_nm": "priority", "nullable": False})
    return _rejects(inputs.transactions(spark, sf_dir), rule)


@query
def dq_not_null_nan(spark, sf_dir):
    """NaN and NULL amounts are both missing."""
    amount = (
        F.when(F.col("status") == "P", float("nan"))
        .when(F.col("priority").isNotNull(), F.col("amount"))
        .alias("amount")
    )
    source = inputs.transactions(spark, sf_dir).select("txn_id", "status", amount)
    rule = ds_contract({"src_nm": "amount", "nullable": False})
    return _rejects(source, rule).drop("amount")


@query
def dq_regex(spark, sf_dir):
    rule = ds_contract({"src_nm": "p_brand", "regex": "#1[0-9]"})
    return _rejects(inputs.table(spark, sf_dir, "part"), rule)


def _capped_transactions(spark, sf_dir) -> DataFrame:
    """Transactions that do not state amounts over 400000."""
    amount = F.when(F.col("amount") <= 400000, F.col("amount"))
    return inputs.transactions(spark, sf_dir).withColumn("amount", amount)


RANGE = {"target_field": "amount", "constraints": {"min": 5000, "max": 300000}}


@query
def dq_range(spark, sf_dir):
    return _rejects(
        _capped_transactions(spark, sf_dir), fields_contract(RANGE), null_policy="drop"
    )


@query
def dq_range_null_rejected(spark, sf_dir):
    return _rejects(_capped_transactions(spark, sf_dir), fields_contract(RANGE))


@query
def dq_range_null_passed(spark, sf_dir):
    rules = quality.compile_rules(fields_contract(RANGE))
    tagged = quality.tag_rows(_capped_transactions(spark, sf_dir), rules, null_policy="pass")
    return plain(quality.valid_rows(tagged))


@query
def dq_bound_one_sided(spark, sf_dir):
    rule = fields_contract({"target_field": "c_acctbal", "constraints": {"min": 0}})
    return _rejects(inputs.table(spark, sf_dir, "customer"), rule)


@query
def dq_allowed_values(spark, sf_dir):
    tagged = quality.tag_rows(inputs.transactions(spark, sf_dir), status_rule())
    return plain(quality.rejected_rows(tagged))


@query
def reject_first_failure(spark, sf_dir):
    return plain(quality.rejected_rows(tagged_transactions(spark, sf_dir)))


@query
def reject_all_reasons(spark, sf_dir):
    tagged = tagged_transactions(spark, sf_dir, all_reasons=True)
    return plain(quality.rejected_rows(tagged).select("txn_id", "error_reason", "error_reasons"))


@query
def valid_rows(spark, sf_dir):
    return plain(quality.valid_rows(tagged_transactions(spark, sf_dir)))


@query
def reject_untagged(spark, sf_dir):
    return plain(quality.untagged_rejects(tagged_transactions(spark, sf_dir)))


@query
def reject_empty(spark, sf_dir):
    """A batch without rejects still has a reject frame with every column."""
    rule = fields_contract({"target_field": "amount", "constraints": {"min": 0}})
    tagged = quality.tag_rows(
        inputs.transactions(spark, sf_dir), quality.compile_rules(rule)
    )
    rejects = quality.rejected_rows(tagged)
    counted = rejects.agg(F.count(F.lit(1)).alias("reject_rows"))
    names = F.array(*[F.lit(c) for c in rejects.columns])
    return counted.select(F.explode(names).alias("column_name"), "reject_rows")


@query
def reject_distinct(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity"
    )
    rule = fields_contract({"target_field": "l_returnflag", "allowed_values": ["A", "R"]})
    tagged = quality.tag_rows(lines, quality.compile_rules(rule))
    return quality.rejected_rows(tagged).dropDuplicates()


# ------------------------------------------------------ counts and gates


def _batch_rules() -> list[quality.Rule]:
    return quality.compile_rules(
        fields_contract(
            {"target_field": "status", "allowed_values": ["O", "F"]},
            {"target_field": "amount", "constraints": {"min": 5000}},
        )
    )


@query
def dq_invalid_all(spark, sf_dir):
    return gates.invalid_count(inputs.transactions(spark, sf_dir), _batch_rules(), "all")


@query
def dq_invalid_any(spark, sf_dir):
    return gates.invalid_count(inputs.transactions(spark, sf_dir), _batch_rules(), "any")


@query
def profile_nulls(spark, sf_dir):
    return profile.profile_nulls(inputs.transactions(spark, sf_dir))


@query
def profile_nulls_footers(spark, sf_dir):
    """Null counts of a written table, from its files' footers."""
    path = inputs.scratch_path(spark, "transactions")
    writers.overwrite(inputs.transactions(spark, sf_dir), path)
    return profile.profile_nulls(spark.read.parquet(path))


@query
def profile_regex(spark, sf_dir):
    patterns = {"priority": "^[12]-", "status": "[OF]"}
    return profile.profile_regex(inputs.transactions(spark, sf_dir), patterns)


@query
def rowcount_reconcile(spark, sf_dir):
    tagged = quality.tag_rows(inputs.transactions(spark, sf_dir), status_rule())
    return gates.rowcount_reconcile(tagged)


@query
def gate_valid_ratio(spark, sf_dir):
    return gates.gate_valid_ratio(tagged_transactions(spark, sf_dir))


@query
def gate_reject_pct(spark, sf_dir):
    return gates.gate_reject_pct(inputs.transactions(spark, sf_dir), _batch_rules())


@query
def gate_null_pct(spark, sf_dir):
    source = inputs.transactions(spark, sf_dir)
    return gates.gate_null_pct(source, ["txn_id", "amount", "priority"])


# -------------------------------------------------------------------- dedupe


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_partkey", "l_suppkey", "l_extendedprice"]


@query
def dedupe_latest(spark, sf_dir):
    lines = scan_parquet(spark, sf_dir)
    return dedupe.latest_per_key(lines, LINE_KEY, ["l_shipdate"], tie_breakers=LINE_TIES)


@query
def dedupe_latest_in_files(spark, sf_dir):
    """The latest line per key, found by row locators: only keys and order columns move."""
    scratch = inputs.scratch_path(spark, "losers")
    lines = scan_parquet(spark, sf_dir)
    return dedupe.latest_in_files(lines, LINE_KEY, ["l_shipdate"], scratch, tie_breakers=LINE_TIES, limit=64 << 20)


@query
def dedupe_hot_key(spark, sf_dir):
    """The latest event per type: a few keys share all rows."""
    events = inputs.table(spark, sf_dir, "events")
    return dedupe.latest_per_key(events, ["event_type"], ["ts"], tie_breakers=["event_id"])


def _partly_keyed_events(spark, sf_dir) -> DataFrame:
    anonymous = F.when(F.col("event_type") != "view", F.col("user_id"))
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", "ts", anonymous.alias("member"), "value"
    )


@query
def dedupe_null_keys_collapse(spark, sf_dir):
    events = _partly_keyed_events(spark, sf_dir)
    return dedupe.latest_per_key(events, ["member"], ["ts"], tie_breakers=["event_id"])


@query
def dedupe_null_keys_keep(spark, sf_dir):
    events = _partly_keyed_events(spark, sf_dir)
    return dedupe.latest_per_key(
        events, ["member"], ["ts"], tie_breakers=["event_id"], null_keys="keep"
    )


@query
def dedupe_missing_upd(spark, sf_dir):
    """The update column is added, so all rows tie and other columns decide."""
    orders = inputs.table(spark, sf_dir, "orders")
    dated = mapping.add_missing_update_columns(orders, ["ingest_ts"], MOMENT)
    latest = dedupe.latest_per_key(
        dated, ["o_custkey"], ["ingest_ts"], tie_breakers=["o_totalprice", "o_orderkey"]
    )
    return latest.drop("ingest_ts")


@query
def dedupe_skip(spark, sf_dir):
    return dedupe.latest_per_key(inputs.table(spark, sf_dir, "orders"), ["o_orderkey"], [])


# -------------------------------------------------------------------- merges


def _both(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return inputs.batch(spark, sf_dir), inputs.business(spark, sf_dir)


@query
def merge_left_join(spark, sf_dir):
    return merge.merge_left_join(*_both(spark, sf_dir), KEYS)


@query
def merge_updates(spark, sf_dir):
    return merge.merge_updates(*_both(spark, sf_dir), KEYS)


@query
def merge_inserts(spark, sf_dir):
    return merge.merge_inserts(*_both(spark, sf_dir), KEYS)


@query
def merge_untouched(spark, sf_dir):
    return merge.merge_untouched(*_both(spark, sf_dir), KEYS)


@query
def scd1_merge(spark, sf_dir):
    return merge.scd1_merge(*_both(spark, sf_dir), KEYS)


@query
def scd2_changed(spark, sf_dir):
    return merge.scd2_changed(
        inputs.history(spark, sf_dir), inputs.batch(spark, sf_dir), KEYS, TRACKED
    )


@query
def scd2_changed_as_read(spark, sf_dir):
    return merge.scd2_changed(
        inputs.history(spark, sf_dir), inputs.batch(spark, sf_dir), KEYS, TRACKED, mode="as_read"
    )


@query
def scd2_close_history(spark, sf_dir):
    return merge.scd2_close_history(
        inputs.history(spark, sf_dir), inputs.batch(spark, sf_dir), KEYS, TRACKED, LOAD_DATE
    )


@query
def scd2_new_versions(spark, sf_dir):
    return merge.scd2_new_versions(
        inputs.history(spark, sf_dir), inputs.batch(spark, sf_dir), KEYS, TRACKED, LOAD_DATE
    )


@query
def scd2_close_history_repeated(spark, sf_dir):
    """Every batch row twice: each changed row is closed once."""
    batch = inputs.batch(spark, sf_dir)
    doubled = batch.unionByName(batch.withColumn("amount", F.col("amount") + 5))
    return merge.scd2_close_history(
        inputs.history(spark, sf_dir), doubled, KEYS, TRACKED, LOAD_DATE, order_by=["amount"]
    )


@query
def scd2_carry_forward(spark, sf_dir):
    return merge.scd2_carry_forward(
        inputs.history(spark, sf_dir), inputs.batch(spark, sf_dir), KEYS
    )


def _scd2(spark, sf_dir, **options) -> DataFrame:
    return merge.scd2_merge(
        inputs.batch(spark, sf_dir),
        inputs.history(spark, sf_dir),
        KEYS,
        TRACKED,
        LOAD_DATE,
        **options,
    )


@query
def scd2_merge(spark, sf_dir):
    return _scd2(spark, sf_dir)


@query
def scd2_merge_shuffled(spark, sf_dir):
    return _scd2(spark, sf_dir, plan="shuffle")


@query
def scd2_merge_looked_up(spark, sf_dir):
    return _scd2(spark, sf_dir, plan="lookup")


@query
def scd2_merge_as_read(spark, sf_dir):
    return _scd2(spark, sf_dir, mode="as_read")


# --------------------------------------------------------------------- loads


def _layers(spark: SparkSession) -> Layers:
    root = inputs.scratch_path(spark, "layers")
    return Layers(
        business=f"{root}/business",
        curated=f"{root}/curated",
        raw=f"{root}/raw",
        rejects=f"{root}/rejects",
        schema_document=f"{root}/schema",
        audit=f"{root}/audit",
    )


def _stored(spark, sf_dir, *names: str) -> tuple[str, ...]:
    return tuple(inputs.stored(spark, sf_dir, name) for name in names)


def _history_of(spark, layers: Layers, result) -> DataFrame:
    return read_business(spark, layers.business).drop("ingest_ts")


@query
def layer_curated(spark, sf_dir):
    tagged = layered_tagged(inputs.transactions(spark, sf_dir), typed_contract())
    stamped = mapping.with_ingest_ts(quality.valid_rows(tagged), MOMENT)
    path = inputs.scratch_path(spark, "curated")
    writers.write_batch(stamped, path, LOAD_DATE, LOAD_HOUR)
    layer = writers.read_layer(spark, path, stamped.schema, ("dt", "hr"))
    micros = F.unix_micros("ingest_ts").alias("ingest_us")
    return plain(layer.select(*[c for c in layer.columns if c != "ingest_ts"], micros))


@query
def load_hourly(spark, sf_dir):
    """Two hourly batches into SCD2 history."""
    layers = _layers(spark)
    contract = merge_contract(min_valid_ratio=0.5)
    first, second = _stored(spark, sf_dir, "business", "batch")
    load_hourly_scd2(spark, first, contract, layers, MOMENT.replace(hour=7))
    result = load_hourly_scd2(spark, second, contract, layers, MOMENT)
    return _history_of(spark, layers, result)


@query
def load_hourly_column_gone(spark, sf_dir):
    """The second batch lacks a column of the first: old rows keep it."""
    layers = _layers(spark)
    contract = merge_contract(min_valid_ratio=0.5)
    first, second = _stored(spark, sf_dir, "business_noted", "batch")
    load_hourly_scd2(spark, first, contract, layers, MOMENT.replace(hour=7))
    return _history_of(spark, layers, load_hourly_scd2(spark, second, contract, layers, MOMENT))


@query
def load_hourly_compacted(spark, sf_dir):
    """Two hourly batches, folded into one snapshot."""
    layers = _layers(spark)
    contract = merge_contract(min_valid_ratio=0.5)
    for hour, source in zip((7, 8), _stored(spark, sf_dir, "business", "batch"), strict=True):
        result = load_hourly_scd2(spark, source, contract, layers, MOMENT.replace(hour=hour))
    compact(spark, layers.business)
    return _history_of(spark, layers, result)


@query
def load_hourly_from_lines(spark, sf_dir):
    """Two hourly batches under a contract file of one mapping a line."""
    layers = _layers(spark)
    path = inputs.scratch_path(spark, "lines")
    lines = [
        {k: json.dumps(v) if k in ("constraints", "allowed_values") else v for k, v in f.items()}
        for f in MERGE_FIELDS
    ]
    contracts.save_document(spark, lines, path)
    contract = contracts.load_contract(spark, path)
    for hour, source in zip((7, 8), _stored(spark, sf_dir, "business", "batch"), strict=True):
        moment = MOMENT.replace(hour=hour)
        result = load_hourly_scd2(spark, source, contract, layers, moment, min_valid_ratio=0.5)
    return _history_of(spark, layers, result)


@query
def load_accounts(spark, sf_dir):
    """Where the rows of a batch with repeated and missing keys go, by load."""
    (source,) = _stored(spark, sf_dir, "batch_repeated")
    hourly = load_hourly_scd2(
        spark, source, merge_contract(min_valid_ratio=0.1), _layers(spark), MOMENT, order_by=["amount"]
    ).metrics
    strict = load_strict(
        spark, line_contract(), inputs.scratch_path(spark, "strict"), MOMENT, source=scan_parquet(spark, sf_dir)
    ).metrics
    rows = [
        {
            "load": "hourly",
            "source_rows": hourly["total_rows"],
            "kept_rows": hourly["valid_rows"] - hourly["duplicate_rows"],
            "rejected_rows": hourly["rejected_rows"],
            "duplicate_rows": hourly["duplicate_rows"],
        },
        {
            "load": "strict",
            "source_rows": strict["source_count"],
            "kept_rows": strict["curated_count"],
            "rejected_rows": strict["rule_rejects"],
            "duplicate_rows": strict["duplicate_rows"],
        },
    ]
    names = "load string, source_rows long, kept_rows long, rejected_rows long, duplicate_rows long"
    return rows_frame(spark, rows, names)


@query
def load_daily(spark, sf_dir):
    """Two daily batches into SCD2 history."""
    layers = _layers(spark)
    contract = merge_contract(min_valid_ratio=0.5)
    first, second = _stored(spark, sf_dir, "business", "batch")
    load_daily_scd2(spark, first, contract, layers, MOMENT.replace(day=13))
    result = load_daily_scd2(spark, second, contract, layers, MOMENT)
    return _history_of(spark, layers, result)


@query
def load_daily_rejects(spark, sf_dir):
    """The rejects a daily load leaves in its partition."""
    layers = _layers(spark)
    contract = merge_contract(min_valid_ratio=0.5)
    (source,) = _stored(spark, sf_dir, "batch")
    load_daily_scd2(spark, source, contract, layers, MOMENT)
    tagged = layered_tagged(spark.read.parquet(source), contract)
    return writers.read_layer(spark, layers.rejects, tagged.schema)


@query
def load_overwriting(spark, sf_dir):
    """Two CSV batches into an SCD1 table."""
    layers = _layers(spark)
    contract = merge_contract(max_reject_pct=0.2, max_null_pct=0.5)
    paths = _stored(spark, sf_dir, "business_csv", "batch_csv")
    for hour, path in zip((7, 8), paths, strict=True):
        load_scd1(spark, path, contract, layers, MOMENT.replace(hour=hour))
    return read_business(spark, layers.business).drop("ingest_ts")


@query
def load_overwriting_column_gone(spark, sf_dir):
    """The second contract lacks a column of the first: rows it doesn't touch keep it."""
    layers = _layers(spark)
    limits = {"max_reject_pct": 0.2, "max_null_pct": 0.5}
    noted = merge_contract({"source_field": "note", "target_field": "note"}, **limits)
    first, second = _stored(spark, sf_dir, "business_noted", "batch")
    load_scd1(spark, first, noted, layers, MOMENT.replace(hour=7), fmt="parquet")
    load_scd1(spark, second, merge_contract(**limits), layers, MOMENT, fmt="parquet")
    return read_business(spark, layers.business).drop("ingest_ts")


def line_document() -> dict:
    return ds_document(
        {"src_nm": "l_orderkey", "tgt_nm": "order_id", "nullable": False},
        {"src_nm": "l_linenumber", "tgt_nm": "line_no", "nullable": False},
        {"src_nm": "l_returnflag", "tgt_nm": "return_flag", "regex": "[AR]"},
        {"src_nm": "l_linestatus", "tgt_nm": "line_status", "regex": "[OF]"},
        {"src_nm": "l_extendedprice", "tgt_nm": "price", "tgt_dtype": "decimal(12,2)"},
        id_cols=LINE_KEY,
        upd_cols=["l_shipdate", *LINE_TIES],
    )


def line_contract():
    return parse_contract(line_document())


def strict_lines(spark, sf_dir) -> DataFrame:
    return strict_tagged(scan_parquet(spark, sf_dir), line_contract(), MOMENT)


@query
def load_strict_curated(spark, sf_dir):
    output = inputs.scratch_path(spark, "strict")
    source = scan_parquet(spark, sf_dir)
    load_strict(spark, line_contract(), output, MOMENT, source=source)
    return plain(read_output(spark, output, "curated", strict_lines(spark, sf_dir).schema))


@query
def load_strict_from_document(spark, sf_dir):
    """A strict load under a contract document saved as a file."""
    path, output = (inputs.scratch_path(spark, label) for label in ("contract", "strict"))
    contracts.save_document(spark, line_document(), path)
    contract = contracts.load_contract(spark, path)
    load_strict(spark, contract, output, MOMENT, source=scan_parquet(spark, sf_dir))
    return plain(read_output(spark, output, "curated", strict_lines(spark, sf_dir).schema))


@query
def load_strict_rejects(spark, sf_dir):
    output = inputs.scratch_path(spark, "strict")
    source = scan_parquet(spark, sf_dir)
    load_strict(spark, line_contract(), output, MOMENT, source=source)
    return plain(read_output(spark, output, "rejects", strict_lines(spark, sf_dir).schema))


def text_contract():
    return ds_contract(
        {"src_nm": "txn_id", "src_dtype": "string", "tgt_dtype": "bigint", "nullable": False},
        {
            "src_nm": "txn_day",
            "tgt_nm": "txn_date",
            "src_dtype": "string",
            "tgt_dtype": "date",
            "src_fmt": "dd/MM/yyyy",
            "nullable": False,
        },
        {"src_nm": "amount", "src_dtype": "string", "tgt_dtype": "decimal(12,2)"},
        {"src_nm": "priority", "regex": "^[1-3]-"},
        dq_rules={"check_row_count": True, "allow_extra_columns": False},
    )


@query
def load_lenient_counts(spark, sf_dir):
    """What a lenient load measures, and how many rows it keeps."""
    output = inputs.scratch_path(spark, "lenient")
    source = inputs.text_transactions(spark, sf_dir)
    result = load_lenient(spark, text_contract(), output, MOMENT, source=source)
    kept = spark.read.parquet(output).agg(
        F.lit("kept").alias("measure"), F.count(F.lit(1)).alias("counted_rows")
    )
    found = [
        {"measure": k, "counted_rows": v} for k, v in result.metrics.items() if "check." in k
    ]
    return rows_frame(spark, found, "measure string, counted_rows bigint").union(kept)


@query
def load_lenient_rows(spark, sf_dir):
    output = inputs.scratch_path(spark, "lenient")
    source = inputs.text_transactions(spark, sf_dir)
    load_lenient(spark, text_contract(), output, MOMENT, source=source)
    return plain(spark.read.parquet(output))


def _policy_load(spark, sf_dir):
    (path,) = _stored(spark, sf_dir, "text_csv")
    curated = inputs.scratch_path(spark, "curated")
    rejects = inputs.scratch_path(spark, "rejects")
    return load_with_policy(spark, path, text_contract(), curated, rejects, MOMENT)


@query
def load_policy_curated(spark, sf_dir):
    return plain(spark.read.parquet(_policy_load(spark, sf_dir).paths["curated"]))


@query
def load_policy_rejects(spark, sf_dir):
    return plain(spark.read.parquet(_policy_load(spark, sf_dir).paths["rejects"]))


@query
def load_policy_rerun_rejects(spark, sf_dir):
    """Rejects a policy load leaves, and what a clean run leaves of them."""
    curated, rejects = (inputs.scratch_path(spark, label) for label in ("curated", "rejects"))
    (texts,) = _stored(spark, sf_dir, "text")
    clean = spark.read.parquet(texts).filter("txn_day <> 'n/a' and priority rlike '^[1-3]-'")
    counts = []
    for run, source in (("first", spark.read.parquet(texts)), ("clean", clean)):
        load_with_policy(spark, source, text_contract(), curated, rejects, MOMENT)
        left = spark.read.parquet(rejects).agg(F.count("*").alias("rejects"))
        counts.append(left.select(F.lit(run).alias("run"), "rejects").first().asDict())
    return rows_frame(spark, counts, "run string, rejects long")


@query
def run_audit_failure(spark, sf_dir):
    """The events of a daily load whose gate fails."""
    layers = _layers(spark)
    (source,) = _stored(spark, sf_dir, "batch")
    try:
        load_daily_scd2(spark, source, merge_contract(min_valid_ratio=1.0), layers, MOMENT)
    except gates.GateFailed:
        pass
    events = read_audit(spark, layers.audit)
    return events.select(
        "level", "stage", F.col("details")["rejected_rows"].alias("rejected_rows"),
        F.col("details")["traceback"].contains("GateFailed").alias("traced"),
    )


@query
def run_audit(spark, sf_dir):
    """The events of a strict load, with the counts they report."""
    root = inputs.scratch_path(spark, "audited")
    load_strict(
        spark,
        line_contract(),
        f"{root}/output",
        MOMENT,
        source=scan_parquet(spark, sf_dir),
        audit=f"{root}/audit",
    )
    details = F.col("details")
    return read_audit(spark, f"{root}/audit").select(
        "job_nm",
        "job_id",
        "level",
        "stage",
        "message",
        F.coalesce(details["row_count"], details["source_count"]).alias("source_rows"),
        F.coalesce(details["valid_rows"], details["curated_count"]).alias("curated_rows"),
        details["pct_loss"].alias("pct_loss"),
    )
