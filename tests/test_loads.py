import json
from dataclasses import replace
from datetime import datetime, timezone

import pytest

from tablepact.audit import audited, read_audit
from tablepact.contract import ContractError, parse_contract
from tablepact.functions.frames import empty_frame
from tablepact.operators import merge, schema
from tablepact.operators.gates import GateFailed
from tablepact.plans import (
    DuplicateKeys,
    Layers,
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
from tablepact.sources import tables, writers
from tests.test_contract import SPECIMEN

UNREPEATED = {"keyless_rows": 0, "duplicate_rows": 0}
HOURS = [datetime(2025, 11, 14, h, tzinfo=timezone.utc) for h in (6, 7, 8, 9)]


def contract(thresholds=None, extra_fields=()):
    return parse_contract(
        {
            "dataset_name": "txn",
            "thresholds": thresholds,
            "fields": [
                {"source_field": "txn_id", "target_field": "id", "target_type": "bigint",
                 "primary_key": True, "change_type": "renamed"},
                {"source_field": "amount", "target_field": "amount", "target_type": "double",
                 "constraints": {"min": 0}, "change_type": "type_modified"},
                *extra_fields,
            ],
        }
    )


def layers(root):
    names = ("business", "curated", "raw", "rejects", "schema_document", "audit")
    return Layers(**{n: f"{root}/{n}" for n in names})


def source(spark, *data):
    return spark.createDataFrame(list(data), "txn_id string, amount string, note string")


def lots(spark, bad=0, shift=0):
    good = [(str(i), str(i + shift), "n") for i in range(100 - bad)]
    return source(spark, *good, *[(str(900 + i), "-1", "n") for i in range(bad)])


def business(spark, root, mode="strict"):
    return read_business(spark, layers(root).business)


@pytest.mark.parametrize("mode", ["strict", "as_read"])
def test_hourly_load_over_three_batches(spark, tmp_path, rows, mode):
    place = layers(tmp_path)
    for hour, df in zip(HOURS, (lots(spark), lots(spark, bad=2), lots(spark, shift=1))):
        result = load_hourly_scd2(spark, df, contract(), place, hour, scd_mode=mode)
    assert result.metrics == {"total_rows": 100, "valid_rows": 100, "rejected_rows": 0} | UNREPEATED
    table = business(spark, tmp_path, mode)
    current = table.filter("is_current")
    assert current.count() == current.select("id").distinct().count() == 100
    assert table.filter("not is_current").count() == 100
    assert table.columns == ["id", "amount", "note", "ingest_ts", *merge.HISTORY]
    rejects = spark.read.parquet(f"{place.rejects}/dt=2025-11-14/hr=07")
    assert rows(rejects, "id", "error_reason") == [
        (900, "amount outside range"), (901, "amount outside range")
    ]
    raw = spark.read.parquet(f"{place.raw}/dt=2025-11-14/hr=07")
    assert rows(raw) == rows(lots(spark, bad=2))


def test_retrying_an_hour_gives_the_same_table(spark, tmp_path, rows):
    place = layers(tmp_path)
    load_hourly_scd2(spark, lots(spark), contract(), place, HOURS[0])
    once = []
    for _ in range(2):
        load_hourly_scd2(spark, lots(spark, bad=3, shift=5), contract(), place, HOURS[1])
        once.append(rows(business(spark, tmp_path)))
        rejects = spark.read.parquet(f"{place.rejects}/dt=2025-11-14/hr=07")
        assert rejects.count() == 3
    assert once[0] == once[1]
    load_hourly_scd2(spark, lots(spark), contract(), place, HOURS[1])
    assert spark.read.parquet(f"{place.rejects}/dt=2025-11-14/hr=07").count() == 0
    with pytest.raises(writers.StaleBatch):
        load_hourly_scd2(spark, lots(spark), contract(), place, HOURS[0])


@pytest.mark.parametrize("load", [load_hourly_scd2, load_daily_scd2])
def test_a_failed_gate_leaves_rejects_but_no_curated(spark, tmp_path, load):
    place = layers(tmp_path)
    with pytest.raises(GateFailed, match="valid_ratio"):
        load(spark, lots(spark, bad=6), contract(), place, HOURS[0])
    assert spark.read.parquet(place.rejects).count() == 6
    assert not (tmp_path / "curated").exists() and not (tmp_path / "business").exists()
    events = read_audit(spark, place.audit).collect()
    assert events[-1].level == "ERROR" and "GateFailed" in events[-1].details["traceback"]
    load(spark, lots(spark, bad=6), contract(), place, HOURS[1], min_valid_ratio=0.9)
    assert (tmp_path / "business").exists()


def test_an_empty_batch_fails_the_ratio_gate(spark, tmp_path):
    with pytest.raises(GateFailed):
        none = lots(spark).filter("false")
        load_daily_scd2(spark, none, contract(), layers(tmp_path), HOURS[0])


@pytest.mark.parametrize("kind", ["known", "file", "filtered"])
def test_empty_sources(spark, tmp_path, kind):
    """Counts are zero, not missing, however early Spark finds out."""
    df = source(spark, ("1", "1", "n"))
    empty = {"known": lambda: empty_frame(spark, df.schema), "filtered": lambda: df.filter("false")}
    if kind == "file":
        df.filter("amount = 'x'").write.parquet(f"{tmp_path}/none")
        no_rows = spark.read.parquet(f"{tmp_path}/none")
    else:
        no_rows = empty[kind]()
    place = layers(tmp_path)
    result = load_hourly_scd2(spark, no_rows, contract(), place, HOURS[0], min_valid_ratio=0.0)
    assert result.metrics == {"total_rows": 0, "valid_rows": 0, "rejected_rows": 0} | UNREPEATED
    assert business(spark, tmp_path).count() == 0
    result = load_scd1(spark, no_rows, contract(), layers(tmp_path / "scd1"), HOURS[0])
    assert result.metrics == {"total_rows": 0, "invalid_rows": 0, "null_values": 0} | UNREPEATED
    etl = STRICT.but(update_columns=("note",), fields=STRICT.fields[:1])
    assert load_strict(spark, etl, f"{tmp_path}/s", HOURS[0], source=no_rows).metrics[
        "pct_loss"
    ] == "0%"
    kept = load_lenient(spark, etl, f"{tmp_path}/l", HOURS[0], source=no_rows)
    assert kept.metrics["null_check.id"] == 0
    checked = load_with_policy(spark, no_rows, etl, f"{tmp_path}/p", f"{tmp_path}/q", HOURS[0])
    assert checked.metrics["total_rows"] == 0


def test_null_policies_of_a_load(spark, tmp_path):
    df = source(spark, *[(str(i), None if i < 4 else "1", "n") for i in range(100)])
    counts = {}
    for policy in ("reject", "pass", "drop"):
        place = layers(tmp_path / policy)
        result = load_daily_scd2(spark, df, contract(), place, HOURS[0], null_policy=policy)
        counts[policy] = (result.metrics["valid_rows"], result.metrics["rejected_rows"])
    assert counts == {"reject": (96, 4), "pass": (100, 0), "drop": (96, 0)}


@pytest.mark.parametrize("load", [load_hourly_scd2, load_daily_scd2])
def test_bad_casts_may_be_rejects_with_all_their_reasons(spark, tmp_path, rows, load):
    good = [(str(i), str(i), "n") for i in range(98)]
    df = source(spark, *good, ("x", "-1", "n"), ("99", "?", "n"))
    place = layers(tmp_path)
    result = load(
        spark, df, contract(), place, HOURS[0], on_cast_error="reject", all_reasons=True
    )
    assert result.metrics == {"total_rows": 100, "valid_rows": 98, "rejected_rows": 2} | UNREPEATED
    found = spark.read.parquet(place.rejects).select("error_reason", "error_reasons").collect()
    assert sorted((r.error_reason, tuple(r.error_reasons)) for r in found) == [
        ("amount not castable", ("amount not castable", "amount outside range")),
        ("id not castable", ("id not castable", "id null", "amount outside range")),
    ]
    curated = spark.read.parquet(result.paths["curated"])
    assert curated.columns == ["id", "amount", "note", "ingest_ts"]


def test_paths_are_required(spark, tmp_path):
    for missing in ("curated", "rejects", "business", "raw"):
        place = Layers(**{**layers(tmp_path).__dict__, missing: "", "audit": ""})
        with pytest.raises(ValueError, match=missing):
            load_hourly_scd2(spark, lots(spark), contract(), place, HOURS[0])


def test_the_documented_specimen_cannot_pass_its_own_rules(spark, tmp_path):
    """An added column is all NULL, and NULL is not an allowed value."""
    df = spark.createDataFrame([("1", "5.00")], "ref string, amount string")
    specimen = parse_contract(SPECIMEN)
    with pytest.raises(GateFailed, match="valid_ratio"):
        load_daily_scd2(spark, df, specimen, layers(tmp_path / "a"), HOURS[0])
    with pytest.raises(GateFailed, match="null_pct"):
        load_scd1(spark, df, specimen, layers(tmp_path / "b"), HOURS[0])
    fields = [dict(f) for f in SPECIMEN["fields"]]
    fields[-1]["expr"] = "case when amount like '-%' then 'out' else 'in' end"
    passing = parse_contract({**SPECIMEN, "fields": fields})
    result = load_daily_scd2(spark, df, passing, layers(tmp_path / "c"), HOURS[0])
    assert result.metrics["valid_rows"] == 1


def test_a_key_is_required(spark, tmp_path):
    keyless = parse_contract([{"source_field": "txn_id", "target_field": "id"}])
    for load in (load_hourly_scd2, load_daily_scd2, load_scd1):
        with pytest.raises(ContractError, match="key"):
            load(spark, lots(spark), keyless, layers(tmp_path), HOURS[0])


def test_scd1_load_over_three_batches(spark, tmp_path, rows):
    place = layers(tmp_path)
    for hour, data in zip(HOURS, ([("1", "1", "a")], [("1", "2", "a"), ("2", "5", "b")],
                                  [("3", "7", "c")])):
        path = f"{tmp_path}/in-{hour:%H}.csv"
        source(spark, *data).write.option("header", True).csv(path)
        result = load_scd1(spark, path, contract(), place, hour)
    staged = spark.read.parquet(result.paths["curated"])
    assert staged.columns == ["id", "amount", "ingest_ts"]
    table = read_business(spark, place.business)
    assert rows(table, "id", "amount") == [(1, 2.0), (2, 5.0), (3, 7.0)]
    assert spark.read.parquet(place.raw).columns == ["txn_id", "amount", "note"]


def test_scd1_gates(spark, tmp_path):
    place = layers(tmp_path)
    with pytest.raises(GateFailed, match="reject_pct"):
        load_scd1(spark, lots(spark, bad=6), contract(), place, HOURS[0])
    assert not (tmp_path / "curated").exists()
    nulls = source(spark, *[(str(i), None if i < 20 else "1", "n") for i in range(100)])
    with pytest.raises(GateFailed, match="null_pct"):
        load_scd1(spark, nulls, contract(), place, HOURS[0])
    # Both rules of a two-sided check never fail together.
    ranged = contract(
        extra_fields=[{"source_field": "note", "target_field": "note", "allowed_values": ["n"]}]
    )
    result = load_scd1(spark, lots(spark, bad=6), ranged, place, HOURS[0], combine="all")
    assert result.metrics["invalid_rows"] == 0


STRICT = parse_contract(
    {
        "ds": {
            "nm": "txn",
            "id_cols": ["txn_id"],
            "upd_cols": ["updated"],
            "cols": [
                {"src_nm": "txn_id", "tgt_nm": "id", "tgt_dtype": "bigint", "nullable": False},
                {"src_nm": "status", "tgt_nm": "status", "regex": "^(open|done)$"},
                {"src_nm": "gone", "tgt_nm": "gone"},
            ],
        }
    }
)


def test_strict_load(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("1", "open", 1), ("1", "done", 2), ("2", "odd", 1), ("x", "open", 1), ("3", None, 1)],
        "txn_id string, status string, updated int",
    )
    output = f"{tmp_path}/out"
    result = load_strict(spark, STRICT, output, HOURS[0], source=df, audit=f"{tmp_path}/audit")
    tagged = strict_tagged(df, STRICT, HOURS[0])
    curated = read_output(spark, output, "curated", tagged.schema)
    rejects = read_output(spark, output, "rejects", tagged.schema)
    assert rows(curated) == [(1, "done", 2)]
    assert rows(rejects, "id", "error_reason") == [
        (2, "status regex"), (3, "status regex"), (None, "id null")
    ]
    # "Rejected" is all that did not come out, duplicates included.
    assert result.metrics["rejected_count"] == 4 and result.metrics["pct_loss"] == "80.0%"
    assert (result.metrics["deduped_rows"], result.metrics["rule_rejects"]) == (4, 3)
    stages = {e.stage: e for e in read_audit(spark, f"{tmp_path}/audit").collect()}
    assert stages["row_count_check"].details["source_count"] == "5"
    clean = df.filter("status = 'done'")
    load_strict(spark, STRICT, output, HOURS[1], source=clean)
    assert read_output(spark, output, "rejects", tagged.schema).count() == 0


def test_strict_load_without_update_columns(spark, tmp_path):
    df = spark.createDataFrame([("1", "open"), ("1", "open")], "txn_id string, status string")
    output = f"{tmp_path}/out"
    added = load_strict(spark, STRICT, output, HOURS[0], source=df)
    assert added.metrics["deduped_rows"] == 1
    skipped = load_strict(spark, STRICT.but(update_columns=()), output, HOURS[0], source=df)
    assert skipped.metrics["deduped_rows"] == 2
    schema = strict_tagged(df, STRICT, HOURS[0]).drop("updated").schema
    assert read_output(spark, output, "curated", schema).count() == 2
    assert read_output(spark, output, "rejects", schema).count() == 0
    odd = df.withColumn("status", df.txn_id)
    load_strict(spark, STRICT.but(update_columns=()), output, HOURS[0], source=odd)
    assert read_output(spark, output, "curated", schema).count() == 0
    assert read_output(spark, output, "rejects", schema).count() == 2


def test_strict_load_reads_what_the_contract_points_at(spark, tmp_path):
    df = spark.createDataFrame([("1", "open", 1)], "txn_id string, status string, updated int")
    df.write.parquet(f"{tmp_path}/in")
    located = STRICT.but(source_path=f"{tmp_path}/in", source_format="parquet")
    assert load_strict(spark, located, f"{tmp_path}/out", HOURS[0]).metrics["curated_count"] == 1
    assert load_lenient(spark, located, f"{tmp_path}/l", HOURS[0]).metrics["curated_count"] == 1


def test_lenient_load_keeps_and_counts(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", "open"), ("x", "odd"), (None, None)],
                               "txn_id string, status string")
    result = load_lenient(spark, STRICT, f"{tmp_path}/out", HOURS[0], source=df)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [
        (1, "open"), (None, "odd"), (None, None)
    ]
    assert result.metrics["null_check.id"] == 2
    assert result.metrics["null_check.status"] == 1
    assert result.metrics["regex_check.status"] == 1
    assert result.metrics["mismatch"] is False


def test_policy_load(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("1", "open"), ("x", "odd"), ("x", "odd"), ("2", "odd")], "txn_id string, status string"
    )
    path = f"{tmp_path}/in.csv"
    df.write.option("header", True).csv(path)
    out, bad = f"{tmp_path}/out", f"{tmp_path}/bad"
    result = load_with_policy(spark, path, STRICT, out, bad, HOURS[0])
    assert result.schema_ok is False
    assert rows(spark.read.parquet(out)) == [(1, "open")]
    assert rows(spark.read.parquet(bad)) == [
        (2, "odd", "status regex"), (None, "odd", "id null")
    ]
    assert result.metrics["rejected_rows"] == 3
    with pytest.raises(schema.SchemaMismatch):
        load_with_policy(spark, path, STRICT, out, bad, HOURS[0], on_schema_fail="raise")
    load_with_policy(spark, df.limit(1), STRICT, out, bad, HOURS[0])
    assert spark.read.parquet(bad).count() == 0  # the earlier run's rejects are gone


def test_the_number_of_actions_does_not_grow_with_the_contract(spark, tmp_path, executions):
    """Spark executions per load: contract width must not matter."""
    wide_columns = [f"c{i}" for i in range(12)]
    narrow = lots(spark)
    wide = narrow.selectExpr("*", *[f"'1' as {c}" for c in wide_columns])
    narrow.write.parquet(f"{tmp_path}/narrow")
    wide.write.parquet(f"{tmp_path}/wide")
    extra = [
        {"source_field": c, "target_field": c, "target_type": "int",
         "constraints": {"min": 0, "max": 5}, "allowed_values": [1, 2]} for c in wide_columns
    ]

    def ds(columns):
        cols = [{"src_nm": c, "tgt_nm": c, "tgt_dtype": "int", "regex": "1", "nullable": False}
                for c in columns]
        return STRICT.but(
            update_columns=("note",),
            fields=parse_contract({"ds": {"nm": "t", "cols": cols}}).fields,
        )

    counts = {}
    for name, df, fields, columns in (
        ("narrow", spark.read.parquet(f"{tmp_path}/narrow"), [], ["txn_id"]),
        ("wide", spark.read.parquet(f"{tmp_path}/wide"), extra, ["txn_id", *wide_columns]),
    ):
        place = Layers(*[f"{tmp_path}/{name}/{n}" for n in ("b", "c", "r", "j")])
        root = f"{tmp_path}/{name}-etl"
        c = contract(extra_fields=fields)
        counts[name] = [
            executions(lambda: load_hourly_scd2(spark, df, c, place, HOURS[0])),
            executions(lambda: load_daily_scd2(spark, df, c, place, HOURS[1].replace(day=15))),
            executions(lambda: load_scd1(spark, df, c, Layers(f"{root}/b1", f"{root}/c1",
                                                              f"{root}/r1"), HOURS[0])),
            executions(lambda: load_strict(spark, ds(columns), f"{root}/s", HOURS[0], source=df)),
            executions(lambda: load_lenient(spark, ds(columns), f"{root}/l", HOURS[0], source=df)),
            executions(lambda: load_with_policy(spark, df, ds(columns), f"{root}/p", f"{root}/q",
                                                HOURS[0])),
        ]
    # hourly: raw, rejects, curated, business; daily: a count instead of raw;
    # SCD1: raw, staging, business; strict: count, write; lenient: write;
    # policy: one write per layer that has rows.
    assert counts["narrow"] == counts["wide"] == [4, 4, 3, 2, 1, counts["wide"][5]]
    assert counts["wide"][5] <= 2


def test_audit_of_a_failure(spark, tmp_path):
    path = f"{tmp_path}/audit"
    with pytest.raises(ZeroDivisionError):
        with audited(spark, "job", path, HOURS[0]) as log:
            log.info("stage", "about to fail", rows=3)
            raise ZeroDivisionError("oops")
    with audited(spark, "job", path, HOURS[1]):
        pass
    events = read_audit(spark, path).collect()
    assert len(events) == 5
    assert {e.job_id for e in events} == {"job_20251114_060000", "job_20251114_070000"}
    failed = [e for e in events if e.level == "ERROR"]
    assert "oops" in failed[0].message and "ZeroDivisionError" in failed[0].details["traceback"]
    assert [e.details["rows"] for e in events if e.stage == "stage"] == ["3"]


def test_columns_may_come_and_go(spark, tmp_path, rows):
    place = layers(tmp_path)
    first = source(spark, ("1", "1", "a"), ("2", "2", "b"))
    load_hourly_scd2(spark, first, contract(), place, HOURS[0])
    load_hourly_scd2(spark, first.limit(1).drop("note").selectExpr("txn_id", "'5' as amount", "7 as extra"),
                     contract(), place, HOURS[1])
    table = business(spark, tmp_path)
    assert rows(table.filter("is_current"), "id", "amount", "note", "extra") == [
        (1, 5.0, None, 7), (2, 2.0, "b", None)
    ]
    warned = read_audit(spark, place.audit).filter("level = 'WARN'").collect()
    assert [json.loads(e.details["missing"]) for e in warned] == [["note"]]


@pytest.mark.parametrize("load", [load_hourly_scd2, load_scd1])
def test_a_type_that_does_not_fit_stops_a_load_before_it_writes(spark, tmp_path, load):
    place = layers(tmp_path)
    options = {"fmt": "parquet"} if load is load_scd1 else {}
    load(spark, lots(spark), contract(), place, HOURS[0], **options)
    other = parse_contract({"dataset_name": "txn", "fields": [
        {"source_field": "txn_id", "target_field": "id", "target_type": "bigint", "primary_key": True},
        {"source_field": "amount", "target_field": "amount", "target_type": "decimal(12,2)"}]})
    before = sorted(p for p in tmp_path.rglob("*") if "audit" not in str(p))
    with pytest.raises(tables.SchemaClash, match="amount"):
        load(spark, lots(spark), other, place, HOURS[1], **options)
    with pytest.raises(writers.StaleBatch):
        load(spark, lots(spark), contract(), place, HOURS[0].replace(hour=1), **options)
    assert sorted(p for p in tmp_path.rglob("*") if "audit" not in str(p)) == before


def test_a_table_keeps_its_mode(spark, tmp_path):
    place = layers(tmp_path)
    load_hourly_scd2(spark, lots(spark), contract(), place, HOURS[0])
    with pytest.raises(tables.BrokenTable, match="scd2"):
        load_hourly_scd2(spark, lots(spark), contract(), place, HOURS[1], scd_mode="as_read")


@pytest.mark.parametrize("load", [load_hourly_scd2, load_scd1])
def test_repeated_keys_are_counted_or_refused(spark, tmp_path, rows, load):
    df = source(spark, ("1", "1", "a"), ("1", "3", "b"), ("1", "2", "c"), ("2", "5", "d"))
    with pytest.raises(DuplicateKeys, match="2 rows"):
        load(spark, df, contract(), layers(tmp_path / "a"), HOURS[0])
    with pytest.raises(tables.BrokenTable):  # nothing is there for readers, and nothing is left behind
        read_business(spark, layers(tmp_path / "a").business)
    assert list((tmp_path / "a").rglob("snapshot=*")) == []
    with pytest.raises(ValueError, match="order_by"):
        load(spark, df, contract(), layers(tmp_path / "a"), HOURS[0], duplicates="latest")
    place = layers(tmp_path / "b")
    result = load(spark, df, contract(), place, HOURS[0], order_by=["amount"])
    assert result.metrics["duplicate_rows"] == 2
    assert rows(read_business(spark, place.business), "id", "amount") == [(1, 3.0), (2, 5.0)]
    with pytest.raises(DuplicateKeys, match="2 rows"):  # a retry that is refused leaves the first try's rows
        load(spark, df, contract(), place, HOURS[0])
    assert rows(read_business(spark, place.business), "id", "amount") == [(1, 3.0), (2, 5.0)]


@pytest.mark.parametrize("load", [load_hourly_scd2, load_scd1])
def test_rows_without_a_key_stay_out(spark, tmp_path, rows, load):
    df = source(spark, *[(str(i), "1", "n") for i in range(30)], (None, "2", "n"))
    place, options = layers(tmp_path), {"fmt": "parquet"} if load is load_scd1 else {}
    for hour in HOURS[:3]:
        result = load(spark, df, contract(), place, hour, **options)
        table = read_business(spark, place.business)
        assert table.count() == 30 and table.filter("id is null").count() == 0
    if load is load_scd1:
        assert result.metrics["keyless_rows"] == 1
    else:
        assert result.metrics["rejected_rows"] == 1
        reject = spark.read.parquet(f"{place.rejects}/dt=2025-11-14/hr=08")
        assert rows(reject, "error_reason") == [("id null",)]


def test_strict_load_accounts_for_rows_without_a_key(spark, tmp_path):
    df = spark.createDataFrame([(None, "open", 1)] * 3 + [("1", "open", 1), ("1", "open", 2)],
                               "txn_id string, status string, updated int")
    kept = load_strict(spark, STRICT, f"{tmp_path}/a", HOURS[0], source=df).metrics
    assert (kept["rule_rejects"], kept["duplicate_rows"], kept["curated_count"]) == (3, 1, 1)
    folded = load_strict(spark, STRICT, f"{tmp_path}/b", HOURS[0], source=df, null_keys="collapse")
    assert (folded.metrics["rule_rejects"], folded.metrics["duplicate_rows"]) == (1, 3)


def test_ignored_rules_are_recorded(spark, tmp_path):
    broken = [{"source_field": "txn_id", "target_field": "id", "primary_key": True, "constraints": "{min: 5}"}]
    place = layers(tmp_path)
    load_daily_scd2(spark, lots(spark), parse_contract(broken, "ignore"), place, HOURS[0])
    said = read_audit(spark, place.audit).filter("stage = 'contract'").collect()
    assert len(said) == 1 and "constraints of id" in said[0].details["ignored"]


def test_an_unwritable_audit_does_not_hide_the_error(spark):
    with pytest.raises(ZeroDivisionError) as caught:
        with audited(spark, "job", "nowhere://x/audit", HOURS[0]):
            raise ZeroDivisionError("oops")
    assert "could not be written" in caught.value.__notes__[0]


NOTE = {"source_field": "note", "target_field": "note", "target_type": "string", "nullable": False}


@pytest.mark.parametrize("load", [load_hourly_scd2, load_daily_scd2])
def test_columns_that_are_not_nullable_are_mandatory(spark, tmp_path, rows, load):
    strict = contract(extra_fields=[NOTE])
    strict = strict.but(fields=tuple(replace(f, target_format="x") if f.target == "note" else f for f in strict.fields))
    df = source(spark, *[(str(i), "1", "n") for i in range(30)], ("40", "1", None))
    result = load(spark, df, strict, layers(tmp_path), HOURS[0])
    assert (result.metrics["valid_rows"], result.metrics["rejected_rows"]) == (30, 1)
    reject = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/rejects")
    assert rows(reject, "id", "error_reason") == [(40, "note null")]
    assert read_business(spark, f"{tmp_path}/business").filter("note is null").count() == 0
    events = read_audit(spark, f"{tmp_path}/audit").filter("message = 'Target formats are not enforced'")
    assert events.count() == 1


def test_a_load_that_only_gates_says_which_columns_should_have_no_nulls(spark, tmp_path):
    strict = contract(extra_fields=[NOTE])
    df = source(spark, *[(str(i), "1", "n" if i else None) for i in range(30)])
    assert load_scd1(spark, df, strict, layers(tmp_path), HOURS[0]).metrics["invalid_rows"] == 0
    events = read_audit(spark, f"{tmp_path}/audit").filter("message like 'Not-null columns%'")
    assert events.count() == 1
    kinds = ["not_null", "range"]
    assert load_scd1(spark, df, strict, layers(tmp_path), HOURS[1], kinds=kinds).metrics["invalid_rows"] == 1
