import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepact.contract import ContractError, parse_contract
from tablepact.operators import merge, schema
from tablepact.sources import contracts, readers, tables, writers
from workload import inputs


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")


def test_csv_has_a_header_and_only_text(spark, people, tmp_path, rows):
    path = f"{tmp_path}/people.csv"
    people.write.option("header", True).csv(path)
    read = readers.read_source(spark, path)
    assert read.dtypes == [("id", "string"), ("name", "string")]
    assert rows(read) == [("1", "a"), ("2", None)]
    assert rows(readers.read_source(spark, path, columns=["id", "name"])) == rows(read)
    assert rows(readers.read_source(spark, path, "CSV")) == rows(read)


def test_parquet_by_suffix_flag_and_contract(spark, people, tmp_path, rows):
    path = f"{tmp_path}/people"
    writers.overwrite(people, path)
    assert rows(readers.read_source(spark, path)) == rows(people)
    located = {"nm": "p", "format": "parquet", "src_prefix": path, "cols": []}
    contract = parse_contract({"ds": located})
    assert rows(readers.read_by_contract(spark, contract)) == rows(people)
    with pytest.raises(ContractError):
        readers.read_by_contract(spark, contract.but(source_path=None))


def test_only_a_missing_path_reads_as_empty(spark, people, tmp_path):
    assert readers.read_or_empty(spark, f"{tmp_path}/none", people.schema).count() == 0
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "part-0.parquet").write_text("not parquet at all")
    with pytest.raises(Exception, match="not a Parquet file"):
        readers.read_or_empty(spark, f"{tmp_path}/junk", people.schema).count()


@pytest.mark.parametrize("dialect", ["ds", "ds_bare", "dataset"])
def test_generated_contracts_round_trip_to_the_identity(spark, tmp_path, rows, dialect):
    df = spark.sql("select 1L id, cast(2 as decimal(10,2)) d, array(1) a, cast(null as string) s")
    document = schema.generate_contract(df, "t", dialect=dialect, observe_nulls=True)
    contracts.save_document(spark, document, f"{tmp_path}/c")
    contract = contracts.load_contract(spark, f"{tmp_path}/c")
    from tablepact.operators.mapping import map_columns

    assert rows(map_columns(df, contract)) == rows(df)
    assert [f.nullable for f in contract.fields] == [False, False, False, True]
    assert [f.target_type for f in contract.fields] == ["bigint", "decimal(10,2)", "array<int>",
                                                        "string"]


def test_ds_document_carries_the_fixed_defaults(spark):
    df = spark.sql("select cast(2 as decimal(10,2)) d, 'x' s")
    full = schema.generate_contract(df, "t", source_path="p", id_columns=["d"])["ds"]
    assert (full["ver"], full["src_prefix"], full["id_cols"]) == ("1.0", "p", ["d"])
    assert full["dq_rules"] == {
        "check_schema": True,
        "check_row_count": True,
        "allow_extra_columns": True,
        "allow_missing_columns": False,
    }
    assert [(c["precision"], c["scale"], c["regex"]) for c in full["cols"]] == [
        (10, 2, ""), ("", "", "")
    ]
    bare = schema.generate_contract(df, "t", dialect="ds_bare")["ds"]
    assert "id_cols" not in bare and bare["cols"][0]["regex"] is None
    assert bare["dq_rules"]["allow_extra_columns"] is False
    wide = schema.generate_contract(df, "t", dialect="dataset")["dataset"]
    assert [f["precision"] for f in wide["fields"]] == [10, None]
    assert wide["fields"][1]["change_type"] == "none"


def test_schema_documents(spark):
    df = spark.sql("select 1 id, array(1) a")
    assert schema.clean_schema(df.schema)["fields"][0] == {
        "name": "id",
        "type": "int",
        "nullable": False,
        "description": "Column id description",
        "source": "s3_source",
        "target": "curated_layer",
    }
    entry = schema.annotated_schema(df.schema)["fields"][1]
    assert entry["type"]["elementType"] == "integer"
    assert (entry["source"], entry["target"]) == ("a", "a")


def test_schema_diff_and_policy(spark, people, rows):
    def contract(**rules):
        cols = [{"src_nm": "id"}, {"src_nm": "NAME"}]
        return parse_contract({"ds": {"nm": "t", "cols": cols, "dq_rules": rules}})

    assert rows(schema.schema_diff(people, contract(), count=True)) == [
        ("NAME", "missing", 0), ("name", "extra", 1)
    ]
    assert rows(schema.schema_diff(people, contract())) == [("NAME", "missing"), ("name", "extra")]
    assert schema.check_schema(people, contract())[0] is False
    both = contract(allow_missing_columns=True, allow_extra_columns=True)
    assert schema.check_schema(people, both, "raise")[0] is True
    with pytest.raises(schema.SchemaMismatch):
        schema.check_schema(people, contract(allow_missing_columns=True,
                                             allow_extra_columns=False), "raise")
    same = parse_contract([{"source_field": c, "target_field": c} for c in people.columns])
    assert schema.schema_diff(people, same).collect() == []


def test_two_documents_are_not_one_contract(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(json.dumps({"fields": []}))
    with pytest.raises(ContractError):
        contracts.load_contract(spark, str(tmp_path))


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([(1, "a", "01"), (2, "b", "02")], "id int, dt string, hr string")
    writers.write_partitions(first, path, ["dt", "hr"])
    writers.write_partitions(first.filter("dt = 'b'").withColumn("id", first.id + 10), path,
                             ["dt", "hr"])
    read = writers.read_layer(spark, path, first.select("id").schema, ("dt", "hr"))
    assert rows(read) == [(1, "a", "01"), (12, "b", "02")]
    pruned = read.filter("hr = '02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hr" in pruned


def test_partitioned_writes_have_few_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "if(id % 3 = 0, 'hot', 'd' || id % 5) dt")
    writers.write_partitions(df, f"{tmp_path}/even", ["dt"])
    writers.write_partitions(df, f"{tmp_path}/as-is", ["dt"], even=False)
    files = {n: len(list((tmp_path / n).glob("*/*.parquet"))) for n in ("even", "as-is")}
    assert files["even"] <= 8 < files["as-is"]
    for name in files:
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 1000


def test_a_retried_batch_replaces_itself_even_when_empty(spark, people, tmp_path):
    path = f"{tmp_path}/rejects"
    writers.write_batch(people, path, "2025-01-01", "08")
    writers.write_batch(people, path, "2025-01-01", "09")
    writers.write_batch(people.filter("false"), path, "2025-01-01", "08")
    read = writers.read_layer(spark, path, people.schema, ("dt", "hr"))
    assert [r.hr for r in read.collect()] == ["09", "09"]
    writers.append_rejects(people, path, "2025-01-01", "09")
    assert read.sparkSession.read.parquet(path).count() == 4


def put(spark, root, layout, snapshot, df, keys=("id",)):
    table = tables.open_table(spark, root, layout, keys, snapshot, df.schema)
    table.write(table.fitted(df, snapshot), snapshot)
    return table


def test_snapshots_switch_when_finished(spark, people, tmp_path, rows):
    root = f"{tmp_path}/business"
    assert tables.read_table(spark, root) is None
    assert put(spark, root, "whole", "1", people).parts == ()
    # A crashed write leaves files but no marker; Spark's own marker doesn't matter.
    target = f"{tmp_path}/business/snapshot=2"
    people.limit(1).write.parquet(target)
    assert tables.finished(spark, root) == ["1"]
    assert tables.read_table(spark, root).rows().count() == 2
    for _ in range(2):  # the newest may be retried
        assert put(spark, root, "whole", "2", people.limit(1)).parts == ("1",)
        assert tables.read_table(spark, root).rows().count() == 1
    with pytest.raises(writers.StaleBatch):
        tables.open_table(spark, root, "whole", ["id"], "1", people.schema)
    assert tables.retire(spark, root) == ["1"] and tables.retire(spark, root) == []


def test_no_finished_snapshot_is_no_empty_table(spark, people, tmp_path):
    root = f"{tmp_path}/business"
    people.write.parquet(f"{root}/snapshot=1")
    tables.open_table(spark, root, "whole", ["id"], "1", people.schema)  # a retry of the first
    with pytest.raises(tables.BrokenTable, match="no finished"):
        tables.open_table(spark, root, "whole", ["id"], "2", people.schema)


def test_layout_and_keys_stay(spark, people, tmp_path):
    root = f"{tmp_path}/business"
    put(spark, root, "scd1", "1", people)
    for layout, keys in (("scd2", ["id"]), ("scd1", ["name"])):
        with pytest.raises(tables.BrokenTable, match="scd1"):
            tables.open_table(spark, root, layout, keys, "2", people.schema)


@pytest.mark.parametrize(
    "stored, new, both",
    [
        ("int", "bigint", "bigint"), ("bigint", "smallint", "bigint"), ("float", "double", "double"),
        ("int", "double", "double"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
        ("decimal(12,2)", "decimal(5,4)", "decimal(14,4)"), ("int", "decimal(12,2)", "decimal(12,2)"),
        ("bigint", "double", None), ("double", "decimal(12,2)", None), ("string", "int", None),
        ("bigint", "decimal(12,2)", None), ("decimal(38,0)", "decimal(10,10)", None),
    ],
)
def test_types_that_fit(stored, new, both):
    of = lambda t: StructType.fromDDL(f"c {t}")
    if both is None:
        with pytest.raises(tables.SchemaClash, match="c is"):
            tables.united(of(stored), of(new))
    else:
        assert tables.united(of(stored), of(new)) == of(both)


@pytest.mark.parametrize("stored, new", [("int", "bigint"), ("int", "double"), ("decimal(6,2)", "decimal(12,4)"), ("float", "double")])
def test_stored_rows_follow_a_wider_type(spark, tmp_path, stored, new):
    root = f"{tmp_path}/business"
    for snapshot, kind in (("1", stored), ("2", new), ("3", stored)):
        df = spark.sql(f"select {snapshot} as id, cast({snapshot} as {kind}) as v")
        put(spark, root, "scd1", snapshot, df)
    table = tables.read_table(spark, root).rows()
    assert table.schema["v"].dataType.simpleString() == new
    assert sorted((r.id, float(r.v)) for r in table.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]


@pytest.mark.parametrize("plan", ["shuffle", "lookup"])
def test_histories_hold_changes_and_fold(spark, tmp_path, rows, plan):
    root = f"{tmp_path}/history"
    schema = merge.history_schema(spark.createDataFrame([], "id int, v int").schema)
    whole = spark.createDataFrame([], schema)
    batches = [[(1, 1), (2, 2)], [(1, 5), (3, 3)], [(9, 9)], [(1, 6), (2, 7)], [(1, 8)], [(2, 7), (3, None)]]
    days = ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-03", "2025-01-03", "2025-01-06"]
    for n, (data, day) in enumerate(zip(batches, days, strict=True), start=1):
        batch = spark.createDataFrame(data, "id int, v int")
        for _ in range(2 if n in (1, 4) else 1):  # the newest batch may be retried
            table = tables.open_table(spark, root, "scd2", ["id"], f"{day}-{n}", schema)
            fitted = table.fitted(batch, f"{day}-{n}")
            changes = merge.scd2_changes(fitted, table.current(), ["id"], ["v"], day, plan=plan)
            table.write(changes, f"{day}-{n}")
        merged = merge.scd2_merge(batch, whole, ["id"], ["v"], day)
        whole = spark.createDataFrame(merged.collect(), schema)
        assert rows(tables.read_table(spark, root).rows()) == rows(whole)
        if n in (3, 5):
            assert tables.fold(spark, root) == f"{day}-{n}.fold"
            assert rows(tables.read_table(spark, root).rows()) == rows(whole)
            assert tables.fold(spark, root) is None
            with pytest.raises(writers.StaleBatch):
                tables.open_table(spark, root, "scd2", ["id"], f"{day}-{n}", schema)
    assert len(tables.retire(spark, root)) == 6
    assert rows(tables.read_table(spark, root).rows()) == rows(whole)
    last = spark.read.parquet(writers.snapshot_path(root, "2025-01-06-6"))
    assert rows(last, "id", "v", "is_current") == [(3, 3, "false"), (3, None, "true")]


def opened_batch(spark, root, snapshot, *data):
    """A batch as it stands between opening the table and writing to it."""
    batch = spark.createDataFrame(list(data), "id int, v int")
    table = tables.open_table(spark, root, "scd2", ["id"], snapshot, merge.history_schema(batch.schema))
    changes = merge.scd2_changes(table.fitted(batch, snapshot), table.current(), ["id"], ["v"], snapshot)
    return table, changes


def in_force(spark, root):
    found = tables.read_table(spark, root).rows().filter("is_current").select("id", "v").collect()
    return sorted(map(tuple, found))


def test_of_two_batches_on_one_base_one_is_finished(spark, tmp_path):
    root = f"{tmp_path}/history"
    table, changes = opened_batch(spark, root, "1", (0, 1), (1, 1))
    table.write(changes, "1")
    (first, one), (second, two) = opened_batch(spark, root, "2", (0, 8)), opened_batch(spark, root, "3", (0, 9))
    first.write(one, "2")
    with pytest.raises(writers.StaleBatch, match="3 was opened on 1, but 2 is finished"):
        second.write(two, "3")
    assert in_force(spark, root) == [(0, 8), (1, 1)]
    assert not list((tmp_path / "history").glob("snapshot=3*"))  # nothing is left behind
    again, changes = opened_batch(spark, root, "3", (0, 9))
    again.write(changes, "3")
    assert in_force(spark, root) == [(0, 9), (1, 1)]
    with pytest.raises(writers.StaleBatch):  # the first retried after the second
        opened_batch(spark, root, "2", (0, 8))
    with pytest.raises(writers.StaleBatch):
        first.write(one, "2")
    assert in_force(spark, root) == [(0, 9), (1, 1)]


def test_a_late_batch_gives_way_to_a_newer_one(spark, tmp_path):
    root = f"{tmp_path}/history"
    (late, one), (newer, two) = opened_batch(spark, root, "1", (0, 8)), opened_batch(spark, root, "2", (0, 9))
    newer.write(two, "2")
    with pytest.raises(writers.StaleBatch, match="an empty table, but 2"):
        late.write(one, "1")
    assert in_force(spark, root) == [(0, 9)]


def test_batches_that_look_at_the_same_time(spark, tmp_path, monkeypatch):
    """Both find the base as it was; the look after the marker still tells."""
    root = f"{tmp_path}/history"
    batches = [opened_batch(spark, root, s, (0, int(s))) for s in ("1", "2")]
    verify = tables.Table._verify
    looked = []

    def blind(self, snapshot):
        looked.append(snapshot)
        if looked.count(snapshot) > 1:
            verify(self, snapshot)

    monkeypatch.setattr(tables.Table, "_verify", blind)
    batches[0][0].write(batches[0][1], "1")
    with pytest.raises(writers.StaleBatch):
        batches[1][0].write(batches[1][1], "2")
    assert tables.finished(spark, root) == ["1"] and in_force(spark, root) == [(0, 1)]


def test_a_base_that_was_written_again_is_another_base(spark, tmp_path):
    root = f"{tmp_path}/history"
    table, changes = opened_batch(spark, root, "1", (0, 1))
    table.write(changes, "1")
    (later, two), (retry, one) = opened_batch(spark, root, "2", (0, 9)), opened_batch(spark, root, "1", (0, 5))
    retry.write(one, "1")
    with pytest.raises(writers.StaleBatch, match="opened on 1"):
        later.write(two, "2")
    (a, rows_a), (b, rows_b) = opened_batch(spark, root, "1", (0, 6)), opened_batch(spark, root, "1", (0, 7))
    a.write(rows_a, "1")
    with pytest.raises(writers.StaleBatch, match="another run of 1"):  # two runs of one batch
        b.write(rows_b, "1")
    assert in_force(spark, root) == [(0, 6)]


def test_a_fold_beside_a_batch(spark, tmp_path, rows):
    root = f"{tmp_path}/history"
    for snapshot, v in (("1", 1), ("2", 2)):
        table, changes = opened_batch(spark, root, snapshot, (0, v), (int(snapshot), v))
        table.write(changes, snapshot)
    batch, changes = opened_batch(spark, root, "3", (0, 3))
    assert tables.fold(spark, root) == "2.fold"
    batch.write(changes, "3")  # the fold holds what the batch was opened on
    assert in_force(spark, root) == [(0, 3), (1, 1), (2, 2)]
    assert tables.read_table(spark, root).parts == ("2.fold", "3")
    retry, changes = opened_batch(spark, root, "3", (0, 4))
    folded = tables.read_table(spark, root)
    retry.write(changes, "3")
    with pytest.raises(writers.StaleBatch):  # what was to be folded is not there any more
        folded.write(folded.stored(), "3.fold", files=1)
    assert in_force(spark, root) == [(0, 4), (1, 1), (2, 2)]


def test_narrowed_to_a_batch_the_table_reads_the_same(spark, tmp_path, rows):
    root = f"{tmp_path}/history"
    for n in range(1, 6):
        table, changes = opened_batch(spark, root, str(n), *[(i, n) for i in range(n, 30, n)])
        table.write(changes, str(n))
        table = tables.read_table(spark, root)
        for keys in ([], [4], [0, 2, 7, 29, 99]):
            only = spark.createDataFrame([(k,) for k in keys], "id int")
            bounds = {"id": (min(keys), max(keys))} if keys else None
            expected = rows(table.current().filter(F.col("id").isin(keys)))
            assert rows(table.current(only)) == rows(table.current(only, bounds)) == expected


def test_a_folded_table_is_clustered_by_key(spark, tmp_path):
    """A batch of one key range reads few of 64 files."""
    root = str(tmp_path / "history")
    schema = merge.history_schema(spark.range(1).selectExpr("id", "id as v").schema)
    keys = spark.range(0, 64_000, 1, 8).selectExpr("id", "id as v").repartition(8, "v")
    for snapshot, batch in (("1", keys), ("2", keys.filter("id % 3 = 0").selectExpr("id", "v + 1 as v"))):
        table = tables.open_table(spark, root, "scd2", ["id"], snapshot, schema)
        changes = merge.scd2_changes(table.fitted(batch, snapshot), table.current(), ["id"], ["v"], "2025-01-01")
        table.write(changes, snapshot)
    before = sum(f.stat().st_size for f in (tmp_path / "history").rglob("*.parquet"))
    assert tables.fold(spark, root, file_bytes=before // 64) == "2.fold"
    files = list((tmp_path / "history" / "snapshot=2.fold").rglob("*.parquet"))
    assert 60 <= len(files) <= 130
    table = tables.read_table(spark, root)
    assert table.rows().count() == 64_000 + 64_000 // 3 + 1
    found = table.current(spark.range(1000, 1500).select("id"), {"id": (1000, 1499)})
    assert found.count() == 500
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()

    def scanned(node) -> int:
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return scanned(node.executedPlan())
        own = node.metrics().apply("numOutputRows").value() if node.nodeName().startswith("Scan parquet") else 0
        if node.nodeName().endswith("QueryStage"):
            return scanned(node.plan())
        children = node.children()
        return own + sum(scanned(children.apply(i)) for i in range(children.size()))

    assert 500 <= scanned(plan) <= 4000  # of 64,000


def test_a_fold_sorts_bounded_rows_a_task(spark, tmp_path, monkeypatch):
    """Rows that compress to a few bytes are dealt by what they take in memory."""
    monkeypatch.setattr(tables, "SORT_BYTES", 64 << 10, raising=False)
    root = str(tmp_path / "newest")
    wide = "id", "repeat('x', 400) as text", "array(id, id) as pair", "cast(id as decimal(30, 2)) as sum"
    for snapshot, start in (("1", 0), ("2", 1000)):
        put(spark, root, "scd1", snapshot, spark.range(start, start + 2000).selectExpr(*wide))
    assert tables.fold(spark, root) == "2.fold"
    files = list((tmp_path / "newest" / "snapshot=2.fold").rglob("*.parquet"))
    assert len(files) >= 20  # 4,000 rows of over 400 bytes
    held = [spark.read.parquet(str(f)).selectExpr("count(*)", "min(id)", "max(id)").first() for f in files]
    assert max(n for n, _, _ in held) < 400
    ranges = sorted((low, high) for n, low, high in held if n)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert tables.read_table(spark, root).rows().count() == 3000


def test_newest_rows_count_and_fold(spark, tmp_path, rows):
    root = f"{tmp_path}/newest"
    for n, data in enumerate([[(1, 1), (2, 2)], [(2, 3), (3, 3)], [(2, 4)], [(1, None)]]):
        put(spark, root, "scd1", str(n), spark.createDataFrame(data, "id int, v int"))
        if n == 2:
            assert tables.fold(spark, root) == "2.fold"
    assert rows(tables.read_table(spark, root).rows()) == [(1, None), (2, 4), (3, 3)]


def test_a_small_batch_writes_little(spark, tmp_path):
    """A batch of one row in a hundred, over a table of 64 files."""
    root = tmp_path / "history"
    schema = merge.history_schema(spark.range(1).selectExpr("id", "id as v").schema)
    first = spark.range(0, 64_000, 1, 64).selectExpr("id", "id as v")
    for snapshot, batch in (("1", first), ("2", first.filter("id % 100 = 0").selectExpr("id", "v + 1 as v"))):
        table = tables.open_table(spark, str(root), "scd2", ["id"], snapshot, schema)
        changes = merge.scd2_changes(table.fitted(batch, snapshot), table.current(), ["id"], ["v"], "2025-01-01")
        table.write(changes, snapshot)
    files = {s: list((root / f"snapshot={s}").rglob("*.parquet")) for s in "12"}
    size = {s: sum(f.stat().st_size for f in files[s]) for s in "12"}
    assert len(files["2"]) <= 4 and size["2"] < 0.1 * size["1"]
    assert tables.read_table(spark, str(root)).rows().count() == 64_640


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (inputs.scratch_path(spark, "x") for _ in range(2))
    assert first.startswith(f"{shared}/tablepact/x-") and first != second


@pytest.mark.parametrize("name", ["schema_profile", "schema_annotated", "schema_diff"])
def test_schemas_are_read_without_data(spark, tmp_path, name):
    path = tmp_path / "data"
    spark.range(3).selectExpr("id", "id as v").write.parquet(str(path))
    df = spark.read.parquet(str(path))
    contract = [parse_contract([{"source_field": "id", "target_field": "id"}])] if name == "schema_diff" else []
    frame = getattr(schema, name)(df, *contract)
    assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == (1 if contract else 2)
    counted = getattr(schema, name)(df, *contract, count=True)
    assert "FileScan" in counted._jdf.queryExecution().executedPlan().toString()
    assert set(counted.columns) - set(frame.columns) in ({"null_rows"}, {"value_rows"})
