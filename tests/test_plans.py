"""Physical plans: what is read, what is shuffled, and what never happens."""

import re

import pytest

from tablepact.operators import merge, quality
from tablepact.operators.dedupe import latest_per_key
from tablepact.sources import tables
from workload import inputs, queries

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "#N", text)


@pytest.fixture
def shuffled(spark):
    """Joins planned as for tables too big to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_mapping_reads_only_the_columns_it_needs(spark):
    df = queries.map_typed_projection(spark, SF).select("transaction_id", "amount")
    plan = plan_of(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "Exchange" not in plan


def test_valid_rows_filter_reaches_the_scan(spark):
    orders = inputs.table(spark, SF, "orders")
    rules = [quality.Rule("o_orderkey", "not_null", "o_orderkey null")]
    plan = plan_of(quality.valid_rows(quality.tag_rows(orders, rules)).select("o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_tagging_is_one_narrow_pass(spark):
    plan = plan_of(queries.tagged_transactions(spark, SF, all_reasons=True))
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "Python" not in plan
    # Everything above the scan is one generated function.
    assert set(re.findall(r"\*\((\d+)\)", plan)) <= {"1"}


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    lines = inputs.table(spark, SF, "lineitem")
    plan = plan_of(latest_per_key(lines, ["l_returnflag"], ["l_shipdate"]))
    partial = plan.index("partial_max")
    assert plan.index("Exchange hashpartitioning") < partial < plan.index("FileScan")
    assert plan.count("Exchange") == 1
    # Sorted by key alone, on either side of the shuffle.
    assert set(re.findall(r"Sort \[([^\]]*)\]", plan)) == {"l_returnflag#N ASC NULLS FIRST"}


def test_small_batches_leave_the_business_table_unshuffled(spark):
    merged = queries._scd2(spark, SF, plan="lookup")
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    # New keys are found by a scan of the business keys alone.
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_big_batches_shuffle_each_table_once(shuffled):
    merged = merge.scd2_apply(
        inputs.batch(shuffled, SF),
        merge.current_rows(inputs.history(shuffled, SF)),
        queries.KEYS,
        queries.TRACKED,
        "2025-11-14",
    )
    plan = plan_of(merged)
    assert "FullOuter" in plan and "Broadcast" not in plan
    # One exchange per table: the batch's dedupe and the join share theirs.
    assert plan.count("Exchange hashpartitioning") == 2


def test_anti_joins_ship_only_keys(shuffled):
    plan = plan_of(queries.merge_untouched(shuffled, SF))
    assert "LeftAnti" in plan and "Cartesian" not in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "o_orderkey:bigint,o_orderpriority:string" in scans


def test_no_query_crosses_tables_or_runs_python(spark):
    written = {"contract", "load", "sink", "scan_csv", "scan_by", "run", "layer", "read"}
    for name, query in queries.QUERIES.items():
        if any(name.startswith(w) for w in written):
            continue
        plan = plan_of(query(spark, SF))
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name
        assert "Python" not in plan and "Scan ExistingRDD" not in plan, name


def _nodes(node):
    """The physical operators that ran, from the top, query stages opened."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        yield from _nodes(node.executedPlan())
        return
    yield node
    if name.endswith("QueryStage"):
        yield from _nodes(node.plan())
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _paths(node, above=()):
    """(operators above, scan) of each scan that ran."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        yield from _paths(node.executedPlan(), above)
    elif name.startswith("Scan"):
        yield above, node
    else:
        above = (*above, node)
        if name.endswith("QueryStage"):
            yield from _paths(node.plan(), above)
        children = node.children()
        for i in range(children.size()):
            yield from _paths(children.apply(i), above)


def _of(scan) -> str:
    """Where a scan reads from, in full however long the path."""
    locations = scan.relation().location().rootPaths()
    return " ".join(locations.apply(i).toString() for i in range(locations.size()))


def _ran(df, *paths: str) -> dict[str, int]:
    """Scans of each path, and shuffles, of the plan that ran."""
    df.collect()
    nodes = list(_nodes(df._jdf.queryExecution().executedPlan()))
    scans = [_of(n) for n in nodes if n.nodeName().startswith("Scan parquet")]
    # a query stage shows its exchange too
    shuffles = sum(n.nodeName() == "Exchange" for n in nodes)
    return {p: sum(s.endswith(p) for s in scans) for p in paths} | {"shuffles": shuffles}


def test_changes_scan_the_table_once(shuffled, tmp_path):
    """Even if nothing is broadcast: the batch's keys and rows, and the table, move once each."""
    spark, batch, table = shuffled, f"{tmp_path}/batch", f"{tmp_path}/table"
    spark.range(50).selectExpr("id", "id as v").write.parquet(batch)
    rows = spark.range(900).selectExpr("id", "id + 1 as v")
    merge.open_versions(rows, "2025-01-01").write.parquet(table)
    counts = {}
    for plan in ("lookup", "shuffle"):
        changes = merge.scd2_changes(
            spark.read.parquet(batch), spark.read.parquet(table), ["id"], ["v"], "2025-01-02", plan=plan
        )
        counts[plan] = _ran(changes, batch, table)
        assert changes.count() == 100
    assert counts["shuffle"] == {batch: 2, table: 1, "shuffles": 2}
    assert counts["lookup"] == {batch: 3, table: 1, "shuffles": 3}
    business = spark.read.parquet(table).select("id", "v")
    merged = merge.scd1_merge(spark.read.parquet(batch), business, ["id"])
    assert _ran(merged, batch, table)["shuffles"] <= 3


def test_small_batches_change_the_table_where_it_lies(spark, tmp_path):
    batch, table = f"{tmp_path}/batch", f"{tmp_path}/table"
    spark.range(50).selectExpr("id", "id as v").write.parquet(batch)
    merge.open_versions(spark.range(900).selectExpr("id", "id + 1 as v"), "2025-01-01").write.parquet(table)
    changes = merge.scd2_changes(
        spark.read.parquet(batch), spark.read.parquet(table), ["id"], ["v"], "2025-01-02"
    )
    # the one shuffle is that of the batch's own keys
    assert _ran(changes, table) == {table: 1, "shuffles": 1}


def _history(spark, root: str, batches: int) -> tables.Table:
    """A table of several parts, each batch of which closed versions of the one before."""
    schema = merge.history_schema(spark.range(1).selectExpr("id", "id as v").schema)
    for n in range(batches):
        rows = spark.range(0, 20_000, 1, 4).selectExpr("id", f"id + {n} as v")
        table = tables.open_table(spark, root, "scd2", ["id"], str(n), schema)
        changes = merge.scd2_changes(table.fitted(rows, str(n)), table.current(), ["id"], ["v"], "2025-01-01", unique=True)
        table.write(changes, str(n))
    return tables.open_table(spark, root, "scd2", ["id"], str(batches), schema)


def test_small_batches_leave_a_table_of_parts_where_it_lies(spark, tmp_path):
    """However many versions are closed: open rows meet the batch's keys before anything moves."""
    root, batch = f"{tmp_path}/history", f"{tmp_path}/batch"
    table = _history(spark, root, 3)
    spark.range(50).selectExpr("id", "-id as v").write.parquet(batch)
    rows = spark.read.parquet(batch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # the batch, not the closed versions
    try:
        changes = merge.scd2_changes(
            table.fitted(rows, "3"), table.current(merge.keys_of(rows, ["id"])), ["id"], ["v"],
            "2025-01-02", plan="lookup", unique=True, narrowed=True,
        )
        assert changes.count() == 100
        changes.collect()
        plan = changes._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    seen = 0
    for above, scan in _paths(plan):
        if "is_current=" not in _of(scan):
            continue
        seen += 1
        names = [n.simpleString(100) for n in reversed(above)]
        moved = next((i for i, n in enumerate(names) if n.startswith("Exchange")), len(names))
        assert any(n.startswith("BroadcastHashJoin") and "LeftSemi" in n for n in names[:moved]), names
    assert seen == 2  # open rows, closed versions


def test_big_batches_shuffle_a_table_of_parts_once(shuffled, tmp_path):
    root = f"{tmp_path}/history"
    table = _history(shuffled, root, 3)
    rows = shuffled.range(0, 30_000).selectExpr("id", "-id as v")
    rows.write.parquet(f"{tmp_path}/batch")
    rows = shuffled.read.parquet(f"{tmp_path}/batch")
    changes = merge.scd2_changes(
        table.fitted(rows, "3"), table.current(keyed=True), ["id"], ["v"], "2025-01-02", plan="shuffle", unique=True
    )
    assert changes.count() == 50_000
    # closed versions, open rows, the batch: each once, all by the key alone
    assert _ran(changes)["shuffles"] == 3
