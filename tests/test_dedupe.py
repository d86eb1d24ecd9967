from tablepact.operators.dedupe import latest_per_key


def test_null_order_values_sort_last(spark, rows):
    df = spark.createDataFrame(
        [(1, None, "old"), (1, 5, "new"), (2, None, "only")], "k int, u int, v string"
    )
    assert rows(latest_per_key(df, ["k"], ["u"])) == [(1, 5, "new"), (2, None, "only")]


def test_null_keys_collapse_or_stay(spark, rows):
    df = spark.createDataFrame(
        [(None, 1, 1), (None, 1, 2), (3, None, 3), (3, None, 4), (3, 4, 5), (3, 4, 6)],
        "a int, b int, u int",
    )
    collapsed = latest_per_key(df, ["a", "b"], ["u"])
    assert rows(collapsed, "u") == [(2,), (4,), (6,)]
    kept = latest_per_key(df, ["a", "b"], ["u"], null_keys="keep")
    assert rows(kept, "u") == [(1,), (2,), (3,), (4,), (6,)]


def test_ties_do_not_depend_on_row_order(spark, rows):
    data = [(k, 0, f"v{i}", None if i % 3 else i) for k in range(20) for i in range(9)]
    schema = "k int, u int, v string, n int"
    results = []
    for order in (data, data[::-1], sorted(data, key=lambda r: r[2])):
        df = spark.createDataFrame(order, schema).repartition(5)
        results.append(rows(latest_per_key(df, ["k"], ["u"])))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 20


def test_no_keys_or_no_order_changes_nothing(spark):
    df = spark.range(3)
    assert latest_per_key(df, [], ["id"]) is df
    assert latest_per_key(df, ["id"], []) is df


def test_map_columns_are_carried(spark):
    data = [(1, 1, {"a": 1}), (1, 2, {"a": 2})]
    df = spark.createDataFrame(data, "k int, u int, m map<string,int>")
    assert latest_per_key(df, ["k"], ["u"]).first().m == {"a": 2}


def test_fractional_keys_come_out_as_they_were(spark, rows):
    df = spark.createDataFrame([(-0.0, 1), (-0.0, 2), (1.5, 3)], "k double, u int")
    assert [str(r.k) for r in latest_per_key(df, ["k"], ["u"]).orderBy("u").collect()] == [
        "-0.0", "1.5"
    ]


def test_only_key_columns(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a int, b int")
    assert rows(latest_per_key(df, ["a", "b"], ["b"])) == [(1, 2), (None, 2)]


def test_order_columns_count_from_left_to_right(spark, rows):
    df = spark.createDataFrame([(1, 1, 9, "a"), (1, 2, 1, "b"), (1, 2, 3, "c")],
                               "k int, x int, y int, v string")
    assert rows(latest_per_key(df, ["k"], ["x", "y"]), "v") == [("c",)]
    assert rows(latest_per_key(df, ["k"], ["y"]), "v") == [("a",)]
    assert rows(latest_per_key(df, ["k"], ["x"], tie_breakers=["y"]), "v") == [("c",)]


def test_duplicate_rows_leave_one(spark):
    df = spark.createDataFrame([(1, 1)] * 50, "k int, u int").repartition(7)
    assert latest_per_key(df, ["k"], ["u"]).count() == 1
