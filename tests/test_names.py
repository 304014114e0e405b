from tests.samples import sample_inputs

from prefshare.operators.dedupe import first_per_key
from prefshare.operators.names import bought_packages, name_bridge, name_transactions
from tests.conftest import rows_of


def test_first_row_is_the_smallest_with_nulls_last(spark):
    rows = [("k", None, "n"), ("k", 2, "b"), ("k", 2, "a"), (None, 5, "x")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert rows_of(first_per_key(df, ["k"], ["o"])) == [("k", 2, "a"), (None, 5, "x")]


def test_ties_prefer_known_values(spark):
    rows = [("k", 1, None, "x"), ("k", 1, "a", None), ("k", 1, "a", "z")]
    df = spark.createDataFrame(rows, "k string, o int, `v w` string, u string")
    assert rows_of(first_per_key(df, ["k"], ["o"])) == [("k", 1, "a", "z")]


def test_first_row_does_not_depend_on_input_order(spark):
    rows = [(i % 7, i, str(i)) for i in range(200)]
    one = spark.createDataFrame(rows, "k int, o int, v string").repartition(1)
    many = spark.createDataFrame(rows[::-1], "k int, o int, v string").repartition(9)
    assert rows_of(first_per_key(one, ["k"], ["o"])) == rows_of(
        first_per_key(many, ["k"], ["o"])
    )


def test_bridge_keeps_old_names_without_current_name(spark):
    inputs = sample_inputs(spark)
    assert rows_of(name_bridge(inputs.old_tariff, inputs.new_tariff)) == [
        ("old A", "p1", "A"),
        ("old B", "p2", "B B"),
        ("old D", "p4", "D"),
        ("old Z", "p9", None),
    ]


def test_repeated_code_counts_twice(spark):
    inputs = sample_inputs(
        spark,
        purchases=[("c", "p1", 2.0), ("c", "p2", 1.0)],
        new_tariff=[("p1", "A"), ("p1", "A"), ("p2", "B")],
    )
    named = name_transactions(inputs.transactions, inputs.new_tariff)
    assert rows_of(named) == [("c", "A", 2.0), ("c", "A", 2.0), ("c", "B", 1.0)]


def test_unnamed_purchases_are_dropped(spark):
    inputs = sample_inputs(spark, purchases=[("c", "p5", 1.0), ("c", "gone", 1.0)])
    assert rows_of(name_transactions(inputs.transactions, inputs.new_tariff)) == []


def test_bought_packages_include_those_of_nobody(spark):
    inputs = sample_inputs(spark, purchases=[(None, "p4", 1.0), ("c", "p1", 1.0)])
    assert rows_of(bought_packages(inputs.transactions, inputs.new_tariff)) == [
        ("A",),
        ("D",),
    ]
