import random

import pytest

from prefshare.operators.index import dense_index, package_index
from prefshare.operators.ranges import id_between, id_from, union_ranges
from prefshare.operators.persona import customer_totals
from prefshare.plans.persona import customer_persona, named_purchases
from prefshare.sources.writers import preview
from tests.conftest import plan_of, rows_of
from tests.samples import sample_inputs


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_index_is_dense_and_in_key_order(spark, settings, partitions):
    settings(
        spark__sql__shuffle__partitions=partitions,
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    keys = random.Random(3).sample(range(100_000), 1_000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string")
    got = [tuple(r) for r in dense_index(df.repartition(5), "k").orderBy("id").collect()]
    assert got == [(i, k, f"v{k}") for i, k in enumerate(sorted(keys))]


def test_index_of_text_keys(spark):
    keys = [f"{i:x}" for i in range(0, 3_000, 7)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [tuple(r) for r in dense_index(df, "k").orderBy("id").collect()]
    assert got == list(enumerate(sorted(keys)))


def test_index_keeps_columns_of_clashing_names(spark):
    df = spark.createDataFrame([("b", 1, 2, 3), ("a", 4, 5, 6)], "k string, _First int, `__first` int, rows int")
    assert rows_of(dense_index(df, "k")) == [(0, "a", 4, 5, 6), (1, "b", 1, 2, 3)]


def test_index_of_nothing(spark):
    assert dense_index(spark.range(0).toDF("k"), "k").collect() == []


def test_index_is_read_back_not_recomputed(spark):
    plan = plan_of(dense_index(spark.range(50).toDF("k"), "k"))
    assert "Scan parquet" in plan and "rangepartitioning" not in plan


def test_package_index_agrees_with_the_distributed_one(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c c",)], "package string")
    small = rows_of(package_index(df, "package"))
    assert small == [(0, "a"), (1, "b"), (2, "c c")]
    assert rows_of(package_index(df, "package", few=False)) == small


def test_nobody_has_no_id(spark):
    """The index, the count and the persona's ids agree where purchases have no
    customer."""
    inputs = sample_inputs(spark)
    named = named_purchases(inputs)
    totals = customer_totals(named)
    index = dense_index(totals.select("analytic_id"), "analytic_id")
    ids = rows_of(index)
    assert ids == [(0, "c1"), (1, "c2"), (2, "c3"), (3, "c4")]
    assert totals.count() == 4
    assert rows_of(customer_persona(inputs).select("id", "analytic_id")) == ids
    assert rows_of(preview(index, rows=2)) == ids[:2]
    assert rows_of(union_ranges(index, [0, 2])) == ids
    assert rows_of(id_between(index, 1, None)) == ids[1:]


def test_ranges(spark):
    df = spark.range(10)
    assert rows_of(id_between(df, 2, 4)) == [(2,), (3,), (4,)]
    assert rows_of(id_from(df, 8)) == [(8,), (9,)]
    assert rows_of(union_ranges(df, [0, 3, 7])) == rows_of(df)
    with pytest.raises(ValueError):
        union_ranges(df, [3, 0])
