"""The plans are the ones meant for large inputs."""

import re

import pytest
from tests.conftest import SF_DIR, plan_of, rows_of
from tests.samples import sample_inputs

from prefshare.catalog.queries import range_union, sparse_matmul
from prefshare.catalog.tables import SCHEMAS, purchases, purchases_by_year, retail_inputs
from prefshare.operators.scores import DURATION, PRICE, QUOTA, SPEED
from prefshare.plans import jobs, persona
from prefshare.plans.persona import (
    customer_persona,
    persona_quantities_wide,
    persona_shares_wide,
    persona_tall,
)
from prefshare.plans.preferences import package_preferences
from prefshare.plans.scores import customer_scores
from prefshare.plans.session import listed_bytes, settings_for
from prefshare.sources import scratch


def shuffles(plan: str) -> list[str]:
    return re.findall(r"Arguments: (hashpartitioning\([^)]*\)|SinglePartition)", plan)


def on_customer(plan: str) -> list[str]:
    return [s for s in shuffles(plan) if "analytic_id" in s]


@pytest.fixture
def no_auto_broadcast(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")


def test_scores_shuffle_purchases_once(spark, no_auto_broadcast):
    plan = plan_of(customer_scores(sample_inputs(spark), [DURATION, PRICE, QUOTA, SPEED]))
    assert len(on_customer(plan)) == 1
    assert "SortMergeJoin" not in plan
    assert plan.count("partial_sum") >= 1


def test_small_packages_are_broadcast_only_when_measured(spark, no_auto_broadcast):
    small = plan_of(customer_scores(sample_inputs(spark), [DURATION]))
    large = plan_of(customer_scores(sample_inputs(spark, broadcast_limit=0), [DURATION]))
    assert "BroadcastHashJoin" in small
    assert "Broadcast" not in large and "SortMergeJoin" in large


def test_shares_use_a_window_only_for_few_packages(spark, no_auto_broadcast):
    few = plan_of(persona_tall(sample_inputs(spark)))
    many = plan_of(persona_tall(sample_inputs(spark, broadcast_limit=0)))
    assert "Window" in few
    assert "Window" not in many
    for plan in (few, many):
        assert "SinglePartition" not in plan


def test_wide_tables_shuffle_tall_rows_not_wide_ones(spark, no_auto_broadcast):
    for build in (persona_quantities_wide, persona_shares_wide):
        plan = plan_of(build(sample_inputs(spark), ["A", "B B"]))
        # Once per customer and package, once per customer.
        assert len(on_customer(plan)) == 2
        assert not [s for s in shuffles(plan) if "pivot" in s.lower()]


def test_wide_tables_hold_a_row_for_each_customer(spark, no_auto_broadcast):
    """Neither a sort nor an aggregate holds a row for each customer and package."""
    inputs = sample_inputs(spark)
    for wide in (customer_persona(inputs), persona_shares_wide(inputs, ["A", "B B"])):
        plan = plan_of(wide)
        assert "pivot" not in plan.lower() and "Sort" not in plan and "Window" not in plan


def test_persona_ids_meet_tall_rows(spark, no_auto_broadcast):
    plan = plan_of(customer_persona(sample_inputs(spark)))
    # The staged quantities and the numbered customers, both by customer.
    assert len(on_customer(plan)) == 2
    assert "rangepartitioning" not in plan


def test_bought_packages_do_not_read_the_orders(spark):
    inputs = retail_inputs(spark, SF_DIR)
    plan = plan_of(package_preferences(inputs))
    assert "o_custkey" not in plan and "orders.parquet" not in plan


def test_line_items_meet_their_orders_unsorted(spark, tmp_path, settings):
    """Tables of any size; what a task holds are its orders, with their repeated keys."""
    for limit in ("-1", "10MB"):
        settings(spark__sql__autoBroadcastJoinThreshold=limit)
        for build in (purchases, purchases_by_year):
            plan = plan_of(build(spark, SF_DIR))
            assert "ShuffledHashJoin LeftOuter BuildRight" in plan and "Sort" not in plan
    orders = [(1, 10, None), (1, 11, None), (2, None, None), (None, 12, None)]
    lines = [(1, 5, 2.0), (1, 5, 2.0), (2, 6, None), (None, 7, 1.0), (3, None, 4.0)]
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    want = [(10, 5, 2.0)] * 2 + [(11, 5, 2.0)] * 2 + [(None, 6, None), (None, 7, 1.0), (None, None, 4.0)]
    assert rows_of(purchases(spark, str(tmp_path))) == sorted(want, key=repr)


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(purchases(spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_only_the_partition_count_grows_with_the_shuffle():
    assert settings_for(0)["spark.sql.shuffle.partitions"] == "8"
    assert settings_for(2**40)["spark.sql.shuffle.partitions"] == "8192"
    large = settings_for(100 * 10**12)
    assert large["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // 2**27))
    for name in ("files.maxPartitionBytes", "adaptive.advisoryPartitionSizeInBytes"):
        assert large[f"spark.sql.{name}"] == str(2**27)


def test_the_shuffle_is_as_large_as_the_listed_files(spark, tmp_path):
    for name, size in (("a", 1_000), ("b", 234)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_bytes(b"x" * size)
    paths = [str(tmp_path / "a"), str(tmp_path / "b" / "part")]
    assert listed_bytes(spark, paths) == 1_234


def test_long_labels_of_many_codes_are_not_broadcast(spark, no_auto_broadcast):
    """The masters are small, but each code repeats its package's long label."""
    inputs = sample_inputs(
        spark,
        new_tariff=[(f"p{i}", "A") for i in range(400)],
        old_tariff=[("p1", "old A")],
        attributes=[("old A", 3.0, 6.0, "x" * 2_000)],
        broadcast_limit=60_000,
    )
    assert inputs.few_packages
    plan = plan_of(customer_scores(inputs, [DURATION]))
    assert "SortMergeJoin" in plan


def test_purchases_are_read_once(spark, tmp_path, monkeypatch):
    """Each product stages the quantities and takes the rest from them."""
    staged = []
    written = scratch.stage

    def counting(df, label):
        staged.append(plan_of(df))
        return written(df, label)

    monkeypatch.setattr(persona, "stage", counting)
    monkeypatch.setattr(jobs, "stage", counting)
    inputs = retail_inputs(spark, SF_DIR)
    last = plan_of(customer_persona(inputs))
    assert [p.count("lineitem.parquet") for p in staged] == [1]
    assert "lineitem.parquet" not in last
    staged.clear()
    jobs.preprocess(inputs, str(tmp_path / "out"))
    assert sum(p.count("lineitem.parquet") for p in staged) == 1


def test_ranges_are_put_together_in_one_pass(spark):
    plan = plan_of(range_union(spark, SF_DIR))
    # The staged index, and its sizes per part.
    assert plan.count("Scan parquet") <= 4 and "Union" not in plan


def test_the_product_shuffles_purchases_once(spark, no_auto_broadcast):
    plan = plan_of(sparse_matmul(spark, SF_DIR))
    keys = [s for s in shuffles(plan) if "row" in s or "analytic" in s or "o_custkey" in s]
    assert len(keys) == 1
