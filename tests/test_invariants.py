"""Properties that hold on any purchases, over the smallest test tables."""

import pytest
from pyspark.sql import functions as F

from prefshare.catalog.tables import LABEL_REST, LABEL_SUBSET, retail_inputs
from prefshare.operators.scores import DURATION, PRICE
from prefshare.plans.persona import persona_tall
from prefshare.plans.scores import customer_scores, indexed_scores
from tests.conftest import SF_DIR, rows_of

EVERY = [DURATION, PRICE, LABEL_SUBSET, LABEL_REST]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_shares_of_a_customer_sum_to_one(spark, limit):
    tall = persona_tall(retail_inputs(spark, SF_DIR, broadcast_limit=limit))
    sums = tall.groupBy("analytic_id").agg(
        F.sum("share").alias("shares"), F.sum("qty").alias("qty"), F.max("total").alias("total")
    )
    assert sums.where(F.abs(F.col("shares") - 1) > 1e-9).count() == 0
    assert sums.where(F.col("qty") != F.col("total")).count() == 0


def test_results_do_not_depend_on_partitions_or_joins(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    results = []
    for partitions, limit in (("1", 1 << 26), ("7", 1 << 26), ("7", 0)):
        settings(spark__sql__shuffle__partitions=partitions)
        settings(spark__sql__autoBroadcastJoinThreshold=str(10 << 20) if limit else "-1")
        inputs = retail_inputs(spark, SF_DIR, broadcast_limit=limit)
        results.append(rows_of(customer_scores(inputs, EVERY)))
    assert results[0] == results[1] == results[2]


def test_one_row_and_one_id_per_customer(spark):
    inputs = retail_inputs(spark, SF_DIR)
    scored = indexed_scores(inputs, [DURATION])
    ids = sorted(r["id"] for r in scored.select("id").collect())
    customers = inputs.transactions.select("analytic_id").na.drop().distinct().count()
    assert ids == list(range(customers))
    assert scored.select("analytic_id").distinct().count() == customers
