import random
from collections import defaultdict

import pytest
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import IndexedRow, IndexedRowMatrix
from pyspark.sql import functions as F
from tests.samples import sample_inputs

from prefshare.operators.matrix import tall_product, to_tall, to_wide
from prefshare.operators.scores import DURATION, PRICE, QUOTA, SPEED, project_scores
from prefshare.plans.persona import customer_persona, customer_persona_tall
from prefshare.plans.preferences import package_preferences
from prefshare.plans.scores import customer_scores, indexed_scores, raw_range_scores
from tests.conftest import rows_of


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_duration_score(spark, limit):
    scores = customer_scores(sample_inputs(spark, broadcast_limit=limit), [DURATION])
    assert scores.columns == ["analytic_id", *DURATION.columns]
    assert rows_of(scores) == [
        ("c1", 0.0, 0.2, 0.0, 0.0, 0.3),
        ("c2", None, None, None, None, None),
        ("c3", 0.0, 0.0, 0.0, 0.0, 0.0),
        ("c4", 0.0, 1.0, 0.0, 0.0, 0.0),
    ]


def test_all_scores_in_one_pass_equal_each_alone(spark):
    inputs = sample_inputs(spark)
    every = [DURATION, PRICE, QUOTA, SPEED]
    together = customer_scores(inputs, every)
    for score in every:
        alone = customer_scores(inputs, [score])
        assert rows_of(together.select("analytic_id", *score.columns)) == rows_of(alone)
    assert len(QUOTA.columns) == 8 and len(SPEED.columns) == 9


def test_duration_gap_scores_in_no_bucket(spark):
    inputs = sample_inputs(spark, purchases=[("c", "p4", 5.0)])
    assert rows_of(customer_scores(inputs, [DURATION])) == [("c", 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_bucket_shares_sum_to_at_most_one(spark):
    scored = customer_scores(sample_inputs(spark), [PRICE]).na.drop()
    total = sum(F.col(c) for c in PRICE.columns)
    assert scored.where(total > 1 + 1e-12).count() == 0


def test_ids_follow_the_customers(spark):
    rows = rows_of(indexed_scores(sample_inputs(spark), [DURATION]))
    assert [r[:2] for r in rows] == [(0, "c1"), (1, "c2"), (2, "c3"), (3, "c4")]


def test_raw_counts_of_an_id_range(spark):
    inputs = sample_inputs(spark)
    assert [r[1] for r in rows_of(raw_range_scores(inputs))] == ["c1", "c2", "c3", "c4"]
    assert rows_of(raw_range_scores(inputs, id_range=(None, 1))) == [
        (0, "c1", 0.0, 2.0, 0.0, 0.0, 3.0),
        (1, "c2", 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    without = raw_range_scores(inputs, id_range=(0, 9), excluded=["A"])
    assert rows_of(without)[0] == (0, "c1", 0.0, 0.0, 0.0, 0.0, 3.0)
    assert without.count() == 4


def test_wide_tables_score_like_the_purchases(spark):
    inputs = sample_inputs(spark)
    every = [DURATION, PRICE, QUOTA, SPEED]
    flags = package_preferences(inputs, with_name=True)
    projected = project_scores(
        # Packages are found by name, in any order.
        customer_persona(inputs).select("id", "analytic_id", "`B B`", "A"),
        flags,
        ["id", "analytic_id"],
        every,
    )
    want = rows_of(indexed_scores(inputs, every))
    for have, row in zip(rows_of(projected), want, strict=True):
        assert have[1:2] == row[1:2]
        assert have == pytest.approx(row, abs=1e-12)


def test_wide_tables_must_match(spark):
    inputs = sample_inputs(spark)
    flags = package_preferences(inputs, with_name=True)
    persona = customer_persona(inputs)
    # A package less, and as many packages of another run.
    for other in (persona.drop("A"), persona.withColumnRenamed("A", "E")):
        with pytest.raises(ValueError, match="differ: "):
            project_scores(other, flags, ["id", "analytic_id"], [DURATION])


def test_package_names_that_differ_in_case_are_refused_when_wide(spark):
    inputs = sample_inputs(
        spark,
        new_tariff=[("p1", "A"), ("p2", "a")],
        purchases=[("c", "p1", 1.0), ("c", "p2", 2.0)],
    )
    with pytest.raises(ValueError, match="tall shape"):
        customer_persona(inputs)
    assert customer_persona_tall(inputs).count() == 2


def test_wide_tables_of_many_packages(spark):
    columns = [f"package {i}" for i in range(600)]
    persona = spark.createDataFrame(
        [(0, "c", *[1.0] * 600)],
        "id bigint, analytic_id string, " + ", ".join(f"`{c}` double" for c in columns),
    )
    flags = spark.range(600).selectExpr(
        "concat('package ', id) as package", *[f"cast(id % 6 = {i} as int) AS {c}" for i, c in enumerate(DURATION.columns)]
    )
    scored = project_scores(persona, flags, ["id", "analytic_id"], [DURATION])
    assert rows_of(scored) == [(0, "c", *[100.0] * 5)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_masters_against_brute_force(spark, seed):
    """Repeated codes, shared and missing names, gaps and empty labels."""
    rng = random.Random(seed)
    codes = [f"p{i}" for i in range(12)]
    olds, news = [f"old {i}" for i in range(8)], [f"new {i}" for i in range(5)]
    old_tariff = [(rng.choice(codes), rng.choice(olds)) for _ in range(14)]
    new_tariff = [(rng.choice(codes), rng.choice([*news, None])) for _ in range(14)]
    attributes = [
        (old, float(rng.choice([1, 5, 7, 10, 20, 31])), 5.0, rng.choice(["Social", None]))
        for old in olds
    ]
    purchases = [
        (rng.choice(["a", "b", "c", None]), rng.choice(codes), float(rng.randrange(4)))
        for _ in range(60)
    ]

    def last(name):
        return (name is None, name or "")

    bridge = {}
    for old in olds:
        listed = [
            (code, last(new), new)
            for code, name in old_tariff
            if name == old
            for new in ([n for c, n in new_tariff if c == code] or [None])
        ]
        if listed:
            bridge[old] = min(listed)
    found = {}
    for old, days, _, size in attributes:
        code, _, new = bridge.get(old, (None, None, None))
        if size is not None and new is not None:
            found.setdefault(new, []).append((code, old, days))
    label = {1: "XS", 5: "S", 7: "M", 10: "L", 20: None, 31: "XL"}
    bucket = {new: label[int(min(rows)[2])] for new, rows in found.items()}
    total, part = defaultdict(float), defaultdict(float)
    for customer, code, n in purchases:
        for c, new in new_tariff:
            if customer is not None and c == code and new is not None:
                total[customer] += n
                part[customer, bucket.get(new)] += n
    want = sorted(
        (c, *[part[c, b] / t if t else None for b in ("XS", "S", "M", "L", "XL")])
        for c, t in total.items()
    )
    inputs = sample_inputs(spark, purchases, old_tariff, new_tariff, attributes)
    assert rows_of(customer_scores(inputs, [DURATION])) == want


def random_matrix(rows, cols, seed):
    rng = random.Random(seed)
    return [[rng.choice([0.0, 0.0, rng.random()]) for _ in range(cols)] for _ in range(rows)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_product_equals_block_matrices(spark, limit):
    a, b = random_matrix(40, 12, 1), random_matrix(12, 5, 2)

    def blocks(m):
        rows = spark.sparkContext.parallelize(
            [IndexedRow(i, Vectors.dense(r)) for i, r in enumerate(m)]
        )
        return IndexedRowMatrix(rows).toBlockMatrix(8, 8)

    want = blocks(a).multiply(blocks(b)).toLocalMatrix().toArray()

    def tall(m):
        names = [f"k{j}" for j in range(len(m[0]))]
        df = spark.createDataFrame(
            [(i, *r) for i, r in enumerate(m)], ["row", *names]
        )
        return to_tall(df, "row", names)

    right = tall(b).withColumn("row", F.concat(F.lit("k"), F.col("row")))
    got = tall_product(tall(a), right, limit)
    wide = {r["row"]: r for r in to_wide(got, [f"k{j}" for j in range(5)]).collect()}
    for i, row in enumerate(want):
        for j, value in enumerate(row):
            have = wide[i][f"k{j}"] if i in wide else 0.0
            assert have == pytest.approx(value, abs=1e-12)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_hot_customer_and_hot_package_against_brute_force(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    rng = random.Random(11)
    purchases = []
    for i in range(6_000):
        customer = "hot" if i % 3 == 0 else f"c{rng.randrange(200)}"
        package = "p1" if i % 3 == 1 else rng.choice(["p1", "p2", "p3", "p4", "unlisted"])
        purchases.append((customer, package, float(rng.randrange(5))))
    buckets = {"p1": "S", "p2": "XL"}
    total, part = defaultdict(float), defaultdict(float)
    for customer, package, n in purchases:
        if package != "unlisted":
            total[customer] += n
            if package in buckets:
                part[customer, buckets[package]] += n
    want = sorted(
        (c, *[part[c, b] / t if t else None for b in ("XS", "S", "M", "L", "XL")])
        for c, t in total.items()
    )
    inputs = sample_inputs(spark, purchases=purchases, broadcast_limit=limit)
    assert sorted(rows_of(customer_scores(inputs, [DURATION]))) == want
