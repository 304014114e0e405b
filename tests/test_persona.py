import pytest
from tests.samples import PURCHASES, sample_inputs

from prefshare.functions import vocab
from prefshare.operators import persona as persona_ops
from prefshare.plans.persona import (
    customer_persona,
    persona_quantities,
    persona_quantities_wide,
    persona_shares_wide,
    persona_tall,
)
from prefshare.plans.preferences import package_preferences
from tests.conftest import rows_of


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_shares(spark, limit):
    tall = persona_tall(sample_inputs(spark, broadcast_limit=limit))
    assert rows_of(tall.select("analytic_id", "package", "qty", "total", "share")) == [
        ("c1", "A", 2.0, 10.0, 0.2),
        ("c1", "B B", 3.0, 10.0, 0.3),
        ("c1", "C", 5.0, 10.0, 0.5),
        ("c2", "A", 0.0, 0.0, None),
        ("c3", "C", 4.0, 4.0, 1.0),
        ("c4", "A", 3.0, 3.0, 1.0),
    ]


def test_wide_persona_has_master_packages_only(spark):
    persona = customer_persona(sample_inputs(spark))
    assert persona.columns == ["id", "analytic_id", "A", "B B"]
    assert rows_of(persona) == [
        (0, "c1", 0.2, 0.3),
        (1, "c2", None, None),
        (2, "c3", 0.0, 0.0),
        (3, "c4", 1.0, 0.0),
    ]


def test_wide_quantities_have_every_bought_package(spark):
    inputs = sample_inputs(spark)
    wide = persona_quantities_wide(inputs)
    assert wide.columns == ["analytic_id", "A", "B B", "C"]
    assert rows_of(wide)[0] == ("c1", 2.0, 3.0, 5.0)
    assert rows_of(persona_shares_wide(inputs))[:2] == [
        ("c1", 0.2, 0.3, 0.5),
        ("c2", None, None, None),
    ]


def test_quantities_do_not_depend_on_partitioning(spark):
    inputs = sample_inputs(spark)
    spread = sample_inputs(spark)
    object.__setattr__(spread, "transactions", spread.transactions.repartition(11))
    assert rows_of(persona_quantities(inputs)) == rows_of(persona_quantities(spread))


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_preferences(spark, limit):
    inputs = sample_inputs(spark, broadcast_limit=limit)
    flags = package_preferences(inputs, with_name=True)
    assert len(package_preferences(inputs).columns) == 1 + 28
    rows = {r["package"]: r.asDict() for r in flags.collect()}
    # D is in the master but nobody bought it; C has no attributes.
    assert {p: r["id"] for p, r in rows.items()} == {"A": 0, "B B": 1}
    ones = {p: {c for c, v in r.items() if v == 1 and c != "id"} for p, r in rows.items()}
    assert ones == {
        "A": {"Package_Duration_S", "Price_XS", "Package_Size_Social"},
        "B B": {"Package_Duration_XL", "Price_XL", "Package_Size_1Mbps"},
    }


def test_preferences_of_the_older_vocabulary(spark):
    inputs = sample_inputs(
        spark,
        attributes=[("old A", 3.0, 6.0, "Full speed")],
        size_labels=vocab.OLDER_SIZE_LABELS,
    )
    flags = package_preferences(inputs)
    assert len(flags.columns) == 1 + 23
    assert flags.first()["Package_Size_Full_speed"] == 1


def test_same_current_name_keeps_smallest_code(spark):
    inputs = sample_inputs(
        spark,
        purchases=[("c", "p1", 1.0)],
        old_tariff=[("p2", "later"), ("p1", "first")],
        new_tariff=[("p1", "A"), ("p2", "A")],
        attributes=[("later", 1.0, 1.0, "Social"), ("first", 7.0, 30.0, "Entertain")],
    )
    row = package_preferences(inputs).first().asDict()
    assert {c for c, v in row.items() if v == 1} == {
        "Package_Duration_M",
        "Price_M",
        "Package_Size_Entertain",
    }


def test_packages_without_plan_type_are_dropped(spark):
    inputs = sample_inputs(spark, attributes=[("old A", 3.0, 6.0, None)])
    assert package_preferences(inputs).collect() == []


def test_very_wide_tables_are_the_same(spark, monkeypatch):
    rows = [*PURCHASES, ("c5", "p1", None), ("c6", "p2", None), ("c6", "p2", 1.5), ("c7", "p3", None)]
    inputs = sample_inputs(spark, purchases=rows)
    builds = [
        customer_persona,
        lambda i: persona_quantities_wide(i, ["C", "A", "none"]),
        lambda i: persona_shares_wide(i, ["C", "A", "none"]),
        lambda i: persona_shares_wide(i, []),
    ]
    summed = [build(inputs) for build in builds]
    monkeypatch.setattr(persona_ops, "SUMMED_COLUMNS", -1)
    for frame, build in zip(summed, builds):
        pivoted = build(inputs)
        assert frame.schema.simpleString() == pivoted.schema.simpleString()
        assert rows_of(frame) == rows_of(pivoted) and frame.count() == 7
