"""Hand-made inputs small enough to check by eye."""

from pyspark.sql import SparkSession

from prefshare.plans.inputs import PackageInputs

PURCHASES = [
    # c1 buys A x2 and B x3, and C x5, which has no attributes.
    ("c1", "p1", 2.0),
    ("c1", "p2", 3.0),
    ("c1", "p3", 5.0),
    # c2 has a zero total.
    ("c2", "p1", 0.0),
    # c3 buys only what has no attributes.
    ("c3", "p3", 4.0),
    # c4 buys an unlisted package beside A, in two rows.
    ("c4", "p1", 1.0),
    ("c4", "p1", 2.0),
    ("c4", "unlisted", 7.0),
    # Nobody.
    (None, "p1", 9.0),
]
OLD_TARIFF = [("p1", "old A"), ("p2", "old B"), ("p9", "old Z"), ("p4", "old D")]
NEW_TARIFF = [("p1", "A"), ("p2", "B B"), ("p3", "C"), ("p4", "D"), ("p5", None)]
ATTRIBUTES = [
    ("old A", 3.0, 6.0, "Social"),
    ("old B", 30.0, 200.0, "1Mbps"),
    ("old D", 20.0, 30.0, "Qouta_S"),
    ("old Z", 1.0, 1.0, "Entertain"),
    ("unknown", 1.0, 1.0, "Entertain"),
]


def sample_inputs(
    spark: SparkSession,
    purchases=PURCHASES,
    old_tariff=OLD_TARIFF,
    new_tariff=NEW_TARIFF,
    attributes=ATTRIBUTES,
    **settings,
) -> PackageInputs:
    return PackageInputs(
        spark.createDataFrame(
            purchases, "analytic_id string, package_id string, total_transaction double"
        ),
        spark.createDataFrame(old_tariff, "promotion_code string, package_name string"),
        spark.createDataFrame(new_tariff, "promotion_code string, package_name string"),
        spark.createDataFrame(
            attributes, "package_name string, duration double, price double, size string"
        ),
        **settings,
    )
