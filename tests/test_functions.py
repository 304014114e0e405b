import pytest
from pyspark.sql import functions as F

from prefshare.functions import vocab
from prefshare.functions.binning import bucket_label, duration_bucket, price_bucket
from prefshare.functions.flags import flag_columns, rename_safe, unique_names
from prefshare.functions.weights import scale_columns, share_columns
from prefshare.operators.encode import column_labels, one_hot


def binned(spark, values, bucket):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v double")
    return [r[0] for r in df.orderBy("i").select(bucket(F.col("v"))).collect()]


def test_duration_edges(spark):
    values = [1.0, 6.99, 7.0, 7.5, 15.0, 20.0, 29.9, 30.0, 365.0, 0.0, None]
    labels = ["XS", "S", "M", "L", "L", None, None, "XL", "XL", "XS", None]
    assert binned(spark, values, duration_bucket) == labels


def test_price_edges(spark):
    values = [6.44, 6.45, 27.62, 36.0, 36.5, 111.0, 111.5, None]
    labels = ["XS", "S", "S", "M", "L", "L", "XL", None]
    assert binned(spark, values, price_bucket) == labels


def test_bins_need_rules():
    with pytest.raises(ValueError):
        bucket_label(None, ())


def test_vocabularies_fit_together():
    assert len(vocab.SIZE_LABELS) == 18
    scored = set(vocab.QUOTA_LABELS) | set(vocab.SPEED_LABELS)
    assert set(vocab.SIZE_LABELS) - scored == {"256Kbps"}
    assert len(vocab.OLDER_SIZE_LABELS) == 13


def test_flags_of_null_and_absent_labels(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "label string")
    flags = df.select("label", *flag_columns(F.col("label"), ["a", "z"], "L"))
    assert flags.dtypes[1:] == [("L_a", "int"), ("L_z", "int")]
    assert [tuple(r) for r in flags.collect()] == [("a", 1, 0), (None, 0, 0), ("b", 0, 0)]


def test_one_hot_of_discovered_labels(spark):
    df = spark.createDataFrame(
        [(1, "Full speed"), (2, None), (3, "Game")], "k int, size string"
    )
    flags = one_hot(df, "size")
    assert flags.columns == ["k", "size_Full_speed", "size_Game"]
    assert sorted(tuple(r) for r in flags.collect()) == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]


def test_label_columns_are_all_labels(spark):
    df = spark.range(6_000).selectExpr("lpad(nullif(id, 7), 4, '0') as v")
    assert column_labels(df, "v") == [f"{i:04}" for i in range(6_000) if i != 7]


def test_unsafe_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Full speed", "x"])
    assert rename_safe(df).columns == ["Full_speed", "x"]
    with pytest.raises(ValueError):
        unique_names(["a", "a"])


def test_scale_and_share_leave_keys_alone(spark):
    df = spark.createDataFrame(
        [("c", 3.0, 1, 0), ("d", 0.0, 1, 1)], "analytic_id string, w double, a int, `b c` int"
    )
    scaled = scale_columns(df, "w", keep=["analytic_id"])
    assert [tuple(r) for r in scaled.collect()] == [("c", 3.0, 3.0, 0.0), ("d", 0.0, 0.0, 0.0)]
    shared = share_columns(scaled, "w", keep=["analytic_id"])
    assert shared.columns == ["analytic_id", "a", "b c"]
    assert [tuple(r) for r in shared.collect()] == [("c", 1.0, 0.0), ("d", None, None)]
