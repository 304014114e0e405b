import glob
import os

import pytest
from pyspark.sql.utils import AnalysisException
from tests.samples import ATTRIBUTES, NEW_TARIFF, OLD_TARIFF, PURCHASES, sample_inputs

from prefshare.operators import sizing
from prefshare.operators.scores import DURATION, QUOTA
from prefshare.plans import jobs
from prefshare.plans.inputs import read_inputs
from prefshare.plans.scores import indexed_scores
from prefshare.sources import readers, writers
from prefshare.sources.scratch import scratch_path
from tests.conftest import rows_of


def put(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_found_by_header(spark, tmp_path):
    path = put(
        tmp_path / "old.csv",
        ["Price Inc VAT,Package Name,Promotion Code", '1.5,"a, b",p1', "2,,p2"],
    )
    old = readers.read_old_tariff(spark, path)
    assert old.columns == ["promotion_code", "package_name"]
    assert rows_of(old) == [("p1", "a, b"), ("p2", None)]


def test_text_in_a_number_column_is_null(spark, tmp_path):
    path = put(
        tmp_path / "attributes.csv",
        ["Package_Name,Package_Duration,Price,Package_Size", "a,7,x,Social", "b,,6.5,"],
    )
    assert rows_of(readers.read_attributes(spark, path)) == [
        ("a", 7.0, None, "Social"),
        ("b", None, 6.5, None),
    ]


def test_pipe_folder_of_many_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = sample_inputs(spark).transactions
    writers.write_delimited(df.repartition(3), path)
    assert len(glob.glob(path + "/part-*")) == 3
    assert rows_of(readers.read_transactions(spark, path)) == rows_of(df)


def test_existing_output_is_not_overwritten_unasked(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    writers.write_parquet(df, path)
    with pytest.raises(AnalysisException):
        writers.write_parquet(df, path)
    writers.write_parquet(df.limit(1), path, mode="overwrite")
    assert readers.read_parquet(spark, path).count() == 1


def test_single_file_is_what_was_asked_for(spark, tmp_path):
    df = spark.range(100).repartition(4)
    for single, files in ((True, 1), (False, 4)):
        writers.write_delimited(df, str(tmp_path / str(files)), single_file=single)
        assert len(glob.glob(str(tmp_path / f"{files}/part-*"))) == files


def test_files_with_other_column_orders_are_refused(spark, tmp_path):
    header = "analytic_id|package_id|total_transaction"
    one = put(tmp_path / "1.txt", [header, "a|p1|2"])
    two = put(tmp_path / "2.txt", ["package_id|analytic_id|total_transaction", "p9|z|3"])
    same = put(tmp_path / "3.txt", [header, "b|p2|4"])
    assert rows_of(readers.read_transactions(spark, [one, same])) == [
        ("a", "p1", 2.0), ("b", "p2", 4.0),
    ]
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_transactions(spark, [one, two]).collect()


def test_a_quantity_that_is_no_number_ends_the_read(spark, tmp_path):
    path = put(
        tmp_path / "t.txt", ["analytic_id|package_id|total_transaction", "a|p1|1,200", "b|p1|"]
    )
    rows = readers.read_transactions(spark, path)
    with pytest.raises(Exception, match="total_transaction is no number: 1,200"):
        rows.collect()
    assert rows_of(rows.where("analytic_id = 'b'")) == [("b", "p1", None)]


def test_vectors_keep_their_ids(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.createDataFrame([(4, 0.5, 2.0), (7, None, 1.25)], "id bigint, a double, b double")
    writers.write_vectors(df, path, "id", ["a", "b"])
    assert "4|[0.5, 2.0]" in [r[0] for r in spark.read.text(path).collect()]
    assert rows_of(readers.read_vectors(spark, path, ["a", "b"])) == rows_of(df)


def test_measured_bytes_grow_with_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "v string")
    long = spark.createDataFrame([("a" * 1_000,), (None,)] * 5, "v string")
    assert sizing.measured_bytes(short) == 10 * (16 + 8 + 1)
    assert sizing.measured_bytes(long) == 10 * (16 + 8) + 5_000
    assert sizing.measured_bytes(short, long) == 250 + 5_240
    assert sizing.measured_bytes(short.limit(0)) == 0
    assert not sizing.fits(long, limit=5_000)


def test_repeated_bytes_bound_the_join(spark):
    codes = spark.createDataFrame([(f"p{i}", "A") for i in range(10)], "code string, name string")
    labels = spark.createDataFrame([("A", "x" * 90), ("B", "x")], "name string, label string")
    joined = codes.join(labels, "name")
    most = sizing.repeated_bytes(codes, labels.drop("name"))
    assert sizing.measured_bytes(joined) == most == 10 * (16 + 16 + 3 + 8 + 90)
    assert sizing.repeated_bytes(codes.limit(0), labels) == 0


class Session:
    """A session stand-in with a given master and settings."""

    def __init__(self, master, folder=None, context_folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master
        self.folder = context_folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder_comes_from_the_session():
    cluster = Session("yarn", folder="hdfs://shared/tmp")
    path = scratch_path(cluster, "x")
    assert path.startswith("hdfs://shared/tmp/x-")
    assert scratch_path(cluster, "x") != path
    assert scratch_path(Session("yarn", context_folder="/shared"), "x").startswith("/shared/x-")


def test_only_a_local_master_makes_its_own_folder():
    with pytest.raises(ValueError):
        scratch_path(Session("spark://host:7077"), "x")
    local = Session("local[2]")
    assert scratch_path(local, "x").startswith(local.folder)


@pytest.fixture
def files(tmp_path):
    def table(name, header, rows, sep=","):
        text = [sep.join("" if v is None else str(v) for v in r) for r in rows]
        return put(tmp_path / name, [sep.join(header), *text])

    return {
        "transactions": table(
            "t.txt", ["analytic_id", "package_id", "total_transaction"], PURCHASES, "|"
        ),
        "old_tariff": table("o.csv", ["Promotion Code", "Package Name"], OLD_TARIFF),
        "new_tariff": table("n.csv", ["PromotionCode", "PackageName"], NEW_TARIFF),
        "attributes": table(
            "a.csv", ["Package_Name", "Package_Duration", "Price", "Package_Size"], ATTRIBUTES
        ),
    }


@pytest.mark.parametrize(
    "table_format, shape", [("csv", "wide"), ("parquet", "wide"), ("csv", "tall")]
)
def test_jobs_from_files_to_scores(spark, files, tmp_path, table_format, shape):
    inputs = read_inputs(spark, **files)
    out = str(tmp_path / "derived")
    jobs.preprocess(inputs, out, table_format=table_format, shape=shape)
    kinds = [("duration", DURATION), ("quota", QUOTA)]
    for kind, buckets in kinds if table_format == "csv" else kinds[:1]:
        path = str(tmp_path / kind)
        jobs.score(
            spark,
            kind,
            out + "/package_preferences",
            out + "/customer_persona",
            path,
            table_format=table_format,
            shape=shape,
        )
        scored = readers.read_features(spark, path, table_format)
        assert scored.columns == ["analytic_id", "id", *buckets.columns]
        want = indexed_scores(sample_inputs(spark), [buckets])
        got = {r["analytic_id"]: r for r in scored.collect()}
        for row in want.collect():
            for c in ["id", *buckets.columns]:
                assert got[row["analytic_id"]][c] == pytest.approx(row[c], abs=1e-12)


def test_all_scores_job(spark, files, tmp_path):
    jobs.all_scores(read_inputs(spark, **files), str(tmp_path / "scores"))
    one_pass = readers.read_features(spark, str(tmp_path / "scores/duration"))
    assert rows_of(one_pass.select("id", "analytic_id", *DURATION.columns)) == rows_of(
        indexed_scores(sample_inputs(spark), [DURATION])
    )


def test_raw_vectors_job(spark, files, tmp_path):
    jobs.raw_duration(read_inputs(spark, **files), str(tmp_path / "raw"))
    raw = readers.read_vectors(spark, str(tmp_path / "raw"), DURATION.columns)
    assert [r[0] for r in rows_of(raw)] == [0, 1, 2, 3]


def test_raw_vectors_of_a_range_without_a_package(spark, files, tmp_path):
    out = str(tmp_path / "raw")
    flags = [f for k, v in files.items() for f in ("--" + k.replace("_", "-"), v)]
    flags += ["--id-from", "0", "--id-to", "1", "--exclude", "A"]
    jobs.main(["raw-duration", *flags, "--out", out])
    rows = rows_of(readers.read_vectors(spark, out, DURATION.columns))
    assert rows == [(0, 0.0, 0.0, 0.0, 0.0, 3.0), (1, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_command_line(spark, files, tmp_path):
    out = str(tmp_path / "cli")
    flags = [f for k, v in files.items() for f in ("--" + k.replace("_", "-"), v)]
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(scratch))
    jobs.main(["preprocess", *flags, "--out", out])
    assert set(os.listdir(scratch)) == before
    tall = readers.read_features(spark, out + "/customer_persona")
    assert "package" in tall.columns and tall.select("id").distinct().count() == 4
