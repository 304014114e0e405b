"""Tables handed from job to job: by customer, by month, in id order, in ranges."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from prefshare.catalog import queries, tables
from prefshare.catalog.queries import scores_by_customer, scores_in_id_order
from prefshare.functions.flags import quoted
from prefshare.operators import index, matrix
from prefshare.operators.scores import DURATION, PRICE
from prefshare.operators.sparse import sparse_entries, sparse_rows, sparse_scores
from prefshare.plans import batches, ids, jobs, months, views
from prefshare.plans.inputs import read_inputs
from prefshare.plans.scores import customer_scores, indexed_scores
from prefshare.plans.session import listed_bytes
from prefshare.sources import ordered, readers
from prefshare.sources.bucketed import is_bucketed, read_bucketed, write_bucketed
from tests.conftest import SF_DIR, plan_of, rows_of
from tests.samples import ATTRIBUTES, NEW_TARIFF, OLD_TARIFF, PURCHASES, sample_inputs


def exchanges(plan):
    return re.findall(r"Arguments: ((?:hash|range)partitioning\(.*|SinglePartition)", plan)


@pytest.fixture
def no_auto_broadcast(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")


# By customer


def test_buckets_survive_the_hand_off(spark, tmp_path, no_auto_broadcast):
    """Grouping and joining by the key, also in a session that knows the folder only."""
    rows = [(f"c{i % 40}", i, float(i)) for i in range(400)] + [(None, 1, 2.0)]
    df = spark.createDataFrame(rows, "c string, n int, `odd ``name` double")
    one, two = str(tmp_path / "one"), str(tmp_path / "two's")
    write_bucketed(df, one, "c", buckets=5)
    write_bucketed(df.groupBy("c").count(), two, "c", buckets=5)
    for name in spark.catalog.listTables():
        if name.name.startswith("prefshare_"):
            spark.sql(f"DROP TABLE {name.name}")
    left, right = read_bucketed(spark, one), read_bucketed(spark, two)
    assert rows_of(left) == rows_of(df)
    joined = left.groupBy("c").agg(F.sum("n").alias("n")).join(right, "c")
    plan = plan_of(joined)
    assert not exchanges(plan) and "Bucketed: true" in plan
    assert joined.count() == 40
    assert len([f for f in os.listdir(one) if f.endswith(".parquet")]) <= 5


def test_bucketed_folders_keep_what_they_were_told(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "c string, n int")
    path = str(tmp_path / "t")
    write_bucketed(df, path, "c", buckets=2)
    with pytest.raises(FileExistsError):
        write_bucketed(df, path, "c")
    with pytest.raises(ValueError):
        write_bucketed(df, path, "c", mode="append")
    write_bucketed(df.limit(0), path, "c", mode="overwrite", buckets=3)
    assert is_bucketed(spark, path) and rows_of(read_bucketed(spark, path)) == []
    folder = str(tmp_path / "f")
    write_bucketed(df.withColumn("m", F.lit("x y/z")), folder, "c", buckets=2, folders=["m"])
    more = df.withColumns({"m": F.lit("b"), "n": F.lit(2)})
    write_bucketed(more, folder, "c", mode="overwrite", folders=["m"])
    assert rows_of(read_bucketed(spark, folder)) == [("a", 1, "x y/z"), ("a", 2, "b")]
    with pytest.raises(ValueError):
        write_bucketed(more.withColumn("o", F.lit(1)), folder, "c", mode="overwrite", folders=["m"])


def test_scoring_a_tall_persona_has_no_exchange(spark, tmp_path, no_auto_broadcast):
    out = str(tmp_path / "derived")
    inputs = sample_inputs(spark)
    jobs.preprocess(inputs, out, table_format="parquet", shape="tall")
    persona = readers.read_features(spark, f"{out}/customer_persona", "parquet")
    flags = readers.read_features(spark, f"{out}/package_preferences", "parquet")
    scored = jobs.tall_scores(persona, flags, jobs.KEYS, [DURATION])
    assert not exchanges(plan_of(scored))
    for kind in ("duration", "price"):
        jobs.score(
            spark, kind, f"{out}/package_preferences", f"{out}/customer_persona",
            str(tmp_path / kind), table_format="parquet",
        )
    got = readers.read_features(spark, str(tmp_path / "duration"), "parquet")
    assert rows_of(got.select("id", "analytic_id", *DURATION.columns)) == rows_of(
        indexed_scores(inputs, [DURATION])
    )


def test_scores_meet_by_customer_without_a_shuffle(spark, no_auto_broadcast):
    assert not exchanges(plan_of(scores_by_customer(spark, SF_DIR)))


# Months


def test_months_add_up(spark, tmp_path):
    store = str(tmp_path / "months")
    rng = random.Random(4)
    rows = [(f"c{rng.randrange(9)}", f"p{rng.randrange(1, 6)}", float(rng.randrange(5)), rng.randrange(3)) for _ in range(400)]
    rows += [(None, "p1", 3.0, 1), ("c1", None, 3.0, 2)]
    every = spark.createDataFrame(rows, "analytic_id string, package_id string, total_transaction double, m int")

    def month(m):
        return every.where(F.col("m") == m).drop("m")

    months.put_month(every.drop("m"), store, "2024-01", buckets=3)
    for m in (1, 2, 0):
        months.put_month(month(m), store, f"2024-0{m + 1}")
    assert months.months(spark, store) == ["2024-01", "2024-02", "2024-03"]
    whole = sample_inputs(spark, purchases=[r[:3] for r in rows])
    kept = sample_inputs(spark)
    object.__setattr__(kept, "transactions", months.quantities_of(spark, store))
    assert rows_of(customer_scores(kept, [DURATION, PRICE])) == rows_of(
        customer_scores(whole, [DURATION, PRICE])
    )
    some = months.quantities_of(spark, store, ["2024-02"])
    assert rows_of(some) == rows_of(
        month(1).groupBy("analytic_id", "package_id").agg(F.sum("total_transaction"))
    )
    months.drop_month(spark, store, "2024-02")
    assert months.months(spark, store) == ["2024-01", "2024-03"]
    left = months.quantities_of(spark, store).agg(F.sum("total_transaction")).first()[0]
    assert left == sum(r[2] for r in rows if r[3] != 1)
    months.put_month(month(1), store, "2024-02")
    assert months.quantities_of(spark, store).agg(F.sum("total_transaction")).first()[0] == sum(r[2] for r in rows)
    with pytest.raises(ValueError):
        months.put_month(month(1), store, "")


def test_a_month_leaves_the_others_alone(spark, tmp_path, no_auto_broadcast):
    store = str(tmp_path / "months")
    rows = spark.createDataFrame(PURCHASES, "analytic_id string, package_id string, total_transaction double")
    months.put_month(rows, store, "1", buckets=3)

    def files():
        return {f: os.stat(f"{store}/month=1/{f}").st_mtime_ns for f in os.listdir(f"{store}/month=1")}

    before = files()
    months.put_month(rows, store, "2")
    assert files() == before
    plan = plan_of(months.quantities_of(spark, store))
    assert not exchanges(plan) and "Bucketed: true" in plan
    one = plan_of(months.quantities_of(spark, store, ["2"]))
    assert "PartitionFilters: [month" in one or "month#" in one.split("PartitionFilters")[1][:60]


def test_jobs_take_a_folder_of_months(spark, tmp_path):
    def table(name, sep, header, rows):
        path = tmp_path / name
        path.mkdir(exist_ok=True)
        lines = [sep.join("" if v is None else str(v) for v in r) for r in rows]
        (path / "a.csv").write_text("\n".join([sep.join(header), *lines]) + "\n")
        return str(path)

    header = ["analytic_id", "package_id", "total_transaction"]
    masters = ["--old-tariff", table("o", ",", ["Promotion Code", "Package Name"], OLD_TARIFF)]
    masters += ["--new-tariff", table("n", ",", ["PromotionCode", "PackageName"], NEW_TARIFF)]
    masters += ["--attributes", table("a", ",", ["Package_Name", "Package_Duration", "Price", "Package_Size"], ATTRIBUTES)]
    store, out = str(tmp_path / "months"), str(tmp_path / "scores")
    for i, half in enumerate((PURCHASES[:4], PURCHASES[4:])):
        table(f"t{i}", "|", header, half)
        jobs.main(["put-month", "--transactions", str(tmp_path / f"t{i}"), "--month", str(i), "--out", store])
    jobs.main(["scores", "--months", store, *masters, "--out", out])
    got = readers.read_features(spark, f"{out}/duration")
    assert rows_of(got.select("id", "analytic_id", *DURATION.columns)) == rows_of(
        indexed_scores(sample_inputs(spark), [DURATION])
    )
    # A pattern of files is listed and read like a folder.
    pattern = str(tmp_path / "t*" / "a.csv")
    assert listed_bytes(spark, [pattern]) == listed_bytes(spark, [str(tmp_path / "t0"), str(tmp_path / "t1")])
    assert read_inputs(spark, pattern, *masters[1::2]).transactions.count() == len(PURCHASES)
    with pytest.raises(FileNotFoundError):
        listed_bytes(spark, [str(tmp_path / "none*")])


def test_parts_of_dated_purchases_meet_their_orders_once(spark, tmp_path, monkeypatch):
    def table(name, rows):
        spark.createDataFrame(rows, tables.SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))

    days = [dt.datetime(1995 + i % 3, 1 + i, 5) for i in range(9)] + [None]
    table("orders", [(i, i % 4, day) for i, day in enumerate(days)])
    # Some lines have no order; those of nobody's year go to year 0.
    table("lineitem", [(i % 12, 1 + i % 5, 1.0 + 7 * i % 50) for i in range(60)])
    table("part", [(i, f"new {i % 3}", f"old {i}", "PROMO", 9 * i, 900.0 + i) for i in range(1, 6)])
    plans = []
    plain = queries.months.put_month

    def noted(rows, *args, **options):
        plans.append(plan_of(rows))
        plain(rows, *args, **options)

    monkeypatch.setattr(queries.months, "put_month", noted)
    got = rows_of(queries.months_replaced(spark, str(tmp_path)))
    assert len(got) == 4
    assert got == rows_of(customer_scores(tables.retail_inputs(spark, str(tmp_path)), [DURATION]))
    # Four years, and the first one again; the parts of a year read its rows alone.
    assert len(plans) == 5 and not any("Join" in p or exchanges(p) for p in plans)
    assert all(re.search(r"PartitionFilters: \[.*year#\d+ = \d+", p) for p in plans[1:])


# Ids


def test_ids_last(spark, tmp_path, no_auto_broadcast):
    store = str(tmp_path / "ids")

    def run(keys):
        frame = spark.createDataFrame([(k,) for k in keys], "analytic_id string")
        return dict(ids.extend_ids(frame, store).collect())

    assert run([]) == {}
    assert run(["b", "d", "b", None]) == {"b": 0, "d": 1}
    assert run(["a", "b", "c"]) == {"b": 0, "d": 1, "a": 2, "c": 3}
    assert run(["d"]) == {"b": 0, "d": 1, "a": 2, "c": 3}
    assert len([f for f in os.listdir(store) if f.startswith("generation=")]) == 2
    many = run([f"k{i}" for i in range(300)] + ["a"])
    assert sorted(many.values()) == list(range(304)) and many["a"] == 2
    kept = ids.kept_ids(spark, store)
    assert not exchanges(plan_of(kept.groupBy("analytic_id").count()))


# In id order


def test_order_takes_one_sort(spark, no_auto_broadcast, monkeypatch):
    written = []
    plain = index.write_ordered

    def noted(df, *args, **options):
        written.append(plan_of(df))
        plain(df, *args, **options)

    monkeypatch.setattr(index, "write_ordered", noted)
    last = plan_of(scores_in_id_order(spark, SF_DIR))
    assert len(written) == 1
    ranges = [e for e in exchanges(last) + exchanges(written[0]) if e.startswith("range")]
    # The one sort is the writer's own.
    assert not ranges and "SinglePartition" not in last


def test_ordered_folders_are_read_in_order(spark, tmp_path, settings):
    settings(
        spark__sql__shuffle__partitions="6",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    keys = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(f"{k:05d}", [k]) for k in keys], "k string, v array<int>")
    path = str(tmp_path / "o")
    ordered.write_ordered(df.repartition(4), path, "k")
    want = [(i, f"{k:05d}", [k]) for i, k in enumerate(sorted(keys))]
    assert rows_of(ordered.read_ordered(spark, path)) == sorted(want, key=repr)
    parts = [[tuple(r) for r in p.collect()] for p in ordered.parts_in_order(spark, path)]
    assert [r for p in parts for r in p] == want and len(parts) > 3
    for low, high in ((0, 0), (100, 250), (None, 10), (490, None), (600, 700), (-5, -1)):
        some = ordered.read_ordered(spark, path, low=low, high=high)
        lo, hi = -(10**9) if low is None else low, 10**9 if high is None else high
        assert rows_of(some) == sorted([r for r in want if lo <= r[0] <= hi], key=repr)
    # Other parts are not read.
    few = plan_of(ordered.read_ordered(spark, path, low=100, high=110))
    assert re.search(r"PartitionFilters: \[.*_part#\d+ >= \d+.*_part#\d+ <= \d+", few)
    with pytest.raises(ValueError):
        ordered.write_ordered(df.withColumn("_PART", F.lit(1)), str(tmp_path / "p"), "k")


def test_raw_vectors_lie_in_order(spark, tmp_path, settings):
    settings(
        spark__sql__shuffle__partitions="3",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    out = str(tmp_path / "raw")
    rows = [(f"c{i:03d}", "p1", 1.0) for i in range(90)]
    jobs.raw_duration(sample_inputs(spark, purchases=rows), out)
    lines = []
    for part in sorted((d for d in os.listdir(out) if d.startswith("part=")), key=lambda d: int(d[5:])):
        for name in sorted(f for f in os.listdir(f"{out}/{part}") if f.endswith(".txt")):
            lines += open(f"{out}/{part}/{name}").read().split()
    assert [int(x.split("|")[0]) for x in lines if "|" in x] == list(range(90))


# Sparse rows and ranges


def test_sparse_rows_of_very_many_packages(spark):
    """One customer buys 100,000 packages, and scores come out as from tall rows."""
    packages = 100_000
    ids_of = spark.range(packages).select(
        F.concat(F.lit("p"), F.col("id")).alias("package"), F.col("id").alias("package_id")
    )
    rows = ids_of.select(
        F.lit("all").alias("analytic_id"), "package", (F.col("package_id") % 7).cast("double").alias("qty")
    ).unionAll(
        spark.createDataFrame(
            [("few", "p5", 2.0), ("few", "p1", 1.0), ("few", "other", 3.0), ("none", "other", 4.0), ("zero", "p2", 0.0)],
            "analytic_id string, package string, qty double",
        )
    )
    sparse = sparse_rows(rows, ids_of).cache()
    got = {r.analytic_id: r for r in sparse.collect()}
    assert len(got["all"].package_ids) == packages - -(-packages // 7)
    assert got["all"].package_ids == sorted(got["all"].package_ids)
    assert tuple(got["few"]) == ("few", 6.0, [1, 5], [1.0, 2.0], [1 / 6, 2 / 6])
    assert tuple(got["none"])[1:] == (4.0, [], [], []) and tuple(got["zero"])[1:] == (0.0, [], [], [])
    assert sparse_entries(sparse, ["analytic_id"]).where("analytic_id = 'none'").count() == 1
    flags = ids_of.select(
        F.col("package_id").alias("id"), "package",
        *[(F.col("package_id") % 5 == i).cast("int").alias(c) for i, c in enumerate(DURATION.columns)],
    )
    want = rows.join(flags, "package", "left").groupBy("analytic_id").agg(
        F.sum("qty").alias("total"), *[F.sum(F.col("qty") * F.coalesce(c, F.lit(0))).alias(c) for c in DURATION.columns]
    )
    want = want.select("analytic_id", *[F.try_divide(c, "total").alias(c) for c in DURATION.columns])
    for limit in (0, 1 << 30):
        scored = sparse_scores(sparse, flags, ["analytic_id"], [DURATION], limit)
        assert rows_of(scored.select("analytic_id", *DURATION.columns)) == rows_of(want)


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    rows = [(f"c{i:02d}", f"p{1 + i % 3}", 1.0 + i) for i in range(25)]
    inputs = sample_inputs(spark, purchases=rows)
    derived, out = str(tmp_path / "d"), str(tmp_path / "s")
    jobs.preprocess(inputs, derived, table_format="parquet", shape="sparse")

    def run(batch=10, kind="duration"):
        jobs.score_by_ranges(
            spark, kind, f"{derived}/package_preferences", f"{derived}/customer_persona", out, batch, "parquet"
        )

    plain = batches.Ledger.enter
    entered = []

    def failing(self, low, high):
        if entered:
            raise RuntimeError("stopped")
        entered.append((low, high))
        plain(self, low, high)

    monkeypatch.setattr(batches.Ledger, "enter", failing)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.undo()
    # The second range is written but not entered: it does not count yet.
    assert batches.read_ranges(spark, out).count() == 10
    first = os.stat(f"{out}/ids=000000000000-000000000009/_SUCCESS").st_mtime_ns
    run()
    assert os.stat(f"{out}/ids=000000000000-000000000009/_SUCCESS").st_mtime_ns == first
    want = rows_of(indexed_scores(inputs, [DURATION]))
    assert rows_of(batches.read_ranges(spark, out).select("id", "analytic_id", *DURATION.columns)) == want
    for other in ({"batch": 5}, {"kind": "price"}):
        with pytest.raises(ValueError):
            run(**other)
    with pytest.raises(FileNotFoundError):
        batches.read_ranges(spark, str(tmp_path))
    assert batches.ranges_over(0, 5) == [] and batches.ranges_over(6, 5) == [(0, 4), (5, 5)]
    with pytest.raises(ValueError):
        batches.ranges_over(6, 0)


def test_small_ranges_are_written_together(spark, tmp_path, monkeypatch):
    rows = [(f"c{i:02d}", f"p{1 + i % 3}", 1.0 + i) for i in range(25)]
    inputs = sample_inputs(spark, purchases=rows)
    derived, out = str(tmp_path / "d"), str(tmp_path / "s")
    jobs.preprocess(inputs, derived, table_format="parquet", shape="sparse")
    asked = []
    plain = jobs.read_ordered

    def noted(*args, **options):
        asked.append((options["low"], options["high"]))
        return plain(*args, **options)

    monkeypatch.setattr(jobs, "read_ordered", noted)
    for most in (1, None):
        jobs.score_by_ranges(
            spark, "duration", f"{derived}/package_preferences", f"{derived}/customer_persona", out, 2, "parquet", most
        )
    # Twelve ranges are left after the first run; one job writes them.
    assert asked == [(0, 1), (2, 24)]
    want = rows_of(indexed_scores(inputs, [DURATION]))
    assert rows_of(batches.read_ranges(spark, out).select("id", "analytic_id", *DURATION.columns)) == want
    ledger = batches.Ledger(spark, out)
    assert ledger.finished() == set(batches.ranges_over(25, 2))
    for low, high in batches.ranges_over(25, 2):
        folder = ledger.folder(low, high)
        assert sorted(r.id for r in spark.read.parquet(folder).select("id").collect()) == list(range(low, high + 1))
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1 or (low, high) == (0, 1)


def test_groups_of_ranges():
    together = batches.written_together
    assert together([]) == [] and together([(0, 1), (2, 3), (4, 4)]) == [[(0, 1), (2, 3), (4, 4)]]
    # A gap, another width and too many ids end a group.
    assert together([(0, 1), (4, 5), (6, 9), (10, 11)]) == [[(0, 1)], [(4, 5)], [(6, 9), (10, 11)]]
    assert together([(0, 1), (2, 2), (3, 4)]) == [[(0, 1), (2, 2)], [(3, 4)]]
    assert together(batches.ranges_over(10, 2), 5) == [[(0, 1), (2, 3)], [(4, 5), (6, 7)], [(8, 9)]]
    assert together(batches.ranges_over(10, 5), 5) == [[(0, 4)], [(5, 9)]]


def test_ranges_without_rows_and_of_a_stopped_run(spark, tmp_path):
    out = str(tmp_path / "s")
    ranges = [(0, 1), (2, 3), (4, 5), (6, 6)]
    # What a stopped run left does not count, also where no row replaces it.
    for left in ("000000000002-000000000003", "000000000004-000000000005"):
        spark.range(2, 3).write.parquet(f"{out}/ids={left}")

    def rows(low, high):
        return spark.range(low, high + 1).where("id NOT IN (2, 3)")

    assert batches.write_ranges(spark, out, ranges, rows, name="id") == ranges
    assert [r[0] for r in batches.read_ranges(spark, out).orderBy("id").collect()] == [0, 1, 4, 5, 6]
    with pytest.raises(ValueError):
        batches.write_ranges(
            spark, str(tmp_path / "t"), ranges, lambda low, high: rows(low, high).withColumn("IDS", F.lit(1)), name="id"
        )


# Block products


def test_block_product_equals_the_plain_one(spark, no_auto_broadcast):
    rng = random.Random(8)
    left = {(f"r{rng.randrange(60)}", rng.choice(["hot", f"k{rng.randrange(20)}"])): float(rng.randrange(1, 9)) for _ in range(600)}
    right = {(rng.choice(["hot", f"k{rng.randrange(25)}"]), f"o{rng.randrange(50)}"): float(rng.randrange(1, 9)) for _ in range(500)}
    a = spark.createDataFrame([(r, c, v) for (r, c), v in left.items()], "row string, col string, value double")
    b = spark.createDataFrame([(r, c, v) for (r, c), v in right.items()], "row string, col string, value double")
    want = rows_of(matrix.tall_product(a, b).select("row", "col", "value"))
    for entries in (10_000, 7):
        got = matrix.block_product(a, b, entries, limit=0)
        assert entries > 7 or "BroadcastHashJoin" not in plan_of(got)
        assert rows_of(got.select("row", "col", "value")) == want
    for side in matrix.block_units(a, b, 7, limit=0):
        most = side.groupBy("inner", "_i", "_j").count().agg(F.max("count")).first()[0]
        # A hot index has 60 rows and 50 columns; hashing makes blocks uneven.
        assert most <= 3 * 7
    assert matrix.block_product(a.limit(0), b).count() == 0


# SQL over views


def test_sql_over_views(spark):
    inputs = sample_inputs(spark)
    names = views.create_views(inputs, "v_")
    packages = ["A", "B B", "C", "no`thing"]
    shares = views.persona_shares_sql(spark, packages, "v_quantities")
    assert shares.columns == ["analytic_id", *packages]
    got = {r[0]: tuple(r)[1:] for r in shares.collect()}
    assert got["c1"] == (0.2, 0.3, 0.5, 0.0) and got["c2"] == (None,) * 4
    assert spark.sql("SELECT count(*) FROM v_labels").first()[0] == 3
    views.drop_views(spark, names)
    assert not spark.catalog.tableExists("v_named")
    assert rows_of(shares.select(quoted("no`thing")).distinct()) == [(0.0,), (None,)]
    with pytest.raises(ValueError):
        views.persona_shares_sql(spark, ["a", "A"])
