"""One query per operator and product, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefshare.catalog.tables import (
    LABEL_REST,
    LABEL_SUBSET,
    PART_NAMES,
    PART_PRICE_RULES,
    PART_TYPES,
    purchases,
    purchases_by_year,
    retail_inputs,
    table,
)
from prefshare.functions import vocab
from prefshare.functions.binning import bucket_label, duration_bucket, price_bucket
from prefshare.functions.flags import flag_columns, quoted, rename_safe
from prefshare.functions.weights import scale_columns
from prefshare.operators import encode, matrix, names, ranges
from prefshare.operators import persona as persona_ops
from prefshare.operators.dedupe import first_per_key
from prefshare.operators.index import dense_index, package_index
from prefshare.operators.scores import (
    DURATION,
    PRICE,
    bucket_scores,
    project_scores,
    tall_scores,
)
from prefshare.plans import (
    batches,
    ids,
    jobs,
    months,
    persona,
    preferences,
    scores,
    views,
)
from prefshare.sources import readers, writers
from prefshare.sources.ordered import read_ordered
from prefshare.sources.scratch import scratch_path, stage

# Starts of the id ranges that are put together again; the last one is open.
BATCH_STARTS = (0, 500, 1_000)
# The id range that ``id_range`` selects, and the start of the open one.
ID_RANGE = (1, 20_000)
FIRST_SCORED = ID_RANGE[0]
# Customers of a range that is written by itself.
RANGE_IDS = 600
# The first run of the lasting ids meets every so many customers.
FIRST_RUN = 3

Query = Callable[[SparkSession, str], DataFrame]


# Sources and sinks


def txn_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    writers.write_delimited(purchases(spark, sf_dir), path)
    return readers.read_transactions(spark, path)


def tariff_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    old, new = scratch_path(spark, "old_tariff"), scratch_path(spark, "new_tariff")
    writers.write_delimited(
        part.select(
            F.col("p_retailprice").alias("Price Inc VAT"),
            F.col("p_partkey").alias("Promotion Code"),
            F.col("p_brand").alias("Package Name"),
        ),
        old,
        sep=",",
    )
    writers.write_delimited(
        part.select(
            F.col("p_partkey").alias("PromotionCode"),
            F.col("p_name").alias("PackageName"),
        ),
        new,
        sep=",",
    )
    current = readers.read_new_tariff(spark, new)
    return readers.read_old_tariff(spark, old).join(
        current.select("promotion_code", F.col("package_name").alias("package")),
        "promotion_code",
        "left",
    )


def attr_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "attributes")
    writers.write_delimited(
        table(spark, sf_dir, "part").select(
            F.col("p_name").alias("Package_Name"),
            F.col("p_size").alias("Package_Duration"),
            F.col("p_retailprice").alias("Price"),
            F.col("p_type").alias("Package_Size"),
        ),
        path,
        sep=",",
        single_file=True,
    )
    return readers.read_attributes(spark, path)


def derived_dir_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = scratch_path(spark, "derived")
    jobs.preprocess(retail_inputs(spark, sf_dir), derived, shape="wide")
    scored = project_scores(
        readers.read_features(spark, f"{derived}/customer_persona"),
        readers.read_features(spark, f"{derived}/package_preferences"),
        ["id", "analytic_id"],
        [DURATION, PRICE],
    )
    # Shares are added one by one here, so the last bits depend on their order.
    return scored.select(
        "id",
        "analytic_id",
        *[F.round(quoted(c), 9).alias(c) for c in DURATION.columns + PRICE.columns],
    )


def tall_dir_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = scratch_path(spark, "derived-tall")
    jobs.preprocess(
        retail_inputs(spark, sf_dir), derived, table_format="parquet", shape="tall"
    )
    return tall_scores(
        readers.read_features(spark, f"{derived}/customer_persona", "parquet"),
        readers.read_features(spark, f"{derived}/package_preferences", "parquet"),
        ["id", "analytic_id"],
        [DURATION, PRICE, LABEL_SUBSET, LABEL_REST],
    )


def score_text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "duration_vectors")
    raw = scores.raw_range_scores(retail_inputs(spark, sf_dir))
    writers.write_vectors(raw, path, "id", DURATION.columns)
    return readers.read_vectors(spark, path, DURATION.columns)


def persona_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.preview(customer_index(spark, sf_dir))


# Names


def name_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = retail_inputs(spark, sf_dir)
    return names.name_bridge(inputs.old_tariff, inputs.new_tariff, inputs.hint)


def attrs_with_new_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = retail_inputs(spark, sf_dir)
    bridge = names.name_bridge(inputs.old_tariff, inputs.new_tariff, inputs.hint)
    return names.attributes_with_current_name(
        inputs.attributes, bridge, inputs.hint
    ).select("package_name", "duration", "price", "size", "package")


def dedupe_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return first_per_key(part, ["p_name"], ["p_partkey"])


def named_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona.named_purchases(retail_inputs(spark, sf_dir))


def bought_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = retail_inputs(spark, sf_dir)
    return names.bought_packages(
        inputs.transactions, inputs.new_tariff, inputs.hint
    )


# Bins, labels and flags


def bin_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", duration_bucket(F.col("p_size")).alias("duration")
    )


def bin_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", price_bucket(F.col("value")).alias("price")
    )


def drop_missing_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_duration(spark, sf_dir).na.drop(subset=["duration"])


def one_hot_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = table(spark, sf_dir, "part").select(
        "p_partkey",
        duration_bucket(F.col("p_size")).alias("duration"),
        bucket_label(F.col("p_retailprice"), PART_PRICE_RULES).alias("price"),
        F.col("p_type").alias("size"),
    )
    return binned.select(
        "p_partkey",
        *flag_columns(F.col("duration"), vocab.STEP_LABELS, vocab.DURATION_PREFIX),
        *flag_columns(F.col("price"), vocab.STEP_LABELS, vocab.PRICE_PREFIX),
        *flag_columns(F.col("size"), PART_TYPES, vocab.SIZE_PREFIX),
    )


def one_hot_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return encode.one_hot(part, "p_type")


def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.distinct_labels(table(spark, sf_dir, "part"), "p_type")


def weighted_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = retail_inputs(spark, sf_dir)
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("package_id"), F.col("p_type").alias("type")
    )
    sold = inputs.transactions.join(inputs.hint(part), "package_id").drop("package_id")
    flags = encode.one_hot(sold, "type", PART_TYPES)
    return scale_columns(flags, "total_transaction", keep=["analytic_id"])


def rename_unsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = persona.persona_quantities_wide(retail_inputs(spark, sf_dir), PART_NAMES)
    return rename_safe(wide).drop("red_widget")


# Persona


def customer_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona_ops.customer_totals(named_transactions(spark, sf_dir))


def customer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_total(spark, sf_dir).agg(F.count(F.lit(1)).alias("customers"))


def persona_qty_tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona.persona_quantities(retail_inputs(spark, sf_dir))


def persona_qty_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona.persona_quantities_wide(retail_inputs(spark, sf_dir), PART_NAMES)


def persona_share_tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona.persona_tall(retail_inputs(spark, sf_dir))


def persona_share_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona.persona_shares_wide(retail_inputs(spark, sf_dir), PART_NAMES)


def customer_persona(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of the wide persona: its columns are found in the data."""
    wide = persona.customer_persona(retail_inputs(spark, sf_dir))
    packages = [quoted(c) for c in wide.columns if c not in ("id", "analytic_id")]
    return wide.unpivot(["id", "analytic_id"], packages, "package", "share")


def sparse_persona(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the sparse persona's rows, with their place in the arrays."""
    path = scratch_path(spark, "sparse-persona")
    inputs = retail_inputs(spark, sf_dir)
    staged = persona.staged_quantities(inputs)
    labels = stage(
        preferences.bought_package_labels(inputs, staged.bought), "bought-packages"
    )
    flags = preferences.package_preferences(inputs, with_name=True, bought=labels)
    persona.write_sparse_persona(inputs, flags, path, staged=staged)
    rows = read_ordered(spark, path)
    entry = F.posexplode_outer(F.arrays_zip("package_ids", "quantities", "shares"))
    return rows.select("id", "analytic_id", "total", entry.alias("place", "entry")).select(
        "id",
        "analytic_id",
        "total",
        "place",
        F.col("entry.package_ids").alias("package_id"),
        F.col("entry.quantities").alias("qty"),
        F.col("entry.shares").alias("share"),
    )


def persona_share_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide shares by SQL over views of the tables."""
    prefix = "retail_"
    names = views.create_views(retail_inputs(spark, sf_dir), prefix)
    shares = views.persona_shares_sql(spark, PART_NAMES, f"{prefix}quantities")
    # The frame keeps the plan of the views it was made from.
    views.drop_views(spark, names)
    return shares


def months_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of purchases that came in parts, one of which was wrong and is replaced."""
    store = scratch_path(spark, "months")
    inputs = retail_inputs(spark, sf_dir)
    # The purchases meet their orders once, not once for each part.
    dated = stage(purchases_by_year(spark, sf_dir), "dated-purchases", folders=["year"])
    years = [r[0] for r in dated.select("year").distinct().orderBy("year").collect()]
    rows = dated.drop("year")
    months.put_month(rows.where(F.col("total_transaction") > 20), store, str(years[0]))
    for year in years[1:]:
        months.put_month(dated.where(F.col("year") == year).drop("year"), store, str(year))
    months.put_month(dated.where(F.col("year") == years[0]).drop("year"), store, str(years[0]))
    kept = replace(inputs, transactions=months.quantities_of(spark, store))
    return scores.customer_scores(kept, [DURATION])


# Ids and ranges


def customer_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_total(spark, sf_dir).select("analytic_id")
    return dense_index(customers, "analytic_id")


def ids_that_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a first run over some customers, and of a second one over all."""
    store = scratch_path(spark, "kept-ids")
    customers = customer_total(spark, sf_dir).select("analytic_id")
    ids.extend_ids(customers.where(F.col("analytic_id") % FIRST_RUN == 0), store)
    return ids.extend_ids(customers, store)


def id_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.id_between(customer_index(spark, sf_dir), *ID_RANGE)


def id_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.id_from(customer_index(spark, sf_dir), FIRST_SCORED)


def range_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.union_ranges(customer_index(spark, sf_dir), BATCH_STARTS)


# Packages


def package_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = retail_inputs(spark, sf_dir)
    bought = names.bought_packages(
        inputs.transactions, inputs.new_tariff, inputs.hint
    )
    return package_index(bought, "package", few=inputs.few_packages)


def package_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.package_preferences(retail_inputs(spark, sf_dir))


# Scores


def score_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.customer_scores(retail_inputs(spark, sf_dir), [DURATION])


def score_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.customer_scores(retail_inputs(spark, sf_dir), [PRICE])


def score_price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by the price bucket of their events, with the standard edges."""
    labelled = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("analytic_id"),
        F.lit(1).alias("events"),
        price_bucket(F.col("value")).alias("price"),
    )
    return bucket_scores(labelled, ["analytic_id"], "events", [PRICE])


def score_label_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.customer_scores(retail_inputs(spark, sf_dir), [LABEL_SUBSET])


def score_label_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.customer_scores(retail_inputs(spark, sf_dir), [LABEL_REST])


def scores_in_id_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = [DURATION, PRICE, LABEL_SUBSET, LABEL_REST]
    # The files that are read back hold the rows in id order.
    return scores.indexed_scores(retail_inputs(spark, sf_dir), every)


def scores_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scores of the derived tables side by side; all three folders lie by customer,
    so neither scoring nor the join shuffles."""
    derived = scratch_path(spark, "derived-by-customer")
    jobs.preprocess(
        retail_inputs(spark, sf_dir), derived, table_format="parquet", shape="tall"
    )
    folders = []
    for kind in ("duration", "price"):
        folders.append(scratch_path(spark, f"{kind}-by-customer"))
        jobs.score(
            spark,
            kind,
            f"{derived}/package_preferences",
            f"{derived}/customer_persona",
            folders[-1],
            table_format="parquet",
        )
    duration, price = (readers.read_features(spark, f, "parquet") for f in folders)
    return duration.join(price.drop("id"), "analytic_id")


def scores_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score of the sparse persona in ranges of ids; the first run ends after one."""
    derived, out = scratch_path(spark, "derived-sparse"), scratch_path(spark, "ranges")
    jobs.preprocess(
        retail_inputs(spark, sf_dir), derived, table_format="parquet", shape="sparse"
    )
    for most in (1, None):
        jobs.score_by_ranges(
            spark,
            "duration",
            f"{derived}/package_preferences",
            f"{derived}/customer_persona",
            out,
            batch=RANGE_IDS,
            table_format="parquet",
            most=most,
        )
    return batches.read_ranges(spark, out)


def score_raw_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.raw_range_scores(
        retail_inputs(spark, sf_dir), excluded=["red widget"]
    )


def sparse_matmul(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = retail_inputs(spark, sf_dir)
    # The flags are measured and joined: staged, the purchases are searched once.
    bought = stage(preferences.bought_package_labels(inputs), "bought-packages")
    flags = preferences.package_preferences(inputs, with_name=True, bought=bought)
    columns = [c for c in flags.columns if c not in ("id", "package")]
    # The product sums; the purchases need no sum of their own before it.
    quantities = persona_ops.with_customer(persona.named_purchases(inputs)).select(
        F.col("analytic_id").alias("row"),
        F.col("package").alias("col"),
        F.col("total_transaction").alias("value"),
    )
    return matrix.tall_product(quantities, matrix.to_tall(flags, "package", columns))


def bought_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages by packages: how much of one was bought by buyers of the other. Both
    factors have a row for each customer and package."""
    quantities = stage(persona.persona_quantities(retail_inputs(spark, sf_dir)), "quantities")
    amounts = quantities.select(
        F.col("package").alias("row"), F.col("analytic_id").alias("col"), F.col("qty").alias("value")
    )
    buyers = quantities.where("qty > 0").select(
        F.col("analytic_id").alias("row"), F.col("package").alias("col"), F.lit(1).alias("value")
    )
    return matrix.block_product(amounts, buyers)


QUERIES: dict[str, Query] = {
    "txn_csv_roundtrip": txn_csv_roundtrip,
    "tariff_csv_roundtrip": tariff_csv_roundtrip,
    "attr_csv_roundtrip": attr_csv_roundtrip,
    "derived_dir_roundtrip": derived_dir_roundtrip,
    "tall_dir_roundtrip": tall_dir_roundtrip,
    "score_text_vectors": score_text_vectors,
    "months_replaced": months_replaced,
    "persona_preview": persona_preview,
    "name_bridge": name_bridge,
    "attrs_with_new_name": attrs_with_new_name,
    "dedupe_by_name": dedupe_by_name,
    "named_transactions": named_transactions,
    "bought_packages": bought_packages,
    "bin_duration": bin_duration,
    "bin_price": bin_price,
    "drop_missing_label": drop_missing_label,
    "one_hot_fixed": one_hot_fixed,
    "one_hot_discovered": one_hot_discovered,
    "distinct_labels": distinct_labels,
    "weighted_flags": weighted_flags,
    "rename_unsafe": rename_unsafe,
    "customer_total": customer_total,
    "customer_count": customer_count,
    "persona_qty_tall": persona_qty_tall,
    "persona_qty_wide": persona_qty_wide,
    "persona_share_tall": persona_share_tall,
    "persona_share_wide": persona_share_wide,
    "persona_share_sql": persona_share_sql,
    "customer_persona": customer_persona,
    "sparse_persona": sparse_persona,
    "customer_index": customer_index,
    "ids_that_last": ids_that_last,
    "id_range": id_range,
    "id_from": id_from,
    "range_union": range_union,
    "package_index": package_ids,
    "package_preferences": package_preferences,
    "score_duration": score_duration,
    "score_price": score_price,
    "score_price_events": score_price_events,
    "score_label_subset": score_label_subset,
    "score_label_rest": score_label_rest,
    "scores_in_id_order": scores_in_id_order,
    "scores_by_customer": scores_by_customer,
    "scores_in_ranges": scores_in_ranges,
    "score_raw_range": score_raw_range,
    "sparse_matmul": sparse_matmul,
    "bought_together": bought_together,
}
