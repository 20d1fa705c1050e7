"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Each one reads the driver tables through ``sources.model`` (so its work grows
with the data) and runs one operator over whole tables. Double outputs are
rounded for publication (``publishable``); counts stay 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import rules
from .functions.exprs import money_sum, rnd
from .operators import baskets as bk
from .operators import cohorts, customers, distinct, logs, products, quality, rfm, summary, timeseries
from .operators.enrich import enrich
from .plans import publish, versions
from .plans.durable import scratch_path
from .plans.publish import PUBLISH_PLAN, dataset_profile
from .sources import dirty, model, quarantine, schemas

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs.
PAIR_MIN_SUPPORT = 0.0004          # product pairs
BRAND_PAIR_MIN_SUPPORT = 0.02      # brand pairs
FRESHNESS_AS_OF = "2024-02-01 00:00:00"
FRESHNESS_MAX_AGE_HOURS = 48.0
STAR_TABLES = ("transactions", "customers", "products")


def publishable(df: DataFrame, digits: int = 2, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (``overrides`` sets per-column digits)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(rnd(f.name, overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(f.name)
    return df.select(*cols)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched star (customer join at order grain, see ``model.enriched``)."""
    return model.enriched(spark, sf_dir)


def _union_all(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _per_star_table(spark, sf_dir, check, source=model):
    s = source.star(spark, sf_dir)
    return _union_all([check(s[name], name) for name in STAR_TABLES])


# --- enrichment and calendar series ------------------------------------------
def q_enriched_transactions(spark, sf_dir):
    return publishable(enriched(spark, sf_dir), digits=6)


def q_monthly_series(spark, sf_dir):
    return publishable(timeseries.monthly_series(enriched(spark, sf_dir)))


def q_active_customers_by_period(spark, sf_dir):
    return distinct.active_by_period(enriched(spark, sf_dir), "customer_id", "active_customers")


def q_products_sold_by_period(spark, sf_dir):
    return distinct.active_by_period(enriched(spark, sf_dir), "product_id", "products_sold")


def q_weekday_series(spark, sf_dir):
    return publishable(timeseries.weekday_series(enriched(spark, sf_dir)))


# --- customers -----------------------------------------------------------------
def q_customer_lifetime(spark, sf_dir):
    return publishable(customers.customer_lifetime(enriched(spark, sf_dir)))


def q_clv_segments(spark, sf_dir):
    lt = customers.customer_lifetime(enriched(spark, sf_dir))
    return publishable(customers.clv_segments(lt))


def q_churn_indicators(spark, sf_dir):
    lt = customers.clv_segments(customers.customer_lifetime(enriched(spark, sf_dir)))
    return publishable(customers.churn_indicators(lt))


def q_rfm_base(spark, sf_dir):
    return publishable(rfm.rfm_base(enriched(spark, sf_dir)))


def q_rfm_quintiles(spark, sf_dir):
    return publishable(rfm.rfm_quintiles_long(rfm.rfm_base(enriched(spark, sf_dir))))


def q_rfm_segments(spark, sf_dir):
    return publishable(rfm.rfm_segments(rfm.rfm_base(enriched(spark, sf_dir))))


def q_rfm_segment_distribution(spark, sf_dir):
    seg = rfm.rfm_segments(rfm.rfm_base(enriched(spark, sf_dir)))
    return rfm.rfm_segment_distribution(seg)


# --- products --------------------------------------------------------------------
def q_product_performance(spark, sf_dir):
    return publishable(products.product_performance(enriched(spark, sf_dir)))


def q_top_products(spark, sf_dir):
    return publishable(products.top_products(enriched(spark, sf_dir), 10))


# --- cohorts ---------------------------------------------------------------------
def q_cohort_retention(spark, sf_dir):
    return publishable(cohorts.cohort_retention(enriched(spark, sf_dir)),
                       overrides={"period_number": 8})


def q_cohort_retention_whole_months(spark, sf_dir):
    return publishable(cohorts.cohort_retention(enriched(spark, sf_dir), whole_months=True))


# --- baskets ---------------------------------------------------------------------
def q_baskets(spark, sf_dir):
    return publishable(bk.baskets(enriched(spark, sf_dir)))


def q_basket_items(spark, sf_dir):
    return bk.basket_items(enriched(spark, sf_dir)).withColumnRenamed("item", "product_id")


def q_basket_pairs(spark, sf_dir):
    return publishable(bk.basket_pairs(enriched(spark, sf_dir), PAIR_MIN_SUPPORT),
                       overrides={"support": 8})


def q_basket_brand_pairs(spark, sf_dir):
    return publishable(bk.basket_pairs(enriched(spark, sf_dir), BRAND_PAIR_MIN_SUPPORT,
                                       item_col="brand"), overrides={"support": 8})


# --- data quality ----------------------------------------------------------------
def q_dq_nulls(spark, sf_dir):
    return _per_star_table(spark, sf_dir, quality.null_check)


def q_dq_duplicates(spark, sf_dir):
    return _per_star_table(spark, sf_dir, quality.duplicate_check)


def q_dq_numeric_strings(spark, sf_dir):
    return _per_star_table(spark, sf_dir, quality.numeric_string_check)


def q_dq_outliers(spark, sf_dir):
    return publishable(_per_star_table(spark, sf_dir, quality.outlier_check))


def q_dq_report(spark, sf_dir):
    return publishable(_per_star_table(spark, sf_dir, quality.quality_report))


def q_dq_verdict(spark, sf_dir):
    return quality.quality_verdict(_per_star_table(spark, sf_dir, quality.quality_report))


def q_ri_customers(spark, sf_dir):
    s = model.star(spark, sf_dir)
    return quality.orphan_keys(s["transactions"], s["customers"], "customer_id",
                               "transactions->customers")


def q_ri_products(spark, sf_dir):
    s = model.star(spark, sf_dir)
    return quality.orphan_keys(s["transactions"], s["products"], "product_id",
                               "transactions->products")


def q_cleanse(spark, sf_dir):
    return quality.cleanse(model.customers(spark, sf_dir))


def q_cleanse_transactions(spark, sf_dir):
    return publishable(quality.cleanse(model.transactions(spark, sf_dir)), digits=6)


def q_cleanse_products(spark, sf_dir):
    return publishable(quality.cleanse(model.products(spark, sf_dir)), digits=6)


def q_freshness(spark, sf_dir):
    tx = model.transactions(spark, sf_dir)
    lg = model.logs(spark, sf_dir)
    return publishable(quality.freshness(tx, "transactions", "transaction_date", FRESHNESS_AS_OF,
                                         FRESHNESS_MAX_AGE_HOURS).unionByName(
        quality.freshness(lg, "logs", "timestamp", FRESHNESS_AS_OF, FRESHNESS_MAX_AGE_HOURS)))


# --- the same over faulty inputs (every check has a row that fails) ----------------
def q_dirty_dq_nulls(spark, sf_dir):
    return _per_star_table(spark, sf_dir, quality.null_check, dirty)


def q_dirty_dq_duplicates(spark, sf_dir):
    return _per_star_table(spark, sf_dir, quality.duplicate_check, dirty)


def q_dirty_dq_numeric_strings(spark, sf_dir):
    return _per_star_table(spark, sf_dir, quality.numeric_string_check, dirty)


def q_dirty_dq_outliers(spark, sf_dir):
    return publishable(_per_star_table(spark, sf_dir, quality.outlier_check, dirty))


def q_dirty_dq_report(spark, sf_dir):
    return publishable(_per_star_table(spark, sf_dir, quality.quality_report, dirty))


def q_dirty_dq_verdict(spark, sf_dir):
    return quality.quality_verdict(_per_star_table(spark, sf_dir, quality.quality_report, dirty))


def q_dirty_ri_customers(spark, sf_dir):
    s = dirty.star(spark, sf_dir)
    return quality.orphan_keys(s["transactions"], s["customers"], "customer_id",
                               "transactions->customers")


def q_dirty_ri_products(spark, sf_dir):
    s = dirty.star(spark, sf_dir)
    return quality.orphan_keys(s["transactions"], s["products"], "product_id",
                               "transactions->products")


def q_dirty_cleanse(spark, sf_dir):
    return quality.cleanse(dirty.customers(spark, sf_dir))


def q_dirty_cleanse_transactions(spark, sf_dir):
    return publishable(quality.cleanse(dirty.transactions(spark, sf_dir)), digits=6)


def q_dirty_cleanse_products(spark, sf_dir):
    return publishable(quality.cleanse(dirty.products(spark, sf_dir)), digits=6)


def _cleansed_enriched(spark, sf_dir):
    """Ingest, cleanse each dataset, then enrich: unknown customers and products
    stay, with null attributes."""
    s = {name: quality.cleanse(df) for name, df in dirty.star(spark, sf_dir).items()}
    return enrich(s["transactions"], s["customers"], s["products"])


def q_dirty_enriched(spark, sf_dir):
    return publishable(_cleansed_enriched(spark, sf_dir), digits=6)


def q_dirty_executive_totals(spark, sf_dir):
    return publishable(summary.executive_totals(_cleansed_enriched(spark, sf_dir)))


# --- text files with bad records ----------------------------------------------------
# Records of a thousand: a price that is no number, a record that is cut off, no key.
BAD_PRICE, CUT_OFF, NO_KEY = 30, 20, 15


def _product_records(spark, sf_dir):
    """Products with the columns of the registered schema, and which record is bad."""
    p = model.products(spark, sf_dir)
    key = F.col("product_id")
    return p.select(
        F.when(~dirty.hit(key, 23, NO_KEY), key.cast("string")).alias("product_id"), "product_name", "category",
        "subcategory", "brand", "price", "cost",
        F.date_add(F.lit("2000-01-01").cast("date"), (key % 3000).cast("int")).alias("launch_date"),
        dirty.hit(key, 21, BAD_PRICE).alias("bad_price"), dirty.hit(key, 22, CUT_OFF).alias("cut_off"))


def _parsed(spark, sf_dir, file_format):
    """All products written as text, one record a line, some of them bad, and read."""
    rows = _product_records(spark, sf_dir)
    fields = [F.col(c) for c in schemas.PRODUCTS.names]
    wrong = [F.lit("n/a").alias("price") if c == "price" else F.col(c) for c in schemas.PRODUCTS.names]
    line = F.to_csv if file_format == "csv" else F.to_json
    short = F.concat_ws(",", "product_id", "product_name") if file_format == "csv" else F.concat(
        F.lit('{"product_id":"'), F.coalesce("product_id", F.lit("")), F.lit('","price":'))
    text = F.when(F.col("cut_off"), short).when(F.col("bad_price"), line(F.struct(*wrong))).otherwise(
        line(F.struct(*fields)))
    path = scratch_path(spark, f"records-{file_format}")
    rows.select(text.alias("value")).write.text(path)
    return quarantine.read_with_quarantine(spark, path, schemas.PRODUCTS, file_format, keep_partial=True,
                                           header=False)


def q_csv_round_trip(spark, sf_dir):
    return publishable(_parsed(spark, sf_dir, "csv").rows, digits=6)


def q_json_round_trip(spark, sf_dir):
    return publishable(_parsed(spark, sf_dir, "json").rows, digits=6)


def _quarantined(spark, sf_dir, file_format):
    bad = _parsed(spark, sf_dir, file_format).quarantine
    kind = F.when(F.col("reason") == "missing key", "missing key").when(
        F.col("raw_record").contains("n/a"), "bad price").otherwise("cut off")
    return bad.groupBy("reason", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("source_file").contains("records-")).alias("with_file"),
        F.count_if(F.col("raw_record").isNotNull()).alias("with_text"),
        F.count("fields.product_name").alias("with_name"), F.count("fields.price").alias("with_price"))


def q_csv_quarantine(spark, sf_dir):
    return _quarantined(spark, sf_dir, "csv")


def q_json_quarantine(spark, sf_dir):
    return _quarantined(spark, sf_dir, "json")


# --- summary and catalog ---------------------------------------------------------
def q_executive_totals(spark, sf_dir):
    return publishable(summary.executive_totals(enriched(spark, sf_dir)))


def q_executive_summary(spark, sf_dir):
    return publishable(summary.executive_summary(summary.executive_totals(enriched(spark, sf_dir))))


def q_dataset_profile(spark, sf_dir):
    """Profiles of the star tables and the enriched table as they would be
    published (schema_json is left out of the compared columns)."""
    s = model.star(spark, sf_dir)
    frames = dict(s)
    frames["enriched_transactions"] = model.enriched(spark, sf_dir)
    parts = []
    for name, df in frames.items():
        zone, cols = PUBLISH_PLAN.get(name, ("raw", None))
        parts.append(dataset_profile(df, f"{zone}/{name}", "parquet", cols))
    return _union_all(parts).drop("schema_json")


REPUBLISHED_YEAR = 1995


def q_published_catalog(spark, sf_dir):
    """All tables published under the shared checkpoint folder, as their manifest,
    their footers and their digests describe them (bytes and files vary)."""
    root = scratch_path(spark, "published")
    publish.publish_all(spark, model.star(spark, sf_dir), root)
    return publish.published_catalog(spark, root).select(
        "dataset", "zone", "partitions", "record_count", "footer_rows", "data_versions", "verified")


def q_published_months(spark, sf_dir):
    """The enriched table published, republished by a run that never gets to its
    switch, and then with one year's amounts doubled in place of that year's
    partitions; read back by month."""
    root = scratch_path(spark, "published")
    zone, parts = PUBLISH_PLAN["enriched_transactions"]
    sales = enriched(spark, sf_dir)
    v = versions.new_version(spark, root)
    versions.switch(spark, root, v, [versions.stage(sales, root, zone, "enriched_transactions", v, parts)])
    sales = versions.read_current(spark, root, "enriched_transactions")
    doubled = sales.withColumn("total_amount", F.col("total_amount") * 2.0)
    versions.stage(doubled, root, zone, "enriched_transactions", versions.new_version(spark, root), parts)
    v = versions.new_version(spark, root)
    year = versions.stage(doubled.filter(F.col("year") == REPUBLISHED_YEAR), root, zone, "enriched_transactions",
                          v, parts)
    versions.switch(spark, root, v, [year], replace="partitions")
    back = versions.read_current(spark, root, "enriched_transactions")
    return publishable(back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("transactions"), money_sum("total_amount").alias("revenue"),
        F.max("transaction_date").alias("latest")))


def q_bucketed_status_totals(spark, sf_dir):
    """Transactions by status and year over the bucketed fact tables."""
    stored = model.store_bucketed(spark, sf_dir, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tx = model.bucketed_transactions(spark, stored)
    return publishable(tx.groupBy("status", F.year("transaction_date").alias("year")).agg(
        F.count(F.lit(1)).alias("transactions"), money_sum("total_amount").alias("revenue"),
        F.count_distinct("customer_id").alias("customers")))


def q_bucketed_enriched(spark, sf_dir):
    """The enriched table, its fact join over the bucketed tables."""
    stored = model.store_bucketed(spark, sf_dir, int(spark.conf.get("spark.sql.shuffle.partitions")))
    codes = [k for k, v in rules.STATUS_NAMES.items() if v == rules.COMPLETED]
    tx = model.bucketed_transactions(spark, stored, codes)
    return publishable(enrich(tx, model.customers(spark, sf_dir), model.products(spark, sf_dir)), digits=6)


# --- error logs ------------------------------------------------------------------
def q_log_severity(spark, sf_dir):
    return logs.log_severity(model.logs(spark, sf_dir))


def q_log_alerts(spark, sf_dir):
    return logs.log_alerts(logs.log_severity(model.logs(spark, sf_dir)))


def q_log_summary(spark, sf_dir):
    return logs.log_summary(logs.log_severity(model.logs(spark, sf_dir)))


def q_log_trend(spark, sf_dir):
    return logs.log_trend(logs.log_severity(model.logs(spark, sf_dir)))


def registry() -> dict[str, QueryFn]:
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}
