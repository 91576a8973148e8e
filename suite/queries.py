"""The registered queries: every operator on whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contract import CONTRACT_SCHEMA, CONTRACT_COLUMNS, read_contract, write_contract
from martflow.operators.keys import surrogate_keys
from martflow.operators import casting, dedupe, normalize, nulls, outliers, profile, quality
from martflow.operators.joins import expand_join, lookup_join
from martflow.plans import mart as marts
from martflow.plans import measures, run, star
from martflow.plans.recipes import Setting, cleanse_tables, prefix_tables
from martflow.sources import catalog
from martflow.sources.landing import cast_tables, load_landing, scan_landing, table_counts
from martflow.sources.layers import DATA_MART, INFO_MART, LANDING, STAGE2, Layers
from martflow.sources.lookups import date_lookup_for
from martflow.sources.workdir import run_folder
from suite import standins
from suite.standins import CONTRACT, RAW_CONTRACT, stand_in, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Chosen so that both outcomes of a flag and of an outlier test occur.
THRESHOLDS = marts.Thresholds(high_value=1_000_000, frequent=40)
Z_LINES = 1.5


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- inputs ------------------------------------------------------------------


def stage1(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return prefix_tables(standins.sources(spark, sf_dir))


def the_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return star.build_star(
        stage1(spark, sf_dir), standins.CALENDAR, standins.statuses(spark)
    )


FACT_ALONE = "fact"


def the_mart(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    """The mart with the parts named, all where none is; FACT_ALONE joins nothing."""
    named = [p for p in parts if p != FACT_ALONE] if parts else marts.PARTS
    return marts.build_mart(
        the_star(spark, sf_dir), THRESHOLDS, named, calendar=standins.CALENDAR
    )


def the_setting(spark: SparkSession) -> Setting:
    return Setting(
        CONTRACT,
        postal=standins.postal_codes(spark),
        int_type="bigint",
        z_threshold=Z_LINES,
        calendar=standins.WIDE_CALENDAR,
    )


def new_layers(spark: SparkSession, name: str) -> Layers:
    return Layers(run_folder(spark, name))


def new_database(spark: SparkSession, layers: Layers) -> str:
    database = f"retail_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, f"{layers.root}/managed")
    return database


def landed(spark: SparkSession, sf_dir: str, name: str) -> Layers:
    layers = new_layers(spark, name)
    layers.write_all(standins.sources(spark, sf_dir), LANDING)
    return layers


def stored_star(spark: SparkSession, sf_dir: str, name: str) -> tuple[Layers, str]:
    layers = new_layers(spark, name)
    layers.write_all(the_star(spark, sf_dir), INFO_MART)
    database = new_database(spark, layers)
    catalog.register_tables(spark, layers, database, run.STAR_TABLES)
    return layers, database


# --- sources -----------------------------------------------------------------


@query
def contract_columns(spark, sf_dir):
    """The contract as read from its file, with what each landed column holds."""
    layers = landed(spark, sf_dir, "contract")
    path = f"{layers.root}/contract"
    write_contract(spark, CONTRACT, path)
    contract = read_contract(spark, path)
    raw = scan_landing(spark, layers, contract)
    report = None
    for name in contract.tables:
        part = casting.cast_report(raw[name], contract.table(name), name, "bigint")
        report = part if report is None else report.unionByName(part)
    rules = spark.createDataFrame(
        [tuple(getattr(r, c) for c in CONTRACT_COLUMNS) for r in contract.rules], CONTRACT_SCHEMA
    ).select(
        F.col("source_table").alias("table_name"),
        F.col("table_columns").alias("column_name"),
        "datatype",
        "nullable",
        F.col("unique").alias("is_unique"),
        "primary_key",
    )
    return rules.join(report.drop("target"), ["table_name", "column_name"])


@query
def ingest_landing_counts(spark, sf_dir):
    return table_counts(load_landing(spark, landed(spark, sf_dir, "ingest"), CONTRACT, "bigint"))


@query
def lookup_date(spark, sf_dir):
    """The calendar that spans every date of the orders, stored and read back."""
    layers = new_layers(spark, "lookup")
    orders = stand_in(spark, sf_dir, "orders")
    dates = date_lookup_for(orders, ["order_date", "required_date", "shipped_date"])
    layers.write(dates, STAGE2, run.DATE_LOOKUP)
    return layers.read(spark, STAGE2, run.DATE_LOOKUP)


@query
def lookup_status(spark, sf_dir):
    """The status lookup, stored and read back, with the orders in each status."""
    layers = new_layers(spark, "lookup")
    layers.write(standins.statuses(spark), STAGE2, run.STATUS_LOOKUP)
    counts = (
        stand_in(spark, sf_dir, "orders")
        .groupBy(F.col("order_status").alias("status_id"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    statuses = layers.read(spark, STAGE2, run.STATUS_LOOKUP)
    return statuses.join(counts, "status_id", "left").na.fill({"orders": 0})


# --- sinks, catalog, publication ----------------------------------------------


@query
def sink_overwrite_idempotent(spark, sf_dir):
    layers = new_layers(spark, "sink")
    customers = star.plain_dim(stage1(spark, sf_dir)["customers"])
    layers.write(customers.drop("customers_email"), INFO_MART, "customers_dim")
    for _ in range(2):
        layers.write(customers, INFO_MART, "customers_dim")
    return layers.read(spark, INFO_MART, "customers_dim")


@query
def catalog_register_list(spark, sf_dir):
    _, database = stored_star(spark, sf_dir, "catalog")
    names = catalog.registered_tables(spark, database)
    return table_counts({n: catalog.scan_table(spark, database, n) for n in names})


@query
def catalog_scan_dim(spark, sf_dir):
    _, database = stored_star(spark, sf_dir, "catalog")
    return spark.sql(f"SELECT * FROM `{database}`.products_dim")


@query
def publish_mart(spark, sf_dir):
    layers, database = stored_star(spark, sf_dir, "publish")
    stored = {n: catalog.scan_table(spark, database, n) for n in run.STAR_TABLES}
    mart = catalog.create_managed(
        marts.build_mart(stored, THRESHOLDS), database, run.MART_TABLE
    )
    location = layers.path(DATA_MART, run.MART_TABLE)
    catalog.publish_external(mart, database, run.PUBLISHED_TABLE, location)
    return catalog.publish_external(mart, database, run.PUBLISHED_TABLE, location)


@query
def publish_schema_merge(spark, sf_dir):
    """Publish without e-mails, then with e-mails but without phones."""
    layers = new_layers(spark, "merge")
    database = new_database(spark, layers)
    customers = star.plain_dim(stage1(spark, sf_dir)["customers"])
    location = layers.path(DATA_MART, "customers")
    for gone in ("customers_email", "customers_phone"):
        published = catalog.publish_external(
            customers.drop(gone), database, "customers", location
        )
    return published


# --- casting and projection ---------------------------------------------------


def raw_tables(spark, sf_dir):
    return {name: stand_in(spark, sf_dir, name) for name in RAW_CONTRACT.tables}


@query
def cast_contract(spark, sf_dir):
    return cast_tables(raw_tables(spark, sf_dir), RAW_CONTRACT)["raw_orders"]


@query
def cast_failures(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    customers, orders = (
        casting.cast_report(raw[name], RAW_CONTRACT.table(name), name)
        for name in ("raw_customers", "raw_orders")
    )
    return customers.unionByName(orders)


@query
def recast_after_cleanse(spark, sf_dir):
    """Markers become NULL while columns are text; the cast then loses no value."""
    cleansed = nulls.cleanse_nulls(
        stand_in(spark, sf_dir, "raw_customers"), RAW_CONTRACT, "raw_customers", ["x1"]
    )
    return cast_tables({"raw_customers": cleansed}, RAW_CONTRACT)["raw_customers"]


@query
def rename_prefixed(spark, sf_dir):
    return casting.prefix_shared_columns(stand_in(spark, sf_dir, "customers"), "customers")


@query
def drop_audit_columns(spark, sf_dir):
    return casting.drop_audit_columns(stand_in(spark, sf_dir, "stores"))


@query
def mart_columns(spark, sf_dir):
    """The columns of the mart and the NULLs in each."""
    return profile.null_counts(the_mart(spark, sf_dir))


# --- missing values, duplicates, outliers -------------------------------------


@query
def nulls_flag_to_null(spark, sf_dir):
    return nulls.markers_to_null(stand_in(spark, sf_dir, "customers"))


@query
def nulls_fill(spark, sf_dir):
    customers = nulls.markers_to_null(stand_in(spark, sf_dir, "customers"))
    return nulls.fill_missing(customers, ["phone", "email"])


@query
def nulls_drop_required(spark, sf_dir):
    customers = nulls.markers_to_null(stand_in(spark, sf_dir, "customers"))
    return nulls.drop_missing(customers, ["phone", "email"])


@query
def cleanse_nulls_customers(spark, sf_dir):
    return nulls.cleanse_nulls(stand_in(spark, sf_dir, "customers"), CONTRACT, "customers")


@query
def dedupe_single_key(spark, sf_dir):
    return dedupe.dedupe(table(spark, sf_dir, "part"), "p_name", order_by=["p_partkey"])


@query
def dedupe_chain(spark, sf_dir):
    return dedupe.dedupe_chain(table(spark, sf_dir, "part"), ["p_name", "p_size"])


@query
def dedupe_composite_key(spark, sf_dir):
    return dedupe.dedupe(stand_in(spark, sf_dir, "order_items"), ["order_id", "item_id"])


@query
def dup_groups(spark, sf_dir):
    return quality.key_duplicates(table(spark, sf_dir, "part"), ["p_name"])


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value")


@query
def outlier_iqr_bounds(spark, sf_dir):
    """Fences of the values, and how many of them lie on either side."""
    values = events(spark, sf_dir)
    low, high = outliers.iqr_fences(values, "value")
    return values.agg(
        F.lit(low).alias("low"),
        F.lit(high).alias("high"),
        F.count_if(F.col("value") < low).alias("below"),
        F.count_if(F.col("value") > high).alias("above"),
    )


@query
def outlier_iqr_remove(spark, sf_dir):
    return outliers.handle_outliers(events(spark, sf_dir), "value", "iqr", "remove")


@query
def outlier_iqr_cap(spark, sf_dir):
    return outliers.handle_outliers(events(spark, sf_dir), "value", "iqr", "cap")


@query
def outlier_z_bounds(spark, sf_dir):
    stats = outliers.zscore_stats(events(spark, sf_dir), "value")
    return stats.select("n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@query
def outlier_z_remove(spark, sf_dir):
    return outliers.handle_outliers(events(spark, sf_dir), "value", "zscore", "remove")


@query
def outlier_z_cap(spark, sf_dir):
    capped = outliers.handle_outliers(events(spark, sf_dir), "value", "zscore", "cap")
    return capped.withColumn("value", F.round("value", 6))


@query
def outlier_z_chain(spark, sf_dir):
    lines = casting.drop_audit_columns(stand_in(spark, sf_dir, "order_items"))
    columns = ["list_price", "quantity", "discount"]
    return outliers.remove_outliers_chain(lines, columns, Z_LINES)


# --- contact columns ----------------------------------------------------------


@query
def normalize_strip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", normalize.strip_specials(F.col("text")).alias("text"))


def _contact(spark, sf_dir, column):
    customers = stand_in(spark, sf_dir, "customers").select("customer_id", column)
    return normalize.normalize_contacts(customers, [column])


@query
def normalize_email(spark, sf_dir):
    return _contact(spark, sf_dir, "email")


@query
def normalize_phone(spark, sf_dir):
    return _contact(spark, sf_dir, "phone")


@query
def normalize_zip(spark, sf_dir):
    return _contact(spark, sf_dir, "zip_code")


@query
def normalize_contract(spark, sf_dir):
    """All contact columns that the contract lists, not valid ones flagged."""
    tables = {"customers": stand_in(spark, sf_dir, "customers")}
    columns = {"customers": [r.table_columns for r in CONTRACT.table("customers")]}
    return normalize.normalize_tables(tables, columns, "flag")["customers"]


@query
def normalize_reject_counts(spark, sf_dir):
    customers, stores = (
        normalize.contact_rejects(stand_in(spark, sf_dir, n), n) for n in ("customers", "stores")
    )
    return customers.unionByName(stores)


# --- quality ------------------------------------------------------------------


@query
def pk_nulls(spark, sf_dir):
    return quality.key_nulls(stand_in(spark, sf_dir, "customers"), ["customer_id", "phone"])


@query
def pk_duplicates(spark, sf_dir):
    return quality.key_duplicates(stand_in(spark, sf_dir, "order_items"), ["order_id"])


@query
def pk_composite_duplicates(spark, sf_dir):
    return quality.key_duplicates(
        stand_in(spark, sf_dir, "order_items"), ["order_id", "item_id"]
    )


@query
def pk_bad_type(spark, sf_dir):
    orders = stand_in(spark, sf_dir, "raw_orders")
    rule = RAW_CONTRACT.primary_key("raw_orders")[0]
    return orders.agg(
        F.count(F.lit(1)).alias("rows"),
        quality.key_type_failures(orders, rule).alias("bad_rows"),
    )


@query
def pk_report(spark, sf_dir):
    cleansed = standins.sources(spark, sf_dir)
    return quality.pk_report(cleansed, CONTRACT, "bigint")


@query
def zip_valid(spark, sf_dir):
    return quality.valid_postal_codes(
        stand_in(spark, sf_dir, "customers"), "zip_code", standins.postal_codes(spark)
    )


@query
def zip_rejects(spark, sf_dir):
    return quality.rejected_postal_codes(
        stand_in(spark, sf_dir, "customers"), "zip_code", standins.postal_codes(spark)
    )


@query
def fact_store_check(spark, sf_dir):
    """Fact rows with the name of their store; rows without a store drop out."""
    built = the_star(spark, sf_dir)
    stores = built["stores_dim"].select("store_id", "store_name")
    return lookup_join(built[star.FACT], stores, "store_id", how="inner")


@query
def fk_orphans(spark, sf_dir):
    """References of the fact, customers being those with a known postal code."""
    tables = standins.sources(spark, sf_dir)
    known = quality.valid_postal_codes(
        tables["customers"], "zip_code", standins.postal_codes(spark)
    )
    fact = star.order_fact(tables["orders"], tables["order_items"], standins.CALENDAR)
    return quality.orphan_report(
        fact,
        {
            "customer_id": ("customers", known, "customer_id"),
            "product_id": ("products", tables["products"], "product_id"),
            "store_id": ("stores", tables["stores"], "store_id"),
            "staff_id": ("staffs", tables["staffs"], "staff_id"),
            "order_status": ("statuses", standins.statuses(spark), "status_id"),
        },
    )


@query
def udf_batch_predicate(spark, sf_dir):
    """Documents that a pandas predicate finds an e-mail address in."""

    def has_address(texts: pd.Series) -> pd.Series:
        return texts.str.contains(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", regex=True)

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.filter_by_batch_predicate(documents, "text", has_address)


@query
def cleanse_audit(spark, sf_dir):
    """Rows after each step of all recipes, as counted by the run that wrote Staging 1."""
    layers = landed(spark, sf_dir, "audit")
    return run.run_cleanse(spark, layers, the_setting(spark)).steps


@query
def key_gate_raw(spark, sf_dir):
    """Raw orders through the gate of their key: rows that pass without a reason, rejects with one."""
    kept, rejects = quality.split_by_key(
        stand_in(spark, sf_dir, "raw_orders"), RAW_CONTRACT.primary_key("raw_orders")
    )
    return kept.withColumn(quality.REASON, F.lit(None).cast("string")).unionByName(rejects)


def loose_run(spark, sf_dir, name):
    setting = replace(the_setting(spark), contract=standins.LOOSE_CONTRACT)
    layers = landed(spark, sf_dir, name)
    return run.run_cleanse(spark, layers, setting, list(standins.LOOSE_TABLES))


@query
def run_key_gate(spark, sf_dir):
    """Per table of a run with loose keys: rows that reached the gate, that passed it, and rejects by reason."""
    done = loose_run(spark, sf_dir, "gate")
    last = F.max_by("rows", "step_no").cast("bigint").alias("reached")
    report = done.steps.groupBy("table_name").agg(last)
    parts = []
    for name, kept in done.tables.items():
        passed = kept.agg(F.count(F.lit(1)).alias("passed"))
        reasons = [
            F.count_if(F.col(quality.REASON) == r).alias(f"rejected_{r}")
            for r in (quality.NULL_KEY, quality.BAD_TYPE, quality.DUPLICATE)
        ]
        found = done.rejects[name].agg(*reasons)
        named = F.lit(name).alias("table_name")
        parts.append(
            passed.select(named, "passed").join(found.select(named, "*"), "table_name")
        )
    return report.join(reduce(DataFrame.unionByName, parts), "table_name")


@query
def run_rejects(spark, sf_dir):
    """The orders that the gate of a run with loose keys sets aside."""
    return loose_run(spark, sf_dir, "rejects").rejects["orders"]


@query
def run_key_report(spark, sf_dir):
    """Key checks of a run with loose keys, on what reached the gate."""
    return loose_run(spark, sf_dir, "keys").keys


# --- profiling ----------------------------------------------------------------


@query
def profile_schema(spark, sf_dir):
    return profile.schema_listing(stand_in(spark, sf_dir, "customers"))


@query
def profile_describe(spark, sf_dir):
    orders = casting.drop_audit_columns(stand_in(spark, sf_dir, "orders"))
    found = profile.describe(orders)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@query
def profile_nulls(spark, sf_dir):
    return profile.null_counts(stand_in(spark, sf_dir, "orders"))


@query
def profile_duplicates(spark, sf_dir):
    """Lines that are equal but for their prices."""
    lines = table(spark, sf_dir, "lineitem")
    return profile.duplicate_rows(lines.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query
def profile_duplicates_hashed(spark, sf_dir):
    """Equal order items but for the item's number and price, found by way of their hashes;
    and equal lines in all columns of the table."""
    lines = table(spark, sf_dir, "lineitem")
    some = profile.duplicate_rows(lines.select("l_orderkey", "l_returnflag", "l_linestatus"), 0)
    whole = profile.duplicate_rows(lines, 0)
    return some.select(F.lit("some").alias("columns"), "*").unionByName(
        whole.select(F.lit("all").alias("columns"), "*")
    )


@query
def profile_distribution(spark, sf_dir):
    return profile.distribution(table(spark, sf_dir, "part"), "p_name")


@query
def profile_topk(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"), "p_name")


@query
def profile_text_distributions(spark, sf_dir):
    return profile.distributions(stand_in(spark, sf_dir, "customers"))


@query
def profile_histogram(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select("value", "ts", "user_id")
    return profile.histograms(lines)


@query
def profile_all(spark, sf_dir):
    """The whole profile of all source tables."""
    found = profile.profile_tables(standins.sources(spark, sf_dir))
    # means of hundredths lie on ties of the sixth place
    mean = F.when(F.col("finding") == "mean", F.round("value", 7))
    return found.withColumn("value", mean.otherwise(F.round("value", 6)))


@query
def profile_distinct(spark, sf_dir):
    return profile.distinct_counts(stand_in(spark, sf_dir, "customers"))


# --- star ---------------------------------------------------------------------


def _stored_dim(spark, sf_dir, name):
    layers = new_layers(spark, "dim")
    layers.write(the_star(spark, sf_dir)[name], INFO_MART, name)
    return layers.read(spark, INFO_MART, name)


@query
def dim_customers(spark, sf_dir):
    return _stored_dim(spark, sf_dir, "customers_dim")


@query
def dim_staffs(spark, sf_dir):
    return _stored_dim(spark, sf_dir, "staffs_dim")


@query
def dim_stores(spark, sf_dir):
    return _stored_dim(spark, sf_dir, "stores_dim")


@query
def dim_status(spark, sf_dir):
    """The status dimension with the fact rows that refer to each status."""
    built = the_star(spark, sf_dir)
    counts = built[star.FACT].groupBy(F.col("order_status").alias("status_id")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return built["status_dim"].join(counts, "status_id", "left").na.fill({"rows": 0})


@query
def dim_date(spark, sf_dir):
    """Calendar columns of every day that the orders span."""
    orders = stand_in(spark, sf_dir, "orders")
    dates = date_lookup_for(orders, ["order_date", "required_date", "shipped_date"])
    return star.date_dim(dates)


@query
def dim_products(spark, sf_dir):
    return _stored_dim(spark, sf_dir, "products_dim")


@query
def fact_order(spark, sf_dir):
    return _stored_dim(spark, sf_dir, star.FACT)


@query
def fact_orders_without_lines(spark, sf_dir):
    fact = the_star(spark, sf_dir)[star.FACT]
    return fact.filter(F.col("product_id").isNull())


@query
def fact_uncovered_dates(spark, sf_dir):
    return star.uncovered_dates(stand_in(spark, sf_dir, "orders"), standins.CALENDAR)


@query
def surrogate_key_brands(spark, sf_dir):
    return surrogate_keys(table(spark, sf_dir, "part"), ["p_brand"], "brand_key")


@query
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


# --- joins --------------------------------------------------------------------


@query
def join_left_order_lines(spark, sf_dir):
    orders = stand_in(spark, sf_dir, "orders").select("order_id", "customer_id")
    lines = stand_in(spark, sf_dir, "order_items").select("order_id", "item_id", "list_price")
    return expand_join(orders, lines, "order_id")


@query
def join_date_roles(spark, sf_dir):
    orders = casting.drop_audit_columns(stand_in(spark, sf_dir, "orders"))
    return star.with_date_ids(orders, standins.CALENDAR)


@query
def join_full_outer_products(spark, sf_dir):
    lines = stand_in(spark, sf_dir, "order_items").select("order_id", "product_id", "quantity")
    products = stand_in(spark, sf_dir, "products").select("product_id", "product_name")
    return marts.full_join_products(lines, products)


# --- mart ---------------------------------------------------------------------


@query
def mart_sales(spark, sf_dir):
    return the_mart(spark, sf_dir)


@query
def mart_revenue(spark, sf_dir):
    mart = the_mart(spark, sf_dir, "products")
    return mart.select("order_id", "product_id", *marts.revenue_columns())


@query
def mart_delays(spark, sf_dir):
    mart = the_mart(spark, sf_dir, "dates")
    dates = ("ordered_date", "required_date", "shipped_date")
    return mart.select("order_id", *dates, *marts.delay_columns()).distinct()


@query
def mart_flags(spark, sf_dir):
    mart = the_mart(spark, sf_dir)
    return mart.groupBy(*marts.flag_columns(THRESHOLDS)).agg(F.count(F.lit(1)).alias("rows"))


@query
def mart_frequent_customer(spark, sf_dir):
    """Customers above the default of five lines and above forty, by both counts."""
    fact = the_star(spark, sf_dir)[star.FACT]
    lines = marts.customer_order_counts(fact, "lines").withColumnRenamed("rows", "lines")
    orders = marts.customer_order_counts(fact, "orders").withColumnRenamed("rows", "orders")
    counts = lines.join(orders, "customer_id")
    for limit in (5, 40):
        for by in ("lines", "orders"):
            frequent = marts.frequent_customers(fact, limit, by).select(
                "customer_id", F.lit(1).alias(f"over_{limit}_{by}")
            )
            counts = counts.join(frequent, "customer_id", "left")
    return counts.na.fill(0)


@query
def mart_unsold_products(spark, sf_dir):
    built = the_star(spark, sf_dir)
    return marts.unsold_products(built[star.FACT], built["products_dim"])


# --- measures -----------------------------------------------------------------

_MEASURES = {
    "kpi_sales_totals": (measures.sales_totals, (FACT_ALONE,)),
    "kpi_aov_quarter": (measures.aov_by_quarter, ("dates",)),
    "kpi_revenue_quarter": (measures.revenue_by_quarter, ("dates",)),
    "kpi_discount_impact": (measures.discount_impact, (FACT_ALONE,)),
    "kpi_brand_loyalty": (measures.brand_loyalty, ("products",)),
    "kpi_customers_total": (measures.customers_total, (FACT_ALONE,)),
    "kpi_customer_value": (measures.customer_value, ("dates",)),
    "kpi_clv": (
        lambda mart: measures.customer_lifetime_value(mart).select(
            F.round("mean_value", 2).alias("mean_value"),
            F.round("mean_years", 4).alias("mean_years"),
            F.round("clv", 2).alias("clv"),
        ),
        ("dates",),
    ),
    "kpi_retention_rate": (measures.retention_rate, ("dates",)),
    "kpi_retention_yoy": (measures.retention_by_year, ("dates",)),
    "kpi_acquisition": (measures.customer_acquisition, ("dates",)),
    "kpi_value_over_time": (measures.value_over_time, ("dates",)),
}


# Summed by product before the products are joined.
_PRODUCT_MEASURES = {
    "kpi_product_top": measures.top_selling_product,
    "kpi_product_max_qty": measures.highest_quantity_product,
    "kpi_product_least": measures.least_selling_product,
    "kpi_qty_product": measures.quantity_by_product,
    "kpi_revenue_product": measures.revenue_by_product,
    "kpi_revenue_category": measures.revenue_by_category,
}


_STATE_MEASURES = {
    "kpi_revenue_state": (measures.revenue_by_state, (FACT_ALONE,)),
    "kpi_customer_distribution": (measures.customer_distribution, ("dates",)),
    "kpi_retention_state": (
        lambda mart, customers: measures.retention_by_state(mart, customers, min_orders=10),
        ("dates",),
    ),
    "kpi_retention_state_twice": (measures.retention_by_state, ("dates",)),
}


def _measure(measure, parts) -> Query:
    return lambda spark, sf_dir: measure(the_mart(spark, sf_dir, *parts))


def _product_measure(measure) -> Query:
    def run_measure(spark, sf_dir):
        products = the_star(spark, sf_dir)["products_dim"].drop("list_price")
        return measure(the_mart(spark, sf_dir, FACT_ALONE), products)

    return run_measure


def _state_measure(measure, parts) -> Query:
    def run_measure(spark, sf_dir):
        customers = star.plain_dim(stage1(spark, sf_dir)["customers"])
        return measure(the_mart(spark, sf_dir, *parts), customers)

    return run_measure


QUERIES.update({name: _measure(*entry) for name, entry in _MEASURES.items()})
QUERIES.update({name: _product_measure(measure) for name, measure in _PRODUCT_MEASURES.items()})
QUERIES.update({name: _state_measure(*entry) for name, entry in _STATE_MEASURES.items()})


# --- recipes and whole runs ---------------------------------------------------


def _cleansed(spark, sf_dir, name):
    tables = {name: stand_in(spark, sf_dir, name)}
    return cleanse_tables(tables, the_setting(spark))[name]


@query
def cleanse_customers(spark, sf_dir):
    return _cleansed(spark, sf_dir, "customers")


@query
def cleanse_order_items(spark, sf_dir):
    return _cleansed(spark, sf_dir, "order_items")


@query
def cleanse_stores(spark, sf_dir):
    return _cleansed(spark, sf_dir, "stores")


@query
def cleanse_categories(spark, sf_dir):
    return _cleansed(spark, sf_dir, "categories")


@query
def cleanse_staffs(spark, sf_dir):
    return _cleansed(spark, sf_dir, "staffs")


@query
def cleanse_orders(spark, sf_dir):
    return _cleansed(spark, sf_dir, "orders")


@query
def cleanse_brands(spark, sf_dir):
    return _cleansed(spark, sf_dir, "brands")


@query
def cleanse_products(spark, sf_dir):
    return _cleansed(spark, sf_dir, "products")


@query
def run_stage1_counts(spark, sf_dir):
    layers = landed(spark, sf_dir, "stage1")
    return table_counts(run.run_cleanse(spark, layers, the_setting(spark)).tables)


@query
def run_mart_counts(spark, sf_dir):
    """Everything from landing files to the published mart, then its totals."""
    layers = landed(spark, sf_dir, "run")
    database = new_database(spark, layers)
    mart = run.run_all(spark, layers, the_setting(spark), database, THRESHOLDS).mart
    return mart.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("order_id").alias("order_rows"),
        F.count("product_id").alias("product_rows"),
        F.count("ordered_date").alias("dated_rows"),
        F.count("store_name").alias("store_rows"),
        F.sum("fulfilled_order_flag").alias("fulfilled"),
        F.sum("high_value_order_flag").alias("high_value"),
        F.sum("frequent_customer_flag").alias("frequent"),
        measures.money(measures.NET).alias("revenue"),
    )
