"""Report measures on the sales mart.

Money is summed as exact decimals, so a total does not depend on the order in
which partitions arrive. Rows without an order (unsold products) only count where
a measure is about products. Every measure is an aggregate with partial sums
before the shuffle; distinct orders are counted per (group, order) first, which
spreads a group that holds much of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NET = "revenue_after_discount"
GROSS = "revenue_per_product"

# Fixed value: days of a year of customer activity.
YEAR_DAYS = 365.0


def money(column: str) -> Column:
    return exact_sum(column).cast("double")


def exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(18,4)"))


def _orders() -> Column:
    return F.count_distinct("order_id")


def _sales(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("order_id").isNotNull())


def _quotient(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _share(part: str, whole: str) -> Column:
    return _quotient(F.col(part), F.col(whole))


def _by_quarter(mart: DataFrame):
    return _sales(mart).groupBy(
        F.year("ordered_date").alias("year"), F.quarter("ordered_date").alias("quarter")
    )


# --- sales -------------------------------------------------------------------


def sales_totals(mart: DataFrame) -> DataFrame:
    totals = _sales(mart).agg(
        money(NET).alias("revenue"),
        F.sum("quantity").alias("quantity"),
        _orders().alias("orders"),
    )
    return totals.withColumn("aov", _share("revenue", "orders"))


def aov_by_quarter(mart: DataFrame) -> DataFrame:
    totals = _by_quarter(mart).agg(money(NET).alias("revenue"), _orders().alias("orders"))
    return totals.select("year", "quarter", "orders", _share("revenue", "orders").alias("aov"))


def revenue_by_quarter(mart: DataFrame) -> DataFrame:
    return _by_quarter(mart).agg(money(NET).alias("revenue"))


def revenue_by_state(mart: DataFrame, customers: DataFrame) -> DataFrame:
    """Summed per customer first, so that the state is joined to a row per customer."""
    net = F.sum(F.col(NET).cast("decimal(18,4)")).alias("net")
    totals = with_state(_sales(mart).groupBy("customer_id").agg(net), customers)
    return totals.groupBy("customers_state").agg(F.sum("net").cast("double").alias("revenue"))


def discount_impact(mart: DataFrame) -> DataFrame:
    """Per discount: lines, gross, net, what was given away and its share."""
    lines = _sales(mart).filter(F.col("discount").isNotNull())
    totals = lines.groupBy("discount").agg(
        F.count(F.lit(1)).alias("lines"), money(GROSS).alias("gross"), money(NET).alias("net")
    )
    given = totals.withColumn("given_away", F.col("gross") - F.col("net"))
    return given.withColumn("given_share", _share("given_away", "gross"))


# --- products ----------------------------------------------------------------


def quantity_by_product(mart: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Quantity per product; zero for products without sales."""
    return _by_product(mart, products, F.sum("quantity")).select(
        "product_id", "product_name", F.coalesce("total", F.lit(0)).cast("bigint").alias("quantity")
    )


def revenue_by_product(mart: DataFrame, products: DataFrame | None = None) -> DataFrame:
    return _by_product(mart, products, exact_sum(NET)).select(
        "product_id", "product_name", F.coalesce(F.col("total").cast("double"), F.lit(0.0)).alias("revenue")
    )


def top_selling_product(mart: DataFrame, products: DataFrame | None = None) -> DataFrame:
    return revenue_by_product(mart, products).orderBy(F.desc("revenue"), "product_id").limit(1)


def highest_quantity_product(mart: DataFrame, products: DataFrame | None = None) -> DataFrame:
    return quantity_by_product(mart, products).orderBy(F.desc("quantity"), "product_id").limit(1)


def least_selling_product(mart: DataFrame, products: DataFrame | None = None) -> DataFrame:
    return quantity_by_product(mart, products).orderBy("quantity", "product_id").limit(1)


def brand_loyalty(mart: DataFrame, min_orders: int = 2) -> DataFrame:
    """Per brand, the share of its customers with several orders of the brand."""
    bought = _sales(mart).filter(F.col("brand_name").isNotNull() & F.col("customer_id").isNotNull())
    per_customer = bought.groupBy("brand_name", "customer_id").agg(_orders().alias("orders"))
    return _retained(per_customer.groupBy("brand_name"), min_orders)


def revenue_by_category(mart: DataFrame, products: DataFrame | None = None) -> DataFrame:
    sold = _sales(mart).filter(F.col("product_id").isNotNull())
    if products is not None:
        totals = sold.groupBy("product_id").agg(exact_sum(NET).alias("total"))
        return totals.join(products, "product_id").groupBy("category_name").agg(
            F.sum("total").cast("double").alias("revenue")
        )
    return sold.groupBy("category_name").agg(money(NET).alias("revenue"))


def _by_product(mart: DataFrame, products: DataFrame | None, total: Column) -> DataFrame:
    """``total`` per known product, sold or not.

    A mart without products is summed by their ids first, so that ``products`` meet a row per product, not
    one per line. The join keeps products without sales and drops ids that no product has.
    """
    if products is not None:
        sums = mart.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(total.alias("total"))
        mart, total = sums.join(products, "product_id", "right"), F.sum("total")
    known = mart.filter(F.col("product_id").isNotNull())
    return known.groupBy("product_id", "product_name").agg(total.alias("total"))


# --- customers ---------------------------------------------------------------


def customer_summary(mart: DataFrame) -> DataFrame:
    """One row per customer with an order."""
    known = _sales(mart).filter(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(
        _orders().alias("orders"),
        F.coalesce(money(NET), F.lit(0.0)).alias("revenue"),
        F.min("ordered_date").alias("first_order"),
        F.max("ordered_date").alias("last_order"),
    )


def with_state(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """The state of each customer; both sides have a row per customer."""
    return per_customer.join(customers.select("customer_id", "customers_state"), "customer_id", "left")


def customers_total(mart: DataFrame) -> DataFrame:
    return _sales(mart).agg(F.count_distinct("customer_id").alias("customers"))


def customer_value(mart: DataFrame) -> DataFrame:
    """Net revenue per year of activity, a year at least."""
    years = F.datediff("last_order", "first_order") / F.lit(YEAR_DAYS)
    active = customer_summary(mart).withColumn("active_years", years)
    value = F.col("revenue") / F.greatest(F.lit(1.0), "active_years")
    return active.select(
        "customer_id", "revenue", "first_order", "last_order", "active_years", value.alias("value")
    )


def customer_lifetime_value(mart: DataFrame) -> DataFrame:
    """Mean customer value times mean years of activity, both from exact sums."""
    value = F.col("value").cast("decimal(28,6)")
    days = F.datediff("last_order", "first_order")
    means = customer_value(mart).agg(
        _quotient(F.sum(value), F.count("value")).alias("mean_value"),
        (_quotient(F.sum(days), F.count(days)) / F.lit(YEAR_DAYS)).alias("mean_years"),
    )
    return means.withColumn("clv", F.col("mean_value") * F.col("mean_years"))


def retention_rate(mart: DataFrame, min_orders: int = 2) -> DataFrame:
    return _retained(customer_summary(mart).groupBy(), min_orders)


def retention_by_state(mart: DataFrame, customers: DataFrame, min_orders: int = 2) -> DataFrame:
    return _retained(_summary_with_state(mart, customers).groupBy("customers_state"), min_orders)


def retention_by_year(mart: DataFrame) -> DataFrame:
    """Of the customers active in a year, how many are in the next one too.

    Every active year is also noted as the year before the next; one group-by
    per customer and year then shows both, without joining customers to themselves.
    """
    active = (
        _sales(mart)
        .filter(F.col("customer_id").isNotNull() & F.col("ordered_date").isNotNull())
        .select("customer_id", F.year("ordered_date").alias("year"))
    )
    noted = active.select(
        "customer_id",
        F.inline(
            F.array(
                F.struct(F.col("year").alias("year"), F.lit(True).alias("now")),
                F.struct((F.col("year") - 1).alias("year"), F.lit(False).alias("now")),
            )
        ),
    )
    per_customer = noted.groupBy("customer_id", "year").agg(
        F.bool_or("now").alias("now"), F.bool_or(~F.col("now")).alias("next")
    )
    years = (
        per_customer.filter("now")
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("customers"), F.count_if("next").alias("retained"))
    )
    return years.withColumn("retention_rate", _share("retained", "customers"))


def customer_distribution(mart: DataFrame, customers: DataFrame) -> DataFrame:
    return _summary_with_state(mart, customers).groupBy("customers_state").agg(
        F.count(F.lit(1)).alias("customers")
    )


def _summary_with_state(mart: DataFrame, customers: DataFrame) -> DataFrame:
    return with_state(customer_summary(mart), customers)


def customer_acquisition(mart: DataFrame) -> DataFrame:
    """Customers by the month of their first order."""
    month = F.trunc("first_order", "month").alias("month")
    return customer_summary(mart).groupBy(month).agg(F.count(F.lit(1)).alias("customers"))


def value_over_time(mart: DataFrame) -> DataFrame:
    """Net revenue per active customer and quarter."""
    totals = _by_quarter(mart).agg(
        money(NET).alias("revenue"), F.count_distinct("customer_id").alias("customers")
    )
    return totals.withColumn("value", _share("revenue", "customers"))


def _retained(grouped, min_orders: int) -> DataFrame:
    counted = grouped.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("orders") >= min_orders).alias("retained"),
    )
    return counted.withColumn("retention_rate", _share("retained", "customers"))
