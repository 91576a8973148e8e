"""The flattened sales mart: one row per order line plus the unsold products."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.operators.joins import DEFAULT_SKEW, Skew, lookup_join
from martflow.plans.star import FACT
from martflow.sources.lookups import Calendar
from martflow.sources.workdir import at_hand, stage

PARTS = ("products", "customers", "stores", "staffs", "status", "dates")

# Date ids of the fact and the mart columns they become.
ROLE_DATES = {
    "order_date_id": "ordered_date",
    "required_date_id": "required_date",
    "shipped_date_id": "shipped_date",
}


@dataclass(frozen=True)
class Thresholds:
    """Fixed values by default: above which a line or a customer is marked."""

    high_value: float = 1000
    frequent: int = 5
    frequent_by: str = "lines"


# --- indicators --------------------------------------------------------------


def gross_revenue() -> Column:
    return F.col("order_list_price") * F.col("quantity")


def discounted_price() -> Column:
    return F.col("order_list_price") * (1 - F.col("discount"))


def revenue_columns() -> dict[str, Column]:
    return {
        "revenue_per_product": gross_revenue(),
        "price_after_discount": discounted_price(),
        "revenue_after_discount": discounted_price() * F.col("quantity"),
    }


def delay_columns() -> dict[str, Column]:
    """Days late against the promise (early is negative) and days to ship."""
    return {
        "delay_time": F.datediff("shipped_date", "required_date"),
        "days_to_ship": F.datediff("shipped_date", "ordered_date"),
    }


def flag_columns(thresholds: Thresholds) -> dict[str, Column]:
    return {
        "fulfilled_order_flag": _flag(F.col("shipped_date").isNotNull()),
        "high_value_order_flag": _flag(gross_revenue() > thresholds.high_value),
        "frequent_customer_flag": _flag(F.col("frequent_customer_flag") == 1),
    }


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# --- frequent customers ------------------------------------------------------


def customer_order_counts(fact: DataFrame, by: str = "lines") -> DataFrame:
    """Fact rows with an order, or distinct orders, per known customer id."""
    if by not in ("lines", "orders"):
        raise ValueError(f"cannot count customers by {by!r}; use 'lines' or 'orders'")
    counted = F.count("order_id") if by == "lines" else F.count_distinct("order_id")
    known = fact.filter(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(counted.alias("rows"))


def frequent_customers(fact: DataFrame, more_than: int = 5, by: str = "lines") -> DataFrame:
    return customer_order_counts(fact, by).filter(F.col("rows") > more_than)


def customers_with_flag(
    customers: DataFrame | None, fact: DataFrame, thresholds: Thresholds
) -> DataFrame:
    """Customer attributes and the frequency flag in one table.

    Joining the two here, both with a row per customer, leaves the fact a single
    join on its customer; the full join keeps frequent ids without attributes.
    """
    frequent = frequent_customers(fact, thresholds.frequent, thresholds.frequent_by).select(
        "customer_id", F.lit(1).alias("frequent_customer_flag")
    )
    return frequent if customers is None else customers.join(frequent, "customer_id", "full")


# --- products ----------------------------------------------------------------


def unsold_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Products that no fact row refers to."""
    return products.join(fact.select("product_id").distinct(), "product_id", "left_anti")


def with_products(
    rows: DataFrame,
    products: DataFrame,
    skew: Skew = DEFAULT_SKEW,
    base: DataFrame | None = None,
) -> DataFrame:
    """Fact rows with their product, whose own id replaces the fact's."""
    known = products.withColumn("__product_id", F.col("product_id"))
    joined = lookup_join(rows, known, "product_id", base=base, skew=skew)
    return joined.drop("product_id").withColumnRenamed("__product_id", "product_id")


def full_join_products(
    fact: DataFrame, products: DataFrame, skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """Full outer join that does not shuffle the fact for a small product table.

    A full outer join always shuffles both sides. The left join may broadcast,
    and finding the unsold products shuffles no more than distinct product ids.
    """
    sold = with_products(fact, products, skew)
    return sold.unionByName(unsold_products(fact, products), allowMissingColumns=True)


# --- the mart ----------------------------------------------------------------


def build_mart(
    star: Mapping[str, DataFrame],
    thresholds: Thresholds = Thresholds(),
    parts: Collection[str] = PARTS,
    skew: Skew = DEFAULT_SKEW,
    calendar: Calendar | None = None,
) -> DataFrame:
    """Join the star and add the indicators.

    A measure may ask for the ``parts`` it reads, as Spark cannot drop a left join
    with a dimension that it does not know to be unique. Customers with their flag are
    stored and measured first, so that their own size decides how the fact meets them; so is a large
    fact that is itself a join, as several steps read it; the rest is lazy. With the ``calendar`` of the star, the days of the three dates are computed from their
    ids; without it they are looked up in the date dimension.
    """
    unknown = set(parts) - set(PARTS)
    if unknown:
        raise ValueError(f"unknown parts {sorted(unknown)}; use some of {PARTS}")
    fact = star[FACT]
    if set(parts) - {"dates"}:
        # joins read the fact for their hot keys, the flag and the unsold products too
        fact = at_hand(fact, "fact", skew.min_bytes)
    rows = fact.withColumnRenamed("list_price", "order_list_price")

    def lookup(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
        # Keys are counted on the fact itself, not on what is joined so far.
        return lookup_join(rows, dim, key, base=fact, skew=skew)

    # The two tables that grow come first, the one with the shorter rows before the other: where they are not
    # broadcast, the rows are shuffled while they hold little more than the fact's ids.
    if "products" in parts:
        products = star["products_dim"].withColumnRenamed("list_price", "product_list_price")
        rows = with_products(rows, products, skew, fact)
    if "customers" in parts:
        buyers = stage(customers_with_flag(star["customers_dim"], fact, thresholds), "customers")
        # The aggregate behind the flag also tells which customers are hot.
        counts = customer_order_counts(fact)
        rows = lookup_join(
            rows, buyers.table, "customer_id", counts=counts, size=buyers.size, skew=skew
        )
    if "stores" in parts:
        rows = lookup(rows, star["stores_dim"], "store_id")
    if "staffs" in parts:
        rows = lookup(rows, star["staffs_dim"].drop("store_id"), "staff_id")
    if "status" in parts:
        statuses = star["status_dim"].withColumnRenamed("status_id", "order_status")
        rows = lookup(rows, statuses, "order_status")
    if "dates" in parts:
        for id_column, name in ROLE_DATES.items():
            if calendar is not None:
                rows = rows.withColumn(name, calendar.date(F.col(id_column)))
                continue
            day = F.col("date").alias(name)
            days = star["date_dim"].select(F.col("date_id").alias(id_column), day)
            rows = lookup(rows, days, id_column)
    if "products" in parts:
        unsold = unsold_products(fact, products)
        rows = rows.unionByName(unsold, allowMissingColumns=True)

    indicators = revenue_columns()
    flags = flag_columns(thresholds)
    if "dates" in parts:
        indicators |= delay_columns()
        indicators["fulfilled_order_flag"] = flags["fulfilled_order_flag"]
    indicators["high_value_order_flag"] = flags["high_value_order_flag"]
    if "customers" in parts:
        indicators["frequent_customer_flag"] = flags["frequent_customer_flag"]
    return rows.withColumns(indicators).drop("store_id", "staff_id", *ROLE_DATES)

